"""Collection checks, logs, usage, matching, files, streams."""

import difflib
import json
import random
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from marquee import fixed, schemas
from marquee.operators import analytics, collection, lookup, matching, picks_log, quality, usage
from marquee.plans.candidates import candidates_of_run
from marquee.plans import weekly
from marquee.session import through_table, work_path
from marquee.sources import feeds_html, week_files
from marquee.streaming import jobs, sink

WEEK = date(2026, 7, 20)
DAY = "2026-07-20"


def messages(df):
    return sorted((r.check, r.entity or "", r.message) for r in df.collect())


# Collection ----------------------------------------------------------------------------------


def test_provenance_compares_text_and_includes_the_bounds(spark):
    start, end = "2026-07-20T10:00:00", "2026-07-20T10:05:00Z"
    files = spark.createDataFrame(
        [(WEEK, s, t) for s, t in [
            ("a", "2026-07-20T10:01:00+00:00"), ("b", "2026-07-20T10:01:00+00:00"), ("c", "2026-07-20T10:01:00Z"),
            ("d", "2026-07-20T10:00:00Z"), ("e", "2026-07-20T06:05:00-04:00"), ("f", "2026-07-20T10:05:01Z"), ("g", None), ("h", ""), ("i", "soon"),
        ]], "week DATE, source STRING, collected_at STRING",
    )
    runs = spark.createDataFrame([(WEEK, start, end)], "week DATE, run_started STRING, run_completed STRING")
    assert messages(quality.provenance(files, runs)) == [
        ("provenance", "", "2 source files share the collected_at 2026-07-20T10:01:00+00:00"),
        ("provenance", "f", "collected_at 2026-07-20T10:05:01Z is outside the run"),
    ]
    assert sorted(r.source for r in quality.shared_stamp_sources(files).collect()) == ["a", "b"]


def test_seventeen_identical_stamps_are_one_finding(spark):
    rows = [(WEEK, f"s{i:02d}", "2026-07-27T01:00:00+00:00" if i < 17 else f"2026-07-27T01:00:{i:02d}+00:00") for i in range(27)]
    files = spark.createDataFrame(rows, "week DATE, source STRING, collected_at STRING")
    (only,) = quality.shared_stamps(files).collect()
    assert only.n_sources == 17


def manifest(spark, rows):
    return spark.createDataFrame([(WEEK, *r) for r in rows], "week DATE, source STRING, status STRING, events BIGINT")


def test_yield_floors(spark):
    rows = manifest(spark, [("low", "ok", 2), ("at", "ok", 3), ("none", "ok", None), ("off", "ok", 0), ("bad", "failed", None)])
    floors = spark.createDataFrame([("low", 3), ("at", 3), ("none", 1), ("off", 0), ("bad", 9)], "source STRING, min_expected BIGINT")
    assert messages(quality.yield_floor(rows, floors, 6)) == [
        ("yield_floor", "", "total events 5 below whole-run floor 6"),
        ("yield_floor", "low", "wrote 2 events, below floor 3"),
        ("yield_floor", "none", "wrote 0 events, below floor 1"),
    ]
    assert len(messages(quality.yield_floor(rows, floors, 5))) == 2
    assert len(messages(quality.yield_floor(rows, floors, 0))) == 2


def test_manifest_agreement(spark):
    rows = manifest(spark, [("same", "ok", 2), ("more", "ok", 2), ("gone", "ok", 1), ("failed", "failed", None), ("failed_gone", "failed", None)])
    files = spark.createDataFrame([(WEEK, s, n) for s, n in [("same", 2), ("more", 3), ("failed", 0), ("orphan", 4)]], "week DATE, source STRING, n_events BIGINT")
    assert messages(quality.manifest_agreement(rows, files)) == [
        ("file_agreement", "failed_gone", "manifest entry without a source file"),
        ("file_agreement", "gone", "manifest entry without a source file"),
        ("file_agreement", "more", "manifest claims 2 events but the file holds 3"),
        ("file_agreement", "orphan", "source file has no manifest entry"),
    ]


def test_snapshot_regression(spark):
    schema = "week DATE, source STRING, n_events BIGINT"
    prior = spark.createDataFrame([(WEEK, "a", 3), (WEEK, "b", 0), (WEEK, "c", 2), (WEEK, "d", 1)], schema)
    now = spark.createDataFrame([(WEEK, "a", 0), (WEEK, "d", 5)], schema)
    assert [m[1] for m in messages(quality.snapshot_regression(now, prior))] == ["a", "c"]


def test_fetch_rollup(spark):
    rows = [("all", 1, 3, False, 0), ("all", 2, 3, False, 0), ("some", 1, 2, True, 5), ("some", 2, 2, False, 0), ("some", 3, 2, True, 9),
            ("many", 6, 20, True, 1), ("many", 7, 20, True, 100), ("quiet", 1, 1, True, 0)]
    fetches = spark.createDataFrame([(WEEK, *r) for r in rows], "week DATE, source STRING, page INT, total_pages INT, ok BOOLEAN, n_events BIGINT")
    got = {r.source: (r.status, r.events, r.note) for r in collection.fetch_rollup(fetches).collect()}
    assert got == {
        "all": ("failed", None, None), "some": ("ok", 14, "partial -- 1 request(s) failed"), "many": ("ok", 101, None), "quiet": ("ok", 0, None)
    }


def test_resume_plan(spark):
    registry = spark.createDataFrame([("a",), ("b",), ("c",)], "source STRING")
    results = spark.createDataFrame([("a", "failed"), ("a", "ok"), ("b", "failed"), ("z", "ok")], "source STRING, status STRING")
    assert {r.source: r.action for r in collection.resume_plan(registry, results).collect()} == {"b": "retry", "c": "fetch"}


def test_union_first_seen(spark):
    rows = [("A", "d1", "m1", 1, "x"), ("A", "d1", "m2", 0, "y"), ("A", "d2", "m2", 1, "z")]
    got = collection.union_first_seen(spark.createDataFrame(rows, "title STRING, date STRING, snapshot STRING, pos INT, venue STRING"))
    assert sorted(r.venue for r in got.collect()) == ["x", "z"]


def test_seven_days_always(spark):
    rows = spark.createDataFrame([(WEEK, "c0", "T", "2026-07-22"), (WEEK, "c1", "T", "2026-07-22")], "week DATE, id STRING, title STRING, date STRING")
    got = collection.day_split(rows).orderBy("date").collect()
    assert [r.n_candidates for r in got] == [0, 0, 2, 0, 0, 0, 0]
    assert collection.out_of_window(rows).count() == 0


def test_a_candidate_outside_its_week_stops_the_write(spark, tmp_path):
    schema = "week DATE, id STRING, title STRING, date STRING"
    good = spark.createDataFrame([(WEEK, "c0", "T", "2026-07-26")], schema)
    week_files.write_day_split(good, str(tmp_path))
    for bad in ("2026-07-27", "2026-07-19", "", None):
        with pytest.raises(week_files.RowsRejected, match="c9"):
            week_files.write_day_split(good.union(spark.createDataFrame([(WEEK, "c9", "T", bad)], schema)), str(tmp_path))
    assert spark.read.parquet(f"{tmp_path}/candidates").count() == 1
    assert spark.read.parquet(f"{tmp_path}/days").count() == 7


# Week folders --------------------------------------------------------------------------------


@pytest.fixture
def week_folder(tmp_path):
    folder = tmp_path / "2026-07-20"
    folder.mkdir()

    def event(title, day=DAY, **more):
        return {"title": title, "venue": "Hall", "date": day, "time": "7:00 PM", "cost": "", "url": "", "description": "", **more}

    stamp = "2026-07-20T10:0{}:00+00:00"
    files = {
        "alpha": {"source": "Do215", "collected_at": stamp.format(1), "events": [event("Both", description="plain"), {"title": "Sparse", "date": DAY}]},
        "beta": {"source": "beta", "collected_at": stamp.format(2), "events": [event("Both", description="SOLD OUT")]},
        "gamma": {"collected_at": stamp.format(3), "events": [event("Nameless")]},
        "failing": {"source": "failing", "status": "failed", "reason": "HTTP 500", "collected_at": stamp.format(4)},
        "orphan": {"source": "orphan", "collected_at": stamp.format(4), "events": [event("Lost")]},
        "candidates": {"week": DAY, "candidates": []},
    }
    sources = {"alpha": {"status": "ok", "events": 2}, "beta": {"status": "ok", "events": 9}, "gamma": {"status": "ok", "events": 1},
               "failing": {"status": "failed", "reason": "HTTP 500"}, "absent": {"status": "ok", "events": 1}}
    files["manifest"] = {"week": DAY, "run_started": "2026-07-20T10:00:00", "run_completed": "2026-07-20T10:03:00Z", "sources": sources}
    for name, body in files.items():
        (folder / f"{name}.json").write_text(json.dumps(body))
    return folder


def test_week_folder_end_to_end(spark, week_folder):
    entries = week_files.read_manifest(spark, f"{week_folder}/manifest.json")
    files = week_files.read_source_files(spark, str(week_folder))
    assert sorted(r.stem for r in files.collect()) == ["alpha", "beta", "failing", "gamma", "orphan"]
    got = candidates_of_run(entries, week_files.source_events(files)).orderBy("ord").collect()
    assert [(r.id, r.title, r.source, r.description) for r in got] == [
        ("c0000", "Both", "Do215", fixed.SOLD_OUT_NOTE + "plain"), ("c0001", "Sparse", "Do215", ""), ("c0002", "Nameless", "gamma", "")
    ]
    floors = spark.createDataFrame([("alpha", 3)], "source STRING, min_expected BIGINT")
    found = weekly.collection_issues(entries, week_files.source_counts(files), floors)
    assert [(c, e) for c, e, _ in messages(found)] == [
        ("file_agreement", "absent"), ("file_agreement", "beta"), ("file_agreement", "orphan"),
        ("provenance", ""), ("provenance", "failing"), ("provenance", "orphan"), ("yield_floor", ""), ("yield_floor", "alpha"),
    ]
    with pytest.raises(week_files.RowsRejected):
        weekly.stop_on_failures(found)


def test_failures_are_listed_with_a_default_reason(spark):
    rows = spark.createDataFrame([(WEEK, "b", "failed", None), (WEEK, "a", "failed", "x"), (WEEK, "c", "ok", None)], "week DATE, source STRING, status STRING, reason STRING")
    assert sorted(r.failure for r in collection.failure_list(rows).collect()) == ["a (x)", "b (unknown reason)"]


def test_manifest_round_trip(spark, tmp_path):
    results = spark.createDataFrame(
        [(WEEK, "b", "ok", 2, None, "t2"), (WEEK, "a", "failed", None, "x", "t1"), (WEEK, "b", "failed", None, "y", "t3")],
        "week DATE, source STRING, status STRING, events BIGINT, reason STRING, collected_at STRING",
    )
    documents = week_files.manifest_documents(collection.build_manifest(results))
    documents.write.json(str(tmp_path / "m"))
    back = week_files.read_manifest(spark, str(tmp_path / "m")).orderBy("source").collect()
    assert [(r.source, r.status, r.events, r.reason, r.run_started, r.run_completed) for r in back] == [
        ("a", "failed", None, "x", "t1", "t3"), ("b", "ok", 2, None, "t1", "t3")
    ]


def test_missing_documents(spark, tmp_path):
    assert week_files.read_music_lookup(spark, f"{tmp_path}/none.json").count() == 0
    assert week_files.read_or_empty(spark, f"{tmp_path}/none.json", schemas.MANIFEST).count() == 0
    with pytest.raises(week_files.MissingInput, match="the selection"):
        week_files.read_annotations(spark, f"{tmp_path}/none.json")
    (tmp_path / "spotify.json").write_text(json.dumps({"A": {"spotify_url": "u", "matched_text": "A"}, "B": None}))
    got = week_files.read_music_lookup(spark, f"{tmp_path}/spotify.json").orderBy("title").collect()
    assert [tuple(r) for r in got] == [("A", "u", "A"), ("B", None, None)]


def test_annotation_documents(spark, tmp_path):
    body = {"week": DAY, "days": [{"date": DAY, "day_name": "Monday", "top3": [{"id": "c1", "rank": 1, "why": "w", "category": "x"}],
            "honorable_mentions": [{"id": "c2"}], "annotations": [{"id": "c1", "category": "x"}, {"id": "c2", "category": "y", "sold_out": True}]}]}
    (tmp_path / "a.json").write_text(json.dumps(body))
    days, notes, picks, mentions = week_files.read_annotations(spark, f"{tmp_path}/a.json")
    assert (days.count(), notes.count(), picks.first().id, mentions.first().id) == (1, 2, "c1", "c2")
    assert notes.where("id = 'c2'").first().sold_out is True


# Logs ----------------------------------------------------------------------------------------


def test_append_is_idempotent(spark, tmp_path):
    rows = spark.createDataFrame([("Philadelphia", DAY, "Monday", DAY, t, "Hall, \"up\"", "music", "s", "1", "low", "", "", "") for t in ("A", "B, C", 'D "E"')], schemas.PICKS_LOG)
    path = str(tmp_path / "log")
    empty = spark.createDataFrame([], schemas.PICKS_LOG)
    assert week_files.read_picks_log(spark, path).count() == 0
    week_files.append_picks_log(picks_log.new_rows(rows, empty), path)
    log = week_files.read_picks_log(spark, path)
    week_files.export_picks_log(log, f"{path}-csv")
    assert sorted(week_files.import_picks_log(spark, f"{path}-csv").collect()) == sorted(log.collect())
    assert sorted(r.title for r in log.collect()) == ["A", "B, C", 'D "E"']
    assert picks_log.new_rows(rows, log).count() == 0
    other = rows.withColumn("week_of", F.lit("2026-07-27"))
    assert picks_log.new_rows(other, log).count() == 3


def test_attendance_changes_one_city_and_week(spark):
    schema = "city STRING, week_of STRING, date STRING, title STRING, venue STRING, rank STRING, attended STRING"
    log = spark.createDataFrame([
        ("Philadelphia", DAY, DAY, "A", "v", "1", ""), ("Philadelphia", DAY, DAY, "B", "v", "HM", "true"),
        ("Philadelphia", "2026-07-13", DAY, "A", "v", "1", "kept"), ("Camden", DAY, DAY, "A", "v", "1", ""),
        ("Philadelphia", DAY, DAY, "a", "v", "2", ""),
    ], schema)
    titles = spark.createDataFrame([("A",), ("A",)], "title STRING")
    got = {(r.city, r.week_of, r.title): r.attended for r in picks_log.update_attendance(log, titles, DAY).collect()}
    assert got == {
        ("Philadelphia", DAY, "A"): "true", ("Philadelphia", DAY, "B"): "false", ("Philadelphia", "2026-07-13", "A"): "kept",
        ("Camden", DAY, "A"): "", ("Philadelphia", DAY, "a"): "false",
    }


def test_attendance_rewrites_one_week_of_the_log_table(spark, tmp_path):
    path = str(tmp_path / "log")
    rows = [("Philadelphia", w, "Monday", w, t, "v", "music", "s", "1", "low", "", "", "") for w in (DAY, "2026-07-13") for t in ("A", "B")]
    spark.createDataFrame(rows, schemas.PICKS_LOG).write.partitionBy("week_of").parquet(path)
    weekly.record_attendance(spark, path, spark.createDataFrame([("A",)], "title STRING"), DAY)
    got = sorted((str(r.week_of), r.title, r.attended) for r in spark.read.parquet(path).collect())
    assert got == [("2026-07-13", "A", ""), ("2026-07-13", "B", ""), (DAY, "A", "true"), (DAY, "B", "false")]


def test_fixed_tables(spark):
    assert collection.registry(spark).count() == 23
    assert collection.yield_floors(spark).where("source = 'wxpn'").first().min_expected == 15
    rows = spark.createDataFrame([("Ruba Club",), ("Nowhere",)], "venue STRING")
    got = {r.venue: r.address for r in lookup.venue_address(rows, lookup.known_addresses(spark), ["venue"]).collect()}
    assert got == {"Ruba Club": "416 Green St, Philadelphia, PA 19123", "Nowhere": None}


def test_log_normalisation(spark):
    log = spark.createDataFrame([("hm", "TRUE "), ("HM", "punk"), ("1", "")], "rank STRING, attended STRING")
    assert sorted(tuple(r) for r in picks_log.normalise(log).collect()) == [("1", ""), ("HM", ""), ("HM", "true")]


def test_salted_lookup_keeps_every_row_of_a_hot_key(spark):
    left = spark.range(3_000).select(F.when(F.col("id") < 1_000, F.lit("hot")).otherwise(F.col("id").cast("string")).alias("k"), "id")
    right = spark.createDataFrame([("hot", 1), ("2999", 2)], "k STRING, v INT")
    got = lookup.salted_lookup(left, right, ["k"], ["id"])
    assert got.count() == 3_000
    assert got.where("v = 1").count() == 1_000 and got.where("v = 2").count() == 1


def plan_of(df):
    return df._jdf.queryExecution().toString()


def test_copies_of_a_lookup_are_broadcast_only_when_all_of_them_are_small(spark, tmp_path):
    spark.range(100_000).select("id", (F.col("id") % 7).alias("v")).write.parquet(str(tmp_path / "right"))
    right = spark.read.parquet(str(tmp_path / "right"))
    spark.range(1_000_000).withColumn("n", F.col("id")).write.parquet(str(tmp_path / "left"))
    got = lookup.salted_lookup(spark.read.parquet(str(tmp_path / "left")), right, ["id"], ["n"])
    assert "BroadcastHashJoin" not in plan_of(got)
    assert got.where("v IS NOT NULL").count() == 100_000


def test_the_manifest_is_not_repeated_for_its_events(spark):
    manifest = spark.createDataFrame([(WEEK, "hot", "ok"), (WEEK, "bad", "failed")], "week DATE, source STRING, status STRING")
    stem = F.when(F.col("id") < 900, "hot").otherwise("bad")
    events = spark.range(1_000).select(F.lit(WEEK).alias("week"), stem.alias("stem"), F.lit(None).cast("string").alias("source"), F.col("id").alias("pos"))
    got = collection.ok_events(manifest, events)
    assert "_salt" not in plan_of(got)
    assert got.count() == 900 and {r.source for r in got.select("source").distinct().collect()} == {"hot"}


def test_detail_pages_are_not_repeated_for_their_cards(spark):
    card = '<li data-hook="events-card"><a data-hook="title" href="u">T</a></li>'
    block = json.dumps({"@type": "Event", "name": "N", "startDate": f"{DAY}T20:00:00-04:00"})
    payloads = spark.createDataFrame([("feed", WEEK, 0, card * 3)], "source STRING, week_start DATE, page LONG, body STRING")
    payloads = payloads.selectExpr("*", "CAST(NULL AS DATE) AS context_date", "'' AS venue", "'' AS fallback_url")
    details = spark.createDataFrame([("u", f'<script type="application/ld+json">{block}</script>')], "url STRING, body STRING")
    got = feeds_html.json_ld(payloads, details)
    assert "_salt" not in plan_of(got)
    assert [r.title for r in got.collect()] == ["N", "N", "N"]


def test_attendance_copies_only_titles_of_its_week(spark, tmp_path):
    schema = "city STRING, week_of STRING, date STRING, title STRING, venue STRING, rank STRING, attended STRING"
    log = spark.createDataFrame([("Philadelphia", DAY, DAY, t, "v", "1", "") for t in ("5", "x")], schema)
    titles = spark.range(50_000).select(F.col("id").cast("string").alias("title"))
    got = picks_log.update_attendance(log, titles, DAY)
    assert "LeftSemi" in plan_of(got)
    assert sorted((r.title, r.attended) for r in got.collect()) == [("5", "true"), ("x", "false")]


# Matching ------------------------------------------------------------------------------------


def plain_ratio(a, b):
    return difflib.SequenceMatcher(None, a.lower(), b.lower()).ratio()


def edit_share(a, b):
    a, b = (x.lower().removesuffix("(sold out)").rstrip() for x in (a, b))
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row, last = [i], row
        for j, y in enumerate(b, 1):
            row.append(min(row[-1] + 1, last[j] + 1, last[j - 1] + (x != y)))
    return 1.0 - row[-1] / max(len(a), len(b), 1)


def brute_match(title, listed, measure):
    """First equal title, else the first of the best ratios from 0.6 up."""
    for pos, t in listed:
        if t == title:
            return pos
    best, score = None, 0.0
    for pos, t in listed:
        ratio = measure(title, t)
        if ratio > score:
            best, score = pos, ratio
    return best if score >= 0.6 else None


@pytest.mark.parametrize(
    ("ratio", "options"),
    [(edit_share, []), (edit_share, [matching.edit_ratio, matching._comparable, 1]), (plain_ratio, [matching.title_ratio, F.lower])],
)
def test_fuzzy_match_against_brute_force(spark, ratio, options):
    rng = random.Random(11)
    words = ["night", "jazz", "open", "house", "film", "punk", "show", "(SOLD OUT)", "SEASIDE,", "NJ"]
    listing = [(d, pos, " ".join(rng.choices(words, k=rng.randrange(1, 5)))) for d in ("d1", "d2") for pos in range(60)]
    mentions = [(d, i, " ".join(rng.choices(words, k=rng.randrange(1, 6)))) for d in ("d1", "d2") for i in range(25)]
    got = matching.match_mentions(
        spark.createDataFrame(mentions, "day STRING, nth INT, title STRING"),
        spark.createDataFrame(listing, "day STRING, pos INT, title STRING").withColumn("where", F.col("pos")),
        ["day"], ["where"], *options,
    ).collect()
    assert len(got) == len(mentions)
    for r in got:
        assert r.hit_where == brute_match(r.title, [(p, t) for d, p, t in listing if d == r.day], ratio), r


def test_names_are_tried_in_order(spark):
    titles = spark.createDataFrame([("Late ball: The Lamps, Ivo",), ("Solo & Friends",), ("Nobody",), ("Solo & Friends",)], "title STRING")
    catalogue = spark.createDataFrame([("THE LAMPS ", "u1", 5), ("the lamps", "u0", 9), ("solo", "u2", 1), ("friends", "u3", 1)], "name STRING, url STRING, rank INT")
    got = matching.lookup_names(titles, catalogue)
    assert {r.title: (r.spotify_url, r.matched_text) for r in got.collect()} == {
        "Late ball: The Lamps, Ivo": ("u1", "The Lamps"), "Solo & Friends": ("u2", "Solo"), "Nobody": (None, None)
    }
    rate = analytics.match_rate(titles.withColumn("kind", F.lit("x")), got, "kind").first()
    assert (rate.titles, rate.matched) == (3, 2)


# Usage ---------------------------------------------------------------------------------------


def usage_line(i, n, **more):
    return json.dumps({"type": "assistant", "message": {"id": i, "usage": {"input_tokens": n, "output_tokens": 1, **more}}})


@pytest.fixture
def usage_folder(tmp_path):
    (tmp_path / "s1" / "subagents").mkdir(parents=True)
    main = [usage_line("m1", 1), "", "not json", usage_line("m1", 2), '{"type": "user"}', usage_line("m2", 5, cache_read_input_tokens=None),
            '{"type": "assistant", "message": {"id": "m3"}}', '{"type": "assistant", "message": {"usage": {}}}', usage_line("m1", 7)]
    (tmp_path / "s1.jsonl").write_text("\n".join(main) + "\n")
    (tmp_path / "s1" / "subagents" / "a.jsonl").write_text(usage_line("m1", 100, cache_creation_input_tokens=40) + "\n")
    return tmp_path


def test_usage_report(spark, usage_folder):
    readings = usage.latest_readings(week_files.read_usage_log(spark, str(usage_folder)))
    agents = spark.createDataFrame([("s1", "a", "explorer", "looks")], "session STRING, agent STRING, agent_type STRING, description STRING")
    rows = usage.ordered(usage.report(readings, agents)).collect()
    got = [(r.scope, r.input_tokens, r.output_tokens, r.message_count, r.agent_type) for r in rows]
    assert got == [("main", 12, 2, 2, ""), ("agent", 100, 1, 1, "explorer"), ("session", 112, 3, 3, ""), ("all", 112, 3, 3, "")]
    units = {r.scope: r.weighted_units for r in usage.weighted(usage.totals(readings)).collect()}
    assert units["agent"] == 100 + 40 * 1.25 + 5


# Streams -------------------------------------------------------------------------------------


def test_usage_stream_settles_late_readings_across_batches(spark, tmp_path):
    schema = "session STRING, agent STRING, message_id STRING, line_no BIGINT, input_tokens BIGINT, cache_creation_input_tokens BIGINT, cache_read_input_tokens BIGINT, output_tokens BIGINT"
    source, table, checkpoint = (str(tmp_path / n) for n in ("in", "table", "cp"))
    batches = [[("s", "", "m1", 5, 50, 0, 0, 0), ("s", "", "m1", 4, 40, 0, 0, 0)], [("s", "", "m1", 2, 20, 0, 0, 0), ("s", "", "m2", 9, 9, 0, 0, 0)]]
    for rows in batches:
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(source)
        stream = spark.readStream.schema(schema).parquet(source)
        jobs.usage_stream(stream, table, checkpoint).awaitTermination()
    got = jobs.usage_readings(sink.read(spark, table)).collect()
    assert sorted((r.message_id, r.input_tokens) for r in got) == [("m1", 50), ("m2", 9)]


def test_identical_copies_are_dropped_within_the_delay(spark, tmp_path):
    schema = "session STRING, agent STRING, message_id STRING, at TIMESTAMP, input_tokens BIGINT"
    at = datetime(2026, 7, 20, 10)
    spark.createDataFrame([("s", "", "m", at, 1)] * 3 + [("s", "", "n", at, 2)], schema).write.parquet(str(tmp_path / "in"))
    stream = jobs.drop_copies(spark.readStream.schema(schema).parquet(str(tmp_path / "in")), "at", "10 minutes")
    q = stream.writeStream.format("parquet").option("path", str(tmp_path / "out")).option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start()
    q.awaitTermination()
    assert spark.read.parquet(str(tmp_path / "out")).count() == 2


def test_log_stream_survives_a_repeated_batch(spark, tmp_path):
    schema = "week_of STRING, title STRING, rank STRING"
    table = str(tmp_path / "table")
    sink.create(spark, table, spark.createDataFrame([("w1", "A", "1")], schema))
    source = str(tmp_path / "in")
    spark.createDataFrame([("w1", "A", "2"), ("w1", "B", "1"), ("w1", "B", "HM")], schema).coalesce(1).write.parquet(source)
    for checkpoint in ("cp1", "cp2"):
        stream = spark.readStream.schema(schema).parquet(source)
        jobs.log_stream(stream, table, str(tmp_path / checkpoint)).awaitTermination()
        got = sink.read(spark, table).drop("batch").collect()
        assert sorted(tuple(r) for r in got) == [("w1", "A", "1"), ("w1", "B", "1"), ("w1", "B", "HM")]


def test_payload_stream_parses_each_file_once(spark, tmp_path):
    source, table, checkpoint = (str(tmp_path / n) for n in ("in", "table", "cp"))
    for i in range(2):
        body = json.dumps({"items": [{"summary": f"e{i}", "start": {"date": "2026-07-21"}}]})
        spark.createDataFrame([("src", i, WEEK, None, None, None, body)], schemas.PAYLOAD).coalesce(1).write.mode("append").parquet(source)
        stream = spark.readStream.schema(schemas.PAYLOAD).parquet(source)
        jobs.payload_stream(stream, "calendar_json", table, checkpoint).awaitTermination()
    assert sorted((r.title, r.batch) for r in sink.read(spark, table).collect()) == [("e0", 0), ("e1", 1)]


def test_shared_folder_comes_from_the_session(spark):
    assert work_path(spark, "x").startswith(spark.conf.get("spark.checkpoint.dir"))
    assert through_table(spark.range(5), "t").count() == 5


def test_collapse_stream_equals_one_run(spark, tmp_path):
    from marquee.operators import collapse

    schema = "week DATE, stem STRING, pos BIGINT, source STRING, title STRING, venue STRING, date STRING, time STRING, cost STRING, url STRING, description STRING"
    rng = random.Random(12)
    weeks = [date(2026, 7, 6 + 7 * k) for k in range(3)]

    def row(k):
        week = weeks[k % 3]
        return (week, f"s{rng.randrange(3)}", k, rng.choice("abc"), f"T{rng.randrange(6)}", rng.choice(["Hall", None]), str(week), rng.choice(["", "7:00 PM"]),
                rng.choice(["", "$5"]), "u", rng.choice(["x", "now sold out", None]))

    files = [[row(k) for k in range(at, at + 40)] for at in (0, 40, 80)]
    files.append(files[0] + [row(k) for k in range(120, 140)])  # an early file again, with rows for weeks long seen
    source, table, checkpoint = (str(tmp_path / x) for x in ("in", "table", "cp"))
    for rows in files:
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(source)
        jobs.collapse_stream(spark.readStream.schema(schema).parquet(source), table, checkpoint, ["b", "a"]).awaitTermination()
    every = spark.createDataFrame([r for rows in files for r in rows], schema)
    expected = collapse.collapse_duplicates(every, ["b", "a"])
    got = jobs.collapsed(sink.read(spark, table)).select(*expected.columns)
    assert sorted(map(str, got.collect())) == sorted(map(str, expected.collect()))
    assert sink.read(spark, table).select("batch").distinct().count() == 4


def test_collapse_stream_lets_old_weeks_go(spark, tmp_path):
    schema = "week DATE, stem STRING, pos BIGINT, source STRING, title STRING, venue STRING, date STRING, time STRING, cost STRING, url STRING, description STRING"
    source, table, checkpoint = (str(tmp_path / x) for x in ("in", "table", "cp"))

    def arrive(*rows):
        made = [(w, "s", p, "a", t, "Hall", str(w), "", "", "", d) for w, p, t, d in rows]
        spark.createDataFrame(made, schema).coalesce(1).write.mode("append").parquet(source)
        jobs.collapse_stream(spark.readStream.schema(schema).parquet(source), table, checkpoint, [], "14 days").awaitTermination()

    first, last = date(2026, 7, 6), date(2026, 8, 31)
    arrive((first, 1, "T", "x"))
    arrive((first, 0, "T", "y"), (last, 2, "T", "x"))
    arrive((last, 3, "U", "x"))
    arrive((first, 0, "late", "x"), (last, 1, "T", "z"))
    got = {(r.week, r.title): r.pos for r in jobs.collapsed(sink.read(spark, table)).collect()}
    assert got == {(first, "T"): 0, (last, "T"): 1, (last, "U"): 3}


def test_log_keys_stand_in_for_the_log(spark, tmp_path):
    path = str(tmp_path / "log")

    def rows(*keys):
        made = [("c", w, "d", "1", t, "v", "k", "s", "1", "$", "", "", "") for w, t in keys]
        return spark.createDataFrame(made, schemas.PICKS_LOG)

    def fresh(*keys):
        new = picks_log.new_rows_by_digest(rows(*keys), week_files.read_log_keys(spark, path))
        plain = picks_log.new_rows(rows(*keys), week_files.read_picks_log(spark, path)).select(*new.columns)
        assert sorted(map(tuple, new.collect())) == sorted(map(tuple, plain.collect()))
        return sorted((r.week_of, r.title) for r in new.collect())

    asked = [("2026-07-06", "a"), ("2026-07-13", "b"), ("2026-07-13", "c")]
    assert fresh(*asked) == asked
    week_files.append_picks_log(rows(*asked[:2]), path)
    assert fresh(*asked) == asked[2:]
    # A run that broke off before the side table was written.
    rows(*asked[2:]).write.mode("append").partitionBy("week_of").parquet(path)
    assert fresh(*asked, ("2026-07-20", "d")) == [("2026-07-20", "d")]
