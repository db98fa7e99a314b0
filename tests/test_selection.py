"""Merge, ranking, caps, selection checks, report tables."""

import random
from datetime import date

import pytest
from pyspark.sql import functions as F

from marquee import fixed
from marquee.operators import merge, numbering, quality, ranking, report
from marquee.plans import weekly
from marquee.sources.week_files import RowsRejected

WEEK = date(2026, 7, 20)
DAY, NEXT = "2026-07-20", "2026-07-21"
MUSIC, FILM, MISC = fixed.CATEGORIES[0][0], fixed.CATEGORIES[1][0], "Misc"

CANDIDATE = "week DATE, id STRING, ord BIGINT, title STRING, venue STRING, date STRING, time STRING, cost STRING, url STRING, source STRING"
ANNOTATION = "week DATE, day STRING, id STRING, category STRING, sold_out BOOLEAN, note STRING, pos BIGINT"
PICK = "week DATE, day STRING, rank INT, id STRING, category STRING, why STRING, is_music BOOLEAN, sold_out BOOLEAN, address STRING, time STRING"
MENTION = "week DATE, day STRING, pos INT, id STRING"


def candidate(i, title=None, day=DAY, time="7:00 PM", cost="$5", venue="Hall"):
    return (WEEK, f"c{i:04d}", i, title or f"T{i}", venue, day, time, cost, f"u{i}", "src")


def note(i, category=MUSIC, day=DAY, sold_out=None, text=None, pos=None):
    return (WEEK, day, f"c{i:04d}", category, sold_out, text, i if pos is None else pos)


def pick(i, rank=1, day=DAY, category=MUSIC, why="why", music=None, sold_out=None, address=None, time=None):
    return (WEEK, day, rank, f"c{i:04d}", category, why, music, sold_out, address, time)


@pytest.fixture
def tables(spark):
    def build(candidates, notes, picks=(), mentions=()):
        return (
            spark.createDataFrame(candidates, CANDIDATE),
            spark.createDataFrame(notes, ANNOTATION),
            spark.createDataFrame(list(picks), PICK),
            spark.createDataFrame(list(mentions), MENTION),
        )

    return build


def test_pick_takes_facts_from_the_candidate(tables):
    c, a, p, _ = tables([candidate(1, cost="", time="7:00 PM, 9:00 PM")], [note(1)], [pick(1, address="", time="7:00 PM")])
    (row,) = merge.merge_picks(p, c, a).collect()
    assert (row.title, row.time, row.cost, row.url, row.address, row.is_music, row.sold_out) == (
        "T1", "7:00 PM", "Not listed", "u1", None, False, False
    )


def test_an_override_of_the_time_leaves_the_listing_alone(tables):
    c, a, p, _ = tables([candidate(1, time="doors 7, show 8")], [note(1)], [pick(1, time="8:00 PM")])
    assert merge.merge_picks(p, c, a).first().time == "8:00 PM"
    assert merge.merge_events(c, a).first().time == "doors 7, show 8"


def test_sold_out_mentions_say_so_once(tables):
    c, a, _, m = tables(
        [candidate(1, "A"), candidate(2, "B (SOLD OUT)"), candidate(3, "C")],
        [note(1, sold_out=True), note(2, sold_out=True), note(3)],
        mentions=[(WEEK, DAY, i, f"c{i:04d}") for i in (1, 2, 3)],
    )
    assert [r.title for r in merge.merge_mentions(m, c, a).orderBy("pos").collect()] == ["A (SOLD OUT)", "B (SOLD OUT)", "C"]


def test_every_violation_is_reported(tables):
    c, a, p, m = tables(
        [candidate(1), candidate(2, day=NEXT), candidate(3), candidate(4), candidate(5), candidate(6, day=NEXT)],
        [note(1), note(2), note(4, MISC), note(5, None), note(6), note(9)],
        [pick(1), pick(2), pick(3), pick(8), pick(1, rank=None), pick(1, why=None), pick(1, category=None)],
        [(WEEK, DAY, 1, "c0001"), (WEEK, DAY, 2, "c0003"), (WEEK, DAY, 3, "c0007")],
    )
    got = sorted((r.severity, r.id, r.message) for r in merge.violations(c, a, p, m).collect())
    assert got == sorted([
        ("fail", "c0002", "pick: belongs to another day"),
        ("fail", "c0003", "pick: not in the day's annotations"),
        ("fail", "c0008", "pick: id matches no candidate"),
        ("fail", "c0001", "pick: missing required field rank"),
        ("fail", "c0001", "pick: missing required field why"),
        ("fail", "c0001", "pick: missing required field category"),
        ("fail", "c0003", "mention: not in the day's annotations"),
        ("fail", "c0007", "mention: id matches no candidate"),
        ("fail", "c0002", "annotation: belongs to another day"),
        ("fail", "c0004", "annotation: category is not one of the nine"),
        ("fail", "c0005", "annotation: missing required field category"),
        ("fail", "c0006", "annotation: belongs to another day"),
        ("warn", "c0009", "annotation: id matches no candidate"),
    ])
    with pytest.raises(RowsRejected, match="checks failed"):
        weekly.merge_selection(c, a, p, m)


def test_days_need_a_date_and_a_name(spark):
    days = spark.createDataFrame([(WEEK, DAY, "Monday"), (WEEK, None, "Tuesday"), (WEEK, NEXT, None)], "week DATE, date STRING, day_name STRING")
    assert sorted(r.message for r in merge.day_violations(days).collect()) == [
        "day: missing required field date", "day: missing required field day_name"
    ]


def test_the_last_annotation_wins(tables):
    c, a, _, _ = tables([candidate(1)], [note(1, MUSIC, pos=1), note(1, FILM, pos=2)])
    assert merge.merge_events(c, a).first().category == FILM


def test_listing_order(tables):
    rows = [(1, FILM, "7:00 PM"), (2, MUSIC, ""), (3, MUSIC, "8:00 PM"), (4, MUSIC, "7:00 PM"), (5, MUSIC, "7:00 PM"), (6, MUSIC, "12:00 AM"), (7, MUSIC, "late")]
    c, a, _, _ = tables([candidate(i, time=t) for i, _, t in rows] + [candidate(8)], [note(i, k) for i, k, _ in rows])
    got = merge.merge_events(c, a).orderBy("listing_pos").collect()
    assert [r.ord for r in got] == [6, 4, 5, 3, 2, 7, 1]
    assert [r.listing_pos for r in got] == list(range(7))


def test_numbering_against_brute_force(spark):
    rng = random.Random(3)
    rows = [(rng.choice("ab"), 0 if rng.random() < 0.4 else rng.randrange(5), i) for i in range(500)]
    df = spark.createDataFrame(rows, "g STRING, b INT, o INT")
    got = numbering.number_rows(df, ["g"], ["b"], ["o"], "n").collect()
    for group in "ab":
        ordered = sorted((b, o) for g, b, o in rows if g == group)
        assert {(r.b, r.o): r.n for r in got if r.g == group} == {k: i for i, k in enumerate(ordered)}


def test_numbering_by_ranges_against_brute_force(spark):
    rng = random.Random(4)
    rows = [(rng.choice(["a", "b", None]) if i % 3 else "a", 0 if rng.random() < 0.4 else rng.choice([None, *range(5)]), i) for i in range(700)]
    df = spark.createDataFrame(rows, "g STRING, b INT, o INT").repartition(9)
    got = numbering.number_by_range(df, ["g"], ["b", "o"], "n").collect()
    assert len(got) == 700
    for group in ("a", "b", None):
        ordered = sorted(((b is not None, b or 0, o) for g, b, o in rows if g == group))
        assert {(r.b is not None, r.b or 0, r.o): r.n for r in got if r.g == group} == {k: i for i, k in enumerate(ordered)}
    assert numbering.number_by_range(df.limit(0), ["g"], ["b", "o"], "n").collect() == []


def merged(tables, n=14, pick_id=13, mention_id=12, sold_out=False):
    c, a, p, m = tables(
        [candidate(i, time=f"{1 + i % 11}:00 PM" if i else "") for i in range(n)],
        [note(i, sold_out=sold_out) for i in range(n)],
        [pick(pick_id)],
        [(WEEK, DAY, 1, f"c{mention_id:04d}")],
    )
    return merge.listing_rows(c, a), merge.merge_picks(p, c, a), merge.merge_mentions(m, c, a)


@pytest.mark.parametrize("sold_out", [False, True])
def test_display_cap_keeps_chosen_rows_first(tables, sold_out):
    """A mention is found by id, so its sold-out suffix does not cost it its place."""
    shown = ranking.display_cap(*merged(tables, sold_out=sold_out)).orderBy("card").collect()
    assert len(shown) == 10
    assert [r.id for r in shown[:2]] == ["c0013", "c0012"]
    assert {r.true_count for r in shown} == {14}
    assert "c0000" not in {r.id for r in shown}


def test_annotation_cap_never_drops_a_chosen_row(tables):
    c, a, p, m = tables([candidate(i, "Same") for i in range(15)], [note(i) for i in range(15)], [pick(14)], [])
    rows = ranking.flag_chosen(merge.listing_rows(c, a), merge.merge_picks(p, c, a), merge.merge_mentions(m, c, a))
    assert ranking.annotation_cap(rows).count() == 15
    other = ranking.flag_chosen(*merged(tables))
    assert ranking.annotation_cap(other).count() == 10


def test_caps_cut_before_the_shuffle(tables):
    plan = ranking.display_cap(*merged(tables))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2
    assert "CartesianProduct" not in plan


def scored(spark, rows):
    schema = "day STRING, id STRING, ord INT, venue_key STRING, tier INT, easy_to_miss BOOLEAN, community BOOLEAN, overlap INT, free BOOLEAN, recurring BOOLEAN, elevated BOOLEAN"
    return spark.createDataFrame(rows, schema).withColumn("week", F.lit(WEEK))


def test_picks_follow_the_precedence(spark):
    base = dict(tier=2, easy=False, community=False, overlap=0, free=False, recurring=False, elevated=False)
    better = [
        ("tier", {"tier": 1}), ("easy", {"easy": True}), ("community", {"community": True}), ("overlap", {"overlap": 2}),
        ("free", {"free": True}), ("plain", {}), ("recurring", {"recurring": True, "elevated": True}),
    ]
    rows = []
    for i, (name, change) in enumerate(reversed(better)):
        r = {**base, **change}
        rows.append((DAY, name, i, f"v{i}", r["tier"], r["easy"], r["community"], r["overlap"], r["free"], r["recurring"], r["elevated"]))
    got = ranking.daily_picks(scored(spark, rows), mentions=4).orderBy("place").collect()
    assert [r.id for r in got] == [name for name, _ in better]
    assert [r.kind for r in got] == ["pick"] * 3 + ["mention"] * 4


def test_venue_cap_comes_before_the_daily_rank(spark):
    days = [f"2026-07-2{i}" for i in range(4)]
    rows = [(d, f"{d}-{i}", 10 * n + i, "same", 1, False, False, 0, False, False, False) for n, d in enumerate(days) for i in range(3)]
    got = ranking.daily_picks(scored(spark, rows)).collect()
    assert [(r.day, r.place) for r in got] == [(days[0], 1), (days[0], 2)]


def test_rows_without_a_venue_share_no_cap(spark):
    days = [f"2026-07-2{i}" for i in range(3)]
    rows = [(d, f"{d}-{i}", i, ("", None, " ")[i % 3], 1, False, False, 0, False, False, False) for d in days for i in range(4)]
    assert ranking.daily_picks(scored(spark, rows)).count() == 12


def test_phrases_of_the_interests(spark):
    docs = spark.createDataFrame([(1, "A Post-Punk R&B night"), (2, "functional programming"), (3, "one"), (4, ""), (5, None)], "id INT, body STRING")
    got = docs.select("id", ranking.terms_of(F.col("body"), 3).alias("t")).orderBy("id").collect()
    assert sorted(got[0].t)[:4] == ["a", "a post", "a post punk", "b"] and "r b night" in got[0].t
    assert [list(r.t) for r in got[1:]] == [["functional", "programming", "functional programming"], ["one"], [], []]
    tags = ranking.interest_tags(docs, ranking.interest_lexicon(spark), "id", "body", fixed.PHRASE_WORDS)
    assert {r.id: list(r.interests) for r in tags.collect()} == {1: ["punk and hardcore", "soul and jazz"], 2: ["software"]}
    assert ranking.category_lexicon(spark).select("category").distinct().count() == 9


def test_interest_tags_and_category_vote(spark):
    docs = spark.createDataFrame([(1, "Punk film, film noir!"), (2, "nothing here"), (3, "Jazz & COFFEE"), (4, None)], "id INT, body STRING")
    tags = ranking.interest_tags(docs, ranking.interest_lexicon(spark), "id", "body")
    assert {r.id: (r.interests, r.overlap) for r in tags.collect()} == {
        1: (["film", "punk and hardcore"], 2), 3: (["coffee", "soul and jazz"], 2)
    }
    lexicon = spark.createDataFrame([("film", FILM), ("punk", MUSIC), ("jazz", MUSIC), ("coffee", FILM)], "term STRING, category STRING")
    votes = ranking.category_vote(docs, lexicon, "id", "body")
    assert {r.id: (r.category, r.votes) for r in votes.collect()} == {1: (FILM, 2), 3: (MUSIC, 1)}


PICKED = "week DATE, day STRING, rank INT, title STRING, venue STRING, address STRING, time STRING, cost STRING, url STRING, category STRING, source STRING, is_music BOOLEAN, sold_out BOOLEAN, why STRING"


def picked(spark, *rows):
    base = dict(day=DAY, rank=1, title="T", venue="Hall, up", address=None, time="7:00 PM", cost="$5", url="u", category=MUSIC, source="s", is_music=False, sold_out=False, why="why")
    return spark.createDataFrame([(WEEK, *{**base, **r}.values()) for r in rows], PICKED)


def messages(df):
    return sorted((r.check, r.entity, r.message) for r in df.collect())


def test_venue_cap_check_at_and_over_the_limit(spark):
    two = [dict(title="a"), dict(title="b", venue="HALL , down")]
    assert messages(quality.venue_cap(picked(spark, *two))) == []
    three = [*two, dict(title="c", day=NEXT)]
    assert messages(quality.venue_cap(picked(spark, *three))) == [("venue_cap", "hall", "took 3 pick slots this week (cap 2)")]
    spread = [dict(title=t, address=f"{t} St") for t in "abc"]
    assert messages(quality.venue_cap(picked(spark, *spread))) == []


def test_time_checks_stay_apart(spark):
    times = ["7:00 PM", "99:99 PM", "7:5 PM", "7:00", "7:00 PM, 9:00 PM", "*(confirm)*", "", "5:59 AM", "6:00 AM", "12:00 AM"]
    rows = picked(spark, *[dict(title=t, time=t) for t in times])
    assert {r.entity for r in quality.time_format(rows).collect()} == {"7:5 PM", "7:00", "7:00 PM, 9:00 PM", "*(confirm)*", ""}
    assert {r.entity for r in quality.implausible_time(rows).collect()} == {"5:59 AM", "12:00 AM"}


def test_blank_costs(spark):
    rows = picked(spark, dict(title="a", cost=" "), dict(title="b", cost=None), dict(title="c"))
    assert len(messages(quality.cost_blank(rows, rows))) == 4


def test_same_series(spark):
    rows = picked(spark, dict(title="Club: A"), dict(title="club: B", day=NEXT), dict(title="Club: C", venue="Bar"), dict(title="Plain"), dict(title="Plain"))
    assert messages(quality.same_series(rows)) == [("same_series", "hall", "2 picks share the title prefix club")]


def test_star_resolves_and_near_titles(spark):
    picks = picked(spark, dict(title="A"), dict(title="B"))
    listing = picked(spark, dict(title="A"), dict(title="B", day=NEXT), dict(title="EF: A"), dict(title="C"))
    assert [r.entity for r in quality.star_resolves(picks, listing).collect()] == ["B"]
    assert [r.message for r in quality.near_titles(listing).collect()] == ["2 titles differ only by a prefix: a"]


def test_implausible_claims(spark):
    rows = spark.createDataFrame(
        [("Halloween Ball", "2026-10-30", "$5"), ("Halloween Ball", "2026-07-20", "$5"), ("Fair", "2026-07-20", "$15M"), ("Fair", "2026-07-20", "$15 members")],
        "title STRING, date STRING, cost STRING",
    ).withColumn("week", F.lit(WEEK))
    assert sorted(r.message for r in quality.implausible_claims(rows).collect()) == ["cost looks like a budget", "halloween in another month"]


def test_calendar_rows(spark):
    rows = picked(
        spark,
        dict(title="film", category=FILM, time="11:30 PM", address="1 St"),
        dict(title="fest", category=fixed.CATEGORIES[8][0], cost="*(confirm)*", url=""),
        dict(title="wrapped", time="*(8:00 PM)*"),
        dict(title="bad", time="7:00"),
        dict(title="none", time="*(confirm details)*"),
    )
    got = {r.summary: (r.start, r.end, r.description, r.location) for r in report.calendar_rows(rows).collect()}
    assert got == {
        "film": ("2026-07-20T23:30:00-04:00", "2026-07-21T01:30:00-04:00", "why\n\nCost: $5\n\nu", "1 St"),
        "fest": ("2026-07-20T19:00:00-04:00", "2026-07-21T01:00:00-04:00", "why", None),
        "wrapped": ("2026-07-20T20:00:00-04:00", "2026-07-20T23:00:00-04:00", "why\n\nCost: $5\n\nu", None),
    }
    assert report.calendar_counts(rows).first().asDict() == {"week": WEEK, "created": 3, "skipped": 2}


def test_pick_cards(spark):
    lookup = spark.createDataFrame([("A w/ B & C", "l", "B"), ("Other", None, None)], "title STRING, spotify_url STRING, matched_text STRING")
    rows = picked(
        spark, dict(rank=1, title="A w/ B & C", is_music=True), dict(rank=2, title="A w/ B & C", time="", cost="*(ask)*"),
        dict(rank=3, title="Other", is_music=True, time="*(confirm showtimes)*", cost=""),
    )
    got = [(r.link_before, r.link_text, r.link_after, r.link_url, r.time_cost) for r in report.pick_cards(rows, lookup).orderBy("rank").collect()]
    assert got == [
        ("A w/ ", "B", " &amp; C", "l", "7:00 PM · $5"),
        ("", "A w/ B &amp; C", "", "u", "Various · ask"),
        ("", "Other", "", "u", "Various"),
    ]


def test_display_time_and_price(spark):
    rows = spark.createDataFrame(
        [("7:00 PM", "Multiple Showtimes today"), ("", "multiple showtimes"), ("*(x)*", ""), ("7:00 PM", None)], "t STRING, n STRING"
    )
    assert [r.d for r in rows.select(report.display_time(F.col("t"), F.col("n")).alias("d")).collect()] == ["7:00 PM+", "Various", "Various", "7:00 PM"]


def test_mention_line(spark):
    rows = spark.createDataFrame(
        [(WEEK, DAY, 2, "B & C", "Bar"), (WEEK, DAY, 1, "A (SOLD OUT)", "Hall")], "week DATE, day STRING, pos INT, title STRING, venue STRING"
    )
    assert report.mention_line(rows).first().line == "A (<strong>SOLD OUT</strong>) at Hall · B &amp; C at Bar"


def test_day_pages_hold_the_whole_listing(tables, monkeypatch):
    monkeypatch.setattr(report, "PAGE_ROWS", 4)
    c, a, p, m = tables([candidate(i) for i in range(10)], [note(i) for i in range(10)], [pick(1), pick(2, rank=2)], [(WEEK, DAY, 1, "c0003")])
    chosen = weekly.merge_selection(c, a, p, m)
    pages = report.day_pages(chosen.picks, chosen.mentions, chosen.listing).orderBy("page").collect()
    assert [len(r.events) for r in pages] == [4, 4, 2]
    assert [e.title for r in pages for e in r.events] == [f"T{i}" for i in range(10)]
    assert [t.title for t in pages[0].top3] == ["T1", "T2"] and pages[1].top3 is None
    assert pages[0].day_name == "Monday"


def test_report_weeks_are_replaced_not_appended(tables, tmp_path, spark):
    c, a, p, m = tables([candidate(i) for i in range(3)], [note(i) for i in range(3)], [pick(1)], [(WEEK, DAY, 1, "c0002")])
    lookup = spark.createDataFrame([], "title STRING, spotify_url STRING, matched_text STRING")
    chosen = weekly.merge_selection(c, a, p, m)
    for _ in range(2):
        weekly.write_report(chosen, lookup, str(tmp_path))
    assert spark.read.parquet(f"{tmp_path}/category_cards").count() == 3
    assert spark.read.parquet(f"{tmp_path}/pages").count() == 1


def test_salts_do_not_change_a_lookup_with_a_hot_key(spark):
    from marquee.operators.lookup import SALTS_SETTING, salted_lookup, salts_for

    left = spark.range(2000).select(F.when(F.col("id") % 10 < 9, "hot").otherwise(F.concat(F.lit("k"), F.col("id") % 7)).alias("key"), "id")
    right = spark.createDataFrame([("hot", 1), ("k3", 2), ("k4", 3), ("none", 4)], "key STRING, value INT")
    one, many = (sorted(salted_lookup(left, right, ["key"], ["id"], salts=n).collect(), key=str) for n in (1, 64))
    assert one == many and len(one) == 2000
    assert (salts_for(left, ["key"]), salts_for(left, ["key"], 100), salts_for(left.limit(0), ["key"])) == (1, 18, 1)
    spark.conf.set(SALTS_SETTING, "3")
    try:
        assert sorted(salted_lookup(left, right, ["key"], ["id"]).collect(), key=str) == one
    finally:
        spark.conf.unset(SALTS_SETTING)


def test_violations_of_odd_rows(spark):
    candidates = spark.createDataFrame(
        [(WEEK, "a", DAY), (WEEK, "b", DAY), (WEEK, "c", "2026-07-21"), (WEEK, "n", None)], "week DATE, id STRING, date STRING"
    )
    notes = spark.createDataFrame(
        [(WEEK, DAY, "a", 0, None, False, None), (WEEK, DAY, "a", 1, MUSIC, False, None), (WEEK, DAY, "c", 0, MUSIC, False, None),
         (WEEK, DAY, "x", 0, MUSIC, False, None), (WEEK, DAY, None, 0, "odd", False, None), (WEEK, DAY, "n", 0, MUSIC, False, None)],
        "week DATE, day STRING, id STRING, pos LONG, category STRING, sold_out BOOLEAN, note STRING",
    )
    picks = spark.createDataFrame(
        [(WEEK, DAY, "a", 1, "w", MUSIC), (WEEK, DAY, "a", 1, None, MUSIC), (WEEK, DAY, "b", 1, "w", MUSIC), (WEEK, DAY, "x", 1, "w", MUSIC),
         (WEEK, DAY, None, 1, "w", MUSIC), (WEEK, DAY, None, 1, "w", MUSIC), (WEEK, None, "n", 1, "w", MUSIC)],
        "week DATE, day STRING, id STRING, rank INT, why STRING, category STRING",
    )
    mentions = spark.createDataFrame([(WEEK, DAY, "c"), (WEEK, "2026-07-21", "c")], "week DATE, day STRING, id STRING")
    found = merge.violations(candidates, notes, picks, mentions)
    assert sorted((str(r.id), r.severity, r.message) for r in found.collect()) == sorted([
        ("a", "fail", "pick: missing required field why"),
        ("b", "fail", "pick: not in the day's annotations"),
        ("x", "fail", "pick: id matches no candidate"),
        ("None", "fail", "pick: id matches no candidate"),
        ("None", "fail", "pick: id matches no candidate"),
        ("n", "fail", "pick: not in the day's annotations"),
        ("c", "fail", "mention: belongs to another day"),
        ("c", "fail", "mention: not in the day's annotations"),
        ("c", "fail", "annotation: belongs to another day"),
        ("x", "warn", "annotation: id matches no candidate"),
        ("n", "warn", "annotation: id matches no candidate"),
        ("None", "fail", "annotation: category is not one of the nine"),
    ])
    plan = found._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert plan.count("Exchange hashpartitioning") <= 1


def test_verdicts_hold_every_week_and_suite(spark):
    rows = [("venue_cap", "warn", "w1"), ("merge", "fail", "w1"), ("merge", "fail", "w1"), ("yield_floor", "fail", "w2")]
    found = spark.createDataFrame(rows, "check STRING, severity STRING, week STRING")
    weeks = spark.createDataFrame([("w1",), ("w2",), ("w3",), ("w3",)], "week STRING")
    got = {(r.week, r.suite): (r.n_fail, r.n_warn, r.passed) for r in quality.verdicts(found, weeks).collect()}
    assert len(got) == 9 and got["w1", "merge"] == (2, 0, False) and got["w1", "selection"] == (0, 1, True)
    assert got["w2", "collection"] == (1, 0, False) and all(got["w3", s] == (0, 0, True) for s in quality.SUITES)


def test_large_lexicons_are_joined(spark):
    docs = spark.createDataFrame([(1, "Punk film, film noir!"), (2, "nothing here"), (3, "Jazz & COFFEE"), (4, None), (5, "post punk post-punk")], "id INT, body STRING")
    lexicon = ranking.interest_lexicon(spark)
    for made in (ranking.interest_tags, ranking.interest_tiers):
        rows = [sorted(map(tuple, made(docs, lexicon, "id", "body", fixed.PHRASE_WORDS, most).collect())) for most in (0, 10_000)]
        assert rows[0] == rows[1] and len(rows[0]) == 3
    terms = spark.createDataFrame([("film", FILM), ("punk", MUSIC), ("jazz", MUSIC), ("coffee", FILM), ("film", FILM)], "term STRING, category STRING")
    rows = [sorted(map(tuple, ranking.category_vote(docs, terms, "id", "body", most).collect())) for most in (0, 10_000)]
    assert rows[0] == rows[1]


def test_terms_of_a_lexicon_are_joined_not_searched(spark):
    docs = spark.createDataFrame([(1, "W7 w8, w7x"), (2, "none"), (3, "w11 é"), (4, None), (5, "w4999-w1")], "id INT, body STRING")
    lexicon = spark.createDataFrame([(f"w{i}", f"i{i % 14}", i % 3) for i in range(5000)], "term STRING, interest STRING, tier INT")
    tags, tiers = (made(docs, lexicon, "id", "body", fixed.PHRASE_WORDS) for made in (ranking.interest_tags, ranking.interest_tiers))
    assert {r.id: (r.interests, r.overlap) for r in tags.collect()} == {1: (["i7", "i8"], 2), 3: (["i11"], 1), 5: (["i1"], 1)}
    assert {r.id: (r.tier, r.overlap) for r in tiers.collect()} == {1: (1, 2), 3: (2, 1), 5: (1, 1)}
    for found in (tags, tiers):  # a pattern of many terms costs a text far more than its words
        assert "RLIKE" not in found._jdf.queryExecution().optimizedPlan().toString().upper()


def test_category_model(spark):
    import math
    from hashlib import md5

    from marquee.operators import category_model

    rows = [("jazz band plays jazz", MUSIC), ("a film", FILM), ("film and film talk", FILM), (None, FILM), ("band", MUSIC), ("!", None), ("ignored", None)]
    frame = spark.createDataFrame(rows, "body STRING, category STRING")
    model = category_model.fit(frame, "body", "category")
    names = model.first().names
    assert names == sorted([MUSIC, FILM])

    def bucket(word):
        return int(md5(word.encode()).hexdigest()[:8], 16) % category_model.BUCKETS

    def score(text, name):
        others = [bucket(w) for t, c in rows if t and c and c != name for w in t.split()]
        return sum(-math.log((others.count(bucket(w)) + 1) / (len(others) + category_model.BUCKETS)) for w in text.split())

    given = ["jazz film band", "film talk", "unseen words", ""]
    asked = spark.createDataFrame([(t,) for t in [*given, None]], "text STRING")
    got = {r.text: (r.category, round(r.score, 9)) for r in category_model.predict(asked, model, "text").collect()}
    for text in given:
        best = max(names, key=lambda n: (score(text, n), -names.index(n)))
        assert got[text] == (best, round(score(text, best), 9))
    assert got[None] == (names[0], 0.0) and len(got) == 5
    nothing = category_model.fit(frame.limit(0), "body", "category")
    assert [(r.category, r.score) for r in category_model.predict(asked.limit(1), nothing, "text").collect()] == [(None, None)]


def test_category_model_on_held_out_listings(spark):
    from pathlib import Path

    from marquee.bindings.queries import QUERIES
    from marquee.bindings.views import Tables

    folder = "/root/testdata/sf0.01"
    if not Path(folder).exists():
        pytest.skip("driver tables are not here")
    rows = QUERIES["category_model"](Tables(spark, folder)).collect()
    right = sum(r.known == r.category for r in rows) / len(rows)
    print(f"held-out accuracy {right:.3f} of {len(rows)}")
    assert right > 0.9


def test_sketches_of_weeks_merge(spark):
    from marquee.operators import sketches

    rng = random.Random(9)
    rows = [(rng.choice(["w1", "w2", "w3"]), f"T{rng.randrange(900)}", rng.choice(["Hall", None]), f"${rng.randrange(1, 400)}") for _ in range(6000)]
    rows += [("w4", "T1", "Hall", "Free"), ("w4", None, None, None)]
    frame = spark.createDataFrame(rows, "week STRING, title STRING, venue STRING, cost STRING").repartition(5)
    stored = sketches.week_sketches(frame)
    weeks = {r.week: r for r in sketches.readings(stored).collect()}
    assert len(weeks) == 4 and weeks["w4"].n_distinct == 2 and weeks["w4"].price_quantiles is None
    (whole,) = sketches.readings(sketches.merged(stored)).collect()
    distinct = len({(t, v) for _, t, v, _ in rows})
    assert whole.n == len(rows) and abs(whole.n_distinct - distinct) <= sketches.DISTINCT_ERROR * distinct
    prices = sorted(int(c[1:]) for *_, c in rows if c and c != "Free")
    for q, got in zip((0.1, 0.5, 0.9), whole.price_quantiles, strict=True):
        low, high = sum(p < got for p in prices) / len(prices), sum(p <= got for p in prices) / len(prices)
        assert low - sketches.RANK_ERROR <= q <= high + sketches.RANK_ERROR
    assert sketches.readings(sketches.merged(stored.limit(0), "week")).collect() == []


def test_near_titles_within_two_edits(spark):
    names = ["jazz night", "jazz nights", "jaz nigth", "Jazz Night ", "open mic", "open mike", "x", "y", "xy", "", None, "jazz nite"]
    rows = [(1, v, n) for n in names for v in ("a", None)] + [(2, "a", "jazz nigt")]
    frame = spark.createDataFrame(rows, "week INT, venue STRING, title STRING")

    def distance(a, b):
        row = list(range(len(b) + 1))
        for i, x in enumerate(a, 1):
            row, before = [i], row
            for j, y in enumerate(b, 1):
                row.append(min(before[j] + 1, row[-1] + 1, before[j - 1] + (x != y)))
        return row[-1]

    known = {(w, v, n.strip().lower()) for w, v, n in rows if n and n.strip()}
    for edits in (1, 2):
        got = sorted(map(tuple, quality.near_edits(frame, edits).collect()), key=repr)
        assert got == sorted(
            [(w, v, a, b, distance(a, b)) for w, v, a in known for x, y, b in known if (w, v) == (x, y) and a < b and distance(a, b) <= edits], key=repr
        )


def test_stamps_in_one_of_several_runs(spark):
    runs = [("w", "2026-07-20T10:00:00Z", "2026-07-20T11:00:00Z"), ("w", "2026-07-22T00:00:00Z", "2026-07-24T00:00:00Z"), ("v", "2026-07-20T00:00:00Z", "2026-07-27T00:00:00Z")]
    stamps = ["2026-07-20T10:00:00Z", "2026-07-20T11:00:01Z", "2026-07-23T12:00:00Z", "2026-07-24T00:00:00Z", "2026-07-24T00:00:01Z", "soon", None]
    files = spark.createDataFrame([("w", f"s{k}", s) for k, s in enumerate(stamps)], "week STRING, source STRING, collected_at STRING")
    found = quality.outside_runs(files, spark.createDataFrame(runs, "week STRING, run_started STRING, run_completed STRING"))
    assert {r.entity for r in found.collect()} == {"s1", "s4", "s5", "s6"}
