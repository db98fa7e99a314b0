"""Collapse, series folding, numbering; every rule on hand-made rows and against brute force."""

import random
from datetime import date

from pyspark.sql import functions as F

from marquee import fixed
from marquee.operators.collapse import assign_ids, collapse_duplicates, fold_series
from marquee.plans.candidates import build_candidates, shown

SCHEMA = (
    "week DATE, stem STRING, pos BIGINT, source STRING, title STRING, venue STRING, date STRING, "
    "time STRING, cost STRING, url STRING, description STRING"
)
WEEK = date(2026, 7, 20)


def row(stem, pos, title="Show", venue="Hall", day="2026-07-20", source=None, time="", cost="", url="", description=""):
    return (WEEK, stem, pos, source or stem, title, venue, day, time, cost, url, description)


def frame(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def test_priority_then_completeness_then_arrival(spark):
    rows = [
        row("a", 0, "P", source="Do215", time="7:00 PM", cost="$5", url="u"),
        row("b", 0, "P", source="R5 Productions"),
        row("a", 1, "C", source="x", cost="$5"),
        row("b", 1, "C", source="y", cost="$5", url="u"),
        row("a", 2, "T", source="x"),
        row("b", 2, "T", source="y"),
    ]
    got = {r.title: (r.source, r.stem, r.pos) for r in collapse_duplicates(frame(spark, rows)).collect()}
    assert got == {"P": ("R5 Productions", "a", 0), "C": ("y", "a", 1), "T": ("x", "a", 2)}


def test_matching_is_exact(spark):
    rows = [row("a", 0, "Show"), row("a", 1, "show"), row("a", 2, "Show "), row("a", 3, "Show", day="2026-07-21")]
    assert collapse_duplicates(frame(spark, rows)).count() == 4


def test_missing_fields_group_with_empty_ones(spark):
    rows = [row("a", 0, None), row("b", 0, "")]
    assert collapse_duplicates(frame(spark, rows)).count() == 1


def test_sold_out_note_only_when_the_kept_row_is_silent(spark):
    rows = [
        row("a", 0, "A", source="Do215", description="fine"),
        row("b", 0, "A", description="This is SOLD OUT now"),
        row("a", 1, "B", source="Do215", description="sold out"),
        row("b", 1, "B", description="sold out"),
        row("a", 2, "C", description="sold out"),
        row("a", 3, "D", source="Do215", description=None),
        row("b", 3, "D", description="x" * 5000 + " sold out"),
    ]
    got = {r.title: r.description for r in collapse_duplicates(frame(spark, rows)).collect()}
    assert got["A"] == fixed.SOLD_OUT_NOTE + "fine"
    assert got["B"] == got["C"] == "sold out"
    assert got["D"] == fixed.SOLD_OUT_NOTE.strip()


def expected_description(kept, noted, limit=fixed.DESCRIPTION_CHARS):
    whole = (fixed.SOLD_OUT_NOTE + kept).strip() if noted else kept
    return whole if len(whole) <= limit else whole[:limit].rstrip() + "…"


def test_cap_comes_after_the_note(spark):
    bodies = ["a" * 600, "a" * 601, "a" * 536, "a" * 540, "a" * 500 + " " * 200, "a" * 500 + " " * 200 + "b", "a" * 560 + " " * 45 + "b"]
    rows = []
    for i, body in enumerate(bodies):
        rows += [row("a", i, f"plain {i}", description=body)]
        rows += [row("a", 100 + i, f"noted {i}", source="Do215", description=body), row("b", i, f"noted {i}", description="sold out")]
    whole = collapse_duplicates(frame(spark, rows))
    got = {r.title: r.description for r in shown(whole).collect()}
    for i, body in enumerate(bodies):
        assert got[f"plain {i}"] == expected_description(body, False), i
        assert got[f"noted {i}"] == expected_description(body, True), i


def test_descriptions_stay_whole_until_the_cap(spark):
    long = "word " * 1000
    rows = [row("a", 0, "A", description=long), row("a", 1, "B", source="Do215", description=long), row("b", 1, "B", description="sold out")]
    whole = collapse_duplicates(frame(spark, rows))
    assert {r.title: r.description for r in whole.collect()} == {"A": long, "B": fixed.SOLD_OUT_NOTE + long.rstrip()}
    assert {r.title: len(r.description) for r in build_candidates(frame(spark, rows)).collect()} == {"A": 600, "B": 600}


def test_the_listed_day_of_an_early_start_is_kept(spark):
    rows = frame(spark, [row("a", 0, "Early", day="2026-07-18"), row("b", 0, "Early", day="2026-07-18"), row("a", 1, "Plain")])
    early = F.when((F.col("title") == "Early") & (F.col("stem") == "b"), "2026-07-20")
    got = build_candidates(rows.withColumn("listed_date", early)).collect()
    assert sorted((r.title, r.date, r.listed_date) for r in got) == [
        ("Early", "2026-07-18", "2026-07-20"), ("Plain", "2026-07-20", "2026-07-20")
    ]


def test_two_dates_pass_three_dates_fold(spark):
    days = ["2026-07-22", "2026-07-20", "2026-07-24"]
    rows = [row("a", i, "Three", day=d) for i, d in enumerate(days)]
    rows += [row("a", 10 + i, "Two", day=d) for i, d in enumerate(days[:2])]
    rows += [row("a", 20, "Rows", day=days[0]), row("a", 21, "Rows", day=days[0]), row("b", 22, "Rows", day=days[1])]
    folded = fold_series(collapse_duplicates(frame(spark, rows))).collect()
    three = [r for r in folded if r.title == "Three"]
    assert [(r.date, r.occurrences, r.recurrence_count) for r in three] == [("2026-07-20", sorted(days), 3)]
    assert sorted(r.date for r in folded if r.title == "Two") == sorted(days[:2])
    assert [r.recurrence_count for r in folded if r.title == "Rows"] == [None, None]


def test_an_empty_date_counts_and_is_the_earliest(spark):
    rows = [row("a", i, day=d) for i, d in enumerate(["2026-07-21", "", "2026-07-22"])]
    (only,) = fold_series(collapse_duplicates(frame(spark, rows))).collect()
    assert (only.date, only.recurrence_count) == ("", 3)


def test_sold_out_note_rides_on_the_series_row(spark):
    rows = [row("a", i, source="Do215", day=f"2026-07-2{i}") for i in range(3)]
    rows.append(row("b", 0, day="2026-07-20", description="sold out"))
    (only,) = build_candidates(frame(spark, rows)).collect()
    assert only.description == fixed.SOLD_OUT_NOTE.strip()
    assert only.recurrence_count == 3


def test_short_series_stay_together_at_their_first_position(spark):
    rows = [
        row("a", 0, "X", day="2026-07-20"),
        row("a", 1, "Y", day="2026-07-20"),
        row("a", 2, "X", day="2026-07-21"),
    ]
    got = build_candidates(frame(spark, rows)).orderBy("ord").collect()
    assert [(r.id, r.title, r.date) for r in got] == [
        ("c0000", "X", "2026-07-20"), ("c0001", "X", "2026-07-21"), ("c0002", "Y", "2026-07-20")
    ]


def brute(rows, priority):
    """The whole preparation with plain Python lists."""
    rows = sorted(rows, key=lambda r: (r[1], r[2]))
    groups = {}
    for r in rows:
        groups.setdefault((r[4], r[5], r[6]), []).append(r)

    def rank(r):
        place = priority.index(r[3]) if r[3] in priority else len(priority)
        return place, -sum(1 for v in r[7:11] if v)

    collapsed = []
    for copies in groups.values():
        best = min(copies, key=rank)
        noted = any("sold out" in c[10].lower() for c in copies) and "sold out" not in best[10].lower()
        collapsed.append((best, expected_description(best[10], noted)))
    series = {}
    for best, body in collapsed:
        series.setdefault((best[4], best[5]), []).append((best, body))
    out = []
    for members in series.values():
        dates = sorted({m[0][6] for m in members})
        if len(dates) < 3:
            out += [(m[0], m[1], None) for m in members]
        else:
            first = min(members, key=lambda m: m[0][6])
            out.append((first[0], first[1], dates))
    return [(f"c{i:04d}", r[4], r[5], r[6], r[3], body, dates) for i, (r, body, dates) in enumerate(out)]


def test_whole_preparation_against_brute_force(spark):
    rng = random.Random(5)
    priority = ["s3", "s1"]
    rows = []
    for stem in ("s0", "s1", "s2", "s3"):
        for pos in range(150):
            rows.append(row(
                stem, pos, f"T{rng.randrange(12)}", f"V{rng.randrange(4)}", f"2026-07-2{rng.randrange(7)}",
                time=rng.choice(["", "7:00 PM"]), cost=rng.choice(["", "$5"]), url=rng.choice(["", "u"]),
                description=rng.choice(["", "x", "y" * 650, "Sold Out!", "z" * 590]),
            ))
    # One title holds a third of all rows.
    rows += [row("s2", 1000 + i, "Hot", "V0", f"2026-07-2{i % 2}", description="sold out" if i == 299 else "") for i in range(300)]
    got = build_candidates(frame(spark, rows), priority).orderBy("ord").collect()
    assert [
        (r.id, r.title, r.venue, r.date, r.source, r.description, r.occurrences) for r in got
    ] == brute(rows, priority)


def test_every_raw_row_is_kept_or_has_a_kept_twin(spark):
    rows = [row("a", i, f"T{i % 3}", day=f"2026-07-2{i % 4}") for i in range(40)]
    raw = frame(spark, rows)
    collapsed = collapse_duplicates(raw)
    assert raw.join(collapsed, ["title", "venue", "date"], "left_anti").count() == 0
    again = collapse_duplicates(collapsed.withColumn("source", F.col("source")))
    assert sorted(again.drop("sold_out_noted").collect()) == sorted(collapsed.drop("sold_out_noted").collect())


def test_ids_beyond_four_digits_and_per_week(spark):
    rows = spark.range(10_003).select(
        F.lit(WEEK).alias("week"), F.lit("s").alias("stem"), F.col("id").alias("pos"),
        F.lit("s").alias("series_stem"), F.col("id").alias("series_pos"),
    )
    other = rows.limit(3).withColumn("week", F.date_add("week", 7))
    ids = assign_ids(rows.unionByName(other))
    assert ids.where("ord = 10002").first().id == "c10002"
    assert ids.select("week", "id").distinct().count() == 10_006
    assert sorted(r.id for r in ids.where(F.col("week") > WEEK).collect()) == ["c0000", "c0001", "c0002"]
