"""Column functions on edge values."""

import html
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from marquee import fixed
from marquee.functions import category, clock, markup, money, text

T = F.col("t")


def test_clock_minutes(value):
    given = ["7:05 PM", "7:5 PM", "12:00 AM", "12:30 pm", "07:05  AM", "7:00", "7:00 PM, 9:00 PM", "13:00 PM", "99:99 PM", "", None]
    assert value(clock.clock_minutes(T), given) == [1145, 1145, 0, 750, 425, None, None, None, None, None, None]


def test_minutes_clock(spark):
    rows = spark.createDataFrame([(0,), (425,), (720,), (1145,), (1439,)], "m INT")
    shown = [r.c for r in rows.select(clock.minutes_clock(F.col("m")).alias("c")).collect()]
    assert shown == ["12:00 AM", "7:05 AM", "12:00 PM", "7:05 PM", "11:59 PM"]


@pytest.mark.parametrize(
    ("today", "monday"), [("2026-07-19", "2026-07-20"), ("2026-07-20", "2026-07-27"), ("2026-12-30", "2027-01-04")]
)
def test_target_monday_is_strictly_after(spark, today, monday):
    day = spark.range(1).select(clock.target_monday(F.lit(today).cast("date")).alias("d")).first().d
    assert day == date.fromisoformat(monday)


@pytest.mark.parametrize(
    ("month", "day", "start", "expected"),
    [
        (1, 3, "2026-12-28", date(2027, 1, 3)),
        (12, 30, "2027-01-04", date(2026, 12, 30)),
        (2, 29, "2026-03-02", None),
        (2, 29, "2025-03-03", date(2024, 2, 29)),
        (7, 22, "2026-07-20", date(2026, 7, 22)),
        (13, 1, "2026-07-20", None),
    ],
)
def test_nearest_date(spark, month, day, start, expected):
    row = spark.range(1).select(
        clock.nearest_date(F.lit(month), F.lit(day), F.lit(start).cast("date")).alias("d")
    ).first()
    assert row.d == expected


def test_nearest_date_against_brute_force(spark):
    days = [(m, d, date(2027, 12, 27) - timedelta(days=49 * k)) for m in (1, 2, 6, 12) for d in (1, 15, 28, 29, 31) for k in range(8)]

    def brute(m, d, start):
        options = []
        for year in (start.year - 1, start.year, start.year + 1):
            try:
                options.append(date(year, m, d))
            except ValueError:
                continue
        return min(options, key=lambda o: (abs((o - start).days), o.year)) if options else None

    df = spark.createDataFrame(days, "m INT, d INT, s DATE")
    got = df.select("m", "d", "s", clock.nearest_date(F.col("m"), F.col("d"), F.col("s")).alias("n")).collect()
    assert all(r.n == brute(r.m, r.d, r.s) for r in got)


def test_month_number(value):
    assert value(clock.month_number(T), ["July", "sept", " Dec ", "Juneau", "xyz", ""]) == [7, 9, 12, 6, None, None]


def test_range_label(spark):
    def label(a, b):
        return spark.range(1).select(
            clock.range_label(F.lit(a).cast("date"), F.lit(b).cast("date")).alias("l")
        ).first().l

    assert label("2026-07-20", "2026-07-26") == "July 20–26, 2026"
    assert label("2026-07-27", "2026-08-02") == "July 27 – August 2, 2026"


def test_end_of_event_is_wall_clock_across_the_clock_change(spark):
    start = clock.wall_start(F.lit("2026-11-01"), F.lit("12:30 AM"))
    end = start + F.make_dt_interval(mins=F.lit(180))
    row = spark.range(1).select(clock.iso_offset(start).alias("s"), clock.iso_offset(end).alias("e")).first()
    assert (row.s, row.e) == ("2026-11-01T00:30:00-04:00", "2026-11-01T03:30:00-05:00")


def test_instant_reads_naive_text_as_utc(spark, value):
    at = clock.instant(T).cast("double")
    given = ["2026-07-20T10:00:00", "2026-07-20T10:00:00Z", "2026-07-20T06:00:00-04:00", "no time"]
    expected = datetime.fromisoformat("2026-07-20T10:00:00+00:00").timestamp()
    assert value(at, given) == [expected, expected, expected, None]


def test_instant_does_not_depend_on_the_session_zone(spark, value):
    spark.conf.set("spark.sql.session.timeZone", "Asia/Tokyo")
    try:
        expected = datetime.fromisoformat("2026-07-20T10:00:00+00:00").timestamp()
        assert value(clock.instant(T).cast("double"), ["2026-07-20T10:00:00"]) == [expected]
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_price_tier(spark):
    given = [
        ("$14.99", "low"), ("$15", "paid"), ("$1,000", "low"), ("No cover", "free"), ("FREE", "free"), ("", ""),
        (None, ""), ("*(confirm details)*", ""), ("Pay what you wish", "free"), ("$10-$20", "low"), ("  free ", "free"),
    ]
    df = spark.createDataFrame([(c,) for c, _ in given], "c STRING")
    got = [r.v for r in df.select(money.price_tier(F.col("c"), F.lit(False)).alias("v")).collect()]
    assert got == [e for _, e in given]
    sold = df.select(money.price_tier(F.col("c"), F.lit(True)).alias("v")).distinct().collect()
    assert [r.v for r in sold] == ["paid"]


def test_placeholder(value):
    given = ["*(confirm details)*", " *( x )* ", "plain", "*(open", "", None, "*()*"]
    assert value(text.is_placeholder(T), given) == [True, True, False, False, False, False, True]
    assert value(text.unwrap_placeholder(T), given) == ["confirm details", "x", "plain", "*(open", "", "", ""]


def test_cap_at_the_limit(value):
    given = ["a" * 600, "a" * 601, "a" * 590 + " " * 20 + "b", None, ""]
    assert value(text.cap(T), given) == ["a" * 600, "a" * 600 + "…", "a" * 590 + "…", None, ""]


def test_truncate_body(value):
    assert value(text.truncate_body(T, 3), ["abc", "abcd"]) == ["abc", "abc\n\n[... truncated at 3 chars ...]"]


def test_series_prefix_takes_the_first_separator_in_list_order(value):
    given = ["Film Club: A - B", "Jazz - Night", "A—B", "plain", ": no prefix", ": x - y", "a — b - c"]
    assert value(text.series_prefix(T), given) == ["film club", "jazz", "a", None, None, ": x", "a — b"]


def test_headliner_names(value):
    given = [
        "Late ball: The Lamps, Ivo Reed & MC Tern",
        "GREY OATS, NORTH PIER: A Winter Show",
        "A w/ B",
        "Solo",
        "X AND Y",
    ]
    assert value(text.headliner_names(T), given) == [
        ["Late ball: The Lamps, Ivo Reed & MC Tern", "Late ball", "The Lamps"],
        ["GREY OATS, NORTH PIER: A Winter Show", "GREY OATS", "A Winter Show"],
        ["A w/ B", "A"],
        ["Solo"],
        ["X AND Y", "X"],
    ]


def test_venue_key(spark):
    df = spark.createDataFrame(
        [(" 12 Main St ", "Hall, upstairs"), ("", "Hall, upstairs"), (None, " Bar "), ("  ", "Hall")], "a STRING, v STRING"
    )
    got = [r.k for r in df.select(text.venue_key(F.col("a"), F.col("v")).alias("k")).collect()]
    assert got == ["12 main st", "hall", "bar", ""]


def test_failure_note(value):
    assert value(text.failure_note(T), ["wxpn (HTTP 500 (retry))", " luma "]) == [
        "wxpn unavailable this week (HTTP 500 (retry))",
        "luma unavailable this week",
    ]


def test_challenge_page(value):
    assert value(text.is_challenge_page(T), ["Just a MOMENT...", "calendar", None]) == [True, False, False]


def test_unescape_agrees_with_the_standard(value):
    given = [
        "a &amp; b", "&amp;lt;", "&eacute;x", "&notit;", "&copy 2020", "&#8217;&#x1F600;", "&#0;", "&bogus; &", "&&amp;&",
        "&ampersand", "&NewLine;x&Tab;", "&NotEqualTilde;", "&#128;&#x99;", "x&#39;y", "", "&lt", "& b", "&hellip;&mdash;",
    ]
    assert value(markup.unescape(T), given) == [html.unescape(g) for g in given]


def test_text_of_tags(value):
    given = ["<b> a </b> <i>b</i>", "<p>  x &amp; y </p>", "<p>one<br>two</p>", "", "no tag", "<i title='a>b'>c</i><i x=it's>d</i>"]
    assert value(markup.unescape(markup.words(markup.tokens(T))), given) == ["ab", "x & y", "onetwo", "", "", "cd"]


def test_class_tokens_are_whole_words(value):
    found = F.exists(markup.tokens(T), markup.tag("a", "event"))
    given = [
        '<a class="event x">', '<a class="event--x">', '<a href="/" class="b event">', '<a data-class="event">', "<abbr class=\"event\">",
        "<A CLASS=event>", "<a title='class=event'>", "<a title=\" class=event \" class='x'>", "</a class=event>", "<a class='x\n event'>",
    ]
    assert value(found, given) == [True, False, True, False, False, True, False, False, False, True]


def test_category_lookups(spark):
    df = spark.createDataFrame([(label,) for label, _, _ in fixed.CATEGORIES] + [("Misc",)], "c STRING")
    c = F.col("c")
    rows = df.select(category.display_order(c).alias("o"), category.slug(c).alias("s"), category.minutes(c).alias("m")).collect()
    assert [r.o for r in rows] == [*range(9), None]
    assert [r.s for r in rows] == [s for _, s, _ in fixed.CATEGORIES] + ["Misc"]
    assert [r.m for r in rows] == [m for _, _, m in fixed.CATEGORIES] + [120]
