"""Checks on a collection run and on a selection; every check yields issue rows."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marquee import fixed
from marquee.functions import clock, money, text
from marquee.operators.lookup import salted_lookup

ISSUE = ["check", "severity", "week", "day", "entity", "message"]


def issues(
    df: DataFrame, check: str, severity: str, entity: Column, message: Column, day: Column | None = None
) -> DataFrame:
    return df.select(
        F.lit(check).alias("check"),
        F.lit(severity).alias("severity"),
        F.col("week").cast("string").alias("week"),
        (F.lit(None) if day is None else day).cast("string").alias("day"),
        entity.cast("string").alias("entity"),
        message.alias("message"),
    )


# Collection run ------------------------------------------------------------------------------


def shared_stamps(files: DataFrame) -> DataFrame:
    """Collection stamps that more than one source of a week carries, compared as text."""
    stamped = files.where(text.filled(F.col("collected_at")))
    return (
        stamped.groupBy("week", "collected_at")
        .agg(F.count(F.lit(1)).alias("n_sources"))
        .where(F.col("n_sources") > 1)
    )


def shared_stamp_sources(files: DataFrame) -> DataFrame:
    """The sources behind each shared stamp, one row each."""
    return salted_lookup(
        files.select("week", "collected_at", "source"),
        shared_stamps(files),
        ["week", "collected_at"],
        ["source"],
        "inner",
    )


def provenance(files: DataFrame, runs: DataFrame) -> DataFrame:
    """Identical stamps across sources, and stamps outside the run; bounds count as inside."""
    twin = issues(
        shared_stamps(files),
        "provenance",
        "fail",
        F.lit(None),
        F.format_string("%d source files share the collected_at %s", "n_sources", "collected_at"),
    )
    started, completed = clock.instant(F.col("run_started")), clock.instant(F.col("run_completed"))
    at = clock.instant(F.col("collected_at"))
    outside = salted_lookup(files, runs, ["week"], ["source"], "inner").where(~at.between(started, completed))
    return twin.unionByName(
        issues(
            outside,
            "provenance",
            "fail",
            F.col("source"),
            F.concat(F.lit("collected_at "), "collected_at", F.lit(" is outside the run")),
        )
    )


def outside_runs(files: DataFrame, runs: DataFrame, bucket_seconds: int = 6 * 3600) -> DataFrame:
    """Source files whose stamp lies in none of their week's runs, of which there may be several; one finding each.

    A run stands in every time bucket that it touches, and a stamp looks only at the runs of its own bucket, where the
    bounds decide. A stamp that cannot be read lies in no run.
    """
    def bucket(at: Column) -> Column:
        return F.floor(F.unix_timestamp(at) / bucket_seconds).cast("long")

    started, completed = clock.instant(F.col("run_started")), clock.instant(F.col("run_completed"))
    windows = runs.select("week", started.alias("started"), completed.alias("completed")).where("started <= completed")
    windows = windows.withColumn("bucket", F.explode(F.sequence(bucket(F.col("started")), bucket(F.col("completed")))))
    stamped = files.withColumn("at", clock.instant(F.col("collected_at"))).withColumn("bucket", bucket(F.col("at")))
    s, w = stamped.alias("s"), windows.alias("w")
    inside = (
        (F.col("s.week") == F.col("w.week")) & (F.col("s.bucket") == F.col("w.bucket"))
        & (F.col("s.at") >= F.col("w.started")) & (F.col("s.at") <= F.col("w.completed"))
    )
    message = F.concat(F.lit("collected_at "), F.coalesce("collected_at", F.lit("(none)")), F.lit(" is in no run of its week"))
    return issues(s.join(w, inside, "left_anti"), "provenance", "fail", F.col("source"), message)


def yield_floor(manifest: DataFrame, floors: DataFrame, total_floor: int) -> DataFrame:
    """Ok sources below their floor, and weeks below the whole-run floor (failed sources count 0)."""
    count = F.coalesce("events", F.lit(0))
    low = (
        manifest.where(F.col("status") == "ok")
        .join(floors, ["source"])
        .where((F.col("min_expected") > 0) & (count < F.col("min_expected")))
    )
    total = manifest.groupBy("week").agg(F.sum(count).alias("total"))
    return issues(
        low,
        "yield_floor",
        "fail",
        F.col("source"),
        F.format_string("wrote %d events, below floor %d", count, "min_expected"),
    ).unionByName(
        issues(
            total.where(F.lit(total_floor > 0) & (F.col("total") < total_floor)),
            "yield_floor",
            "fail",
            F.lit(None),
            F.format_string("total events %d below whole-run floor %d", "total", F.lit(total_floor)),
        )
    )


def manifest_agreement(manifest: DataFrame, files: DataFrame) -> DataFrame:
    """Manifest entries without a file, files without an entry, and counts that disagree.

    A source that is not ok still needs its file, but its count is not compared.
    """
    declared = manifest.select("week", "source", "status", "events", F.lit(True).alias("_listed"))
    found = files.select("week", "source", F.col("n_events"), F.lit(True).alias("_found"))
    both = declared.join(found, ["week", "source"], "full")
    problem = (
        F.when(F.col("_listed").isNull(), "source file has no manifest entry")
        .when(F.col("_found").isNull(), "manifest entry without a source file")
        .when(
            (F.col("status") == "ok") & (F.coalesce("events", F.lit(0)) != F.coalesce("n_events", F.lit(0))),
            F.format_string(
                "manifest claims %d events but the file holds %d",
                F.coalesce("events", F.lit(0)),
                F.coalesce("n_events", F.lit(0)),
            ),
        )
    )
    checked = both.withColumn("_problem", problem).where(F.col("_problem").isNotNull())
    return issues(checked, "file_agreement", "fail", F.col("source"), F.col("_problem"))


def snapshot_regression(current: DataFrame, prior: DataFrame) -> DataFrame:
    """Sources that had events in the prior snapshot of a week and have none now."""
    now = current.select("week", "source", F.col("n_events").alias("now"))
    lost = (
        prior.where(F.col("n_events") > 0)
        .join(now, ["week", "source"], "left")
        .where(F.coalesce("now", F.lit(0)) == 0)
    )
    return issues(
        lost,
        "non_destructive",
        "fail",
        F.col("source"),
        F.format_string("this run wrote 0 events, the prior version had %d", "n_events"),
    )


# Selection -----------------------------------------------------------------------------------


def _by_venue(picks: DataFrame) -> DataFrame:
    return picks.withColumn("venue_key", text.venue_key(F.col("address"), F.col("venue")))


def _over_cap(picks: DataFrame, cap: int) -> DataFrame:
    return _by_venue(picks).groupBy("week", "venue_key").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > cap)


def venue_cap_members(picks: DataFrame, cap: int = fixed.VENUE_PICKS_PER_WEEK) -> DataFrame:
    """The picks of the venues that `venue_cap` names."""
    members = _by_venue(picks).join(_over_cap(picks, cap), ["week", "venue_key"])
    return members.select("week", "venue_key", "day", "rank", "title", "n")


def venue_cap(picks: DataFrame, cap: int = fixed.VENUE_PICKS_PER_WEEK) -> DataFrame:
    return issues(
        _over_cap(picks, cap),
        "venue_cap",
        "warn",
        F.col("venue_key"),
        F.format_string("took %d pick slots this week (cap %d)", "n", F.lit(cap)),
    )


def time_format(picks: DataFrame) -> DataFrame:
    bad = picks.where(~F.rlike(text.text_or_empty(F.col("time")), F.lit(fixed.SINGLE_CLOCK)))
    return issues(
        bad,
        "time_format",
        "warn",
        F.col("title"),
        F.concat(F.lit("not a single clock time: "), text.text_or_empty(F.col("time"))),
        F.col("day"),
    )


def cost_blank(picks: DataFrame, listing: DataFrame) -> DataFrame:
    def blank(df: DataFrame, kind: str) -> DataFrame:
        empty = df.where(text.strip(text.text_or_empty(F.col("cost"))) == "")
        return issues(empty, "cost_blank", "warn", F.col("title"), F.lit(f"{kind} has a blank cost"), F.col("day"))

    return blank(picks, "pick").unionByName(blank(listing, "listed event"))


def implausible_time(picks: DataFrame) -> DataFrame:
    low, high = fixed.NIGHT_HOURS
    minute = clock.clock_minutes(F.col("time"))
    night = picks.where((minute >= low * 60) & (minute < high * 60))
    return issues(
        night,
        "implausible_time",
        "warn",
        F.col("title"),
        F.concat(F.lit("starts at "), "time"),
        F.col("day"),
    )


def _by_series(picks: DataFrame) -> DataFrame:
    return _by_venue(picks).withColumn("prefix", text.series_prefix(F.col("title"))).where(F.col("prefix").isNotNull())


def _series_groups(picks: DataFrame) -> DataFrame:
    return _by_series(picks).groupBy("week", "venue_key", "prefix").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1)


def same_series_members(picks: DataFrame) -> DataFrame:
    """The picks of the series that `same_series` names."""
    members = _by_series(picks).join(_series_groups(picks), ["week", "venue_key", "prefix"])
    return members.select("week", "venue_key", "prefix", "day", "rank", "title", "n")


def same_series(picks: DataFrame) -> DataFrame:
    """More than one pick with the same venue and title prefix in a week."""
    return issues(
        _series_groups(picks),
        "same_series",
        "warn",
        F.col("venue_key"),
        F.format_string("%d picks share the title prefix %s", "n", "prefix"),
    )


def star_resolves(picks: DataFrame, listing: DataFrame) -> DataFrame:
    """Picks whose title is not in their day's listing word for word."""
    key = ["week", "day", "title"]
    titles = listing.select(*key).join(picks.select(*key).distinct(), key, "left_semi").distinct()
    return issues(
        picks.join(titles, key, "left_anti"),
        "star_resolves",
        "warn",
        F.col("title"),
        F.lit("pick title is not in the day's listing"),
        F.col("day"),
    )


def _bare_titles(rows: DataFrame) -> DataFrame:
    title = text.strip(F.col("title"))
    at = F.instr(title, ": ")
    bare = F.lower(F.when(at > 0, text.strip(F.substr(title, at + 2))).otherwise(title))
    return rows.select("week", "venue", bare.alias("bare"), title.alias("title")).distinct()


def _shared_titles(rows: DataFrame) -> DataFrame:
    return _bare_titles(rows).groupBy("week", "venue", "bare").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1)


def near_title_members(rows: DataFrame) -> DataFrame:
    """The titles that `near_titles` counts."""
    return _bare_titles(rows).join(_shared_titles(rows), ["week", "venue", "bare"])


def near_titles(rows: DataFrame) -> DataFrame:
    """Titles of a venue that differ only by a leading 'prefix: ', as one row per shared remainder."""
    return issues(
        _shared_titles(rows),
        "near_titles",
        "warn",
        F.col("venue"),
        F.format_string("%d titles differ only by a prefix: %s", "n", "bare"),
    )


def _deletions(title: Column, edits: int) -> Column:
    """A text and all that is left of it when up to `edits` characters are taken out."""
    found = F.array(title)
    for _ in range(edits):
        shorter = F.transform(
            found,
            lambda x: F.transform(
                F.sequence(F.lit(1), F.greatest(F.char_length(x), F.lit(1))),
                lambda i: F.concat(F.substr(x, F.lit(1), i - 1), F.substr(x, i + 1)),
            ),
        )
        found = F.array_distinct(F.concat(found, F.flatten(shorter)))
    return found


def near_edits(rows: DataFrame, edits: int = 1) -> DataFrame:
    """Titles of a venue and week that up to `edits` typing slips tell apart: title, near_title (the greater) and edits.

    Every title stands under the digests of all that is left when up to `edits` characters are taken out. Two titles
    within so many insertions, deletions and substitutions have a remainder in common, so they meet by an equi-join and
    the edit distance verifies them; titles that share no remainder are never compared. A title of n characters has about
    n ** edits / edits! remainders: one edit suits long titles, two are for short ones. Case and white space around a
    title make no difference; titles without a character are left out.
    """
    title = F.lower(text.strip(F.col("title")))
    known = rows.select("week", "venue", title.alias("title")).where("title != ''").distinct()
    keyed = known.select("week", "venue", "title", F.explode(_deletions(F.col("title"), edits)).alias("left"))
    keyed = keyed.select("week", "venue", "title", F.xxhash64("week", "venue", "left").alias("key"))
    other = keyed.select(F.col("week").alias("w"), F.col("venue").alias("v"), F.col("title").alias("near_title"), "key")
    met = keyed.join(other, "key").where(
        (F.col("title") < F.col("near_title")) & F.col("week").eqNullSafe(F.col("w")) & F.col("venue").eqNullSafe(F.col("v"))
    )
    pairs = met.select("week", "venue", "title", "near_title").distinct()
    return pairs.withColumn("edits", F.levenshtein("title", "near_title")).where(F.col("edits") <= edits)


def implausible_claims(rows: DataFrame) -> DataFrame:
    """A holiday named in the wrong month, or a cost that reads like a budget."""
    month = F.month(F.try_to_date(F.col("date").cast("string"), "yyyy-MM-dd"))
    lowered = F.lower(text.text_or_empty(F.col("title")))
    problem = F.when(money.looks_like_budget(F.col("cost")), F.lit("cost looks like a budget"))
    for word, expected in fixed.HOLIDAY_MONTHS:
        problem = problem.when(
            F.contains(lowered, F.lit(word)) & (month != expected), F.lit(f"{word} in another month")
        )
    checked = rows.withColumn("_problem", problem).where(F.col("_problem").isNotNull())
    return issues(checked, "implausible_claim", "warn", F.col("title"), F.col("_problem"), F.col("date"))


def selection_issues(picks: DataFrame, listing: DataFrame) -> DataFrame:
    suite = [
        venue_cap(picks),
        time_format(picks),
        cost_blank(picks, listing),
        implausible_time(picks),
        same_series(picks),
    ]
    return reduce(DataFrame.unionByName, suite)


def summary(found: DataFrame) -> DataFrame:
    return found.groupBy("check", "severity").agg(F.count(F.lit(1)).alias("n"))


# The suite that each check belongs to, in the order they run.
SUITES = {
    "collection": ("provenance", "yield_floor", "file_agreement", "non_destructive"),
    "merge": ("merge",),
    "selection": (
        "venue_cap", "time_format", "cost_blank", "implausible_time", "same_series", "star_resolves", "near_titles",
        "implausible_claim",
    ),
}


def full_selection_issues(picks: DataFrame, listing: DataFrame) -> DataFrame:
    """All checks of a selection: those of `selection_issues`, resolved stars, near titles and claims."""
    dated = listing.withColumn("date", F.col("day"))
    more = [star_resolves(picks, listing), near_titles(listing), implausible_claims(dated)]
    return reduce(DataFrame.unionByName, more, selection_issues(picks, listing))


def verdicts(found: DataFrame, weeks: DataFrame) -> DataFrame:
    """Whether each suite passed in each week: it fails by one finding of severity fail, warnings are counted.

    `weeks` holds every week that was checked, so a week without findings passes.
    """
    pairs = [(check, suite) for suite, checks in SUITES.items() for check in checks]
    suite = F.when(F.lit(False), F.lit(""))
    for check, name in pairs:
        suite = suite.when(F.col("check") == check, name)
    counted = found.groupBy(F.col("week").cast("string").alias("week"), suite.alias("suite")).agg(
        F.count_if(F.col("severity") == "fail").alias("n_fail"), F.count_if(F.col("severity") == "warn").alias("n_warn")
    )
    every = weeks.select(F.col("week").cast("string").alias("week")).distinct()
    every = every.select("week", F.explode(F.array(*map(F.lit, SUITES))).alias("suite"))
    judged = every.join(counted, ["week", "suite"], "left").na.fill(0, ["n_fail", "n_warn"])
    return judged.withColumn("passed", F.col("n_fail") == 0)
