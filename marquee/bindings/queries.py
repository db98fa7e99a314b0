"""Every registered query: its DataFrame job over the driver tables and the DuckDB SQL that checks it.

A query without SQL has no practical SQL form; tests compare it with brute force on small rows.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marquee import fixed, schemas
from marquee.bindings import sql_views as S
from marquee.bindings.views import LISTING_PRIORITY, OCCURRENCE_PRIORITY, Tables
from marquee.functions import clock, money, pages, text
from marquee.functions.markup import tag
from marquee.operators import (
    analytics,
    category_model,
    collapse,
    collection,
    lookup,
    matching,
    merge,
    picks_log,
    quality,
    ranking,
    report,
    sketches,
    usage,
)
from marquee.plans.candidates import build_candidates, whole_candidates
from marquee.session import through_table, work_path
from marquee.plans import weekly
from marquee.sources import extract, feeds_html, week_files
from marquee.sources.week_files import replace_weeks
from marquee.streaming import jobs, sink

Query = Callable[[Tables], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None, views: list[str] | None = None) -> Callable[[Query], Query]:
    def register(fn: Query) -> Query:
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = S.with_views(views or [], sql)
        return fn

    return register


def text_columns(df: DataFrame, *names: str) -> DataFrame:
    for name in names:
        df = df.withColumn(name, F.col(name).cast("string"))
    return df


# Collapse, fold, number --------------------------------------------------------------------------


def _collapsed_sql(view: str, priority: list[str], note_len: int = len(fixed.SOLD_OUT_NOTE)) -> str:
    ranks = " ".join(f"WHEN '{s}' THEN {i}" for i, s in enumerate(priority))
    noted = f"('{fixed.SOLD_OUT_NOTE}' || description)"
    return f"""
    ranked AS (
      SELECT *, contains(lower(description), 'sold out') AS sold,
             row_number() OVER (PARTITION BY week, title, venue, date ORDER BY CASE source {ranks} ELSE {len(priority)} END,
               -((time <> '')::INT + (cost <> '')::INT + (url <> '')::INT + (description <> '')::INT), stem, pos) AS rn,
             max(contains(lower(description), 'sold out')::INT) OVER (PARTITION BY week, title, venue, date) AS any_sold,
             min((stem, pos)) OVER (PARTITION BY week, title, venue, date) AS first_seen
      FROM {view}),
    collapsed AS (
      SELECT week, title, venue, date, first_seen[1] AS stem, first_seen[2] AS pos, source, time, cost, url,
             CASE WHEN any_sold = 1 AND NOT sold THEN {S.rtrim(noted)} ELSE description END AS description,
             date AS listed_date,
             (any_sold = 1 AND NOT sold) AS sold_out_noted
      FROM ranked WHERE rn = 1)"""


_FOLDED = """
    spans AS (SELECT week, title, venue, count(DISTINCT date) AS n_dates, string_agg(DISTINCT date, ',' ORDER BY date) AS dates,
                     min((stem, pos)) AS first_row, min(date) AS first_date
              FROM collapsed GROUP BY week, title, venue),
    folded AS (
      SELECT c.*, CASE WHEN n_dates >= 3 THEN dates END AS occurrences, CASE WHEN n_dates >= 3 THEN CAST(n_dates AS INT) END AS recurrence_count,
             first_row[1] AS series_stem, first_row[2] AS series_pos
      FROM collapsed c JOIN spans s USING (week, title, venue) WHERE n_dates < 3 OR c.date = first_date)"""

_NUMBERED = """
    numbered AS (SELECT *, row_number() OVER (PARTITION BY week ORDER BY series_stem, series_pos, stem, pos) - 1 AS ord FROM folded)"""


def _chain(view: str, priority: list[str], steps: list[str], select: str) -> str:
    """View CTEs, then the collapse chain, then the final select."""
    head = S.with_views([view], "")
    return head.rstrip() + ",\n" + ",".join([_collapsed_sql(view, priority), *steps]) + "\n" + select


COLLAPSED = "week, title, venue, date, stem, pos, source, time, cost, url, description, listed_date, sold_out_noted"


@query("collapse_duplicates")
def collapse_duplicates(t: Tables) -> DataFrame:
    return collapse.collapse_duplicates(t.listing(), LISTING_PRIORITY)


ORACLES["collapse_duplicates"] = _chain("listing", LISTING_PRIORITY, [], f"SELECT {COLLAPSED} FROM collapsed")


def _folded(t: Tables) -> DataFrame:
    return collapse.fold_series(collapse.collapse_duplicates(t.occurrence(), OCCURRENCE_PRIORITY))


@query("group_recurring")
def group_recurring(t: Tables) -> DataFrame:
    return _folded(t).select(
        "week", "title", "venue", "date", "stem", "pos", "series_stem", "series_pos",
        F.array_join("occurrences", ",").alias("occurrences"), "recurrence_count",
    )


ORACLES["group_recurring"] = _chain(
    "occurrence", OCCURRENCE_PRIORITY, [_FOLDED],
    "SELECT week, title, venue, date, stem, pos, series_stem, series_pos, occurrences, recurrence_count FROM folded",
)


@query("assign_ids")
def assign_ids(t: Tables) -> DataFrame:
    return collapse.assign_ids(_folded(t)).select("week", "id", "ord", "title", "venue", "date", "source")


ORACLES["assign_ids"] = _chain(
    "occurrence", OCCURRENCE_PRIORITY, [_FOLDED, _NUMBERED],
    "SELECT week, printf('c%04d', ord) AS id, ord, title, venue, date, source FROM numbered",
)


@query("build_candidates")
def candidates(t: Tables) -> DataFrame:
    return build_candidates(t.listing(), LISTING_PRIORITY).withColumn("occurrences", F.array_join("occurrences", ","))


ORACLES["build_candidates"] = _chain(
    "listing", LISTING_PRIORITY, [_FOLDED, _NUMBERED],
    "SELECT week, printf('c%04d', ord) AS id, ord, title, venue, date, time, cost, url, "
    + S.cap("description") + " AS description, source, occurrences, recurrence_count, listed_date FROM numbered",
)

# Scans, sinks, collection ------------------------------------------------------------------------


@query(
    "scan_ok_sources",
    """
    SELECT CAST(date_trunc('year', o_orderdate) AS DATE) AS week, CAST(o_orderkey AS VARCHAR) AS stem,
           CASE WHEN l_returnflag = 'N' THEN CAST(o_orderkey AS VARCHAR) ELSE 'supplier ' || l_suppkey END AS source,
           l_linenumber AS pos, l_partkey, l_quantity
    FROM orders JOIN lineitem ON l_orderkey = o_orderkey WHERE o_orderstatus = 'O'""",
)
def scan_ok_sources(t: Tables) -> DataFrame:
    """Line items of orders whose manifest entry is ok; a line without a source name takes the stem."""
    orders = t.table("orders").select("o_orderkey", F.trunc("o_orderdate", "year").alias("week"))
    events = t.table("lineitem").join(orders, F.col("l_orderkey") == F.col("o_orderkey")).select(
        "week",
        F.col("l_orderkey").cast("string").alias("stem"),
        F.when(F.col("l_returnflag") != "N", F.concat(F.lit("supplier "), "l_suppkey")).alias("source"),
        F.col("l_linenumber").alias("pos"),
        "l_partkey",
        "l_quantity",
    )
    return collection.ok_events(t.declared_orders(), events)


@query(
    "build_manifest",
    """
    WITH counts AS (SELECT l_orderkey, count(*) AS n FROM lineitem GROUP BY l_orderkey),
    results AS (
      SELECT CAST(date_trunc('year', o_orderdate) AS DATE) AS week, CAST(o_custkey AS VARCHAR) AS source, o_orderstatus <> 'P' AS ok,
             coalesce(n, 0) AS events, CASE WHEN o_orderpriority <> '5-LOW' THEN o_orderpriority END AS reason,
             strftime(o_orderdate, '%Y-%m-%d') AS collected_at
      FROM orders LEFT JOIN counts ON l_orderkey = o_orderkey)
    SELECT week, source, CASE WHEN bool_or(ok) THEN 'ok' ELSE 'failed' END AS status,
           CASE WHEN bool_or(ok) THEN CAST(sum(CASE WHEN ok THEN events ELSE 0 END) AS BIGINT) END AS events,
           CASE WHEN NOT bool_or(ok) THEN min(coalesce(reason, 'unknown reason')) END AS reason,
           min(collected_at) AS first_collected, max(collected_at) AS last_collected
    FROM results GROUP BY week, source""",
)
def build_manifest(t: Tables) -> DataFrame:
    return collection.build_manifest(_results(t))


def _results(t: Tables) -> DataFrame:
    """Orders as extraction results of a customer's feed."""
    counts = t.table("lineitem").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.count(F.lit(1)).alias("events"))
    return t.table("orders").join(counts, ["o_orderkey"], "left").select(
        F.trunc("o_orderdate", "year").alias("week"),
        F.col("o_custkey").cast("string").alias("source"),
        F.when(F.col("o_orderstatus") == "P", "failed").otherwise("ok").alias("status"),
        "events",
        F.when(F.col("o_orderpriority") != "5-LOW", F.col("o_orderpriority")).alias("reason"),
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("collected_at"),
    )


@query(
    "run_summary",
    """
    SELECT week, count(*) AS n_sources, count(*) FILTER (status = 'ok') AS n_ok, count(*) FILTER (status <> 'ok') AS n_failed,
           CAST(sum(coalesce(events, 0)) AS BIGINT) AS n_events
    FROM manifest GROUP BY ROLLUP (week)""",
    ["manifest"],
)
def run_summary(t: Tables) -> DataFrame:
    return collection.run_summary(t.manifest())


@query(
    "split_by_day",
    """
    SELECT d.week, CAST(d.date AS DATE) AS date, coalesce(n, 0) AS n_candidates
    FROM (SELECT week, unnest(generate_series(week, week + 6, INTERVAL 1 DAY)) AS date FROM (SELECT DISTINCT week FROM occurrence)) d
    LEFT JOIN (SELECT week, day_date, count(*) AS n FROM occurrence GROUP BY ALL) c ON c.week = d.week AND c.day_date = d.date""",
    ["occurrence"],
)
def split_by_day(t: Tables) -> DataFrame:
    return collection.day_split(t.occurrence())


@query(
    "out_of_window",
    """
    SELECT week, id, day AS date FROM placed WHERE CAST(day AS DATE) NOT BETWEEN week AND week + 6""",
    ["placed"],
)
def out_of_window(t: Tables) -> DataFrame:
    placed = t._placed(t.occurrence()).withColumn("date", F.col("day"))
    return collection.out_of_window(placed).select("week", "id", "date")


@query(
    "append_new_picks",
    """
    SELECT n.* FROM log_row n
    WHERE NOT EXISTS (SELECT 1 FROM (SELECT week_of, title FROM log_row WHERE date < '2024-01-15') l
                      WHERE l.week_of = n.week_of AND l.title = n.title)""",
    ["log_row"],
)
def append_new_picks(t: Tables) -> DataFrame:
    """All log rows against a log that was written up to the middle of the month."""
    rows = through_table(_log_rows(t), "log")
    return picks_log.new_rows(rows, rows.where(F.col("date") < "2024-01-15"))


def _log_rows(t: Tables) -> DataFrame:
    return picks_log.log_rows(_merged_picks(t), _merged_mentions(t), t.music_lookup())


@query("picks_log_rows", "SELECT * FROM log_row", ["log_row"])
def picks_log_rows(t: Tables) -> DataFrame:
    return _log_rows(t)


@query(
    "fetch_rollup",
    """
    WITH asked AS (SELECT CAST(date_trunc('month', l_shipdate) AS DATE) AS week, CAST(l_suppkey AS VARCHAR) AS source,
                          l_returnflag <> 'R' AS ok, CAST(l_quantity AS BIGINT) AS n FROM lineitem),
    rolled AS (SELECT week, source, CAST(sum(CASE WHEN ok THEN n ELSE 0 END) AS BIGINT) AS events, count(*) FILTER (ok) AS n_ok,
                      count(*) FILTER (NOT ok) AS n_failed FROM asked GROUP BY week, source)
    SELECT week, source, CASE WHEN n_ok = 0 THEN 'failed' ELSE 'ok' END AS status, CASE WHEN n_ok > 0 THEN events END AS events,
           CASE WHEN n_ok = 0 THEN 'every request failed (' || n_failed || ' attempted)' END AS reason,
           CASE WHEN n_ok > 0 AND n_failed > 0 THEN 'partial -- ' || n_failed || ' request(s) failed' END AS note
    FROM rolled""",
)
def fetch_rollup(t: Tables) -> DataFrame:
    return collection.fetch_rollup(t.fetches())


@query(
    "resume_plan",
    """
    SELECT CAST(c_custkey AS VARCHAR) AS source, c_mktsegment AS segment, CASE WHEN any_ok IS NULL THEN 'fetch' ELSE 'retry' END AS action
    FROM customer LEFT JOIN (SELECT o_custkey, bool_or(o_orderstatus = 'F' AND o_totalprice > 300000) AS any_ok FROM orders GROUP BY 1)
      ON o_custkey = c_custkey WHERE NOT coalesce(any_ok, false)""",
)
def resume_plan(t: Tables) -> DataFrame:
    """Customers as the source registry, orders as results: only large finished ones count as ok."""
    registry = t.table("customer").select(F.col("c_custkey").cast("string").alias("source"), F.col("c_mktsegment").alias("segment"))
    done = (F.col("o_orderstatus") == "F") & (F.col("o_totalprice") > 300_000)
    results = t.table("orders").select(
        F.col("o_custkey").cast("string").alias("source"), F.when(done, "ok").otherwise("failed").alias("status")
    )
    return collection.resume_plan(registry, results)


@query(
    "union_first_seen",
    """
    SELECT title, date, CASE WHEN k < 50 THEN 'month 1' ELSE 'month 2' END AS snapshot, pos, venue FROM occurrence
    QUALIFY row_number() OVER (PARTITION BY title, date ORDER BY k >= 50, pos) = 1""",
    ["occurrence"],
)
def union_first_seen(t: Tables) -> DataFrame:
    rows = t.occurrence().select("title", "date", "pos", "venue", "k")
    first = rows.where(F.col("k") < 50).withColumn("snapshot", F.lit("month 1"))
    second = rows.where(F.col("k") >= 50).withColumn("snapshot", F.lit("month 2"))
    return collection.union_first_seen(first.unionByName(second).drop("k"))


@query(
    "failure_notes",
    """
    SELECT CAST(date_trunc('year', o_orderdate) AS DATE) AS week, CAST(o_orderkey AS VARCHAR) AS source,
           o_orderkey || ' (' || coalesce(reason, 'unknown reason') || ')' AS failure,
           o_orderkey || ' unavailable this week (' || coalesce(reason, 'unknown reason') || ')' AS note
    FROM (SELECT *, CASE WHEN o_orderpriority <> '5-LOW' THEN o_orderpriority END AS reason FROM orders) WHERE o_orderstatus = 'P'""",
)
def failure_notes(t: Tables) -> DataFrame:
    manifest = t.table("orders").select(
        F.trunc("o_orderdate", "year").alias("week"),
        F.col("o_orderkey").cast("string").alias("source"),
        F.when(F.col("o_orderstatus") == "P", "failed").otherwise("ok").alias("status"),
        F.when(F.col("o_orderpriority") != "5-LOW", F.col("o_orderpriority")).alias("reason"),
    )
    return collection.failure_list(manifest).withColumn("note", text.failure_note(F.col("failure")))


# Raw feeds ---------------------------------------------------------------------------------------

LISTED = "source, week_start, title, venue, date, time, cost, url, description, listed_date"
LISTED_COLUMNS = [c.strip() for c in LISTED.split(",")]


def _listed(parsed: DataFrame) -> DataFrame:
    return extract.listings(parsed).select(*LISTED_COLUMNS)


@query(
    "extract_json_feed",
    """
    SELECT 'feed' AS source, week AS week_start, event_type || ' & ' || k AS title,
           'Hall ' || user_id || CASE WHEN user_id < 75 THEN ', Camden' ELSE '' END || CASE WHEN user_id < 50 THEN ', NJ' ELSE '' END AS venue,
           date, strftime(ts, '%-I:%M %p') AS time,
           CASE WHEN value < 5 THEN 'Free' ELSE '$' || CAST(CAST(value AS DECIMAL(12, 2)) AS VARCHAR) END AS cost,
           'https://do215.com/events/' || pos AS url, description, date AS listed_date
    FROM occurrence WHERE event_type <> 'error'""",
    ["occurrence"],
)
def extract_json_feed(t: Tables) -> DataFrame:
    return _listed(extract.parse(t.object_payloads(), "object_json"))


@query(
    "extract_epoch_overlap",
    """
    WITH r AS (SELECT *, timezone('America/New_York', timezone('UTC', ts)) AS wall,
                      timezone('America/New_York', timezone('UTC', ts + to_days(k))) AS last,
                      CASE WHEN event_type = 'click' THEN week + 7 ELSE week END AS monday,
                      event_type IN ('view', 'click') AS multi FROM occurrence)
    SELECT 'feed' AS source, monday AS week_start, title,
           'Hall ' || user_id || CASE WHEN user_id < 75 THEN ' (' || user_id || ' Main St)' ELSE '' END AS venue,
           CAST(CAST(wall AS DATE) AS VARCHAR) AS date, strftime(wall, '%-I:%M %p') AS time, '' AS cost,
           'https://philly.askapunk.net/slug-' || pos AS url, event_type || ' / k' || k AS description,
           CAST(greatest(CAST(wall AS DATE), monday) AS VARCHAR) AS listed_date
    FROM r WHERE CAST(wall AS DATE) <= monday + 6 AND CASE WHEN multi THEN CAST(last AS DATE) ELSE CAST(wall AS DATE) END >= monday""",
    ["occurrence"],
)
def extract_epoch_overlap(t: Tables) -> DataFrame:
    return _listed(extract.parse(t.epoch_payloads(), "epoch_json"))


@query(
    "extract_date_only",
    """
    SELECT 'feed' AS source, CAST(date_trunc('week', o_orderdate) AS DATE) AS week_start,
           'Order & “' || o_orderkey || '” é<' AS title, 'Cust – ' || o_custkey AS venue, strftime(o_orderdate, '%Y-%m-%d') AS date,
           '' AS time, CASE WHEN o_orderstatus = 'O' THEN o_orderpriority ELSE '' END AS cost,
           CASE WHEN o_orderstatus <> 'P' THEN 'https://example.org/o' || o_orderkey ELSE 'https://example.org/x' END AS url,
           CASE WHEN o_orderstatus = 'F' THEN 'A &amp; B' ELSE '' END AS description, strftime(o_orderdate, '%Y-%m-%d') AS listed_date
    FROM orders WHERE o_orderstatus <> 'P' OR o_totalprice < 100000""",
)
def extract_date_only(t: Tables) -> DataFrame:
    return _listed(extract.parse(t.date_only_payloads(), "date_only_json"))


@query(
    "extract_calendar_json",
    """
    SELECT 'feed' AS source, week AS week_start, event_type AS title, CASE WHEN user_id >= 50 THEN venue ELSE 'Default Hall' END AS venue,
           date, CASE WHEN event_type <> 'signup' THEN strftime(ts, '%-I:%M %p') ELSE '' END AS time, '' AS cost,
           CASE WHEN event_type <> 'click' THEN url ELSE 'https://example.org/' END AS url, description, date AS listed_date
    FROM occurrence WHERE event_type <> 'error'""",
    ["occurrence"],
)
def extract_calendar_json(t: Tables) -> DataFrame:
    return _listed(extract.parse(t.calendar_payloads(), "calendar_json"))


def _ical_sql(wall: str, online: str, url: str) -> str:
    return f"""
    WITH r AS (SELECT *, {wall} AS wall, CASE WHEN user_id < 30 THEN 'https://example.org/u' || user_id
               WHEN user_id < 60 THEN '' ELSE 'Hall ' || user_id || ', Main St' END AS place FROM occurrence)
    SELECT 'feed' AS source, week AS week_start, event_type || '; no ' || k AS title, {online} AS venue,
           CAST(CAST(wall AS DATE) AS VARCHAR) AS date, strftime(wall, '%-I:%M %p') AS time, '' AS cost, {url} AS url,
           'first' || chr(10) || 'then: ' || k AS description, CAST(CAST(wall AS DATE) AS VARCHAR) AS listed_date
    FROM r WHERE CAST(wall AS DATE) BETWEEN week AND week + 6"""


@query(
    "extract_ical_utc",
    _ical_sql(
        "timezone('America/New_York', timezone('UTC', ts))",
        "CASE WHEN user_id < 30 THEN '(online / see description)' ELSE place END",
        "CASE WHEN user_id < 30 THEN place ELSE '' END",
    ),
    ["occurrence"],
)
def extract_ical_utc(t: Tables) -> DataFrame:
    return _listed(extract.parse(t.ical_payloads(local=False), "ical_utc"))


@query(
    "extract_ical_local",
    _ical_sql("ts", "CASE WHEN user_id < 60 THEN '(online)' ELSE place END", "url"),
    ["occurrence"],
)
def extract_ical_local(t: Tables) -> DataFrame:
    return _listed(extract.parse(t.ical_payloads(local=True), "ical_local"))


def _html_sql(title: str, venue: str, time: str, cost: str, url: str, description: str, keep: str = "event_type <> 'error'") -> str:
    return f"""
    SELECT 'feed' AS source, week AS week_start, {title} AS title, {venue} AS venue, date, {time} AS time, {cost} AS cost,
           {url} AS url, {description} AS description, date AS listed_date
    FROM occurrence WHERE {keep}"""


_NAME = "event_type || ' & ' || k"
_CLOCK_TEXT = "strftime(ts, '%-I:%M %p')"
HTML_SQL = {
    "html_dated": _html_sql(
        _NAME, f"'{fixed.VENUE_OF_FORMAT['html_dated']}'", f"{_CLOCK_TEXT} || ', 11:59 PM'", "cost", "url", "description"
    ),
    "html_blocks": _html_sql(_NAME, "'Hall ' || user_id", _CLOCK_TEXT, "''", "url", "event_type"),
    "html_tagline": _html_sql(
        f"CASE WHEN user_id < 75 THEN 'with ' || user_id || ' | ' ELSE '' END || {_NAME}", "'Hall ' || user_id", _CLOCK_TEXT,
        "cost", "url", "CASE WHEN user_id < 75 THEN 'with ' || user_id ELSE '' END",
    ),
    "html_long_date": _html_sql(_NAME, "'Hall ' || user_id", "''", "''", "url", "description"),
    "html_two_fields": _html_sql(
        _NAME, "'Hall ' || user_id", _CLOCK_TEXT, "cost", "url", _NAME
    ),
    "html_month_grid": _html_sql(
        _NAME, f"'{fixed.VENUE_OF_FORMAT['html_month_grid']}'", _CLOCK_TEXT, "''", "'https://www.therotunda.org/event/' || pos",
        _NAME, "true",
    ),
}


def _register_layouts() -> None:
    for layout, sql in HTML_SQL.items():
        def run(t: Tables, layout: str = layout) -> DataFrame:
            return _listed(extract.parse(t.html_payloads(layout), layout))

        query(f"extract_{layout}", sql, ["occurrence"])(run)


_register_layouts()


@query(
    "extract_html_links",
    r"""
    SELECT page_id, CAST(i - 1 AS INT) AS pos, replace(replace(regexp_extract(b, 'href="([^"]*)"', 1), '&quot;', '"'), '&amp;', '&') AS href,
           replace(replace(trim(regexp_extract(b, '<a href="[^"]*">([^<]*)</a>', 1)), '&quot;', '"'), '&amp;', '&') AS label
    FROM (SELECT page_id, unnest(range(1, len(l) + 1)) AS i, unnest(l) AS b
          FROM (SELECT page_id, regexp_extract_all(html, '<li><a href="[^"]*">[^<]*</a>') AS l FROM pages))""",
)
def extract_html_links(t: Tables) -> DataFrame:
    return feeds_html.links(t.table("pages"), tag("li"))


@query(
    "extract_json_ld",
    """
    SELECT 'feed' AS source, week AS week_start, event_type || ' & ' || k AS title,
           concat_ws(', ', CASE WHEN user_id >= 30 THEN 'Hall ' || user_id END, CASE WHEN user_id < 75 THEN user_id || ' Main St' END) AS venue,
           date, strftime(ts, '%-I:%M %p') AS time, '' AS cost, url, description, date AS listed_date
    FROM occurrence WHERE event_type NOT IN ('error', 'signup')""",
    ["occurrence"],
)
def extract_json_ld(t: Tables) -> DataFrame:
    return _listed(feeds_html.json_ld(t.card_payloads(), t.card_details()))


@query(
    "extract_text_blocks",
    """
    WITH shows AS (
      SELECT week, date, user_id, pos // 1000 AS page, event_type, strftime(ts, '%-I:%M %p') AS t, min(pos) AS pos
      FROM occurrence WHERE event_type <> 'error' GROUP BY ALL)
    SELECT 'feed' AS source, week AS week_start, event_type AS title, 'Hall ' || user_id AS venue, date,
           string_agg(t, ', ' ORDER BY pos) AS time, '' AS cost, 'https://example.org/theater' AS url,
           'Rated ' || CASE WHEN event_type = 'view' THEN 'Not Rated' ELSE 'PG' END || '. Runtime: 1 hr.' AS description, date AS listed_date
    FROM shows GROUP BY week, date, user_id, page, event_type""",
    ["occurrence"],
)
def extract_text_blocks(t: Tables) -> DataFrame:
    return _listed(extract.parse(t.showtime_payloads(), "showtime_text"))


_BOLD = feeds_html.Layout(
    listing=pages.tag("b"),
    of_listing=lambda block: {"title": pages.words(block)},
    dated=(),
    date=lambda t: F.col("context_date"),
    fields=lambda t: {"title": t["title"], **{c: F.lit("") for c in ("venue", "time", "cost", "url", "description")}},
)


@query(
    "extract_status",
    """
    WITH p AS (SELECT regexp_extract(url, '://([^/]+)/', 1) AS source, page_id % 28 <= 6 AS inside,
                      (length(html) - length(replace(html, '<p><b>', ''))) // 6 AS n FROM pages)
    SELECT source, DATE '2024-01-01' AS week_start, CASE WHEN sum(n) = 0 THEN 'failed' ELSE 'ok' END AS status,
           CASE WHEN sum(n) = 0 THEN 'no listing containers found, the layout may have changed' END AS reason,
           CASE WHEN sum(n) > 0 THEN CAST(sum(CASE WHEN inside THEN n ELSE 0 END) AS BIGINT) END AS events
    FROM p GROUP BY source""",
)
def extract_status(t: Tables) -> DataFrame:
    """Web pages as payloads of their host: bold paragraphs are the listings, the page number sets the day."""
    monday = F.lit("2024-01-01").cast("date")
    payloads = t.table("pages").select(
        F.regexp_extract("url", "://([^/]+)/", 1).alias("source"),
        F.col("page_id").alias("page"),
        monday.alias("week_start"),
        F.date_add(monday, (F.col("page_id") % 28).cast("int")).alias("context_date"),
        F.col("html").alias("body"),
    )
    return extract.status(feeds_html.parse(payloads, _BOLD))


@query(
    "flag_challenge_pages",
    """
    SELECT page_id, regexp_matches(lower(html), 'checking your browser|just a moment|please wait while we verify|performing security verification') AS challenged,
           CAST(length(html) AS INT) AS chars FROM pages""",
)
def flag_challenge_pages(t: Tables) -> DataFrame:
    return t.table("pages").select(
        "page_id", text.is_challenge_page(F.col("html")).alias("challenged"), F.char_length("html").alias("chars")
    )


@query(
    "truncate_bodies",
    """
    SELECT page_id, html AS body, length(html) > 5000 AS truncated,
           CASE WHEN length(html) > 5000 THEN substring(html, 1, 5000) || chr(10) || chr(10) || '[... truncated at 5000 chars ...]'
           ELSE html END AS shown_body FROM pages""",
)
def truncate_bodies(t: Tables) -> DataFrame:
    return extract.with_shown_body(t.table("pages").select("page_id", F.col("html").alias("body")), 5_000)


# Column expressions ------------------------------------------------------------------------------


@query(
    "week_calendar",
    """
    SELECT DISTINCT week, week + 7 AS next_monday,
           CASE WHEN month(week) = month(week + 6) THEN strftime(week, '%B %-d') || '–' || strftime(week + 6, '%-d, %Y')
                ELSE strftime(week, '%B %-d') || ' – ' || strftime(week + 6, '%B %-d, %Y') END AS label,
           array_to_string([CAST(week + CAST(i AS INT) AS VARCHAR) FOR i IN range(0, 7)], ',') AS days
    FROM (SELECT CAST(date_trunc('week', ts) AS DATE) AS week FROM events)""",
)
def week_calendar(t: Tables) -> DataFrame:
    days = t.occurrence().select("day_date").distinct()
    weeks = days.select(clock.week_of(F.col("day_date")).alias("week"), clock.target_monday(F.col("day_date")).alias("next_monday"))
    return weeks.distinct().select(
        "week",
        "next_monday",
        clock.range_label(F.col("week"), F.date_add("week", 6)).alias("label"),
        F.array_join(F.transform(clock.week_days(F.col("week")), lambda d: d.cast("string")), ",").alias("days"),
    )


@query(
    "resolve_year",
    """
    WITH o AS (SELECT o_orderkey, month(o_orderdate) AS m, day(o_orderdate) AS d,
                      CAST(date_trunc('week', o_orderdate + to_days(CAST(o_custkey % 400 AS INT))) AS DATE) + 7 AS monday FROM orders),
    c AS (SELECT o_orderkey, monday, TRY_CAST((year(monday) + s) || '-' || lpad(CAST(m AS VARCHAR), 2, '0') || '-' || lpad(CAST(d AS VARCHAR), 2, '0') AS DATE) AS day
          FROM o, (SELECT unnest([-1, 0, 1]) AS s))
    SELECT o_orderkey, monday AS week_start, arg_min(day, abs(day - monday) * 100000 + year(day)) FILTER (day IS NOT NULL) AS resolved
    FROM c GROUP BY o_orderkey, monday""",
)
def resolve_year(t: Tables) -> DataFrame:
    day = F.to_date("o_orderdate")
    monday = clock.target_monday(F.date_add(day, (F.col("o_custkey") % 400).cast("int")))
    rows = t.table("orders").select("o_orderkey", monday.alias("week_start"), day.alias("day"))
    return rows.select(
        "o_orderkey",
        "week_start",
        clock.nearest_date(F.month("day"), F.dayofmonth("day"), F.col("week_start")).alias("resolved"),
    )


@query("format_time", "SELECT event_id, strftime(ts, '%-I:%M %p') AS shown FROM events")
def format_time(t: Tables) -> DataFrame:
    return t.table("events").select("event_id", clock.display_clock(F.col("ts")).alias("shown"))


@query(
    "parse_time",
    f"""
    WITH w AS (SELECT event_id, CASE event_type WHEN 'view' THEN strftime(ts, '%-I:%M %p') WHEN 'click' THEN lower(strftime(ts, '%I:%M  %p'))
                 WHEN 'error' THEN strftime(ts, '%-I:%-M %p') WHEN 'signup' THEN strftime(ts, '%H:%M')
                 ELSE strftime(ts, '%-I:%M %p') || ', 11:00 PM' END AS written FROM events)
    SELECT event_id, written, {S.minutes('written')} AS minute FROM w""",
)
def parse_time(t: Tables) -> DataFrame:
    """Clock times as feeds write them: plain, padded lower-case, unpadded, 24-hour, several."""
    kind = F.col("event_type")
    written = (
        F.when(kind == "view", F.date_format("ts", "h:mm a"))
        .when(kind == "click", F.lower(F.date_format("ts", "hh:mm  a")))
        .when(kind == "error", F.date_format("ts", "h:m a"))
        .when(kind == "signup", F.date_format("ts", "HH:mm"))
        .otherwise(F.concat(F.date_format("ts", "h:mm a"), F.lit(", 11:00 PM")))
    )
    rows = t.table("events").select("event_id", written.alias("written"))
    return rows.withColumn("minute", clock.clock_minutes(F.col("written")))


@query("cap_descriptions", f"SELECT doc_id, {S.cap('text')} AS description FROM documents")
def cap_descriptions(t: Tables) -> DataFrame:
    return t.table("documents").select("doc_id", text.cap(F.col("text")).alias("description"))


_WRAPPED = "CASE lang WHEN 'en' THEN '*(' || text || ')*' WHEN 'fr' THEN '  *( ' || text || ' )*  ' ELSE text END"


@query(
    "placeholder",
    f"""
    SELECT doc_id, {S.placeholder('w')} AS unconfirmed, {S.unwrap('w')} AS value
    FROM (SELECT doc_id, {_WRAPPED} AS w FROM documents)""",
)
def placeholder(t: Tables) -> DataFrame:
    body, lang = F.col("text"), F.col("lang")
    wrapped = (
        F.when(lang == "en", F.concat(F.lit("*("), body, F.lit(")*")))
        .when(lang == "fr", F.concat(F.lit("  *( "), body, F.lit(" )*  ")))
        .otherwise(body)
    )
    return t.table("documents").select(
        "doc_id", text.is_placeholder(wrapped).alias("unconfirmed"), text.unwrap_placeholder(wrapped).alias("value")
    )


@query(
    "price_tier",
    f"""
    SELECT pos, {S.price_tier('cost', 'sold_out')} AS tier,
           CASE WHEN sold_out THEN 'sold-out' WHEN lower({S.unwrap('cost')}) IN ('free', 'no cover') THEN 'price-free' ELSE 'price-paid' END AS price_class,
           CASE WHEN sold_out THEN 'SOLD OUT' ELSE {S.unwrap('cost')} END AS price_text, {S.dollars('cost')} AS dollars
    FROM occurrence""",
    ["occurrence"],
)
def price_tier(t: Tables) -> DataFrame:
    cost, sold_out = F.col("cost"), F.col("sold_out")
    return t.occurrence().select(
        "pos",
        money.price_tier(cost, sold_out).alias("tier"),
        money.price_class(cost, sold_out).alias("price_class"),
        money.price_text(cost, sold_out).alias("price_text"),
        money.dollars(cost).alias("dollars"),
    )


_ACTS = r"\s*(?:,| & | and | w/ | with | — | – | - )\s*"
_HEAD_OF = lambda side: S.strip(f"regexp_split_to_array({side}, '(?i){_ACTS}')[1]")


@query(
    "headliner_names",
    f"""
    WITH t AS (SELECT doc_id, {S.strip('split_part(text, chr(10), 1)')} AS title FROM documents),
    s AS (SELECT *, CASE WHEN contains(title, ':') THEN {S.strip("substring(title, 1, position(':' IN title) - 1)")} ELSE title END AS a,
                 CASE WHEN contains(title, ':') THEN {S.strip("substring(title, position(':' IN title) + 1)")} END AS b FROM t),
    h AS (SELECT *, {_HEAD_OF('a')} AS ha, {_HEAD_OF('b')} AS hb FROM s)
    SELECT doc_id, concat_ws(' | ', title, CASE WHEN ha <> '' AND ha <> title THEN ha END,
                             CASE WHEN hb <> '' AND hb <> title AND hb <> ha THEN hb END) AS names FROM h""",
)
def headliner_names(t: Tables) -> DataFrame:
    title = F.split_part("text", F.lit("\n"), F.lit(1))
    return t.table("documents").select("doc_id", F.array_join(text.headliner_names(title), " | ").alias("names"))


@query(
    "venue_address",
    """
    SELECT s_suppkey, 'NATION_' || s_nationkey AS venue, CASE WHEN n_regionkey < 3 THEN n_regionkey || ' Region St' END AS address
    FROM supplier LEFT JOIN nation ON n_nationkey = s_nationkey""",
)
def venue_address(t: Tables) -> DataFrame:
    known = t.table("nation").where(F.col("n_regionkey") < 3).select(
        F.col("n_name").alias("venue"), F.concat(F.col("n_regionkey"), F.lit(" Region St")).alias("address")
    )
    rows = t.table("supplier").select("s_suppkey", F.concat(F.lit("NATION_"), "s_nationkey").alias("venue"))
    return lookup.venue_address(rows, known, ["s_suppkey"])


# Merge -------------------------------------------------------------------------------------------


def _merged_picks(t: Tables) -> DataFrame:
    return merge.merge_picks(t.pick(), t.occurrence(), t.annotation())


def _merged_mentions(t: Tables) -> DataFrame:
    return merge.merge_mentions(t.mention(), t.occurrence(), t.annotation())


def _listing(t: Tables) -> DataFrame:
    return merge.listing_rows(t.occurrence(), t.annotation())


def _tables(t: Tables) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The merged listing, picks and mentions, each written once, as the weekly plan does."""
    return (
        through_table(_listing(t), "listing"), through_table(_merged_picks(t), "picks"), through_table(_merged_mentions(t), "mentions")
    )


def _flagged(t: Tables) -> DataFrame:
    return ranking.flag_chosen(_listing(t), _merged_picks(t), _merged_mentions(t))


@query("merge_top3", "SELECT * FROM merged_pick", ["merged_pick"])
def merge_top3(t: Tables) -> DataFrame:
    return _merged_picks(t)


@query("merge_mentions", "SELECT * FROM merged_mention", ["merged_mention"])
def merge_mentions(t: Tables) -> DataFrame:
    return _merged_mentions(t)


@query(
    "merge_events",
    """
    SELECT *, row_number() OVER (PARTITION BY week, day ORDER BY category_ord, untimed, minute, ord) - 1 AS listing_pos
    FROM merged_event""",
    ["merged_event"],
)
def merge_events(t: Tables) -> DataFrame:
    return merge.merge_events(t.occurrence(), t.annotation())


_VIOLATIONS = """
    SELECT 'merge' AS "check", 'fail' AS severity, week, day, id, 'pick: ' || problem AS message FROM resolved_pick WHERE problem IS NOT NULL
    UNION ALL
    SELECT 'merge', 'fail', week, day, id, 'mention: ' || problem FROM resolved_mention WHERE problem IS NOT NULL
    UNION ALL
    SELECT 'merge', CASE WHEN p = 'id matches no candidate' THEN 'warn' ELSE 'fail' END, week, day, id, 'annotation: ' || p FROM (
      SELECT a.*, CASE WHEN a.category IS NULL THEN 'missing required field category'
                       WHEN a.category = 'Misc' THEN 'category is not one of the nine' WHEN c.id IS NULL THEN 'id matches no candidate'
                       WHEN c.date <> a.day THEN 'belongs to another day' END AS p
      FROM latest a LEFT JOIN occurrence c ON c.week = a.week AND c.id = a.id) WHERE p IS NOT NULL"""


@query("merge_violations", _VIOLATIONS, ["resolved_pick", "resolved_mention", "latest", "occurrence"])
def merge_violations(t: Tables) -> DataFrame:
    return merge.violations(t.occurrence(), t.annotation(), t.pick(), t.mention())


# Matching ----------------------------------------------------------------------------------------


_COMPARABLE = r"lower(rtrim(regexp_replace({}, '\(SOLD OUT\)\s*$', '')))"


@query(
    "fuzzy_match",
    f"""
    WITH top AS (SELECT p_brand AS brand, p_name, row_number() OVER (PARTITION BY p_brand ORDER BY p_retailprice DESC, p_partkey) AS nth FROM part),
    m AS (SELECT brand, CAST(nth AS INT) AS nth, p_name || CASE WHEN nth > 1 THEN ' (SOLD OUT)' ELSE '' END AS title FROM top WHERE nth <= 3),
    t AS (SELECT p_brand AS brand, p_name AS listed, min(p_partkey) AS pos FROM part GROUP BY ALL),
    pairs AS (
      SELECT m.*, listed, pos, listed = title AS same,
             CASE WHEN listed = title THEN 1 ELSE 1 - levenshtein({_COMPARABLE.format('title')}, {_COMPARABLE.format('listed')})::DOUBLE
               / greatest(length({_COMPARABLE.format('title')}), length({_COMPARABLE.format('listed')}), 1)::DOUBLE END AS score
      FROM m JOIN t USING (brand)),
    best AS (SELECT * FROM pairs WHERE score >= 0.6 QUALIFY row_number() OVER (PARTITION BY brand, nth ORDER BY same DESC, score DESC, pos) = 1)
    SELECT m.brand, m.nth, m.title, b.listed AS hit_matched, b.score FROM m LEFT JOIN best b USING (brand, nth)""",
)
def fuzzy_match(t: Tables) -> DataFrame:
    """The three dearest parts of each brand, marked sold out, matched back to the brand's other names."""
    from pyspark.sql import Window

    parts = t.table("part").select(
        F.col("p_brand").alias("brand"), F.col("p_name").alias("title"), F.col("p_partkey").alias("pos"), "p_retailprice"
    )
    dearest = Window.partitionBy("brand").orderBy(F.col("p_retailprice").desc(), "pos")
    top = parts.withColumn("nth", F.row_number().over(dearest)).where(F.col("nth") <= 3)
    sold_out = F.when(F.col("nth") > 1, F.concat("title", F.lit(" (SOLD OUT)"))).otherwise(F.col("title"))
    mentions = top.select("brand", "nth", sold_out.alias("title"))
    return matching.match_mentions(mentions, parts.withColumn("matched", F.col("title")), ["brand"], ["matched"])


@query("artist_lookup", "SELECT * FROM looked_up", ["looked_up", "part_title"])
def artist_lookup(t: Tables) -> DataFrame:
    return matching.lookup_names(t.part_titles(), t.catalogue())


@query(
    "match_rate",
    """
    SELECT kind, count(*) AS titles, count(spotify_url) AS matched, round(count(spotify_url) / count(*), 4) AS rate
    FROM (SELECT DISTINCT kind, title FROM part_title) JOIN looked_up USING (title) GROUP BY kind""",
    ["looked_up", "part_title"],
)
def match_rate(t: Tables) -> DataFrame:
    titles = t.part_titles()
    return analytics.match_rate(titles, matching.lookup_names(titles, t.catalogue()), "kind")


# Quality -----------------------------------------------------------------------------------------


def _issue_sql(check: str, severity: str, entity: str, message: str, source: str, day: str = "NULL") -> str:
    return (
        f"SELECT '{check}' AS \"check\", '{severity}' AS severity, CAST(week AS VARCHAR) AS week, CAST({day} AS VARCHAR) AS day, "
        f"CAST({entity} AS VARCHAR) AS entity, {message} AS message FROM {source}"
    )


_PROVENANCE = (
    _issue_sql(
        "provenance", "fail", "NULL", "n || ' source files share the collected_at ' || collected_at",
        "(SELECT week, collected_at, count(*) AS n FROM stamps GROUP BY ALL HAVING count(*) > 1)",
    )
    + " UNION ALL "
    + _issue_sql(
        "provenance", "fail", "source", "'collected_at ' || collected_at || ' is outside the run'",
        "stamps WHERE stamped_at NOT BETWEEN CAST(week + INTERVAL 1 MONTH AS TIMESTAMP) AND CAST(year(week) || '-11-30 12:00:00' AS TIMESTAMP)",
    )
)


@query("provenance", _PROVENANCE, ["stamps"])
def provenance(t: Tables) -> DataFrame:
    return quality.provenance(t.order_stamps(), t.order_runs())


@query(
    "shared_stamp_sources",
    """
    SELECT week, collected_at, source, count(*) OVER (PARTITION BY week, collected_at) AS n_sources FROM stamps
    QUALIFY n_sources > 1""",
    ["stamps"],
)
def shared_stamp_sources(t: Tables) -> DataFrame:
    return quality.shared_stamp_sources(t.order_stamps())


TOTAL_FLOOR = 2_400


_YIELD = (
    _issue_sql(
        "yield_floor", "fail", "source", "'wrote ' || events || ' events, below floor ' || min_expected",
        "(SELECT * FROM manifest JOIN floors USING (source) WHERE status = 'ok' AND min_expected > 0 AND events < min_expected)",
    )
    + " UNION ALL "
    + _issue_sql(
        "yield_floor", "fail", "NULL", f"'total events ' || total || ' below whole-run floor {TOTAL_FLOOR}'",
        f"(SELECT week, CAST(sum(coalesce(events, 0)) AS BIGINT) AS total FROM manifest GROUP BY week) WHERE total < {TOTAL_FLOOR}",
    )
)


@query("yield_floor", _YIELD, ["manifest", "floors"])
def yield_floor(t: Tables) -> DataFrame:
    return quality.yield_floor(t.manifest(), t.floors(), TOTAL_FLOOR)


_AGREEMENT = _issue_sql(
    "file_agreement", "fail", "source", "problem",
    """(SELECT coalesce(d.week, f.week) AS week, coalesce(d.source, f.source) AS source,
         CASE WHEN d.source IS NULL THEN 'source file has no manifest entry'
              WHEN f.source IS NULL THEN 'manifest entry without a source file'
              WHEN d.status = 'ok' AND d.events <> f.n
                THEN 'manifest claims ' || d.events || ' events but the file holds ' || f.n END AS problem
       FROM (SELECT CAST(date_trunc('year', o_orderdate) AS DATE) AS week, o_orderkey AS source,
                    CASE WHEN o_orderstatus = 'F' THEN 'failed' ELSE 'ok' END AS status, month(o_orderdate) // 2 + 1 AS events
             FROM orders WHERE o_orderstatus <> 'P') d
       FULL JOIN (SELECT CAST(date_trunc('year', o_orderdate) AS DATE) AS week, l_orderkey AS source, count(*) AS n
                  FROM lineitem JOIN orders ON o_orderkey = l_orderkey GROUP BY ALL) f ON f.source = d.source) WHERE problem IS NOT NULL""",
)


@query("manifest_agreement", _AGREEMENT)
def manifest_agreement(t: Tables) -> DataFrame:
    return quality.manifest_agreement(t.declared_orders(), t.order_files())


@query(
    "snapshot_regression",
    _issue_sql(
        "non_destructive", "fail", "source", "'this run wrote 0 events, the prior version had ' || n",
        """(SELECT week, user_id AS source, count(*) AS n, count(*) FILTER (event_type = 'purchase') AS now
            FROM occurrence GROUP BY ALL) WHERE now = 0""",
    ),
    ["occurrence"],
)
def snapshot_regression(t: Tables) -> DataFrame:
    """Prior snapshot: all events of a user's week. Current snapshot: its purchases only."""
    def counted(df: DataFrame) -> DataFrame:
        return df.groupBy("week", F.col("user_id").cast("string").alias("source")).agg(F.count(F.lit(1)).alias("n_events"))

    rows = t.occurrence()
    return quality.snapshot_regression(counted(rows.where(F.col("event_type") == "purchase")), counted(rows))


_VENUE_HEAD = S.strip("split_part(venue, ',', 1)")
_VENUE_KEY = f"CASE WHEN coalesce(address, '') <> '' THEN lower({S.strip('address')}) ELSE lower({_VENUE_HEAD}) END"

CHECK_SQL = {
    "check_venue_cap": _issue_sql(
        "venue_cap", "warn", "venue_key", "'took ' || n || ' pick slots this week (cap 2)'",
        f"(SELECT week, {_VENUE_KEY} AS venue_key, count(*) AS n FROM merged_pick GROUP BY ALL HAVING count(*) > 2)",
    ),
    "check_time_format": _issue_sql(
        "time_format", "warn", "title", "'not a single clock time: ' || time",
        r"merged_pick WHERE NOT regexp_full_match(time, '\d{1,2}:\d{2} [AP]M')", "day",
    ),
    "check_cost_blank": _issue_sql(
        "cost_blank", "warn", "title", "'listed event has a blank cost'", "occurrence WHERE trim(cost) = ''", "date"
    ),
    "check_implausible": _issue_sql(
        "implausible_time", "warn", "title", "'starts at ' || time", f"merged_pick WHERE ({S.minutes('time')}) < 360", "day"
    ),
}


@query("check_venue_cap", CHECK_SQL["check_venue_cap"], ["merged_pick"])
def check_venue_cap(t: Tables) -> DataFrame:
    return quality.venue_cap(_merged_picks(t))


@query("check_time_format", CHECK_SQL["check_time_format"], ["merged_pick"])
def check_time_format(t: Tables) -> DataFrame:
    return quality.time_format(_merged_picks(t))


@query("check_cost_blank", CHECK_SQL["check_cost_blank"], ["occurrence"])
def check_cost_blank(t: Tables) -> DataFrame:
    """Raw listings, whose costs were not defaulted yet."""
    return quality.cost_blank(_merged_picks(t), t.occurrence().withColumn("day", F.col("date")))


@query("check_implausible", CHECK_SQL["check_implausible"], ["merged_pick"])
def check_implausible(t: Tables) -> DataFrame:
    return quality.implausible_time(_merged_picks(t))


@query(
    "check_same_series",
    _issue_sql(
        "same_series", "warn", "venue_key", "n || ' picks share the title prefix ' || prefix",
        """(SELECT p_size AS week, lower(p_type) AS venue_key, lower(p_brand) AS prefix, count(*) AS n FROM part GROUP BY ALL HAVING count(*) > 1)""",
    ),
)
def check_same_series(t: Tables) -> DataFrame:
    """Parts as picks: '<brand>: <name>' at the venue of their type, sizes as weeks."""
    return quality.same_series(
        t.table("part").select(
            F.col("p_size").alias("week"),
            F.lit("").alias("address"),
            F.concat("p_type", F.lit(", back room")).alias("venue"),
            F.concat("p_brand", F.lit(": "), "p_name").alias("title"),
        )
    )


@query(
    "venue_cap_members",
    f"""
    SELECT week, {_VENUE_KEY} AS venue_key, day, rank, title, n
    FROM (SELECT *, count(*) OVER (PARTITION BY week, {_VENUE_KEY}) AS n FROM merged_pick) WHERE n > 2""",
    ["merged_pick"],
)
def venue_cap_members(t: Tables) -> DataFrame:
    return quality.venue_cap_members(through_table(_merged_picks(t), "picks"))


@query(
    "near_title_members",
    """
    WITH b AS (SELECT DISTINCT o_orderpriority AS venue, lower(o_orderstatus || ' ' || o_custkey) AS bare,
                      CASE WHEN o_orderkey % 2 = 0 THEN 'Club: ' ELSE '' END || o_orderstatus || ' ' || o_custkey AS title, DATE '2024-01-01' AS week FROM orders)
    SELECT * FROM (SELECT *, count(*) OVER (PARTITION BY week, venue, bare) AS n FROM b) WHERE n > 1""",
)
def near_title_members(t: Tables) -> DataFrame:
    """Orders as shows of a customer, every other one announced by a club."""
    name = F.concat("o_orderstatus", F.lit(" "), "o_custkey")
    rows = t.table("orders").select(
        F.lit("2024-01-01").cast("date").alias("week"), F.col("o_orderpriority").alias("venue"),
        F.concat(F.when(F.col("o_orderkey") % 2 == 0, "Club: ").otherwise(""), name).alias("title"),
    )
    return quality.near_title_members(rows)


@query(
    "near_title_dupes",
    _issue_sql(
        "near_titles", "warn", "venue", "n || ' titles differ only by a prefix: ' || bare",
        """(SELECT 'all' AS week, p_brand AS venue, p_name AS bare, count(DISTINCT CASE WHEN p_retailprice < 950 THEN p_name ELSE p_brand || ': ' || p_name END) AS n
            FROM part GROUP BY ALL) WHERE n > 1""",
    ),
)
def near_title_dupes(t: Tables) -> DataFrame:
    """Parts as listings; the dearer ones carry their brand as a prefix."""
    name = F.when(F.col("p_retailprice") < 950, F.col("p_name")).otherwise(F.concat("p_brand", F.lit(": "), "p_name"))
    return quality.near_titles(
        t.table("part").select(F.lit("all").alias("week"), F.col("p_brand").alias("venue"), name.alias("title"))
    )


@query(
    "near_title_edits",
    """
    WITH r AS (SELECT DISTINCT p_size AS week, p_brand AS venue, lower(trim(p_name)) AS title FROM part)
    SELECT a.week, a.venue, a.title, b.title AS near_title, CAST(levenshtein(a.title, b.title) AS INT) AS edits
    FROM r a JOIN r b ON a.week = b.week AND a.venue = b.venue AND a.title < b.title WHERE levenshtein(a.title, b.title) <= 2""",
)
def near_title_edits(t: Tables) -> DataFrame:
    """Parts as listings of their brand, sizes as weeks."""
    rows = t.table("part").select(F.col("p_size").alias("week"), F.col("p_brand").alias("venue"), F.col("p_name").alias("title"))
    return quality.near_edits(rows, 2)


@query(
    "stamps_outside_runs",
    _issue_sql(
        "provenance", "fail", "source", "'collected_at ' || collected_at || ' is in no run of its week'",
        """stamps WHERE NOT (stamped_at BETWEEN CAST(week + INTERVAL 1 MONTH AS TIMESTAMP) AND CAST(year(week) || '-05-15 10:30:00' AS TIMESTAMP)
           OR stamped_at BETWEEN CAST(year(week) || '-05-15 10:00:00' AS TIMESTAMP) AND CAST(year(week) || '-06-30 15:00:00' AS TIMESTAMP)
           OR stamped_at BETWEEN CAST(year(week) || '-09-01 00:00:00' AS TIMESTAMP) AND CAST(year(week) || '-11-30 12:00:00' AS TIMESTAMP))""",
    ),
    ["stamps"],
)
def stamps_outside_runs(t: Tables) -> DataFrame:
    """Orders as source files, three runs a year of which two overlap."""
    year = F.year("week").cast("string")
    spans = [("-02-01T00:00:00", "-05-15T10:30:00Z"), ("-05-15T10:00:00", "-06-30T15:00:00Z"), ("-09-01T00:00:00", "-11-30T12:00:00Z")]
    span = F.array(*(F.struct(F.concat(year, F.lit(a)).alias("run_started"), F.concat(year, F.lit(b)).alias("run_completed")) for a, b in spans))
    runs = t.order_runs().select("week", F.inline(span))
    return quality.outside_runs(t.order_stamps(), runs)


@query(
    "check_claims",
    _issue_sql(
        "implausible_claim", "warn", "title", "problem",
        """(SELECT CAST(date_trunc('week', o_orderdate) AS DATE) AS week, o_orderdate, title, cost, CASE
              WHEN o_totalprice > 400000 THEN 'cost looks like a budget'
              WHEN o_orderstatus = 'F' AND month(o_orderdate) <> 10 THEN 'halloween in another month' END AS problem
            FROM (SELECT *, CASE o_orderstatus WHEN 'F' THEN 'Halloween ball ' ELSE 'Ball ' END || o_orderkey AS title, '' AS cost FROM orders)) WHERE problem IS NOT NULL""",
        "CAST(o_orderdate AS DATE)",
    ),
)
def check_claims(t: Tables) -> DataFrame:
    day = F.to_date("o_orderdate")
    name = F.when(F.col("o_orderstatus") == "F", "Halloween ball ").otherwise("Ball ")
    cost = F.when(F.col("o_totalprice") > 400_000, "$4M").otherwise(F.concat(F.lit("$"), "o_totalprice"))
    return quality.implausible_claims(
        t.table("orders").select(
            clock.week_of(day).alias("week"), day.cast("string").alias("date"), F.concat(name, "o_orderkey").alias("title"), cost.alias("cost")
        )
    )


@query(
    "check_star_resolves",
    _issue_sql(
        "star_resolves", "warn", "title", "'pick title is not in the day''s listing'",
        """(SELECT p.week, p.day, p.title FROM merged_mention p WHERE NOT EXISTS (
              SELECT 1 FROM merged_event e WHERE e.week = p.week AND e.day = p.day AND e.title = p.title))""",
        "day",
    ),
    ["merged_mention", "merged_event"],
)
def check_star_resolves(t: Tables) -> DataFrame:
    """Mentions against the listing: a sold-out suffix is a title the listing does not hold."""
    return quality.star_resolves(_merged_mentions(t), _listing(t))


@query(
    "check_star_picks",
    _issue_sql(
        "star_resolves", "warn", "title", "'pick title is not in the day''s listing'",
        """(SELECT p.week, p.day, p.title FROM merged_pick p WHERE NOT EXISTS (
              SELECT 1 FROM merged_event e WHERE e.week = p.week AND e.day = p.day AND e.title = p.title))""",
        "day",
    ),
    ["merged_pick", "merged_event"],
)
def check_star_picks(t: Tables) -> DataFrame:
    return quality.star_resolves(_merged_picks(t), _listing(t))


@query(
    "suite_verdicts",
    f"""
    SELECT w.week, suite, coalesce(n_fail, 0) AS n_fail, coalesce(n_warn, 0) AS n_warn, coalesce(n_fail, 0) = 0 AS passed
    FROM (SELECT DISTINCT CAST(week AS VARCHAR) AS week FROM occurrence) w
    CROSS JOIN (VALUES ('collection'), ('merge'), ('selection')) s(suite)
    LEFT JOIN (
      SELECT week, suite, count(*) FILTER (severity = 'fail') AS n_fail, count(*) FILTER (severity = 'warn') AS n_warn FROM (
        SELECT week, severity, 'collection' AS suite FROM ({_YIELD})
        UNION ALL SELECT week, 'fail', 'collection' FROM (
          SELECT CAST(week AS VARCHAR) AS week, count(*) FILTER (event_type = 'purchase') AS now FROM occurrence GROUP BY week, user_id) WHERE now = 0
        UNION ALL SELECT CAST(week AS VARCHAR), severity, 'merge' FROM ({_VIOLATIONS})
        UNION ALL SELECT week, severity, 'selection' FROM ({CHECK_SQL['check_venue_cap']})
        UNION ALL SELECT week, severity, 'selection' FROM ({CHECK_SQL['check_time_format']})
        UNION ALL SELECT week, severity, 'selection' FROM ({CHECK_SQL['check_implausible']})
        UNION ALL SELECT CAST(p.week AS VARCHAR), 'warn', 'selection' FROM merged_pick p WHERE NOT EXISTS (
          SELECT 1 FROM merged_event e WHERE e.week = p.week AND e.day = p.day AND e.title = p.title)) GROUP BY week, suite) f
    USING (week, suite)""",
    ["merged_pick", "merged_event", "resolved_pick", "resolved_mention", "latest", "occurrence", "manifest", "floors"],
)
def suite_verdicts(t: Tables) -> DataFrame:
    """Pass or fail of the collection, merge and selection suites of every week."""
    def counted(df: DataFrame) -> DataFrame:
        return df.groupBy("week", F.col("user_id").cast("string").alias("source")).agg(F.count(F.lit(1)).alias("n_events"))

    listing, picks, _ = _tables(t)
    rows = t.occurrence()
    broken = merge_violations(t).select(
        "check", "severity", F.col("week").cast("string").alias("week"), "day", F.col("id").alias("entity"), "message"
    )
    found = (
        quality.full_selection_issues(picks, listing)
        .unionByName(quality.yield_floor(t.manifest(), t.floors(), TOTAL_FLOOR))
        .unionByName(quality.snapshot_regression(counted(rows.where(F.col("event_type") == "purchase")), counted(rows)))
        .unionByName(broken)
    )
    return quality.verdicts(found, rows.select("week"))


@query(
    "issue_report",
    f"""
    SELECT "check", severity, count(*) AS n FROM (
      {CHECK_SQL['check_venue_cap']} UNION ALL {CHECK_SQL['check_time_format']} UNION ALL {CHECK_SQL['check_implausible']}
      UNION ALL SELECT "check", severity, CAST(week AS VARCHAR), day, id, message FROM ({_VIOLATIONS})
      UNION ALL {_YIELD}) GROUP BY ALL""",
    ["merged_pick", "resolved_pick", "resolved_mention", "latest", "occurrence", "manifest", "floors"],
)
def issue_report(t: Tables) -> DataFrame:
    listing, picks, _ = _tables(t)
    found = quality.selection_issues(picks, listing).unionByName(
        quality.yield_floor(t.manifest(), t.floors(), TOTAL_FLOOR)
    )
    broken = merge_violations(t).select(
        "check", "severity", F.col("week").cast("string").alias("week"), "day", F.col("id").alias("entity"), "message"
    )
    return quality.summary(found.unionByName(broken))


# Report ------------------------------------------------------------------------------------------


@query(
    "mention_line",
    """
    SELECT week, day, string_agg(replace(title, '(SOLD OUT)', '(<strong>SOLD OUT</strong>)') || ' at ' || venue, ' · ' ORDER BY pos) AS line
    FROM merged_mention GROUP BY week, day""",
    ["merged_mention"],
)
def mention_line(t: Tables) -> DataFrame:
    return report.mention_line(_merged_mentions(t))


def _shown_time(time: str, note: str) -> str:
    return (
        f"CASE WHEN {S.placeholder(time)} OR ({S.unwrap(time)}) = '' THEN 'Various' ELSE ({S.unwrap(time)}) || "
        f"CASE WHEN contains(lower(coalesce({note}, '')), 'multiple showtimes') THEN '+' ELSE '' END END"
    )


@query(
    "pick_cards",
    f"""
    SELECT week, day, rank, CASE WHEN m THEN substring(title, 1, 1) ELSE '' END AS link_before, CASE WHEN m THEN matched_text ELSE title END AS link_text,
           CASE WHEN m THEN substring(title, 5) ELSE '' END AS link_after, CASE WHEN m THEN spotify_url ELSE url END AS link_url, why, venue,
           concat_ws(' · ', {_shown_time('time', "''")}, nullif({S.unwrap('cost')}, '')) AS time_cost
    FROM (SELECT *, matched_text IS NOT NULL AS m FROM linked_pick)""",
    ["linked_pick"],
)
def pick_cards(t: Tables) -> DataFrame:
    return report.pick_cards(_merged_picks(t), t.music_lookup())


@query(
    "display_cap",
    f"""
    SELECT week, day, category, category_ord, CAST(card AS INT) AS card, id, title, url AS link_url, is_pick AS starred, note, venue, {_shown_time('time', 'note')} AS time_display,
           CASE WHEN sold_out THEN 'sold-out' WHEN lower({S.unwrap('cost')}) IN ('free', 'no cover') THEN 'price-free' ELSE 'price-paid' END AS price_class,
           CASE WHEN sold_out THEN 'SOLD OUT' ELSE {S.unwrap('cost')} END AS price_text, true_count
    FROM carded WHERE card <= 10""",
    ["carded"],
)
def display_cap(t: Tables) -> DataFrame:
    return report.category_cards(_listing(t), _merged_picks(t), _merged_mentions(t))


@query(
    "annotation_cap",
    "SELECT week, day, category, id, is_pick, is_mention FROM carded WHERE card <= 10 OR is_pick OR is_mention",
    ["carded"],
)
def annotation_cap(t: Tables) -> DataFrame:
    return ranking.annotation_cap(_flagged(t)).select("week", "day", "category", "id", "is_pick", "is_mention")


_END = "CASE category " + " ".join(f"WHEN '{n}' THEN {m}" for n, _, m in fixed.CATEGORIES) + " ELSE 120 END"
_ISO = lambda c: (
    f"strftime({c}, '%Y-%m-%dT%H:%M:%S') || CASE WHEN date_diff('minute', {c}, timezone('UTC', timezone('America/New_York', {c}))) > 0 THEN '-' ELSE '+' END || "
    f"strftime(TIMESTAMP '2000-01-01 00:00:00' + to_minutes(CAST(abs(date_diff('minute', {c}, timezone('UTC', timezone('America/New_York', {c})))) AS INT)), '%H:%M')"
)


@query(
    "calendar_rows",
    f"""
    SELECT week, day, title AS summary, {_ISO('s')} AS start, {_ISO('e')} AS "end",
           concat_ws(chr(10) || chr(10), why, CASE WHEN cost <> '' AND NOT {S.placeholder('cost')} THEN 'Cost: ' || cost END, nullif(url, '')) AS description,
           address AS location
    FROM (SELECT *, s + to_minutes({_END}) AS e FROM (
      SELECT *, CAST(day AS TIMESTAMP) + to_minutes({S.minutes(f"({S.unwrap('time')})")}) AS s FROM merged_pick)) WHERE s IS NOT NULL""",
    ["merged_pick"],
)
def calendar_rows(t: Tables) -> DataFrame:
    return report.calendar_rows(_merged_picks(t))


@query(
    "calendar_counts",
    f"""
    SELECT week, count(m) AS created, count(*) - count(m) AS skipped
    FROM (SELECT week, {S.minutes(f"({S.unwrap('time')})")} AS m FROM merged_pick) GROUP BY week""",
    ["merged_pick"],
)
def calendar_counts(t: Tables) -> DataFrame:
    return report.calendar_counts(_merged_picks(t))


@query(
    "week_index",
    """
    SELECT DISTINCT week, CASE WHEN month(week) = month(week + 6) THEN strftime(week, '%B %-d') || '–' || strftime(week + 6, '%-d, %Y')
           ELSE strftime(week, '%B %-d') || ' – ' || strftime(week + 6, '%B %-d, %Y') END AS label FROM occurrence""",
    ["occurrence"],
)
def week_index(t: Tables) -> DataFrame:
    return report.week_index(t.occurrence())


@query(
    "selections_nested",
    """
    WITH l AS (SELECT *, row_number() OVER (PARTITION BY week, day ORDER BY category_ord, untimed, minute, ord) - 1 AS listing_pos FROM merged_event),
    e AS (SELECT week, day, CAST(listing_pos // 1000 AS INT) AS page, string_agg(title || '@' || venue || '@' || time, '|' ORDER BY listing_pos) AS events
          FROM l GROUP BY ALL),
    p AS (SELECT week, day, string_agg(rank || ' ' || title, '|' ORDER BY rank) AS top3 FROM merged_pick GROUP BY ALL),
    m AS (SELECT week, day, string_agg(title, '|' ORDER BY pos) AS mentions FROM merged_mention GROUP BY ALL),
    h AS (SELECT week, day, 0 AS page, top3, mentions FROM p FULL JOIN m USING (week, day))
    SELECT week, day, page, strftime(CAST(day AS DATE), '%A') AS day_name, top3, mentions, events FROM e FULL JOIN h USING (week, day, page)""",
    ["merged_event", "merged_pick", "merged_mention"],
)
def selections_nested(t: Tables) -> DataFrame:
    """The nested pages, arrays joined to text so both engines print them alike."""
    pages = report.day_pages(_merged_picks(t), _merged_mentions(t), merge_events(t))
    return pages.select(
        "week", "day", "page", "day_name",
        F.array_join(F.transform("top3", lambda p: F.concat(p["rank"], F.lit(" "), p["title"])), "|").alias("top3"),
        F.array_join(F.transform("honorable_mentions", lambda m: m["title"]), "|").alias("mentions"),
        F.array_join(F.transform("events", lambda e: F.concat_ws("@", e["title"], e["venue"], e["time"])), "|").alias("events"),
    )


_ATTENDED_WEEK = "1998-06-01"


@query(
    "attendance",
    f"""
    WITH log AS (
      SELECT CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH', '3-MEDIUM') THEN 'Philadelphia' ELSE 'Camden' END AS city,
             CAST(CAST(date_trunc('week', o_orderdate) AS DATE) AS VARCHAR) AS week_of, strftime(o_orderdate, '%Y-%m-%d') AS date,
             'Customer#' || lpad(CAST(o_custkey AS VARCHAR), 9, '0') AS title, 'Hall ' || o_orderkey AS venue, '1' AS rank, '' AS attended FROM orders)
    SELECT * REPLACE (CASE WHEN city = 'Philadelphia' AND week_of = '{_ATTENDED_WEEK}'
                      THEN CASE WHEN title IN (SELECT c_name FROM customer WHERE c_acctbal > 0) THEN 'true' ELSE 'false' END ELSE attended END AS attended)
    FROM log""",
)
def attendance(t: Tables) -> DataFrame:
    """Orders as the log, customers in credit as the titles that stayed in the calendar."""
    city = F.when(F.col("o_orderpriority").isin("1-URGENT", "2-HIGH", "3-MEDIUM"), fixed.CITY).otherwise("Camden")
    day = F.to_date("o_orderdate")
    log = t.table("orders").select(
        city.alias("city"),
        clock.week_of(day).cast("string").alias("week_of"),
        day.cast("string").alias("date"),
        F.format_string("Customer#%09d", "o_custkey").alias("title"),
        F.concat(F.lit("Hall "), "o_orderkey").alias("venue"),
        F.lit("1").alias("rank"),
        F.lit("").alias("attended"),
    )
    held = t.table("customer").where(F.col("c_acctbal") > 0).select(F.col("c_name").alias("title"))
    return picks_log.update_attendance(log, held, _ATTENDED_WEEK)


# Usage -------------------------------------------------------------------------------------------


def _usage_totals(t: Tables) -> DataFrame:
    return usage.totals(usage.latest_readings(t.usage_lines()))


@query("usage_dedupe", "SELECT * FROM reading", ["reading"])
def usage_dedupe(t: Tables) -> DataFrame:
    return usage.latest_readings(t.usage_lines())


_SUM = "input_tokens + cache_creation_input_tokens + cache_read_input_tokens + output_tokens"


@query(
    "usage_report",
    f"""
    SELECT *, CASE WHEN scope = 'agent' AND agent <> 'RO' THEN 'type ' || substring(agent, 1, 1) ELSE '' END AS agent_type,
           CASE WHEN scope = 'agent' AND agent <> 'RO' THEN 'ships ' || session ELSE '' END AS description, {_SUM} AS total_tokens
    FROM usage_total""",
    ["usage_total"],
)
def usage_report(t: Tables) -> DataFrame:
    return usage.ordered(usage.report(usage.latest_readings(t.usage_lines()), t.agents()))


@query(
    "usage_weighted",
    """
    SELECT *, round(input_tokens * 1.0::DOUBLE + cache_creation_input_tokens * 1.25::DOUBLE + cache_read_input_tokens * 0.1::DOUBLE
                    + output_tokens * 5.0::DOUBLE, 2) AS weighted_units FROM usage_total""",
    ["usage_total"],
)
def usage_weighted(t: Tables) -> DataFrame:
    return usage.weighted(_usage_totals(t))


# Ranking -----------------------------------------------------------------------------------------

_SCORED = """
    SELECT week, date AS day, id, ord, CASE WHEN coalesce(address, '') <> '' THEN lower(address) ELSE lower(split_part(venue, ',', 1)) END AS venue_key,
           k % 3 + 1 AS tier, event_type = 'signup' AS easy_to_miss, event_type = 'purchase' AS community, CAST(value AS INT) // 50 AS overlap,
           cost = 'Free' AS free, k > 80 AS recurring, user_id < 10 AS elevated
    FROM (SELECT *, '' AS address FROM occurrence)"""
_PRECEDENCE = "tier, easy_to_miss DESC, community DESC, overlap DESC, free DESC, recurring, elevated DESC, ord"


def _scored(t: Tables) -> DataFrame:
    kind = F.col("event_type")
    return t.occurrence().select(
        "week",
        F.col("date").alias("day"),
        "id",
        "ord",
        text.venue_key(F.lit(""), F.col("venue")).alias("venue_key"),
        (F.col("k") % 3 + 1).alias("tier"),
        (kind == "signup").alias("easy_to_miss"),
        (kind == "purchase").alias("community"),
        F.floor(F.round("value") / 50).cast("int").alias("overlap"),
        (F.col("cost") == "Free").alias("free"),
        (F.col("k") > 80).alias("recurring"),
        (F.col("user_id") < 10).alias("elevated"),
    )


@query(
    "top3_per_day",
    f"""
    WITH s AS ({_SCORED}),
    v AS (SELECT *, row_number() OVER (PARTITION BY week, venue_key ORDER BY {_PRECEDENCE}) AS nth FROM s),
    d AS (SELECT *, row_number() OVER (PARTITION BY week, day ORDER BY {_PRECEDENCE}) AS place FROM v WHERE nth <= 2)
    SELECT week, day, CAST(place AS INT) AS place, CASE WHEN place <= 3 THEN 'pick' ELSE 'mention' END AS kind, id, venue_key FROM d WHERE place <= 6""",
    ["occurrence"],
)
def top3_per_day(t: Tables) -> DataFrame:
    return ranking.daily_picks(_scored(t)).select("week", "day", "place", "kind", "id", "venue_key")


def _listed_documents(t: Tables) -> DataFrame:
    """Listings as candidates, one in three languages at an elevated venue."""
    venue = F.when(F.col("venue") == "fr", "Iffy Books, back room").otherwise(F.concat("venue", F.lit(" hall, main room")))
    return t.listing().select(
        "week", "date", F.concat(F.lit("d"), "pos").alias("id"), F.col("pos").alias("ord"), "title", "description", venue.alias("venue"),
        F.when(F.col("source") == "src6", "No cover").otherwise(F.col("cost")).alias("cost"), "url", "source",
        F.when(F.col("source") == "src8", fixed.COMMUNITY).otherwise(fixed.CATEGORIES[0][0]).alias("category"),
        F.when(F.col("source") == "src11", 3).alias("recurrence_count"),
    )


_SCORED_DOCUMENTS = """
    WITH hits AS (SELECT DISTINCT l.pos, b.item_id % 14 AS i
                  FROM (SELECT pos, unnest(regexp_extract_all(lower(title || ' ' || description), '[\\pL\\pN]+')) AS term FROM listing) l
                  JOIN bench_words b USING (term)),
    t AS (SELECT pos, min(i % 3 + 1) AS tier, count(*) AS overlap FROM hits GROUP BY pos),
    scored AS (
      SELECT week, date AS day, 'd' || l.pos AS id, l.pos AS ord, CASE WHEN venue = 'fr' THEN 'iffy books' ELSE venue || ' hall' END AS venue_key,
             CAST(coalesce(tier, 4) AS INT) AS tier, source <> 'src0' AS easy_to_miss, source = 'src8' AS community,
             CAST(coalesce(overlap, 0) AS INT) AS overlap, source = 'src6' AS free, source = 'src11' AS recurring, venue = 'fr' AS elevated,
             CASE WHEN url = '' THEN '*(confirm details)*' END AS unconfirmed
      FROM listing l LEFT JOIN t ON t.pos = l.pos)"""


def _scored_documents(t: Tables) -> DataFrame:
    return ranking.score_candidates(_listed_documents(t), t.interest_lexicon(), ["src0"])


@query("scored_candidates", _SCORED_DOCUMENTS + " SELECT * FROM scored", ["listing", "bench_words"])
def scored_candidates(t: Tables) -> DataFrame:
    return _scored_documents(t)


@query(
    "picks_from_scores",
    _SCORED_DOCUMENTS
    + f""",
    v AS (SELECT *, row_number() OVER (PARTITION BY week, venue_key ORDER BY {_PRECEDENCE}) AS nth FROM scored),
    d AS (SELECT *, row_number() OVER (PARTITION BY week, day ORDER BY {_PRECEDENCE}) AS place FROM v WHERE nth <= 2)
    SELECT week, day, CAST(place AS INT) AS place, id, venue_key, unconfirmed FROM d WHERE place <= 6""",
    ["listing", "bench_words"],
)
def picks_from_scores(t: Tables) -> DataFrame:
    return ranking.daily_picks(_scored_documents(t)).select("week", "day", "place", "id", "venue_key", "unconfirmed")


@query(
    "interest_tags",
    """
    SELECT doc_id, string_agg(DISTINCT printf('i%02d', item_id % 14), ',' ORDER BY printf('i%02d', item_id % 14)) AS interests,
           CAST(count(DISTINCT item_id % 14) AS INT) AS overlap
    FROM words JOIN bench_words USING (term) GROUP BY doc_id""",
    ["words", "bench_words"],
)
def interest_tags(t: Tables) -> DataFrame:
    tags = ranking.interest_tags(t.table("documents"), t.interest_lexicon(), "doc_id", "text")
    return tags.withColumn("interests", F.array_join("interests", ","))


@query(
    "category_vote",
    f"""
    WITH lex AS (SELECT DISTINCT term, item_id % 9 AS c FROM bench_words),
    v AS (SELECT doc_id, c, CAST(sum(n) AS BIGINT) AS votes FROM words JOIN lex USING (term) GROUP BY doc_id, c)
    SELECT doc_id, {S.label_at('c')} AS category, votes FROM v
    QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY votes DESC, c) = 1""",
    ["words", "bench_words"],
)
def category_vote(t: Tables) -> DataFrame:
    return ranking.category_vote(t.table("documents"), t.category_lexicon(), "doc_id", "text")


def _two_halves(t: Tables) -> DataFrame:
    """Documents as annotated listings: languages stand for categories, and the digest of the id deals two halves."""
    half = F.substring(F.md5(F.col("doc_id").cast("string").cast("binary")), 1, 1) < "8"
    return t.table("documents").select("doc_id", "text", F.col("lang").alias("known"), half.alias("half"))


_MODEL_SQL = f"""
    WITH d AS (SELECT doc_id, lang AS known, md5(CAST(doc_id AS VARCHAR))[1] < '8' AS half, lower(coalesce(text, '')) AS text FROM documents),
    w AS (SELECT doc_id, known, half, ('0x' || md5(term)[1:8])::BIGINT % {category_model.BUCKETS} AS b
          FROM (SELECT doc_id, known, half, unnest(regexp_extract_all(text, '[\\pL\\pN]+')) AS term FROM d)),
    n AS (SELECT half, known, b, count(*) AS n FROM w GROUP BY ALL),
    a AS (SELECT half, b, sum(n) AS n FROM n GROUP BY ALL),
    t AS (SELECT half, known, sum(n) AS n FROM n GROUP BY ALL),
    z AS (SELECT half, sum(n) AS n FROM n GROUP BY half),
    k AS (SELECT DISTINCT half, known FROM d),
    wt AS (SELECT k.half, k.known, a.b,
                  -ln((a.n - coalesce(n.n, 0) + 1.0) / (z.n - coalesce(t.n, 0) + {category_model.BUCKETS}.0)) AS weight
           FROM k JOIN a ON a.half = k.half JOIN z ON z.half = k.half
           LEFT JOIN n ON n.half = k.half AND n.known = k.known AND n.b = a.b
           LEFT JOIN t ON t.half = k.half AND t.known = k.known),
    un AS (SELECT k.half, k.known, -ln(1.0 / (z.n - coalesce(t.n, 0) + {category_model.BUCKETS}.0)) AS weight
           FROM k JOIN z ON z.half = k.half LEFT JOIN t ON t.half = k.half AND t.known = k.known),
    s AS (SELECT w.doc_id, w.known, un.known AS category, sum(coalesce(wt.weight, un.weight)) AS score
          FROM w JOIN un ON un.half = NOT w.half
          LEFT JOIN wt ON wt.half = un.half AND wt.known = un.known AND wt.b = w.b GROUP BY ALL),
    e AS (SELECT doc_id, known, (SELECT min(known) FROM k WHERE k.half = NOT d.half) AS category, 0.0 AS score
          FROM d WHERE NOT regexp_matches(text, '[\\pL\\pN]'))
    SELECT doc_id, known, category, round(score, 4) AS score FROM (
      SELECT * FROM s QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY score DESC, category) = 1) UNION ALL SELECT * FROM e"""


@query("category_model", _MODEL_SQL)
def category_model_scores(t: Tables) -> DataFrame:
    """Each half of the listings judged by the model of the other."""
    rows = _two_halves(t)
    model = category_model.fit(rows, "text", "known", ["half"]).withColumn("half", ~F.col("half"))
    found = category_model.predict(rows, model, "text", ["half"])
    return found.select("doc_id", "known", "category", F.round("score", 4).alias("score"))


# Analytics ---------------------------------------------------------------------------------------


@query(
    "funnel",
    S.with_views(["occurrence", "merged_event", "merged_pick"], "").rstrip()
    + ",\n" + ",".join([_collapsed_sql("occurrence", OCCURRENCE_PRIORITY), _FOLDED])
    + """
    SELECT week, r.n AS raw, c.n AS candidates, coalesce(l.n, 0) AS listed, coalesce(p.n, 0) AS picked
    FROM (SELECT week, count(*) AS n FROM occurrence GROUP BY week) r
    JOIN (SELECT week, count(*) AS n FROM folded GROUP BY week) c USING (week)
    LEFT JOIN (SELECT week, count(*) AS n FROM merged_event GROUP BY week) l USING (week)
    LEFT JOIN (SELECT week, count(*) AS n FROM merged_pick GROUP BY week) p USING (week)""",
)
def funnel(t: Tables) -> DataFrame:
    rows = t.occurrence()
    return analytics.funnel(rows, whole_candidates(rows, OCCURRENCE_PRIORITY), _listing(t), _merged_picks(t))


@query(
    "category_share",
    """
    WITH l AS (SELECT week, category, count(*) AS listed FROM merged_event GROUP BY ALL),
    p AS (SELECT week, category, count(*) AS picked FROM merged_pick GROUP BY ALL),
    b AS (SELECT week, category, coalesce(listed, 0) AS listed, coalesce(picked, 0) AS picked FROM l FULL JOIN p USING (week, category))
    SELECT *, round(100.0::DOUBLE * listed / sum(listed) OVER (PARTITION BY week), 4) AS listed_pct,
           round(100.0::DOUBLE * picked / nullif(sum(picked) OVER (PARTITION BY week), 0), 4) AS picked_pct FROM b""",
    ["merged_event", "merged_pick"],
)
def category_share(t: Tables) -> DataFrame:
    return analytics.category_share(_listing(t), _merged_picks(t))


@query(
    "source_share",
    """
    SELECT week, source, count(*) AS n, round(100.0::DOUBLE * count(*) / sum(count(*)) OVER (PARTITION BY week), 4) AS pct
    FROM listing GROUP BY week, source""",
    ["listing"],
)
def source_share(t: Tables) -> DataFrame:
    return analytics.source_share(t.listing())


@query(
    "collection_health",
    """
    SELECT week, count(*) AS n_sources, count(*) FILTER (status = 'ok') AS n_ok, count(*) FILTER (status <> 'ok') AS n_failed,
           CAST(sum(coalesce(events, 0)) AS BIGINT) AS n_events, count(*) FILTER (status = 'ok' AND coalesce(events, 0) = 0) AS n_silent,
           count(*) FILTER (status = 'ok' AND min_expected > 0 AND events < min_expected) AS n_under_floor,
           date_sub('second', min(started), max(completed)) AS run_seconds
    FROM manifest LEFT JOIN floors USING (source) GROUP BY week""",
    ["manifest", "floors"],
)
def collection_health(t: Tables) -> DataFrame:
    return analytics.collection_health(t.manifest(), t.floors())


@query(
    "price_histogram",
    f"""
    SELECT week, {S.price_tier('cost', 'sold_out')} AS tier, CAST(floor({S.dollars('cost')} / 10) AS BIGINT) * 10 AS price_from, count(*) AS n,
           count(*) FILTER (sold_out) AS n_sold_out FROM occurrence GROUP BY ALL""",
    ["occurrence"],
)
def price_histogram(t: Tables) -> DataFrame:
    return analytics.price_histogram(t.occurrence())


@query(
    "merged_sketches",
    f"""
    WITH r AS (SELECT *, {S.dollars('cost')} AS price FROM occurrence)
    SELECT 'listings' AS metric, count(*) AS exact, true AS within FROM r
    UNION ALL SELECT 'distinct listings', count(DISTINCT (title, venue)), true FROM r
    UNION ALL SELECT 'price quantile ' || q, count(price), true FROM r, (VALUES ('0.1'), ('0.5'), ('0.9')) v(q) GROUP BY q""",
    ["occurrence"],
)
def merged_sketches(t: Tables) -> DataFrame:
    """All weeks from the stored sketches of each, held against the exact figures: whether an estimate keeps its bound."""
    rows = t.occurrence().select("week", "title", "venue", "cost")
    stored = through_table(sketches.week_sketches(rows), "sketches")
    quantiles = (0.1, 0.5, 0.9)
    read = sketches.readings(sketches.merged(stored), quantiles)
    estimated = {c: read.select(c).scalar() for c in ("n", "n_distinct", "price_quantiles")}
    known = rows.select(sketches.listing_key().alias("key"), sketches.price().alias("price"), estimated["price_quantiles"].alias("cuts"))
    below = lambda i: F.count_if(F.col("price") < F.get("cuts", F.lit(i)))
    up_to = lambda i: F.count_if(F.col("price") <= F.get("cuts", F.lit(i)))
    exact = known.agg(
        F.count(F.lit(1)).alias("listings"), F.countDistinct("key").alias("distinct"), F.count("price").alias("prices"),
        F.array(*map(below, range(3))).alias("below"), F.array(*map(up_to, range(3))).alias("up_to"),
    ).select("*", estimated["n"].alias("n"), estimated["n_distinct"].alias("n_distinct"))
    error = sketches.RANK_ERROR
    metrics = [
        (F.lit("listings"), F.col("listings"), F.col("listings") == F.col("n")),
        (F.lit("distinct listings"), F.col("distinct"), F.abs(F.col("n_distinct") - F.col("distinct")) <= sketches.DISTINCT_ERROR * F.col("distinct")),
    ] + [
        (F.lit(f"price quantile {q}"), F.col("prices"),
         (F.get("below", F.lit(i)) <= (q + error) * F.col("prices")) & (F.get("up_to", F.lit(i)) >= (q - error) * F.col("prices")))
        for i, q in enumerate(quantiles)
    ]
    listed = F.array(*(F.struct(m.alias("metric"), e.alias("exact"), w.alias("within")) for m, e, w in metrics))
    return exact.select(F.inline(listed))


@query(
    "time_histogram",
    f"""
    SELECT week, CAST(isodow(day_date) AS INT) AS weekday, CAST(floor(({S.minutes('time')}) / 60) AS INT) AS hour, count(*) AS n
    FROM occurrence GROUP BY ALL""",
    ["occurrence"],
)
def time_histogram(t: Tables) -> DataFrame:
    return analytics.time_histogram(t.occurrence())


@query(
    "venue_leaderboard",
    """
    SELECT week, venue_key, n, CAST(place AS INT) AS place FROM (
      SELECT *, dense_rank() OVER (PARTITION BY week ORDER BY n DESC) AS place FROM (
        SELECT week, lower(split_part(venue, ',', 1)) AS venue_key, count(*) AS n FROM occurrence GROUP BY ALL)) WHERE place <= 10""",
    ["occurrence"],
)
def venue_leaderboard(t: Tables) -> DataFrame:
    return analytics.venue_leaderboard(t.occurrence())


@query(
    "week_delta",
    """
    SELECT *, n - previous AS delta FROM (SELECT week, source, n, lag(n) OVER (PARTITION BY source ORDER BY week) AS previous
      FROM (SELECT week, source, count(*) AS n FROM occurrence GROUP BY ALL))""",
    ["occurrence"],
)
def week_delta(t: Tables) -> DataFrame:
    return analytics.week_delta(t.occurrence())


@query(
    "pick_histograms",
    f"""
    SELECT week, 'venue' AS dimension, {_VENUE_KEY} AS label, count(*) AS n FROM merged_pick GROUP BY ALL
    UNION ALL SELECT week, 'category', category, count(*) FROM merged_pick GROUP BY ALL
    UNION ALL SELECT week, 'source', source, count(*) FROM merged_pick GROUP BY ALL""",
    ["merged_pick"],
)
def pick_histograms(t: Tables) -> DataFrame:
    return analytics.pick_histograms(_merged_picks(t))


# Sinks and streams -------------------------------------------------------------------------------


@query(
    "scan_manifest",
    """
    SELECT week, source, status, events, CASE WHEN status = 'failed' THEN 'gone' END AS reason, CASE WHEN events > 500 THEN 'partial' END AS note
    FROM manifest""",
    ["manifest"],
)
def scan_manifest(t: Tables) -> DataFrame:
    """Manifest documents written as JSON, one per week, and read back."""
    rows = t.manifest().select(
        "week", "source", "status", "events", F.when(F.col("status") == "failed", "gone").alias("reason"),
        F.when(F.col("events") > 500, "partial").alias("note"),
        F.col("started").cast("string").alias("first_collected"), F.col("completed").cast("string").alias("last_collected"),
    )
    path = work_path(t.spark, "manifests")
    documents = week_files.manifest_documents(rows).withColumn("folder", F.col("week"))
    documents.repartition("folder").write.partitionBy("folder").json(path)
    return week_files.read_manifest(t.spark, f"{path}/folder=*/*.json").select("week", "source", "status", "events", "reason", "note")


@query(
    "scan_source_files",
    "SELECT week, stem, source, title, venue, date, time, cost, url, description FROM occurrence WHERE stem <> 's07'",
    ["occurrence"],
)
def scan_source_files(t: Tables) -> DataFrame:
    """Source files written by week and source, a failed one without events, and their events read back."""
    event = F.struct(*schemas.EVENT_FIELDS)
    failed = F.col("stem") == "s07"
    files = t.occurrence().groupBy("week", "stem", "source").agg(F.collect_list(event).alias("events")).select(
        "week", "stem", "source", F.when(failed, "failed").alias("status"), F.when(failed, "gone").alias("reason"),
        F.lit("2024-01-01T00:00:00Z").alias("collected_at"), F.when(~failed, F.col("events")).alias("events"),
    )
    path = work_path(t.spark, "source-files")
    week_files.write_source_files(files, path)
    read = week_files.source_events(week_files.read_written_source_files(t.spark, path))
    return read.select("week", "stem", "source", *schemas.EVENT_FIELDS)


@query(
    "scan_side_inputs",
    """
    SELECT 'floor' AS kind, source AS name, CAST(min_expected AS VARCHAR) AS value, CAST(2400 AS VARCHAR) AS more FROM floors
    UNION ALL SELECT DISTINCT 'music', event_type, CASE WHEN event_type <> 'error' THEN 'https://music.example/' || event_type END,
           CASE WHEN event_type <> 'error' THEN substring(event_type, 2, 3) END FROM occurrence""",
    ["floors", "occurrence"],
)
def scan_side_inputs(t: Tables) -> DataFrame:
    """The yield baseline and the music lookup written as documents and read back; a lookup that is not there yet is empty."""
    path = work_path(t.spark, "side-inputs")
    week_files.expected_yield_document(t.floors(), TOTAL_FLOOR).coalesce(1).write.json(f"{path}/expected")
    hit = F.struct("spotify_url", "matched_text")
    lookup = t.music_lookup().agg(F.map_from_entries(F.collect_list(F.struct("title", hit))).alias("hits"))  # one document
    lookup.select(F.to_json("hits").alias("value")).coalesce(1).write.text(f"{path}/music")
    floors = week_files.read_expected_yield(t.spark, f"{path}/expected")
    music = week_files.read_music_lookup(t.spark, f"{path}/music").unionByName(
        week_files.read_music_lookup(t.spark, f"{path}/no-such-lookup")
    )
    return floors.select(
        F.lit("floor").alias("kind"), F.col("source").alias("name"), F.col("min_expected").cast("string").alias("value"),
        F.col("total_floor").cast("string").alias("more"),
    ).unionByName(music.select(
        F.lit("music").alias("kind"), F.col("title").alias("name"), F.col("spotify_url").alias("value"), F.col("matched_text").alias("more")
    ))


@query("scan_picks_log", "SELECT * REPLACE (coalesce(category, '') AS category) FROM log_row", ["log_row"])
def scan_picks_log(t: Tables) -> DataFrame:
    """The log written as CSV, quotes and commas included, and read back. CSV has no nulls: a missing category is empty."""
    path = work_path(t.spark, "log-csv")
    week_files.export_picks_log(_log_rows(t), path)
    return week_files.import_picks_log(t.spark, path)


@query("append_log_table", "SELECT DISTINCT * FROM log_row", ["log_row"])
def append_log_table(t: Tables) -> DataFrame:
    """The log appended twice to a table by week: the second time finds every key."""
    path = work_path(t.spark, "log-table")
    rows = through_table(_log_rows(t).distinct(), "log")
    for _ in range(2):
        keys = week_files.read_log_keys(t.spark, path)
        week_files.append_picks_log(through_table(picks_log.new_rows_by_digest(rows, keys), "new"), path)
    return week_files.read_picks_log(t.spark, path)


@query(
    "scan_usage_log",
    """
    SELECT l_orderkey AS message_id, l_linenumber AS line_no, CAST(l_quantity AS BIGINT) AS input_tokens, l_partkey AS output_tokens
    FROM lineitem WHERE l_returnflag <> 'R'""",
)
def scan_usage_log(t: Tables) -> DataFrame:
    """Line items as JSON lines among blank, broken and foreign ones."""
    usage_of = F.struct(F.col("l_quantity").cast("long").alias("input_tokens"), F.col("l_partkey").alias("output_tokens"))
    message = F.struct(F.col("l_orderkey").cast("string").alias("id"), usage_of.alias("usage"))
    good = F.to_json(F.struct(F.lit("assistant").alias("type"), message.alias("message"), F.col("l_linenumber").alias("nth")))
    other = F.when(F.col("l_linenumber") % 3 == 0, "").when(F.col("l_linenumber") % 3 == 1, F.substring(good, 1, 40)).otherwise(
        F.to_json(F.struct(F.lit("user").alias("type"), message.alias("message")))
    )
    line = F.when(F.col("l_returnflag") != "R", good).otherwise(other)
    path = work_path(t.spark, "usage-lines")
    t.table("lineitem").select(line.alias("value")).write.text(path)
    nth = F.get_json_object("value", "$.nth").cast("long")
    lines = t.spark.read.text(path).select(F.lit("s").alias("session"), F.lit("").alias("agent"), nth.alias("line_no"), "value")
    return week_files.usage_lines(lines).select(F.col("message_id").cast("long").alias("message_id"), "line_no", "input_tokens", "output_tokens")


@query("scan_annotations", "SELECT week, day, rank, id, why, category FROM pick", ["pick"])
def scan_annotations(t: Tables) -> DataFrame:
    """Judgement documents written as JSON, one per week, and their picks read back."""
    pick = F.struct("id", "rank", "address", "category", "is_music", "sold_out", "why", "time")
    days = t.pick().groupBy("week", "day").agg(F.collect_list(pick).alias("top3"))  # three a day
    day = F.struct(F.col("day").alias("date"), F.date_format(F.to_date("day"), "EEEE").alias("day_name"), "top3")
    path = work_path(t.spark, "judgement")
    documents = days.groupBy("week").agg(F.collect_list(day).alias("days")).withColumn("folder", F.col("week"))  # seven a week
    documents.repartition("folder").write.partitionBy("folder").json(path)
    _, _, picks, _ = week_files.read_annotations(t.spark, f"{path}/folder=*/*.json")
    return picks.select("week", "day", "rank", "id", "why", "category")


@query("write_source_results", ORACLES["extract_calendar_json"])
def write_source_results(t: Tables) -> DataFrame:
    """Status and listings of a feed written by week and read back."""
    path = work_path(t.spark, "results")
    listings, status = weekly.collect({"calendar_json": t.calendar_payloads()})
    week_files.write_source_results(status, listings, path)
    return t.spark.read.parquet(f"{path}/listings").withColumnRenamed("week", "week_start").select(*LISTED_COLUMNS)


_WEEKLY = ",\n".join([
    S.with_views(["occurrence", "bench_words"], "").rstrip(),
    """
    feed AS (SELECT week, 'feed' AS stem, pos, 'feed' AS source, event_type AS title, CASE WHEN user_id >= 50 THEN venue ELSE 'Default Hall' END AS venue,
                    date, CASE WHEN event_type <> 'signup' THEN strftime(ts, '%-I:%M %p') ELSE '' END AS time, '' AS cost,
                    CASE WHEN event_type <> 'click' THEN url ELSE 'https://example.org/' END AS url, description
             FROM occurrence WHERE event_type <> 'error')""",
    _collapsed_sql("feed", fixed.SOURCE_PRIORITY),
    _FOLDED,
    _NUMBERED,
    f"""
    word AS (SELECT week, ord, unnest(regexp_extract_all(lower(title || ' ' || description), '[\\pL\\pN]+')) AS term FROM numbered),
    vote AS (SELECT week, ord, c FROM (
               SELECT week, ord, c, count(*) AS n FROM word JOIN (SELECT DISTINCT term, item_id % 9 AS c FROM bench_words) USING (term) GROUP BY ALL)
             QUALIFY row_number() OVER (PARTITION BY week, ord ORDER BY n DESC, c) = 1),
    hit AS (SELECT week, ord, min(i % 3 + 1) AS tier, count(*) AS overlap
            FROM (SELECT DISTINCT week, ord, item_id % 14 AS i FROM word JOIN bench_words USING (term)) GROUP BY ALL),
    judged AS (
      SELECT n.week, n.ord, n.date AS day, n.title, lower({S.strip("split_part(n.venue, ',', 1)")}) AS venue_key, coalesce({S.label_at('c')}, '{weekly.UNVOTED}') AS category,
             CAST(coalesce(tier, 4) AS INT) AS tier, CAST(coalesce(overlap, 0) AS INT) AS overlap, true AS easy_to_miss,
             coalesce({S.label_at('c')}, '{weekly.UNVOTED}') = '{fixed.COMMUNITY}' AS community, false AS free,
             recurrence_count IS NOT NULL AS recurring, false AS elevated
      FROM numbered n LEFT JOIN vote USING (week, ord) LEFT JOIN hit USING (week, ord)),
    capped AS (SELECT *, CASE WHEN venue_key = '' THEN ord END AS alone FROM judged
               QUALIFY row_number() OVER (PARTITION BY week, venue_key, alone ORDER BY {_PRECEDENCE}) <= 2),
    placed_pick AS (SELECT *, CAST(row_number() OVER (PARTITION BY week, day ORDER BY {_PRECEDENCE}) AS INT) AS rank FROM capped)""",
])


@query(
    "weekly_run",
    _WEEKLY
    + """
    SELECT week, day, rank, printf('c%04d', ord) AS id, title, category, printf('interest tier %d, %d interests', tier, overlap) AS why
    FROM placed_pick WHERE rank <= 3""",
)
def weekly_run(t: Tables) -> DataFrame:
    """A calendar feed from raw payloads to the merged picks."""
    registry = t.spark.createDataFrame([("feed", "feed", "calendar_json")], "source STRING, name STRING, format STRING")
    made = weekly.run({"calendar_json": t.calendar_payloads()}, registry, t.category_lexicon(), t.interest_lexicon(), "2024-01-01T00:00:00Z")
    return made.selection.picks.select("week", "day", "rank", "id", "title", "category", "why")


@query(
    "overwrite_week",
    """
    SELECT week, id, title, 'old' AS state FROM occurrence WHERE week <> DATE '2024-01-15'
    UNION ALL SELECT week, id, title, 'new' FROM occurrence WHERE week = DATE '2024-01-15' AND event_type <> 'error'""",
    ["occurrence"],
)
def overwrite_week(t: Tables) -> DataFrame:
    """All weeks written, then one week replaced by its rows without errors."""
    path = work_path(t.spark, "overwrite-week")
    rows = t.occurrence().select("week", "id", "title")
    replace_weeks(rows.withColumn("state", F.lit("old")), path)
    target = rows.where((F.col("week") == "2024-01-15") & (F.col("title") != "error"))
    replace_weeks(target.withColumn("state", F.lit("new")), path)
    return t.spark.read.parquet(path).select("week", "id", "title", "state")


def _stream(t: Tables, name: str) -> DataFrame:
    """A driver table as a stream of files."""
    schema = t.table(name).schema
    return t.spark.readStream.schema(schema).option("pathGlobFilter", f"{name}.parquet").parquet(t.folder)


@query("usage_stream", "SELECT * FROM reading", ["reading"])
def usage_stream(t: Tables) -> DataFrame:
    path = work_path(t.spark, "usage-stream")
    lines = t.usage_lines(_stream(t, "lineitem"))
    jobs.usage_stream(lines, f"{path}/table", f"{path}/checkpoint").awaitTermination()
    return jobs.usage_readings(sink.read(t.spark, f"{path}/table"))


@query(
    "log_stream",
    """
    WITH log AS (SELECT CAST(CAST(date_trunc('week', o_orderdate) AS DATE) AS VARCHAR) AS week_of, CAST(o_custkey AS VARCHAR) AS title,
                        o_orderkey AS venue, o_orderpriority AS rank FROM orders)
    SELECT * FROM log WHERE rank = '1-URGENT'
    UNION ALL SELECT * FROM log WHERE (week_of, title) NOT IN (SELECT (week_of, title) FROM log WHERE rank = '1-URGENT')""",
)
def log_stream(t: Tables) -> DataFrame:
    """Orders streamed into a log that already holds the urgent ones."""
    def rows(orders: DataFrame) -> DataFrame:
        week = clock.week_of(F.to_date("o_orderdate")).cast("string")
        return orders.select(
            week.alias("week_of"), F.col("o_custkey").cast("string").alias("title"),
            F.col("o_orderkey").alias("venue"), F.col("o_orderpriority").alias("rank"),
        )

    path = work_path(t.spark, "log-stream")
    sink.create(t.spark, f"{path}/table", rows(t.table("orders")).where(F.col("rank") == "1-URGENT"))
    jobs.log_stream(rows(_stream(t, "orders")), f"{path}/table", f"{path}/checkpoint").awaitTermination()
    return sink.read(t.spark, f"{path}/table").drop("batch")


@query("payload_stream", ORACLES["extract_calendar_json"])
def payload_stream(t: Tables) -> DataFrame:
    """Calendar payloads written as files, then parsed as a stream."""
    path = work_path(t.spark, "payload-stream")
    payloads = t.calendar_payloads()
    payloads.write.parquet(f"{path}/payloads")
    stream = t.spark.readStream.schema(payloads.schema).parquet(f"{path}/payloads")
    jobs.payload_stream(stream, "calendar_json", f"{path}/table", f"{path}/checkpoint").awaitTermination()
    return sink.read(t.spark, f"{path}/table").select(*LISTED_COLUMNS)


@query("collapse_stream", ORACLES["collapse_duplicates"])
def collapse_stream(t: Tables) -> DataFrame:
    """Listings that arrive file by file, some of them twice."""
    path = work_path(t.spark, "collapse-stream")
    listings = t.listing()
    listings.repartition(6).write.parquet(f"{path}/listings")
    listings.where(F.col("pos") % 5 == 0).repartition(2).write.mode("append").parquet(f"{path}/listings")
    stream = t.spark.readStream.schema(listings.schema).option("maxFilesPerTrigger", 3).parquet(f"{path}/listings")
    jobs.collapse_stream(stream, f"{path}/table", f"{path}/checkpoint", LISTING_PRIORITY).awaitTermination()
    return jobs.collapsed(sink.read(t.spark, f"{path}/table"))
