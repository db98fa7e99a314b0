"""The driver tables seen as listings, judgements, fetch logs and raw payloads.

`sql_views.py` defines the same views for DuckDB.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from marquee.functions import category, clock
from marquee.operators.ranking import tokens
from marquee.session import through_table

LISTING_PRIORITY = ["src7", "src1", "src2", "src13"]
OCCURRENCE_PRIORITY = ["s07", "s01", "s20"]
# Items per page of a payload built from a table.
PAGE_ITEMS = 100


class Tables:
    """The driver tables of one folder and the views over them."""

    def __init__(self, spark: SparkSession, folder: str) -> None:
        self.spark, self.folder = spark, folder
        self._judged: DataFrame | None = None
        self._tables: dict[str, DataFrame] = {}

    def table(self, name: str) -> DataFrame:
        if name not in self._tables:
            self._tables[name] = self.spark.read.parquet(f"{self.folder}/{name}.parquet")
        return self._tables[name]

    # Listings --------------------------------------------------------------------------------

    def listing(self) -> DataFrame:
        """Documents as listings: the first line is the title, the whole text the description."""
        first_day = F.lit("2024-01-01").cast("date")
        offset = (F.col("n_chars") % 28).cast("int")
        date = F.date_add(first_day, offset)
        text = F.col("text")
        return self.table("documents").select(
            clock.week_of(date).alias("week"),
            F.col("source").alias("stem"),
            F.col("doc_id").alias("pos"),
            "source",
            F.split_part(text, F.lit("\n"), F.lit(1)).alias("title"),
            F.col("lang").alias("venue"),
            date.cast("string").alias("date"),
            clock.minutes_clock(F.col("n_chars") % 1440).alias("time"),
            F.when(F.col("source").isin("src1", "src3", "src5"), "")
            .otherwise(F.concat(F.lit("$"), (F.col("n_chars") % 40).cast("string")))
            .alias("cost"),
            F.when(F.col("source").isin("src2", "src4"), "")
            .otherwise(F.concat(F.lit("https://example.org/"), F.col("doc_id")))
            .alias("url"),
            F.when(F.col("source") == "src9", F.concat(F.lit("SOLD OUT: "), text)).otherwise(text).alias("description"),
        )

    def occurrence(self) -> DataFrame:
        """Events as listings of many venues over five weeks."""
        if "occurrence" not in self._tables:
            self._tables["occurrence"] = self._occurrence()
        return self._tables["occurrence"]

    def _occurrence(self) -> DataFrame:
        k = F.get_json_object("props", "$.k").cast("int")
        shown = clock.display_clock(F.col("ts"))
        value = F.col("value")
        kind = F.col("event_type")
        dollars = F.concat(F.lit("$"), value.cast("decimal(12,2)").cast("string"))
        date = F.to_date("ts")
        return self.table("events").select(
            clock.week_of(date).alias("week"),
            date.cast("string").alias("date"),
            date.alias("day_date"),
            F.concat(F.lit("e"), F.col("event_id")).alias("id"),
            F.col("event_id").alias("pos"),
            F.col("event_id").alias("ord"),
            F.format_string("s%02d", k % 23).alias("stem"),
            F.format_string("s%02d", k % 23).alias("source"),
            kind.alias("title"),
            F.concat(F.lit("Hall "), F.col("user_id"), F.lit(", Main St")).alias("venue"),
            F.when((kind == "purchase") & (value >= 80), F.concat(shown, F.lit(", 11:00 PM")))
            .when((kind == "view") & (value >= 80), "")
            .otherwise(shown)
            .alias("time"),
            F.when(value < 5, "Free")
            .when((kind == "error") & (value >= 100), "*(confirm details)*")
            .when((kind == "signup") & (value >= 100), "")
            .otherwise(dollars)
            .alias("cost"),
            F.concat(F.lit("https://example.org/"), F.col("event_id")).alias("url"),
            F.col("props").alias("description"),
            F.when(k == 99, "Misc").when(k < 98, category.at(k % 9)).alias("category"),
            ((kind == "purchase") & (value >= 120)).alias("sold_out"),
            "user_id",
            "event_type",
            "value",
            k.alias("k"),
            "ts",
        )

    # Judgements ------------------------------------------------------------------------------

    @staticmethod
    def _placed(rows: DataFrame) -> DataFrame:
        """Some rows carry an unknown id, some stand under the next day."""
        late = (F.col("event_type") == "error") & (F.col("value") >= 150)
        unknown = (F.col("event_type") == "signup") & (F.col("value") >= 250)
        return rows.withColumn(
            "day", F.when(late, F.date_add("day_date", 1)).otherwise(F.col("day_date")).cast("string")
        ).withColumn("id", F.when(unknown, F.concat(F.lit("x"), F.col("id"))).otherwise(F.col("id")))

    def annotation(self) -> DataFrame:
        """Every occurrence but the cheapest views annotated; the dearest clicks twice."""
        if "annotation" not in self._tables:
            self._tables["annotation"] = self._annotation()
        return self._tables["annotation"]

    def _annotation(self) -> DataFrame:
        rows = self._placed(self.occurrence()).where(~((F.col("event_type") == "view") & (F.col("value") < 0.5)))
        note = F.when(F.col("event_type") == "click", "Multiple showtimes").when(
            F.col("event_type") == "view", ""
        ).otherwise(F.col("description"))
        columns = ["week", "day", "id", "category", "sold_out"]
        again = rows.where((F.col("event_type") == "click") & (F.col("value") >= 200))
        return rows.select(*columns, note.alias("note"), "pos").unionByName(
            again.withColumn("category", category.at((F.col("k") + 1) % 9)).select(
                *columns, note.alias("note"), (F.col("pos") + 1_000_000_000_000).alias("pos")
            )
        )

    def _top_six(self) -> DataFrame:
        """The six dearest occurrences of each day, kept as a table: judgement comes as stored documents."""
        if self._judged is None:
            self._judged = through_table(self._ranked_six(), "judged")
        return self._judged

    def _ranked_six(self) -> DataFrame:
        best = Window.partitionBy("date").orderBy(F.col("value").desc(), "pos")
        ranked = self.occurrence().withColumn("place", F.row_number().over(best)).where(F.col("place") <= 6)
        return self._placed(ranked)

    def pick(self) -> DataFrame:
        """The three dearest occurrences of a day."""
        return self._top_six().where(F.col("place") <= 3).select(
            "week",
            "day",
            F.col("place").alias("rank"),
            "id",
            "category",
            F.when(F.col("k") >= 10, F.concat(F.lit("Why "), F.col("pos"))).alias("why"),
            (F.col("k") % 9 == 0).alias("is_music"),
            "sold_out",
            F.when(F.col("user_id") < 75, F.concat(F.lit("Addr "), F.floor(F.col("user_id") / 25))).otherwise("").alias("address"),
            F.when((F.col("event_type") == "click") & (F.col("k") < 50), "8:00 PM").alias("time"),
        )

    def mention(self) -> DataFrame:
        """The next three of a day."""
        return self._top_six().where(F.col("place") > 3).select("week", "day", F.col("place").alias("pos"), "id")

    def music_lookup(self) -> DataFrame:
        """A lookup result for every event type, one of them not found."""
        found = F.col("title") != "error"
        return self.occurrence().select("title").distinct().select(
            "title",
            F.when(found, F.concat(F.lit("https://music.example/"), F.col("title"))).alias("spotify_url"),
            F.when(found, F.substring("title", 2, 3)).alias("matched_text"),
        )

    # Collection ------------------------------------------------------------------------------

    def manifest(self) -> DataFrame:
        """Events per week and source as manifest rows; one source always fails."""
        rows = self.occurrence()
        failed = F.col("source") == "s07"
        return rows.groupBy("week", "source").agg(
            F.count(F.lit(1)).alias("_n"), F.min("ts").alias("started"), F.max("ts").alias("completed")
        ).select(
            "week",
            "source",
            F.when(failed, "failed").otherwise("ok").alias("status"),
            F.when(~failed, F.col("_n")).alias("events"),
            "started",
            "completed",
        )

    def floors(self) -> DataFrame:
        return self.table("nation").select(
            F.format_string("s%02d", F.col("n_nationkey")).alias("source"),
            (F.col("n_regionkey") * 30).cast("long").alias("min_expected"),
        )

    def declared_orders(self) -> DataFrame:
        """Finished and open orders as manifest entries; pending ones are not listed yet."""
        return self.table("orders").where(F.col("o_orderstatus") != "P").select(
            F.trunc("o_orderdate", "year").alias("week"),
            F.col("o_orderkey").cast("string").alias("source"),
            F.when(F.col("o_orderstatus") == "F", "failed").otherwise("ok").alias("status"),
            (F.floor(F.month("o_orderdate") / 2) + 1).cast("long").alias("events"),
        )

    def order_files(self) -> DataFrame:
        """Line items per order as the events a source file holds."""
        per_order = self.table("lineitem").groupBy("l_orderkey").agg(F.count(F.lit(1)).alias("n_events"))
        orders = self.table("orders").select("o_orderkey", F.trunc("o_orderdate", "year").alias("week"))
        return per_order.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).select(
            "week", F.col("o_orderkey").cast("string").alias("source"), "n_events"
        )

    def order_stamps(self) -> DataFrame:
        """Orders as source files with a collection stamp, written with three kinds of offset."""
        day = F.date_format("o_orderdate", "yyyy-MM-dd'T'10:00:00")
        status = F.col("o_orderstatus")
        suffix = F.when(status == "O", "+00:00").when(status == "F", "Z").otherwise("-05:00")
        return self.table("orders").select(
            F.trunc("o_orderdate", "year").alias("week"),
            F.col("o_orderkey").cast("string").alias("source"),
            F.concat(day, suffix).alias("collected_at"),
        )

    def order_runs(self) -> DataFrame:
        """One run per year, February to the end of November."""
        year = F.year("week").cast("string")
        return self.order_stamps().select("week").distinct().select(
            "week",
            F.concat(year, F.lit("-02-01T00:00:00")).alias("run_started"),
            F.concat(year, F.lit("-11-30T12:00:00Z")).alias("run_completed"),
        )

    def fetches(self) -> DataFrame:
        """Line items as page requests of a source."""
        return self.table("lineitem").select(
            F.trunc("l_shipdate", "month").alias("week"),
            F.col("l_suppkey").cast("string").alias("source"),
            F.col("l_linenumber").alias("page"),
            F.lit(7).alias("total_pages"),
            (F.col("l_returnflag") != "R").alias("ok"),
            F.col("l_quantity").cast("long").alias("n_events"),
        )

    def usage_lines(self, lineitem: DataFrame | None = None) -> DataFrame:
        """Line items as usage readings: message per order, several readings per message."""
        lineitem = self.table("lineitem") if lineitem is None else lineitem
        flag = F.concat("l_returnflag", "l_linestatus")
        line = (
            F.col("l_linenumber").cast("long") * 100_000_000_000_000_000
            + F.col("l_partkey") * 10_000_000_000
            + F.col("l_suppkey") * 100_000
            + F.col("l_quantity").cast("long") * 1_000
            + F.round(F.col("l_discount") * 100).cast("long") * 10
            + (F.col("l_tax") == 0).cast("long")
        )
        return lineitem.select(
            F.date_format("l_shipdate", "yyyy").alias("session"),
            F.when(flag == "NO", "").otherwise(flag).alias("agent"),
            F.col("l_orderkey").alias("message_id"),
            line.alias("line_no"),
            F.col("l_quantity").cast("long").alias("input_tokens"),
            F.col("l_partkey").alias("cache_creation_input_tokens"),
            F.col("l_suppkey").alias("cache_read_input_tokens"),
            F.when(F.col("l_tax") != 0, F.round(F.col("l_discount") * 100).cast("long")).alias("output_tokens"),
        )

    def agents(self) -> DataFrame:
        """Agent descriptions; the last flag has none."""
        rows = self.usage_lines().where(~F.col("agent").isin("", "RO")).select("session", "agent").distinct()
        return rows.select(
            "session",
            "agent",
            F.concat(F.lit("type "), F.substring("agent", 1, 1)).alias("agent_type"),
            F.concat(F.lit("ships "), F.col("session")).alias("description"),
        )

    # Lexicons --------------------------------------------------------------------------------

    def interest_lexicon(self) -> DataFrame:
        """Words of the benchmark passages, fourteen interests."""
        return self.table("benchmark").select(
            F.explode(F.array_distinct(tokens(F.col("text")))).alias("term"),
            F.format_string("i%02d", F.col("item_id") % 14).alias("interest"),
            (F.col("item_id") % 14 % 3 + 1).cast("int").alias("tier"),
        ).distinct()

    def category_lexicon(self) -> DataFrame:
        return self.table("benchmark").select(
            F.explode(F.array_distinct(tokens(F.col("text")))).alias("term"),
            category.at((F.col("item_id") % 9).cast("int")).alias("category"),
        ).distinct()

    def part_titles(self) -> DataFrame:
        """Parts as bills: '<brand>: <name>' or '<name> & <type>'."""
        return self.table("part").select(
            F.col("p_partkey").alias("pos"),
            F.col("p_type").alias("kind"),
            F.when(F.col("p_type") == "ECONOMY", F.concat(F.col("p_brand"), F.lit(": "), F.col("p_name")))
            .otherwise(F.concat(F.col("p_name"), F.lit(" & "), F.col("p_type")))
            .alias("title"),
        )

    def catalogue(self) -> DataFrame:
        """Big parts and all suppliers as a catalogue of names."""
        parts = self.table("part").where(F.col("p_size") > 40).select(
            F.initcap("p_name").alias("name"),
            F.concat(F.lit("https://music.example/p"), F.col("p_partkey")).alias("url"),
            F.col("p_partkey").alias("rank"),
        )
        suppliers = self.table("supplier").select(
            F.col("s_name").alias("name"),
            F.concat(F.lit("https://music.example/s"), F.col("s_suppkey")).alias("url"),
            F.col("s_suppkey").alias("rank"),
        )
        return parts.unionByName(suppliers)

    # Raw payloads ----------------------------------------------------------------------------

    @staticmethod
    def _pages(rows: DataFrame, week: Column, item: Column, page: Column, *keys: Column) -> DataFrame:
        """Items gathered into pages of a bounded size, in position order."""
        gathered = F.sort_array(F.collect_list(F.struct(F.col("pos"), item.alias("item"))))
        return rows.groupBy(
            F.lit("feed").alias("source"), page.alias("page"), week.alias("week_start"), *keys
        ).agg(F.transform(gathered, lambda r: r["item"]).alias("items"))

    def _event_pages(self, item: Column, *keys: Column, week: Column | None = None) -> DataFrame:
        rows = self.occurrence()
        page = F.floor(F.col("pos") / PAGE_ITEMS)
        return self._pages(rows, F.col("week") if week is None else week, item, page, *keys)

    @staticmethod
    def _payload(pages: DataFrame, body: Column) -> DataFrame:
        have = set(pages.columns)
        extra = [
            (F.col(c) if c in have else F.lit(None)).cast(t).alias(c)
            for c, t in (("context_date", "date"), ("venue", "string"), ("fallback_url", "string"))
        ]
        # Parsing a body costs far more than its bytes say: spread the pages over all reducers.
        reducers = int(pages.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        rows = pages.select("source", "page", "week_start", *extra, body.alias("body"))
        return rows.repartition(reducers, "week_start", "page")

    def object_payloads(self) -> DataFrame:
        """Pages of a JSON object feed; every view is listed again on the page after its own."""
        rows = self.occurrence().withColumn("page", F.floor(F.col("pos") / PAGE_ITEMS))
        again = rows.where(F.col("event_type") == "view").withColumn("page", F.col("page") + 1)
        again = again.withColumn("week", clock.week_of(F.date_add("day_date", 1)))
        dollars = F.concat(F.lit("$"), F.col("value").cast("decimal(12,2)").cast("string"))
        item = F.struct(
            F.col("pos").alias("id"),
            F.concat(F.col("event_type"), F.lit(" & "), F.col("k")).alias("title"),
            F.col("description").alias("excerpt"),
            F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSS'-05:00'").alias("tz_adjusted_begin_date"),
            (F.col("event_type") == "error").alias("is_ongoing"),
            (F.col("value") < 5).alias("is_free"),
            dollars.alias("ticket_info"),
            F.concat(F.lit("/events/"), F.col("pos")).alias("permalink"),
            F.struct(
                F.concat(F.lit("Hall "), F.col("user_id")).alias("title"),
                F.when(F.col("user_id") < 75, "Camden").alias("city"),
                F.when(F.col("user_id") < 50, "NJ").alias("state"),
            ).alias("venue"),
        )
        pages = self._pages(rows.unionByName(again), F.col("week"), item, F.col("page"))
        return self._payload(pages, F.to_json(F.struct(F.col("items").alias("events"))))

    def epoch_payloads(self) -> DataFrame:
        """Epoch feed; clicks are asked for one week after they began."""
        start = F.timestamp_diff(
            "SECOND", F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"), F.col("ts")
        )
        item = F.struct(
            F.col("event_type").alias("title"),
            F.concat(F.lit("slug-"), F.col("pos")).alias("slug"),
            start.alias("start_datetime"),
            (start + F.col("k") * 86_400).alias("end_datetime"),
            F.col("event_type").isin("view", "click").alias("multidate"),
            F.array(F.col("event_type"), F.concat(F.lit("k"), F.col("k"))).alias("tags"),
            F.struct(
                F.concat(F.lit("Hall "), F.col("user_id")).alias("name"),
                F.when(F.col("user_id") < 75, F.concat(F.col("user_id"), F.lit(" Main St"))).alias("address"),
            ).alias("place"),
        )
        week = F.when(F.col("event_type") == "click", F.date_add("week", 7)).otherwise(F.col("week"))
        return self._payload(self._event_pages(item, week=week), F.to_json("items"))

    def date_only_payloads(self) -> DataFrame:
        """Orders as posts with a date only; pending ones are asked for a week late."""
        status = F.col("o_orderstatus")
        day = F.to_date("o_orderdate")
        rows = self.table("orders").withColumn("pos", F.col("o_orderkey"))
        item = F.struct(
            F.when(status != "P", F.concat(F.lit("https://example.org/o"), F.col("pos"))).alias("link"),
            F.struct(F.concat(F.lit("Order &amp; &#8220;"), F.col("pos"), F.lit("&#x201D; &eacute;&lt;")).alias("rendered")).alias("title"),
            F.struct(
                F.date_format("o_orderdate", "yyyy-MM-dd 00:00:00").alias("date"),
                F.concat(F.lit("Cust &ndash; "), F.col("o_custkey")).alias("venue"),
                F.when(status == "O", F.col("o_orderpriority")).alias("price"),
                F.lit("https://example.org/x").alias("external_link"),
                F.when(status == "F", F.lit("A &amp;amp; B")).alias("external_artist"),
            ).alias("acf"),
        )
        week = clock.week_of(F.when(status == "P", F.date_add(day, 7)).otherwise(day))
        late = F.when((status == "P") & (F.col("o_totalprice") < 100_000), clock.week_of(day)).otherwise(week)
        pages = self._pages(rows, late, item, F.floor(F.col("pos") / PAGE_ITEMS))
        return self._payload(pages, F.to_json("items"))

    def calendar_payloads(self) -> DataFrame:
        """Calendar resources; sign-ups last all day, errors are cancelled."""
        kind = F.col("event_type")
        timed = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'-05:00'")
        item = F.struct(
            F.when(kind == "error", "cancelled").otherwise("confirmed").alias("status"),
            kind.alias("summary"),
            F.when(F.col("user_id") >= 50, F.col("venue")).alias("location"),
            F.col("description").alias("description"),
            F.when(kind != "click", F.col("url")).alias("htmlLink"),
            F.struct(
                F.when(kind != "signup", timed).alias("dateTime"),
                F.when(kind == "signup", F.col("date")).alias("date"),
            ).alias("start"),
        )
        pages = self._event_pages(item)
        doc = F.struct("items", F.lit("Default Hall").alias("venue"), F.lit("https://example.org/").alias("fallback_url"))
        return self._payload(pages, F.to_json(doc))

    def ical_payloads(self, local: bool) -> DataFrame:
        """iCalendar text: folded lines, escapes, parameters, a repeated key."""
        place = F.when(F.col("user_id") < 30, F.concat(F.lit("LOCATION:https://example.org/u"), F.col("user_id"), F.lit("\r\n")))
        place = place.when(F.col("user_id") < 60, "").otherwise(
            F.concat(F.lit("LOCATION:Hall "), F.col("user_id"), F.lit("\\, Main\r\n  St\r\n"))
        )
        stamp = F.date_format("ts", "yyyyMMdd'T'HHmmss")
        start = (
            F.concat(F.lit("DTSTART;TZID=America/New_York:"), stamp)
            if local
            else F.concat(F.lit("DTSTART:"), stamp, F.lit("Z"))
        )
        block = F.concat(
            F.lit("BEGIN:VEVENT\r\nSUMMARY:draft\r\n"),
            start,
            F.lit("\r\n"),
            place,
            F.concat(F.lit("SUMMARY;LANGUAGE=en:"), F.col("event_type"), F.lit("\\; no "), F.col("k"), F.lit("\r\n")),
            F.concat(F.lit("DESCRIPTION:first\\nthen: "), F.col("k"), F.lit("\r\n")),
            F.concat(F.lit("URL;VALUE=URI:"), F.col("url"), F.lit("\r\nEND:VEVENT\r\n")),
        )
        pages = self._event_pages(block)
        body = F.concat(F.lit("BEGIN:VCALENDAR\r\nVERSION:2.0\r\n"), F.array_join("items", ""), F.lit("END:VCALENDAR\r\n"))
        return self._payload(pages, body)

    def html_payloads(self, layout: str) -> DataFrame:
        """Events rendered in the markup of one page layout; errors are dated a week later."""
        kind, k, user = F.col("event_type"), F.col("k"), F.col("user_id")
        shown_day = F.when(kind == "error", F.date_add("day_date", 7)).otherwise(F.col("day_date"))
        clock_text = F.date_format("ts", "h:mm a")
        cost = F.replace("cost", F.lit("&"), F.lit("&amp;"))
        href = F.col("url")
        name = F.concat(kind, F.lit(" &amp; "), k)
        nested = F.concat(F.lit("<span><span>"), name, F.lit("</span></span><span></span>"))
        name = F.when(k % 3 == 1, nested).otherwise(name)
        if layout == "html_dated":
            item = F.concat(
                F.lit('<a class="event event--x" href="'), href, F.lit('"><h3><span class="event__title">'), name,
                F.lit('</span></h3><p class="event__description">'), F.col("description"),
                F.lit('</p><ul><li class="event__detail event__detail--tickets"><span>Tickets</span><span class="event__detail-value"> '),
                cost,
                F.lit(' </span></li><li class="event__detail event__detail--time"><span>Doors</span><time datetime="x">'),
                clock_text,
                F.lit('</time></li><li class="event__detail event__detail--time"><time>11:59 PM</time></li></ul><time class="event__date" datetime="'),
                shown_day.cast("string"), F.lit('"><span>Mon</span></time></a>\n'),
            )
        elif layout == "html_blocks":
            item = F.concat(
                F.lit('<li class="wp-block-post post-1 event type-event"><h1 class="a wp-block-post-title"><a href="'), href,
                F.lit('">\n  '), name, F.lit('\n</a></h1><div class="wp-block-buttons"><a href="https://tickets.example/">Buy</a></div>'
                '<p class="x wp-block-paragraph">\n  '),
                F.date_format(shown_day, "MMMM d, yyyy"), F.lit("   @ "), F.lower(F.date_format("ts", "h:mm  a")),
                F.lit('\n</p><div class="wp-block-buttons"><a class="b" href="https://maps.app.goo.gl/x">Hall '), user,
                F.lit('</a></div><div class="t wp-block-post-terms"><a href="/t">'), kind, F.lit("</a></div></li>\n"),
            )
        elif layout == "html_tagline":
            item = F.concat(
                F.lit('<div class="rhp-event"><div id="eventDate" class="mb-0">'), F.date_format(shown_day, "EEE, MMM d"),
                F.lit('</div><div class="rhp-event-info rhp-event__info--list">'),
                F.when(user < 75, F.concat(F.lit('<div class="eventTagLine">with '), user, F.lit("</div>"))).otherwise(""),
                F.lit('<a id="eventTitle" class="url" href="'), href,
                F.lit('"><h2 class="rhp-event__title--list">'), name,
                F.lit('</h2></a><span class="rhp-event__time-text--list">'), clock_text,
                F.lit('</span><span class="rhp-event__cost-text--list">'), cost,
                F.lit('</span><a class="venueLink" href="/v" title="Hall '), user, F.lit('">somewhere</a></div></div>\n'),
            )
        elif layout == "html_long_date":
            year = F.when(user < 75, F.date_format(shown_day, ", yyyy")).otherwise("")
            item = F.concat(
                F.lit('<div class="em-event em-item"><h3 class="em-item-title"><a href="'), href, F.lit('">'), name,
                F.lit('</a></h3><div class="em-event-date em-x">'), F.date_format(shown_day, "MMMM d"), year,
                F.lit('</div><div class="em-event-location"><a href="/l">Hall '), user,
                F.lit('</a></div><div class="em-item-actions input"><p>'), F.col("description"), F.lit("</p></div></div>\n"),
            )
        elif layout == "html_two_fields":
            item = F.concat(
                F.lit('<div class="showblock"><p class="showdatevenue">'), F.date_format(shown_day, "MMMM d, yyyy"), F.lit(" "),
                clock_text, F.lit('</p><p class="showdatevenue">Hall '), user, F.lit("</p><h3>"), name,
                F.lit('</h3><p class="showdescription showprice">'), cost,
                F.lit('</p><a href="'), href, F.lit('" class="btn w-button">buy</a></div>\n'),
            )
        else:
            return self._grid_payloads(name)
        body = F.concat(F.lit("<html><body>"), F.array_join("items", ""), F.lit("</body></html>"))
        return self._payload(self._event_pages(item), self._spelt(body))

    @staticmethod
    def _spelt(body: Column) -> Column:
        """Pages in three spellings of the same markup: as written; single quotes and a listing inside a
        comment; bare attribute values and capital tags."""
        single = F.regexp_replace(body, r'''="([^"'<>]*)"''', "='$1'")
        commented = F.concat(F.lit("<!-- "), F.get("items", F.lit(0)), F.lit(" -->"), single)
        bare = F.regexp_replace(body, r'''="([\w/-]+)"''', " = $1")
        for name in ("div", "span", "li", "td", "a", "h3"):
            bare = F.regexp_replace(bare, rf"<(/?){name}\b", f"<$1{name.upper()}")
        page = F.pmod(F.col("page"), F.lit(3))
        return F.when(page == 0, body).when(page == 1, commented).otherwise(bare)

    def _grid_payloads(self, name: Column) -> DataFrame:
        item = F.concat(
            F.lit('<li class="anEvent">'), F.date_format("ts", "h:mm a"), F.lit('<a href="/event/'), F.col("pos"),
            F.lit('">'), name, F.lit("</a></li>"),
        )
        pages = self._event_pages(item, F.col("day_date"), F.trunc("day_date", "month").alias("context_date"))
        body = F.concat(
            F.lit('<table><tr><td class="notmonth"><span class="day">1</span><ul><li class="anEvent">9:00 PM<a href="/no">no</a></li></ul></td>'
                  '<td><div><span class="day">'),
            F.dayofmonth("day_date").cast("string"), F.lit("</span></div><ul>"), F.array_join("items", ""),
            F.lit("</ul></td></tr></table>"),
        )
        return self._payload(pages, self._spelt(body))

    def card_payloads(self) -> DataFrame:
        card = F.concat(
            F.lit('<li data-hook="events-card"><a data-hook="title" href="'), F.col("url"), F.lit('">'), F.col("event_type"), F.lit("</a></li>"),
        )
        return self._payload(self._event_pages(card), self._spelt(F.concat(F.lit("<ul>"), F.array_join("items", ""), F.lit("</ul>"))))

    def card_details(self) -> DataFrame:
        """Detail pages: errors could not be fetched, sign-ups carry no event block."""
        kind = F.col("event_type")
        block = F.to_json(F.struct(
            F.lit("Event").alias("@type"),
            F.concat(kind, F.lit(" &amp; "), F.col("k")).alias("name"),
            F.col("description").alias("description"),
            F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'-05:00'").alias("startDate"),
            F.struct(
                F.when(F.col("user_id") >= 30, F.concat(F.lit("Hall "), F.col("user_id"))).alias("name"),
                F.when(F.col("user_id") < 75, F.concat(F.col("user_id"), F.lit(" Main St"))).alias("address"),
            ).alias("location"),
        ))
        page = F.concat(
            F.lit('<html><script type="application/ld+json">{"@type":"Organization"}</script><script type="application/ld+json">'),
            block, F.lit("</script></html>"),
        )
        return self.occurrence().select(
            "url", F.when(kind == "signup", "<html>shell</html>").when(kind != "error", page).alias("body")
        )

    def showtime_payloads(self) -> DataFrame:
        """Rendered showtime pages: one per venue and day, one block per event type."""
        rows = self.occurrence().withColumn("page", F.floor(F.col("pos") / 1_000))
        late = F.date_format("ts", "h:mm").alias("t")
        clock_text = F.concat(late, F.when(F.hour("ts") < 12, "a").otherwise("p"))
        times = F.sort_array(F.collect_list(F.struct("pos", clock_text.alias("t"))))
        film = rows.groupBy("week", "day_date", "user_id", "page", "event_type").agg(
            F.array_join(F.transform(times, lambda r: r["t"]), "\n").alias("times"), F.min("pos").alias("pos")
        )
        rating = F.when(F.col("event_type") == "view", "").otherwise("PG")
        block = F.concat(
            F.col("event_type"), F.lit("\n\nRated:\n"), rating, F.lit("\nRuntime:\n1 hr\n\nStandard\nStandard Format\n"),
            F.when(F.col("event_type") == "error", "sold out").otherwise(F.col("times")),
        )
        gathered = F.sort_array(F.collect_list(F.struct("pos", block.alias("b"))))
        pages = film.groupBy(
            F.lit("feed").alias("source"),
            "page",
            F.col("week").alias("week_start"),
            F.col("day_date").alias("context_date"),
            F.concat(F.lit("Hall "), F.col("user_id")).alias("venue"),
            F.lit("https://example.org/theater").alias("fallback_url"),
        ).agg(F.array_join(F.transform(gathered, lambda r: r["b"]), "\n").alias("films"))
        return self._payload(pages, F.concat(F.col("films"), F.lit("\nNEARBY THEATERS\nOther hall\n1:00a")))
