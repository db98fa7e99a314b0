"""Raw feeds: real layouts, windows, clock changes, broken against quiet."""

import dataclasses
import json
from datetime import date, datetime, timezone

import pytest

from marquee import fixed, schemas
from marquee.sources import extract, feeds_html

MONDAY = date(2026, 7, 20)


@pytest.fixture
def run(spark):
    def parse(layout, *bodies, week=MONDAY, context=None, venue=None, fallback=None):
        rows = [("src", i, week, context, venue, fallback, b) for i, b in enumerate(bodies)]
        parsed = extract.parse(spark.createDataFrame(rows, schemas.PAYLOAD), layout)
        listed = extract.listings(parsed).orderBy("page", "pos").collect()
        (status,) = extract.status(parsed).collect()
        return listed, status

    return parse


def picked(rows, *names):
    return [tuple(r[n] for n in names) for r in rows]


def test_object_feed(run):
    def event(i, day, **more):
        return {"id": i, "title": f"e{i}", "tz_adjusted_begin_date": day, "venue": {"title": " Hall ", "city": "Camden", "state": "NJ"},
                "permalink": f"/e/{i}", "ticket_info": " $5 ", "excerpt": "x", **more}

    first = {"events": [
        event(1, "2026-07-20T19:05:00.000-04:00", begin_time="2026-07-20T18:05:00-05:00"),
        event(2, "2026-07-26T23:30:00-04:00", is_free=True, venue={"title": "Hall", "city": None}),
        event(3, "2026-07-27T00:00:00-04:00"),
        event(4, "2026-07-21T12:00:00-04:00", is_ongoing=True),
        event(5, None),
        event(None, "2026-07-22T12:00:00-04:00", permalink=""),
        event(None, "2026-07-22T12:00:00-04:00", venue=None),
    ]}
    second = {"events": [event(1, "2026-07-21T19:00:00-04:00"), event(4, "2026-07-21T12:00:00-04:00")]}
    rows, status = run("object_json", json.dumps(first), json.dumps(second))
    assert picked(rows, "title", "date", "time", "cost", "venue", "url") == [
        ("e1", "2026-07-20", "7:05 PM", "$5", "Hall, Camden, NJ", "https://do215.com/e/1"),
        ("e2", "2026-07-26", "11:30 PM", "Free", "Hall", "https://do215.com/e/2"),
        ("eNone", "2026-07-22", "12:00 PM", "$5", "Hall, Camden, NJ", ""),
        ("eNone", "2026-07-22", "12:00 PM", "$5", "", "https://do215.com/e/None"),
    ]
    assert (status.status, status.events) == ("ok", 4)


@pytest.mark.parametrize(
    ("layout", "broken", "quiet"),
    [
        ("object_json", "<html>", '{"events": []}'),
        ("object_json", '{"items": []}', '{"events": []}'),
        ("epoch_json", "oops", "[]"),
        ("date_only_json", "oops", "[]"),
        ("calendar_json", "{}", '{"items": []}'),
        ("ical_utc", "<html>", "BEGIN:VCALENDAR\nEND:VCALENDAR"),
        ("ical_local", "", "BEGIN:VCALENDAR\r\nEND:VCALENDAR"),
        ("html_dated", "<html></html>", '<a class="event" href="/x"><time class="event__date" datetime="2026-08-05"></time></a>'),
        ("html_two_fields", "<p>x</p>", '<div class="showblock"><h3>no fields</h3></div>'),
        ("html_tagline", '<div id="eventDate">Wed, Jul 22</div>', '<div id="eventDate">Sat, Aug 1</div><div class="rhp-event__info--list"><h2 class="rhp-event__title--list">T</h2></div>'),
        ("html_tagline", "<p>changed</p>", '<div id="eventDate">Sat, Aug 1</div><div class="rhp-event__info--list"></div>'),
        ("html_month_grid", "<p>x</p>", '<td><span class="day">5</span></td>'),
        ("html_month_grid", '<td class="notmonth"><span class="day">28</span></td>', '<td><span class="day">20</span></td>'),
    ],
)
def test_broken_is_not_quiet(run, layout, broken, quiet):
    rows, status = run(layout, broken, context=date(2026, 7, 1))
    assert (rows, status.status, status.events) == ([], "failed", None)
    rows, status = run(layout, quiet, context=date(2026, 7, 1))
    assert (rows, status.status, status.events) == ([], "ok", 0)


def seconds(text):
    return int(datetime.fromisoformat(text).replace(tzinfo=timezone.utc).timestamp())


def test_epoch_feed_dates_and_overlap(run):
    body = json.dumps([
        {"title": "late", "slug": "s", "start_datetime": seconds("2026-07-27T03:30:00"), "tags": ["a", "b"], "place": {"name": "Hall", "address": "1 St"}},
        {"title": "spans", "start_datetime": seconds("2026-07-18T16:00:00"), "end_datetime": seconds("2026-07-20T16:00:00"), "multidate": True, "place": {"name": "Hall"}},
        {"title": "over", "start_datetime": seconds("2026-07-10T16:00:00"), "end_datetime": seconds("2026-07-19T16:00:00"), "multidate": True},
        {"title": "single", "start_datetime": seconds("2026-07-18T16:00:00"), "end_datetime": seconds("2026-07-20T16:00:00"), "multidate": False},
        {"title": "no start"},
    ])
    rows, _ = run("epoch_json", body)
    assert picked(rows, "title", "date", "listed_date", "time", "venue", "description") == [
        ("late", "2026-07-26", "2026-07-26", "11:30 PM", "Hall (1 St)", "a / b"),
        ("spans", "2026-07-18", "2026-07-20", "12:00 PM", "Hall", ""),
    ]


def test_epoch_feed_winter_offset(run):
    body = json.dumps([{"title": "w", "start_datetime": seconds("2026-11-02T00:30:00")}, {"title": "s", "start_datetime": seconds("2026-11-01T04:30:00")}])
    rows, _ = run("epoch_json", body, week=date(2026, 10, 26))
    assert picked(rows, "title", "date", "time") == [("w", "2026-11-01", "7:30 PM"), ("s", "2026-11-01", "12:30 AM")]


def test_date_only_feed_leaves_time_blank(run):
    body = json.dumps([
        {"title": {"rendered": "A &#8211; B"}, "link": "l", "acf": {"date": "2026-07-21 00:00:00", "venue": "X &amp; Y", "price": "$9", "external_artist": "Q&eacute;"}},
        {"title": {"rendered": "C"}, "acf": {"date": "2026-07-22", "external_link": "x"}},
        {"title": {"rendered": "D"}, "acf": {"date": "soon"}},
        {"title": {"rendered": "E"}, "acf": {}},
    ])
    rows, _ = run("date_only_json", body)
    assert picked(rows, "title", "venue", "time", "cost", "url", "description") == [
        ("A – B", "X & Y", "", "$9", "l", "Qé"), ("C", "", "", "", "x", "")
    ]


def test_calendar_feed_never_loses_the_link(run):
    body = json.dumps({"venue": "Default", "fallback_url": "https://f", "items": [
        {"summary": "timed", "location": "Here", "htmlLink": "https://e", "start": {"dateTime": "2026-07-20T19:00:00-04:00"}},
        {"summary": "all day", "start": {"date": "2026-07-26"}},
        {"summary": "gone", "status": "cancelled", "start": {"date": "2026-07-22"}},
        {"summary": "bad", "start": {"dateTime": "never", "date": "2026-07-22"}},
        {"summary": "out", "start": {"date": "2026-07-27"}},
    ]})
    rows, _ = run("calendar_json", body)
    assert picked(rows, "title", "venue", "time", "url") == [
        ("timed", "Here", "7:00 PM", "https://e"), ("all day", "Default", "", "https://f")
    ]


ICAL = """BEGIN:VCALENDAR
BEGIN:VEVENT
DTSTART{params}:{stamp}
SUMMARY:First try
SUMMARY:Boat\\, night
  on the lake
LOCATION:{place}
DESCRIPTION:one\\ntwo: three\\; \\\\n
URL;VALUE=URI:https://u
END:VEVENT
BEGIN:VEVENT
DTSTART:20260801T000000Z
SUMMARY:outside
END:VEVENT
BEGIN:VEVENT
SUMMARY:never closed
END:VCALENDAR
"""


@pytest.mark.parametrize(
    ("stamp", "week", "day", "clock"),
    [
        ("20260722T191500Z", MONDAY, "2026-07-22", "3:15 PM"),
        ("20260721T033000Z", MONDAY, "2026-07-20", "11:30 PM"),
        ("20261101T053000Z", date(2026, 10, 26), "2026-11-01", "1:30 AM"),
        ("20261101T073000Z", date(2026, 10, 26), "2026-11-01", "2:30 AM"),
    ],
)
def test_utc_calendar(run, stamp, week, day, clock):
    for newline in ("\n", "\r\n"):
        body = ICAL.format(params="", stamp=stamp, place="Pier\\, 1 Blvd").replace("\n", newline)
        rows, _ = run("ical_utc", body, week=week)
        # Undoing escapes one after the other reads a doubled backslash before n as backslash, newline.
        assert picked(rows, "title", "date", "time", "venue", "url", "description") == [
            ("Boat, night on the lake", day, clock, "Pier, 1 Blvd", "", "one\ntwo: three; \\")
        ]


def test_online_events(run):
    rows, _ = run("ical_utc", ICAL.format(params="", stamp="20260722T191500Z", place="https://x"))
    assert picked(rows, "venue", "url") == [(fixed.ONLINE_SEE_DESCRIPTION, "https://x")]
    for place in ("", "https://x"):
        rows, _ = run("ical_local", ICAL.format(params=";TZID=America/New_York", stamp="20260721T200000", place=place))
        assert picked(rows, "venue", "url", "date", "time") == [("(online)", "https://u", "2026-07-21", "8:00 PM")]


def test_dated_links(run):
    body = """<a class="event event--tickets" href="https://a.example/?x=1&amp;y=2"><span class="event__title">Film &amp; Talk</span>
      <p class="event__description"> Long <b>text</b> </p>
      <ul><li class="event__detail event__detail--tickets"><span>Tickets</span><span class="event__detail-value">$8 cash</span></li>
      <li class="event__detail event__detail--time"><span>Doors</span><time datetime="19:00">7:00</time></li>
      <li class="event__detail event__detail--time"><span>Show</span><time datetime="19:30"> 7:30 </time></li></ul>
      <time class="event__date" datetime="2026-07-20"><span>Mon</span></time></a>
      <a class="event"><span class="event__title">No link</span><time class="event__date" datetime="2026-07-21"></time></a>
      <a class="event" href="/n"><span class="event__title">No date</span></a>"""
    rows, status = run("html_dated", body)
    assert picked(rows, "title", "date", "time", "cost", "url", "description") == [
        ("Film & Talk", "2026-07-20", "7:00, 7:30", "$8 cash", "https://a.example/?x=1&y=2", "Longtext"),
        ("No link", "2026-07-21", "", "", fixed.LINKS["html_dated"], ""),
    ]
    assert status.events == 2


def test_block_listing(run):
    def block(when, extra=""):
        return f"""<li class="wp-block-post post-1 event type-event"><h1 class="wp-block-post-title x"><a href="https://t">\n RIVERS (2025)\n</a></h1>
          <div class="wp-block-buttons"><a href="https://tickets">Buy</a></div><p class="y wp-block-paragraph">\n {when}\n</p>
          <div class="wp-block-buttons"><a class="z" href="https://maps.app.goo.gl/q">Orchard &amp; Yard</a></div>{extra}</li>"""

    body = "<ul>" + block("July 22, 2026   @ 7:45  pm", '<div class="wp-block-post-terms"><a href="/d">Documentary</a></div>') \
        + block("July 23, 2026 @ 12:05am") + block("Smarch 1, 2026 @ 7:00 pm") + block("someday") + "</ul>"
    rows, _ = run("html_blocks", body)
    assert picked(rows, "title", "date", "time", "venue", "url", "description") == [
        ("RIVERS (2025)", "2026-07-22", "7:45 PM", "Orchard & Yard", "https://t", "Documentary"),
        ("RIVERS (2025)", "2026-07-23", "12:05 AM", "Orchard & Yard", "https://t", ""),
    ]


def test_tagline_listing_takes_the_date_before_it_and_the_nearest_year(run):
    def show(when, title, tagline=""):
        return f"""<div class="rhp-event"><div id="eventDate" class="m">{when}</div><div class="rhp-event-info rhp-event__info--list">
          {f'<div class="eventTagLine t">{tagline}</div>' if tagline else ''}
          <a id="eventTitle" class="url" href="https://e" title="x"><h2 class="rhp-event__title--list">{title}</h2></a>
          <span class="rhp-event__time-text--list">from 6:45 pm</span><span class="rhp-event__cost-text--list">$17.05</span>
          <a class="venueLink" href="/v" title="The Hall">Hall</a></div></div>"""

    body = show("Thu, Dec 31", "LOUD", "Radio Welcomes") + show("Sun, Jan 3", "NEXT") + show("Sat, Jan 9", "LATER")
    rows, _ = run("html_tagline", body, week=date(2026, 12, 28))
    assert picked(rows, "title", "date", "venue", "time", "cost", "description") == [
        ("Radio Welcomes | LOUD", "2026-12-31", "The Hall", "from 6:45 pm", "$17.05", "Radio Welcomes"),
        ("NEXT", "2027-01-03", "The Hall", "from 6:45 pm", "$17.05", ""),
    ]


def test_long_dates_with_and_without_a_year(run):
    def item(when, title):
        return f"""<div class="em-event em-item"><h3 class="em-item-title"><a href="https://e/{title}">{title}</a></h3>
          <div class="em-event-date em-event-meta">{when}</div><div class="em-event-location"><a href="/l">Kings &amp; Queens</a></div>
          <div class="em-item-actions input"><p>for adults, $12</p></div></div>"""

    body = item("January 1", "a") + item("December 31, 2026", "b") + item("January 1, 2026", "c") + item("February 30, 2027", "d")
    rows, _ = run("html_long_date", body, week=date(2026, 12, 28))
    assert picked(rows, "title", "date", "venue", "url", "description") == [
        ("a", "2027-01-01", "Kings & Queens", "https://e/a", "for adults, $12"),
        ("b", "2026-12-31", "Kings & Queens", "https://e/b", "for adults, $12"),
    ]


def test_two_fields(run):
    body = """<div class="showblock"><p class="showdatevenue">July 21, 2026 7:00 PM</p><p class="showdatevenue">Corner Bar</p>
      <h3>Salt &amp; Smoke</h3><p class="showdescription showprice">$20</p><a href="https://d" class="wide btn">buy</a></div>
      <div class="showblock"><p class="showdatevenue">July 22, 2026</p><h3>one field</h3></div>
      <div class="showblock"><p class="showdatevenue">July 23, 2026</p><p class="showdatevenue">Hall</p><h3>no time</h3></div>"""
    rows, _ = run("html_two_fields", body)
    assert picked(rows, "title", "date", "time", "venue", "cost", "url") == [
        ("Salt & Smoke", "2026-07-21", "7:00 PM", "Corner Bar", "$20", "https://d"),
        ("no time", "2026-07-23", "", "Hall", "", fixed.LINKS["html_two_fields"]),
    ]


def test_month_grid_ignores_other_months(run):
    body = """<table><tr><td class="notmonth"><span class="day">28</span><ul><li class="anEvent">9:00 PM<a href="/no">no</a></li></ul></td>
      <td><div class="header"><span class="day">20</span></div><ul><li class="anEvent" data-x="1">7:00 PM<a href="/event/w">Writing &amp; more</a></li>
      <li class="anEvent">All day<a href="/event/o">Open</a></li></ul></td>
      <td><div class="header"><span class="day">5</span></div><ul><li class="anEvent">8:00 PM<a href="/event/x">early</a></li></ul></td>
      <td class="notmonth"><span class="day">21</span><li class="anEvent">1:00 PM<a href="/no">no</a></li></td></tr></table>"""
    rows, _ = run("html_month_grid", body, context=date(2026, 7, 1))
    base = "https://www.therotunda.org"
    assert picked(rows, "title", "date", "time", "url") == [
        ("Writing & more", "2026-07-20", "7:00 PM", base + "/event/w"),
        ("Open", "2026-07-20", "", base + "/event/o"),
    ]


def test_showtimes(run):
    body = (
        "Header\nHarbour\n\nRated:\n\nRuntime:\n1 hr 12 min\n\nStandard\nStandard Format\n1:00p\n11:30a\n35mm\n1:00p\n"
        "The Long Road (2026)\n\nRated:\nR\nRuntime:\n2 hr 5 min\n\nStandard\n12:00p\n"
        "Nothing On\n\nRated:\nPG\nRuntime:\n1 hr\n\nsold out\nNEARBY THEATERS\n9:00p"
    )
    rows, status = run("showtime_text", body, None, context=date(2026, 7, 22), venue="Hall, 1 St", fallback="https://t")
    assert picked(rows, "title", "time", "description") == [
        ("Harbour", "1:00 PM, 11:30 AM", "Rated Not Rated. Runtime: 1 hr 12 min."),
        ("The Long Road (2026)", "12:00 PM", "Rated R. Runtime: 2 hr 5 min."),
    ]
    assert status.status == "ok"
    rows, _ = run("showtime_text", body, context=date(2026, 7, 27), venue="Hall")
    assert rows == []


def test_embedded_descriptions(spark):
    def page(blocks):
        return "<html>" + "".join(f'<script type="application/ld+json">{b}</script>' for b in blocks) + "</html>"

    event = {"@type": "Event", "name": "O&#39;Neil &amp; B", "startDate": "2026-07-22T19:00:00-04:00", "description": "x &amp; y",
             "location": {"name": "Maple &amp; Co", "address": "1 St"}}
    index = "".join(f'<li data-hook="events-card"><a data-hook="title" href="{u}">Card {u}</a></li>' for u in ("a", "b", "c", "d", "e"))
    details = [
        ("a", page(['{"@type": "Organization"}', "not json", json.dumps(event), json.dumps({**event, "name": "second"})])),
        ("b", page([json.dumps({**event, "startDate": "2026-09-09T19:00:00-04:00"})])),
        ("c", None),
        ("d", "<html>shell</html>"),
        ("e", page([json.dumps({**event, "name": "", "location": {"address": "2 St"}})])),
    ]
    payloads = spark.createDataFrame([("src", 0, MONDAY, None, None, None, f"<ul>{index}</ul>")], schemas.PAYLOAD)
    parsed = feeds_html.json_ld(payloads, spark.createDataFrame(details, "url STRING, body STRING"))
    rows = extract.listings(parsed).orderBy("pos").collect()
    assert picked(rows, "title", "venue", "time", "url", "description") == [
        ("O'Neil & B", "Maple & Co, 1 St", "7:00 PM", "a", "x & y"),
        ("Card e", "2 St", "7:00 PM", "e", "x & y"),
    ]
    again = [("a", page([json.dumps({**event, "name": n})]) if n else None, t) for n, t in (("zz older", 1), ("newest", 3), ("middle", 2), (None, 9))]
    rows = extract.listings(feeds_html.json_ld(payloads, spark.createDataFrame(again, "url STRING, body STRING, fetched_at INT"))).collect()
    assert picked(rows, "title", "url") == [("newest", "a")]
    empty = feeds_html.json_ld(payloads.selectExpr("* except(body)", "'<p>' AS body"), spark.createDataFrame(details, "url STRING, body STRING"))
    assert extract.status(empty).first().status == "failed"


def test_markup_of_any_spelling(value):
    from pyspark.sql import functions as F

    from marquee.functions import markup

    page = markup.tokens(F.col("t"))
    read = markup.unescape(markup.words(markup.element(page, markup.tag("span", "t"))))
    assert value(read, [
        '<span class="t">A <span>in</span> tail</span> after',
        "<SPAN id=x class = 't u'>A</SPAN >",
        "<span class=t>A</span>",
        '<!-- <span class="t">no</span> --><span data-a="b c=d" class="t">A</span>',
        '<span class="t"><span><span>deep</span></span><spanner>kept</spanner></span></span>',
        '<span class="other">no</span>',
        '<span class="t"><span>never closed</span>',
        '<span class="t">open <p>inside</span> after',
        '</span></p><b><span class="t">x</b></span>',
        '<span title="a>b" class="t" data-x=it\'s>y &lt; z</span>',
        "<span class='t'>" + "<span>" * 300 + "d" + "</span>" * 301 + "e",
        None,
    ]) == ["Aintail", "A", "A", "A", "deepkept", "", "", "openinside", "x", "y < z", "d", ""]
    href = markup.attribute(page, markup.tag("a"), "href")
    assert value(href, [
        "<a HREF='/x?a=b'>t</a>", "<A title='q' href=/y>t</A>", '<a href="/z?k=v w=1">t</a>', "<a>x href='n'</a>", "<a title=' href=no ' href = yes>", "",
    ]) == ["/x?a=b", "/y", "/z?k=v w=1", "", "yes", ""]
    assert value(F.size(page), ["a = 'b' < 3 and c='d'", "<a <b>", "x</p>y<3"]) == [0, 2, 1]


def test_elements_of_a_page_that_is_not_balanced(run):
    body = """<div class=showblock></p><p class='showdatevenue x'>July 21, 2026 7:00 PM</p><b><p class=showdatevenue>Inn</b></p>
      <h3>Left <i>open</h3><span class=showprice>$3</div></span>
      <DIV class="showblock"><p class="showdatevenue">July 22, 2026</p><p class="showdatevenue">never closed<h3>Next</h3></div>"""
    rows, _ = run("html_two_fields", body)
    assert picked(rows, "title", "date", "venue", "cost") == [
        ("Leftopen", "2026-07-21", "Inn", "$3"), ("Next", "2026-07-22", "", "")
    ]


def test_a_grid_without_its_month_is_broken(run):
    rows, status = run("html_month_grid", '<td><span class="day">20</span><ul><li class="anEvent">7:00 PM<a href="/e">x</a></li></ul></td>')
    assert rows == [] and status.status == "failed"


def test_tags_cut_in_tasks_are_those_of_the_columns(spark):
    import random

    from pyspark.sql import functions as F

    from marquee.functions import markup, pages

    bits = [
        "<a", "<A ", "</a>", "</A >", "<div", "<div>", "</div>", "<b/", ">", ">", " class='x y'", ' class="y"', " class=x", " CLASS = y", ' id="x"', " ID=x",
        " href='p>q'", ' href="a<b"', " href=", '"', "'", " = ", "/", "<!-- ", "-->", "< 3", "<", "t ", "  w\n", "İKK", "<ſ", "&amp;", " z\x85", "<a-é x>",
        " data-class='x'", "\x1c", "<a class='y' class=x>", "<p\x0bclass=x>",
    ]
    draw = random.Random(7)
    bodies = ["".join(draw.choices(bits, k=draw.randint(0, 25))) for _ in range(1_500)] + [None, ""]
    openings = [("a", None, None), (None, "x", None), ("div", "x y", None), (None, None, ("id", "x")), ("a", None, ("href", "p.*"))]
    page = markup.tokens(F.col("body"))
    wanted = [F.transform(page, lambda t: F.array(t["name"], t["head"], t["text"])).alias("t")]
    for i, opening in enumerate(openings):
        match = markup.tag(*opening)
        wanted += [markup.words(markup.element(F.col("page"), match)).alias(f"e{i}"), markup.attribute(F.col("page"), match, "class").alias(f"a{i}")]
        wanted.append(F.size(markup.blocks(F.col("page"), match)).alias(f"b{i}"))
    rows = spark.createDataFrame([(b,) for b in bodies], "body STRING").select("body", F.explode(F.array(page)).alias("page"))
    seen = 0
    for row in rows.select("body", *wanted).collect():
        tags = pages.tokens(row.body)
        assert [list(t) for t in tags] == row.t, row.body
        for i, opening in enumerate(openings):
            match = pages.tag(*opening)
            found = pages.words(pages.element(tags, match)), pages.attribute(tags, match, "class"), len(pages.blocks(tags, match))
            assert found == (row[f"e{i}"], row[f"a{i}"], row[f"b{i}"]), (row.body, opening)
            seen += found[0] != ""
    assert seen > 50


def test_a_group_that_is_never_closed_costs_its_length_once():
    from marquee.functions import pages
    from marquee.sources import feeds_html

    calls = []
    group = lambda g: calls.append(1) or {"when": ""}
    layout = dataclasses.replace(feeds_html.TAGLINE, of_group=group)
    page = pages.tokens('<p id="eventDate">' + "<div class=rhp-event__info--list>" * 500)
    assert len(list(feeds_html._cut(page, layout))) == 500 and len(calls) == 1
