"""The whole week: raw bodies to picks, report, log and attendance, with the functions a user calls."""

import json
from datetime import date

from marquee import fixed, schemas
from marquee.operators import collection, ranking
from marquee.plans import weekly
from marquee.sources import week_files

MONDAY = date(2026, 7, 20)
EARLY = 1784300400  # 2026-07-17, 11 AM in Philadelphia


def payload(spark, source, *bodies, fallback=None):
    return spark.createDataFrame([(source, i, MONDAY, None, None, fallback, b) for i, b in enumerate(bodies)], schemas.PAYLOAD)


def calendar(*events):
    items = [{"status": "confirmed", "summary": t, "location": v, "description": d, "htmlLink": f"https://e.org/{t}",
              "start": {"dateTime": f"2026-07-{day}T19:00:00-04:00"}} for t, v, day, d in events]
    return json.dumps({"items": items, "venue": "Home", "fallback_url": "https://e.org/"})


def test_a_week_from_raw_bodies_to_attendance(spark, tmp_path):
    fest = {"title": "Long fest", "slug": "fest", "start_datetime": EARLY, "end_datetime": EARLY + 6 * 86_400, "multidate": True,
            "tags": [], "place": {"name": "Park"}}
    show = ("Loud show", "Hall", 21, "x " * 400 + "punk")
    cards = '<ul><li data-hook="events-card"><a data-hook="title" href="https://f.org/noir">Noir</a></li></ul>'
    event = {"@type": "Event", "name": "Noir", "description": "film", "startDate": "2026-07-22T20:00:00-04:00", "location": {"name": "Box"}}
    details = spark.createDataFrame(
        [("https://f.org/noir", f'<script type="application/ld+json">{json.dumps(event)}</script>')], "url STRING, body STRING"
    )
    payloads = {
        "epoch_json": payload(spark, "philly-ask-a-punk", json.dumps([fest])),
        "calendar_json": payload(spark, "iffy-books", calendar(show, ("Reading", "Shop", 21, "poetry")), calendar(show)),
        "json_ld": payload(spark, "lightbox-film-center", cards),
        "html_tagline": payload(spark, "r5-productions", "<p>changed</p>"),
    }
    label = {slug: name for name, slug, _ in fixed.CATEGORIES}
    categories = spark.createDataFrame(
        [("punk", label["music"]), ("jazz", label["music"]), ("film", label["film"]), ("poetry", label["literary"])], "term STRING, category STRING"
    )
    notes = spark.createDataFrame([(MONDAY, "iffy-books", "partial")], "week DATE, source STRING, note STRING")
    run = weekly.run(
        payloads, collection.registry(spark), categories, ranking.interest_lexicon(spark), "2026-07-20T10:00:00Z", details=details, notes=notes
    )

    told = {r.source: (r.status, r.events, r.note) for r in run.manifest.collect()}
    assert told == {
        "philly-ask-a-punk": ("ok", 1, None), "iffy-books": ("ok", 3, "partial"),
        "lightbox-film-center": ("ok", 1, None), "r5-productions": ("failed", None, None),
    }
    head = run.heads.first()
    assert (head.raw_event_count, head.total_events_after_dedup) == (5, 4)
    assert [f.split(" (")[0] for f in head.collection_failures] == ["r5-productions"]
    got = {r.title: r for r in run.candidates.collect()}
    assert (got["Long fest"].date, got["Long fest"].listed_date) == ("2026-07-17", "2026-07-20")
    assert max(len(r.description) for r in got.values()) <= fixed.DESCRIPTION_CHARS + 1
    # The word that decides stands behind the cap.
    picks = {r.title: (r.day, r["rank"], r.category, r.is_music) for r in run.selection.picks.collect()}
    assert picks == {
        "Long fest": ("2026-07-20", 1, fixed.COMMUNITY, False), "Loud show": ("2026-07-21", 1, label["music"], True),
        "Reading": ("2026-07-21", 2, label["literary"], False), "Noir": ("2026-07-22", 1, label["film"], False),
    }

    weeks, log = str(tmp_path / "weeks"), str(tmp_path / "log")
    week_files.write_day_split(run.candidates, weeks)
    days = spark.read.parquet(f"{weeks}/days").orderBy("date").collect()
    assert [r.n_candidates for r in days] == [1, 2, 1, 0, 0, 0, 0]
    lookup = spark.createDataFrame([("Loud show", "https://m/1", "Loud")], "title STRING, spotify_url STRING, matched_text STRING")
    weekly.write_report(run.selection, lookup, str(tmp_path / "report"))
    assert spark.read.parquet(str(tmp_path / "report/category_cards")).count() == 4
    assert weekly.append_log(spark, run.selection, lookup, log) == (4, 0)
    assert weekly.append_log(spark, run.selection, lookup, log) == (0, 4)
    weekly.record_attendance(spark, log, spark.createDataFrame([("Noir",)], "title STRING"), str(MONDAY))
    assert {r.title: r.attended for r in week_files.read_picks_log(spark, log).collect()} == {
        "Long fest": "false", "Loud show": "false", "Reading": "false", "Noir": "true"
    }
