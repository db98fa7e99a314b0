"""Schemas of the documents and tables the jobs read and write."""

from __future__ import annotations

EVENT = "title STRING, venue STRING, date STRING, time STRING, cost STRING, url STRING, description STRING"
EVENT_FIELDS = ["title", "venue", "date", "time", "cost", "url", "description"]

SOURCE_FILE = f"source STRING, status STRING, reason STRING, collected_at STRING, events ARRAY<STRUCT<{EVENT.replace(' STRING', ': STRING')}>>"

MANIFEST = (
    "week STRING, run_started STRING, run_completed STRING, "
    "sources MAP<STRING, STRUCT<status: STRING, events: BIGINT, reason: STRING, note: STRING>>"
)

EXPECTED_YIELD = (
    "_meta STRUCT<total_floor: BIGINT>, "
    "sources MAP<STRING, STRUCT<min_expected: BIGINT, note: STRING>>"
)

ANNOTATIONS = (
    "week STRING, collection_failures ARRAY<STRING>, days ARRAY<STRUCT<date: STRING, day_name: STRING, "
    "top3: ARRAY<STRUCT<id: STRING, rank: INT, address: STRING, category: STRING, is_music: BOOLEAN, "
    "sold_out: BOOLEAN, why: STRING, time: STRING>>, "
    "honorable_mentions: ARRAY<STRUCT<id: STRING>>, "
    "annotations: ARRAY<STRUCT<id: STRING, category: STRING, sold_out: BOOLEAN, note: STRING>>>>"
)

MUSIC_LOOKUP = "MAP<STRING, STRUCT<spotify_url: STRING, matched_text: STRING>>"

USAGE_LINE = (
    "type STRING, message STRUCT<id: STRING, usage: STRUCT<input_tokens: BIGINT, "
    "cache_creation_input_tokens: BIGINT, cache_read_input_tokens: BIGINT, output_tokens: BIGINT>>"
)

PICKS_LOG = (
    "city STRING, week_of STRING, day STRING, date STRING, title STRING, venue STRING, category STRING, "
    "source STRING, rank STRING, price_tier STRING, spotify_link STRING, tags STRING, attended STRING"
)

PAYLOAD = (
    "source STRING, page BIGINT, week_start DATE, context_date DATE, venue STRING, fallback_url STRING, body STRING"
)
