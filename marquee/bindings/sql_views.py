"""DuckDB definitions of the views in views.py, as named common table expressions."""

from __future__ import annotations

from marquee import fixed
from marquee.functions.category import LABELS

_LABELS = "[" + ", ".join("'" + label + "'" for label in LABELS) + "]"
BLANKS = "(' ' || chr(9) || chr(10) || chr(13))"


def label_at(index: str) -> str:
    return f"list_extract({_LABELS}, CAST({index} AS INT) + 1)"


def label_order(c: str) -> str:
    return f"(list_position({_LABELS}, {c}) - 1)"


def rtrim(c: str) -> str:
    return f"rtrim({c}, {BLANKS})"


def strip(c: str) -> str:
    return f"trim({c}, {BLANKS})"


def cap(c: str, limit: int = fixed.DESCRIPTION_CHARS) -> str:
    return f"CASE WHEN length({c}) > {limit} THEN {rtrim(f'substring({c}, 1, {limit})')} || '…' ELSE {c} END"


CLOCK = r"( ?[1-9]|0[1-9]|1[0-2]):([0-5][0-9]|[0-9])\s+([AaPp][Mm])"


def minutes(c: str) -> str:
    part = lambda i: f"regexp_extract({c}, '^{CLOCK}$', {i})"
    return (
        f"CASE WHEN regexp_full_match({c}, '{CLOCK}') THEN "
        f"TRY_CAST(trim({part(1)}) AS INT) % 12 * 60 + TRY_CAST({part(2)} AS INT) "
        f"+ CASE WHEN lower({part(3)}) = 'pm' THEN 720 ELSE 0 END END"
    )


def clock_of(minute: str) -> str:
    return f"strftime(TIMESTAMP '2024-01-01 00:00:00' + to_minutes(CAST({minute} AS INT)), '%-I:%M %p')"


def placeholder(c: str) -> str:
    t = strip(f"coalesce({c}, '')")
    return f"(starts_with({t}, '*(') AND ends_with({t}, ')*'))"


def unwrap(c: str) -> str:
    t = strip(f"coalesce({c}, '')")
    return f"CASE WHEN {placeholder(c)} THEN {strip(f'substring({t}, 3, length({t}) - 4)')} ELSE {t} END"


def dollars(c: str) -> str:
    return rf"TRY_CAST(nullif(regexp_extract({c}, '\$(\d+(?:\.\d+)?)', 1), '') AS DOUBLE)"


def price_tier(cost: str, sold_out: str) -> str:
    u = f"({unwrap(cost)})"
    return (
        f"CASE WHEN {sold_out} THEN 'paid' WHEN {placeholder(cost)} OR {u} = '' THEN '' "
        f"WHEN lower({u}) IN ('free', 'no cover') THEN 'free' WHEN {dollars(u)} < 15 THEN 'low' "
        f"WHEN {dollars(u)} IS NOT NULL THEN 'paid' ELSE 'free' END"
    )


def weekday_name(c: str) -> str:
    return f"strftime(CAST({c} AS DATE), '%A')"


VIEWS: dict[str, tuple[list[str], str]] = {
    "listing": (
        [],
        f"""
        SELECT DATE '2024-01-01' + CAST(7 * ((n_chars % 28) // 7) AS INT) AS week, source AS stem, doc_id AS pos, source,
               split_part(text, chr(10), 1) AS title, lang AS venue,
               CAST(DATE '2024-01-01' + CAST(n_chars % 28 AS INT) AS VARCHAR) AS date,
               {clock_of('n_chars % 1440')} AS time,
               CASE WHEN source IN ('src1', 'src3', 'src5') THEN '' ELSE '$' || (n_chars % 40) END AS cost,
               CASE WHEN source IN ('src2', 'src4') THEN '' ELSE 'https://example.org/' || doc_id END AS url,
               CASE WHEN source = 'src9' THEN 'SOLD OUT: ' || text ELSE text END AS description
        FROM documents""",
    ),
    "occurrence": (
        [],
        f"""
        SELECT CAST(date_trunc('week', ts) AS DATE) AS week, CAST(CAST(ts AS DATE) AS VARCHAR) AS date, CAST(ts AS DATE) AS day_date,
               'e' || event_id AS id, event_id AS pos, event_id AS ord, printf('s%02d', k % 23) AS stem,
               printf('s%02d', k % 23) AS source, event_type AS title, 'Hall ' || user_id || ', Main St' AS venue,
               CASE WHEN event_type = 'purchase' AND value >= 80 THEN shown || ', 11:00 PM'
                    WHEN event_type = 'view' AND value >= 80 THEN '' ELSE shown END AS time,
               CASE WHEN value < 5 THEN 'Free' WHEN event_type = 'error' AND value >= 100 THEN '*(confirm details)*'
                    WHEN event_type = 'signup' AND value >= 100 THEN ''
                    ELSE '$' || CAST(CAST(value AS DECIMAL(12, 2)) AS VARCHAR) END AS cost,
               'https://example.org/' || event_id AS url, props AS description,
               CASE WHEN k = 99 THEN 'Misc' WHEN k < 98 THEN {label_at('k % 9')} END AS category,
               (event_type = 'purchase' AND value >= 120) AS sold_out, user_id, event_type, value, k, ts
        FROM (SELECT *, CAST(json_extract(props, '$.k') AS INT) AS k, strftime(ts, '%-I:%M %p') AS shown FROM events)""",
    ),
    "placed": (
        ["occurrence"],
        """
        SELECT * REPLACE (CASE WHEN event_type = 'signup' AND value >= 250 THEN 'x' || id ELSE id END AS id),
               CAST(day_date + CASE WHEN event_type = 'error' AND value >= 150 THEN 1 ELSE 0 END AS VARCHAR) AS day
        FROM occurrence""",
    ),
    "annotation": (
        ["placed"],
        f"""
        SELECT week, day, id, category, sold_out, note, pos FROM (
          SELECT *, CASE event_type WHEN 'click' THEN 'Multiple showtimes' WHEN 'view' THEN '' ELSE description END AS note
          FROM placed WHERE NOT (event_type = 'view' AND value < 0.5))
        UNION ALL
        SELECT week, day, id, {label_at('(k + 1) % 9')}, sold_out, 'Multiple showtimes', pos + 1000000000000
        FROM placed WHERE event_type = 'click' AND value >= 200""",
    ),
    "latest": (
        ["annotation"],
        """
        SELECT week, day, id, category, sold_out, note FROM annotation
        QUALIFY row_number() OVER (PARTITION BY week, day, id ORDER BY pos DESC) = 1""",
    ),
    "top_six": (
        ["placed"],
        """
        SELECT *, row_number() OVER (PARTITION BY date ORDER BY value DESC, pos) AS place FROM placed
        QUALIFY place <= 6""",
    ),
    "pick": (
        ["top_six"],
        """
        SELECT week, day, CAST(place AS INT) AS rank, id, category,
               CASE WHEN k >= 10 THEN 'Why ' || pos END AS why, k % 9 = 0 AS is_music, sold_out,
               CASE WHEN user_id < 75 THEN 'Addr ' || (user_id // 25) ELSE '' END AS address,
               CASE WHEN event_type = 'click' AND k < 50 THEN '8:00 PM' END AS time
        FROM top_six WHERE place <= 3""",
    ),
    "mention": (["top_six"], "SELECT week, day, CAST(place AS INT) AS pos, id FROM top_six WHERE place > 3"),
    "resolved_pick": (
        ["pick", "occurrence", "latest"],
        """
        SELECT p.*, c.title AS c_title, c.venue AS c_venue, c.time AS c_time, c.cost AS c_cost, c.url AS c_url,
               c.source AS c_source,
               CASE WHEN c.id IS NULL THEN 'id matches no candidate' WHEN c.date <> p.day THEN 'belongs to another day'
                    WHEN a.id IS NULL THEN 'not in the day''s annotations'
                    WHEN p.category IS NULL THEN 'missing required field category'
                    WHEN p.why IS NULL THEN 'missing required field why' END AS problem
        FROM pick p LEFT JOIN occurrence c ON c.week = p.week AND c.id = p.id
        LEFT JOIN latest a ON a.week = p.week AND a.day = p.day AND a.id = p.id""",
    ),
    "resolved_mention": (
        ["mention", "occurrence", "latest"],
        """
        SELECT m.*, c.title AS c_title, c.venue AS c_venue, c.cost AS c_cost, c.source AS c_source,
               a.category AS a_category, a.sold_out AS a_sold_out,
               CASE WHEN c.id IS NULL THEN 'id matches no candidate' WHEN c.date <> m.day THEN 'belongs to another day'
                    WHEN a.id IS NULL THEN 'not in the day''s annotations' END AS problem
        FROM mention m LEFT JOIN occurrence c ON c.week = m.week AND c.id = m.id
        LEFT JOIN latest a ON a.week = m.week AND a.day = m.day AND a.id = m.id""",
    ),
    "merged_pick": (
        ["resolved_pick"],
        """
        SELECT week, day, rank, id, c_title AS title, c_venue AS venue, nullif(address, '') AS address,
               coalesce(time, c_time, '') AS time, coalesce(nullif(c_cost, ''), 'Not listed') AS cost, c_url AS url,
               category, c_source AS source, is_music, sold_out, why
        FROM resolved_pick WHERE problem IS NULL""",
    ),
    "merged_mention": (
        ["resolved_mention"],
        """
        SELECT week, day, pos, id,
               CASE WHEN a_sold_out AND NOT ends_with(c_title, '(SOLD OUT)') THEN c_title || ' (SOLD OUT)' ELSE c_title END AS title,
               c_venue AS venue, a_category AS category, c_source AS source,
               coalesce(nullif(c_cost, ''), 'Not listed') AS cost, coalesce(a_sold_out, false) AS sold_out
        FROM resolved_mention WHERE problem IS NULL""",
    ),
    "merged_event": (
        ["occurrence", "latest"],
        f"""
        SELECT c.week, a.day, c.id, c.ord, c.title, c.venue, c.time, coalesce(nullif(c.cost, ''), 'Not listed') AS cost,
               c.url, a.category, c.source, a.sold_out, nullif(a.note, '') AS note,
               {label_order('a.category')} AS category_ord, ({minutes('c.time')}) IS NULL AS untimed,
               coalesce({minutes('c.time')}, 0) AS minute
        FROM occurrence c JOIN latest a ON a.week = c.week AND a.id = c.id
        WHERE a.day = c.date AND list_contains({_LABELS}, a.category)""",
    ),
    "flagged": (
        ["merged_event", "merged_pick", "merged_mention"],
        """
        SELECT e.*, EXISTS (SELECT 1 FROM merged_pick p WHERE p.week = e.week AND p.day = e.day AND p.title = e.title) AS is_pick,
               EXISTS (SELECT 1 FROM merged_mention m WHERE m.week = e.week AND m.day = e.day AND m.id = e.id) AS is_mention
        FROM merged_event e""",
    ),
    "carded": (
        ["flagged"],
        """
        SELECT *, row_number() OVER (PARTITION BY week, day, category
                                     ORDER BY is_pick DESC, is_mention DESC, untimed, minute, ord) AS card,
               count(*) OVER (PARTITION BY week, day, category) AS true_count
        FROM flagged""",
    ),
    "music_lookup": (
        ["occurrence"],
        """
        SELECT DISTINCT title, CASE WHEN title <> 'error' THEN 'https://music.example/' || title END AS spotify_url,
               CASE WHEN title <> 'error' THEN substring(title, 2, 3) END AS matched_text
        FROM occurrence""",
    ),
    "linked_pick": (
        ["merged_pick", "music_lookup"],
        """
        SELECT p.*, CASE WHEN p.is_music THEN l.spotify_url END AS spotify_url,
               CASE WHEN p.is_music THEN l.matched_text END AS matched_text
        FROM merged_pick p LEFT JOIN music_lookup l ON l.title = p.title""",
    ),
    "log_row": (
        ["linked_pick", "merged_mention"],
        "".join(
            [
                "SELECT 'Philadelphia' AS city, CAST(week AS VARCHAR) AS week_of, ", weekday_name("day"), " AS day, day AS date, ",
                "title, venue, ", "CASE category " + " ".join(f"WHEN '{n}' THEN '{s}'" for n, s, _ in fixed.CATEGORIES) + " ELSE category END AS category, ",
                "source, CAST(rank AS VARCHAR) AS rank, ", price_tier("cost", "sold_out"), " AS price_tier, ",
                "coalesce(spotify_url, '') AS spotify_link, '' AS tags, '' AS attended FROM linked_pick UNION ALL ",
                "SELECT 'Philadelphia', CAST(week AS VARCHAR), ", weekday_name("day"), ", day, title, venue, ",
                "CASE category " + " ".join(f"WHEN '{n}' THEN '{s}'" for n, s, _ in fixed.CATEGORIES) + " ELSE category END, ",
                "source, 'HM', ", price_tier("cost", "sold_out"), ", '', '', '' FROM merged_mention",
            ]
        ),
    ),
    "manifest": (
        ["occurrence"],
        """
        SELECT week, source, CASE WHEN source = 's07' THEN 'failed' ELSE 'ok' END AS status,
               CASE WHEN source <> 's07' THEN count(*) END AS events, min(ts) AS started, max(ts) AS completed
        FROM occurrence GROUP BY week, source""",
    ),
    "floors": ([], "SELECT printf('s%02d', n_nationkey) AS source, n_regionkey * 30 AS min_expected FROM nation"),
    "stamps": (
        [],
        """
        SELECT CAST(date_trunc('year', o_orderdate) AS DATE) AS week, CAST(o_orderkey AS VARCHAR) AS source, o_orderdate,
               o_orderstatus, strftime(o_orderdate, '%Y-%m-%dT10:00:00') ||
               CASE o_orderstatus WHEN 'O' THEN '+00:00' WHEN 'F' THEN 'Z' ELSE '-05:00' END AS collected_at,
               o_orderdate + CASE WHEN o_orderstatus = 'P' THEN INTERVAL 15 HOUR ELSE INTERVAL 10 HOUR END AS stamped_at
        FROM orders""",
    ),
    "usage_line": (
        [],
        """
        SELECT strftime(l_shipdate, '%Y') AS session,
               CASE WHEN l_returnflag || l_linestatus = 'NO' THEN '' ELSE l_returnflag || l_linestatus END AS agent,
               l_orderkey AS message_id,
               CAST(l_linenumber AS BIGINT) * 100000000000000000 + l_partkey * 10000000000 + l_suppkey * 100000
                 + CAST(l_quantity AS BIGINT) * 1000 + CAST(round(l_discount * 100) AS BIGINT) * 10
                 + CASE WHEN l_tax = 0 THEN 1 ELSE 0 END AS line_no,
               CAST(l_quantity AS BIGINT) AS input_tokens, l_partkey AS cache_creation_input_tokens,
               l_suppkey AS cache_read_input_tokens,
               CASE WHEN l_tax <> 0 THEN CAST(round(l_discount * 100) AS BIGINT) END AS output_tokens
        FROM lineitem""",
    ),
    "reading": (
        ["usage_line"],
        """
        SELECT session, agent, message_id, input_tokens, cache_creation_input_tokens, cache_read_input_tokens, output_tokens
        FROM usage_line QUALIFY row_number() OVER (PARTITION BY session, agent, message_id ORDER BY line_no DESC) = 1""",
    ),
    "usage_total": (
        ["reading"],
        """
        SELECT session, agent, CASE grouping(session, agent) WHEN 3 THEN 'all' WHEN 1 THEN 'session'
               ELSE CASE WHEN agent = '' THEN 'main' ELSE 'agent' END END AS scope,
               CAST(sum(coalesce(input_tokens, 0)) AS BIGINT) AS input_tokens,
               CAST(sum(coalesce(cache_creation_input_tokens, 0)) AS BIGINT) AS cache_creation_input_tokens,
               CAST(sum(coalesce(cache_read_input_tokens, 0)) AS BIGINT) AS cache_read_input_tokens,
               CAST(sum(coalesce(output_tokens, 0)) AS BIGINT) AS output_tokens, count(*) AS message_count
        FROM reading GROUP BY ROLLUP (session, agent)""",
    ),
    "words": (
        [],
        r"""
        SELECT doc_id, t AS term, count(*) AS n
        FROM (SELECT doc_id, unnest(regexp_extract_all(lower(text), '[\pL\pN]+')) AS t FROM documents) GROUP BY ALL""",
    ),
    "bench_words": (
        [],
        r"SELECT DISTINCT item_id, unnest(regexp_extract_all(lower(text), '[\pL\pN]+')) AS term FROM benchmark",
    ),
    "part_title": (
        [],
        """
        SELECT p_partkey AS pos, p_type AS kind, CASE WHEN p_type = 'ECONOMY' THEN p_brand || ': ' || p_name
               ELSE p_name || ' & ' || p_type END AS title FROM part""",
    ),
    "known_name": (
        [],
        """
        SELECT key, arg_min(url, (rank, url)) AS url FROM (
          SELECT lower(p_name) AS key, 'https://music.example/p' || p_partkey AS url, p_partkey AS rank FROM part WHERE p_size > 40
          UNION ALL SELECT lower(s_name), 'https://music.example/s' || s_suppkey, s_suppkey FROM supplier) GROUP BY key""",
    ),
    "title_name": (
        ["part_title"],
        """
        SELECT DISTINCT title, u.nth, u.name FROM part_title, LATERAL (
          SELECT unnest([1, 2, 3]) AS nth, unnest([title,
            CASE WHEN contains(title, ': ') THEN split_part(title, ': ', 1) ELSE split_part(title, ' & ', 1) END,
            CASE WHEN contains(title, ': ') THEN split_part(title, ': ', 2) END]) AS name) u WHERE u.name IS NOT NULL""",
    ),
    "looked_up": (
        ["title_name", "known_name"],
        """
        SELECT t.title, m.url AS spotify_url, m.name AS matched_text FROM (SELECT DISTINCT title FROM part_title) t
        LEFT JOIN (SELECT title, arg_min(k.url, nth) AS url, arg_min(n.name, nth) AS name
                   FROM title_name n JOIN known_name k ON k.key = lower(n.name) GROUP BY title) m ON m.title = t.title""",
    ),
}


def _ordered(names: list[str], seen: list[str]) -> list[str]:
    for name in names:
        if name not in seen:
            _ordered(VIEWS[name][0], seen)
            seen.append(name)
    return seen


def with_views(names: list[str], query: str) -> str:
    """A query preceded by the views it needs, in dependency order."""
    ctes = [f"{name} AS ({VIEWS[name][1].strip()})" for name in _ordered(names, [])]
    body = query.strip()
    if not ctes:
        return body
    head = "WITH " + ",\n".join(ctes)
    return head + ",\n" + body[5:] if body.startswith("WITH ") else head + "\n" + body
