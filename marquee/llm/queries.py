"""Registered queries of the corpus operators, and DuckDB SQL for those that SQL can express."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from marquee.llm import (
    decontamination,
    divergence,
    html_text,
    line_dedup,
    maximal_repeats,
    merkle,
    mixing,
    near_dup,
    packing,
    quality,
    rows,
    secret_scan,
    substring_dedup,
    url_filter,
)

# The rules of the query: (host, path, verdict).
URL_RULES = [
    ("org", "/", "allow"),
    ("example.org", "/es/", "block"),
    ("example.org", "/en/1", "block"),
    ("com", "/fr/", "allow"),
    ("com", "/de/", "block"),
]


def _documents(spark: SparkSession, folder: str, *more: str) -> DataFrame:
    return rows.table(spark, folder, "documents").select("doc_id", "text", *more)


def _sha256(text: Column) -> Column:
    return F.sha2(text.cast("binary"), 256)


def op1_html_extraction(spark: SparkSession, folder: str) -> DataFrame:
    pages = rows.table(spark, folder, "pages").select("page_id", "url", "html")
    return html_text.extract(pages).select("page_id", "url", "text", "n_chars")


def op2_substring_dedup(spark: SparkSession, folder: str) -> DataFrame:
    found = substring_dedup.remove(_documents(spark, folder))
    return found.select(F.col("id").alias("doc_id"), "n_words", "n_removed", _sha256(F.col("kept")).alias("kept_sha256"))


def op3_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    judged = quality.judge(_documents(spark, folder).select("doc_id", "text"), keep=["doc_id"])
    return judged.select(
        "row.doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept",
        F.round("posterior", 6).alias("posterior"),
    )


def op4_mix_sources(spark: SparkSession, folder: str) -> DataFrame:
    planned = mixing.plan(_documents(spark, folder, "source"))
    return planned.select(
        "row.doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken")
    )


def op5_secret_scan(spark: SparkSession, folder: str) -> DataFrame:
    kinds = [rule.kind for rule in secret_scan.RULES]
    base = [rule.kind for rule in secret_scan.BASE]
    found = secret_scan.scan(_documents(spark, folder)).select("row.doc_id", "spans")

    def counted(kind: str) -> Column:
        return F.size(F.filter("spans", lambda x: x["rank"] == kinds.index(kind))).cast("long").alias(f"n_{kind}")

    based = F.filter("spans", lambda x: x["rank"] < len(base))
    return found.select(
        "doc_id",
        *map(counted, base),
        _sha256(secret_scan.written(based, kinds)).alias("base_sha256"),
        secret_scan.written(F.col("spans"), kinds).alias("spans"),
    )


def op6_benchmark_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    found = decontamination.search(_documents(spark, folder), rows.table(spark, folder, "benchmark"), keep=["doc_id"])
    items = decontamination.items_of(F.col("matches"))
    return found.select(
        "row.doc_id",
        "n_words",
        decontamination.n_hit(F.col("matches")).alias("n_hit"),
        F.size(items).cast("long").alias("n_items"),
        _sha256(F.array_join(items, ",")).alias("items_sha256"),
        (F.size("matches") > 0).alias("contaminated"),
    )


def op7_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    found = line_dedup.remove(_documents(spark, folder), keep=["doc_id"])
    return found.select("row.doc_id", "n_lines", "n_removed", _sha256(F.col("kept")).alias("kept_sha256"))


def op8_url_filters(spark: SparkSession, folder: str) -> DataFrame:
    rules = spark.createDataFrame(URL_RULES, "host string, path string, verdict string")
    pages = rows.table(spark, folder, "pages").select("page_id", "url")
    return url_filter.judge(pages, rules).select("page_id", "host", "path", "rule", "verdict")


def op9_minhash_near_dup(spark: SparkSession, folder: str) -> DataFrame:
    found = near_dup.classes(_documents(spark, folder))
    return found.select(F.col("id").alias("doc_id"), "class_id", "class_size")


def op10_suffix_array_dedup(spark: SparkSession, folder: str) -> DataFrame:
    found = maximal_repeats.remove(_documents(spark, folder))
    return found.select(
        F.col("id").alias("doc_id"), "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256")
    )


def op11_lexical_packing(spark: SparkSession, folder: str) -> DataFrame:
    import public_tokenizers

    pieces = packing.pack(_documents(spark, folder), public_tokenizers.path("word_bpe_49k.json"))
    return pieces.select(
        F.col("id").alias("doc_id"), "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset"
    )


def op12_source_divergence(spark: SparkSession, folder: str) -> DataFrame:
    return divergence.audit(_documents(spark, folder, "lang", "source"))


def op13_merkle_manifest(spark: SparkSession, folder: str) -> DataFrame:
    docs = rows.table(spark, folder, "documents")
    tampered = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 0
    # Decimal, so that the greatest count can grow too.
    n_chars = F.col("n_chars").cast("decimal(20,0)") + F.when(tampered, 1).otherwise(0)
    shown = merkle.leaf(*(n_chars if c == "n_chars" else F.col(c) for c in merkle.COLUMNS))
    proven = merkle.manifest(docs.select(*merkle.COLUMNS), carry={"presented": shown})
    return merkle.verify(proven, "presented").select(
        F.col("id").alias("doc_id"), "leaf", "subroot", "root",
        _sha256(F.array_join(F.col("proof.digest"), "")).alias("proof_sha256"), "folded_root", "verified",
    )


_SPACE_CLASS = r"[^\x20\x09-\x0D]+"

_OP4 = rf"""
WITH sized AS (
    SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '{_SPACE_CLASS}')) AS size,
           sha256(coalesce(text, '')) AS digest, row_number() OVER (PARTITION BY doc_id, source, coalesce(text, '')) - 1 AS number
    FROM documents
), sources AS (
    SELECT source, sum(size)::BIGINT AS source_size,
           [5, 2, 1][1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3]::BIGINT AS weight
    FROM sized GROUP BY source
), summed AS (
    SELECT *, 3 * source_size AS cap, sum(source_size) OVER () AS total, sum(weight) OVER () AS weights,
           coalesce(sum(3 * source_size) OVER w, 0) AS cap_before, coalesce(sum(weight) OVER w, 0) AS weight_before
    FROM sources
    WINDOW w AS (ORDER BY 3 * source_size / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), marked AS (
    SELECT *, cap * (weights - weight_before) <= weight * (total - cap_before) AS capped FROM summed
), shared AS (
    SELECT source, source_size,
           CASE WHEN capped THEN cap::DOUBLE
                ELSE (weight * (total - sum(CASE WHEN capped THEN cap ELSE 0 END) OVER ()))::DOUBLE
                     / (weights - sum(CASE WHEN capped THEN weight ELSE 0 END) OVER ())::DOUBLE END AS target
    FROM marked
), rated AS (
    SELECT doc_id, size, source_size, target,
           CASE WHEN source_size > 0 THEN target / source_size ELSE 0 END AS rate,
           ('0x' || substr(sha256('mix-1:' || coalesce(doc_id::VARCHAR, '') || ':' || digest || ':' || number), 1, 13))::BIGINT::DOUBLE
               / 4503599627370496 AS draw
    FROM sized JOIN shared ON sized.source IS NOT DISTINCT FROM shared.source
)
SELECT doc_id, size, source_size, target,
       (size * (floor(rate) + CASE WHEN draw < rate - floor(rate) THEN 1 ELSE 0 END))::BIGINT AS taken
FROM rated
"""


def _op5_sql() -> str:
    found = []
    for rank, rule in enumerate(secret_scan.RULES):
        pattern = rule.pattern.replace("'", "''")
        found.append(f"""
    SELECT rid, '{rule.kind}' AS kind, {rank} AS rank, {rule.least} AS least,
           regexp_extract_all(text, '{pattern}', 0) AS whole, regexp_extract_all(text, '{pattern}', {rule.group}) AS part,
           string_split_regex(text, '{pattern}') AS gaps
    FROM numbered""")
    return f"""
WITH numbered AS (
    SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS text FROM documents
), matched AS ({" UNION ALL ".join(found)}
), single AS (
    SELECT rid, kind, rank, least, unnest(range(1, len(whole) + 1)) AS i, whole, part, gaps FROM matched
), spans AS (
    SELECT rid, kind, rank, length(whole[i]) AS chars,
           list_sum(list_transform(gaps[1:i], lambda x: length(x)))
           + coalesce(list_sum(list_transform(whole[1:i - 1], lambda x: length(x))), 0) AS start
    FROM single WHERE length(part[i]) >= least
), written AS (
    SELECT rid, kind, rank, start, kind || ':' || start::BIGINT || ':' || (start + chars)::BIGINT AS span FROM spans
), gathered AS (
    SELECT rid, count(*) FILTER (kind = 'assign') AS n_assign, count(*) FILTER (kind = 'access') AS n_access,
           count(*) FILTER (kind = 'hex') AS n_hex,
           string_agg(span, ',' ORDER BY start, rank) FILTER (rank < {len(secret_scan.BASE)}) AS base,
           string_agg(span, ',' ORDER BY start, rank) AS spans
    FROM written GROUP BY rid
)
SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
       sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM numbered LEFT JOIN gathered USING (rid)
"""


_OP8 = """
WITH cut AS (
    SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages
), split AS (
    SELECT page_id, translate(regexp_extract(coalesce(rest, ''), '^[^/?#]*'),
               'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
           regexp_extract(coalesce(rest, ''), '^[^/?#]*([^?#]*)', 1) AS path
    FROM cut
), rules(rule_host, rule_path, action) AS (
    VALUES ('org', '/', 'allow'), ('example.org', '/es/', 'block'), ('example.org', '/en/1', 'block'),
           ('com', '/fr/', 'allow'), ('com', '/de/', 'block')
), targets AS (
    SELECT host, path, arg_max(rule_host || rule_path, length(rule_host || rule_path)) AS rule,
           arg_max(action, length(rule_host || rule_path)) AS action
    FROM (SELECT DISTINCT host, path FROM split)
    JOIN rules ON (host = rule_host OR suffix(host, '.' || rule_host)) AND starts_with(path, rule_path)
    GROUP BY host, path
)
SELECT page_id, split.host, split.path, rule, coalesce(action, 'allow') AS verdict
FROM split LEFT JOIN targets ON split.host = targets.host AND split.path = targets.path
"""

_OP2 = rf"""
WITH docs AS (
    SELECT row_number() OVER () AS rid, doc_id, regexp_extract_all(coalesce(text, ''), '{_SPACE_CLASS}') AS w FROM documents
), windows AS (
    SELECT rid, doc_id, i, array_to_string(w[i:i + 49], ' ') AS held
    FROM (SELECT rid, doc_id, w, unnest(range(1, len(w) - 48)) AS i FROM docs)
), lost AS (
    SELECT rid, i FROM windows JOIN (SELECT held, min(doc_id) AS least FROM windows GROUP BY held) USING (held)
    WHERE doc_id > least
), gone AS (
    SELECT DISTINCT rid, i + unnest(range(0, 50)) AS i FROM lost
), words AS (
    SELECT rid, w[i] AS word, i FROM (SELECT rid, w, unnest(range(1, len(w) + 1)) AS i FROM docs)
), kept AS (
    SELECT rid, string_agg(word, ' ' ORDER BY i) AS kept, count(*) AS n
    FROM words ANTI JOIN gone USING (rid, i) GROUP BY rid
)
SELECT doc_id, len(w) AS n_words, len(w) - coalesce(n, 0) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
FROM docs LEFT JOIN kept USING (rid)
"""

_OP6 = r"""
WITH docs AS (
    SELECT row_number() OVER () AS rid, doc_id, regexp_extract_all(translate(coalesce(text, ''),
        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
    FROM documents
), items AS (
    SELECT item_id, regexp_extract_all(translate(coalesce(text, ''),
        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
    FROM benchmark
), item_windows AS (
    SELECT DISTINCT item_id, least(10, len(w)) AS n, array_to_string(w[i:i + least(10, len(w)) - 1], ' ') AS held
    FROM (SELECT item_id, w, unnest(range(1, len(w) - least(10, len(w)) + 2)) AS i FROM items WHERE len(w) > 0)
), doc_windows AS (
    SELECT rid, i, n, array_to_string(w[i:i + n - 1], ' ') AS held
    FROM (SELECT rid, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM docs, (SELECT DISTINCT n FROM item_windows))
), found AS (
    SELECT rid, i, n, item_id FROM doc_windows JOIN item_windows USING (n, held)
), hits AS (
    SELECT rid, count(*) AS n_hit
    FROM (SELECT DISTINCT rid, i + unnest(range(0, n)) AS i FROM (SELECT DISTINCT rid, i, n FROM found)) GROUP BY rid
), named AS (
    SELECT rid, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
    FROM (SELECT DISTINCT rid, item_id::VARCHAR AS item FROM found) GROUP BY rid
)
SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM docs LEFT JOIN hits USING (rid) LEFT JOIN named USING (rid)
"""

# Bytes as pairs of hexadecimal digits.
_OP10 = """
WITH docs AS (
    SELECT row_number() OVER () AS rid, doc_id, hex(encode(coalesce(text, ''))) AS x FROM documents
), windows AS (
    SELECT rid, doc_id, i, substr(x, 2 * i + 1, 100) AS held
    FROM (SELECT rid, doc_id, x, unnest(range(0, length(x) // 2 - 49)) AS i FROM docs)
), lost AS (
    SELECT rid, i FROM windows JOIN (SELECT held, min(doc_id) AS least FROM windows GROUP BY held) USING (held)
    WHERE doc_id > least
), runs AS (
    SELECT rid, first, max(i) + 50 AS past
    FROM (SELECT rid, i, max(begins) OVER (PARTITION BY rid ORDER BY i) AS first
          FROM (SELECT rid, i, CASE WHEN i > coalesce(lag(i) OVER (PARTITION BY rid ORDER BY i), -100) + 50 THEN i END AS begins
                FROM lost))
    GROUP BY rid, first
), pieces AS (
    SELECT rid, first, past - first AS n, coalesce(lag(past) OVER (PARTITION BY rid ORDER BY first), 0) AS since,
           max(past) OVER (PARTITION BY rid) AS ends
    FROM runs
), cut AS (
    SELECT rid, count(*) AS n_spans, sum(n)::BIGINT AS n_removed, max(ends) AS ends,
           string_agg(substr(x, 2 * since + 1, 2 * (first - since)), '' ORDER BY first) AS head
    FROM pieces JOIN docs USING (rid) GROUP BY rid
)
SELECT doc_id, length(x) // 2 AS n_bytes, coalesce(n_removed, 0)::BIGINT AS n_removed, coalesce(n_spans, 0) AS n_spans,
       sha256(unhex(coalesce(head, '') || substr(x, 2 * coalesce(ends, 0) + 1))) AS kept_sha256
FROM docs LEFT JOIN cut USING (rid)
"""

_OP12 = r"""
WITH docs AS (
    SELECT row_number() OVER () AS rid, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
           regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
               '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS w
    FROM documents
), words AS (
    SELECT rid, lang, source, unnest(w) AS term FROM docs
), kept AS (
    SELECT lang, term, count(*) AS n FROM words GROUP BY lang, term HAVING count(DISTINCT rid) >= 10
), counts AS (
    SELECT lang, source, term, count(*) AS n FROM words SEMI JOIN kept USING (lang, term) GROUP BY lang, source, term
), langs AS (
    SELECT lang, count(*) AS v, sum(n) AS total FROM kept GROUP BY lang
), members AS (
    SELECT lang, source, coalesce(sum(n), 0) AS total
    FROM (SELECT DISTINCT lang, source FROM docs) LEFT JOIN counts USING (lang, source) GROUP BY lang, source
), dense AS (
    SELECT m.lang, m.source, k.term, coalesce(c.n, 0) AS n,
           1 + (1000000000::HUGEINT * (coalesce(c.n, 0) + 2)) // (m.total + 2 * v)::HUGEINT AS p,
           1 + (1000000000::HUGEINT * (k.n + 2)) // (langs.total + 2 * v)::HUGEINT AS q
    FROM members m JOIN kept k USING (lang) JOIN langs USING (lang)
    LEFT JOIN counts c ON c.lang = m.lang AND c.source = m.source AND c.term = k.term
), pairs AS (
    SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // (a.p + b.p)) AS value
    FROM dense a JOIN dense b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source
    GROUP BY a.lang, a.source, b.source
), found AS (
    SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(value, 0) AS value
    FROM members a JOIN members b ON a.lang = b.lang AND a.source <> b.source
    LEFT JOIN pairs ON pairs.lang = a.lang AND pairs.source = a.source AND pairs.item = b.source
    UNION ALL
    SELECT lang, source, 'term', term, (p - q) * (p - q) // (p + q) FROM dense WHERE n > 0 AND p > q
), ranked AS (
    SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank FROM found
)
SELECT lang, source, part, item, value::BIGINT AS value, rank::INTEGER AS rank FROM ranked WHERE part = 'pair' OR rank <= 10
"""

# crc32 byte by byte and bit by bit; a proof is folded as a list of digests that begin with the side of the sibling.
_OP13 = """
WITH RECURSIVE named AS (
    SELECT doc_id, lang, n_chars,
           list_reduce([4294967295]::BIGINT[]
                   || list_transform(string_split(doc_id::VARCHAR, ''), lambda c: ascii(c)::BIGINT),
               lambda crc, b: list_reduce([xor(crc, b)] || range(8), lambda r, i: xor(r >> 1, 3988292384 * (r & 1)))) AS crc,
           coalesce(octet_length(encode(doc_id::VARCHAR)) || ':' || doc_id, '-')
           || coalesce(octet_length(encode(source)) || ':' || source, '-')
           || coalesce(octet_length(encode(lang)) || ':' || lang, '-') AS head,
           coalesce(octet_length(encode(text)) || ':' || text, '-') AS tail
    FROM documents
), leaves AS (
    SELECT doc_id, lang, sha256(head || coalesce(length(n_chars::VARCHAR) || ':' || n_chars, '-') || tail) AS leaf,
           sha256(head || coalesce(length(shown::VARCHAR) || ':' || shown, '-') || tail) AS presented
    FROM (SELECT *, n_chars::HUGEINT + CASE WHEN xor(crc, 4294967295) % 7 = 0 THEN 1 ELSE 0 END AS shown FROM named)
), placed AS (
    SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS place,
           count(*) OVER (PARTITION BY lang) AS size
    FROM leaves
), nodes AS (
    SELECT lang, 0 AS level, place, leaf AS digest, size FROM placed
    UNION ALL
    SELECT lang, level + 1, place // 2, sha256(string_agg(digest, '' ORDER BY place)), (size + 1) // 2
    FROM nodes WHERE size > 1 GROUP BY lang, level, place // 2, size
), subroots AS (
    SELECT lang, digest AS subroot, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS place, count(*) OVER () AS size
    FROM nodes WHERE size = 1
), upper AS (
    SELECT 0 AS level, place, subroot AS digest, size FROM subroots
    UNION ALL
    SELECT level + 1, place // 2, sha256(string_agg(digest, '' ORDER BY place)), (size + 1) // 2
    FROM upper WHERE size > 1 GROUP BY level, place // 2, size
), heights AS (
    SELECT lang, max(level) AS height FROM nodes GROUP BY lang
), steps AS (
    SELECT placed.lang, placed.place, l.level,
           CASE WHEN (placed.place >> l.level) % 2 = 1 THEN 'L' ELSE 'R' END || coalesce(o.digest, '') AS step
    FROM placed JOIN heights ON heights.lang IS NOT DISTINCT FROM placed.lang
    JOIN (SELECT unnest(range(0, 40)) AS level) l ON l.level < height
    LEFT JOIN nodes o ON o.lang IS NOT DISTINCT FROM placed.lang AND o.level = l.level
         AND o.place = xor(placed.place >> l.level, 1)
), lower_paths AS (
    SELECT lang, place, list(step ORDER BY level) AS path FROM steps GROUP BY lang, place
), upper_steps AS (
    SELECT subroots.lang, l.level,
           CASE WHEN (subroots.place >> l.level) % 2 = 1 THEN 'L' ELSE 'R' END || coalesce(o.digest, '') AS step
    FROM subroots JOIN (SELECT unnest(range(0, 40)) AS level) l ON l.level < (SELECT max(level) FROM upper)
    LEFT JOIN upper o ON o.level = l.level AND o.place = xor(subroots.place >> l.level, 1)
), upper_paths AS (
    SELECT lang, list(step ORDER BY level) AS path FROM upper_steps GROUP BY lang
), proven AS (
    SELECT doc_id, leaf, presented, subroot, (SELECT digest FROM upper WHERE size = 1) AS root,
           coalesce(low.path, []::VARCHAR[]) || coalesce(high.path, []::VARCHAR[]) AS path
    FROM placed JOIN subroots ON subroots.lang IS NOT DISTINCT FROM placed.lang
    LEFT JOIN lower_paths low ON low.lang IS NOT DISTINCT FROM placed.lang AND low.place = placed.place
    LEFT JOIN upper_paths high ON high.lang IS NOT DISTINCT FROM placed.lang
), folded AS (
    SELECT *, list_reduce([presented] || path, lambda node, s: CASE WHEN s[1] = 'L' THEN sha256(substr(s, 2) || node)
                                                                   ELSE sha256(node || substr(s, 2)) END) AS folded_root
    FROM proven
)
SELECT doc_id, leaf, subroot, root, sha256(array_to_string(list_transform(path, lambda s: substr(s, 2)), '')) AS proof_sha256,
       folded_root, folded_root = root AS verified
FROM folded
"""

QUERIES = {
    "op1_html_extraction": op1_html_extraction,
    "op2_substring_dedup": op2_substring_dedup,
    "op3_quality_rules": op3_quality_rules,
    "op4_mix_sources": op4_mix_sources,
    "op5_secret_scan": op5_secret_scan,
    "op6_benchmark_decontamination": op6_benchmark_decontamination,
    "op7_line_dedup": op7_line_dedup,
    "op8_url_filters": op8_url_filters,
    "op9_minhash_near_dup": op9_minhash_near_dup,
    "op10_suffix_array_dedup": op10_suffix_array_dedup,
    "op11_lexical_packing": op11_lexical_packing,
    "op12_source_divergence": op12_source_divergence,
    "op13_merkle_manifest": op13_merkle_manifest,
}

ORACLES = {
    "op2_substring_dedup": _OP2,
    "op4_mix_sources": _OP4,
    "op5_secret_scan": _op5_sql(),
    "op6_benchmark_decontamination": _OP6,
    "op8_url_filters": _OP8,
    "op10_suffix_array_dedup": _OP10,
    "op12_source_divergence": _OP12,
    "op13_merkle_manifest": _OP13,
}
