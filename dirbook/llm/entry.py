"""The registered corpus queries, each over its whole table, and their SQL where SQL can express them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from dirbook.llm.bpe import token_digests
from dirbook.llm.divergence import audit
from dirbook.llm.exact import exact_groups
from dirbook.llm.html_templates import main_text
from dirbook.llm.merkle import manifest
from dirbook.llm.ngram_join import components
from dirbook.llm.packing import pack
from dirbook.llm.quality import quality_report
from dirbook.llm.substring import remove_repeats as remove_repeated_words
from dirbook.llm.suffix_array import remove_repeats
from dirbook.llm.suffix_tree_lm import score
from dirbook.llm.warc import round_trip
from dirbook.llm.winnowing import fingerprints


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/pages.parquet")


def op1_site_templates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return main_text(pages(spark, sf_dir))


def op2_suffix_tree_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score(documents(spark, sf_dir))


def op3_two_stage_suffixes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(documents(spark, sf_dir))


def op4_salvage_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return round_trip(pages(spark, sf_dir))


def op5_forced_boundary_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_digests(documents(spark, sf_dir))


def op6_combination_prefixes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return components(documents(spark, sf_dir)).select("doc_id", "n_shingles", "component_id")


def op7_seed_and_extend(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeated_words(documents(spark, sf_dir))


def op8_block_naming(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_groups(documents(spark, sf_dir)).drop("rid")


def op9_quality_cascade(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_report(documents(spark, sf_dir))


def op10_shortest_pack_first(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(documents(spark, sf_dir))


def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return manifest(documents(spark, sf_dir))


def op12_source_tries(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit(documents(spark, sf_dir))


def op13_winnowed_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints(documents(spark, sf_dir))


QUERIES = {f.__name__: f for f in (op1_site_templates, op2_suffix_tree_scores, op3_two_stage_suffixes, op4_salvage_warc, op5_forced_boundary_bpe, op6_combination_prefixes, op7_seed_and_extend, op8_block_naming, op9_quality_cascade, op10_shortest_pack_first, op11_merkle_manifest, op12_source_tries, op13_winnowed_fingerprints)}

WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"

OP4 = """
WITH p AS (SELECT page_id, coalesce(html, '') AS html, sha1(coalesce(html, '')) AS hex FROM pages),
g AS (SELECT *, max(page_id) OVER (PARTITION BY html) AS last FROM p)
SELECT page_id, CAST(octet_length(encode(html)) AS BIGINT) AS payload_bytes,
  array_to_string(list_transform(range(0, 32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
    CAST(((CAST('0x' || substr(hex, CAST((i // 4) * 5 + 1 AS INT), 5) AS BIGINT) >> CAST(15 - 5 * (i % 4) AS INT)) & 31) + 1 AS INT), 1)), '') AS payload_digest,
  CASE WHEN page_id = last THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id = last THEN NULL ELSE last END AS refers_to
FROM g
"""

OP8 = """
SELECT doc_id, max(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size, doc_id = max(doc_id) OVER g AS kept,
  sha256(coalesce(text, '')) AS text_sha256
FROM documents WINDOW g AS (PARTITION BY coalesce(text, ''))
"""

OP9 = rf"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS text, {WORDS} AS w,
    list_filter(string_split(coalesce(text, ''), chr(10)), lambda l: regexp_matches(l, '[^\x20\x09-\x0D]')) AS lines FROM documents),
t AS (SELECT doc_id, unnest(range(1, len(w) - 1)) AS i, w FROM d),
k AS (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, w[i], w[i + 1], w[i + 2]) AS n FROM t),
r AS (SELECT doc_id, count(DISTINCT p) AS n FROM (SELECT doc_id, unnest([i, i + 1, i + 2]) AS p FROM k WHERE n >= 2) GROUP BY doc_id),
f AS (SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(list_sum(list_transform(w, lambda x: length(x))), 0) AS BIGINT) AS word_chars,
    CAST(length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
    CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines, CAST(coalesce(r.n, 0) AS BIGINT) AS n_repeat_words, len(lines) AS n_lines
  FROM d LEFT JOIN r ON d.doc_id = r.doc_id)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
  NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words OR word_chars NOT BETWEEN 2 * n_words AND 15 * n_words OR 10 * n_symbols > 3 * n_words OR 2 * n_dup_lines > n_lines) AS kept
FROM f
"""

OP6 = r"""
WITH RECURSIVE d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (SELECT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
  ELSE list_distinct(list_transform(range(1, len(w) - 3), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] || ' ' || w[i + 3] || ' ' || w[i + 4])) END) AS t FROM d),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
b AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS c FROM s x JOIN s y ON x.t = y.t AND x.doc_id <> y.doc_id GROUP BY ALL),
l AS (SELECT a, b FROM b JOIN n p ON p.doc_id = a JOIN n q ON q.doc_id = b WHERE 100 * c >= 80 * (p.n + q.n - c)),
r AS (SELECT doc_id, doc_id AS c FROM d UNION SELECT l.b, r.c FROM r JOIN l ON l.a = r.doc_id)
SELECT d.doc_id, CAST(coalesce(n.n, 0) AS BIGINT) AS n_shingles, c.component_id FROM d LEFT JOIN n ON n.doc_id = d.doc_id
JOIN (SELECT doc_id, min(c) AS component_id FROM r GROUP BY doc_id) c ON c.doc_id = d.doc_id
"""

OP7 = rf"""
WITH d AS (SELECT doc_id, {WORDS} AS w FROM documents),
t AS (SELECT doc_id, unnest(range(1, len(w) - 33)) AS i, w FROM d WHERE len(w) >= 35),
k AS (SELECT doc_id, i, count(*) OVER (PARTITION BY array_to_string(w[i : i + 34], ' ')) AS n FROM t),
g AS (SELECT doc_id, list(DISTINCT p) AS gone FROM (SELECT doc_id, unnest(range(i, i + 35)) AS p FROM k WHERE n > 1) GROUP BY doc_id),
o AS (SELECT d.doc_id, w, list_filter(range(1, len(w) + 1), lambda i: gone IS NULL OR NOT list_contains(gone, i)) AS kept FROM d LEFT JOIN g ON g.doc_id = d.doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(len(w) - len(kept) AS BIGINT) AS n_removed,
  sha256(array_to_string(list_transform(kept, lambda i: w[i]), ' ')) AS kept_sha256
FROM o
"""

_MARKED = "coalesce(CAST(strlen(CAST({0} AS VARCHAR)) AS VARCHAR) || ':' || CAST({0} AS VARCHAR), '-')"
_CRC32 = """xor(4294967295, list_reduce(list_concat([4294967295], list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda c: CAST(ascii(c) AS BIGINT))),
    lambda crc, b: list_reduce(list_concat([xor(crc, b)], range(0, 8)), lambda x, i: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END)))"""


def _digest(text: str) -> str:
    return "sha256(" + " || ".join(_MARKED.format(c) for c in ("doc_id", "source", "lang", "n_chars", text)) + ")"


OP11 = f"""
WITH RECURSIVE h AS (SELECT doc_id, lang, {_digest("text")} AS leaf,
    CASE WHEN {_CRC32} % 3 = 0 THEN {_digest("translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')")} ELSE {_digest("text")} END AS now FROM documents),
d AS (SELECT *, row_number() OVER () AS r, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos, count(*) OVER (PARTITION BY lang) AS n FROM h),
x AS (SELECT lang, 0 AS level, pos, n, leaf AS digest FROM d
  UNION ALL SELECT lang, level + 1, pos >> 3, (n + 7) >> 3, sha256(string_agg(digest, '' ORDER BY pos)) FROM x WHERE n > 1 GROUP BY lang, level, pos >> 3, n),
s AS (SELECT lang, digest AS subroot, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS pos, count(*) OVER () AS n FROM x WHERE n = 1),
y AS (SELECT 0 AS level, pos, n, subroot AS digest FROM s
  UNION ALL SELECT level + 1, pos >> 3, (n + 7) >> 3, sha256(string_agg(digest, '' ORDER BY pos)) FROM y WHERE n > 1 GROUP BY level, pos >> 3, n),
m AS (SELECT r, 0 AS tree, level, x.pos - (d.pos >> (3 * level)) AS side, digest FROM d JOIN x ON x.lang IS NOT DISTINCT FROM d.lang AND x.n > 1 AND x.pos >> 3 = d.pos >> (3 * (level + 1))
  UNION ALL SELECT r, 1, level, y.pos - (s.pos >> (3 * level)), digest FROM d JOIN s ON s.lang IS NOT DISTINCT FROM d.lang JOIN y ON y.n > 1 AND y.pos >> 3 = s.pos >> (3 * (level + 1))),
l AS (SELECT r, tree, level, coalesce(string_agg(digest, '' ORDER BY side) FILTER (side < 0), '') AS b, coalesce(string_agg(digest, '' ORDER BY side) FILTER (side > 0), '') AS a FROM m GROUP BY ALL),
p AS (SELECT r, string_agg(b || a, '' ORDER BY tree, level) AS proof, list(b || '|' || a ORDER BY tree, level) AS sides FROM l GROUP BY r),
f AS (SELECT doc_id, leaf, subroot, (SELECT digest FROM y WHERE n = 1) AS root, sha256(coalesce(proof, '')) AS proof_sha256,
    list_reduce(list_concat([now], coalesce(sides, [])), lambda u, v: sha256(string_split(v, '|')[1] || u || string_split(v, '|')[2])) AS folded_root
  FROM d JOIN s ON s.lang IS NOT DISTINCT FROM d.lang LEFT JOIN p ON p.r = d.r)
SELECT *, folded_root = root AS verified FROM f
"""

OP12 = r"""
WITH d AS (SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS w FROM documents),
t AS (SELECT r, lang, source, unnest(w) AS term FROM d),
v AS (SELECT lang, term FROM t GROUP BY lang, term HAVING count(DISTINCT r) >= 10),
c AS (SELECT lang, source, term, count(*) AS n FROM t JOIN v USING (lang, term) GROUP BY ALL),
g AS (SELECT DISTINCT lang, source FROM d),
s AS (SELECT g.lang, g.source, v.term, CAST(coalesce(c.n, 0) AS HUGEINT) AS n FROM g JOIN v ON v.lang = g.lang LEFT JOIN c ON c.lang = g.lang AND c.source = g.source AND c.term = v.term),
p AS (SELECT *, 1 + (1000000000 * (n + 2)) // (sum(n) OVER (PARTITION BY lang, source) + 2 * count(*) OVER (PARTITION BY lang, source)) AS p FROM s),
l AS (SELECT lang, term, sum(n) AS n FROM s GROUP BY ALL),
q AS (SELECT lang, term, 1 + (1000000000 * (n + 2)) // (sum(n) OVER (PARTITION BY lang) + 2 * count(*) OVER (PARTITION BY lang)) AS q FROM l),
f AS (SELECT a.lang, a.source, b.source AS item, sum(((a.p - b.p) * (a.p - b.p)) // (a.p + b.p)) AS value
  FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
e AS (SELECT a.lang, a.source, 'pair' AS part, b.source AS item, CAST(coalesce(f.value, 0) AS BIGINT) AS value
  FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source LEFT JOIN f ON f.lang = a.lang AND f.source = a.source AND f.item = b.source
  UNION ALL SELECT lang, source, 'term', term, CAST(((p - q) * (p - q)) // (p + q) AS BIGINT) FROM p JOIN q USING (lang, term) WHERE n > 0 AND p > q),
k AS (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, encode(item)) AS rank FROM e)
SELECT lang, source, part, item, value, CAST(rank AS INTEGER) AS rank FROM k WHERE part = 'pair' OR rank <= 10
"""

ORACLES: dict[str, str] = {"op4_salvage_warc": OP4, "op6_combination_prefixes": OP6, "op7_seed_and_extend": OP7, "op8_block_naming": OP8, "op9_quality_cascade": OP9, "op11_merkle_manifest": OP11, "op12_source_tries": OP12}
