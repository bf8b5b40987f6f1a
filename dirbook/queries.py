"""Registered queries of the directory engine over the driver's tables, each with the SQL that checks it."""

from __future__ import annotations

import json
from collections.abc import Callable

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dirbook import dictionary as D
from dirbook.functions import address as A
from dirbook.functions import arrays as R
from dirbook.functions import phone as P
from dirbook.functions import text as T
from dirbook.functions import jsons as N
from dirbook.functions.images import png
from dirbook.functions.jsons import extract_object
from dirbook.operators import export as X
from dirbook.operators import harvest as H
from dirbook.operators import jobs as J
from dirbook.operators import layout as L
from dirbook.operators import publish as B
from dirbook.operators import repair as Q
from dirbook.operators import segments as S
from dirbook.operators import similar
from dirbook.operators import windows as W
from dirbook.plans import split
from dirbook.plans.split import FileSink, attempt_name
from dirbook.sources import books
from dirbook.sources.shared import shared_folder
from dirbook.views import load, with_views

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    def put(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = with_views(sql)
        return f

    return put


def _values(rows) -> str:
    return ", ".join("(" + ", ".join(str(x) if isinstance(x, int) else "'" + str(x) + "'" for x in row) + ")" for row in rows)


# -- publish ------------------------------------------------------------------------------------------------------

_PUBLISHED = """
SELECT regexp_replace(regexp_replace(regexp_replace(regexp_replace(translate(phone_raw, 'ー', '-'), '\\s+', '', 'g'), '-+', '-', 'g'), '^-|-$', '', 'g'), '(代表|代)$', '') AS phone, name, row_idx FROM v_phone_raw
"""


@query(f"""WITH p AS ({_PUBLISHED}) SELECT phone, name, min(row_idx) AS row_idx FROM p
WHERE regexp_full_match(phone, '06-[0-9]{{3}}-[0-9]{{4}}') GROUP BY phone, name
ORDER BY CAST(split_part(phone, '-', 2) AS INT), CAST(split_part(phone, '-', 3) AS INT), row_idx""")
def publish_dedupe_sort(spark, sf_dir):
    rows = load(spark, sf_dir, "v_phone_raw").withColumnRenamed("phone_raw", "phone")
    return B.publish(rows, ("phone", "name"))


@query(f"""WITH p AS ({_PUBLISHED}), v AS (SELECT *, regexp_full_match(phone, '06-[0-9]{{3}}-[0-9]{{4}}') AS ok FROM p)
SELECT count(*) AS total, count(*) FILTER (NOT ok) AS invalid, count(*) FILTER (ok) - count(DISTINCT (phone, name)) FILTER (ok) AS duplicates,
count(DISTINCT (phone, name)) FILTER (ok) AS published FROM v""")
def publish_skip_counts(spark, sf_dir):
    rows = load(spark, sf_dir, "v_phone_raw").withColumnRenamed("phone_raw", "phone")
    return B.skip_counts(rows, ("phone", "name"))


@query("""WITH a AS (SELECT row_idx, translate(phone_raw, '()', '--') AS p FROM v_phone_raw),
b AS (SELECT row_idx, regexp_replace(regexp_replace(regexp_replace(p, '-+', '-', 'g'), '^-|-$', '', 'g'), '(代表|代)$', '') AS p FROM a),
c AS (SELECT row_idx, p, CASE WHEN p LIKE '※%' THEN substr(p, 2) ELSE p END AS q FROM b)
SELECT row_idx, CASE WHEN p = '' THEN '' WHEN q LIKE '0%' THEN q ELSE '06-' || q END AS phone FROM c""")
def phone_normalize(spark, sf_dir):
    return load(spark, sf_dir, "v_phone_raw").select("row_idx", P.export_number(F.col("phone_raw")).alias("phone"))


@query("SELECT doc_id, regexp_extract(coalesce(text, ''), '" + P.PATTERN + "', 0) AS phone FROM documents")
def phone_extract(spark, sf_dir):
    return load(spark, sf_dir, "documents").select("doc_id", P.first_number(F.coalesce("text", F.lit(""))).alias("phone"))


@query("""WITH s AS (SELECT row_idx, unnest(string_split(phones_text, '、')) AS p, generate_subscripts(string_split(phones_text, '、'), 1) AS i FROM v_entry),
f AS (SELECT row_idx, '06-' || p AS p, min(i) AS i FROM s GROUP BY row_idx, p)
SELECT row_idx, string_agg(p, '/' ORDER BY i) AS phones, count(*) AS n FROM f GROUP BY row_idx""")
def phone_candidates(spark, sf_dir):
    found = P.number_candidates(F.array("phones_text"), F.lit(""))
    return load(spark, sf_dir, "v_entry").select("row_idx", F.array_join(found, "/").alias("phones"), F.size(found).cast("long").alias("n"))


# -- addresses ----------------------------------------------------------------------------------------------------

_DICT = "d(valid_from, prefix, kind, prefecture, municipality, precedence) AS (VALUES " + _values((v, e.prefix, e.kind, e.prefecture, e.municipality, e.precedence) for v in (D.EARLY, D.LATE) for e in D.entries(v)) + ")"
_HEADS = "h(valid_from, prefix) AS (VALUES " + _values((v, p) for v in (D.EARLY, D.LATE) for p in D.starts(v)) + ")"
_TOWNS = "t(valid_from, district, name, town) AS (VALUES " + _values((v, x, n, t) for v in (D.EARLY, D.LATE) for n, t in D.profile(v).towns.items() for x, y in D.district_names().items() if t.startswith(y)) + ")"
_ADDRESS = "a AS (SELECT row_idx, address, as_of, CASE WHEN as_of >= '1968-03-01' THEN '1968-03-01' ELSE '1963-02-01' END AS v FROM v_address)"


@query(f"""WITH {_HEADS}, {_ADDRESS}
SELECT row_idx, coalesce(arg_max(h.prefix, length(h.prefix)), '') AS prefix FROM a LEFT JOIN h ON h.valid_from = a.v AND starts_with(address, h.prefix) AND address <> h.prefix GROUP BY row_idx""")
def address_longest_prefix(spark, sf_dir):
    text = A.tidy_address(F.col("address"))
    late = A.valid_from(F.col("as_of")) == D.LATE
    return load(spark, sf_dir, "v_address").select("row_idx", F.when(late, A.longest_prefix(text, D.LATE)).otherwise(A.longest_prefix(text, D.EARLY)).alias("prefix"))


#: From a(row_idx, v, address) to f(row_idx, prefecture, municipality, rest).
_SPLIT = """s AS (SELECT row_idx, v, address, 1 AS k, split_part(address, ',', 1) AS p, substr(address, instr(address, ',') + 1) AS rest FROM a WHERE instr(address, ',') > 1
  UNION ALL SELECT row_idx, v, any_value(address), 2, arg_max(h.prefix, length(h.prefix)), substr(any_value(address), max(length(h.prefix)) + 1) FROM a JOIN h ON h.valid_from = a.v AND starts_with(address, h.prefix) AND address <> h.prefix GROUP BY row_idx, v),
w AS (SELECT row_idx, k, p, rest, arg_max(t.town, length(t.name)) AS town, max(length(t.name)) AS n FROM s JOIN t ON t.valid_from = s.v AND t.district = s.p AND starts_with(s.rest, t.name) GROUP BY ALL),
e AS (SELECT row_idx, k, p, rest, arg_min(d.prefecture, precedence) AS prefecture, arg_min(d.municipality, precedence) AS municipality FROM s JOIN d ON d.valid_from = s.v AND d.prefix = s.p GROUP BY ALL),
r AS (SELECT row_idx, k, 0 AS o, '大阪府' AS prefecture, town AS municipality, trim(substr(rest, n + 1), ',') AS rest FROM w
  UNION ALL SELECT row_idx, k, 1, prefecture, municipality, coalesce((SELECT trim(substr(e.rest, length(c) + 1), ',') FROM (SELECT unnest([p, regexp_replace(regexp_replace(p, '^.*郡', ''), '[市町村区]$', ''), regexp_replace(regexp_replace(municipality, '^.*郡', ''), '[市町村区]$', '')]) AS c) q WHERE length(c) > 1 AND starts_with(e.rest, c) ORDER BY length(c) DESC LIMIT 1), e.rest) FROM e),
b AS (SELECT row_idx, arg_min(prefecture, k * 2 + o) AS prefecture, arg_min(municipality, k * 2 + o) AS municipality, arg_min(rest, k * 2 + o) AS rest FROM r GROUP BY row_idx),
f AS (SELECT a.row_idx, coalesce(b.prefecture, '大阪府') AS prefecture, coalesce(b.municipality, '大阪市') AS municipality, coalesce(b.rest, a.address) AS rest FROM a LEFT JOIN b ON b.row_idx = a.row_idx)"""


@query(f"""WITH {_DICT}, {_HEADS}, {_TOWNS}, {_ADDRESS},
{_SPLIT}
SELECT row_idx, prefecture, municipality, trim(regexp_replace(rest, '[0-9]+(-[0-9]+)*$', '')) AS area, regexp_extract(rest, '[0-9]+(-[0-9]+)*$', 0) AS lot FROM f""")
def address_split(spark, sf_dir):
    return A.split_address(load(spark, sf_dir, "v_address"), "address", "as_of").select("row_idx", "prefecture", "municipality", "area", "lot")


@query("SELECT row_idx, regexp_extract(address, '([0-9]+(?:-[0-9]+)*)$', 1) AS lot FROM v_address")
def lot_split(spark, sf_dir):
    return load(spark, sf_dir, "v_address").select("row_idx", A.lot_number(F.col("address")).alias("lot"))


@query("SELECT o_orderkey, CASE WHEN strftime(o_orderdate, '%Y-%m-%d') >= '1968-03-01' THEN '1968-03-01' ELSE '1963-02-01' END AS valid_from FROM orders")
def address_profile_asof(spark, sf_dir):
    day = F.date_format("o_orderdate", "yyyy-MM-dd")
    return load(spark, sf_dir, "orders").select("o_orderkey", A.valid_from(day).alias("valid_from"))


_BOOK = "'^(昭和)([0-9]+)年([0-9]+)月([0-9]+)日(.+)$'"


@query(f"""SELECT row_idx, CASE WHEN regexp_matches(book, {_BOOK}) THEN printf('%04d-%02d-%02d', 1925 + CAST(regexp_extract(book, {_BOOK}, 2) AS INT), CAST(regexp_extract(book, {_BOOK}, 3) AS INT), CAST(regexp_extract(book, {_BOOK}, 4) AS INT)) ELSE 'unknown-date' END AS as_of FROM v_bookname""")
def era_date_parse(spark, sf_dir):
    return load(spark, sf_dir, "v_bookname").select("row_idx", T.book_date(F.col("book")).alias("as_of"))


@query(f"""WITH b AS (SELECT row_idx, book, regexp_matches(book, {_BOOK}) AS ok, CASE WHEN regexp_matches(book, {_BOOK}) THEN printf('%04d-%02d-%02d', 1925 + CAST(regexp_extract(book, {_BOOK}, 2) AS INT), CAST(regexp_extract(book, {_BOOK}, 3) AS INT), CAST(regexp_extract(book, {_BOOK}, 4) AS INT)) ELSE 'unknown-date' END AS d, regexp_extract(book, {_BOOK}, 5) AS r FROM v_bookname),
k AS (SELECT *, CASE WHEN r LIKE '%50音別電話番号簿' THEN '50音別電話番号簿' WHEN r LIKE '%職業別電話番号簿' THEN '職業別電話番号簿' ELSE '電話番号簿' END AS t FROM b)
SELECT row_idx, d || '-' || CASE WHEN ok THEN CASE WHEN r LIKE '%' || t THEN substr(r, 1, length(r) - length(t)) ELSE r END ELSE book END || '-' || t || '.csv.gz' AS file FROM k""")
def book_filename(spark, sf_dir):
    return load(spark, sf_dir, "v_bookname").select("row_idx", T.book_filename(F.col("book")).alias("file"))


# -- repair -------------------------------------------------------------------------------------------------------

_LOC = """l AS (SELECT prefecture || chr(9) || municipality || chr(9) || area AS id, prefecture, municipality, area, replace(area, ',', '') AS c, count(*) AS n, min(row_idx) AS seen FROM v_location WHERE area <> '' GROUP BY ALL),
o AS (SELECT * FROM l WHERE n <= 2 OR contains(area, ','))"""


_SEP = _LOC.replace("v_location", "v_separated")


def _locations(spark, sf_dir, view: str = "v_location") -> tuple[DataFrame, DataFrame]:
    counts = Q.location_counts(load(spark, sf_dir, view))
    return counts, Q.suspicious(counts)


@query(f"WITH {_LOC} SELECT id, prefecture, municipality, area, n AS count, seen AS first_seen FROM l")
def location_counts(spark, sf_dir):
    return _locations(spark, sf_dir)[0].drop("comparable")


@query(f"WITH {_LOC} SELECT id, n AS count FROM l WHERE n <= 2")
def rare_locations(spark, sf_dir):
    return _locations(spark, sf_dir)[0].where("count <= 2").select("id", "count")


@query(f"""WITH {_LOC} SELECT id, n AS count, concat_ws('/', CASE WHEN contains(area, ',') THEN 'area_contains_separator' END, CASE WHEN n <= 2 THEN 'rare_location' END) AS reasons FROM o""")
def suspicious_reasons(spark, sf_dir):
    return _locations(spark, sf_dir)[1].select("id", "count", F.array_join("reasons", "/").alias("reasons"))


@query("""WITH k AS (SELECT prefecture, municipality, area, count(*) AS n FROM v_odd_location GROUP BY ALL),
r AS (SELECT prefecture || chr(9) || municipality || chr(9) || area AS id, n AS count, concat_ws('/',
  CASE WHEN contains(area, '大阪府') OR contains(area, '大阪市') THEN 'area_contains_prefecture_or_city' END, CASE WHEN contains(area, ',') OR contains(area, '、') THEN 'area_contains_separator' END,
  CASE WHEN regexp_matches(area, '[^\\s]{1,12}区') THEN 'area_contains_ward_name' END,
  CASE WHEN length(area) > 1 AND regexp_matches(area, '^(豊中|守口|布施).') OR (starts_with(municipality, '大阪市') AND regexp_matches(area, '^(北|大|堺|豊).')) THEN 'area_starts_with_municipality_hint' END,
  CASE WHEN municipality <> '' AND area <> 'M' || municipality AND area LIKE regexp_replace(municipality, '[市町村区]$', '') || '_%' THEN 'area_starts_with_own_municipality_name' END,
  CASE WHEN n <= 2 THEN 'rare_location' END) AS reasons FROM k)
SELECT * FROM r WHERE reasons <> ''""")
def all_suspicious_reasons(spark, sf_dir):
    """Every reason for which a location is asked about, each from rows of customers."""
    odd = Q.suspicious(Q.location_counts(load(spark, sf_dir, "v_odd_location")))
    return odd.select("id", "count", F.array_join("reasons", "/").alias("reasons"))


@query(f"""WITH {_LOC}, f AS (SELECT * FROM l WHERE n >= 8 AND c <> '')
SELECT o.id, f.id AS candidate, min(CASE WHEN o.municipality = f.municipality THEN 0 ELSE 1 END) AS block, min(f.seen) AS seen
FROM o JOIN f ON o.prefecture = f.prefecture AND (o.municipality = f.municipality OR substr(o.c, 1, 1) = substr(f.c, 1, 1)) GROUP BY ALL""")
def block_candidates(spark, sf_dir):
    counts, odd = _locations(spark, sf_dir)
    return Q.block_pairs(odd, Q.common(counts, 8))


_COMMON_LETTERS = "list_sum(list_transform(list_distinct(string_split(o.c, '')), lambda x: least(length(o.c) - length(replace(o.c, x, '')), length(f.c) - length(replace(f.c, x, '')))))"
_BLOCKED = f"""f AS (SELECT * FROM l WHERE n >= 8 AND c <> ''),
b AS (SELECT o.id, f.id AS candidate, CASE WHEN o.municipality = f.municipality THEN 0 ELSE 1 END AS block, {_COMMON_LETTERS} AS common, length(o.c) + length(f.c) AS size
  FROM o JOIN f ON o.prefecture = f.prefecture AND (o.municipality = f.municipality OR substr(o.c, 1, 1) = substr(f.c, 1, 1)))"""


@query(f"WITH {_LOC}, {_BLOCKED} SELECT id, candidate, block FROM b WHERE id <> candidate AND 2.0 * common / size * CASE block WHEN 0 THEN 1.0 ELSE 0.82 END >= 0.5")
def bounded_pairs(spark, sf_dir):
    counts, odd = _locations(spark, sf_dir)
    return similar.bounded_pairs(odd, counts, 8, 0.5).select("id", "candidate", "block")


@query(f"""WITH {_LOC}, {_BLOCKED} SELECT 'blocked' AS stage, count(*) AS pairs FROM b
UNION ALL SELECT 'matched', count(*) FROM b WHERE id <> candidate AND 2.0 * common / size * CASE block WHEN 0 THEN 1.0 ELSE 0.82 END >= 0.5""")
def similarity_pair_counts(spark, sf_dir):
    counts, odd = _locations(spark, sf_dir)
    return similar.pair_counts(odd, counts, 8, 0.5)


@query()
def candidate_similarity_topk(spark, sf_dir):
    counts, odd = _locations(spark, sf_dir)
    return Q.similar_candidates(odd, counts, min_similarity=0.5)


@query(f"""WITH {_LOC}, p AS (SELECT o.id, f.id AS candidate, f.n AS candidate_count, row_number() OVER (PARTITION BY o.id ORDER BY f.n DESC, f.seen) AS rank
FROM o JOIN l f ON o.prefecture = f.prefecture AND o.municipality = f.municipality AND o.id <> f.id AND f.n >= 8 AND substr(o.c, 1, 1) = substr(f.c, 1, 1))
SELECT id, candidate, rank, candidate_count FROM p WHERE rank <= 8""")
def fallback_candidates(spark, sf_dir):
    counts, odd = _locations(spark, sf_dir)
    return Q.fallback_candidates(odd, counts)


@query(f"""WITH {_SEP}, m AS (SELECT o.id, o.c, f.id AS candidate FROM o JOIN l f ON o.prefecture = f.prefecture AND o.municipality = f.municipality AND o.id <> f.id AND f.n >= 8 AND substr(o.c, 1, 1) = substr(f.c, 1, 1) AND f.c = o.c WHERE contains(o.area, ','))
SELECT id, 'replace' AS action, min(candidate) AS corrected_id, 0.99::DOUBLE AS confidence FROM m GROUP BY id HAVING count(*) = 1""")
def deterministic_decisions(spark, sf_dir):
    counts, odd = _locations(spark, sf_dir, "v_separated")
    return Q.deterministic_decisions(odd, Q.fallback_candidates(odd, counts, top=1 << 20), counts)


_CORRECTED = f"""{_SEP}, f AS (SELECT * FROM l WHERE n >= 8), k AS (SELECT v.id, v.corrected_id, v.decision_idx, f.prefecture, f.municipality, f.area FROM v_judged v JOIN o ON o.id = v.id JOIN f ON f.id = v.corrected_id AND f.id <> o.id
  AND f.prefecture = o.prefecture AND f.municipality = o.municipality AND substr(f.c, 1, 1) = substr(o.c, 1, 1) WHERE v.action = 'replace' AND v.confidence >= 0.25),
c AS (SELECT id, arg_max(prefecture, decision_idx) AS prefecture, arg_max(municipality, decision_idx) AS municipality, arg_max(area, decision_idx) AS area FROM k GROUP BY id)"""


def _corrections(spark, sf_dir) -> DataFrame:
    counts, odd = _locations(spark, sf_dir, "v_separated")
    found = Q.fallback_candidates(odd, counts, top=1 << 20)
    return Q.valid_corrections(load(spark, sf_dir, "v_judged"), odd, found, counts, min_confidence=0.25)


@query(f"WITH {_CORRECTED} SELECT * FROM c")
def validate_corrections(spark, sf_dir):
    return _corrections(spark, sf_dir)


@query(f"""WITH {_CORRECTED} SELECT row_idx, coalesce(c.prefecture, v.prefecture) AS prefecture, coalesce(c.municipality, v.municipality) AS municipality, coalesce(c.area, v.area) AS area, lot, c.id IS NOT NULL AS changed
FROM v_separated v LEFT JOIN c ON c.id = v.prefecture || chr(9) || v.municipality || chr(9) || v.area""")
def apply_corrections(spark, sf_dir):
    return Q.apply_corrections(load(spark, sf_dir, "v_separated"), _corrections(spark, sf_dir))


@query(f"""WITH {_LOC} SELECT id, action, corrected_id, confidence FROM v_decision WHERE decision_idx % 2 = 0
UNION ALL SELECT id, 'keep', '', 0.0 FROM o WHERE id NOT IN (SELECT id FROM v_decision WHERE decision_idx % 2 = 0)""")
def missing_decisions_fill(spark, sf_dir):
    return Q.fill_missing(_locations(spark, sf_dir)[1], load(spark, sf_dir, "v_decision").where("decision_idx % 2 = 0"))


@query(f"WITH {_LOC} SELECT id, n AS count FROM o WHERE id NOT IN (SELECT id FROM v_decision)")
def remaining_items(spark, sf_dir):
    return Q.remaining(_locations(spark, sf_dir)[1], load(spark, sf_dir, "v_decision")).select("id", "count")


_NORMAL = "n AS (SELECT row_idx, trim(prefecture) || chr(9) || municipality || chr(9) || trim(translate(area, '０１２３４', '01234')) AS id, lot FROM v_wide_location)"


@query(f"WITH {_NORMAL} SELECT id, count(*) AS count, min(row_idx) AS first_seen FROM n GROUP BY id")
def location_counts_wide(spark, sf_dir):
    """Spellings that normalise alike are one location."""
    return Q.location_counts(load(spark, sf_dir, "v_wide_location")).select("id", "count", "first_seen")


@query(f"""WITH {_NORMAL}, c AS (SELECT id, count(*) AS n, min(row_idx) AS seen FROM n GROUP BY id),
o AS (SELECT id, n FROM c WHERE n <= 2 OR contains(id, ',')),
s AS (SELECT id, string_agg(CAST(row_idx AS VARCHAR), ' ' ORDER BY row_idx) FILTER (k <= 5) AS samples FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY row_idx) AS k FROM n) GROUP BY id),
f AS (SELECT o.id, count(*) AS candidates FROM o JOIN c ON split_part(c.id, chr(9), 1) = split_part(o.id, chr(9), 1) AND split_part(c.id, chr(9), 2) = split_part(o.id, chr(9), 2) AND c.id <> o.id AND c.n >= 8 GROUP BY o.id),
p AS (SELECT o.id, o.n, s.samples, f.candidates, row_number() OVER (ORDER BY o.n, o.id) AS place FROM o JOIN f ON f.id = o.id JOIN s ON s.id = o.id)
SELECT place - 1 AS place, id, n AS count, samples, candidates FROM p WHERE place <= 12""")
def suspicious_items(spark, sf_dir):
    """The first locations that would be asked about, with samples; candidates are all frequent ones of the municipality."""
    rows = load(spark, sf_dir, "v_wide_location")
    counts = Q.location_counts(rows)
    odd = Q.suspicious(counts)
    pairs = Q.block_pairs(odd, Q.common(counts, 8)).where("block = 0 AND id <> candidate")
    found = pairs.select("id", "candidate", F.lit(1).alias("rank"), F.lit(1.0).alias("similarity"), F.lit(0).alias("candidate_count"))
    asked = Q.items(odd, found, rows, max_items=12)
    return asked.select("place", "id", "count", F.array_join(F.transform("samples", lambda x: x["row_idx"].cast("string")), " ").alias("samples"), F.size("candidates").cast("long").alias("candidates"))


@query(f"""WITH s AS (SELECT *, row_number() OVER (PARTITION BY prefecture, municipality, area ORDER BY row_idx) AS k FROM v_location)
SELECT prefecture || chr(9) || municipality || chr(9) || area AS id, string_agg(CAST(row_idx AS VARCHAR) || ':' || lot, ' ' ORDER BY k) AS samples FROM s WHERE k <= 5 GROUP BY ALL""")
def location_samples(spark, sf_dir):
    rows = load(spark, sf_dir, "v_location")
    found = Q.samples(rows, Q.location_counts(rows))
    return found.select("id", F.array_join(F.transform("samples", lambda s: F.concat_ws(":", s["row_idx"].cast("string"), s["lot"])), " ").alias("samples"))


# -- ordered operators --------------------------------------------------------------------------------------------


@query("SELECT event_id, CAST(sum(CASE WHEN event_type = 'purchase' THEN 1 ELSE 0 END) OVER (PARTITION BY user_id ORDER BY event_id) AS BIGINT) AS section FROM events")
def section_ids(spark, sf_dir):
    return W.sections(load(spark, sf_dir, "events"), F.col("event_type") == "purchase", "user_id", ["event_id"]).select("event_id", "section")


@query("SELECT event_id, last_value(CASE WHEN event_type <> 'click' THEN value END IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY event_id ROWS UNBOUNDED PRECEDING) AS carried FROM events")
def carry_forward(spark, sf_dir):
    return W.carry_forward(load(spark, sf_dir, "events"), F.when(F.col("event_type") != "click", F.col("value")), ["user_id"], ["event_id"], "carried").select("event_id", "carried")


@query("""WITH RECURSIVE s AS (SELECT *, CAST(sum(CASE WHEN entry_type <> 'directory_entry' THEN 1 ELSE 0 END) OVER (PARTITION BY book ORDER BY pos) AS BIGINT) AS section FROM v_segment),
e AS (SELECT book, section, pos, indent_level, name, row_number() OVER (PARTITION BY book, section ORDER BY pos) AS k FROM s WHERE entry_type = 'directory_entry'),
r AS (SELECT book, section, pos, k, name AS full_name, [CASE WHEN indent_level = 0 THEN name END, CASE WHEN indent_level = 1 THEN name END, CASE WHEN indent_level = 2 THEN name END, CASE WHEN indent_level = 3 THEN name END] AS st FROM e WHERE k = 1
  UNION ALL
  SELECT e.book, e.section, e.pos, e.k, x.f, list_transform([0, 1, 2, 3], lambda i: CASE WHEN i < e.indent_level THEN r.st[i + 1] WHEN i = e.indent_level THEN x.f END)
  FROM r JOIN e ON e.book = r.book AND e.section = r.section AND e.k = r.k + 1,
  LATERAL (SELECT CASE WHEN starts_with(e.name, p) THEN e.name ELSE p || e.name END AS f FROM (SELECT coalesce(CASE e.indent_level WHEN 1 THEN r.st[1] WHEN 2 THEN coalesce(r.st[2], r.st[1]) WHEN 3 THEN coalesce(r.st[3], r.st[2], r.st[1]) END, '') AS p)) x)
SELECT book, section, pos, full_name AS name FROM r""")
def indent_names(spark, sf_dir):
    numbered = W.sections(load(spark, sf_dir, "v_segment"), F.col("entry_type") != "directory_entry", "book", ["pos"]).where("entry_type = 'directory_entry'")
    return X.indented_names(numbered, "book", "pos", "indent_level", "name")


@query("""WITH o AS (SELECT l_orderkey AS k, list('p' || l_partkey ORDER BY l_linenumber, l_partkey, l_suppkey) AS p, list_distinct(list('s' || l_suppkey)) AS s, list('a' || CAST(l_linenumber % 3 AS VARCHAR) ORDER BY l_linenumber, l_partkey, l_suppkey) AS a FROM lineitem GROUP BY l_orderkey),
q AS (SELECT k, CASE WHEN len(p) > 4 THEN p[1:2] ELSE p END AS p, list_sort(s) AS s, CASE WHEN len(p) % 2 = 0 THEN a[1:1] ELSE a END AS a FROM o),
e AS (SELECT k, p, s, a, unnest(range(1, greatest(len(p), len(a)) + 1)) AS i FROM q)
SELECT k AS l_orderkey, i - 1 AS i, CASE WHEN i <= len(p) THEN p[i] WHEN len(p) = 1 THEN p[1] ELSE '' END AS phone, coalesce(s[i], s[1]) AS name, coalesce(a[i], a[len(a)]) AS address FROM e""")
def candidate_expansion(spark, sf_dir):
    item = F.struct("l_linenumber", "l_partkey", "l_suppkey")
    o = load(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(F.array_sort(F.collect_list(item)).alias("x"))
    text = lambda c, f: F.transform("x", lambda v: F.concat(F.lit(c), v[f].cast("string")))
    p, s = text("p", "l_partkey"), F.array_sort(F.array_distinct(text("s", "l_suppkey")))
    a = F.transform("x", lambda v: F.concat(F.lit("a"), (v["l_linenumber"] % 3).cast("string")))
    n = F.size("x")
    rows = R.expand_candidates(F.when(n > 4, F.slice(p, 1, 2)).otherwise(p), s, F.when(n % 2 == 0, F.slice(a, 1, 1)).otherwise(a))
    return o.select("l_orderkey", F.posexplode(rows).alias("i", "r")).select("l_orderkey", F.col("i").cast("long").alias("i"), "r.*")


_ADDRESSES = "SELECT row_idx, string_split(addresses_text, '|') AS a FROM v_entry"


@query(f"""WITH e AS ({_ADDRESSES}), c AS (SELECT row_idx, a, replace(a[1], '-', '-') AS x, a[2] AS y FROM e)
SELECT row_idx, CASE WHEN contains(y, x) THEN y WHEN contains(x, y) THEN x ELSE x || '|' || y END AS addresses FROM c""")
def collapse_fragments(spark, sf_dir):
    found = R.collapse_fragments(F.split("addresses_text", r"\|"))
    return load(spark, sf_dir, "v_entry").select("row_idx", F.array_join(found, "|").alias("addresses"))


@query(f"""WITH e AS ({_ADDRESSES}) SELECT row_idx, array_to_string(list_transform(a, lambda x: x || '北' || CAST(row_idx % 3 AS VARCHAR)), '|') AS addresses FROM e""")
def continuation_merge(spark, sf_dir):
    merged = R.merge_continuation(F.split("addresses_text", r"\|"), F.array(F.lit(" 北 "), (F.col("row_idx") % 3).cast("string")))
    return load(spark, sf_dir, "v_entry").select("row_idx", F.array_join(merged, "|").alias("addresses"))


_SIDES = "l AS (SELECT event_id, user_id, event_id AS place FROM events WHERE event_type <> 'view'), r AS (SELECT user_id, event_id AS place, value FROM events WHERE event_type = 'view')"


@query(f"WITH {_SIDES} SELECT l.event_id, r.value AS label FROM l ASOF LEFT JOIN r ON l.user_id = r.user_id AND l.place >= r.place")
def asof_label(spark, sf_dir):
    events = load(spark, sf_dir, "events").withColumn("at", F.col("event_id"))
    left, right = events.where("event_type <> 'view'").select("event_id", "user_id", "at"), events.where("event_type = 'view'").select("user_id", "at", "value")
    return W.asof_backward(left, right, "user_id", "at", "value", "label").select("event_id", "label")


@query(f"""WITH {_SIDES}, n AS (SELECT *, lead(place) OVER (PARTITION BY user_id ORDER BY place) AS until FROM l)
SELECT n.event_id, arg_min(r.value, r.place) AS first_view FROM n LEFT JOIN r ON r.user_id = n.user_id AND r.place >= n.place AND (n.until IS NULL OR r.place < n.until) GROUP BY n.event_id""")
def range_first(spark, sf_dir):
    events = load(spark, sf_dir, "events").withColumn("at", F.col("event_id"))
    left, right = events.where("event_type <> 'view'").select("event_id", "user_id", "at"), events.where("event_type = 'view'").select("user_id", "at", "value")
    return W.range_first(left, right, "user_id", "at", "value", "first_view").select("event_id", "first_view")


#: The fold over the segments below, step by step: eid counts the entries that gave a row, lp, ln, la are the latest one's
#: number, name and address, sn and sa the name and address said last, st the names of lines by indentation.
_FOLD = """g AS (SELECT *, CAST(sum(CASE WHEN entry_type <> 'directory_entry' THEN 1 ELSE 0 END) OVER (PARTITION BY book ORDER BY pos) AS BIGINT) AS section FROM v_segment),
i AS (SELECT book, section, pos % 5 AS kind, indent_level AS lv, name, '06-' || (pos % 900 + 100) || '-' || lpad(CAST(pos % 9000 AS VARCHAR), 4, '0') AS phone,
  CASE pos % 3 WHEN 0 THEN '北' WHEN 1 THEN '豊,中' ELSE '布,' END || '町' || (pos % 40) AS address, row_number() OVER (PARTITION BY book, section ORDER BY pos) AS k FROM g WHERE entry_type = 'directory_entry'),
z AS (SELECT DISTINCT book, section, CAST(0 AS BIGINT) AS k, CAST(0 AS INTEGER) AS eid, '' AS lp, '' AS ln, '' AS la, '' AS sn, '' AS sa, [CAST(NULL AS VARCHAR), NULL, NULL, NULL] AS st FROM i
  UNION ALL
  SELECT i.book, i.section, i.k, z.eid + CAST(y.new AS INTEGER), CASE WHEN y.new THEN i.phone ELSE z.lp END, CASE WHEN y.new THEN y.f ELSE z.ln END,
    CASE WHEN x.more THEN z.la || i.address WHEN y.new THEN y.addr ELSE z.la END,
    CASE WHEN x.more THEN z.ln WHEN y.f <> '' AND y.addr <> '' THEN y.f ELSE z.sn END, CASE WHEN x.more THEN z.la || i.address WHEN y.f <> '' AND y.addr <> '' THEN y.addr ELSE z.sa END,
    CASE WHEN x.more THEN z.st ELSE list_transform([0, 1, 2, 3], lambda j: CASE WHEN j < i.lv THEN z.st[j + 1] WHEN j = i.lv AND y.f <> '' THEN y.f END) END
  FROM z JOIN i ON i.book = z.book AND i.section = z.section AND i.k = z.k + 1,
  LATERAL (SELECT i.kind = 4 AND z.eid > 0 AS more, CASE WHEN i.kind = 3 THEN z.sn WHEN i.kind = 4 THEN '町の' ELSE i.name END AS n, CASE WHEN i.kind = 3 THEN z.sa ELSE i.address END AS addr,
    coalesce(CASE i.lv WHEN 1 THEN z.st[1] WHEN 2 THEN coalesce(z.st[2], z.st[1]) WHEN 3 THEN coalesce(z.st[3], z.st[2], z.st[1]) END, '') AS head) x,
  LATERAL (SELECT x.addr AS addr, i.kind <> 4 AND x.addr <> '' AS new, CASE WHEN x.n = '' OR starts_with(x.n, x.head) THEN x.n ELSE x.head || x.n END AS f) y),
q AS (SELECT book, section, eid, arg_max(lp, k) AS phone, arg_max(ln, k) AS name, arg_max(la, k) AS address FROM z WHERE eid > 0 GROUP BY book, section, eid),
n AS (SELECT *, row_number() OVER (ORDER BY book, section, eid) AS row_idx FROM q),
a AS (SELECT row_idx, '1963-02-01' AS v, address FROM n)"""


def _directory_segments(spark, sf_dir) -> DataFrame:
    """v_segment as segments: numbers and addresses by place, gaps included, so that all ways of the fold are taken."""
    s = load(spark, sf_dir, "v_segment")
    place = F.col("pos")
    phone = F.concat((place % 900 + 100).cast("string"), F.lit("-"), F.lpad((place % 9000).cast("string"), 4, "0"))
    address = F.concat(F.when(place % 3 == 0, "北").when(place % 3 == 1, "豊,中").otherwise("布,"), F.lit("町"), (place % 40).cast("string"))
    keep = lambda when, c: F.when(when, F.array(c)).otherwise(F.array().cast("array<string>"))
    return s.select(
        F.concat(F.lit("昭和38年2月1日"), F.col("book").cast("string")).alias("book"), F.lit("0001-01").alias("file_key"), place.alias("pos"), F.col("entry_type").alias("entryType"),
        F.lit("").alias("rawText"), F.when(place % 5 == 4, F.lit("町の")).otherwise(phone).alias("cleanText"), F.col("indent_level").alias("indentLevel"),
        F.struct(F.lit("").alias("phone"), F.lit("").alias("name"), F.lit("").alias("address")).alias("entryHints"),
        keep(place % 5 != 4, phone).alias("phones"), keep(~(place % 5).isin(3, 4), F.col("name")).alias("names"), keep(place % 5 != 3, address).alias("addresses"),
    )


@query(f"""WITH RECURSIVE {_DICT}, {_HEADS}, {_TOWNS}, {_FOLD},
{_SPLIT}
SELECT '昭和38年2月1日' || book AS book, section, eid - 1 AS row_no, phone, name, prefecture, municipality, trim(regexp_replace(rest, '[0-9]+(-[0-9]+)*$', '')) AS area, regexp_extract(rest, '[0-9]+(-[0-9]+)*$', 0) AS lot
FROM n JOIN f ON f.row_idx = n.row_idx""")
def export_fold(spark, sf_dir):
    return X.export(_directory_segments(spark, sf_dir))


# -- segments and harvest -----------------------------------------------------------------------------------------


@query("""SELECT book, pos, printf('%04d-%02d-%04d', book, 1, pos) AS segment_id, CASE entry_type WHEN 'directory_entry' THEN 'directory_entry' WHEN 'ad_block' THEN 'ad_block' ELSE 'category_heading' END AS entry_type, greatest(indent_level - 1, 0) AS indent_level,
'p' || (pos % 3) || CASE WHEN pos % 2 = 0 THEN '/q' ELSE '' END AS phones, 'p' || (pos % 3) AS phone,
concat_ws('/', 'old', CASE WHEN pos % 4 = 0 THEN 'starts_mid_entry' END, CASE WHEN pos % 2 = 0 THEN 'multi_phone' END) AS flags FROM v_segment""")
def segment_normalize(spark, sf_dir):
    s = load(spark, sf_dir, "v_segment")
    short = F.create_map(*[F.lit(x) for k, v in S.SHORT_TYPES.items() for x in (v, k)])
    first = F.concat(F.lit("p"), (F.col("pos") % 3).cast("string"))
    phones = F.when(F.col("pos") % 2 == 0, F.array(first, F.lit(" q "), first)).otherwise(F.array(first, F.lit("")))
    row = F.struct(short[F.col("entry_type")].alias("t"), F.lit("x ").alias("x"), (F.col("indent_level") - 1).alias("i"), phones.alias("p"), F.array(F.lit("old")).alias("f"), (F.col("pos") % 4 == 0).alias("s"))
    text = F.to_json(F.struct(F.array(row).alias("r")))
    found = S.normalize_responses(s.select(F.col("book").cast("int").alias("page"), F.col("pos").cast("int").alias("column"), text.alias("text")))
    seg = found.select("page", "column", F.col("segments")[0].alias("s"))
    return seg.select(
        F.col("page").cast("long").alias("book"), F.col("column").cast("long").alias("pos"), F.format_string("%04d-%02d-%04d", "page", F.lit(1), "column").alias("segment_id"), F.col("s.entryType").alias("entry_type"), F.col("s.indentLevel").alias("indent_level"),
        F.array_join("s.phones", "/").alias("phones"), F.col("s.entryHints.phone").alias("phone"), F.array_join("s.reviewFlags", "/").alias("flags"),
    )


@query("""SELECT book, pos, concat_ws('/', CASE WHEN pos % 4 <> 1 THEN 'seen' ELSE 'multi_phone' END, CASE WHEN pos % 2 = 0 THEN 'starts_mid_entry' END, CASE WHEN pos % 3 = 0 THEN 'ends_mid_entry' END,
CASE WHEN pos % 5 = 0 THEN 'continued_from_previous' END, CASE WHEN pos % 4 <> 1 AND indent_level > 1 THEN 'multi_phone' END) AS flags FROM v_segment""")
def review_flags(spark, sf_dir):
    p = F.col("pos")
    phones = F.when(F.col("indent_level") > 1, F.array(F.lit("a"), F.lit("b"))).otherwise(F.array(F.lit("a")))
    flags = R.review_flags(F.when(p % 4 != 1, F.array(F.lit("seen"))).otherwise(F.array(F.lit("multi_phone"))), p % 2 == 0, p % 3 == 0, p % 5 == 0, phones, F.array(F.lit("x")))
    return load(spark, sf_dir, "v_segment").select("book", "pos", F.array_join(flags, "/").alias("flags"))


def _quality(spark, sf_dir) -> DataFrame:
    c = load(spark, sf_dir, "conversations")
    n = F.char_length(F.coalesce("text", F.lit("")))
    counted = S.conditions(F.when(F.col("role") == "user", "x"), (n % 100) / 100, F.split("text", " "), F.col("turn") == 1, n % 7 == 0, F.when(F.col("turn") > 2, F.array(F.lit("f"))))
    return S.quality_rollup(c, counted, "conv_id", "turn")


_QUALITY = """SELECT conv_id, turn, count(*) AS segments, count(*) FILTER (role IS DISTINCT FROM 'user') AS without_phone, count(*) FILTER ((length(coalesce(text, '')) % 100) / 100.0 < 0.6) AS low_confidence,
count(*) FILTER (len(list_filter(string_split(text, ' '), lambda x: trim(x) <> '')) > 1) AS multi_phone, count(*) FILTER (turn = 1) AS mid_entry, count(*) FILTER (length(coalesce(text, '')) % 7 = 0) AS continued, count(*) FILTER (turn > 2) AS flagged,
GROUPING(conv_id, turn) AS level FROM conversations GROUP BY ROLLUP (conv_id, turn)"""


@query(_QUALITY)
def ocr_quality_rollup(spark, sf_dir):
    return _quality(spark, sf_dir)


@query(f"""WITH q AS ({_QUALITY}) SELECT conv_id, turn, concat_ws('/', CASE WHEN without_phone * 2 > segments THEN 'many_segments_without_phone' END, CASE WHEN low_confidence > 0 THEN 'low_confidence_segments' END,
CASE WHEN mid_entry > 0 THEN 'mid_entry_segments' END, CASE WHEN continued > 0 THEN 'continued_from_previous_segments' END) AS flags FROM q WHERE level = 0""")
def column_flags(spark, sf_dir):
    q = _quality(spark, sf_dir).where("level = 0")
    return q.select("conv_id", "turn", F.array_join(S.column_flags(q), "/").alias("flags"))


def _batch(spark, sf_dir) -> tuple[DataFrame, DataFrame, DataFrame]:
    key = lambda c: F.concat(F.lit("k"), F.col(c).cast("string")).alias("output_key")
    results = load(spark, sf_dir, "lineitem").select(key("l_orderkey"), "l_linenumber", "l_partkey")
    orders = load(spark, sf_dir, "orders")
    return results, orders.where("o_orderkey % 5 <> 0").select(key("o_orderkey")), orders.where("o_orderkey % 7 = 0").select(key("o_orderkey"))


_BATCH = "r AS (SELECT 'k' || l_orderkey AS output_key, l_linenumber, l_partkey FROM lineitem), q AS (SELECT 'k' || o_orderkey AS output_key FROM orders WHERE o_orderkey % 5 <> 0), x AS (SELECT 'k' || o_orderkey AS output_key FROM orders WHERE o_orderkey % 7 = 0)"


@query(f"""WITH {_BATCH} SELECT CASE WHEN output_key NOT IN (SELECT output_key FROM q) THEN 'unmatched' WHEN output_key IN (SELECT output_key FROM x) THEN 'skipped' ELSE 'saved' END AS status, count(*) AS n, CAST(sum(l_partkey) AS BIGINT) AS parts FROM r GROUP BY 1""")
def harvest_join(spark, sf_dir):
    return H.harvest(*_batch(spark, sf_dir)).groupBy("status").agg(F.count("*").alias("n"), F.sum("l_partkey").alias("parts"))


@query(f"""WITH {_BATCH}, m AS (SELECT DISTINCT output_key FROM q WHERE output_key NOT IN (SELECT output_key FROM r WHERE l_partkey % 2 = 0)),
k AS (SELECT output_key, row_number() OVER (ORDER BY output_key) AS i FROM m)
SELECT output_key, 0::BIGINT AS others FROM k WHERE i <= 100 UNION ALL SELECT NULL, count(*) - 100 FROM k HAVING count(*) > 100""")
def missing_results(spark, sf_dir):
    results, requests, _ = _batch(spark, sf_dir)
    return H.missing_results(requests, results.where("l_partkey % 2 = 0"))


@query(f"WITH {_BATCH} SELECT output_key, l_linenumber, l_partkey FROM r WHERE output_key NOT IN (SELECT output_key FROM x)")
def skip_existing(spark, sf_dir):
    results, _, existing = _batch(spark, sf_dir)
    return H.write_if_absent(results, existing, "output_key")


@query("""WITH a AS (SELECT o_custkey % 50 AS g, o_orderkey, row_number() OVER (PARTITION BY o_custkey % 50 ORDER BY o_orderkey) AS place FROM orders),
b AS (SELECT c_custkey % 50 AS g, c_custkey, row_number() OVER (PARTITION BY c_custkey % 50 ORDER BY c_custkey) AS place FROM customer)
SELECT g, place, o_orderkey, c_custkey, CASE WHEN c_custkey IS NULL THEN 'left' WHEN o_orderkey IS NULL THEN 'right' ELSE 'both' END AS side FROM a FULL JOIN b USING (g, place)""")
def positional_zip(spark, sf_dir):
    left = load(spark, sf_dir, "orders").select((F.col("o_custkey") % 50).alias("g"), "o_orderkey")
    right = load(spark, sf_dir, "customer").select((F.col("c_custkey") % 50).alias("g"), "c_custkey")
    return H.zip_by_place(left, right, "g", "o_orderkey", "c_custkey").withColumn("place", F.col("place").cast("long"))


@query("SELECT doc_id, CAST(floor((row_number() OVER (ORDER BY doc_id) - 1) / 100) AS BIGINT) AS chunk FROM documents")
def batch_chunks(spark, sf_dir):
    return W.chunked(load(spark, sf_dir, "documents").select("doc_id"), ["doc_id"], 100)


@query("WITH p AS (SELECT doc_id, lpad(CAST(doc_id AS VARCHAR), 6, '0') AS page FROM documents) SELECT doc_id, page FROM p WHERE page NOT IN ('000003', '000777') AND NOT (page BETWEEN '000010' AND '000020') AND NOT (page BETWEEN '000500' AND '000600')")
def page_exclusion(spark, sf_dir):
    pages = load(spark, sf_dir, "documents").select("doc_id", F.lpad(F.col("doc_id").cast("string"), 6, "0").alias("page"))
    return L.excluded_pages(pages, "page", ["000003", "000777"], [("000010", "000020"), ("000600", "000500")])


@query("SELECT name, state, state <> 'JOB_STATE_RUNNING' AS terminal, state = 'JOB_STATE_SUCCEEDED' AS succeeded FROM v_job")
def job_status(spark, sf_dir):
    return J.job_status(load(spark, sf_dir, "v_job"))


_OUTCOME = """r AS (SELECT CAST(l_orderkey AS VARCHAR) AS k FROM lineitem GROUP BY l_orderkey),
x AS (SELECT job, output_key, CASE WHEN output_key NOT IN (SELECT k FROM r) THEN 'unmatched' WHEN status_said = 'F' THEN 'skipped' WHEN error IS NOT NULL OR said = 'nothing found' THEN 'failed' ELSE 'saved' END AS status, said, error FROM v_result)"""


def _outcomes(spark, sf_dir) -> DataFrame:
    """Results as a service gives them: a key for some, for others the file that the response names; outputs of finished orders exist."""
    rows = load(spark, sf_dir, "v_result")
    text = F.struct(F.array(F.struct(F.struct(F.array(F.struct(F.col("said").alias("text"))).alias("parts")).alias("content"))).alias("candidates"), F.struct(F.concat(F.lit("gs://in/a/"), "output_key", F.lit(".png")).alias("file_uri")).alias("instance"))
    results = rows.select("job", F.when(F.col("job") != "2-HIGH", F.col("output_key")).otherwise("").alias("output_key"), F.to_json(text).alias("response"), "error")
    requests = load(spark, sf_dir, "lineitem").select(F.col("l_orderkey").cast("string").alias("output_key"))
    existing = rows.where("status_said = 'F'").select("output_key")
    return J.harvested(results, requests, existing)


@query(f"""WITH {_OUTCOME} SELECT job, output_key, status, CASE WHEN status IN ('saved', 'failed') AND said <> 'nothing found' THEN substr(said, 5, length(said) - 8) END AS payload,
CASE status WHEN 'unmatched' THEN 'no request' WHEN 'failed' THEN coalesce(error, 'no JSON object') END AS problem FROM x""")
def harvest_outcomes(spark, sf_dir):
    return _outcomes(spark, sf_dir).select("job", "output_key", "status", "payload", "problem")


@query(f"""WITH {_OUTCOME} SELECT job, count(*) FILTER (status = 'saved') AS saved, count(*) FILTER (status = 'skipped') AS skipped, count(*) FILTER (status = 'failed') AS failed, count(*) FILTER (status = 'unmatched') AS unmatched, count(*) AS total FROM x GROUP BY ROLLUP (job)""")
def harvest_counters(spark, sf_dir):
    return J.counters(_outcomes(spark, sf_dir), "job", "status", ("saved", "skipped", "failed", "unmatched"))


@query("""SELECT o_orderstatus AS book, o_orderkey AS page, o_custkey % 6 + 1 AS columns FROM orders LEFT JOIN (SELECT l_orderkey, count(*) AS n FROM lineitem GROUP BY l_orderkey) i ON l_orderkey = o_orderkey
WHERE coalesce(n, 0) < o_custkey % 6 + 1""")
def pages_to_split(spark, sf_dir):
    orders = load(spark, sf_dir, "orders").select(F.col("o_orderstatus").alias("book"), F.col("o_orderkey").alias("page"), (F.col("o_custkey") % 6 + 1).alias("columns"))
    images = load(spark, sf_dir, "lineitem").join(orders, F.col("l_orderkey") == F.col("page")).select("book", "page")
    return J.pending_pages(orders, images)


@query("""WITH u AS (SELECT page_id AS page, url AS uri, regexp_replace(regexp_extract(url, '[^/]*$', 0), '\\.[^.]*$', '') AS output_key FROM pages)
SELECT output_key, page, uri, json_object('output_key', output_key, 'page', page, 'column', 1, 'uri', uri, 'mime', 'image/png')::VARCHAR AS item FROM u""")
def manifest_items(spark, sf_dir):
    pages = load(spark, sf_dir, "pages").select(F.col("page_id").alias("page"), F.lit(1).alias("column"), F.translate("url", "/", "\\").alias("path"), F.lit("image/png").alias("mime"))
    return J.manifest_items(pages).select("output_key", "page", "uri", "item")


@query("""SELECT event_id, CASE event_type WHEN 'click' THEN 'gs://a/' || event_id || '.png' WHEN 'view' THEN 'gs://b/' || user_id ELSE '' END AS uri FROM events""")
def nested_uri(spark, sf_dir):
    e = load(spark, sf_dir, "events")
    deep = F.to_json(F.struct(F.struct(F.lit(1).alias("n")).alias("first"), F.array(F.struct(F.struct(F.concat(F.lit("gs://a/"), F.col("event_id").cast("string"), F.lit(".png")).alias("file_uri")).alias("fileData"))).alias("parts")))
    flat = F.to_json(F.struct(F.lit("").alias("file_uri"), F.concat(F.lit("gs://b/"), F.col("user_id").cast("string")).alias("fileUri")))
    value = F.when(F.col("event_type") == "click", deep).when(F.col("event_type") == "view", flat).otherwise(F.lit("{broken"))
    return e.select("event_id", N.find_uri_column(value).alias("uri"))


@query("""WITH a AS (SELECT row_idx, string_split(addresses_text, '|') AS x, CASE WHEN row_idx % 3 = 0 THEN '' WHEN row_idx % 3 = 1 THEN name ELSE split_part(addresses_text, '|', 2) END AS hint FROM v_entry)
SELECT row_idx, array_to_string(CASE WHEN hint = '' OR list_contains(x, hint) THEN x ELSE list_prepend(hint, x) END, '|') AS addresses FROM a""")
def hint_first(spark, sf_dir):
    x = F.split("addresses_text", "[|]")
    hint = F.when(F.col("row_idx") % 3 == 0, "").when(F.col("row_idx") % 3 == 1, F.col("name")).otherwise(x[1])
    return load(spark, sf_dir, "v_entry").select("row_idx", F.array_join(R.put_first(x, hint), "|").alias("addresses"))


# -- layout -------------------------------------------------------------------------------------------------------


@query("""WITH h AS (SELECT p_size, count(*) AS pages, min(p_partkey) AS first FROM part GROUP BY p_size), m AS (SELECT p_size FROM h ORDER BY pages DESC, first LIMIT 1)
SELECT p_size, pages, p_size = (SELECT p_size FROM m) AS is_mode FROM h""")
def split_histogram_mode(spark, sf_dir):
    return L.count_mode(load(spark, sf_dir, "part"), "p_size", "p_partkey")


@query("SELECT flag, count(*) AS n FROM (SELECT unnest(CASE WHEN value > 50 THEN [event_type, 'high'] ELSE [event_type] END) AS flag FROM events) GROUP BY flag")
def flag_counts(spark, sf_dir):
    rows = load(spark, sf_dir, "events").select(F.when(F.col("value") > 50, F.array("event_type", F.lit("high"))).otherwise(F.array("event_type")).alias("flags"))
    return L.flag_counts(rows, "flags")


def _widths(spark, sf_dir) -> DataFrame:
    return load(spark, sf_dir, "embeddings").select("vec_id", "label", F.posexplode("embedding").alias("place", "x")).select("vec_id", "label", "place", (F.floor(F.abs("x") * 100000) + 1).cast("double").alias("width"))


_WIDTHS = "w AS (SELECT vec_id, label, generate_subscripts(embedding, 1) - 1 AS place, CAST(floor(abs(CAST(unnest(embedding) AS DOUBLE)) * 100000) + 1 AS DOUBLE) AS width FROM embeddings)"
_STATS = f"WITH {_WIDTHS}, s AS (SELECT vec_id, any_value(label) AS label, count(*) AS n, avg(width) AS m, stddev_pop(width) / avg(width) AS cv, min(width) / avg(width) AS lo, max(width) / avg(width) AS hi, median(width) AS med FROM w GROUP BY vec_id)"


@query(f"{_STATS} SELECT vec_id, n, round(m, 4) AS mean_width, round(cv, 6) AS cv, round(lo, 6) AS min_ratio, round(hi, 6) AS max_ratio FROM s")
def width_stats(spark, sf_dir):
    s = L.width_stats(_widths(spark, sf_dir), ["vec_id"], "width")
    return s.select("vec_id", "n", F.round("mean_width", 4).alias("mean_width"), *[F.round(c, 6).alias(c) for c in ("cv", "min_ratio", "max_ratio")])


@query(f"""{_STATS}, i AS (SELECT vec_id, bool_or(width / 100000 < 0.35 * med / 100000) AS under FROM w JOIN s USING (vec_id) GROUP BY vec_id)
SELECT vec_id, concat_ws('/', CASE WHEN cv > 0.18 THEN 'uneven_column_widths' END, CASE WHEN under THEN 'possible_blank_or_underfilled_column' END, CASE WHEN m > 0 AND lo > greatest(0.30, 1.85 * m / 100000) THEN 'possible_text_cut_at_column_edge' END) AS flags, cv > 0.18 AS fatal
FROM s JOIN i USING (vec_id)""")
def quality_flags(spark, sf_dir):
    w = _widths(spark, sf_dir)
    inks = w.groupBy("vec_id").agg(F.collect_list(F.col("width") / 100000).alias("inks"), (F.median("width") / 100000).alias("median"))
    s = L.width_stats(w, ["vec_id"], "width").join(inks, "vec_id")
    flags = L.quality_flags(F.col("cv"), F.col("inks"), F.col("median"), F.col("min_ratio"), F.col("mean_width") / 100000)
    return s.select("vec_id", F.array_join(flags, "/").alias("flags"), L.fatal(flags).alias("fatal"))


@query(f"""{_STATS}, k AS (SELECT label, vec_id % 7 AS page, 2 + vec_id % 3 AS n_cols, min(cv) AS cv, min(lo) AS lo, min(hi) AS hi FROM s GROUP BY ALL),
c AS (SELECT *, 3 * cv + 0.9 - 2.5 * cv - 3 * greatest(0.55 - lo, 0) - 2 * greatest(hi - 1.6, 0) - 4 * greatest(lo - 0.03, 0) - 0.3 * greatest(3 - n_cols, 0) - CASE n_cols WHEN 2 THEN 0.05 WHEN 4 THEN 0.02 ELSE 0 END AS score FROM k)
SELECT label * 10 + page AS page, arg_max(n_cols, score) AS n_cols, round(max(score), 6) AS score FROM c GROUP BY 1""")
def layout_argmax(spark, sf_dir):
    w = _widths(spark, sf_dir)
    s = L.width_stats(w, ["vec_id", "label"], "width")
    k = s.groupBy((F.col("label") * 10 + F.col("vec_id") % 7).alias("page"), (F.col("vec_id") % 3 + 2).alias("n_cols")).agg(F.min("cv").alias("cv"), F.min("min_ratio").alias("lo"), F.min("max_ratio").alias("hi"))
    score = L.layout_score(F.col("cv"), F.lit(0.9), F.col("cv"), F.col("lo"), F.col("hi"), F.col("lo"), F.lit(2), F.col("n_cols"))
    return L.best_layout(k.withColumn("score", score), "page", "n_cols", "score").withColumn("score", F.round("score", 6))


@query(f"""WITH {_WIDTHS}, f AS (SELECT vec_id, place, place - row_number() OVER (PARTITION BY vec_id ORDER BY place) AS g FROM w WHERE width % 2 = 0)
SELECT vec_id, min(place) AS first, max(place) AS last, count(*) AS length FROM f GROUP BY vec_id, g HAVING count(*) >= 2""")
def run_groups(spark, sf_dir):
    return W.islands(_widths(spark, sf_dir), F.col("width") % 2 == 0, ["vec_id"], "place").where("length >= 2")


@query(f"""WITH {_WIDTHS}, e AS (SELECT vec_id, max(place) AS top FROM w GROUP BY vec_id), o AS (SELECT unnest(range(-3, 3)) AS o)
SELECT a.vec_id, a.place, round(avg(b.width), 4) AS smooth FROM w a JOIN e ON e.vec_id = a.vec_id CROSS JOIN o JOIN w b ON b.vec_id = a.vec_id AND b.place = least(greatest(a.place + o.o, 0), e.top) GROUP BY ALL""")
def moving_average(spark, sf_dir):
    return W.moving_average(_widths(spark, sf_dir), "width", 6, ["vec_id"], "place", "smooth").select("vec_id", "place", F.round("smooth", 4).alias("smooth"))


@query(f"WITH {_WIDTHS} SELECT vec_id, min(place) FILTER (width > 20000) AS first, max(place) FILTER (width > 20000) AS last FROM w GROUP BY vec_id")
def first_crossing(spark, sf_dir):
    return W.first_crossing(_widths(spark, sf_dir), F.col("width") > 20000, ["vec_id"], "place")


@query("SELECT doc_id, sha256(coalesce(text, '')) AS sha FROM documents")
def content_sha256(spark, sf_dir):
    return books.content_hash(load(spark, sf_dir, "documents").select("doc_id", F.coalesce("text", F.lit("")).alias("content"))).select("doc_id", F.col("sha256").alias("sha"))


@query("SELECT event_id, CAST(json_extract_string(props, '$.page') AS VARCHAR) AS page, json_extract_string(props, '$.k') AS k FROM events")
def json_props(spark, sf_dir):
    return load(spark, sf_dir, "events").select("event_id", F.get_json_object("props", "$.page").alias("page"), F.get_json_object("props", "$.k").alias("k"))


@query("SELECT event_id, regexp_replace(props, '[ ]', '', 'g') AS found FROM events")
def extract_json_object(spark, sf_dir):
    wrapped = F.concat(F.lit("note {not json} ```json\n"), "props", F.lit("\n``` end {}"))
    return load(spark, sf_dir, "events").select("event_id", extract_object(wrapped).alias("found"))


@query("""WITH k AS (SELECT o_orderkey, o_orderkey % 12 AS m, o_custkey FROM orders),
e AS (SELECT *, CASE m WHEN 1 THEN 'segments[1].indentLevel is float' WHEN 2 THEN 'segments[1].indentLevel is bool' WHEN 3 THEN 'segments[1].indentLevel is str' WHEN 4 THEN 'segments[1].entryType is unknown'
  WHEN 5 THEN 'segments[1].phones is int' WHEN 6 THEN 'segments[2].confidence is str' WHEN 7 THEN 'row 2 is list' WHEN 8 THEN 'segments[1].indentLevel is beyond 32 bits' END AS error FROM k)
SELECT o_orderkey, error, CASE WHEN error IS NULL THEN 2 END AS segments, CASE WHEN error IS NULL THEN CASE m WHEN 9 THEN 0 ELSE 2 END END AS indent,
 CASE WHEN error IS NULL THEN CASE WHEN m = 10 THEN 'h' || o_custkey || '/p' ELSE 'p' END END AS phones, CASE WHEN error IS NULL THEN CASE WHEN m = 10 THEN 'h' || o_custkey ELSE 'p' END END AS phone,
 CASE WHEN error IS NULL THEN concat_ws('/', 'old', CASE WHEN m = 11 THEN 'starts_mid_entry' END, CASE WHEN m = 11 THEN 'continued_from_previous' END, CASE WHEN m = 10 THEN 'multi_phone' END) END AS flags,
 CASE WHEN error IS NULL THEN m = 11 END AS same, CASE WHEN error IS NULL THEN CAST(CASE m WHEN 0 THEN 1.0 ELSE 0.25 END AS DOUBLE) END AS confidence FROM e""")
def segment_strict(spark, sf_dir):
    """The full schema with every kind of slip: a response for each order, its types checked on the JVM."""
    o = load(spark, sf_dir, "orders").withColumn("m", F.expr("cast(o_orderkey % 12 AS int)"))
    json_of = lambda otherwise, **when: F.coalesce(*[F.when(F.col("m") == int(k[1:]), F.lit(v) if isinstance(v, str) else v) for k, v in when.items()], F.lit(otherwise))
    indent = json_of("2", m1="1.5", m2="true", m3='"1"', m8="2147483648", m9="-3")
    first = F.concat(
        F.lit('{"entryType": "'), json_of("directory_entry", m4="entry"), F.lit('", "indentLevel": '), indent, F.lit(', "phones": ['), json_of('" p "', m5="7"), F.lit('], "reviewFlags": ["old"], "entryHints": {"phone": "'),
        json_of("", m10=F.concat(F.lit("h"), F.col("o_custkey").cast("string"))), F.lit('"}, "continuityFromPrevious": {"sameEntry": '), json_of("false", m11="true"), F.lit('}, "confidence": '), json_of("0.25", m0="7"), F.lit("}"),
    )
    second = json_of('{"entryType": " ad_block "}', m6='{"entryType": "ad_block", "confidence": "1"}', m7="[]")
    text = F.concat(F.lit('{"segments": ['), first, F.lit(", "), second, F.lit("]}"))
    told = S.strict_responses(o.select("o_orderkey", F.lit(1).alias("page"), F.lit(1).alias("column"), text.alias("text")), "o_orderkey")
    s = F.col("segments")[0]
    return told.select(
        "o_orderkey", "error", F.when(F.col("error").isNull(), F.size("segments")).alias("n"), s["indentLevel"].alias("indent"), F.array_join(s["phones"], "/").alias("phones"), s["entryHints"]["phone"].alias("phone"),
        F.array_join(s["reviewFlags"], "/").alias("flags"), s["continuityFromPrevious"]["sameEntry"].alias("same"), s["confidence"].alias("confidence"),
    ).withColumnRenamed("n", "segments")


@query("""WITH k AS (SELECT o_orderpriority AS job, o_orderkey, o_orderstatus = 'F' AS bad, sum(CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END) OVER w AS sofar FROM orders WINDOW w AS (PARTITION BY o_orderpriority ORDER BY o_orderkey)),
b AS (SELECT *, sofar - coalesce(max(CASE WHEN NOT bad THEN sofar END) OVER (PARTITION BY job ORDER BY o_orderkey), 0) AS streak FROM k),
c AS (SELECT job, min(o_orderkey) AS cut FROM b WHERE bad AND streak = 8 GROUP BY job)
SELECT b.job, o_orderkey, CASE WHEN o_orderkey > cut THEN 'undone' WHEN bad THEN 'failed' ELSE 'done' END AS outcome FROM b LEFT JOIN c ON c.job = b.job""")
def error_budget(spark, sf_dir):
    """Requests in order, up to the first eight errors in a row of their job."""
    o = load(spark, sf_dir, "orders").select(F.col("o_orderpriority").alias("job"), "o_orderkey", "o_orderstatus")
    return J.replay(o, ["job"], ["o_orderkey"], F.col("o_orderstatus") == "F", 8).select("job", "o_orderkey", "outcome")


@query("""SELECT o_orderpriority AS job, row_number() OVER (PARTITION BY o_orderpriority ORDER BY o_orderkey) AS line, o_orderkey FROM orders""")
def response_lines(spark, sf_dir):
    """Line numbers of result files, one a job, that Spark reads in several splits each."""
    folder = shared_folder(spark, "lines")
    o = load(spark, sf_dir, "orders").select(F.col("o_orderpriority").alias("job"), "o_orderkey")
    ordered = o.repartition("job").sortWithinPartitions("job", "o_orderkey").select("job", F.to_json(F.struct("o_orderkey")).alias("value"))
    ordered.write.mode("overwrite").partitionBy("job").text(folder)
    found = books.numbered_lines(spark, folder)
    job = F.regexp_extract("file", "/job=([^/]*)/", 1)
    return found.select(F.url_decode(job).alias("job"), F.col("line").cast("long").alias("line"), F.get_json_object("value", "$.o_orderkey").cast("long").alias("o_orderkey"))


# -- the split stage ----------------------------------------------------------------------------------------------

_SCAN_HEIGHT, _SCAN_EDGE, _OVERLAP = 420, 60, 40


def _scans(frames):
    """A scan for each (folder, book, page, columns, width, blank): rules between columns, short strokes, white margins."""
    for frame in frames:
        for folder, book, page, columns, width, blank in frame.itertuples(index=False, name=None):
            image = np.full((_SCAN_HEIGHT, width), 255, np.uint8)
            if not blank:
                strokes = [x for x in range(_SCAN_EDGE, width - _SCAN_EDGE) if x % 9 < 5]
                for y in range(40, _SCAN_HEIGHT - 40, 14):
                    image[y : y + 8, strokes] = 0
                for i in range(1, columns):
                    x = _SCAN_EDGE + (width - 2 * _SCAN_EDGE) * i // columns
                    image[:, x - 8 : x + 8] = 255
                    image[30 : _SCAN_HEIGHT - 30, x : x + 2] = 0
            FileSink(folder, attempt_name()).put(f"{book}/{page}.png", png(image))
        yield frame[["book", "page"]]


@query(f"""
WITH s AS (SELECT concat('b', cast(s_suppkey % 3 + 2 AS string)) AS book, lpad(cast(s_suppkey AS string), 7, '0') AS page, s_suppkey % 3 + 2 AS n, 900 + s_nationkey * 4 AS w, s_acctbal < 0 AS blank FROM supplier),
k AS (SELECT *, CASE WHEN page BETWEEN '0000005' AND '0000009' THEN 'excluded' WHEN blank THEN 'skipped' ELSE 'split' END AS status FROM s)
SELECT book, page, status, CASE status WHEN 'excluded' THEN 'configured_exclude' WHEN 'skipped' THEN concat('0 rules for ', n, ' columns') END AS reason,
 CASE WHEN status = 'split' THEN cast(n AS int) END AS columns,
 CASE WHEN status = 'split' THEN array_to_string(list_transform(range(0, n), lambda i: CASE WHEN i = 0 THEN 0 ELSE {_SCAN_EDGE} + (w - {2 * _SCAN_EDGE}) * i // n - {_OVERLAP} END), ',') END AS starts,
 CASE WHEN status = 'split' THEN array_to_string(list_transform(range(1, n + 1), lambda i: CASE WHEN i = n THEN w ELSE {_SCAN_EDGE} + (w - {2 * _SCAN_EDGE}) * i // n + {_OVERLAP} END), ',') END AS ends,
 CASE WHEN status = 'split' THEN array_to_string(list_transform(range(1, n + 1), lambda i: concat(book, '/', page, '-', lpad(cast(i AS string), 2, '0'), '.png')), ',') END AS files FROM k""")
def split_manifest(spark, sf_dir):
    """The split stage over a scan for each supplier: drawn to a shared folder, split, written; what its manifest then says."""
    folder = shared_folder(spark, "split")
    suppliers = load(spark, sf_dir, "supplier").select(
        F.lit(f"{folder}/scans").alias("folder"),
        F.expr("concat('b', cast(s_suppkey % 3 + 2 AS string))").alias("book"),
        F.expr("lpad(cast(s_suppkey AS string), 7, '0')").alias("page"),
        F.expr("cast(s_suppkey % 3 + 2 AS int)").alias("columns"),
        F.expr("cast(900 + s_nationkey * 4 AS int)").alias("width"),
        F.expr("s_acctbal < 0").alias("blank"),
    )
    tasks = -(-suppliers.count() // split.PAGES_A_TASK)  # a small table is read by one task
    suppliers.repartition(max(1, tasks)).mapInPandas(_scans, "book string, page string").write.format("noop").mode("overwrite").save()
    for n in (2, 3, 4):
        config = {"split": {"fixedColumnCount": n, "excludePageRanges": ["0000005-0000009"]}}
        FileSink(f"{folder}/scans", "config").put(f"b{n}/{split.CONFIG}", json.dumps(config).encode())
    found = split.split_books(spark, f"{folder}/scans", f"{folder}/columns")
    listed = lambda of: F.array_join(F.transform("columns", lambda c: c[of].cast("string")), ",")
    return found.select("book", "page", "status", "reason", F.col("columnCount").alias("columns"), listed("x1").alias("starts"), listed("x2").alias("ends"), F.array_join("files", ",").alias("files"))
