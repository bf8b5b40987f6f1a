"""Derived inputs for the registered queries, as SQL that Spark and the oracle both run."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

from dirbook.operators.scans import row_numbers

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations")

VIEWS = {
    "v_phone_raw": """
SELECT c_custkey AS row_idx, CASE c_custkey % 6
 WHEN 0 THEN concat('06-', lpad(cast(c_custkey % 900 + 100 AS string), 3, '0'), '-', lpad(cast(c_custkey % 97 AS string), 4, '0'))
 WHEN 1 THEN concat('(', cast(c_custkey % 900 + 100 AS string), ')', lpad(cast(c_custkey % 9000 AS string), 4, '0'), '代')
 WHEN 2 THEN concat('※0', cast(c_custkey % 90 + 720 AS string), '--', lpad(cast(c_custkey % 9000 AS string), 4, '0'))
 WHEN 3 THEN concat(cast(c_custkey % 900 + 100 AS string), '-', lpad(cast(c_custkey % 9000 AS string), 4, '0'), '代表')
 WHEN 4 THEN '' ELSE concat('06ー', cast(c_custkey % 900 + 100 AS string), 'ー', lpad(cast(c_custkey % 97 AS string), 4, '0')) END AS phone_raw,
 c_mktsegment AS name FROM customer""",
    "v_address": """
SELECT c_custkey AS row_idx, concat(CASE c_custkey % 9 WHEN 0 THEN '北' WHEN 1 THEN '東,' WHEN 2 THEN '豊,' WHEN 3 THEN '尼,' WHEN 4 THEN '北河,門真' WHEN 5 THEN '布,' WHEN 6 THEN '東淀川' WHEN 7 THEN '大阪市北区' ELSE 'zz' END,
 lower(c_mktsegment), CASE WHEN c_custkey % 4 = 0 THEN '' ELSE concat(cast(c_custkey % 50 AS string), '-', cast(c_custkey % 7 AS string)) END) AS address,
 CASE WHEN c_custkey % 2 = 0 THEN '1963-02-01' ELSE '1968-03-01' END AS as_of FROM customer""",
    "v_location": """
SELECT c_custkey AS row_idx, concat('P', cast(c_nationkey % 3 AS string)) AS prefecture, concat('M', cast(c_nationkey % 6 AS string)) AS municipality,
 concat(CASE WHEN c_custkey % 211 = 0 THEN 'x,' ELSE '' END, substr('abcdefgh', cast(c_custkey % 8 + 1 AS int), 1), cast((c_custkey * c_custkey) % 5 AS string)) AS area,
 cast(c_custkey % 100 AS string) AS lot FROM customer""",
    "v_wide_location": """
SELECT row_idx, concat(' ', prefecture) AS prefecture, municipality, CASE WHEN row_idx % 3 = 0 THEN translate(area, '01234', '０１２３４') WHEN row_idx % 3 = 1 THEN concat(area, ' ') ELSE area END AS area, lot FROM v_location""",
    "v_odd_location": """
SELECT c_custkey AS row_idx, '大阪府' AS prefecture, CASE WHEN c_nationkey % 3 = 0 THEN '大阪市' WHEN c_nationkey % 3 = 1 THEN '堺市' ELSE '' END AS municipality,
 concat(CASE c_custkey % 8 WHEN 0 THEN '大阪府' WHEN 1 THEN '豊中' WHEN 2 THEN '北' WHEN 3 THEN '堺' WHEN 4 THEN 'x区' WHEN 5 THEN '大阪' WHEN 6 THEN '中,' ELSE '' END, lower(c_mktsegment), CASE WHEN c_custkey % 50 = 0 THEN cast(c_custkey AS string) ELSE '' END) AS area,
 '1' AS lot FROM customer""",
    "v_separated": "SELECT row_idx, prefecture, municipality, replace(area, 'x,', ',') AS area, lot FROM v_location",
    "v_judged": """
SELECT row_idx AS decision_idx, concat(prefecture, chr(9), municipality, chr(9), area) AS id, CASE WHEN row_idx % 3 = 0 THEN 'keep' ELSE 'replace' END AS action,
 concat(prefecture, chr(9), municipality, chr(9), replace(area, ',', '')) AS corrected_id, cast((row_idx % 100) / 100.0 AS double) AS confidence
 FROM v_separated WHERE area LIKE ',%'""",
    "v_segment": """
SELECT l_orderkey % 7 AS book, row_number() OVER (PARTITION BY l_orderkey % 7 ORDER BY l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice) AS pos,
 CASE WHEN l_quantity >= 49 THEN 'category_heading' WHEN l_quantity >= 48 THEN 'ad_block' ELSE 'directory_entry' END AS entry_type,
 cast(l_linenumber % 4 AS int) AS indent_level, concat('n', cast(l_partkey % 50 AS string)) AS name FROM lineitem""",
    "v_bookname": """
SELECT o_orderkey AS row_idx, CASE WHEN o_orderkey % 10 = 0 THEN 'misc' ELSE concat('昭和', cast(year(o_orderdate) - 1925 AS string), '年', cast(month(o_orderdate) AS string), '月', cast(day(o_orderdate) AS string), '日', '大阪市',
 CASE o_orderkey % 3 WHEN 0 THEN '50音別電話番号簿' WHEN 1 THEN '職業別電話番号簿' ELSE '名簿' END) END AS book FROM orders""",
    "v_job": """
SELECT o_orderkey AS name, CASE o_orderstatus WHEN 'F' THEN 'JOB_STATE_SUCCEEDED' WHEN 'O' THEN 'JOB_STATE_RUNNING' ELSE 'JOB_STATE_FAILED' END AS state FROM orders""",
    "v_result": """
SELECT o_orderpriority AS job, cast(o_orderkey AS string) AS output_key, o_orderstatus AS status_said, CASE WHEN o_orderpriority = '5-LOW' THEN 'nothing found' ELSE concat('``` ', chr(123), '"a":', cast(o_custkey AS string), chr(125), ' ```') END AS said,
 CASE WHEN o_orderpriority = '1-URGENT' THEN 'quota' END AS error FROM orders""",
    "v_decision": """
SELECT row_idx AS decision_idx, concat(prefecture, chr(9), municipality, chr(9), area) AS id, CASE WHEN row_idx % 3 = 0 THEN 'keep' ELSE 'replace' END AS action,
 concat(prefecture, chr(9), municipality, chr(9), replace(area, 'x,', '')) AS corrected_id, cast((row_idx % 100) / 100.0 AS double) AS confidence
 FROM v_location WHERE area LIKE 'x,%'""",
    "v_entry": """
SELECT o_orderkey AS row_idx, concat(cast(o_custkey % 900 + 100 AS string), '-', lpad(cast(o_orderkey % 9000 AS string), 4, '0'), '、', cast(o_custkey % 900 + 100 AS string), '-', lpad(cast(o_orderkey % 3 AS string), 4, '0')) AS phones_text,
 concat('n', cast(o_custkey AS string)) AS name, concat('a', cast(o_orderkey % 40 AS string), '|', 'a', cast(o_orderkey % 40 AS string), CASE WHEN o_orderkey % 2 = 0 THEN '0' ELSE '-x' END) AS addresses_text FROM orders""",
}


_NUMBER = re.compile(r"row_number\(\) OVER \(PARTITION BY (.+?) ORDER BY ([^()]+)\)")


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A driver table, or a derived view of it."""
    if name in TABLES:
        return spark.read.parquet(f"{sf_dir}/{name}.parquet")
    sql = VIEWS[name]
    source = re.search(r"FROM (\w+)", sql)[1]
    rows = load(spark, sf_dir, source)
    if number := _NUMBER.search(sql):  # a window would run each key, here a book, in one task
        used = [c for c in rows.columns if re.search(rf"\b{c}\b", sql)]
        rows = row_numbers(rows.select(*used).selectExpr("*", f"{number[1]} AS numbered_by"), ["numbered_by"], number[2].split(", "), "number")
        sql = sql.replace(number[0], "cast(number AS int)")
    return spark.sql(re.sub(rf"FROM {source}\b", f"FROM {{{source}}}", sql), **{source: rows})


def with_views(sql: str) -> str:
    """Oracle SQL with the views that it names put before it."""
    needed, todo = [], re.findall(r"\bv_\w+", sql)
    while todo:
        name = todo.pop()
        if name in VIEWS:
            if name in needed:
                needed.remove(name)
            needed.append(name)
            todo += re.findall(r"\bv_\w+", VIEWS[name])
    views = [f"{n} AS ({VIEWS[n].strip()})" for n in reversed(needed)]
    body = sql.strip()
    if not views:
        return body
    recursive = body.upper().startswith("WITH RECURSIVE")
    if body.upper().startswith("WITH"):
        return ("WITH RECURSIVE " if recursive else "WITH ") + ", ".join(views) + ", " + re.sub(r"^WITH( RECURSIVE)?\s+", "", body, flags=re.I)
    return "WITH " + ", ".join(views) + "\n" + body
