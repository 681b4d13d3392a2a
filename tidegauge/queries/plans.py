"""Execution plans: documents built from order lines, then flattened."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidegauge.plans import steps as P
from tidegauge.plans.steps import plan_rejects, plan_steps
from tidegauge.queries import statements as Q
from tidegauge.queries.oracle_text import STATEMENTS
from tidegauge.queries.registry import Sample, query, written

# One JSON table object per merged order line. Odd orders are MariaDB.
_MYSQL_TABLE = """concat('{"table":{"table_name":"t', cast(partkey AS string), '`x","access_type":"',
  CASE WHEN l_linenumber % 2 = 0 THEN 'ALL' ELSE 'ref' END, '","possible_keys":["PRIMARY","k', cast(l_linenumber AS string),
  '"],"key":"k', cast(l_linenumber AS string), '","used_key_parts":["a","b"],"key_length":"4","ref":["const"],',
  CASE WHEN l_linenumber % 3 = 0 THEN '"rows_examined_per_scan":0,"rows":99,' ELSE concat('"rows_examined_per_scan":', cast(qty AS string), ',') END,
  '"rows_produced_per_join":', cast(qty * 2 AS string), ',"filtered":"', cast(qty AS string), '.00","using_index":',
  CASE WHEN l_linenumber % 2 = 0 THEN 'true' ELSE 'false' END, ',"cost_info":{',
  CASE WHEN l_linenumber % 4 = 0 THEN concat('"query_cost":"', cast(partkey AS string), '.10",') ELSE '' END,
  '"read_cost":"', cast(qty AS string), '.25","eval_cost":"0.', cast(l_linenumber AS string), '","prefix_cost":"', cast(partkey AS string),
  '","data_read_per_join":"', cast(qty AS string), 'K"},"attached_condition":"(`a` = \\\\"{\\\\"table_name\\\\":1}\\\\")"}}')"""
_MARIADB_TABLE = """concat('"', CASE WHEN l_linenumber % 3 = 2 THEN 'block-nl-join":{"table' ELSE 'table' END, '":{"table_name":"t',
  cast(partkey AS string), '","access_type":"ALL",', CASE WHEN l_linenumber % 2 = 0 THEN concat('"rows":', cast(qty AS string), ',') ELSE '"rows":1.5,' END,
  CASE WHEN l_linenumber % 2 = 1 THEN concat('"cost":', cast(partkey AS string), '.000125,') ELSE '' END,
  '"filtered":', cast(qty AS string), '.125,"using_index":"true","possible_keys":["PRIMARY"]}', CASE WHEN l_linenumber % 3 = 2 THEN '}' ELSE '' END)"""


_FIELD = re.compile(r"\b(l_linenumber|partkey|qty)\b")

#: Documents of a reader's trouble, by order: cut short, followed by text, nested over the limit.
_UNREAD = "l_orderkey % 50 IN (0, 10, 12)"


def documents(t: Sample) -> DataFrame:
    """One plan per order. An order has at most seven distinct line numbers.

    By the order's key some are odd: unreadable ones (``_UNREAD``), 300 objects
    and arrays around the plan (20), repeated keys outside MariaDB, of which the
    last counts (30), costs of 1e20 (21) and 1e300 (31) in MariaDB.
    """
    # v_lines, with an order's lines in one place from the start: numbers are shuffled once, and texts never.
    lines = t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_quantity").repartition("l_orderkey").groupBy("l_orderkey", "l_linenumber")
    merged = lines.agg(F.max("l_partkey").alias("partkey"), F.max("l_quantity").cast("long").alias("qty"))
    line = F.struct("l_linenumber", "partkey", "qty")
    per_order = merged.groupBy("l_orderkey").agg(F.array_sort(F.collect_list(line)).alias("lines"))
    of_line = lambda table: _FIELD.sub(r"l.\g<0>", table)
    # An order's lines are read in one place of one expression: a semi join of documents then goes below all this.
    tables = F.array_join(F.expr(f"transform(lines, l -> IF(l_orderkey % 2 = 1, {of_line(_MARIADB_TABLE)}, {of_line(_MYSQL_TABLE)}))"), ",")
    order, rest, odd = F.col("l_orderkey").cast("string"), F.col("l_orderkey") % 50, F.col("l_orderkey") % 2 == 1
    cost = F.when(rest == 21, "1e20").when(rest == 31, "1e300").otherwise(F.concat(order, F.lit(".5")))
    mariadb = F.concat(F.lit('{"query_block":{"select_id":1,"cost":'), cost, F.lit(","))
    mysql = F.concat(F.lit('"query_block":{"select_id":1,"cost_info":{"query_cost":"'), order, F.lit('.50"},"nested_loop":['))
    before = (
        F.when(rest == 12, '{"s":[' * 600 + "{")
        .when(rest == 20, '{"s":[' * 150 + "{")
        .when(rest == 30, '{"query_block":{"table":{"table_name":"earlier"}},')
        .otherwise("{")
    )
    after = F.when(rest == 0, "]").when(rest == 10, " {}").when(rest == 12, "]}" * 600).when(rest == 20, "]}" * 150).otherwise("")
    return per_order.select(
        F.col("l_orderkey").alias("event_id"),
        (F.col("l_orderkey") % 97).alias("thread_id"),
        F.when(odd, "mariadb").otherwise("mysql").alias("flavor"),
        F.concat(
            F.when(odd, mariadb).otherwise(F.concat(before, mysql)), tables, F.when(odd, "}}").otherwise(F.concat(F.lit("]}}"), after))
        ).alias("plan_json"),
    )


# Its digits are written out, as the oracle prints other ones.
_HUGE = f"{1e300:.5f}"
_STEPS = {
    "o_steps": rf"""
SELECT l_orderkey AS event_id, l_orderkey % 97 AS thread_id, (row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber) - 1)::integer AS step_id,
  CASE WHEN l_orderkey % 2 = 1 THEN CASE WHEN l_linenumber % 2 = 1 THEN printf('%.5f', partkey + 0.000125) ELSE CASE l_orderkey % 50 WHEN 21 THEN printf('%.5f', 1e20) WHEN 31 THEN '{_HUGE}' ELSE printf('%.5f', l_orderkey + 0.5) END END
    WHEN l_linenumber % 4 = 0 THEN concat(partkey, '.10') ELSE concat(l_orderkey, '.50') END AS query_cost,
  CASE WHEN l_orderkey % 2 = 1 THEN concat('t', partkey) ELSE concat('t', partkey, '\`x') END AS table_name,
  CASE WHEN l_orderkey % 2 = 1 OR l_linenumber % 2 = 0 THEN 'ALL' ELSE 'ref' END AS access_type,
  CASE WHEN l_orderkey % 2 = 1 THEN CASE WHEN l_linenumber % 2 = 0 THEN qty ELSE 0 END WHEN l_linenumber % 3 = 0 THEN 0 ELSE qty END AS rows_examined_per_scan,
  CASE WHEN l_orderkey % 2 = 1 THEN 0 ELSE qty * 2 END AS rows_produced_per_join,
  CASE WHEN l_orderkey % 2 = 1 THEN printf('%.2f', qty + 0.125) ELSE concat(qty, '.00') END AS filtered,
  CASE WHEN l_orderkey % 2 = 1 THEN '' ELSE concat(qty, '.25') END AS read_cost,
  CASE WHEN l_orderkey % 2 = 1 THEN '' ELSE concat('0.', l_linenumber) END AS eval_cost,
  CASE WHEN l_orderkey % 2 = 1 THEN 'PRIMARY' ELSE concat('PRIMARY,k', l_linenumber) END AS possible_keys,
  CASE WHEN l_orderkey % 2 = 1 THEN '' ELSE concat('k', l_linenumber) END AS key,
  CASE WHEN l_orderkey % 2 = 1 THEN '' ELSE 'a,b' END AS used_key_parts,
  CASE WHEN l_orderkey % 2 = 1 THEN '' ELSE 'const' END AS ref,
  CASE WHEN l_orderkey % 2 = 1 THEN '' ELSE partkey::varchar END AS prefix_cost,
  CASE WHEN l_orderkey % 2 = 1 THEN '' ELSE concat(qty, 'K') END AS data_read_per_join,
  CASE WHEN l_orderkey % 2 = 0 AND l_linenumber % 2 = 0 THEN 'true' ELSE 'false' END AS using_index,
  CASE WHEN l_orderkey % 2 = 1 THEN '' ELSE '4' END AS key_length
FROM v_lines WHERE NOT l_orderkey % 50 IN (0, 10, 12)""",
}

_ID = "event_id, thread_id, step_id"
_VIEWS = {
    "plan_steps": "*",
    "plan_cost_inherit": f"{_ID}, query_cost",
    "plan_rows_fallback": f"{_ID}, rows_examined_per_scan",
    "plan_filtered_format": f"{_ID}, filtered",
    "plan_key_lists": f"{_ID}, possible_keys, used_key_parts, ref, using_index",
    "plan_costs_detail": f"{_ID}, read_cost, eval_cost, prefix_cost, data_read_per_join",
}


def _register(key: str, columns: str) -> None:
    @query(key, f"SELECT {columns} FROM o_steps", _STEPS)
    def steps(t):
        found = plan_steps(documents(t))
        return found if columns == "*" else found.select(*columns.split(", "))


for _key, _columns in _VIEWS.items():
    _register(_key, _columns)


@query("plan_duplicate_keys", f"SELECT {_ID}, table_name FROM o_steps WHERE event_id % 2 = 1", _STEPS)
def plan_duplicate_keys(t):
    """Only MariaDB documents repeat keys."""
    repeated = documents(t).filter("flavor = 'mariadb'")
    return plan_steps(repeated).select("event_id", "thread_id", "step_id", "table_name")


@query("plan_rejects", f"SELECT DISTINCT l_orderkey AS event_id, 'mysql' AS flavor FROM v_lines WHERE {_UNREAD}")
def rejects(t):
    """Three in fifty orders' documents are cut short, followed by text or too deep."""
    return plan_rejects(documents(t)).select("event_id", "flavor")


PLAN_SAMPLES = {
    **STATEMENTS,
    **_STEPS,
    "o_plan_samples": """
SELECT i.instance, i.collected_at, i.event_id, i.thread_id, s.* EXCLUDE (event_id, thread_id)
FROM o_individual i JOIN o_steps s ON s.event_id = i.event_id
WHERE i.database_name IS NOT NULL AND i.query_id IS NOT NULL AND NOT contains(i.query_sample_text, '?')
  AND regexp_matches(i.query_sample_text, '^\\s*(select|with)', 'i')""",
}


@query("plan_samples", "SELECT * FROM o_plan_samples", PLAN_SAMPLES)
def plan_samples(t):
    """The reported executions' plans; the sample documents are known by their event alone.

    The executions are read twice, so they are written first.
    """
    return P.plan_samples(Q.individual(written(t)), documents(t), ("event_id",))
