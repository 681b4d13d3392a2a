"""Slow statements, executions, waits and blocking sessions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidegauge.operators import blocking as B
from tidegauge.operators import filters
from tidegauge.operators import statements as ST
from tidegauge.operators import waits as W
from tidegauge.queries.oracle_text import BLOCKING_ORDER, EXCLUDED, STATEMENTS, first_k
from tidegauge.queries.registry import Sample, query, written

LOOKBACK = 864_000


def _as_bigint(df: DataFrame, *names: str) -> DataFrame:
    return df.withColumns({n: F.col(n).cast("long") for n in names})


def summary(t: Sample) -> DataFrame:
    return t.once("summary", lambda: ST.digest_rollup(t.v_st_history))


def slow(t: Sample) -> DataFrame:
    flavored = summary(t).join(t.v_nodes.select("instance", "collected_at", "flavor"), ["instance", "collected_at"])
    return ST.slow_queries(flavored, LOOKBACK)


def top_slow(t: Sample) -> DataFrame:
    return ST.topk_slow(slow(t))


def individual(t: Sample) -> DataFrame:
    return t.once("individual", lambda: ST.individual_queries(t.v_st_current, t.v_st_history, top_slow(t)))


def waits(t: Sample) -> DataFrame:
    return W.union_waits(t.v_waits.filter("is_current"), t.v_waits.filter("NOT is_current")).drop("is_current")


def wait_statements(t: Sample) -> DataFrame:
    return W.union_statements(t.v_st_current, t.v_st_history)


@query("digest_rollup", "SELECT * FROM o_summary", STATEMENTS)
def digest_rollup(t):
    return _as_bigint(summary(t), "sum_cpu_time", "sum_timer_wait")


@query("slow_queries", "SELECT * FROM o_slow WHERE query_id IS NOT NULL", STATEMENTS)
def slow_queries(t):
    return slow(t).filter("query_id IS NOT NULL")


query("topk_slow", "SELECT * FROM o_topk_slow", STATEMENTS)(top_slow)


@query(
    "slow_semi_join",
    """SELECT e.instance, e.collected_at, e.event_id, e.thread_id, e.digest, e.timer_wait FROM v_st_history e
    WHERE EXISTS (SELECT 1 FROM o_topk_slow s WHERE s.instance = e.instance AND s.query_id = e.digest)""",
    STATEMENTS,
)
def slow_semi_join(t):
    found = ST.slow_semi_join(t.v_st_history, top_slow(t))
    return found.select("instance", "collected_at", "event_id", "thread_id", "digest", "timer_wait")


_EXECUTION = "source, instance, collected_at, event_id, thread_id, digest, sql_text, timer_wait, current_schema"


@query("union_executions", f"SELECT {_EXECUTION} FROM o_executions", STATEMENTS)
def union_executions(t):
    return ST.union_executions(t.v_st_current, t.v_st_history).selectExpr(*_EXECUTION.split(", "))


@query(
    "topk_per_digest",
    first_k(
        f"(SELECT {_EXECUTION} FROM o_executions)",
        "timer_wait DESC, event_id, thread_id",
        10,
        "instance, collected_at, source, digest",
    ),
    STATEMENTS,
)
def topk_per_digest(t):
    return ST.topk_per_digest(ST.union_executions(t.v_st_current, t.v_st_history)).selectExpr(*_EXECUTION.split(", "))


@query(
    "dedup_executions",
    first_k(
        f"(SELECT {_EXECUTION} FROM o_executions WHERE event_id IS NOT NULL AND thread_id IS NOT NULL)",
        "source, timer_wait DESC",
        1,
        "instance, collected_at, event_id, thread_id",
    ),
    STATEMENTS,
)
def dedup_executions(t):
    both = ST.union_executions(t.v_st_current, t.v_st_history).withColumn("slow_rank", F.lit(1))
    return ST.dedup_executions(both).selectExpr(*_EXECUTION.split(", "))


@query("individual_queries", "SELECT * EXCLUDE (query_sample_text) FROM o_individual", STATEMENTS)
def individual_queries(t):
    return ST.drop_sample_text(individual(t)).drop("query_sample_text")


@query(
    "drop_sample_text",
    "SELECT instance, collected_at, event_id, thread_id, query_id, NULL::varchar AS query_sample_text FROM o_individual",
    STATEMENTS,
)
def drop_sample_text(t):
    reported = ST.drop_sample_text(individual(t))
    return reported.select("instance", "collected_at", "event_id", "thread_id", "query_id", "query_sample_text")


@query(
    "require_db_and_text",
    "SELECT * FROM o_individual WHERE database_name IS NOT NULL AND query_sample_text IS NOT NULL",
    STATEMENTS,
)
def require_db_and_text(t):
    return filters.require_db_and_text(individual(t))


@query(
    "database_groups",
    """SELECT instance, collected_at, database_name, count(*) AS query_count, count(DISTINCT query_id) AS digest_count
    FROM o_individual WHERE database_name IS NOT NULL AND query_sample_text IS NOT NULL
    GROUP BY instance, collected_at, database_name""",
    STATEMENTS,
)
def database_groups(t):
    return ST.database_groups(individual(t))


@query(
    "exclude_databases",
    f"""SELECT instance, event_id, current_schema FROM v_st_history
    WHERE current_schema IS NOT NULL AND current_schema NOT IN ('crm', {EXCLUDED[1:]}""",
)
def exclude_databases(t):
    from tidegauge.settings import excluded_databases

    kept = filters.exclude_databases(t.v_st_history, "current_schema", excluded_databases('[" crm ", ""]'))
    return kept.select("instance", "event_id", "current_schema")


@query(
    "lookback_filter",
    "SELECT instance, digest, last_seen FROM o_summary WHERE last_seen >= collected_at - INTERVAL 90000 SECOND",
    STATEMENTS,
)
def lookback_filter(t):
    return filters.lookback_filter(summary(t), "last_seen", 90_000).select("instance", "digest", "last_seen")


@query(
    "min_exec_time",
    "SELECT instance, event_id, timer_wait FROM v_st_history WHERE timer_wait / 1000000000 > 250",
)
def min_exec_time(t):
    return filters.min_exec_time(t.v_st_history, 250).select("instance", "event_id", "timer_wait")


@query(
    "explainable",
    """SELECT instance, event_id, coalesce(digest IS NOT NULL AND trim(sql_text) <> ''
      AND (upper(trim(sql_text)) LIKE 'SELECT%' OR upper(trim(sql_text)) LIKE 'WITH%')
      AND sql_text NOT LIKE '%?%', false) AS can_explain FROM v_st_history""",
)
def explainable(t):
    flag = filters.explainable(F.col("digest"), F.col("sql_text"))
    return t.v_st_history.select("instance", "event_id", flag.alias("can_explain"))


@query("union_waits", "SELECT (NOT is_current)::integer AS source, instance, thread_id, event_name, timer_wait FROM v_waits")
def union_waits(t):
    return waits(t).select("source", "instance", "thread_id", "event_name", "timer_wait")


query("union_statements", "SELECT * FROM o_statements", STATEMENTS)(wait_statements)


@query("wait_partial_agg", "SELECT * FROM o_waits_partial", STATEMENTS)
def wait_partial_agg(t):
    return _as_bigint(W.wait_partial_agg(waits(t)), "total_wait_time")


@query(
    "wait_join",
    """SELECT instance, collected_at, source, thread_id, wait_event_name, total_wait_time, wait_event_count, query_id,
      database_name, query_text, count(*) AS repeats FROM o_waits_joined
    GROUP BY instance, collected_at, source, thread_id, wait_event_name, total_wait_time, wait_event_count, query_id,
      database_name, query_text""",
    STATEMENTS,
)
def wait_join(t):
    return _as_bigint(W.wait_join(W.wait_partial_agg(waits(t)), wait_statements(t)), "total_wait_time")


@query("wait_events", "SELECT * FROM o_wait_events", STATEMENTS)
def wait_events(t):
    return W.wait_events(waits(t), wait_statements(t))


@query(
    "topk_waits",
    first_k("o_wait_events", "total_wait_time_ms DESC, query_id, database_name, wait_event_name, query_text", 20),
    STATEMENTS,
)
def topk_waits(t):
    return W.topk_waits(wait_events(t))


# The servers' clocks: three zones over the instances.
ZONE = "CASE instance WHEN 'db1:3306' THEN '+02:00' WHEN 'db2:3306' THEN '-05:30' ELSE 'UTC' END"


@query("blocking_sessions_mysql", "SELECT * FROM o_blocking_mysql", STATEMENTS)
def blocking_sessions_mysql(t):
    return B.blocking_sessions_mysql(t.v_lock_waits, t.v_threads, t.v_trx, t.v_st_current, summary(t), zone=F.expr(ZONE))


@query("blocking_sessions_mariadb", "SELECT * FROM o_blocking_mariadb", STATEMENTS)
def blocking_sessions_mariadb(t):
    return B.blocking_sessions_mariadb(t.v_trx_lock_waits, t.v_threads, t.v_trx, t.v_st_current, zone=F.expr(ZONE))


@query("topk_blocking", first_k("o_blocking_mysql", BLOCKING_ORDER, 20), STATEMENTS)
def topk_blocking(t):
    return B.topk_blocking(blocking_sessions_mysql(t))


BLOCKING_SQL = first_k(
    """(SELECT b.* FROM o_blocking_mysql b JOIN v_nodes n ON n.instance = b.instance AND n.flavor = 'mysql'
    UNION ALL BY NAME
    SELECT b.* FROM o_blocking_mariadb b JOIN v_nodes n ON n.instance = b.instance AND n.flavor = 'mariadb')""",
    BLOCKING_ORDER,
    20,
)


@query("blocking_sessions", BLOCKING_SQL, STATEMENTS)
def blocking_sessions(t):
    tables = (t.v_nodes, t.v_lock_waits, t.v_trx_lock_waits, t.v_threads, t.v_trx, t.v_st_current, summary(t))
    return B.blocking_sessions(*tables, zone=F.expr(ZONE), once=written(t).once)
