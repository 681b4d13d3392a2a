"""Telemetry relations derived from the sample tables.

The sample data set has no telemetry, so each relation is a query over its
tables. The text is portable: Spark runs it over the parquet files and the
oracle runs the same text as CTEs. Only ``NTZ`` (the zone-less timestamp type)
differs between the two.
"""

from __future__ import annotations

import hashlib
import re

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()

COLLECTED = "cast('2024-01-31 00:00:00' AS NTZ)"

# Status names landed by the v_status relation, one per event.
STATUS_NAMES = (
    "Queries Questions Connections Threads_created Threads_cached Threads_connected Threads_running Slow_queries "
    "Bytes_sent Bytes_received Aborted_clients Aborted_connects Com_select Com_insert Com_update Com_delete "
    "Qcache_hits Qcache_free_blocks Qcache_total_blocks Qcache_free_memory Qcache_not_cached Open_files Open_tables "
    "Opened_tables Max_used_connections Key_blocks_unused Key_reads Key_read_requests Innodb_rows_read "
    "Innodb_rows_inserted Innodb_data_reads Innodb_data_pending_reads Innodb_num_open_files Select_range Sort_rows "
    "Handler_write Uptime"
).split()

# Version strings landed for the customer-derived servers.
SERVER_VERSIONS = (
    "8.0.37-1build2",
    "8.4.6-commercial",
    "9.4.0",
    "5.7.44",
    "6",
    "unknown",
    "",
    "10.4-MariaDB",
    "10.1.9-MariaDB",
    "10.11.5-MariaDB",
    "11.8.1-MariaDB-log",
    "07.9",
    "10.x7.1",
)

# One version per instance of the status and variables relations.
NODE_VERSIONS = (
    "8.0.37-1build2",
    "8.4.5-lts",
    "9.1.0",
    "5.7.35",
    "10.6.9-MariaDB",
    "5.6.51",
    "invalid",
    "11.4.1-MariaDB-log",
)

# Raw variable values that exercise typing.
ODD_VALUES = (
    "10", "0.12", "true", "Yes", "ON", "", " 5 ", "1d", "1e5", "+7", "text", "F", "TRUE", "tRUE", "99999999999999999999",
    "1e400", "-12", ".5", "5.", "1_000", "-0", "0x1F", "1.5e-3", "t", "0", "1", "0x1.8p3", "0x_1Fp-2", "-0X.8P1", "1__0",
)


def _pick(expr: str, values: tuple[str, ...] | list[str]) -> str:
    arms = " ".join(f"WHEN {i} THEN '{v}'" for i, v in enumerate(values))
    return f"CASE cast({expr} AS int) {arms} END"


_ST_COLUMNS = (
    "instance, collected_at, event_id, thread_id, digest, digest_text, sql_text, timer_wait, cpu_time, rows_sent, "
    "rows_examined, rows_affected, no_index_used, current_schema, ts"
)

VIEWS: dict[str, str] = {
    # Executions: events_statements_history.
    "v_st_history": f"""
SELECT concat('db', cast(user_id % 4 AS string), ':3306') AS instance, {COLLECTED} AS collected_at,
  event_id, user_id AS thread_id,
  CASE WHEN event_id % 97 = 0 THEN NULL ELSE md5(concat(event_type, cast(event_id % 7 AS string))) END AS digest,
  concat(CASE event_type WHEN 'click' THEN 'SELECT a FROM t' WHEN 'view' THEN 'INSERT INTO t'
         WHEN 'signup' THEN 'UPDATE t' WHEN 'purchase' THEN 'DELETE FROM t' ELSE 'CALL p' END,
         cast(event_id % 7 AS string), ' /* ? */') AS digest_text,
  CASE WHEN event_id % 53 = 0 THEN NULL
       WHEN event_type = 'error' AND event_id % 11 = 0 THEN 'LOCK TABLES t; FLUSH TABLES t WITH READ LOCK'
       WHEN event_type = 'error' AND event_id % 3 = 0 THEN concat('LOCK TABLES t', cast(event_id % 7 AS string))
       WHEN event_type = 'error' AND event_id % 3 = 1 THEN 'FLUSH TABLES WITH READ LOCK'
       WHEN event_type = 'error' THEN '/* dump */ START TRANSACTION WITH CONSISTENT SNAPSHOT'
       WHEN event_id % 31 = 0 THEN ' select a from t where k = ? '
       WHEN event_id % 29 = 0 THEN '   '
       WHEN event_id % 5 = 0 THEN concat('With x as (select ', cast(event_id AS string), ') select * from x')
       WHEN event_id % 5 = 1 THEN concat('UPDATE t SET a = ''it''''s'' WHERE b = 0x1F AND c = ', cast(event_id AS string))
       ELSE concat('select a from t where k = ''', event_type, ''' and id > ', cast(event_id AS string)) END AS sql_text,
  cast(round(value * 100) AS bigint) * 10000000 + (event_id % 4) * 500000 AS timer_wait,
  cast(round(value * 100) AS bigint) * 6000000 AS cpu_time,
  event_id % 100 AS rows_sent, event_id % 1000 AS rows_examined, event_id % 13 AS rows_affected,
  event_id % 2 AS no_index_used,
  CASE cast(user_id % 6 AS int) WHEN 0 THEN 'mysql' WHEN 1 THEN NULL WHEN 2 THEN '' WHEN 3 THEN 'shop'
    WHEN 4 THEN 'crm' ELSE 'hr' END AS current_schema,
  ts
FROM events""",
    # Last execution per thread; overlaps the history on purpose.
    "v_st_current": f"""
SELECT {_ST_COLUMNS} FROM (
  SELECT h.*, row_number() OVER (PARTITION BY instance, thread_id ORDER BY event_id DESC) AS rn
  FROM v_st_history h) x WHERE rn = 1""",
    # Waits; is_current splits current and history.
    "v_waits": f"""
SELECT concat('db', cast(l_suppkey % 4 AS string), ':3306') AS instance, {COLLECTED} AS collected_at,
  l_suppkey AS thread_id,
  {_pick("l_partkey % 11", [
      "wait/io/file/innodb/data", "wait/io/file/aria/log", "wait/io/file/sql/binlog", "wait/io/socket/sql/client",
      "wait/synch/cond/sql/c", "wait/synch/mutex/sql/m", "wait/lock/table/sql/handler", "wait/lock/metadata/sql/mdl",
      "wait/lock/transaction/x", "wait/synch/rwlock/sql/r", "idle"])} AS event_name,
  cast(round(l_extendedprice * 100) AS bigint) * 10000 AS timer_wait, l_returnflag = 'N' AS is_current
FROM lineitem""",
    "v_threads": f"""
SELECT concat('db', cast(c_custkey % 4 AS string), ':3306') AS instance, {COLLECTED} AS collected_at,
  c_custkey AS thread_id,
  CASE WHEN c_custkey % 41 = 0 THEN NULL ELSE c_custkey + 100000 END AS processlist_id,
  concat('app', cast(c_nationkey AS string)) AS processlist_host,
  CASE c_nationkey % 5 WHEN 0 THEN NULL WHEN 1 THEN 'mysql'
    ELSE concat('shop', cast(c_nationkey % 5 AS string)) END AS processlist_db,
  CASE WHEN c_mktsegment = 'BUILDING' THEN NULL ELSE lower(c_mktsegment) END AS processlist_state
FROM customer""",
    # One open transaction per thread, from the latest order of a customer.
    "v_trx": f"""
SELECT concat('db', cast(o_custkey % 4 AS string), ':3306') AS instance, {COLLECTED} AS collected_at,
  concat('T', cast(orderkey AS string)) AS trx_id, o_custkey + 100000 AS trx_mysql_thread_id,
  started AS trx_started, started + INTERVAL '1' SECOND AS trx_wait_started,
  CASE WHEN status = 'F' THEN 'LOCK WAIT' ELSE 'RUNNING' END AS trx_state,
  CASE WHEN orderkey % 3 = 0 THEN 0 ELSE orderkey % 9 END AS trx_rows_modified,
  CASE WHEN orderkey % 10 = 0 THEN NULL
       ELSE concat('UPDATE t SET a = ''it''''s'' WHERE id = ', cast(orderkey AS string)) END AS trx_query
FROM (SELECT o_custkey, max(o_orderkey) AS orderkey, max(o_orderdate) AS started, max(o_orderstatus) AS status
      FROM orders GROUP BY o_custkey) o""",
    # Both threads are on the same instance and never equal.
    "v_lock_waits": f"""
SELECT DISTINCT concat('db', cast(o_custkey % 4 AS string), ':3306') AS instance, {COLLECTED} AS collected_at,
  o_custkey AS requesting_thread_id, o_custkey + 4 * (1 + o_orderkey % 36) AS blocking_thread_id
FROM orders""",
    "v_trx_lock_waits": """
SELECT w.instance, w.collected_at, r.trx_id AS requesting_trx_id, b.trx_id AS blocking_trx_id FROM v_lock_waits w
JOIN v_trx r ON r.instance = w.instance AND r.trx_mysql_thread_id = w.requesting_thread_id + 100000
JOIN v_trx b ON b.instance = w.instance AND b.trx_mysql_thread_id = w.blocking_thread_id + 100000""",
    "v_metadata_locks": f"""
SELECT concat('db', cast(l_orderkey % 4 AS string), ':3306') AS instance, {COLLECTED} AS collected_at,
  CASE WHEN l_linenumber = 7 THEN 'BACKUP' ELSE 'TABLE' END AS object_type,
  CASE WHEN l_linenumber = 7 THEN concat('BACKUP_FTWRL', cast(l_suppkey % 2 + 1 AS string))
       WHEN l_linenumber = 6 THEN 'SHARED_READ' WHEN l_linenumber = 5 THEN 'EXCLUSIVE'
       WHEN l_linenumber = 4 THEN 'SHARED_NO_READ_WRITE' ELSE 'SHARED_WRITE' END AS lock_type,
  CASE WHEN l_linestatus = 'O' THEN 'GRANTED' ELSE 'PENDING' END AS lock_status,
  CASE l_returnflag WHEN 'N' THEN 'EXPLICIT' WHEN 'A' THEN 'TRANSACTION' ELSE 'STATEMENT' END AS lock_duration,
  CASE cast(l_partkey % 4 AS int) WHEN 0 THEN 'sys' WHEN 1 THEN NULL ELSE 'shop' END AS object_schema,
  CASE WHEN l_partkey % 17 = 0 THEN NULL ELSE l_orderkey END AS owner_thread_id
FROM lineitem""",
    "v_processlist": f"""
SELECT concat('db', cast(o_custkey % 4 AS string), ':3306') AS instance, {COLLECTED} AS collected_at,
  o_custkey AS id,
  CASE WHEN o_orderkey % 19 = 0 THEN 'LOCK TABLES t READ' WHEN o_orderkey % 19 = 1 THEN 'UNLOCK TABLES '
       WHEN o_orderkey % 19 = 2 THEN NULL ELSE 'SELECT 1' END AS info
FROM orders""",
    # The four servers of the statement, lock and backup relations.
    "v_nodes": f"""
SELECT instance, {COLLECTED} AS collected_at, flavor, CASE WHEN flavor = 'mysql' THEN '8.0.37' ELSE '10.6.9-MariaDB' END AS version,
  has_metadata_locks FROM (
  SELECT concat('db', cast(c_custkey % 4 AS string), ':3306') AS instance,
    max(CASE WHEN c_custkey % 4 < 2 THEN 'mysql' ELSE 'mariadb' END) AS flavor,
    max(CASE cast(c_custkey % 4 AS int) WHEN 0 THEN true WHEN 1 THEN false WHEN 2 THEN true ELSE NULL END) AS has_metadata_locks
  FROM customer GROUP BY concat('db', cast(c_custkey % 4 AS string), ':3306')) n""",
    # Counter samples: a running counter that wraps at 50000.
    "v_counters": """
SELECT concat('db', cast(user_id % 4 AS string), ':3306') AS instance,
  CASE event_type WHEN 'click' THEN 'Queries' WHEN 'view' THEN 'Connections' WHEN 'signup' THEN 'Bytes_sent'
    WHEN 'purchase' THEN 'Slow_queries' ELSE 'Questions' END AS name,
  ts, event_id,
  cast(sum(cast(round(value * 100) AS bigint)) OVER (PARTITION BY user_id % 4, event_type ORDER BY ts, event_id)
    % 50000 AS bigint) AS value
FROM events""",
    # One server per customer, for version, readiness and entity rules.
    "v_servers": f"""
SELECT concat('host', cast(c_custkey AS string)) AS hostname, 3306 + c_custkey % 3 AS port,
  concat('host', cast(c_custkey AS string), ':', cast(3306 + c_custkey % 3 AS string)) AS instance,
  {COLLECTED} AS collected_at, c_custkey % 5 <> 0 AS is_remote,
  {_pick(f"c_custkey % {len(SERVER_VERSIONS)}", SERVER_VERSIONS)} AS version,
  CASE cast(c_custkey % 7 AS int) WHEN 0 THEN 'OFF' WHEN 1 THEN 'on' WHEN 2 THEN NULL ELSE 'ON' END AS performance_schema
FROM customer""",
    "v_consumers": f"""
SELECT instance, collected_at, name, max(enabled) AS enabled FROM (
  SELECT concat('host', cast(o_custkey AS string), ':', cast(3306 + o_custkey % 3 AS string)) AS instance,
    {COLLECTED} AS collected_at,
    {_pick("o_orderkey % 9", [
        "events_waits_current", "events_waits_history_long", "events_waits_history", "events_statements_history_long",
        "events_statements_history", "events_statements_current", "events_statements_cpu", "global_instrumentation",
        "thread_instrumentation"])} AS name,
    CASE WHEN o_orderkey % 4 = 0 THEN 'NO' WHEN o_orderkey % 4 = 1 THEN 'yes' ELSE 'YES' END AS enabled
  FROM orders) c GROUP BY instance, collected_at, name""",
    "v_instruments": f"""
SELECT concat('host', cast(c_custkey AS string), ':', cast(3306 + c_custkey % 3 AS string)) AS instance,
  {COLLECTED} AS collected_at,
  CASE WHEN c_nationkey % 4 = 0 THEN 'wait/lock/metadata/sql/other' ELSE 'wait/lock/metadata/sql/mdl' END AS name,
  CASE WHEN c_custkey % 3 = 0 THEN 'NO' ELSE 'YES' END AS enabled
FROM customer""",
    # global_status, one name per event, many collections.
    "v_status": f"""
SELECT concat('db', cast(user_id % 8 AS string), ':3306') AS instance,
  cast(date_trunc('day', ts) AS NTZ) + INTERVAL '1' DAY AS collected_at, event_id AS ordinal,
  {_pick(f"event_id % {len(STATUS_NAMES)}", STATUS_NAMES)} AS name,
  CASE WHEN event_id % 41 = 0 THEN NULL WHEN event_id % 43 = 0 THEN 'ON' WHEN event_id % 47 = 0 THEN '0.5'
       WHEN event_id % 31 = 0 THEN '0'
       ELSE cast(extract(day FROM ts) % 10 * 100000 + cast(round(value * 100) AS bigint) AS string) END AS raw
FROM events""",
    "v_variables": f"""
SELECT concat('db', cast(o_custkey % 8 AS string), ':3306') AS instance,
  cast('2024-01-02 00:00:00' AS NTZ) + cast(o_orderkey % 30 AS int) * INTERVAL '1' DAY AS collected_at,
  o_orderkey AS ordinal,
  {_pick("(o_orderkey + o_custkey) % 7", [
      "key_cache_block_size", "key_buffer_size", "version_comment", "version", "performance_schema", "odd_a", "odd_b"])} AS name,
  CASE cast((o_orderkey + o_custkey) % 7 AS int)
    WHEN 0 THEN '1024' WHEN 1 THEN '8388608' WHEN 2 THEN concat('Build ', cast(o_orderkey % 3 AS string))
    WHEN 3 THEN {_pick("o_custkey % 8", NODE_VERSIONS)} WHEN 4 THEN 'ON'
    ELSE {_pick(f"(o_custkey + o_orderkey) % {len(ODD_VALUES)}", ODD_VALUES)} END AS raw
FROM orders""",
    # Replica status: wide, all text; instances db0 to db2 of the status relations are no replicas.
    "v_replica": """
SELECT concat('db', cast(3 + c_custkey % 5 AS string), ':3306') AS instance,
  cast('2024-01-02 00:00:00' AS NTZ) + cast(c_custkey % 30 AS int) * INTERVAL '1' DAY AS collected_at,
  c_custkey AS ordinal,
  CASE WHEN c_custkey % 6 = 0 THEN 'No' ELSE 'Yes' END AS Slave_IO_Running,
  CASE WHEN c_custkey % 7 = 0 THEN 'Connecting' WHEN c_custkey % 11 = 0 THEN '1' ELSE 'Yes' END AS Slave_SQL_Running,
  CASE WHEN c_custkey % 6 = 0 THEN 'No' ELSE 'Yes' END AS Replica_IO_Running,
  CASE WHEN c_custkey % 7 = 0 THEN 'Connecting' ELSE 'Yes' END AS Replica_SQL_Running,
  CASE WHEN c_custkey % 9 = 0 THEN NULL ELSE cast(c_custkey % 100 AS string) END AS Seconds_Behind_Master,
  CASE WHEN c_custkey % 9 = 0 THEN NULL ELSE cast(c_custkey % 100 AS string) END AS Seconds_Behind_Source,
  cast(c_custkey % 3 AS string) AS Last_IO_Errno,
  CASE WHEN c_custkey % 3 = 0 THEN '' ELSE 'io failed' END AS Last_IO_Error,
  cast(c_custkey * 1000 AS string) AS Relay_Log_Space,
  concat('10.0.0.', cast(c_nationkey AS string)) AS Master_Host,
  concat('10.0.0.', cast(c_nationkey AS string)) AS Source_Host
FROM customer""",
    # Collections of the eight instances, their version and the outcome of the replica scan.
    "v_collections": f"""
SELECT instance, collected_at, max(version) AS version, max(replica_scan) AS replica_scan FROM (
  SELECT concat('db', cast(o_custkey % 8 AS string), ':3306') AS instance,
    cast('2024-01-02 00:00:00' AS NTZ) + cast(o_orderkey % 30 AS int) * INTERVAL '1' DAY AS collected_at,
    {_pick("o_custkey % 8", NODE_VERSIONS)} AS version,
    CASE WHEN o_custkey % 8 = 7 THEN 'failed' ELSE 'ok' END AS replica_scan
  FROM orders) x GROUP BY instance, collected_at""",
    # Plan documents. l_linenumber repeats within an order, so lines are merged first.
    "v_lines": """
SELECT l_orderkey, l_linenumber, max(l_partkey) AS partkey, cast(max(l_quantity) AS bigint) AS qty
FROM lineitem GROUP BY l_orderkey, l_linenumber""",
}

# The same counters for Spark: a series may hold a third of all events, so the
# running sum is split by day and only the day totals are summed per series.
_SPARK_COUNTERS = """
SELECT s.instance, s.name, s.ts, s.event_id,
  (coalesce(o.earlier, 0) + sum(s.amount) OVER (PARTITION BY s.instance, s.name, s.day ORDER BY s.ts, s.event_id))
    % 50000 AS value
FROM {steps} s JOIN (
  SELECT instance, name, day, sum(total) OVER (PARTITION BY instance, name ORDER BY day
    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS earlier
  FROM (SELECT instance, name, day, sum(amount) AS total FROM {steps} GROUP BY instance, name, day) d) o
ON o.instance = s.instance AND o.name = s.name AND o.day = s.day""".format(
    steps="""(
  SELECT concat('db', cast(user_id % 4 AS string), ':3306') AS instance,
    CASE event_type WHEN 'click' THEN 'Queries' WHEN 'view' THEN 'Connections' WHEN 'signup' THEN 'Bytes_sent'
      WHEN 'purchase' THEN 'Slow_queries' ELSE 'Questions' END AS name,
    ts, event_id, cast(ts AS date) AS day, cast(round(value * 100) AS bigint) AS amount
  FROM events)"""
)

# The same rows for Spark where the text would sort, hash or shuffle wide rows: what is kept
# is found on the tables' numbers, and the texts are built for that alone.
_SPARK_VIEWS = {
    "v_counters": _SPARK_COUNTERS,
    "v_st_current": f"SELECT {_ST_COLUMNS} FROM ({VIEWS['v_st_history']}) h".replace(
        "FROM events",
        """FROM (SELECT * FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) AS rn
  FROM (SELECT event_id, ts, user_id, event_type, value FROM events) n) x WHERE rn = 1) e""",
    ),
    "v_lock_waits": f"""
SELECT concat('db', cast(waiting % 4 AS string), ':3306') AS instance, {COLLECTED} AS collected_at,
  waiting AS requesting_thread_id, blocking AS blocking_thread_id
FROM (SELECT DISTINCT o_custkey AS waiting, o_custkey + 4 * (1 + o_orderkey % 36) AS blocking FROM orders) w""",
    # All four columns are functions of the two remainders, so a collection is one row already.
    "v_collections": re.search(r"FROM \((.*)\) x", VIEWS["v_collections"], re.S).group(1).replace(
        "FROM orders", "FROM (SELECT DISTINCT o_custkey % 8 AS o_custkey, o_orderkey % 30 AS o_orderkey FROM orders) o"
    ),
}

_DEPENDS = {
    name: [other for other in VIEWS if other != name and re.search(rf"\b{other}\b", text)]
    for name, text in VIEWS.items()
}


def closure(*names: str) -> list[str]:
    """The named views and what they read, in dependency order."""
    ordered: list[str] = []

    def visit(name: str) -> None:
        for other in _DEPENDS[name]:
            visit(other)
        if name not in ordered:
            ordered.append(name)

    for name in names:
        visit(name)
    return ordered


def _referenced(text: str, candidates) -> list[str]:
    return [c for c in candidates if re.search(rf"\b{c}\b", text)]


_RELATIONS: dict[tuple[str, str], dict[str, DataFrame]] = {}


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A sample table or derived relation as a DataFrame.

    Defined once per application and directory: the definition is only a plan,
    no data is held.
    """
    session = spark._jsparkSession.sessionUUID()
    return _defined(spark, sf_dir, name, _RELATIONS.setdefault((session, sf_dir), {}), "tg", lambda _, df: df)


def view_once(
    spark: SparkSession, sf_dir: str, name: str, known: dict[str, DataFrame], once: Callable[[str, DataFrame], DataFrame]
) -> DataFrame:
    """The same, for a caller with relations of its own, ``known``.

    ``once`` is given each derived relation's name and definition when it is first
    asked for, and returns what it and the relations over it are read from.
    """
    return _defined(spark, sf_dir, name, known, "tg_once", once)


def _defined(spark, sf_dir, name, known, label, once) -> DataFrame:
    prefix = f"{label}_" + hashlib.md5(sf_dir.encode()).hexdigest()[:8]
    if name not in known:
        if name in TABLES:
            df = spark.read.parquet(f"{sf_dir}/{name}.parquet")
        else:
            text = _SPARK_VIEWS.get(name, VIEWS[name]).replace("NTZ", "timestamp_ntz")
            for other in _referenced(text, [*VIEWS, *TABLES]):
                if other != name:
                    _defined(spark, sf_dir, other, known, label, once).createOrReplaceTempView(f"{prefix}_{other}")
                    text = re.sub(rf"\b(FROM|JOIN)(\s+){other}\b", rf"\1\2{prefix}_{other}", text)
            df = once(name, spark.sql(text))
        known[name] = df
    return known[name]


def oracle_query(select: str, extra: dict[str, str] | None = None) -> str:
    """``select`` with the views it mentions as CTEs, for the oracle.

    ``extra`` holds further CTEs of the oracle, in dependency order.
    """
    extra = extra or {}
    needed: dict[str, str] = {}
    pending = select
    for name in reversed(list(extra)):
        if re.search(rf"\b{name}\b", pending):
            needed[name] = extra[name]
            pending += " " + extra[name]
    views = closure(*_referenced(pending, VIEWS))
    texts = {v: VIEWS[v].replace("NTZ", "timestamp") for v in views}
    texts.update({name: needed[name].replace("NTZ", "timestamp") for name in extra if name in needed})
    if not texts:
        return select
    ctes = ", ".join(f"{name} AS ({text})" for name, text in texts.items())
    return f"WITH {ctes} {select}"
