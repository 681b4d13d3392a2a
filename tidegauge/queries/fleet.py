"""Backups, readiness, scalar rules and samples on their way out."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tidegauge.functions import scalars as S
from tidegauge.functions.typed import typed_value
from tidegauge.operators import backup as BK
from tidegauge.operators import filters, fleet
from tidegauge.operators import metrics as M
from tidegauge.operators import samples as SM
from tidegauge.operators.catalog import METRICS
from tidegauge.operators.contract import contract_rows, sample_contract
from tidegauge.queries import metrics as MQ
from tidegauge.queries import plans as PQ
from tidegauge.queries import statements as Q
from tidegauge.queries.oracle_metrics import BACKUP_CTES, METRICS_CTES, as_int, older, sample_columns, sanitized, typed
from tidegauge.queries.oracle_text import (
    STATEMENTS,
    anonymized,
    iso,
    ms,
    statement_type,
    truncated,
    wait_category,
)
from tidegauge.queries.registry import query, written
from tidegauge.session import shared_dir
from tidegauge.sources import sinks
from tidegauge.sources.relations import scan_relation
from tidegauge.streaming.jobs import run_available

# --- backups ------------------------------------------------------------


@query("backup_active", "SELECT * FROM o_backup_main", BACKUP_CTES)
def backup_active(t):
    return BK.backup_active(t.v_nodes, t.v_metadata_locks, t.v_trx)


@query("backup_active_fallback", "SELECT * FROM o_backup_fallback", BACKUP_CTES)
def backup_active_fallback(t):
    return BK.backup_active_fallback(t.v_nodes, t.v_processlist, t.v_trx)


@query("backup_active_auto", "SELECT * FROM o_backup_auto", BACKUP_CTES)
def backup_active_auto(t):
    return BK.backup_active_auto(t.v_nodes, t.v_metadata_locks, t.v_processlist, t.v_trx)


@query("backup_history", "SELECT * FROM o_backup_history", BACKUP_CTES)
def backup_history(t):
    return BK.backup_history(t.v_nodes, t.v_st_history)


@query(
    "long_readonly_trx",
    """SELECT instance, trx_id, trx_started FROM v_trx WHERE trx_state = 'RUNNING' AND trx_rows_modified = 0
    AND date_sub('second', trx_started, collected_at) >= 30""",
)
def long_readonly_trx(t):
    return filters.long_readonly_trx(t.v_trx).select("instance", "trx_id", "trx_started")


@query(
    "backup_statement_filter",
    """SELECT instance, event_id, sql_text FROM v_st_history WHERE sql_text LIKE 'LOCK TABLES %'
    OR sql_text LIKE '%FLUSH TABLES%WITH READ LOCK%' OR sql_text LIKE '%START TRANSACTION WITH CONSISTENT SNAPSHOT%'""",
)
def backup_statement_filter(t):
    return filters.backup_statement_filter(t.v_st_history).select("instance", "event_id", "sql_text")


@query(
    "mdl_instrument_warning",
    """SELECT DISTINCT s.instance, s.collected_at FROM v_servers s WHERE NOT EXISTS (SELECT 1 FROM v_instruments i
    WHERE i.instance = s.instance AND i.name = 'wait/lock/metadata/sql/mdl' AND i.enabled = 'YES')""",
)
def mdl_instrument_warning(t):
    return BK.mdl_instrument_warning(t.v_servers, t.v_instruments)


# --- readiness ----------------------------------------------------------

# Consumers that statement and wait monitoring needs.
_ESSENTIAL = (
    "('events_waits_current', 'events_waits_history_long', 'events_waits_history', 'events_statements_history_long', "
    "'events_statements_history', 'events_statements_current', 'events_statements_cpu')"
)
_COVERAGE = {
    "o_coverage": f"""
SELECT instance, collected_at, count(*) FILTER (name IN {_ESSENTIAL} AND upper(enabled) = 'YES') AS enabled_consumers,
  count(*) FILTER (name IN {_ESSENTIAL} AND upper(enabled) = 'YES') >= 5 AS ready
FROM v_consumers GROUP BY instance, collected_at""",
}


@query("consumer_coverage", "SELECT * FROM o_coverage", _COVERAGE)
def consumer_coverage(t):
    return fleet.consumer_coverage(t.v_consumers)


_MAJOR = as_int("split_part(version, '.', 1)")
_MINOR = as_int("split_part(split_part(version, '.', 2), '-', 1)")


@query(
    "monitoring_readiness",
    f"""SELECT instance, collected_at, flavor, enabled_consumers,
      CASE WHEN reason IS NULL THEN 'ok' WHEN reason LIKE 'essential%' THEN 'warning' ELSE 'unsupported' END AS status, reason
    FROM (SELECT *, CASE WHEN version = '' THEN 'version unknown'
        WHEN flavor = 'mysql' AND NOT (dotted AND coalesce(major >= 8, false)) THEN 'only MySQL 8.0+ is supported'
        WHEN flavor = 'mariadb' AND NOT (dotted AND coalesce(minor IS NOT NULL AND (major > 10 OR (major = 10 AND minor >= 2)), false))
          THEN 'only MariaDB 10.2+ is supported'
        WHEN performance_schema IS NULL THEN 'performance schema status unknown'
        WHEN performance_schema <> 'ON' THEN 'performance schema is not enabled'
        WHEN NOT coalesce(ready, false) THEN 'essential consumers are not enabled' END AS reason
      FROM (SELECT s.instance, s.collected_at, s.version, s.performance_schema, c.ready,
          coalesce(c.enabled_consumers, 0) AS enabled_consumers, version LIKE '%.%' AS dotted, {_MAJOR} AS major, {_MINOR} AS minor,
          CASE WHEN lower(version) LIKE '%maria%' THEN 'mariadb' ELSE 'mysql' END AS flavor
        FROM v_servers s LEFT JOIN o_coverage c ON c.instance = s.instance))""",
    _COVERAGE,
)
def monitoring_readiness(t):
    return fleet.monitoring_readiness(t.v_servers, fleet.consumer_coverage(t.v_consumers))


# --- scalar rules -------------------------------------------------------


@query("typed_value", f"SELECT instance, ordinal, {typed('raw')} FROM v_variables")
def typed_values(t):
    return t.v_variables.select("instance", "ordinal", typed_value(F.col("raw")).alias("t")).select("instance", "ordinal", "t.*")


@query("truncate_text", f"SELECT doc_id, {truncated('text')} AS query_text FROM documents")
def truncate_text(t):
    return t.table("documents").select("doc_id", S.truncate_text(F.col("text")).alias("query_text"))


@query("statement_type", f"SELECT instance, event_id, {statement_type('digest_text')} AS statement_type FROM v_st_history")
def statement_types(t):
    return t.v_st_history.select("instance", "event_id", S.statement_type(F.col("digest_text")).alias("statement_type"))


@query(
    "wait_category",
    f"""SELECT instance, thread_id, event_name, {wait_category("event_name")} AS wait_category, timer_wait FROM v_waits""",
)
def wait_categories(t):
    category = S.wait_category(F.col("event_name")).alias("wait_category")
    return t.v_waits.select("instance", "thread_id", "event_name", category, "timer_wait")


@query(
    "full_scan_flag",
    """SELECT instance, schema_name, digest, CASE WHEN nullif(sum_no_index_used, 1) > 0 THEN 'Yes' ELSE 'No' END AS has_full_table_scan
    FROM o_summary""",
    STATEMENTS,
)
def full_scan_flag(t):
    used = F.nullif(F.col("sum_no_index_used"), F.lit(1).cast("long"))
    return Q.summary(t).select("instance", "schema_name", "digest", S.full_scan_flag(used).alias("has_full_table_scan"))


@query(
    "timer_units",
    f"""SELECT instance, event_id, {ms("timer_wait")} AS ms, timer_wait::double / 1e12 AS seconds,
      (timer_wait // 1000000)::double / 1000 AS us_as_ms FROM v_st_history""",
)
def timer_units(t):
    timer = F.col("timer_wait")
    return t.v_st_history.select(
        "instance",
        "event_id",
        S.ps_to_ms(timer).alias("ms"),
        S.ps_to_seconds(timer).alias("seconds"),
        S.us_to_ms(S.whole_div(timer, 1_000_000)).alias("us_as_ms"),
    )


@query(
    "utc_iso",
    f"""SELECT event_id, {iso('''ts - CASE CAST(user_id % 3 AS integer) WHEN 0 THEN INTERVAL 0 MINUTE
      WHEN 1 THEN INTERVAL 330 MINUTE ELSE INTERVAL (-180) MINUTE END''')} AS utc FROM events""",
)
def utc_iso(t):
    zone = F.when(F.col("user_id") % 3 == 0, "+00:00").when(F.col("user_id") % 3 == 1, "+05:30").otherwise("-03:00")
    return t.table("events").select("event_id", S.utc_iso(F.col("ts"), zone).alias("utc"))


_TEXTS = (
    "SELECT 'statement' AS kind, cast(event_id AS {s}) AS id, sql_text AS text FROM {p}v_st_history UNION ALL "
    "SELECT 'transaction', trx_id, trx_query FROM {p}v_trx UNION ALL "
    "SELECT 'document', cast(doc_id AS {s}), text FROM {p}documents UNION ALL "
    "SELECT 'page', cast(page_id AS {s}), html FROM {p}pages"
)
_ORACLE_TEXTS = {"o_texts": _TEXTS.format(s="varchar", p="")}


def texts(t):
    out = None
    for kind, df, key, text in (
        ("statement", t.v_st_history, "event_id", "sql_text"),
        ("transaction", t.v_trx, "trx_id", "trx_query"),
        ("document", t.table("documents"), "doc_id", "text"),
        ("page", t.table("pages"), "page_id", "html"),
    ):
        part = df.select(F.lit(kind).alias("kind"), F.col(key).cast("string").alias("id"), F.col(text).alias("text"))
        out = part if out is None else out.unionByName(part)
    return out


@query("anonymize_sql", f"SELECT kind, id, {anonymized('text')} AS anonymized FROM o_texts", _ORACLE_TEXTS)
def anonymize_sql(t):
    return texts(t).select("kind", "id", S.anonymize_sql(F.col("text")).alias("anonymized"))


@query(
    "escape_json_strings",
    r"""SELECT kind, id, replace(replace(replace(text, '\', '\\'), '"', '\"'), '`', '\`') AS escaped FROM o_texts""",
    _ORACLE_TEXTS,
)
def escape_json_strings(t):
    return texts(t).select("kind", "id", S.escape_json_strings(F.col("text")).alias("escaped"))


@query(
    "entity_tags",
    """SELECT instance, CASE WHEN is_remote THEN concat(hostname, ':', port) END AS entity_name,
      CASE WHEN is_remote THEN 'node' END AS entity_type, CASE WHEN is_remote THEN hostname END AS hostname,
      port::varchar AS port FROM v_servers""",
)
def entity_tags(t):
    return SM.entity_tags(t.v_servers).select("instance", "entity_name", "entity_type", "hostname", "port")


@query("db_flavor", "SELECT instance, version, CASE WHEN version ILIKE '%maria%' THEN 'mariadb' ELSE 'mysql' END AS flavor FROM v_servers")
def db_flavor(t):
    return t.v_servers.select("instance", "version", S.db_flavor(F.col("version")).alias("flavor"))


@query("sanitize_version", f"SELECT instance, version, {sanitized('version')} AS sanitized FROM v_servers")
def sanitize_version(t):
    return t.v_servers.select("instance", "version", S.sanitize_version(F.col("version")).alias("sanitized"))


@query("version_lt", f"SELECT instance, version, {older('version', 8)} AS below_8, {older('version', 8, 4)} AS below_8_4 FROM v_servers")
def version_lt(t):
    version = F.col("version")
    return t.v_servers.select(
        "instance", "version", S.version_lt(version, 8).alias("below_8"), S.version_lt(version, 8, 4).alias("below_8_4")
    )


# --- sources and sinks --------------------------------------------------

_EVENTS = "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string"


@query("scan_relation", "SELECT event_id, ts, user_id, event_type, value FROM events WHERE event_type <> 'view'")
def scan(t):
    events = scan_relation(t.spark, f"{t.sf_dir}/events.parquet", _EVENTS)
    return events.filter("event_type <> 'view'").select("event_id", "ts", "user_id", "event_type", "value")


_SLOW_SOURCES = {
    "execution_count": "gauge",
    "avg_cpu_time_ms": "gauge",
    "avg_elapsed_time_ms": "gauge",
    "avg_disk_reads": "other",
    "query_text": "attribute",
    "statement_type": "attribute",
    "last_execution_timestamp": "attribute",
}


@query(
    "record_to_metrics",
    "SELECT * FROM ("
    + " UNION ALL ".join(
        f"SELECT instance, query_id, database_name, '{n}' AS metric, '{'attribute' if k == 'attribute' else 'gauge'}' AS source_type, "
        f"{'NULL' if k == 'attribute' else n}::double AS value, {n if k == 'attribute' else 'NULL'}::varchar AS text FROM o_slow"
        for n, k in _SLOW_SOURCES.items()
    )
    + ") WHERE value IS NOT NULL OR text IS NOT NULL",
    STATEMENTS,
)
def record_to_metrics(t):
    return SM.record_to_metrics(Q.slow(t), _SLOW_SOURCES, ("instance", "query_id", "database_name"))


# What identifies a sample of each event type that is not an execution's.
_SAMPLE_KEYS = {
    SM.SLOW_QUERIES_SAMPLE: ("query_id", "database_name"),
    SM.BLOCKING_SESSION_SAMPLE: ("blocked_txn_id", "blocking_txn_id", "blocked_pid", "blocking_pid"),
    SM.SERVER_SAMPLE: ("instance",),
    SM.QUERY_EXECUTION_SAMPLE: ("event_id", "thread_id", "step_id"),
}


def _publish_sql() -> str:
    history = f"""SELECT instance, collected_at, CASE WHEN digest IS NULL THEN '{SM.WAIT_EVENTS_SAMPLE}' ELSE '{SM.INDIVIDUAL_QUERIES_SAMPLE}' END AS event_type,
      concat_ws('|', event_id::varchar, thread_id::varchar) AS sample_key FROM v_st_history WHERE sql_text IS NOT NULL"""
    others = [
        f"SELECT instance, collected_at, '{event}', concat_ws('|', {', '.join(f'{k}::varchar' for k in keys)}) FROM {_EMITTED[event]}"
        for event, keys in _SAMPLE_KEYS.items()
    ]
    return f"""SELECT instance, event_type, sample_key, (row_number() OVER (PARTITION BY instance, collected_at, event_type ORDER BY md5(sample_key)) - 1) // 601
      AS batch_id FROM ({" UNION ALL ".join([history, *others])})"""


def publish_batches(t):
    """All six event types: those of executions from the whole history, the others as they are emitted."""
    kind = F.when(F.col("digest").isNull(), SM.WAIT_EVENTS_SAMPLE).otherwise(SM.INDIVIDUAL_QUERIES_SAMPLE)
    key = lambda names: F.concat_ws("|", *[F.col(n).cast("string") for n in names]).alias("sample_key")
    parts = t.v_st_history.select("instance", "collected_at", kind.alias("event_type"), key(("event_id", "thread_id")), F.col("sql_text").alias("model"))
    own, found = samples(t), None
    for event, names in _SAMPLE_KEYS.items():
        part = own[event].select("instance", "collected_at", F.lit(event).alias("event_type"), key(names), F.lit("").alias("model"))
        found = part if found is None else found.union(part)
    # Numbering reads its rows twice.
    parts = parts.union(written(t).once("sample_keys", lambda: found))
    batched = SM.publish_batches(parts, ("sample_key",), model=F.col("model"))
    return batched.select("instance", "event_type", "sample_key", "batch_id")


def samples(t):
    """The samples of all six event types, without host and port.

    They share steps: the digest summary, the reported executions, the current
    statements, the bag of metrics. Each is written once.
    """
    t = written(t)
    return {
        SM.SLOW_QUERIES_SAMPLE: Q.slow_queries(t),
        SM.INDIVIDUAL_QUERIES_SAMPLE: Q.individual_queries(t),
        SM.WAIT_EVENTS_SAMPLE: Q.wait_events(t),
        SM.BLOCKING_SESSION_SAMPLE: Q.blocking_sessions(t),
        SM.SERVER_SAMPLE: M.under_metric_names(MQ.server_sample(t)),
        SM.QUERY_EXECUTION_SAMPLE: PQ.plan_samples(t),
    }


def payloads(own):
    """Samples by event type as JSON payloads."""
    out = None
    for event, df in own.items():
        part = sinks.payload(SM.split_instance(df), event)
        out = part if out is None else out.unionByName(part)
    return out


def shapes(own):
    """The fields of each event type's payload."""
    out = {}
    for event, df in own.items():
        given = SM.split_instance(df).schema
        out[event] = StructType([f for f in given if f.name not in ("instance", "collected_at")])
    return out


# event type, oracle relation
_EMITTED = {
    SM.SLOW_QUERIES_SAMPLE: "(SELECT * FROM o_slow WHERE query_id IS NOT NULL)",
    SM.INDIVIDUAL_QUERIES_SAMPLE: "(SELECT * EXCLUDE (query_sample_text) FROM o_individual)",
    SM.WAIT_EVENTS_SAMPLE: "o_wait_events",
    SM.BLOCKING_SESSION_SAMPLE: "o_blocking",
    SM.SERVER_SAMPLE: f"(SELECT instance, collected_at, {sample_columns()} FROM o_sample GROUP BY instance, collected_at)",
    SM.QUERY_EXECUTION_SAMPLE: "o_plan_samples",
}
_BLOCKING = {
    **METRICS_CTES,
    **PQ.PLAN_SAMPLES,
    "o_blocking": Q.BLOCKING_SQL,
}


query("publish_batches", _publish_sql(), _BLOCKING)(publish_batches)

# Whole payloads, every field of every type.
_PAYLOADS = " UNION ALL BY NAME ".join(
    f"SELECT '{event}' AS event_type, *, split_part(instance, ':', 1) AS hostname, split_part(instance, ':', 2) AS port FROM {relation}"
    for event, relation in _EMITTED.items()
)


@query("emit_samples", _PAYLOADS, _BLOCKING)
def emit_samples(t):
    path, own = shared_dir(t.spark, "samples"), samples(t)
    sinks.emit_samples(payloads(own), path)
    written = scan_relation(t.spark, path, "event_type string, instance string, collected_at timestamp_ntz, payload string")
    return sinks.read_payloads(written, shapes(own))


@query("emit_stream", _PAYLOADS, _BLOCKING)
def emit_stream(t):
    """The samples arrive in three folders, one after another, and leave in three micro-batches."""
    path, own = shared_dir(t.spark, "sample-stream"), samples(t)
    arriving = payloads(own).withColumn("turn", F.pmod(F.xxhash64("payload"), F.lit(3)))
    arriving.write.partitionBy("turn").parquet(f"{path}-landed")
    landed = t.spark.read.parquet(f"{path}-landed")
    stream = t.spark.readStream.schema(landed.drop("turn").schema)
    for turn in range(3):
        landed.filter(F.col("turn") == turn).drop("turn").write.parquet(f"{path}-arrived/turn={turn}")
        run_available(sinks.emit_stream(stream.parquet(f"{path}-arrived/turn=*").drop("turn"), path, f"{path}-checkpoint"))
    return sinks.read_payloads(sinks.emitted(t.spark, path), shapes(own))


def misprinted(payloads):
    """Payloads of which some have a field of a wrong kind: a text for a number, a blank in a date, a negative id."""
    number = lambda key: F.get_json_object("payload", f"$.{key}").cast("long")
    put = lambda pattern, text: F.regexp_replace("payload", pattern, text)
    individual, step, slow = SM.INDIVIDUAL_QUERIES_SAMPLE, SM.QUERY_EXECUTION_SAMPLE, SM.SLOW_QUERIES_SAMPLE
    changed = (
        F.when((F.col("event_type") == individual) & (number("event_id") % 10 == 3), put(r'"rows_sent":(-?\d+)', '"rows_sent":"$1"'))
        .when((F.col("event_type") == step) & (number("step_id") == 1), put(r'"thread_id":(\d)', '"thread_id":-$1'))
        .when((F.col("event_type") == slow) & (number("execution_count") % 10 == 1), put(r'"collection_timestamp":"([^"T]*)T', '"collection_timestamp":"$1 '))
    )
    return payloads.withColumn("payload", F.coalesce(changed, F.col("payload")))


# What `misprinted` does, in the relations' terms.
_MISPRINTED = {
    (SM.INDIVIDUAL_QUERIES_SAMPLE, "rows_sent"): "event_id % 10 = 3 AND rows_sent IS NOT NULL",
    (SM.QUERY_EXECUTION_SAMPLE, "thread_id"): "step_id = 1 AND thread_id > 0",
    (SM.SLOW_QUERIES_SAMPLE, "collection_timestamp"): "execution_count % 10 = 1",
}


def _contract_sql() -> str:
    """Counts straight from the relations: their columns are typed, so besides missing
    and empty values only the misprinted ones can occur."""
    relation_columns = {
        SM.SLOW_QUERIES_SAMPLE: "avg_cpu_time_ms avg_disk_reads avg_disk_writes avg_elapsed_time_ms collection_timestamp database_name "
        "execution_count has_full_table_scan last_execution_timestamp query_id query_text schema_name statement_type",
        SM.INDIVIDUAL_QUERIES_SAMPLE: "database_name event_id execution_time_ms query_id query_text rows_examined rows_sent thread_id",
        SM.WAIT_EVENTS_SAMPLE: "avg_wait_time_ms collection_timestamp database_name query_id query_text total_wait_time_ms "
        "wait_category wait_event_count wait_event_name",
        SM.BLOCKING_SESSION_SAMPLE: "blocked_host blocked_pid blocked_query blocked_query_id blocked_query_time_ms blocked_status "
        "blocked_thread_id blocked_txn_id blocked_txn_start_time blocking_host blocking_pid blocking_query blocking_query_id "
        "blocking_query_time_ms blocking_status blocking_thread_id blocking_txn_id blocking_txn_start_time collection_timestamp "
        "database_name",
        SM.QUERY_EXECUTION_SAMPLE: "access_type data_read_per_join eval_cost event_id filtered key key_length possible_keys prefix_cost "
        "query_cost read_cost ref rows_examined_per_scan rows_produced_per_join step_id table_name thread_id used_key_parts using_index",
    }
    # A published metric goes by its own name, a column of the sample by one without dots.
    of_metric = {m.metric: m.column for m in METRICS}
    parts = []
    for event, field, kind, required, non_empty in contract_rows():
        if event not in _EMITTED:
            continue
        own = of_metric if event == SM.SERVER_SAMPLE else {c: c for c in relation_columns[event].split()}
        value = own.get(field, "'x'" if field in ("event_type", "port", "hostname") else "NULL")
        # JSON has no number for what isn't finite: such a value is written as a text.
        odd = f"count(*) FILTER (NOT isfinite({value}))" if event == SM.SERVER_SAMPLE and kind == "number" and field in own else "0::bigint"
        if (event, field) in _MISPRINTED:
            odd = f"count(*) FILTER ({_MISPRINTED[event, field]})"
        lacks = f"{value} IS NULL"
        if field == "avg_cpu_time_ms":
            lacks += " AND instance NOT IN (SELECT instance FROM v_nodes WHERE flavor = 'mariadb')"
        missing = f"count(*) FILTER ({lacks})" if required else "0::bigint"
        empty = f"count(*) FILTER ({value}::varchar = '')" if non_empty else "0::bigint"
        parts.append(
            f"SELECT '{event}' AS event_type, '{field}' AS field, '{kind}' AS kind, {str(required).lower()} AS required, "
            f"count(*) AS samples, {missing} AS missing, {odd} AS wrong_type, {empty} AS empty FROM {_EMITTED[event]}"
        )
    return " UNION ALL ".join(parts)


@query("sample_contract", _contract_sql(), _BLOCKING)
def contract(t):
    # The samples as they are emitted, each type a folder that its counts read.
    path = shared_dir(t.spark, "contract-samples")
    sinks.emit_samples(misprinted(payloads(samples(t))), path)
    written = scan_relation(t.spark, path, "event_type string, instance string, payload string")
    flavors = F.broadcast(t.v_nodes.select("instance", "flavor"))  # one row for each server
    return sample_contract(written.join(flavors, "instance", "left"))
