"""Schemas of the landed relations and the one function that reads them.

Every landed relation carries ``instance`` (host:port) and ``collected_at``.
Timestamps are the server's wall clock, so they are TIMESTAMP_NTZ; only
``collected_at`` is the collector's own clock and is landed in UTC.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

_LANDED = "instance string, collected_at timestamp_ntz, "

_COLUMNS = {
    "global_variables": "ordinal bigint, name string, value string",
    "global_status": "ordinal bigint, name string, value string",
    "statements_summary_by_digest": (
        "schema_name string, digest string, digest_text string, count_star bigint, sum_cpu_time bigint, "
        "sum_timer_wait bigint, sum_rows_examined bigint, sum_rows_affected bigint, sum_no_index_used bigint, "
        "last_seen timestamp_ntz"
    ),
    "statements": (
        "event_id bigint, thread_id bigint, digest string, digest_text string, sql_text string, timer_wait bigint, "
        "rows_sent bigint, rows_examined bigint, current_schema string"
    ),
    "waits": "thread_id bigint, event_name string, timer_wait bigint",
    "data_lock_waits": "requesting_thread_id bigint, blocking_thread_id bigint",
    "innodb_lock_waits": "requesting_trx_id string, blocking_trx_id string",
    "threads": (
        "thread_id bigint, processlist_id bigint, processlist_host string, processlist_db string, "
        "processlist_state string"
    ),
    "innodb_trx": (
        "trx_id string, trx_mysql_thread_id bigint, trx_started timestamp_ntz, trx_wait_started timestamp_ntz, "
        "trx_query string, trx_state string, trx_rows_modified bigint"
    ),
    "metadata_locks": (
        "object_type string, lock_type string, lock_status string, lock_duration string, object_schema string, "
        "owner_thread_id bigint"
    ),
    "processlist": "id bigint, info string",
    "setup_consumers": "name string, enabled string",
    "setup_instruments": "name string, enabled string",
    "plan_documents": "event_id bigint, thread_id bigint, flavor string, plan_json string",
}

SCHEMAS = {name: _LANDED + columns for name, columns in _COLUMNS.items()}


def scan_relation(
    spark: SparkSession,
    path: str | None,
    schema: str | T.StructType,
    fmt: str = "parquet",
    **options: str,
) -> DataFrame:
    """Read one relation with an explicit schema; nothing is inferred.

    ``fmt`` is parquet, json, orc, csv or jdbc (options ``url``, ``dbtable``,
    ``partitionColumn`` and bounds; JDBC takes its schema as ``customSchema``).
    """
    reader = spark.read.format(fmt).options(**options)
    if fmt == "jdbc":
        return reader.load()
    return reader.schema(schema).load(path)


def scan_landed(spark: SparkSession, root: str, relation: str, fmt: str = "parquet", **options: str) -> DataFrame:
    """A relation of the landing zone, by name."""
    return scan_relation(spark, f"{root}/{relation}", SCHEMAS[relation], fmt, **options)
