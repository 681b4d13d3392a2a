"""Slow statements by digest and the individual executions behind them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidegauge import KEYS, settings
from tidegauge.functions import scalars as S
from tidegauge.operators import filters
from tidegauge.operators.ranking import first_per_key, top_k

SYSTEM = settings.SYSTEM_DATABASES


def summary_columns() -> list[Column]:
    """Aggregates of the digest summary, without ``last_seen``.

    Picosecond totals are decimals: a busy digest passes 64 bits.
    """
    totals = {
        "sum_cpu_time": F.col("cpu_time").cast("decimal(20,0)"),
        "sum_timer_wait": F.col("timer_wait").cast("decimal(20,0)"),
        "sum_rows_examined": F.col("rows_examined"),
        "sum_rows_affected": F.col("rows_affected"),
        "sum_no_index_used": F.col("no_index_used"),
    }
    return [F.count(F.lit(1)).alias("count_star"), *[F.sum(column).alias(name) for name, column in totals.items()]]


def digest_rollup(executions: DataFrame) -> DataFrame:
    """Landed executions to the columns of the server's digest summary."""
    keys = [*KEYS, F.col("current_schema").alias("schema_name"), "digest", "digest_text"]
    return executions.groupBy(*keys).agg(*summary_columns(), F.max("ts").alias("last_seen"))


def slow_queries(
    summary: DataFrame,
    lookback: int = settings.DEFAULT_LOOKBACK_SECONDS,
    excluded: Sequence[str] = SYSTEM,
    zone: str = "UTC",
) -> DataFrame:
    """One sample per recently seen digest row.

    ``summary`` may carry ``flavor``; MariaDB rows report no CPU time.
    A null digest stays: it takes a place in the ranking and is dropped after.
    """
    recent = filters.lookback_filter(filters.exclude_databases(summary, "schema_name", excluded), "last_seen", lookback)
    count = F.col("count_star")
    cpu = S.mean_ps_to_ms(F.col("sum_cpu_time"), count)
    if "flavor" in summary.columns:
        cpu = F.when(F.col("flavor") != "mariadb", cpu)
    per_execution = lambda total: F.try_divide(F.col(total).cast("double"), count.cast("double"))
    return recent.select(
        *KEYS,
        F.col("digest").alias("query_id"),
        S.truncate_text(F.col("digest_text")).alias("query_text"),
        F.col("schema_name").alias("database_name"),
        F.lit("N/A").alias("schema_name"),
        count.alias("execution_count"),
        cpu.alias("avg_cpu_time_ms"),
        S.mean_ps_to_ms(F.col("sum_timer_wait"), count).alias("avg_elapsed_time_ms"),
        per_execution("sum_rows_examined").alias("avg_disk_reads"),
        per_execution("sum_rows_affected").alias("avg_disk_writes"),
        S.full_scan_flag(F.col("sum_no_index_used")).alias("has_full_table_scan"),
        S.statement_type(F.col("digest_text")).alias("statement_type"),
        S.utc_iso(F.col("last_seen"), zone).alias("last_execution_timestamp"),
        S.utc_iso(F.col("collected_at")).alias("collection_timestamp"),
    )


def topk_slow(slow: DataFrame, k: int = settings.DEFAULT_TOP_K, ceiling: int | None = settings.MAX_TOP_K) -> DataFrame:
    """Slowest digests per instance and collection, with their rank."""
    order = [F.desc_nulls_last("avg_elapsed_time_ms"), F.asc("query_id"), F.asc("database_name"), F.asc("query_text")]
    return top_k(slow, KEYS, order, settings.top_k(k, ceiling), rank="slow_rank").filter(F.col("query_id").isNotNull())


def _slow_digests(slow: DataFrame) -> DataFrame:
    """One row per slow digest; a digest slow in several schemas keeps its best rank."""
    return slow.groupBy(*KEYS, F.col("query_id").alias("digest")).agg(F.min("slow_rank").alias("slow_rank"))


def slow_semi_join(executions: DataFrame, slow: DataFrame) -> DataFrame:
    """Executions of the slow digests: one join instead of a search per digest."""
    return executions.join(_slow_digests(slow).drop("slow_rank"), [*KEYS, "digest"], "left_semi")


def union_executions(current: DataFrame, history: DataFrame) -> DataFrame:
    """Current first, then history; ``source`` keeps that order (0, 1)."""
    return current.withColumn("source", F.lit(0)).unionByName(history.withColumn("source", F.lit(1)))


def topk_per_digest(
    executions: DataFrame, k: int = settings.DEFAULT_TOP_K, ceiling: int | None = settings.MAX_EXECUTIONS_PER_DIGEST
) -> DataFrame:
    """Slowest executions of each digest, per source table."""
    order = [F.desc_nulls_last("timer_wait"), F.asc("event_id"), F.asc("thread_id")]
    return top_k(executions, [*KEYS, "source", "digest"], order, settings.per_digest_k(k, ceiling))


def dedup_executions(executions: DataFrame) -> DataFrame:
    """First row per (event, thread), in the order the searches append.

    Rows without one of the two ids cannot be compared and are dropped.
    """
    order = [F.asc("source"), F.asc_nulls_last("slow_rank"), F.desc_nulls_last("timer_wait"), F.asc("digest")]
    known = executions.filter(F.col("event_id").isNotNull() & F.col("thread_id").isNotNull())
    return first_per_key(known, [*KEYS, "event_id", "thread_id"], order)


def individual_queries(
    current: DataFrame,
    history: DataFrame,
    slow: DataFrame,
    min_ms: int = settings.DEFAULT_MIN_EXECUTION_MS,
    k: int = settings.DEFAULT_TOP_K,
    ceiling: int | None = settings.MAX_EXECUTIONS_PER_DIGEST,
) -> DataFrame:
    """Executions of the slow digests, deduplicated, with their sample text.

    The slow digests are at most k for each instance and collection, so they
    filter the executions first, and only what is left is ranked.
    """
    wanted = slow_semi_join(filters.min_exec_time(union_executions(current, history), min_ms), slow)
    best = topk_per_digest(wanted, k, ceiling)
    ranked = best.filter(F.col("digest").isNotNull()).join(_slow_digests(slow), [*KEYS, "digest"])
    return dedup_executions(ranked).select(
        *KEYS,
        F.col("digest").alias("query_id"),
        S.truncate_text(F.col("digest_text")).alias("query_text"),
        F.col("sql_text").alias("query_sample_text"),
        "event_id",
        "thread_id",
        S.ps_to_ms(F.col("timer_wait")).alias("execution_time_ms"),
        "rows_sent",
        "rows_examined",
        F.col("current_schema").alias("database_name"),
    )


def drop_sample_text(executions: DataFrame) -> DataFrame:
    """The copy for reporting: raw statement text never leaves."""
    return executions.withColumn("query_sample_text", F.lit(None).cast("string"))


def database_groups(executions: DataFrame) -> DataFrame:
    """Groups that plan work fans out to, with their size.

    The rows themselves stay distributed: ``filters.require_db_and_text`` gives
    them and a partitioned write by database keeps a group together.
    """
    return (
        filters.require_db_and_text(executions)
        .groupBy(*KEYS, "database_name")
        .agg(F.count(F.lit(1)).alias("query_count"), F.countDistinct("query_id").alias("digest_count"))
    )
