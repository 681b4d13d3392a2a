"""Wait events by digest."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidegauge import KEYS, settings
from tidegauge.functions import scalars as S
from tidegauge.operators import filters
from tidegauge.operators.ranking import top_k

SYSTEM = settings.SYSTEM_DATABASES


def union_waits(current: DataFrame, history: DataFrame) -> DataFrame:
    """Both tables, nothing removed: an event in both counts twice."""
    return current.withColumn("source", F.lit(0)).unionByName(history.withColumn("source", F.lit(1)))


def union_statements(current: DataFrame, history: DataFrame, excluded: Sequence[str] = SYSTEM) -> DataFrame:
    """Statements of both tables outside the excluded databases."""
    both = current.unionByName(history)
    return filters.exclude_databases(both, "current_schema", excluded).select(
        *KEYS,
        "thread_id",
        F.col("digest").alias("query_id"),
        F.col("current_schema").alias("database_name"),
        F.col("digest_text").alias("query_text"),
    )


def wait_partial_agg(waits: DataFrame, by: Sequence[str] = ("source",)) -> DataFrame:
    """Total and count per thread and event, per source table.

    Picosecond totals are decimals: a busy thread passes 64 bits.
    """
    return waits.groupBy(*KEYS, *by, "thread_id", F.col("event_name").alias("wait_event_name")).agg(
        F.sum(F.col("timer_wait").cast("decimal(20,0)")).alias("total_wait_time"),
        F.count(F.lit(1)).alias("wait_event_count"),
    )


def wait_join(waits: DataFrame, statements: DataFrame) -> DataFrame:
    """Pre-aggregated waits x statements of the same thread.

    A thread with n statement rows repeats each of its waits n times. Equal
    statements are counted before the join and carried as ``repeats``, so the
    same bag of rows is produced without listing every pair.
    """
    counted = statements.groupBy(*KEYS, "thread_id", "query_id", "database_name", "query_text").agg(
        F.count(F.lit(1)).alias("repeats")
    )
    return waits.join(counted, [*KEYS, "thread_id"])


def wait_events(waits: DataFrame, statements: DataFrame) -> DataFrame:
    """Wait totals per digest, database and event.

    Totals over a joined bag are totals times repeats, and the two wait tables
    only add up, so both sides are reduced before they meet.
    """
    per_thread = wait_partial_agg(waits, by=())
    joined = wait_join(per_thread, statements.filter(F.col("query_id").isNotNull()))
    repeats = F.col("repeats").cast("decimal(18,0)")
    grouped = joined.groupBy(*KEYS, "query_id", "database_name", "wait_event_name", "query_text").agg(
        F.sum(F.col("total_wait_time") * repeats).alias("total"),
        F.sum(F.col("wait_event_count") * repeats).cast("long").alias("count"),
    )
    total, count = F.col("total"), F.col("count")
    return grouped.select(
        *KEYS,
        "query_id",
        "database_name",
        "wait_event_name",
        S.wait_category(F.col("wait_event_name")).alias("wait_category"),
        S.ps_to_ms(total).alias("total_wait_time_ms"),
        count.alias("wait_event_count"),
        S.mean_ps_to_ms_text(total, count).alias("avg_wait_time_ms"),
        S.truncate_text(F.col("query_text")).alias("query_text"),
        S.utc_iso(F.col("collected_at")).alias("collection_timestamp"),
    )


def topk_waits(events: DataFrame, k: int = settings.DEFAULT_TOP_K, ceiling: int | None = settings.MAX_TOP_K) -> DataFrame:
    order = [F.desc("total_wait_time_ms"), *map(F.asc, ("query_id", "database_name", "wait_event_name", "query_text"))]
    return top_k(events, KEYS, order, settings.top_k(k, ceiling))
