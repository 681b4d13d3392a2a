"""Backup activity: what is running now and what the history shows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidegauge import KEYS, settings
from tidegauge.functions import scalars as S
from tidegauge.operators import filters

# Table lock types, durations and schemas of a table-lock backup.
TABLE_LOCK_TYPES = ("SHARED_READ", "SHARED_NO_READ_WRITE", "EXCLUSIVE")
TABLE_LOCK_DURATIONS = ("EXPLICIT", "TRANSACTION")
INTERNAL_SCHEMAS = ("performance_schema", "information_schema", "sys")


def _distinct_where(df: DataFrame, member: str, conditions: dict[str, Column]) -> DataFrame:
    """Distinct members meeting each condition, per instance and collection.

    Two small aggregations (member, then instance) instead of one expanded
    count-distinct: rows are combined before the shuffle and no instance needs
    a set of its members in one task.
    """
    flags = {name: F.max(F.when(cond, 1).otherwise(0)).alias(name) for name, cond in conditions.items()}
    members = df.filter(F.col(member).isNotNull()).groupBy(*KEYS, member).agg(*flags.values())
    return members.groupBy(*KEYS).agg(*[F.sum(name).alias(name) for name in flags])


def _logical(trx: DataFrame) -> DataFrame:
    running = filters.long_readonly_trx(trx)
    return _distinct_where(running, "trx_id", {"logical_backup_active": F.lit(True)})


def _report(collections: DataFrame, *parts: DataFrame) -> DataFrame:
    """One row per collection; a collection without rows reports zeros."""
    out = collections.select(*KEYS).distinct()
    for part in parts:
        out = out.join(part, list(KEYS), "left")
    names = ("logical_backup_active", "physical_backup_active", "table_lock_active")
    columns = {n: F.coalesce(F.col(n), F.lit(0)) if n in out.columns else F.lit(0) for n in names}
    columns = {n: c.cast("long") for n, c in columns.items()}
    total = columns[names[0]] + columns[names[1]] + columns[names[2]]
    return out.select(*KEYS, total.alias("total_backup_active"), *[c.alias(n) for n, c in columns.items()])


def backup_active(collections: DataFrame, metadata_locks: DataFrame, trx: DataFrame) -> DataFrame:
    """Running backups from held metadata locks and long read-only transactions."""
    granted = F.col("lock_status") == "GRANTED"
    physical = (F.col("object_type") == "BACKUP") & F.col("lock_type").like("BACKUP_FTWRL%") & granted
    table = (
        (F.col("object_type") == "TABLE")
        & F.col("lock_type").isin(*TABLE_LOCK_TYPES)
        & granted
        & F.col("lock_duration").isin(*TABLE_LOCK_DURATIONS)
        & ~F.col("object_schema").isin(*INTERNAL_SCHEMAS)
    )
    conditions = {"physical_backup_active": physical, "table_lock_active": table}
    locks = _distinct_where(metadata_locks.filter(physical | table), "owner_thread_id", conditions)
    return _report(collections, locks, _logical(trx))


def backup_active_fallback(collections: DataFrame, processlist: DataFrame, trx: DataFrame) -> DataFrame:
    """For servers without metadata locks: only statements running right now."""
    locking = processlist.filter(filters.backup_statement(F.col("info"))["table_lock"])
    locks = _distinct_where(locking, "id", {"table_lock_active": F.lit(True)})
    return _report(collections, locks, _logical(trx))


def backup_active_auto(
    nodes: DataFrame, metadata_locks: DataFrame, processlist: DataFrame, trx: DataFrame
) -> DataFrame:
    """By capability: ``nodes.has_metadata_locks``; false or unknown falls back."""
    capable = F.coalesce(F.col("has_metadata_locks"), F.lit(False))
    main = backup_active(nodes.filter(capable), metadata_locks, trx)
    return main.unionByName(backup_active_fallback(nodes.filter(~capable), processlist, trx))


def backup_history(collections: DataFrame, history: DataFrame) -> DataFrame:
    """Count, mean and longest duration (seconds) per backup statement class."""
    classes = filters.backup_statement(F.col("sql_text"))
    aggs = []
    for name, cond in classes.items():
        # Exact decimal sums: no overflow, and no dependence on row order.
        timer = F.when(cond, F.col("timer_wait"))
        mean = F.try_divide(F.sum(timer.cast("decimal(20,0)")).cast("double"), F.count(timer).cast("double"))
        aggs += [
            F.sum(F.when(cond, 1).otherwise(0)).cast("long").alias(f"{name}_count"),
            (mean / F.lit(1e12)).alias(f"{name}_avg_duration"),
            S.ps_to_seconds(F.max(timer)).alias(f"{name}_max_duration"),
        ]
    found = filters.backup_statement_filter(history).groupBy(*KEYS).agg(*aggs)
    out = collections.select(*KEYS).distinct().join(found, list(KEYS), "left")
    filled = []
    for name in classes:
        filled.append(F.coalesce(F.col(f"{name}_count"), F.lit(0).cast("long")).alias(f"{name}_count"))
        for stat in ("avg", "max"):
            filled.append(F.coalesce(F.col(f"{name}_{stat}_duration"), F.lit(0.0)).alias(f"{name}_{stat}_duration"))
    counts = [F.coalesce(F.col(f"{name}_count"), F.lit(0).cast("long")) for name in classes]
    return out.select(*KEYS, (counts[0] + counts[1] + counts[2]).alias("total_backup_history"), *filled)


def mdl_instrument_warning(collections: DataFrame, instruments: DataFrame) -> DataFrame:
    """Collections whose metadata-lock instrument is off: active backups read 0."""
    enabled = instruments.filter((F.col("name") == settings.MDL_INSTRUMENT) & (F.col("enabled") == "YES"))
    return collections.select(*KEYS).distinct().join(enabled.select(*KEYS), list(KEYS), "left_anti")
