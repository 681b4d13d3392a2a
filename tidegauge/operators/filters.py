"""Row predicates. "Now" is always ``collected_at``, never the wall clock."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidegauge import settings


def exclude_databases(df: DataFrame, column: str, names: Sequence[str] = settings.SYSTEM_DATABASES) -> DataFrame:
    """Keep rows whose database is known and not excluded (null is dropped).

    The list is a parameter, so this is a predicate that reaches the scan.
    """
    return df.filter(F.col(column).isNotNull() & ~F.col(column).isin(list(names)))


def lookback_filter(df: DataFrame, last_seen: str, seconds: int = settings.DEFAULT_LOOKBACK_SECONDS) -> DataFrame:
    oldest = F.col("collected_at") - F.make_dt_interval(secs=F.lit(settings.lookback_seconds(seconds)))
    return df.filter(F.col(last_seen) >= oldest)


def min_exec_time(df: DataFrame, milliseconds: int = settings.DEFAULT_MIN_EXECUTION_MS) -> DataFrame:
    """Strictly slower than the threshold, compared in picoseconds."""
    return df.filter(F.col("timer_wait") > F.lit(settings.min_execution_ms(milliseconds) * 1_000_000_000).cast("long"))


def require_db_and_text(df: DataFrame) -> DataFrame:
    """Executions that plan work can use; the others are still reported."""
    return df.filter(F.col("database_name").isNotNull() & F.col("query_sample_text").isNotNull())


def explainable(query_id: Column, text: Column) -> Column:
    """A statement whose plan may be asked for: SELECT or WITH, no placeholder."""
    body = F.upper(F.trim(text, F.lit(" \t\n\r\f\v")))
    supported = body.startswith("SELECT") | body.startswith("WITH")
    return F.coalesce(query_id.isNotNull() & supported & ~text.contains("?"), F.lit(False))


def age_seconds(started: Column, now: Column) -> Column:
    """Whole seconds from ``started`` to ``now``."""
    return F.timestamp_diff("SECOND", started, now)


def long_readonly_trx(df: DataFrame, min_age: int = settings.LONG_TRX_SECONDS) -> DataFrame:
    return df.filter(
        (F.col("trx_state") == "RUNNING")
        & (F.col("trx_rows_modified") == 0)
        & (age_seconds(F.col("trx_started"), F.col("collected_at")) >= min_age)
    )


def backup_statement(text: Column) -> dict[str, Column]:
    """The three statement classes of a backup; one text may be in several."""
    return {
        "logical_backup": text.like("%START TRANSACTION WITH CONSISTENT SNAPSHOT%"),
        "physical_backup": text.like("%FLUSH TABLES%WITH READ LOCK%"),
        "table_lock": text.like("LOCK TABLES %"),
    }


def backup_statement_filter(df: DataFrame, column: str = "sql_text") -> DataFrame:
    classes = backup_statement(F.col(column))
    return df.filter(classes["table_lock"] | classes["physical_backup"] | classes["logical_backup"])
