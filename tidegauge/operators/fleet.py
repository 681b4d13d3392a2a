"""Is each server ready to be monitored?"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidegauge import KEYS, settings
from tidegauge.functions.scalars import db_flavor, version_at_least


def consumer_coverage(consumers: DataFrame) -> DataFrame:
    """Enabled essential consumers per server and whether they are enough."""
    named = F.col("name").isin(*settings.ESSENTIAL_CONSUMERS)
    enabled = F.sum(F.when(named & (F.upper("enabled") == "YES"), 1).otherwise(0)).cast("long")
    counted = consumers.groupBy(*KEYS).agg(enabled.alias("enabled_consumers"))
    return counted.withColumn("ready", F.col("enabled_consumers") >= settings.READY_CONSUMERS)


def monitoring_readiness(servers: DataFrame, coverage: DataFrame) -> DataFrame:
    """``status`` ok, warning or unsupported, with the first reason that holds.

    Missing consumers only warn; a server without consumer rows counts as 0.
    """
    version, flavor = F.col("version"), F.col("flavor")
    joined = servers.withColumn("flavor", db_flavor(version)).join(coverage, list(KEYS), "left")
    supported = F.when(flavor == "mysql", version_at_least(version, 8)).otherwise(version_at_least(version, 10, 2))
    reason = (
        F.when(F.coalesce(version, F.lit("")) == "", "version unknown")
        .when(~supported & (flavor == "mysql"), "only MySQL 8.0+ is supported")
        .when(~supported, "only MariaDB 10.2+ is supported")
        .when(F.col("performance_schema").isNull(), "performance schema status unknown")
        .when(F.col("performance_schema") != "ON", "performance schema is not enabled")
        .when(~F.coalesce(F.col("ready"), F.lit(False)), "essential consumers are not enabled")
    )
    status = (
        F.when(F.col("reason").isNull(), "ok")
        .when(F.col("reason").startswith("essential"), "warning")
        .otherwise("unsupported")
    )
    return (
        joined.withColumn("reason", reason)
        .withColumn("status", status)
        .select(*KEYS, "flavor", F.coalesce("enabled_consumers", F.lit(0).cast("long")).alias("enabled_consumers"), "status", "reason")
    )
