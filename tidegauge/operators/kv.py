"""Key/value bags: landed status, variables and wide one-row results."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidegauge import KEYS
from tidegauge.functions.typed import typed_value
from tidegauge.operators.ranking import first_per_key


def kv_rows(pairs: DataFrame) -> DataFrame:
    """``name, raw`` rows of a two-column result; the last duplicate wins.

    Needs ``ordinal``, the position in the result. A null value reads as "".
    """
    return _last(pairs.select(*KEYS, "ordinal", "name", F.coalesce("raw", F.lit("")).alias("raw")))


def _last(pairs: DataFrame) -> DataFrame:
    # An aggregate, not a window: duplicates are reduced before the shuffle.
    best = F.max(F.struct("ordinal", "raw")).alias("_last")
    return pairs.groupBy(*KEYS, "name").agg(best).select(*KEYS, "name", F.col("_last.raw").alias("raw"))


def kv_rows_wide(rows: DataFrame, order: str = "ordinal", columns: Sequence[str] | None = None) -> DataFrame:
    """``name, raw`` rows of the first row of any other result; column = name.

    Two value columns make a pair even when there is one row: such a result
    belongs in :func:`kv_rows`.
    """
    columns = [c for c in (columns or rows.columns) if c not in (*KEYS, order)]
    first = first_per_key(rows, KEYS, [F.asc(order)])
    text = first.select(*KEYS, *[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in columns])
    return text.unpivot(list(KEYS), columns, "name", "raw")


def inventory_items(variables: DataFrame) -> DataFrame:
    """Every server variable as a typed item."""
    typed = typed_value(F.col("raw"))
    return kv_rows(variables).withColumn("_t", typed).select(*KEYS, "name", "_t.*")


# Variables the server sample needs next to the status counters.
COPIED_VARIABLES = ("key_cache_block_size", "key_buffer_size", "version_comment", "version")


def metrics_enrich(
    status: DataFrame,
    variables: DataFrame,
    replica: DataFrame | None = None,
    *later: DataFrame,
) -> DataFrame:
    """One bag per collection: status, then replica, variables and ``later``
    bags (``name, raw``) in turn; a later bag overrides an earlier one.

    A copied variable that a collection lacks is simply absent.
    """
    bags = [status.select(*KEYS, "ordinal", "name", F.coalesce("raw", F.lit("")).alias("raw"))]
    bags += [replica.withColumn("ordinal", F.lit(0).cast("long"))] if replica is not None else []
    copied = variables.filter(F.col("name").isin(*COPIED_VARIABLES))
    bags.append(copied.select(*KEYS, "ordinal", "name", F.coalesce("raw", F.lit("")).alias("raw")))
    bags += [bag.withColumn("ordinal", F.lit(0).cast("long")) for bag in later]
    union = None
    for priority, bag in enumerate(bags):
        tagged = bag.withColumn("priority", F.lit(priority))
        union = tagged if union is None else union.unionByName(tagged)
    best = F.max(F.struct("priority", "ordinal", "raw")).alias("_last")
    return union.groupBy(*KEYS, "name").agg(best).select(*KEYS, "name", F.col("_last.raw").alias("raw"))


def bag_of(report: DataFrame) -> DataFrame:
    """A one-row-per-collection report (backups) as a bag."""
    columns = [c for c in report.columns if c not in KEYS]
    text = report.select(*KEYS, *[F.col(c).cast("string").alias(c) for c in columns])
    return text.unpivot(list(KEYS), columns, "name", "raw")


def node_role(collections: DataFrame, replica_rows: DataFrame, scan_outcome: str = "replica_scan") -> DataFrame:
    """``node_type`` from the replica scan: failed gives null, empty gives
    master, any row gives slave."""
    seen = replica_rows.select(*KEYS).distinct().withColumn("_seen", F.lit(True))
    role = F.when(F.col(scan_outcome) != "failed", F.when(F.col("_seen"), "slave").otherwise("master"))
    return collections.join(seen, list(KEYS), "left").withColumn("node_type", role).drop("_seen")
