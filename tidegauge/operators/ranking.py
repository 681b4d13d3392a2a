"""Top-k, first-wins dedup and numbering, all safe with a hot group."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def top_k(df: DataFrame, group: Sequence[str], order: Sequence[Column], k: int, rank: str | None = None) -> DataFrame:
    """The first ``k`` rows of each group.

    ``row_number() <= k`` lets Spark cut every input partition to k rows per
    group before the shuffle, so a group with a third of all rows stays cheap.
    """
    ranked = df.withColumn("_rank", F.row_number().over(W.partitionBy(*group).orderBy(*order)))
    kept = ranked.filter(F.col("_rank") <= k)
    return kept.withColumnRenamed("_rank", rank) if rank else kept.drop("_rank")


def may_be_top_k(df: DataFrame, group: Sequence[str], order: Sequence[Column], k: int) -> DataFrame:
    """The rows that can be among the first ``k`` of their group by ``order`` and whatever decides after it: ties stay."""
    ranked = df.withColumn("_rank", F.rank().over(W.partitionBy(*group).orderBy(*order)))
    return ranked.filter(F.col("_rank") <= k).drop("_rank")


def first_per_key(df: DataFrame, key: Sequence[str], order: Sequence[Column]) -> DataFrame:
    return top_k(df, key, order, 1)


def numbered(df: DataFrame, group: Sequence[str], order: Sequence[Column], bucket: Column, name: str) -> DataFrame:
    """0-based position of each row in its group, without one task per group.

    ``bucket`` must not decrease along ``order``. Rows are numbered inside
    (group, bucket); only the bucket counts are summed per group. Null is a group
    of its own.
    """
    rows = df.withColumn("_bucket", bucket)
    cells = [*group, "_bucket"]
    counts = rows.groupBy(*cells).agg(F.count(F.lit(1)).alias("_rows"))
    before = W.partitionBy(*group).orderBy("_bucket").rowsBetween(W.unboundedPreceding, -1)
    offsets = counts.select(*cells, F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_offset"))
    inside = F.row_number().over(W.partitionBy(*cells).orderBy(*order))
    position = (F.col("_offset") + inside - 1).cast("long")
    other = offsets.select(*[F.col(c).alias(f"_{c}_of") for c in cells], "_offset")
    same = [rows[c].eqNullSafe(other[f"_{c}_of"]) for c in cells]
    joined = rows.join(other, reduce(and_, same)).drop(*[f"_{c}_of" for c in cells])
    return joined.withColumn(name, position).drop("_bucket", "_offset")
