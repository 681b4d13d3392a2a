"""Approximate nearest neighbours by cross-polytope hashing.

Unit vectors are turned by a pseudo-rotation, three rounds of random signs and a
fast Hadamard transform, and go to the nearest of the signed axes. A table's
bucket is the axes of `hashes` rotations. Queries also look into the next best
buckets of each table, and every candidate is ranked by its exact distance.

Equal vectors are one class of which the smallest ids suffice, so a vector that
a third of all rows hold is one row. Large buckets are split by a hash and their
queries are sent to every part. Distances stay within a part's task: only the
nearest of each part go on.

With n vectors the number of buckets should grow too: one hash suits some
millions of vectors, two some hundred millions (2 * dimension buckets each).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import checkpointed

PART_ROWS = 4_096
FOUND = "cls long, vec_id long, score double"


def hadamard(x: np.ndarray) -> np.ndarray:
    """The orthonormal Hadamard transform of rows whose length is a power of two."""
    n = x.shape[1]
    h = 1
    while h < n:
        x = x.reshape(-1, n // (2 * h), 2, h)
        x = np.stack([x[:, :, 0] + x[:, :, 1], x[:, :, 0] - x[:, :, 1]], 2).reshape(-1, n)
        h *= 2
    return x / np.sqrt(n)


def rotations(units: np.ndarray, table: int, hashes: int) -> list[np.ndarray]:
    """The pseudo-rotated rows for each hash of a table; rows are padded to a power of two."""
    size = 1 << max(0, units.shape[1] - 1).bit_length()
    padded = np.zeros((len(units), size))
    padded[:, : units.shape[1]] = units
    out = []
    for k in range(hashes):
        signs = np.random.default_rng([971, table, k, size]).choice([-1.0, 1.0], (3, size))
        turned = padded
        for s in signs:
            turned = hadamard(turned * s)
        out.append(turned)
    return out


def buckets(units: np.ndarray, table: int, hashes: int, probes: int) -> np.ndarray:
    """The best `probes` buckets of every row in a table, best first."""
    codes = np.zeros((len(units), 1), np.int64)
    loss = np.zeros((len(units), 1))
    for turned in rotations(units, table, hashes):
        reach = np.concatenate([turned, -turned], 1)
        first = np.argsort(-reach, 1, kind="stable")[:, :probes]
        missed = reach.max(1, keepdims=True) - np.take_along_axis(reach, first, 1)
        codes = (codes[:, :, None] * reach.shape[1] + first[:, None, :]).reshape(len(units), -1)
        loss = (loss[:, :, None] + missed[:, None, :]).reshape(len(units), -1)
        best = np.argsort(loss, 1, kind="stable")[:, :probes]
        codes, loss = np.take_along_axis(codes, best, 1), np.take_along_axis(loss, best, 1)
    return codes


def _matrix(column: pa.ListArray) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(column), -1)


def _hashed(rows: DataFrame, tables: range, hashes: int, probes: int) -> DataFrame:
    """Rows (cls, dim, ...) with their buckets: one row for each table and probe. Batches hold vectors of mixed lengths."""
    schema = T.StructType([*rows.schema.fields, T.StructField("tab", T.IntegerType()), T.StructField("bucket", T.LongType())])

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            dims = batch.column("dim").to_numpy()
            for dim in np.unique(dims):
                own = batch.filter(pa.array(dims == dim))
                for start in range(0, own.num_rows, 2_000):
                    part = own.slice(start, 2_000)
                    vectors = _matrix(part.column("embedding"))
                    largest = np.abs(vectors).max(1, keepdims=True)  # first, so that no square overflows
                    vectors = vectors / largest
                    units = vectors / np.sqrt((vectors**2).sum(1, keepdims=True))
                    for table in tables:
                        codes = buckets(units, table, hashes, probes)
                        again = part.take(pa.array(np.repeat(np.arange(part.num_rows), codes.shape[1])))
                        yield pa.RecordBatch.from_arrays([*again.columns, pa.array(np.full(codes.size, table, np.int32)), pa.array(codes.ravel())], names=[*again.schema.names, "tab", "bucket"])

    return rows.mapInArrow(assign, schema)


def _nearest(k: int):
    """Per query class of a part, the k nearest ids (distance, then id) among the part's classes."""
    def rank(asked: pa.Table, held: pa.Table) -> pa.Table:
        out: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        if asked.num_rows and held.num_rows:
            vectors = _matrix(held["embedding"].combine_chunks())
            ids = held["ids"].combine_chunks()
            flat, ends = ids.flatten().to_numpy(), ids.offsets.to_numpy() - ids.offsets[0].as_py()
            for cls, query in zip(asked["cls"].to_pylist(), _matrix(asked["embedding"].combine_chunks()), strict=True):
                far = np.sqrt(((vectors - query) ** 2).sum(1))
                near = np.flatnonzero(far <= np.partition(far, k - 1)[k - 1]) if len(far) > k else np.arange(len(far))
                sizes = ends[near + 1] - ends[near]
                members = flat[np.repeat(ends[near] - np.cumsum(sizes) + sizes, sizes) + np.arange(sizes.sum())]
                distance = np.repeat(far[near], sizes)
                first = np.lexsort((members, distance))[:k]
                out.append((np.full(len(first), cls), members[first], distance[first]))
        columns = [np.concatenate(c) for c in zip(*out, strict=True)] if out else [np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)]
        return pa.table({n: pa.array(c) for n, c in zip(("cls", "vec_id", "score"), columns, strict=True)})

    return rank


def _search(classes: DataFrame, asked: DataFrame, k: int, tables: range, hashes: int, probes: int) -> DataFrame:
    """The k nearest ids of each asked class among those found: cls, vec_id, score."""
    keys = ["dim", "tab", "bucket"]
    held = _hashed(classes.select("cls", "dim", "embedding", "ids"), tables, hashes, 1)
    # A row for each bucket: tables times (2 * dimension) ** hashes at most.
    parts = _hashed(classes.select("cls", "dim", "embedding"), tables, hashes, 1).groupBy(*keys).count()
    parts = checkpointed(parts.select(*keys, F.ceil(F.col("count") / PART_ROWS).cast("int").alias("parts")))
    held = held.join(parts, keys).withColumn("part", F.pmod(F.xxhash64("cls"), F.col("parts")).cast("int"))
    wanted = _hashed(asked.select("cls", "dim", "embedding"), tables, hashes, probes)
    wanted = wanted.join(parts, keys).withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    cells = [*keys, "part"]
    found = wanted.drop("parts").groupBy(*cells).cogroup(held.drop("parts").groupBy(*cells)).applyInArrow(_nearest(k), FOUND)
    place = F.row_number().over(Window.partitionBy("cls").orderBy("score", "vec_id"))
    return found.distinct().withColumn("place", place).filter(F.col("place") <= k).drop("place")


def nearest(vectors: DataFrame, queries: DataFrame, k: int = 10, tables: int = 6, hashes: int = 1, probes: int = 24) -> DataFrame:
    """The k nearest rows of vectors for each row of queries, other than the query's own: query_id, rank, vec_id, score.

    Both have vec_id and embedding (an array of floats). score is the Euclidean
    distance of the given vectors in double precision; ties go to the smaller
    vec_id. Null vectors and ids, vectors of zeros, and those with null or
    non-finite components take no part; vectors of different lengths are never
    compared; repeated rows count once. A query that finds fewer than k in its
    buckets is compared with every vector.
    """
    def usable(df: DataFrame) -> DataFrame:
        finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
        good = df.select(F.col("vec_id").cast("long"), "embedding").filter(F.col("vec_id").isNotNull() & F.col("embedding").isNotNull())
        return good.filter(finite & F.exists("embedding", lambda x: x != 0))

    base = usable(vectors)
    first = F.dense_rank().over(Window.partitionBy("embedding").orderBy("vec_id"))
    kept = base.withColumn("place", first).filter(F.col("place") <= k + 1)
    classes = kept.groupBy("embedding").agg(F.sort_array(F.collect_set("vec_id")).alias("ids"))
    classes = checkpointed(classes.select(F.get("ids", F.lit(0)).alias("cls"), F.size("embedding").alias("dim"), "embedding", "ids"))
    asking = checkpointed(usable(queries).distinct().join(classes.select("embedding", "cls"), "embedding").select(F.col("vec_id").alias("query_id"), "cls"))
    asked = classes.join(asking.select("cls").distinct(), "cls", "left_semi")
    # One more than k, as a class holds its queries themselves.
    found = checkpointed(_search(classes, asked, k + 1, range(tables), hashes, probes))
    few = found.groupBy("cls").count().filter(F.col("count") > k).select("cls")
    short = checkpointed(asked.join(few, "cls", "left_anti"))
    if short.limit(1).count():
        every = 2 ** 62
        found = found.join(short.select("cls"), "cls", "left_anti").unionByName(_search(classes, short, k + 1, range(1), hashes, every))
    ranked = asking.join(found, "cls").filter("query_id <> vec_id")
    place = F.row_number().over(Window.partitionBy("query_id").orderBy("score", "vec_id"))
    return ranked.withColumn("rank", place).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
