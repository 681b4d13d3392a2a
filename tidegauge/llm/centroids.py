"""Centroid clustering of integer vectors by Walsh-Hadamard progressive search.

Vectors and centroids go through the integer Walsh-Hadamard transform, which
multiplies every squared distance by the number of components. A vector's
distance to each centroid is then added up over coefficients from coarse to
fine, by the number of sign changes. The centroid that is nearest over the
coarse ones is measured whole; a centroid whose sum so far is strictly greater
cannot be nearest and goes. What is left is finished over all coefficients, so
the result is exact, with ties to the smaller number.

A round is one pass over the stored integers: every task reduces its vectors to
a sum and a count for each centroid, so only those reach the shuffle, and k rows
of sums the driver.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import checkpointed

#: Integers below this have distances, times 64, within 64 bits.
LIMIT = 1 << 23
ROWS = 4_096  # vectors that a task compares at once


def integer_vectors(vectors: DataFrame, size: int = 64, scale: int = 256) -> DataFrame:
    """Rows (vec_id, embedding) with exactly `size` components, none null or not finite: vec_id and `ints`, floor(scale * x).

    Left out too are vectors with an integer of 2**23 or more in magnitude, whose
    distances might not fit 64 bits. Other columns are left out.
    """
    usable = F.coalesce((F.size("embedding") == size) & F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(scale * x.cast("double")) < LIMIT)), F.lit(False))
    kept = vectors.select(F.col("vec_id").cast("long"), "embedding").filter(usable)
    return kept.select("vec_id", F.transform("embedding", lambda x: F.floor(scale * x.cast("double")).cast("int")).alias("ints"))


def hadamard(values: np.ndarray) -> np.ndarray:
    """The Walsh-Hadamard transform of each row (a power of two of integers), coefficients by their sign changes."""
    rows, n = values.shape
    out, half = values.astype(np.int64), 1
    while half < n:
        pairs = out.reshape(rows, -1, 2, half)
        out = np.stack([pairs[:, :, 0] + pairs[:, :, 1], pairs[:, :, 0] - pairs[:, :, 1]], axis=2).reshape(rows, n)
        half *= 2
    return out[:, _by_sign_changes(n)]


def _by_sign_changes(n: int) -> np.ndarray:
    """Places, in the transform's natural order, of the coefficients with 0, 1, ... n - 1 sign changes."""
    matrix = np.ones((1, 1), np.int8)
    while len(matrix) < n:
        matrix = np.block([[matrix, matrix], [matrix, -matrix]])
    return np.argsort((np.diff(matrix, axis=1) != 0).sum(1), kind="stable")


def nearest(vectors: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The nearest centroid of each vector, the smaller number of several, and the squared distance; all exact integers."""
    n, size = vectors.shape
    fine, centres = hadamard(vectors), hadamard(centroids)
    row, number = (x.ravel() for x in np.indices((n, len(centres))))
    sums, best = np.zeros(len(row), np.int64), None
    at, width = 0, 4
    while at < size:
        stop = min(size, at + width)
        sums = sums + ((fine[row, at:stop] - centres[number, at:stop]) ** 2).sum(1)
        if best is None:  # the nearest so far is measured whole, for all others to be held against
            first = sums.reshape(n, -1).argmin(1)
            best = ((fine - centres[first]) ** 2).sum(1)
        alive = sums <= best[row]
        row, number, sums = row[alive], number[alive], sums[alive]
        at, width = stop, 2 * width if at else width
    order = np.lexsort((number, sums, row))
    first = order[np.searchsorted(row[order], np.arange(n))]
    return number[first], sums[first] // size


def _chunks(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    for batch in batches:
        for start in range(0, batch.num_rows, ROWS):
            part = batch.slice(start, ROWS)
            yield part, part.column("ints").flatten().to_numpy().reshape(-1, size).astype(np.int64)


def first_centroids(ints: DataFrame, k: int, salt: str = "2:") -> np.ndarray:
    """The k vectors with the smallest sha256 of salt and vec_id (null: salt alone), equal hashes by their components."""
    key = F.sha2(F.concat(F.lit(salt), F.coalesce(F.col("vec_id").cast("string"), F.lit(""))), 256)
    rows = ints.select("ints", key.alias("key")).orderBy("key", "ints").limit(k).collect()
    return np.array([r["ints"] for r in rows], np.int64)


def moved(ints: DataFrame, centroids: np.ndarray) -> np.ndarray:
    """Each centroid's vectors' floor of sum over count in every component; a centroid without vectors stays."""
    k, size = centroids.shape

    def reduce(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count, total = np.zeros(k, np.int64), np.zeros((k, size), np.int64)
        for _, vectors in _chunks(batches, size):
            cluster, _ = nearest(vectors, centroids)
            for c in np.unique(cluster):
                total[c] += vectors[cluster == c].sum(0)
            count += np.bincount(cluster, minlength=k)
        own = np.flatnonzero(count)
        yield pa.RecordBatch.from_arrays([pa.array(own.astype(np.int32)), pa.array(count[own]), *(pa.array(total[own, c]) for c in range(size))], names=["cluster", "n", *(f"s{c}" for c in range(size))])

    schema = ", ".join(["cluster int", "n long", *(f"s{c} long" for c in range(size))])
    # Sums of all rows as decimals: at any number of rows within 38 digits.
    summed = ints.mapInArrow(reduce, schema).groupBy("cluster").agg(F.sum("n").alias("n"), F.array(*(F.sum(F.col(f"s{c}").cast("decimal(20, 0)")) for c in range(size))).alias("sums"))
    out = centroids.copy()
    for row in summed.collect():  # at most k rows
        out[row["cluster"]] = [int(s) // row["n"] for s in row["sums"]]
    return out


def cluster(vectors: DataFrame, k: int = 40, rounds: int = 5, size: int = 64, scale: int = 256, salt: str = "2:") -> DataFrame:
    """Per usable vector (see `integer_vectors`): vec_id, cluster, distance, cluster_inertia, inertia, centroid.

    `size` is a power of two. Centroids start as `first_centroids`; each of `rounds`
    rounds assigns and moves them, and vectors are assigned once more. Distances are
    squared; inertias are their sums over the cluster and over all. With fewer than k
    usable vectors each is a centroid; with none there are no rows. Rows that repeat
    a vec_id count as often as they come; a null vec_id is kept. Inertias must fit 64 bits.
    """
    ints = checkpointed(integer_vectors(vectors, size, scale))
    schema = "vec_id long, cluster int, distance long"
    centroids = first_centroids(ints, k, salt)
    if not len(centroids):
        centroids = np.zeros((1, size), np.int64)  # of no vectors
    for _ in range(rounds):
        centroids = moved(ints, centroids)

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, own in _chunks(batches, size):
            number, far = nearest(own, centroids)
            yield pa.RecordBatch.from_arrays([part.column("vec_id"), pa.array(number.astype(np.int32)), pa.array(far)], names=["vec_id", "cluster", "distance"])

    assigned = checkpointed(ints.mapInArrow(assign, schema))
    sums = {r["cluster"]: r["d"] for r in assigned.groupBy("cluster").agg(F.sum("distance").alias("d")).collect()}  # at most k rows
    every = sum(sums.values())
    rows = [(c, d, every, [int(x) for x in centroids[c]]) for c, d in sums.items()]
    table = assigned.sparkSession.createDataFrame(rows, "cluster int, cluster_inertia long, inertia long, centroid array<long>")
    return assigned.join(F.broadcast(table), "cluster").select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid")


def cluster_report(clustered: DataFrame) -> DataFrame:
    """`cluster` with the sha256 of a centroid's components, joined by commas, in place of the centroid."""
    text = F.array_join(F.transform("centroid", lambda x: x.cast("string")), ",")
    return clustered.select(*(c for c in clustered.columns if c != "centroid"), F.sha2(text, 256).alias("centroid_sha256"))
