"""Stupid-backoff scores, relationally.

S(w | context) is c(context w) / c(context) where other documents hold the
n-gram, else `alpha` times the score with a context one word shorter; without
context it is (c(w) + 1) / (words + 1). All counts are those of the other
documents: the whole corpus less the document that is scored.

Counting and looking up are one relational pass. Documents are dealt into
chunks by a hash; a chunk's distinct n-grams, with their counts, go to the
count table's partitions, each of which holds a range of n-gram hashes, and the
sums come back to the chunk. An n-gram however common is one entry of a chunk,
so no partition grows with a hot word. Entries travel as packed columns of
bytes. The n-gram of no words counts all words, so the total needs no pass.

Hashes have 56 bits and the table's partition is a range of them.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import texts_of
from .hashed_words import runs, word_hashes

CHUNK_ROWS = 2_000
_SHIFT = np.uint64(8)


def _packed(values: np.ndarray, width: int, sorted_: bool = False) -> bytes:
    """Integers below 256**width, sorted ones as differences, byte by byte of all: equal high bytes lie together and compress."""
    if sorted_:
        values = np.diff(values, prepend=values.dtype.type(0))
    planes = values.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width].T
    return zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(planes).tobytes())


def _unpacked(data: bytes, width: int, sorted_: bool = False) -> np.ndarray:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8).reshape(width, -1)
    out = np.zeros((planes.shape[1], 8), np.uint8)
    out[:, :width] = planes.T
    values = out.view("<u8").ravel()
    return np.cumsum(values, dtype=np.uint64) if sorted_ else values


class _Grams:
    """All n-grams of a chunk: distinct keys in order, counts, and the key of each position."""

    def __init__(self, texts: pa.Array, order: int) -> None:
        words, self.at = word_hashes(texts)
        self.text, self.size = np.repeat(np.arange(len(texts)), np.diff(self.at)), len(words)
        keys, self.valid = [np.zeros(len(words), np.uint64)], [np.ones(len(words), bool)]
        for n in range(1, order + 1):
            found, _ = runs(words, self.at, n)
            valid = np.zeros(len(words), bool)
            valid[n - 1 :] = self.text[n - 1 :] == self.text[: len(words) - n + 1] if len(words) >= n else False
            of = np.zeros(len(words), np.uint64)
            of[valid] = found >> _SHIFT
            keys.append(of)
            self.valid.append(valid)
        self.order = order
        every = np.concatenate([k[v] for k, v in zip(keys, self.valid, strict=True)])
        self.keys, where, self.counts = np.unique(every, return_inverse=True, return_counts=True)
        self.place = []
        start = 0
        for valid in self.valid:
            of = np.full(len(words), -1, np.int64)
            of[valid] = where[start : start + valid.sum()]
            start += int(valid.sum())
            self.place.append(of)

    def ranges(self, shards: int) -> np.ndarray:
        """Where the keys of each shard start."""
        borders = [(i << 56) // shards for i in range(shards)]
        return np.append(np.searchsorted(self.keys, np.array(borders, np.uint64)), len(self.keys))

    def others(self, n: int, totals: np.ndarray) -> np.ndarray:
        """Per position, how often other documents hold its n-gram; 0 where the text has none there."""
        valid = self.valid[n]
        out = np.zeros(self.size)
        place = self.place[n][valid]
        own = self.text[valid] * np.int64(len(self.keys)) + place
        _, where, times = np.unique(own, return_inverse=True, return_counts=True)
        out[valid] = totals[place].astype(np.int64) - times[where]
        return out


def _score(grams: _Grams, totals: np.ndarray, alpha: float) -> np.ndarray:
    """Per position the logarithm of its backed-off score."""
    counts = [grams.others(n, totals) for n in range(grams.order + 1)]
    out = np.log(counts[1] + 1) - np.log(counts[0] + 1)
    longest = np.zeros(grams.size, int)
    for n in range(1, grams.order + 1):
        longest[grams.valid[n]] = n
    used = np.ones(grams.size, int)
    for n in range(2, grams.order + 1):
        seen = counts[n] > 0
        context = np.empty(grams.size)
        # The context of a position's n-gram is the (n-1)-gram that ends one word before; it is whole where the n-gram is.
        context[1:] = counts[n - 1][:-1]
        # The context is looked up within the same document, and an n-gram seen elsewhere has its context there.
        out[seen] = np.log(counts[n][seen]) - np.log(context[seen])
        used[seen] = n
    return out + (longest - used) * math.log(alpha)


def stupid_backoff(docs: DataFrame, order: int = 3, alpha: float = 0.4, chunk_rows: int = CHUNK_ROWS) -> DataFrame:
    """Per row of docs (doc_id, text): doc_id, n_tokens, log_score (natural, summed) and mean_log_score.

    A null or empty text, or one of white space, has n_tokens 0, log_score 0 and
    a null mean. Repeated rows count as documents of their own and so support
    each other; null ids stay; no rows give none.
    """
    keyed = docs.select(F.col("doc_id").cast("long"), F.coalesce("text", F.lit("")).alias("text"))
    chunks = max(1, math.ceil(docs.count() / chunk_rows))
    keyed = keyed.select(F.pmod(F.xxhash64("doc_id", "text"), F.lit(chunks)).cast("int").alias("chunk"), "doc_id", "text")

    def ask(key: tuple, table: pa.Table) -> pa.Table:
        grams = _Grams(texts_of(table.combine_chunks().to_batches()[0]), order)
        at = grams.ranges(chunks)
        full = np.flatnonzero(np.diff(at))
        parts = [slice(at[i], at[i + 1]) for i in full]
        return pa.table({
            "shard": pa.array(full.astype(np.int32)),
            "chunk": pa.array(np.full(len(full), key[0].as_py(), np.int32)),
            "keys": pa.array([_packed(grams.keys[p], 7, True) for p in parts], pa.binary()),
            "counts": pa.array([_packed(grams.counts[p], 4) for p in parts], pa.binary()),
        })

    def add(key: tuple, table: pa.Table) -> pa.Table:
        keys = [_unpacked(x, 7, True) for x in table["keys"].to_pylist()]
        counts = np.concatenate([_unpacked(x, 4) for x in table["counts"].to_pylist()])
        distinct, where = np.unique(np.concatenate(keys), return_inverse=True)
        totals = np.bincount(where, counts, len(distinct)).astype(np.uint64)[where]
        at = np.cumsum([0, *map(len, keys)])
        return pa.table({
            "shard": table["shard"],
            "chunk": table["chunk"],
            "totals": pa.array([_packed(totals[a:b], 6) for a, b in zip(at[:-1], at[1:], strict=True)], pa.binary()),
        })

    def sum_up(key: tuple, table: pa.Table, replies: pa.Table) -> pa.Table:
        batch = table.combine_chunks().to_batches()[0]
        grams = _Grams(texts_of(batch), order)
        found = replies.sort_by("shard")["totals"].to_pylist()
        totals = np.concatenate([_unpacked(x, 6) for x in found]) if found else np.zeros(0, np.uint64)
        words = np.diff(grams.at)
        score = np.bincount(grams.text, _score(grams, totals, alpha), len(words)) if grams.size else np.zeros(len(words))
        return pa.table({
            "doc_id": batch.column("doc_id"),
            "n_tokens": pa.array(words.astype(np.int64)),
            "log_score": pa.array(score),
            "mean_log_score": pa.array(np.divide(score, words, where=words > 0, out=np.zeros(len(score))), mask=words == 0),
        })

    asked = keyed.groupBy("chunk").applyInArrow(ask, "shard int, chunk int, keys binary, counts binary")
    replies = asked.groupBy("shard").applyInArrow(add, "shard int, chunk int, totals binary")
    both = keyed.groupBy("chunk").cogroup(replies.groupBy("chunk"))
    return both.applyInArrow(sum_up, "doc_id long, n_tokens long, log_score double, mean_log_score double")
