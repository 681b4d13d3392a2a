"""Hierarchical packing into windows of several lengths, without padding.

The windows' lengths are the tiers, powers of two. Texts longer than the longest
fill windows of it; what is left of them, and every shorter text, belongs to the
shortest tier that holds it. From the longest tier to the shortest, a window
takes its tier's longest piece, and pieces of shorter tiers fill the gap to the
last token (a subset-sum over the lengths left). Pieces that no such gap fits are
poured into windows of the longest tier one after another and cut where a window
ends; the end of the pour goes into windows of descending powers of two. So
every window is exactly full, and only poured pieces are cut.

Sequences are numbered tier by tier, in a tier by the attention cost of their
pieces (the sum of squared lengths), and a step takes `step_tokens` tokens of one
tier in that order: its sequences have the same length and about the same cost.

The plan depends on how many pieces have each length, at most as many rows as
the longest tier is long. Each task numbers its pieces of a length, and the
counts of tasks and lengths are summed, so no length is ever one task's.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import checkpointed, shared_folder, slices, texts_of
from .packing import fullest
from .word_ids import tokenizer_json, word_encoder

TIERS = (4096, 2048, 1024, 512)
STEP_TOKENS = 1 << 18
#: Cut parts beyond this many meet their ids by a shuffle; fewer (64 MB) are broadcast.
BROADCAST_PARTS = 500_000
PIECES = "task int, number long, nth long, doc_id long, start long, length long, doc_tokens long, ids_crc32 long, ids binary"
PARTS = "task int, number long, at long, doc_id long, start long, length long, doc_tokens long, ids_crc32 long, sequence_id long, offset long, tier int, step_group long"


def encoded(docs: DataFrame, tokenizer: str, size: int, end_id: int) -> DataFrame:
    """Pieces of at most `size` ids: (task, number) names a piece, nth counts those of its length in the task.

    The ids (unsigned 32 bits, little-endian) are kept of pieces shorter than `size`: no others are cut.
    """
    json = tokenizer_json(tokenizer)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, task = word_encoder(json), TaskContext.get().partitionId()
        seen: Counter[int] = Counter()
        number = 0
        for batch in slices(batches, "text", keep=True):
            found, at = encoder.encode(texts_of(batch))
            rows: list[tuple] = []
            for row in range(batch.num_rows):
                own = np.append(found[at[row] : at[row + 1]], np.uint32(end_id)).astype("<u4")
                for start in range(0, len(own), size):
                    part = own[start : start + size].tobytes()
                    n = len(part) // 4
                    rows.append((row, number, seen[n], start, n, len(own), zlib.crc32(part), part if n < size else None))
                    seen[n] += 1
                    number += 1
            row, *longs, ids = zip(*rows, strict=True)
            number_, nth, start, length, tokens, crc = (pa.array(x, pa.int64()) for x in longs)
            yield pa.RecordBatch.from_arrays(
                [pa.array([task] * len(row), pa.int32()), number_, nth, batch.column("doc_id").take(pa.array(row)), start, length, tokens, crc, pa.array(ids, pa.binary())],
                names=["task", "number", "nth", "doc_id", "start", "length", "doc_tokens", "ids_crc32", "ids"],
            )

    return docs.select(F.col("doc_id").cast("long"), F.col("text")).mapInArrow(cut, PIECES)


def full_windows(counts: dict[int, int], tiers: Sequence[int]) -> tuple[list[tuple[int, list[int], int]], dict[int, int]]:
    """Windows that whole pieces fill, as (tier, lengths, how many), and how many pieces of each length are left over."""
    left = np.zeros(max(tiers) + 1, np.int64)
    for length, n in counts.items():
        left[length] = n
    windows, over = [], {}
    for tier, below in zip(tiers, [*tiers[1:], 0], strict=True):
        for lead in range(tier, below, -1):
            while left[lead]:
                left[lead] -= 1
                chosen = [lead, *fullest(left, tier - lead)]
                left[lead] += 1
                if sum(chosen) < tier:
                    over[lead] = int(left[lead])
                    left[lead] = 0
                    break
                lengths, times = np.unique(chosen, return_counts=True)
                repeat = int((left[lengths] // times).min())
                left[lengths] -= times * repeat
                windows.append((tier, chosen, repeat))
    return windows, over


class Plan:
    """Where piece number k of a length goes; small, and the same in every task."""

    def __init__(self, counts: dict[int, int], tiers: Sequence[int], step_tokens: int) -> None:
        windows, over = full_windows(counts, tiers)
        self.size = tiers[0]
        self.poured = sum(n * c for n, c in over.items())
        pours, rest = divmod(self.poured, self.size)
        #: Places in the pour where its last, shorter windows start, and where the pour ends.
        self.tail = [pours * self.size]
        for bit in reversed(range(self.size.bit_length())):
            if rest >> bit & 1:
                self.tail.append(self.tail[-1] + (1 << bit))
        order = sorted(windows, key=lambda w: (-w[0], sum(n * n for n in w[1])))
        steps, used, sequence, group = [], Counter(), 0, 0
        rows: list[tuple[int, int, int, int, int]] = []  # length, its first number, pieces a window, first sequence (pour: -1), first offset
        for tier in tiers:
            first = sequence
            for _, chosen, repeat in (w for w in order if w[0] == tier):
                offset = 0
                for length, each in sorted(Counter(chosen).items(), reverse=True):
                    rows.append((length, used[length], each, sequence, offset))
                    used[length] += each * repeat
                    offset += each * length
                sequence += repeat
            if tier == self.size:
                self.first_pour = sequence
                sequence += pours
            if sequence > first:
                per_step = max(1, step_tokens // tier)
                steps.append((first, tier, group, per_step))
                group += -(-(sequence - first) // per_step)
        self.first_tail = sequence
        for a, b in zip(self.tail, self.tail[1:]):  # each of its own length, so each is a step
            steps.append((sequence, b - a, group, 1))
            sequence, group = sequence + 1, group + 1
        base = 0
        for length in sorted(over, reverse=True):
            rows.append((length, used[length], 1, -1, base))
            base += length * over[length]
        rows.sort()
        self._length, self._from, self._each, self._sequence, self._offset = np.array(rows, np.int64).reshape(-1, 5).T
        self._steps = np.array(steps, np.int64).reshape(-1, 4).T
        # The plan's row of a piece is, among those of its length, the last one that starts at or before its number.
        self._rows = {n: np.searchsorted(self._length, [n, n + 1]).tolist() for n in counts}

    def place(self, length: np.ndarray, k: np.ndarray) -> tuple[np.ndarray, ...]:
        """Parts of pieces: which piece, where in it, how long, sequence, offset, tier and step."""
        row = np.empty(len(length), np.int64)
        for n in np.unique(length):
            own, (a, b) = length == n, self._rows[int(n)]
            row[own] = a + np.searchsorted(self._from[a:b], k[own], side="right") - 1
        nth = k - self._from[row]
        each, sequence, offset = self._each[row], self._sequence[row], self._offset[row]
        poured = sequence < 0
        piece, at, part = np.arange(len(length)), np.zeros(len(length), np.int64), length.copy()
        sequence, offset = sequence + nth // each, offset + nth % each * length
        more = [self._pour(int(i), int(self._offset[row[i]] + nth[i] * length[i]), int(length[i])) for i in np.flatnonzero(poured)]
        if more:
            extra = np.array([p for parts in more for p in parts], np.int64).T
            keep = ~poured
            piece, at, part, sequence, offset = (np.concatenate([x[keep], y]) for x, y in zip((piece, at, part, sequence, offset), extra, strict=True))
        first, tier, group, per_step = self._steps[:, np.searchsorted(self._steps[0], sequence, side="right") - 1]
        return piece, at, part, sequence, offset, tier, group + (sequence - first) // per_step

    def _pour(self, piece: int, start: int, length: int) -> list[tuple[int, int, int, int, int]]:
        """The parts of a piece that starts at a place of the pour."""
        out, at = [], start
        while at < start + length:
            if at < self.tail[0]:
                window, offset = divmod(at, self.size)
                stop, sequence = (window + 1) * self.size, self.first_pour + window
            else:
                window = int(np.searchsorted(self.tail, at, side="right")) - 1
                stop, sequence, offset = self.tail[window + 1], self.first_tail + window, at - self.tail[window]
            stop = min(stop, start + length)
            out.append((piece, at - start, stop - at, sequence, offset))
            at = stop
        return out


def _placed(pieces: DataFrame, plan: Plan) -> DataFrame:
    """Parts of pieces in sequences; ids_crc32 is null for a part of a piece that is cut."""
    tasks = pieces.groupBy("length", "task").count()
    earlier = F.sum("count").over(Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1))
    before = tasks.select("length", "task", F.coalesce(earlier, F.lit(0)).alias("before"))
    numbered = pieces.drop("ids").join(before, ["length", "task"]).withColumn("k", F.col("nth") + F.col("before"))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            length = batch.column("length").to_numpy()
            piece, at, part, *where = plan.place(length, batch.column("k").to_numpy())
            own = batch.select(["task", "number", "doc_id", "start", "doc_tokens", "ids_crc32"]).take(pa.array(piece))
            crc = pa.array(own.column("ids_crc32").to_numpy(), mask=part < length[piece])
            sequence, offset, tier, group = where
            yield pa.RecordBatch.from_arrays(
                [*own.columns[:2], pa.array(at), own.column("doc_id"), pa.array(own.column("start").to_numpy() + at), pa.array(part), own.column("doc_tokens"), crc,
                 pa.array(sequence), pa.array(offset), pa.array(tier.astype(np.int32)), pa.array(group)],
                names=["task", "number", "at", "doc_id", "start", "length", "doc_tokens", "ids_crc32", "sequence_id", "offset", "tier", "step_group"],
            )

    return numbered.select("task", "number", "doc_id", "start", "length", "doc_tokens", "ids_crc32", "k").mapInArrow(place, PARTS)


def tiered_pack(docs: DataFrame, tokenizer: str, tiers: Sequence[int] = TIERS, end_id: int = 2, step_tokens: int = STEP_TOKENS) -> DataFrame:
    """Pack the ids of every text, followed by `end_id`, into full sequences of the tiers' lengths.

    docs: doc_id, text (other columns are left out, whatever their names). tiers: powers of
    two, longest first. Returns doc_id, start, length, ids_crc32, doc_tokens, sequence_id,
    offset, tier (the sequence's length) and step_group per piece; every id lies in one piece.

    Every sequence is full: at most log2 of the longest tier of them, at the end of the
    pour, are shorter powers of two than the tiers. A null or empty text is `end_id` alone;
    a null doc_id is kept, repeated rows are packed again, no rows give none. Which of
    several pieces of one length goes where depends on how the rows came to the tasks.
    """
    tiers = tuple(sorted(tiers, reverse=True))
    if any(t < 1 or t & (t - 1) for t in tiers) or len(set(tiers)) < len(tiers):
        raise ValueError("tiers are different powers of two")
    spark = docs.sparkSession
    path = shared_folder(spark, "tiered-pieces")
    encoded(docs, tokenizer, tiers[0], end_id).write.parquet(path)
    pieces = spark.read.schema(PIECES).parquet(path)
    counts = {r["length"]: r["count"] for r in pieces.groupBy("length").count().collect()}  # at most tiers[0] rows
    placed = checkpointed(_placed(pieces, Plan(counts, tiers, step_tokens)))
    cut = placed.filter("ids_crc32 IS NULL").drop("ids_crc32")
    if cut.count() <= BROADCAST_PARTS:
        cut = F.broadcast(cut)
    ids = pieces.filter("ids IS NOT NULL").select("task", "number", "ids")
    sums = ids.join(cut, ["task", "number"]).withColumn("ids_crc32", F.crc32(F.expr("substring(ids, CAST(4 * at + 1 AS INT), CAST(4 * length AS INT))")))
    columns = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "tier", "step_group"]
    return placed.filter("ids_crc32 IS NOT NULL").select(*columns).union(sums.select(*columns))
