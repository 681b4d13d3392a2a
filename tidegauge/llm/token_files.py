"""Token ids in directly addressable codes.

An id is split into chunks of 8 bits. Level 0 holds the low chunk of every id
and a bitmap that says which ids go on; level 1 holds the next chunk of those,
and so on. A rank directory counts the set bits before every block of a bitmap,
so id i is read from each level at a computed place, and no block is decoded.

A file is a Parquet part of segments: whole documents in doc_id order, their
lengths, and the codes of their ids. Parquet gives the commit protocol and
works in every store; the codes are this format's own bytes.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import slices, texts_of
from .word_ids import tokenizer_json, word_encoder

MAGIC = b"DAC8"
BLOCK = 512
SEGMENT_IDS = 1 << 20
SEGMENT_SCHEMA = "part int, segment int, before long, doc_ids array<long>, lengths array<long>, n_ids long, codes binary"


def dac_encode(ids: np.ndarray) -> bytes:
    """The codes of unsigned ids below 2**32."""
    rest, levels = np.asarray(ids, np.uint32), []
    while True:
        more = rest > 255
        ranks = np.concatenate([[0], np.cumsum(np.add.reduceat(more, np.arange(0, len(more), BLOCK), dtype=np.uint32))[:-1]]) if len(more) else np.zeros(0)
        levels.append(((rest & 255).astype(np.uint8).tobytes(), np.packbits(more, bitorder="little").tobytes(), ranks.astype("<u4").tobytes()))
        rest = rest[more] >> 8
        if not len(rest):
            break
    head = struct.pack("<4sI", MAGIC, len(levels)) + b"".join(struct.pack("<I", len(level[0])) for level in levels)
    return head + b"".join(b"".join(level) for level in levels)


class DacReader:
    """Ids from codes: one at a time by place, or a whole run."""

    def __init__(self, codes: bytes) -> None:
        magic, n = struct.unpack_from("<4sI", codes)
        if magic != MAGIC:
            raise ValueError("not directly addressable codes")
        at, self._levels = 8 + 4 * n, []
        for size in struct.unpack_from(f"<{n}I", codes, 8):
            chunks = np.frombuffer(codes, np.uint8, size, at)
            bits = np.frombuffer(codes, np.uint8, (size + 7) // 8, at + size)
            ranks = np.frombuffer(codes, "<u4", (size + BLOCK - 1) // BLOCK, at + size + len(bits))
            at += size + len(bits) + 4 * len(ranks)
            self._levels.append((chunks, bits, ranks))

    def __len__(self) -> int:
        return len(self._levels[0][0])

    def __getitem__(self, i: int) -> int:
        if not 0 <= i < len(self):
            raise IndexError(i)
        value = 0
        for level, (chunks, bits, ranks) in enumerate(self._levels):
            value |= int(chunks[i]) << 8 * level
            if not bits[i >> 3] >> (i & 7) & 1:
                break
            block = i // BLOCK
            inside = np.unpackbits(bits[block * BLOCK // 8 : (i >> 3) + 1], bitorder="little")[: i - block * BLOCK]
            i = int(ranks[block]) + int(inside.sum())
        return value

    def all(self) -> np.ndarray:
        values = np.zeros(len(self), np.uint32)
        at = np.arange(len(self))
        for level, (chunks, bits, _) in enumerate(self._levels):
            values[at] |= chunks.astype(np.uint32) << np.uint32(8 * level)
            at = at[np.unpackbits(bits, count=len(chunks), bitorder="little").astype(bool)]
        return values


def segments(docs: DataFrame, tokenizer: str, end_id: int = 1, segment_ids: int = SEGMENT_IDS) -> DataFrame:
    """Segments of whole documents in ascending doc_id order; parts and segments are numbered in that order.

    docs: doc_id, text. A null text is empty, a null doc_id comes first, repeated
    rows stay (those of one doc_id by text); a segment ends with the document that
    reaches `segment_ids` ids.
    """
    json = tokenizer_json(tokenizer)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, part, number, before = word_encoder(json), TaskContext.get().partitionId(), 0, 0
        doc_ids: list[int | None] = []
        runs: list[np.ndarray] = []
        size = 0

        def done() -> pa.RecordBatch:
            ids = np.concatenate(runs)
            return pa.RecordBatch.from_arrays(
                [pa.array([part], pa.int32()), pa.array([number], pa.int32()), pa.array([before], pa.int64()), pa.array([doc_ids], pa.list_(pa.int64())), pa.array([[len(r) for r in runs]], pa.list_(pa.int64())), pa.array([len(ids)], pa.int64()), pa.array([dac_encode(ids)], pa.binary())],
                names=["part", "segment", "before", "doc_ids", "lengths", "n_ids", "codes"],
            )

        for batch in slices(batches, "text", keep=True):
            ids, at = encoder.encode(texts_of(batch))
            for row, doc_id in enumerate(batch.column("doc_id").to_pylist()):
                doc_ids.append(doc_id)
                runs.append(np.append(ids[at[row] : at[row + 1]], np.uint32(end_id)))
                size += len(runs[-1])
                if size >= segment_ids:
                    yield done()
                    number, before, doc_ids, runs, size = number + 1, before + size, [], [], 0
        if runs:
            yield done()

    ordered = docs.select(F.col("doc_id").cast("long"), F.col("text")).repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")
    return ordered.mapInArrow(write, SEGMENT_SCHEMA)


def write_token_files(docs: DataFrame, path: str, tokenizer: str, end_id: int = 1) -> None:
    """Write the ids of every text, followed by `end_id`, as token files below `path`."""
    segments(docs, tokenizer, end_id).write.mode("overwrite").parquet(path)


def placed_segments(spark: SparkSession, path: str) -> DataFrame:
    """The segments of token files with `start`, the ids of all segments before.

    A segment knows the ids before it in its part. One row for each part, of
    which there are as many as tasks wrote, is summed in a window and broadcast.
    """
    stored = spark.read.schema(SEGMENT_SCHEMA).parquet(path)
    parts = stored.groupBy("part").agg(F.sum("n_ids").alias("part_ids"))
    earlier = F.sum("part_ids").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    starts = parts.select("part", F.coalesce(earlier, F.lit(0)).alias("part_start"))
    return stored.join(F.broadcast(starts), "part").withColumn("start", F.col("part_start") + F.col("before"))


def read_token_files(spark: SparkSession, path: str) -> DataFrame:
    """Per document of token files: doc_id, start (ids before it), n_tokens, ids_crc32 and its ids."""
    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                ids = DacReader(row["codes"]).all()
                ends = np.cumsum(row["lengths"])
                starts = ends - row["lengths"]
                crcs = [zlib.crc32(ids[a:b].astype("<u4").tobytes()) for a, b in zip(starts, ends, strict=True)]
                values = pa.ListArray.from_arrays(pa.array(np.append(starts, len(ids)).astype(np.int32)), pa.array(ids.astype(np.int32)))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(row["doc_ids"], pa.int64()), pa.array(starts + row["start"]), pa.array(row["lengths"], pa.int64()), pa.array(crcs, pa.int64()), values],
                    names=["doc_id", "start", "n_tokens", "ids_crc32", "ids"],
                )

    placed = placed_segments(spark, path).select("start", "doc_ids", "lengths", "codes")
    return placed.mapInArrow(decode, "doc_id long, start long, n_tokens long, ids_crc32 long, ids array<int>")
