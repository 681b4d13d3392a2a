"""Best-fit packing by minimum bin slack.

Texts become pieces of 1 to `size` tokens, so a pack is decided by lengths
alone: how many pieces have each length is a table of at most `size` rows. Per
bin, the longest length left goes in, and a subset-sum over the lengths left,
held as a bitset of reachable fills, finds the fullest feasible rest. The bin is
then repeated until one of its lengths runs short, which is what filling bin
after bin would do, so the plan has bounded size whatever the number of pieces.

Pieces are numbered within their length, in cells of a hash so that a common
length is never one task's, and number k of a length takes slot k of the plan.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import checkpointed, set_apart, slices, texts_of
from .word_ids import tokenizer_json, word_encoder

PIECE_SCHEMA = "doc_id long, piece int, start long, length long, ids_crc32 long"
CELL_ROWS = 5_000


def pieces(docs: DataFrame, tokenizer: str, size: int = 2048, end_id: int = 0) -> DataFrame:
    """Cut the ids of every text, followed by `end_id`, into pieces of at most `size` ids.

    docs: doc_id, text (other columns are left out). A null or empty text is the
    piece of `end_id` alone; repeated rows give their pieces again; no rows give none.
    """
    json = tokenizer_json(tokenizer)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = word_encoder(json)
        for batch in slices(batches, "text", 1 << 20, keep=True):
            ids, at = encoder.encode(texts_of(batch))
            rows: list[tuple[int, int, int, int]] = []
            for row in range(batch.num_rows):
                own = np.append(ids[at[row] : at[row + 1]], np.uint32(end_id)).astype("<u4")
                for k, start in enumerate(range(0, len(own), size)):
                    part = own[start : start + size]
                    rows.append((row, k, start, len(part), zlib.crc32(part.tobytes())))
            row, k, start, length, crc = (np.array(x, np.int64) for x in zip(*rows, strict=True))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").take(pa.array(row)), pa.array(k.astype(np.int32)), *map(pa.array, (start, length, crc))],
                names=["doc_id", "piece", "start", "length", "ids_crc32"],
            )

    return docs.select(F.col("doc_id").cast("long"), F.col("text")).mapInArrow(cut, PIECE_SCHEMA)


def fullest(counts: np.ndarray, room: int) -> list[int]:
    """Lengths, longest first, of the fullest subset within `room`; counts[n] pieces of length n are left."""
    within = (1 << (room + 1)) - 1
    reach = 1
    added: list[tuple[int, int]] = []  # a length, and the fills that it reached first
    for length in range(min(room, len(counts) - 1), 0, -1):
        for _ in range(min(int(counts[length]), room // length)):
            new = (reach << length) & within & ~reach
            if not new:
                break
            reach |= new
            added.append((length, new))
        if reach >> room & 1:
            break
    fill, chosen = reach.bit_length() - 1, []
    for length, new in reversed(added):
        if new >> fill & 1:
            chosen.append(length)
            fill -= length
    return chosen[::-1]


def bin_plan(counts: dict[int, int], size: int) -> list[tuple[list[int], int]]:
    """Bins as (lengths, how many such bins), by minimum bin slack over the counts of each length."""
    left = np.zeros(size + 1, np.int64)
    for length, n in counts.items():
        left[length] = n
    plan = []
    while left.any():
        longest = int(np.flatnonzero(left)[-1])
        left[longest] -= 1
        chosen = [longest, *fullest(left, size - longest)]
        left[longest] += 1
        lengths, times = np.unique(chosen, return_counts=True)
        repeat = int((left[lengths] // times).min())
        left[lengths] -= times * repeat
        plan.append((chosen, repeat))
    return plan


def slots(plan: list[tuple[list[int], int]]) -> list[tuple[int, int, int, int, int, int]]:
    """Per bin kind and length: length, its first and end number, pieces a bin, first bin, first offset in a bin."""
    used: dict[int, int] = {}
    out, first_bin = [], 0
    for chosen, repeat in plan:
        offset = 0
        for length in sorted(set(chosen), reverse=True):
            each = chosen.count(length)
            start = used.get(length, 0)
            used[length] = start + each * repeat
            out.append((length, start, used[length], each, first_bin, offset))
            offset += each * length
        first_bin += repeat
    return out


def pack(parts: DataFrame, size: int = 2048) -> DataFrame:
    """Place pieces (doc_id, piece, length and any more columns) in bins: adds sequence_id and offset.

    Ties between pieces of one length are broken by a hash cell, then doc_id and
    piece; repeated rows take places of their own; no pieces give no rows. Other
    columns stay whatever their names, but sequence_id and offset are replaced.
    """
    spark = parts.sparkSession
    parts, given = set_apart(parts.drop("sequence_id", "offset"), ("_cell", "_in", "_before", "_k", "_from", "_to", "_each", "_bin", "_offset"))
    total, counts = 0, {}
    for row in parts.groupBy("length").count().collect():  # at most `size` rows
        counts[row["length"]] = row["count"]
        total += row["count"]
    plan = slots(bin_plan(counts, size))
    cells = max(16, total // CELL_ROWS)
    celled = parts.withColumn("_cell", F.pmod(F.xxhash64("doc_id", "piece"), F.lit(cells)))
    by_length = Window.partitionBy("length").orderBy("_cell").rowsBetween(Window.unboundedPreceding, -1)
    before = celled.groupBy("length", "_cell").count().select("length", "_cell", F.coalesce(F.sum("count").over(by_length), F.lit(0)).alias("_before"))
    number = F.row_number().over(Window.partitionBy("length", "_cell").orderBy("doc_id", "piece")) - 1
    numbered = celled.withColumn("_in", number).join(before, ["length", "_cell"])
    schema = "length long, _from long, _to long, _each long, _bin long, _offset long"
    # At most `size` lengths times the bins they exhaust: bounded by `size`, whatever the corpus.
    table = F.broadcast(spark.createDataFrame(plan, schema))
    k = F.col("_in") + F.col("_before")
    placed = numbered.withColumn("_k", k).join(table, "length").filter((F.col("_k") >= F.col("_from")) & (F.col("_k") < F.col("_to")))
    nth = F.col("_k") - F.col("_from")
    return placed.select(
        *(F.col(c).alias(given.get(c, c)) for c in parts.columns if c != "length"),
        F.col("length"),
        (F.col("_bin") + F.floor(nth / F.col("_each"))).cast("long").alias("sequence_id"),
        (F.col("_offset") + nth % F.col("_each") * F.col("length")).cast("long").alias("offset"),
    )


def best_fit_pack(docs: DataFrame, tokenizer: str, size: int = 2048, end_id: int = 0) -> DataFrame:
    """Pack whole texts into sequences of at most `size` ids: the pieces with sequence_id and offset.

    docs: doc_id, text; see `pieces` and `pack` for nulls, repeats and empty tables.
    The pieces are written once, as encoding costs more than anything after it.
    """
    return pack(checkpointed(pieces(docs, tokenizer, size, end_id)), size)
