"""Periodic runs of words: stretches that repeat with a period, found by multi-scale minimizers.

A run of period q is a maximal stretch in which words q apart are identical. At
the scale K, a power of two, runs with K/2 < q <= K are looked for. Every window
of K/2 runs of K words (K-grams) gives its smallest hash. Within a run of period q and
length 4q, a window and the one q words on hold the same K-grams, so both give
the same one, q apart; and as K >= q, a K-gram comes again within a run after q
words, not earlier. So two equal minimizers that follow each other at a distance
between K/2 and K seed one extension, and no run of that scale is without a seed.
Periods up to 16 are too short for windows: each such lag is scanned directly.

Each extension compares words, so whatever is reported holds exactly; K-grams are
compared by hashes of 64 bits, so a collision could at worst hide a seed. All of
it happens within a row: no shuffle, and a document's work grows with its length.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import slices, texts_of
from .hashed_words import mixed

SHORT = 16  # periods up to this are scanned lag by lag; a power of two
RUN = "struct<start:long,length:long,period:long>"
SCHEMA = f"doc_id long, n_words long, runs array<{RUN}>, collapsed string"
_ODD = np.uint64(0x9E3779B97F4A7C15)


def shortest(period: int, repeats: int = 4, least: int = 6) -> int:
    """The least length of a run of this period."""
    return max(least, repeats * period)


def window_minima(values: np.ndarray, width: int) -> np.ndarray:
    """The minimum of each `width` neighbours, in time that does not depend on width."""
    n = len(values) - width + 1
    if n <= 0:
        return values[:0]
    blocks = np.full(-(-len(values) // width) * width, np.iinfo(values.dtype).max, values.dtype)
    blocks[: len(values)] = values
    blocks = blocks.reshape(-1, width)
    after = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    before = np.minimum.accumulate(blocks, axis=1).ravel()
    return np.minimum(after[:n], before[width - 1 : width - 1 + n])


def minimizers(hashes: np.ndarray, width: int) -> np.ndarray:
    """Places that hold the minimum of some window of `width` hashes."""
    minima = window_minima(hashes, width)
    if not len(minima):
        return np.zeros(0, np.int64)
    # The greatest minimum of the windows around a place, as the smallest complement.
    around = np.full(len(minima) + 2 * (width - 1), np.iinfo(hashes.dtype).max, hashes.dtype)
    around[width - 1 : width - 1 + len(minima)] = ~minima
    return np.flatnonzero(~window_minima(around, width) == hashes)


def _equal(codes: np.ndarray, i: int, j: int, step: int) -> int:
    """How many words are equal from i and j on, in direction `step`; i < j, and a separator ends them."""
    block, total = 64, 0
    while True:
        if step > 0:
            right = codes[j + total : j + total + block]
            left = codes[i + total : i + total + len(right)]
        else:
            stop = max(0, i - total - block + 1)
            left = codes[stop : i - total + 1][::-1]
            right = codes[j - total - len(left) + 1 : j - total + 1][::-1]
        differ = np.flatnonzero(left != right)
        if len(differ):
            return total + int(differ[0])
        if not len(left):
            return total
        total += len(left)
        block *= 2


def _seeds(codes: np.ndarray, sizes: np.ndarray, repeats: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Per scale: places and distances of equal minimizers that follow each other.

    codes: words of all texts, a separator of its own after each; sizes: words of each text.
    """
    grams, place = mixed(codes.astype(np.uint64) + _ODD), np.arange(len(codes))
    scale, long = 1, sizes
    while True:
        if scale > SHORT:
            pos = minimizers(grams, scale // 2)
            order = pos[np.argsort(grams[pos], kind="stable")]
            away = np.diff(order)
            good = (grams[order[1:]] == grams[order[:-1]]) & (away > scale // 2) & (away <= scale)
            yield place[order[:-1][good]], away[good]
        # Texts too short for any period of the next scale are left out, with their separators.
        stay = long >= repeats * (max(scale, SHORT) + 1)
        if not stay.any():
            return
        if long[~stay].sum() * 2 > long.sum():
            mask = np.repeat(stay, long + 1)
            grams, place, long = grams[mask], place[mask], long[stay]
        # The hash of twice as many words; the last ones, which have no other half, keep a hash of one half.
        grams[:-scale] = mixed(grams[:-scale] * _ODD + mixed(grams[scale:]))
        grams[-scale:] = mixed(grams[-scale:] + np.uint64(scale))
        scale *= 2


def find_runs(codes: np.ndarray, sizes: np.ndarray, repeats: int = 4, least: int = 6) -> np.ndarray:
    """Rows (start, length, period) of all runs, by start and period; starts are places in `codes`.

    codes: words as integers from 0 of all texts, each text followed by a separator
    that occurs once; sizes: words of each text. A run's length is at least
    `repeats` (3 or more) times its smallest period and at least `least`.
    """
    found: list[tuple[int, int, int]] = []

    def keep(start: int, equal: int, period: int) -> None:
        length = equal + period
        if length < shortest(period, repeats, least):
            return
        root = codes[start : start + 2 * period]
        for part in _proper_divisors(period):
            if np.array_equal(root[part : part + period], root[:period]):
                return  # a shorter period
        found.append((start, length, period))

    for period in range(1, min(SHORT, max(int(sizes.max(initial=0)) // repeats, 1)) + 1):
        breaks = np.flatnonzero(codes[:-period] != codes[period:])
        equal = np.diff(breaks, prepend=-1) - 1
        for k in np.flatnonzero(equal >= shortest(period, repeats, least) - period):
            keep(int(breaks[k] - equal[k]), int(equal[k]), period)
    for places, away in _seeds(codes, sizes, repeats):
        last, end = 0, 0
        for k in np.lexsort((places, away)):
            at, period = int(places[k]), int(away[k])
            if period == last and at < end:
                continue  # within the stretch just found
            ahead, back = _equal(codes, at, at + period, 1), _equal(codes, at - 1, at + period - 1, -1) if at else 0
            last, end = period, at + ahead
            keep(at - back, ahead + back, period)
    rows = np.array(found, np.int64).reshape(-1, 3)
    return rows[np.lexsort((rows[:, 2], rows[:, 0]))]


def _proper_divisors(n: int) -> list[int]:
    """n over each of its prime factors: a period of n words that is not the smallest has one of these too."""
    out, rest, p = [], n, 2
    while rest > 1:
        if p * p > rest:
            p = rest
        if rest % p == 0:
            out.append(n // p)
            while rest % p == 0:
                rest //= p
        p += 1
    return out


def periodic_runs(docs: DataFrame, repeats: int = 4, least: int = 6) -> DataFrame:
    """Per row of docs (doc_id, text): doc_id, n_words, runs (start, length, period) and collapsed.

    A word is a run of characters other than the space and the controls 9 to 13;
    words are numbered from 0 and compared exactly. `runs` holds every stretch of at
    least `repeats` times its smallest period and `least` words that no neighbouring
    word extends, by start, then period. `collapsed` is the text without words that
    any run holds after its first period, joined by one space.

    A null or empty text, or one of white space, has no words, no runs and an empty
    collapsed text. Rows without doc_id and repeated rows give their rows again; no
    rows give none; other columns are left out, whatever their names.
    """
    def runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            # Bytes split at just these six characters.
            texts = [t.split() for t in pc.cast(texts_of(batch), pa.binary()).to_pylist()]
            sizes = np.array([len(t) for t in texts], np.int64)
            coded = pa.array(chain.from_iterable(texts), pa.large_binary()).dictionary_encode()
            starts = np.cumsum(sizes + 1) - sizes - 1
            codes = np.empty(int(sizes.sum()) + len(sizes), np.int64)
            word = np.ones(len(codes), bool)
            word[starts + sizes] = False
            codes[word] = coded.indices.to_numpy()
            codes[~word] = len(coded.dictionary) + np.arange(len(sizes))
            found = find_runs(codes, sizes, repeats, least)
            of = np.searchsorted(starts, found[:, 0], side="right") - 1
            bounds = np.searchsorted(of, np.arange(len(sizes) + 1))
            found[:, 0] -= starts[of]
            collapsed = []
            for row, words in enumerate(texts):
                own = found[bounds[row] : bounds[row + 1]]
                if len(own):
                    gone = np.zeros(len(words) + 1, np.int64)
                    np.add.at(gone, own[:, 0] + own[:, 2], 1)
                    np.add.at(gone, own[:, 0] + own[:, 1], -1)
                    words = [words[i] for i in np.flatnonzero(np.cumsum(gone[:-1]) == 0)]
                collapsed.append(b" ".join(words))
            structs = pa.StructArray.from_arrays([pa.array(found[:, c]) for c in range(3)], ["start", "length", "period"])
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(sizes), pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), structs), pa.array(collapsed, pa.string())],
                names=["doc_id", "n_words", "runs", "collapsed"],
            )

    return docs.select(F.col("doc_id").cast("long"), F.col("text")).mapInArrow(runs, SCHEMA)


def greatest_run(runs: Column) -> Column:
    """Of runs by start and period, the one with the greatest exact length / period, the first of several; null of none."""
    def better(best: Column, run: Column) -> Column:
        return F.when(best.isNull() | (run["length"] * best["period"] > best["length"] * run["period"]), run).otherwise(best)

    return F.aggregate(runs, F.lit(None).cast(RUN), better)


def run_report(found: DataFrame) -> DataFrame:
    """Digests of `periodic_runs`: n_runs, the greatest run, and hashes of all runs and of the collapsed text."""
    best = found.withColumn("best", greatest_run(F.col("runs")))
    line = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    return best.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        *(F.col("best")[c].alias(c) for c in ("start", "length", "period")),
        F.expr("1000 * best.length DIV best.period").alias("exponent_milli"),
        F.sha2(F.array_join(line, ""), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed"), 256).alias("collapsed_sha256"),
    )


def planted(docs: DataFrame) -> DataFrame:
    """docs (doc_id, text) in which every tenth document, by the crc32 of its id, repeats itself from some word on.

    With h the crc32 of the id, g = h div 10 and n words, word a = g mod n begins a
    period of 1 + (n - a) div (3 + g mod 8) words. Documents without id stay.
    """
    h = F.crc32(F.col("doc_id").cast("long").cast("string"))
    words = F.filter(F.split(F.col("text"), "[\\x20\\x09-\\x0D]+"), lambda w: w != "")
    hit = docs.select(F.col("doc_id").cast("long"), "text", (h % 10 == 0).alias("_hit"), F.expr("0L").alias("_n"), F.floor(h / 10).alias("_g"))
    hit = hit.withColumn("_words", F.when(F.col("_hit"), words)).withColumn("_n", F.size("_words").cast("long"))
    hit = hit.withColumn("_a", F.when(F.col("_n") > 0, F.col("_g") % F.col("_n")))
    hit = hit.withColumn("_p", F.expr("1 + (_n - _a) DIV (3 + _g % 8)"))
    repeated = F.expr("concat(slice(_words, 1, cast(_a AS int)), transform(sequence(0L, _n - _a - 1), i -> _words[cast(_a + i % _p AS int)]))")
    return hit.select("doc_id", F.when(F.col("_hit") & (F.col("_n") > 0), F.array_join(repeated, " ")).otherwise(F.col("text")).alias("text"))
