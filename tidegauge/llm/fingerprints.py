"""Document fingerprints from prefix polynomial hashes.

The hash of a text's first i code points is a polynomial in the base, modulo two
primes; with all prefixes at hand, any span's hash is a difference, equality of
spans is one comparison, and the longest common extension of two places is a
binary search.

A fingerprint keeps of a text its length, its whole hash, and the hashes of the
prefixes and suffixes whose lengths are on a fixed ladder of eight rungs to the
doubling, and the hash and length of every inner span between borders that the
text's own content sets. Two fingerprints tell by binary search how long a
beginning and an end their texts share, and what inner spans both hold between
these, wherever they are. An edit changes the spans around it alone, so copies
with many edits stay alike. Inner spans add about an eighth of the text's length
to its fingerprint.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import slices, texts_of

PRIMES = (2147483647, 2147483629)
BASES = (1000003, 786433)
#: Prefix and suffix lengths that a fingerprint keeps: 2 to the power k/8, rounded.
LADDER = np.unique(np.round(2 ** (np.arange(0, 8 * 40) / 8)).astype(np.int64))
#: A border is behind a window of so many code points whose hash is a multiple of SPAN_MEAN.
WINDOW = 8
SPAN_MEAN = 32
#: Of borders closer than this only the first holds; spans longer than the most, which fits a byte, are cut.
SPAN_LEAST, SPAN_MOST = 8, 255
BORDER_IDS = 20
SCHEMA = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"


class _Powers:
    """Powers of a base modulo a prime, as many as were asked for."""

    def __init__(self, base: int, prime: int) -> None:
        self._base, self._prime, self._found = base, np.uint64(prime), np.ones(1, np.uint64)

    def __call__(self, n: int) -> np.ndarray:
        while len(self._found) < n:
            step = np.uint64(pow(self._base, len(self._found), int(self._prime)))
            self._found = np.concatenate([self._found, self._found * step % self._prime])
        return self._found[:n]


_POWERS = [_Powers(b, p) for b, p in zip(BASES, PRIMES, strict=True)]
_INVERSES = [_Powers(pow(b, -1, p), p) for b, p in zip(BASES, PRIMES, strict=True)]


class PrefixHashes:
    """Prefix sums of a text's polynomial; hashes of spans, their equality and common extensions."""

    def __init__(self, text: str) -> None:
        points = np.frombuffer(text.encode("utf-32-le"), "<u4").astype(np.uint64) + np.uint64(1)
        self.n = len(points)
        # Terms stay below 2**31, so sums of up to 2**32 of them fit and are reduced when they are read.
        self._sums = [np.concatenate([np.zeros(1, np.uint64), np.cumsum(points * powers(self.n) % np.uint64(p))]) for powers, p in zip(_POWERS, PRIMES, strict=True)]

    def spans(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """62-bit hashes of the spans [start, end)."""
        out = np.zeros(len(start), np.uint64)
        for sums, inverse, p in zip(self._sums, _INVERSES, PRIMES, strict=True):
            out = out << np.uint64(31) | (sums[end] - sums[start]) % np.uint64(p) * inverse(self.n + 1)[start] % np.uint64(p)
        return out

    def windows(self, size: int) -> np.ndarray:
        """31-bit hashes of all spans of `size` code points, by the first prime alone."""
        sums, p = self._sums[0], np.uint64(PRIMES[0])
        count = max(0, self.n - size + 1)
        return (sums[size : size + count] - sums[:count]) % p * _INVERSES[0](self.n + 1)[:count] % p

    def borders(self) -> np.ndarray:
        """Where the text's inner spans begin, and its end; what is before a place and near it decides alone."""
        found = np.flatnonzero(self.windows(WINDOW) % np.uint64(SPAN_MEAN) == 0) + WINDOW
        found = found[(np.diff(found, prepend=-SPAN_LEAST) >= SPAN_LEAST) & (found < self.n)]
        edges = np.concatenate([[0], found, [self.n]])
        cuts = [np.arange(edges[k] + SPAN_MOST, edges[k + 1], SPAN_MOST) for k in np.flatnonzero(np.diff(edges) > SPAN_MOST)]
        return np.unique(np.concatenate([edges, *cuts])).astype(np.int64)

    def span(self, start: int, end: int) -> int:
        return int(self.spans(np.array([start]), np.array([end]))[0])


def equal_spans(a: PrefixHashes, i: int, b: PrefixHashes, j: int, length: int) -> bool:
    return a.span(i, i + length) == b.span(j, j + length)


def common_extension(a: PrefixHashes, i: int, b: PrefixHashes, j: int) -> int:
    """How many code points agree from place i of one text and j of the other."""
    low, high = 0, min(a.n - i, b.n - j)
    while low < high:
        middle = (low + high + 1) // 2
        if equal_spans(a, i, b, j, middle):
            low = middle
        else:
            high = middle - 1
    return low


def fingerprint(text: str) -> str:
    """`length.whole.prefixes.suffixes.inner`: hexadecimal numbers, and in base 64 24-bit hashes, shortest first, and inner spans in order.

    An inner span is its 24-bit hash and, in the byte above, its length.
    """
    hashes = PrefixHashes(text)
    n = hashes.n
    rungs = LADDER[: np.searchsorted(LADDER, n, side="right")]
    zeros = np.zeros(len(rungs), np.int64)
    borders = hashes.borders()
    start = np.concatenate([[0], zeros, n - rungs, borders[:-1]])
    end = np.concatenate([[n], rungs, zeros + n, borders[1:]])
    found = hashes.spans(start, end)
    short = (found[1:] ^ found[1:] >> np.uint64(31)).astype("<u4").view(np.uint8).reshape(-1, 4)
    short[2 * len(rungs) :, 3] = np.diff(borders)
    parts = short[: len(rungs), :3], short[len(rungs) : 2 * len(rungs), :3], short[2 * len(rungs) :]
    return f"{n:x}.{int(found[0]):016x}." + ".".join(base64.b64encode(x.tobytes()).decode() for x in parts)


def _shared(a: str, b: str) -> int:
    """The longest rung whose hashes agree; four characters of base 64 hold one rung's three bytes."""
    low, high = 0, min(len(a), len(b)) // 4
    while low < high:
        middle = (low + high + 1) // 2
        if a[4 * middle - 4 : 4 * middle] == b[4 * middle - 4 : 4 * middle]:
            low = middle
        else:
            high = middle - 1
    return int(LADDER[low - 1]) if low else 0


def _inner(part: str, begin: int, end: int) -> tuple[np.ndarray, np.ndarray]:
    """Inner spans that are not wholly outside [begin, end): keys of span and repeat, and how much of each is inside, the most first."""
    spans = np.frombuffer(base64.b64decode(part), "<u4").astype(np.int64)
    sizes = spans >> 24
    stops = np.cumsum(sizes)
    inside = np.minimum(stops, end) - np.maximum(stops - sizes, begin)
    spans, inside = spans[inside > 0], inside[inside > 0]
    order = np.lexsort((-inside, spans))
    spans, inside = spans[order], inside[order]
    return spans << 31 | np.arange(len(spans)) - np.searchsorted(spans, spans), inside


def likeness(a: str, b: str) -> float:
    """The share of the longer text that the texts of two fingerprints have in common: beginnings, ends, and inner spans between them.

    An inner span counts as often as both texts hold it, wherever it is.
    """
    if a == b:
        return 1.0
    (n, _, *own), (m, _, *others) = a.split("."), b.split(".")
    lengths = int(n, 16), int(m, 16)
    sizes = sorted(lengths)
    if not sizes[0]:
        return 0.0
    first, last = (_shared(x, y) for x, y in zip(own[:2], others[:2], strict=True))
    shared = min(sizes[0], first + last)
    if shared < sizes[0]:
        (keys, mine), (other_keys, theirs) = (_inner(x[2], first, length - last) for x, length in zip((own, others), lengths, strict=True))
        _, i, j = np.intersect1d(keys, other_keys, assume_unique=True, return_indices=True)
        shared = min(sizes[0], shared + int(np.minimum(mine[i], theirs[j]).sum()))
    return shared / sizes[1] if shared < sizes[1] else (sizes[1] - 1) / sizes[1]


def edited(text: str, following: str) -> str:
    """The text with its last third replaced by as much of the following one's beginning."""
    third = len(text) // 3
    return text[: len(text) - third] + following[:third]


def in_turn(docs: DataFrame, cells: int) -> DataFrame:
    """docs (doc_id, text) in cells, each in descending doc_id order and closed by the row that follows its last.

    Adds `_cell` and `_extra` (true for a closing row); the row after the lowest
    doc_id is the one of the highest. The borders of cells, which decide only how
    even they are, are quantiles of a sample of some BORDER_IDS ids for each cell.
    Only cells go by the id as a double; ids that round to one double share a cell,
    and within it the whole id decides.
    """
    from pyspark.ml.feature import Bucketizer

    spark = docs.sparkSession
    keyed = docs.select(F.col("doc_id").cast("long"), F.coalesce("text", F.lit("")).alias("text"))
    keyed = keyed.withColumn("_key", F.coalesce("doc_id", F.lit(-(2**63))).cast("double"))
    share = min(1.0, BORDER_IDS * cells / max(1, docs.count()))
    seen = [r["_key"] for r in keyed.select("_key").sample(share, seed=1).collect()]
    borders = np.quantile(seen, [k / cells for k in range(1, cells)], method="nearest").tolist() if seen and cells > 1 else []
    splits = [float("-inf"), *sorted({b for b in borders if b > -9e18}), float("inf")]
    if len(splits) > 2:
        celled = Bucketizer(splits=splits, inputCol="_key", outputCol="_cell").transform(keyed)
    else:
        celled = keyed.withColumn("_cell", F.lit(0.0))
    # Nulls are in the lowest cell; where it has no other ids its head is null.
    heads = sorted(((r["_cell"], r["head"]) for r in celled.groupBy("_cell").agg(F.max("doc_id").alias("head")).collect()), reverse=True)
    following = [(cell, heads[(i + 1) % len(heads)][1]) for i, (cell, _) in enumerate(heads)]
    # One id a cell: bounded by `cells`.
    closing = F.broadcast(spark.createDataFrame(following, "_cell double, _head long"))
    extra = keyed.join(closing, F.col("doc_id").eqNullSafe(F.col("_head"))).drop("_head").withColumn("_extra", F.lit(True))
    return celled.withColumn("_extra", F.lit(False)).unionByName(extra)


def fingerprints(docs: DataFrame, cells: int | None = None) -> DataFrame:
    """Fingerprints of every text and of its edited text, and their likeness to each other and to the next document's.

    docs: doc_id, text. The next document has the next lower doc_id, and the
    highest follows the lowest; a lone document follows itself. A null text is
    empty, a null doc_id comes last, rows of one doc_id follow each other by text.
    `cells` bounds the ids brought to the driver; default: four for each shuffle partition.
    """
    cells = cells or 4 * int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: tuple | None = None  # the last row, which its follower completes
        for batch in slices(batches, "text", 1 << 20):
            rows: list[tuple] = []
            columns = [batch.column(c).to_pylist() for c in ("doc_id", "_cell", "_extra")]
            for doc_id, cell, extra, text in zip(*columns, texts_of(batch).to_pylist(), strict=True):
                if held and held[1] == cell and held[2]:
                    continue  # one closing row is enough
                own = fingerprint(text)
                if held and held[1] == cell:
                    changed = edited(held[3], text)
                    new = fingerprint(changed)
                    rows.append((held[0], len(held[3]), hashlib.sha256(changed.encode()).hexdigest(), held[4], new, likeness(held[4], new), likeness(held[4], own)))
                held = (doc_id, cell, extra, text, own)
            if rows:
                fields = [pa.field(n, {"long": pa.int64(), "string": pa.string(), "double": pa.float64()}[t]) for n, t in (x.split() for x in SCHEMA.split(", "))]
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), fields, strict=True)], schema=pa.schema(fields))

    ordered = in_turn(docs, cells).repartition("_cell").sortWithinPartitions("_cell", "_extra", F.col("doc_id").desc_nulls_last(), "text")
    return ordered.select("doc_id", "_cell", "_extra", "text").mapInArrow(compare, SCHEMA)
