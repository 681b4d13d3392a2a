"""Document quality by a linear-chain conditional random field over lines.

Every line is described by its mix of characters, its words and its place, and
so are the lines before and after it. The field labels lines good or bad; its
marginals, by forward and backward messages, are averaged over a document with
the lines' lengths as weights, and a logistic curve turns that into a score.

With two labels a message is one number, the log-odds, so a step along the
chains of many documents is a handful of array operations.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import checkpointed, slices, texts_of

SCHEMA = "doc_id long, held_out boolean, score double, predicted int, n_lines int, bad_lines int"
#: Bounds of the sample that the field is fitted on: labelled rows, and lines of all of them; a row takes part with all its lines or not at all.
SAMPLE_ROWS = 6_000
SAMPLE_LINES = 250_000
THRESHOLD = 0.3

_CLASSES = ("abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789", " \t\r", ".,;:?'\"-", "!", "|", "#$%&*+/<=>@\\^_`{}~[]()")


def _class_of_bytes() -> np.ndarray:
    """0 for bytes beyond ASCII and controls, else the number of the class."""
    table = np.zeros(256, np.uint8)
    for k, letters in enumerate(_CLASSES, 1):
        table[[ord(c) for c in letters]] = k
    return table


_CLASS = _class_of_bytes()


def line_features(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Features of all lines with those of their neighbours, the lines' bytes, and where each text's lines start."""
    split = pc.split_pattern(texts, "\n")
    lines, at = split.flatten(), (split.offsets.to_numpy() - split.offsets[0].as_py()).astype(np.int64)
    n = len(lines)
    offsets = np.frombuffer(lines.buffers()[1], np.int32, n + 1, lines.offset * 4).astype(np.int64)
    data = np.frombuffer(lines.buffers()[2] or b"", np.uint8)[offsets[0] : offsets[-1]]
    sizes = np.diff(offsets)
    kinds = _CLASS[data]
    counts = np.zeros((n, len(_CLASSES) + 1))
    full = np.flatnonzero(sizes > 0)
    if len(full):
        starts = (offsets[:-1] - offsets[0])[full]
        for k in range(len(_CLASSES) + 1):
            counts[full, k] = np.add.reduceat(kinds == k, starts, dtype=np.int64)
    words = pc.split_pattern(lines, " ")
    ends = words.offsets.to_numpy().astype(np.int64) - words.offsets[0].as_py()
    place = words.flatten().dictionary_encode().indices.to_numpy()
    n_words = np.diff(ends)
    same = np.concatenate([[0], np.cumsum(place[1:] == place[:-1])]) if len(place) else np.zeros(1)
    twice = np.where(n_words > 1, same[np.maximum(ends[1:] - 1, 0)] - same[np.minimum(ends[:-1], max(len(same) - 1, 0))], 0)
    doc = np.repeat(np.arange(len(texts)), np.diff(at))
    code = doc * (np.int64(n) + 1) + lines.dictionary_encode().indices.to_numpy()
    _, which, times = np.unique(code, return_inverse=True, return_counts=True)
    share = counts / np.maximum(sizes, 1)[:, None]
    own = np.column_stack([
        share,
        np.minimum(share, 0.08) * 12,  # a small share of symbols tells as much as a large one
        twice / np.maximum(n_words - 1, 1),
        np.log1p(sizes),
        sizes / np.maximum(n_words, 1) / 10,
        (sizes == 0),
        (times[which] > 1) & (sizes > 0),
    ]).astype(np.float64)
    first, last = np.zeros(n, bool), np.zeros(n, bool)
    first[at[:-1]], last[at[1:] - 1] = True, True
    before, after = np.zeros_like(own), np.zeros_like(own)
    before[1:], after[:-1] = own[:-1], own[1:]
    before[first], after[last] = 0, 0
    return np.column_stack([own, before, after, first, last]), sizes, at


@dataclass
class Field:
    """Weights over scaled features and a bias, log transition weights, and the curve from mean marginal to score."""

    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    steps: np.ndarray
    curve: np.ndarray

    def emissions(self, features: np.ndarray) -> np.ndarray:
        return (features - self.mean) / self.scale @ self.weights[:-1] + self.weights[-1]

    def score(self, mean_good: np.ndarray) -> np.ndarray:
        odds = np.log(np.clip(mean_good, 1e-6, 1 - 1e-6)) - np.log(1 - np.clip(mean_good, 1e-6, 1 - 1e-6))
        return 1 / (1 + np.exp(-(self.curve[0] * odds + self.curve[1])))


def messages(emissions: np.ndarray, at: np.ndarray, steps: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Per line the log-odds of being good: from the lines up to it, and from the lines beyond it.

    Chain k is emissions[at[k] : at[k + 1]]; steps[i, j] is the log weight of going from label i to j.
    """
    forward, backward = emissions.copy(), np.zeros(len(emissions))
    sizes = np.diff(at)
    order = np.argsort(-sizes, kind="stable")
    starts, lengths = at[:-1][order], sizes[order]
    longest = int(lengths[0]) if len(lengths) else 0
    live = np.searchsorted(-lengths, -np.arange(1, longest + 1), side="right")  # chains with more than t lines
    for t in range(1, longest):
        here = starts[: live[t]] + t
        odds = forward[here - 1]
        forward[here] += np.logaddexp(steps[0, 1], steps[1, 1] + odds) - np.logaddexp(steps[0, 0], steps[1, 0] + odds)
    for t in range(longest - 2, -1, -1):
        here = starts[: live[t + 1]] + t
        odds = emissions[here + 1] + backward[here + 1]
        backward[here] = np.logaddexp(steps[1, 0], steps[1, 1] + odds) - np.logaddexp(steps[0, 0], steps[0, 1] + odds)
    return forward, backward


def marginals(emissions: np.ndarray, at: np.ndarray, steps: np.ndarray) -> np.ndarray:
    forward, backward = messages(emissions, at, steps)
    return 1 / (1 + np.exp(-np.clip(forward + backward, -40, 40)))


def document_means(good: np.ndarray, sizes: np.ndarray, at: np.ndarray) -> np.ndarray:
    """The mean of the marginals of each document's lines, weighted by length; every line counts a little."""
    weight = sizes + 1.0
    return np.add.reduceat(good * weight, at[:-1]) / np.add.reduceat(weight, at[:-1])


def _ascend(start: np.ndarray, gradient, rounds: int, rate: float) -> np.ndarray:
    """Gradient ascent with running means of the gradient and its square."""
    x, m, v = start.copy(), np.zeros_like(start), np.zeros_like(start)
    for k in range(1, rounds + 1):
        g = gradient(x)
        m, v = 0.9 * m + 0.1 * g, 0.99 * v + 0.01 * g * g
        x += rate * (m / (1 - 0.9**k)) / (np.sqrt(v / (1 - 0.99**k)) + 1e-8)
    return x


def fit(chains: list[tuple[int, np.ndarray, np.ndarray]], rounds: int = 150) -> Field | None:
    """A field from (label, features of the lines, bytes of the lines) of documents; None without both labels."""
    if len({label for label, _, _ in chains}) < 2:
        return None
    features = np.concatenate([x for _, x, _ in chains])
    sizes = np.concatenate([s for _, _, s in chains])
    at = np.cumsum([0, *(len(s) for _, _, s in chains)])
    labels = np.array([label for label, _, _ in chains], float)
    truth = np.repeat(labels, np.diff(at))
    mean, scale = features.mean(0), features.std(0)
    scale[scale < 1e-6] = 1.0
    x = np.column_stack([(features - mean) / scale, np.ones(len(features))])
    inner = np.setdiff1d(np.arange(len(truth) - 1), at[1:-1] - 1)  # lines with a next one
    seen = np.zeros((2, 2))
    np.add.at(seen, (truth[inner].astype(int), truth[inner + 1].astype(int)), 1)
    # A document counts about the same whatever its lines.
    weight = 1 / np.sqrt(np.repeat(np.diff(at), np.diff(at)))

    def gradient(theta: np.ndarray) -> np.ndarray:
        weights, steps = theta[:-4], theta[-4:].reshape(2, 2)
        emissions = x @ weights
        forward, backward = messages(emissions, at, steps)
        good = 1 / (1 + np.exp(-np.clip(forward + backward, -40, 40)))
        left, right = forward[inner], emissions[inner + 1] + backward[inner + 1]
        pair = np.stack([np.full(len(inner), steps[0, 0]), steps[0, 1] + right, steps[1, 0] + left, steps[1, 1] + left + right])
        pair = np.exp(pair - pair.max(0))
        pair = (pair / pair.sum(0)).sum(1).reshape(2, 2)
        n = len(truth)
        return np.concatenate([x.T @ (weight * (truth - good)) / n - 1e-3 * weights, (seen - pair).ravel() / n - 0.05 * steps.ravel()])

    theta = _ascend(np.zeros(x.shape[1] + 4), gradient, rounds, 0.1)
    field = Field(mean, scale, theta[:-4], theta[-4:].reshape(2, 2), np.array([1.0, 0.0]))
    means = np.clip(document_means(marginals(x @ theta[:-4], at, field.steps), sizes, at), 1e-6, 1 - 1e-6)
    curve_x = np.column_stack([np.log(means) - np.log(1 - means), np.ones(len(means))])
    field.curve = _ascend(np.array([1.0, 0.0]), lambda c: curve_x.T @ (labels - 1 / (1 + np.exp(-curve_x @ c))) / len(labels) - np.array([1e-3 * (c[0] - 1), 0]), 300, 0.05)
    return field


def _held_out() -> F.Column:
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0, F.lit(False))


def train(docs: DataFrame, labels: DataFrame, rows: int = SAMPLE_ROWS, lines: int = SAMPLE_LINES) -> Field | None:
    """Fit the field on at most `rows` labelled texts that aren't held out, in the order of a hash of doc_id.

    Texts are whole: of those rows, the first that have `lines` lines in all take
    part, without any that is longer than a tenth of that, so what comes to the
    driver is bounded. Lines carry their text's label.
    """
    known = labels.filter("doc_id IS NOT NULL AND quality IN (0, 1)").groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.min("quality").alias("quality"))
    sample = known.filter(~_held_out()).orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows)
    count = F.length("text") - F.length(F.replace("text", F.lit("\n"), F.lit(""))) + 1
    found = docs.select(F.col("doc_id").cast("long"), "text").join(F.broadcast(sample), "doc_id").dropDuplicates(["doc_id"])
    # Of at most `rows` rows.
    sized = checkpointed(found.select("doc_id", "text", "quality", F.coalesce(count, F.lit(1)).alias("lines")).filter(F.col("lines") <= lines // 10))
    before = F.sum("lines").over(Window.orderBy(F.xxhash64("doc_id"), "doc_id"))
    chosen = sized.select("doc_id", "lines").select("doc_id", before.alias("until")).filter(F.col("until") <= lines).select("doc_id")

    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            features, sizes, at = line_features(texts_of(batch))
            parts = [slice(a, b) for a, b in zip(at[:-1], at[1:], strict=True)]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    batch.column("quality").cast(pa.int32()),
                    pa.array([features[p].astype("<f4").tobytes() for p in parts], pa.binary()),
                    pa.array([sizes[p].astype("<i8").tobytes() for p in parts], pa.binary()),
                ],
                names=["doc_id", "label", "features", "sizes"],
            )

    picked = sized.join(F.broadcast(chosen), "doc_id", "left_semi").select("doc_id", "text", "quality")
    rows_ = picked.mapInArrow(describe, "doc_id long, label int, features binary, sizes binary").orderBy("doc_id").collect()
    parts = [(r["label"], np.frombuffer(r["sizes"], "<i8"), np.frombuffer(r["features"], "<f4").astype(float)) for r in rows_]
    return fit([(label, x.reshape(len(sizes), -1), sizes) for label, sizes, x in parts])


def score_quality(docs: DataFrame, field: Field | None, threshold: float = THRESHOLD) -> DataFrame:
    """Per row of docs (doc_id, text): doc_id, held_out, score, predicted, n_lines, bad_lines.

    A null or empty text is one empty line; repeated rows are scored again; a null
    doc_id is not held out. Without a field (no labels of both kinds) the score is 0.5.
    """
    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            features, sizes, at = line_features(texts_of(batch))
            good = marginals(field.emissions(features), at, field.steps) if field else np.full(len(sizes), 0.5)
            scores = field.score(document_means(good, sizes, at)) if field else np.full(batch.num_rows, 0.5)
            ids = batch.column("doc_id").to_pylist()
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pa.array([i is not None and zlib.crc32(str(i).encode()) % 5 == 0 for i in ids], pa.bool_()),
                    pa.array(scores, pa.float64()),
                    pa.array((scores >= threshold).astype(np.int32)),
                    pa.array(np.diff(at).astype(np.int32)),
                    pa.array(np.add.reduceat(good < 0.5, at[:-1], dtype=np.int64).astype(np.int32)),
                ],
                names=[c.split()[0] for c in SCHEMA.split(", ")],
            )

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(score, SCHEMA)


def good_documents(docs: DataFrame, field: Field | None, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of docs, all columns, whose text scores at least `threshold`; all of them without a field."""
    if field is None:
        return docs

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            features, sizes, at = line_features(texts_of(batch))
            scores = field.score(document_means(marginals(field.emissions(features), at, field.steps), sizes, at))
            yield batch.filter(pa.array(scores >= threshold))

    return docs.mapInArrow(keep, docs.schema)
