"""Byte-level BPE: encoding with a lexicon of frequent words and exact merges, and decoding.

A text is cut before its spaces into pieces; a piece is a word with its leading
space and trailing punctuation. Cutting there never changes the ids, except at a
space between white space and white space or the end: texts that have one, or
the separator, or a special token, are cut by the vocabulary's pattern alone.

The most frequent pieces of the whole corpus, counted by Spark, are compiled
with their ids into a lexicon, which executors map from a file. All other pieces
are cut by the pattern and merged pair by pair in the order of the vocabulary's
merges, many words at a time.
"""

from __future__ import annotations

import hashlib
import heapq
import json as jsonlib
from array import array
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark import SparkFiles
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import checkpointed, shared_folder, slices, texts_of
from .lexicon import Lexicon, compile_lexicon
from .word_ids import tokenizer_json

SCHEMA = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
LEXICON_WORDS = 65_536
MAX_PIECES = 400_000
LONG_WORD = 48
_SPACE = r"\t\n\x0b\f\r \x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
_WHOLE = rf"\x00|[{_SPACE}] ([{_SPACE}]|\z)"
# Fixed value: the pattern by which this kind of vocabulary separates words.
_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\p{White_Space}\p{L}\p{N}]+|\p{White_Space}+(?!\P{White_Space})|\p{White_Space}+"


def _byte_letters() -> list[str]:
    """The letter by which a vocabulary file writes each byte: printable Latin-1 as itself, the others from 256 on."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in printable]
    return [chr(b) if b in printable else chr(256 + others.index(b)) for b in range(256)]


class Vocabulary:
    """A byte-level BPE vocabulary: exact merges of words, and the bytes of ids."""

    def __init__(self, json: str) -> None:
        whole = jsonlib.loads(json)
        vocab = whole["model"]["vocab"]
        letters = _byte_letters()
        back = {c: b for b, c in enumerate(letters)}
        self.special = {t["content"]: t["id"] for t in whole["added_tokens"]}
        self.size = max([*vocab.values(), *self.special.values()]) + 1
        self._first = np.array([vocab[c] for c in letters], np.int64)
        merges = [m.split(" ") if isinstance(m, str) else m for m in whole["model"]["merges"]]
        keys = np.array([vocab[a] * self.size + vocab[b] for a, b in merges], np.int64)
        order = np.argsort(keys)
        self._keys, self._ranks = keys[order], order
        self._made = np.array([vocab[a + b] for a, b in merges], np.int64)
        of = [b""] * self.size
        for token, i in vocab.items():
            of[i] = bytes(back[c] for c in token)
        for token, i in self.special.items():
            of[i] = token.encode()
        self._bytes = np.frombuffer(b"".join(of), np.uint8)
        self._sizes = np.array([len(x) for x in of], np.int64)
        self._starts = np.cumsum(self._sizes) - self._sizes
        self._rank_of = dict(zip(keys.tolist(), range(len(keys)), strict=True))
        self._pattern = regex.compile(_PATTERN)
        self._split = regex.compile("(" + "|".join(map(regex.escape, self.special)) + ")") if self.special else None

    def _rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Ranks of the merges of pairs; len(merges) where there is none."""
        key = left * self.size + right
        at = np.minimum(np.searchsorted(self._keys, key), len(self._keys) - 1)
        return np.where((self._keys[at] == key) & (left >= 0) & (right >= 0), self._ranks[at], len(self._made))

    def _merge_long(self, word: bytes) -> list[int]:
        """One word by a heap of pairs."""
        ids = self._first[np.frombuffer(word, np.uint8)].tolist()
        n, none = len(ids), len(self._made)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        ranks = [self._rank_of.get(a * self.size + b, none) for a, b in zip(ids, ids[1:], strict=False)]
        heap = [(r, i, ids[i], ids[i + 1]) for i, r in enumerate(ranks) if r < none]
        heapq.heapify(heap)
        while heap:
            rank, i, a, b = heapq.heappop(heap)
            j = after[i]
            if ids[i] != a or j >= n or ids[j] != b:
                continue
            ids[i], ids[j], after[i] = int(self._made[rank]), -1, after[j]
            if after[i] < n:
                before[after[i]] = i
            for x, y in ((before[i], i), (i, after[i])):
                if x >= 0 and y < n:
                    new = self._rank_of.get(ids[x] * self.size + ids[y], none)
                    if new < none:
                        heapq.heappush(heap, (new, x, ids[x], ids[y]))
        return [i for i in ids if i >= 0]

    def _merge_equal(self, words: list[bytes], width: int) -> list[list[int]]:
        """Words of at most `width` bytes: each round merges every word's first pair of lowest rank."""
        n, none = len(words), len(self._made)
        sizes = np.array([len(w) for w in words])
        ids = np.full((n, width + 1), -1, np.int64)
        inside = np.arange(width + 1) < sizes[:, None]
        ids[inside] = self._first[np.frombuffer(b"".join(words), np.uint8)]
        ranks = np.full((n, width + 1), none, np.int64)
        ranks[:, :-1] = self._rank(ids[:, :-1], ids[:, 1:])
        after = np.tile(np.arange(1, width + 2), (n, 1))
        before = np.tile(np.arange(-1, width), (n, 1))
        rows = np.arange(n)
        while True:
            place = ranks[rows].argmin(1)
            rank = ranks[rows, place]
            on = rank < none
            rows, place, rank = rows[on], place[on], rank[on]
            if not len(rows):
                break
            gone = after[rows, place]
            beyond = np.minimum(after[rows, gone], width)
            ids[rows, place] = self._made[rank]
            ids[rows, gone], ranks[rows, gone] = -1, none
            after[rows, place] = beyond
            before[rows, beyond] = place
            ranks[rows, place] = self._rank(ids[rows, place], ids[rows, beyond])
            left = before[rows, place]
            has = left >= 0
            ranks[rows[has], left[has]] = self._rank(ids[rows[has], left[has]], ids[rows[has], place[has]])
        kept = ids >= 0
        flat, ends = ids[kept].tolist(), np.cumsum(kept.sum(1)).tolist()
        return [flat[a:b] for a, b in zip([0, *ends[:-1]], ends, strict=True)]

    def merge(self, words: list[bytes]) -> list[list[int]]:
        """The ids of words that the pattern does not cut."""
        out: list[list[int]] = [[]] * len(words)
        sizes = np.array([len(w) for w in words])
        for low, high in ((0, 8), (8, 16), (16, LONG_WORD)):
            own = np.flatnonzero((sizes > low) & (sizes <= high))
            for part in (own[k : k + 50_000] for k in range(0, len(own), 50_000)):
                for i, ids in zip(part, self._merge_equal([words[i] for i in part], high), strict=True):
                    out[i] = ids
        for i in np.flatnonzero(sizes > LONG_WORD):
            out[i] = self._merge_long(words[i])
        return out

    def encode_pieces(self, pieces: list[str]) -> list[list[int]]:
        cut = [self._pattern.findall(p) for p in pieces]
        distinct = {w: w.encode() for own in cut for w in own}
        ids = dict(zip(distinct, self.merge(list(distinct.values())), strict=True))
        return [list(chain.from_iterable(ids[w] for w in own)) for own in cut]

    def encode_whole(self, texts: list[str]) -> list[list[int]]:
        """Any texts, special tokens included."""
        parts = [self._split.split(t) if self._split else [t] for t in texts]
        ids = iter(self.encode_pieces([p for own in parts for p in own if p not in self.special]))
        return [list(chain.from_iterable([self.special[p]] if p in self.special else next(ids) for p in own)) for own in parts]

    def decode(self, ids: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The bytes of runs of ids (run k is ids[at[k] : at[k + 1]]) in a row, and where each run's bytes start."""
        sizes = self._sizes[ids]
        ends = np.concatenate([[0], np.cumsum(sizes)])
        where = np.repeat(self._starts[ids] - ends[:-1], sizes) + np.arange(ends[-1])
        return self._bytes[where], ends[at]


def cut(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """The pieces of texts in a row, and where each text's pieces start."""
    parts = pc.split_pattern(pc.replace_substring(texts, " ", "\0 "), "\0")
    return parts.flatten(), parts.offsets.to_numpy() - parts.offsets[0].as_py()


def to_be_cut_whole(texts: pa.Array, special: list[str]) -> pa.Array:
    found = pc.match_substring_regex(texts, _WHOLE)
    for token in special:
        found = pc.or_(found, pc.match_substring(texts, token))
    return found


class Encoder:
    """Encodes slices of texts with a lexicon; one per task."""

    def __init__(self, vocabulary: Vocabulary, lexicon: Lexicon) -> None:
        self._vocabulary, self._lexicon = vocabulary, lexicon
        self._forget()

    def _forget(self) -> None:
        self._slot: dict[str, int] = {}
        self._ids, self._count = array("I"), array("I")

    def _learn(self, pieces: list[str]) -> None:
        ids = self._vocabulary.encode_pieces(pieces)
        self._slot.update(zip(pieces, range(len(self._count), len(self._count) + len(pieces)), strict=True))
        self._count.extend(map(len, ids))
        self._ids.extend(chain.from_iterable(ids))

    def _pieces(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        flat, ends = cut(texts)
        coded = flat.dictionary_encode()
        words = coded.dictionary
        offsets = np.frombuffer(words.buffers()[1], np.int32, len(words) + 1, words.offset * 4).astype(np.int64)
        data = np.frombuffer(words.buffers()[2] or b"", np.uint8)
        lengths = np.diff(offsets)
        number = self._lexicon.find(data, offsets[:-1], lengths)
        unseen = np.flatnonzero(number < 0)
        rest = words.take(pa.array(unseen)).to_pylist()
        if len(self._slot) + len(rest) > MAX_PIECES or len(self._ids) > 8 * MAX_PIECES:
            self._forget()
        self._learn([p for p in rest if p not in self._slot])
        # The lexicon's ids come first, then those of the pieces that were merged here.
        known = np.concatenate([np.diff(self._lexicon.starts), np.array(self._count, np.int64)])
        number[unseen] = np.fromiter(map(self._slot.__getitem__, rest), np.int64, len(rest)) + len(self._lexicon)
        starts = np.cumsum(known) - known
        place = coded.indices.to_numpy()
        each = known[number][place]
        after = np.concatenate([[0], np.cumsum(each)])
        where = np.repeat(starts[number][place] - after[:-1], each) + np.arange(after[-1])
        ids = np.concatenate([self._lexicon.ids, np.array(self._ids, np.uint32)])
        return ids[where], after[ends]

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids in a row, and where each text's ids start (one more entry than texts)."""
        whole = to_be_cut_whole(texts, list(self._vocabulary.special))
        if not pc.any(whole).as_py():
            return self._pieces(texts)
        ids, at = self._pieces(pc.if_else(whole, "", texts))
        own = np.split(ids, at[1:-1])
        rows = np.flatnonzero(whole.to_numpy(zero_copy_only=False))
        for row, found in zip(rows, self._vocabulary.encode_whole(texts.filter(whole).to_pylist()), strict=True):
            own[row] = np.array(found, np.uint32)
        return np.concatenate(own), np.cumsum([0, *map(len, own)])


def frequent_pieces(docs: DataFrame, special: list[str], most: int = LEXICON_WORDS) -> list[str]:
    """The most frequent pieces of all texts: as many whole grades of frequency as `most` pieces allow.

    A grade is a sixteenth of a doubling. No more than `most` pieces come to the driver.
    """
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.Table] = []

        def summed() -> pa.Table:
            return pa.concat_tables(held).group_by("piece").aggregate([("n", "sum")]).rename_columns(["piece", "n"])

        for batch in slices(batches, "text"):
            texts = texts_of(batch)
            pieces, _ = cut(pc.if_else(to_be_cut_whole(texts, special), "", texts))
            counts = pc.value_counts(pieces)
            held.append(pa.table({"piece": counts.field(0), "n": counts.field(1)}))
            if sum(map(len, held)) > MAX_PIECES:  # a piece may be given in parts
                held[:] = [summed()]
                if len(held[0]) > MAX_PIECES // 2:
                    yield from held.pop().to_batches()
        if held:
            yield from summed().to_batches()

    counts = docs.select("text").mapInArrow(count, "piece string, n long").groupBy("piece").agg(F.sum("n").alias("n"))
    graded = checkpointed(counts.filter("piece <> '' AND n > 1").withColumn("grade", F.floor(F.log2("n") * 16)))
    # At most 16 rows for each doubling of the largest count.
    sizes = sorted(((r["grade"], r["count"]) for r in graded.groupBy("grade").count().collect()), reverse=True)
    taken, lowest = 0, None
    for grade, size in sizes:
        taken += size
        if taken > most:
            break
        lowest = grade
    if lowest is None:
        return []
    return [r["piece"] for r in graded.filter(F.col("grade") >= lowest).select("piece").collect()]


def share_file(spark: SparkSession, data: bytes, name: str) -> str:
    """Write data into the shared folder and hand it to every executor; returns the name that SparkFiles knows."""
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(shared_folder(spark, name))
    out = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).create(path)
    out.write(data)
    out.close()
    spark.sparkContext.addFile(path.toString())
    return path.getName()


def encode_and_decode(docs: DataFrame, tokenizer: str, lexicon_words: int = LEXICON_WORDS) -> DataFrame:
    """Per row of docs (doc_id, text): its ids and what they decode to, as digests.

    A null text is empty; repeated rows give repeated results; no rows give none.
    """
    return _each(docs, tokenizer, lexicon_words, digests=True)


def encoded(docs: DataFrame, tokenizer: str, lexicon_words: int = LEXICON_WORDS) -> DataFrame:
    """Per row of docs (doc_id, text): doc_id, ids and the text they decode to."""
    return _each(docs, tokenizer, lexicon_words, digests=False)


def _each(docs: DataFrame, tokenizer: str, lexicon_words: int, digests: bool) -> DataFrame:
    spark, json = docs.sparkSession, tokenizer_json(tokenizer)
    vocabulary = Vocabulary(json)
    words = sorted((p.encode(), p) for p in frequent_pieces(docs, list(vocabulary.special), lexicon_words))
    ids = vocabulary.encode_pieces([p for _, p in words])
    name = share_file(spark, compile_lexicon(zip((w for w, _ in words), ids, strict=True)), "lexicon")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = Vocabulary(json)
        encoder = Encoder(vocabulary, Lexicon(SparkFiles.get(name)))
        for batch in slices(batches, "text", 4 << 20):
            ids, at = encoder.encode(texts_of(batch))
            data, to = vocabulary.decode(ids, at)
            runs = [ids[a:b].astype("<u4") for a, b in zip(at[:-1], at[1:], strict=True)]
            texts = [data[a:b].tobytes().decode("utf-8", "replace") for a, b in zip(to[:-1], to[1:], strict=True)]
            columns = {"doc_id": batch.column("doc_id")}
            if digests:
                columns["n_tokens"] = pa.array(np.diff(at).astype(np.int64))
                columns["ids_sha256"] = pa.array([hashlib.sha256(r.tobytes()).hexdigest() for r in runs])
                columns["decoded_sha256"] = pa.array([hashlib.sha256(t.encode()).hexdigest() for t in texts])
            else:
                columns |= {"ids": pa.array([r.astype(np.int32) for r in runs], pa.list_(pa.int32())), "decoded": pa.array(texts, pa.string())}
            yield pa.RecordBatch.from_arrays([*columns.values()], names=[*columns])

    schema = SCHEMA if digests else "doc_id long, ids array<int>, decoded string"
    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, schema)
