"""Ids of whole texts by the tokenizers library, one library call per distinct word.

The vocabulary with word ends drops white space and never merges across it, so
the ids of a text are the ids of its words in a row. Arrow lower-cases A to Z,
splits a slice of texts at spaces and line breaks, and numbers the distinct
words; the library encodes those that a bounded cache does not hold.

Punctuation at a word's end, without the apostrophe, is a word of its own: the
library's pattern separates it from a letter too. A word of lower-case Latin
letters needs no normaliser, so a second tokenizer without one encodes it.
Texts that may hold a special token, or a combining mark (whose letter must be
composed before its case is folded), go through the library unchanged.
"""

from __future__ import annotations

import os
import re
from array import array
from itertools import chain
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from .common import kept_between_tasks

# Latin-1 letters: canonical composition leaves them alone.
_PLAIN = re.compile(r"[a-zß-öø-ÿ]+")
_TAIL = r"([a-zß-öø-ÿ])([!-&(-/:-@\[-`{-~]+)( |$)"
_WHOLE = "<\\||[\u0300-\u036f]"
MAX_WORDS = 400_000
MAX_IDS = 2_000_000
LEARN_WORDS = 8_192


def tokenizer_json(path: str) -> str:
    return Path(path).read_text(encoding="utf-8")


def word_encoder(json: str) -> WordEncoder:
    """This process's encoder: what a worker has learnt serves its next tasks too, until it does other work.

    At most one vocabulary is held.
    """
    kept = kept_between_tasks()
    if getattr(kept, "json", None) != json:
        kept.json, kept.encoder = json, WordEncoder(json)
    return kept.encoder


class WordEncoder:
    """Encodes slices of texts."""

    def __init__(self, json: str) -> None:
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer, normalizers, pre_tokenizers

        self._full = Tokenizer.from_str(json)
        self._bare = Tokenizer.from_str(json)
        for tokenizer in (self._full, self._bare):
            tokenizer.no_truncation()
            tokenizer.no_padding()
        self._bare.normalizer = normalizers.Sequence([])
        self._bare.pre_tokenizer = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        self._forget()

    def _forget(self) -> None:
        self._slot: dict[str, int] = {}
        self._ids, self._count = array("I"), array("I")

    def _learn(self, words: list[str]) -> None:
        plain = [w for w in words if _PLAIN.fullmatch(w)]
        others = [w for w in words if not _PLAIN.fullmatch(w)]
        for tokenizer, own in ((self._bare, plain), (self._full, others)):
            # The library's objects for a word take far more than its ids, so few are held at once.
            for part in (own[i : i + LEARN_WORDS] for i in range(0, len(own), LEARN_WORDS)):
                # One array of ids for all words, and how many each has: the cache holds no lists.
                ids = [e.ids for e in tokenizer.encode_batch_fast(part, add_special_tokens=False)]
                first = len(self._count)
                self._slot.update(zip(part, range(first, first + len(part)), strict=True))
                self._count.extend(map(len, ids))
                self._ids.extend(chain.from_iterable(ids))

    def _words(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        flat = pc.replace_substring(pc.ascii_lower(texts), "\n", " ")
        words = pc.split_pattern(pc.replace_substring_regex(flat, _TAIL, r"\1 \2 "), " ")
        ends = words.offsets.to_numpy() - words.offsets[0].as_py()
        coded = words.flatten().dictionary_encode()
        distinct = coded.dictionary.to_pylist()
        if len(self._slot) + len(distinct) > MAX_WORDS or len(self._ids) > MAX_IDS:
            self._forget()
        self._learn([w for w in distinct if w not in self._slot])
        slots = np.fromiter(map(self._slot.__getitem__, distinct), np.int64, len(distinct))
        known = np.array(self._count, np.int32)
        # Within 2**31 ids a slice: a slice holds few texts or one.
        counts, starts = known[slots], (np.cumsum(known, dtype=np.int32) - known)[slots]
        place = coded.indices.to_numpy()
        each = counts[place]
        after = np.zeros(len(place) + 1, np.int32)
        np.cumsum(each, out=after[1:])
        where = np.repeat(starts[place] - after[:-1], each)
        where += np.arange(after[-1], dtype=np.int32)
        return np.array(self._ids, np.uint32)[where] if after[-1] else np.zeros(0, np.uint32), after[ends]

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids in a row (uint32), and where each text's ids start (one more entry than texts)."""
        whole = pc.match_substring_regex(texts, _WHOLE)
        if not pc.any(whole).as_py():
            return self._words(texts)
        ids, at = self._words(pc.if_else(whole, "", texts))
        runs = np.split(ids, at[1:-1])
        for row in np.flatnonzero(whole.to_numpy(zero_copy_only=False)):
            runs[row] = np.array(self._full.encode(texts[int(row)].as_py(), add_special_tokens=False).ids, np.uint32)
        return np.concatenate(runs), np.cumsum([0, *map(len, runs)])
