"""Words of texts as 64-bit hashes, and the hashes of their runs.

A word is a run of characters other than the space and the controls 9 to 13,
with A to Z lower-cased. Hashes do not depend on the process that makes them.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash

_SPACES = "\t\n\x0b\x0c\r"
_ODD = np.uint64(0x9E3779B97F4A7C15)
_MIX = (np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB))


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values in which every bit of the input reaches every bit of the output."""
    x = (x ^ (x >> np.uint64(30))) * _MIX[0]
    x = (x ^ (x >> np.uint64(27))) * _MIX[1]
    return x ^ (x >> np.uint64(31))


def word_hashes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The words' hashes in a row, and where each text's words start (one more entry than texts)."""
    flat = pc.ascii_lower(texts)
    for space in _SPACES:
        flat = pc.replace_substring(flat, space, " ")
    parts = pc.split_pattern(flat, " ")
    ends = parts.offsets.to_numpy() - parts.offsets[0].as_py()
    coded = parts.flatten().dictionary_encode()
    distinct = coded.dictionary.to_pylist()
    codes = np.fromiter(map(xxhash.xxh3_64_intdigest, distinct), np.uint64, len(distinct))
    filled = np.fromiter(map(bool, distinct), bool, len(distinct))
    place = coded.indices.to_numpy()
    keep = filled[place] if len(place) else np.zeros(0, bool)
    before = np.zeros(len(keep) + 1, np.int64)
    np.cumsum(keep, out=before[1:])
    return codes[place[keep]] if len(place) else np.zeros(0, np.uint64), before[ends]


def runs(hashes: np.ndarray, at: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of n words within a text, in order, and the text of each."""
    last = len(hashes) - n + 1
    if last <= 0:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    text = np.repeat(np.arange(len(at) - 1), np.diff(at))
    inside = text[:last] == text[n - 1 :]
    out = np.full(last, np.uint64(n))
    for k in range(n):
        out = mixed(out + _ODD) ^ hashes[k : k + last]
    return mixed(out)[inside], text[:last][inside]
