"""A lexicon of frequent words as a minimal acyclic transducer.

Equal suffixes share their states. Every arc carries how many words sort before
those beyond it, and the sum of a word's arcs is its number, which finds its ids.
A file of the lexicon is read as mapped memory; many words walk it at a time.
"""

from __future__ import annotations

import struct
from collections.abc import Iterable

import numpy as np

MAGIC = b"LEX1"
_TYPES = ("<i8", "<i4", "<i4", "<u1", "<i8", "<u4")  # arc keys, targets, outputs, final states, starts of ids, ids


def compile_lexicon(entries: Iterable[tuple[bytes, list[int]]]) -> bytes:
    """The file of sorted, distinct, non-empty words with their ids."""
    # A state is (final, ((byte, state), ...)); equal states are one. Words come sorted,
    # so the states of a word beyond what the next one shares with it are finished.
    known: dict[tuple, int] = {}
    arcs: list[tuple] = []
    path: list[list] = [[False, []]]  # open states of the last word: final, finished arcs
    last = b""

    def close(depth: int) -> None:
        while len(path) > depth + 1:
            final, own = path.pop()
            state = known.setdefault((final, tuple(own)), len(known))
            if state == len(arcs):
                arcs.append((final, own))
            path[-1][1].append((last[len(path) - 1], state))

    ids: list[list[int]] = []
    for word, own in entries:
        shared = next((i for i, (a, b) in enumerate(zip(last, word, strict=False)) if a != b), min(len(last), len(word)))
        close(shared)
        path.extend([False, []] for _ in word[shared:])
        path[-1][0] = True
        last = word
        ids.append(own)
    close(0)
    arcs.append((path[0][0], path[0][1]))  # the root is the last state

    words = np.zeros(len(arcs), np.int64)
    keys, targets, outputs = [], [], []
    for state, (final, own) in enumerate(arcs):  # targets come before their sources
        count = int(final)
        for byte, target in own:
            keys.append(state << 8 | byte)
            targets.append(target)
            outputs.append(count)
            count += int(words[target])
        words[state] = count
    starts = np.cumsum([0, *map(len, ids)])
    flat = [x for own in ids for x in own]
    parts = [np.array(x, t) for x, t in zip((keys, targets, outputs, [a[0] for a in arcs], starts, flat), _TYPES, strict=True)]
    head = struct.pack("<4sI6q", MAGIC, 0, *map(len, parts))
    return head + b"".join(p.tobytes() + b"\0" * (-p.nbytes % 8) for p in parts)


class Lexicon:
    """A compiled lexicon, mapped from its file."""

    def __init__(self, path: str) -> None:
        whole = np.memmap(path, np.uint8, "r")
        magic, _, *sizes = struct.unpack_from("<4sI6q", whole)
        if magic != MAGIC:
            raise ValueError(f"{path} is no lexicon")
        at, parts = struct.calcsize("<4sI6q"), []
        for size, kind in zip(sizes, _TYPES, strict=True):
            step = size * np.dtype(kind).itemsize
            parts.append(whole[at : at + step].view(kind))
            at += step + -step % 8
        self._keys, self._targets, self._outputs, self._final, self.starts, self.ids = parts

    def __len__(self) -> int:
        return len(self.starts) - 1

    def find(self, data: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """The numbers of the words data[start : start + length]; -1 where the lexicon has no such word."""
        found = np.full(len(starts), -1, np.int64)
        if not len(self._keys):
            return found
        live = np.flatnonzero(lengths > 0)
        state = np.full(len(live), len(self._final) - 1, np.int64)
        number = np.zeros(len(live), np.int64)
        step = 0
        while len(live):
            key = state << 8 | data[starts[live] + step]
            arc = np.minimum(np.searchsorted(self._keys, key), len(self._keys) - 1)
            known = self._keys[arc] == key
            live, arc = live[known], arc[known]
            state, number = self._targets[arc].astype(np.int64), number[known] + self._outputs[arc]
            step += 1
            ended = lengths[live] == step
            right = ended & (self._final[state] == 1)
            found[live[right]] = number[right]
            live, state, number = live[~ended], state[~ended], number[~ended]
        return found
