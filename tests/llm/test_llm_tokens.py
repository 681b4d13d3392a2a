"""Encoding, packing and token files against the library and a plain packing."""

import hashlib
import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from tidegauge.llm import bpe, packing, token_files, word_ids
from tidegauge.llm.lexicon import Lexicon, compile_lexicon
from tidegauge.llm.queries import BYTE_BPE, WORD_BPE

LETTERS = list("abzABZéÉßẞÿŸİıſKσΣς'.,!$*- \n\t\r\x0b\x1c\x85\xa0　<|>0123½Ⅷ中文字̱́̊🎉\0")
PARTS = ["<|endoftext|>", "<|startoftext|>", "<|EndOfText|>", "'s", "'ll", "'RE", "th", "ing", "don't", " ", "the.", "  ", " \n"]
ROWS = [(3, "Hello there, world."), (1, None), (2, ""), (2, ""), (None, "no id here"), (9, "word " * 3000), (7, "x" * 5000), (5, "the the the")]


def texts(n, seed=1):
    draw = random.Random(seed)
    return ["".join(draw.choices(LETTERS + PARTS, k=draw.randint(0, 40))) for _ in range(n)] + ["", "H̱ ab", "ab" * 30_000]


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


def test_word_ids_are_the_library_s():
    given = texts(4000)
    ids, at = word_ids.WordEncoder(word_ids.tokenizer_json(WORD_BPE)).encode(pa.array(given))
    for i, e in enumerate(Tokenizer.from_file(WORD_BPE).encode_batch(given, add_special_tokens=False)):
        assert ids[at[i] : at[i + 1]].tolist() == e.ids, given[i]


def test_byte_ids_are_the_library_s(tmp_path):
    given, library = texts(4000), Tokenizer.from_file(BYTE_BPE)
    vocabulary = bpe.Vocabulary(word_ids.tokenizer_json(BYTE_BPE))
    words = sorted({w.encode() for t in texts(300, 2) for w in bpe.cut(pa.array([t]))[0].to_pylist() if w})
    path = tmp_path / "lexicon"
    path.write_bytes(compile_lexicon(zip(words, vocabulary.encode_pieces([w.decode() for w in words]), strict=True)))
    ids, at = bpe.Encoder(vocabulary, Lexicon(str(path))).encode(pa.array(given))
    data, to = vocabulary.decode(ids, at)
    for i, e in enumerate(library.encode_batch(given, add_special_tokens=False)):
        assert ids[at[i] : at[i + 1]].tolist() == e.ids, given[i]
        assert data[to[i] : to[i + 1]].tobytes().decode() == library.decode(e.ids, skip_special_tokens=False)


def test_lexicon_numbers_words_and_shares_suffixes(tmp_path):
    words = sorted({(a + b).encode() for a in ("", "x", "yy", "zé") for b in ("king", "kings", "ring", "")} - {b""})
    path = tmp_path / "lexicon"
    path.write_bytes(compile_lexicon((w, [i, i + 1]) for i, w in enumerate(words)))
    lexicon = Lexicon(str(path))
    asked = [*words, b"kin", b"kingss", b"q", b""]
    data, sizes = np.frombuffer(b"".join(asked), np.uint8), np.array([len(w) for w in asked])
    assert lexicon.find(data, np.cumsum(sizes) - sizes, sizes).tolist() == [*range(len(words)), -1, -1, -1, -1]
    assert len(lexicon._final) < sum(map(len, words)) / 2
    path.write_bytes(compile_lexicon([]))
    assert Lexicon(str(path)).find(data, np.cumsum(sizes) - sizes, sizes).tolist() == [-1] * len(asked)


@pytest.mark.parametrize("rows", [ROWS, []])
def test_encode_and_decode(documents, rows):
    library = Tokenizer.from_file(BYTE_BPE)
    want = []
    for i, t in rows:
        ids = library.encode(t or "", add_special_tokens=False).ids
        want.append((i, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256((t or "").encode()).hexdigest()))
    got = [tuple(r) for r in bpe.encode_and_decode(documents(rows), BYTE_BPE).collect()]
    assert sorted(got, key=str) == sorted(want, key=str)
    assert {(r["doc_id"], r["decoded"]) for r in bpe.encoded(documents(rows), BYTE_BPE).collect()} == {(i, t or "") for i, t in rows}


@pytest.mark.parametrize("rows", [ROWS, []])
def test_pieces_and_packing(documents, rows):
    library = Tokenizer.from_file(WORD_BPE)
    want = []
    for i, t in rows:
        ids = [*library.encode(t or "", add_special_tokens=False).ids, 0]
        want += [(i, k, 64 * k, len(ids[64 * k : 64 * k + 64]), crc(ids[64 * k : 64 * k + 64])) for k in range(-(-len(ids) // 64))]
    got = packing.best_fit_pack(documents(rows), WORD_BPE, size=64).collect()
    assert sorted((tuple(r[c] for c in ("doc_id", "piece", "start", "length", "ids_crc32")) for r in got), key=str) == sorted(want, key=str)
    bins = {}
    for r in got:
        bins.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for parts in bins.values():
        ends = np.cumsum([n for _, n in sorted(parts)])
        assert [at for at, _ in sorted(parts)] == [0, *ends[:-1]] and ends[-1] <= 64


def test_packing_keeps_columns_named_like_its_own(spark):
    own = ["_cell", "_in", "_before", "_k", "_from", "_bin", "_offset"]
    rows = [(i, 0, 1 + i % 9, "s", *[f"{c}{i}" for c in own]) for i in range(30)]
    df = spark.createDataFrame(rows, "doc_id long, piece int, length long, sequence_id string, " + ", ".join(f"{c} string" for c in own))
    got = packing.pack(df, 10)
    assert sorted(got.columns) == sorted(["doc_id", "piece", "length", "sequence_id", "offset", *own])
    bins = {}
    for r in got.collect():
        assert [r[c] for c in own] == [f"{c}{r['doc_id']}" for c in own] and r["length"] == 1 + r["doc_id"] % 9
        bins.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    assert sum(map(len, bins.values())) == 30 and all(sum(n for _, n in b) <= 10 for b in bins.values())


def test_plan_fills_bins_and_uses_every_piece():
    draw = random.Random(4)
    for size in (10, 64, 2048):
        counts = {n: draw.randint(1, 60) for n in draw.sample(range(1, size + 1), min(size, 200))}
        plan = packing.bin_plan(counts, size)
        used = {}
        for chosen, repeat in plan:
            assert sum(chosen) <= size
            for n in chosen:
                used[n] = used.get(n, 0) + repeat
        assert used == counts
        bins, total = sum(r for _, r in plan), sum(n * c for n, c in counts.items())
        halves = sum(c for n, c in counts.items() if 2 * n > size)
        assert bins <= 1.05 * max(halves, -(-total // size)) + 1
    assert packing.fullest(np.array([0, 0, 0, 2, 0, 1, 0, 1]), 11) == [5, 3, 3]


def test_directly_addressable_codes():
    draw = np.random.default_rng(2)
    for n in (1, 511, 512, 513, 5000):
        ids = (draw.integers(0, 2**32, n) >> draw.integers(0, 32, n)).astype(np.uint32)
        reader = token_files.DacReader(token_files.dac_encode(ids))
        assert reader.all().tolist() == ids.tolist()
        assert [reader[i] for i in range(0, n, 7)] == ids[::7].tolist()
        with pytest.raises(IndexError):
            reader[n]
    assert len(token_files.DacReader(token_files.dac_encode(np.zeros(0, np.uint32)))) == 0


@pytest.mark.parametrize("rows", [ROWS, []])
def test_token_files_round_trip(spark, documents, tmp_path, rows):
    library = Tokenizer.from_file(WORD_BPE)
    token_files.write_token_files(documents(rows), str(tmp_path), WORD_BPE)
    got = sorted(token_files.read_token_files(spark, str(tmp_path)).collect(), key=lambda r: r["start"])
    ordered = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or ""))
    start = 0
    for r, (i, t) in zip(got, ordered, strict=True):
        ids = [*library.encode(t or "", add_special_tokens=False).ids, 1]
        assert (r["doc_id"], r["start"], r["n_tokens"], r["ids_crc32"], r["ids"]) == (i, start, len(ids), crc(ids), ids)
        start += len(ids)


def test_segments_are_numbered_within_parts(documents):
    rows = token_files.segments(documents([(i, f"word {i}") for i in range(50)]), WORD_BPE, segment_ids=12).collect()
    for part in {r["part"] for r in rows}:
        own = sorted((r for r in rows if r["part"] == part), key=lambda r: r["segment"])
        assert [r["segment"] for r in own] == list(range(len(own)))
        assert [r["before"] for r in own] == [sum(x["n_ids"] for x in own[:k]) for k in range(len(own))]
