"""Periodic runs, centroids and tiered packing against plain versions."""

import hashlib
import random
import zlib
from collections import defaultdict
from fractions import Fraction

import brute
import numpy as np
import pytest
from tokenizers import Tokenizer

from tidegauge.llm import centroids, periodic_runs, queries, tiered_packing
from tidegauge.llm.queries import WORD_BPE


def plain_runs(w):
    """(start, length, period) by the definition, from all lags."""
    out = []
    for q in range(1, len(w) // 4 + 1):
        i = 0
        while i + q < len(w):
            j = i
            while j + q < len(w) and w[j] == w[j + q]:
                j += 1
            length = j - i + q
            if length >= max(6, 4 * q) and not any(w[i : j + q - p] == w[i + p : j + q] for p in range(1, q)):
                out.append((i, length, q))
            i = j + 1
    return sorted(out, key=lambda r: (r[0], r[2]))


def plain_report(doc_id, text, plant):
    w = brute.WORD.findall(text or "")
    n = len(w)
    h = zlib.crc32(str(doc_id).encode())
    if plant and h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        w = w[:a] + [w[a + (i - a) % p] for i in range(a, n)]
    found = plain_runs(w)
    gone = {i for s, length, q in found for i in range(s + q, s + length)}
    best = min(found, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2])) if found else None
    digest = [hashlib.sha256(x.encode()).hexdigest() for x in ("".join(f"{s},{k},{q}\n" for s, k, q in found), " ".join(x for i, x in enumerate(w) if i not in gone))]
    return (doc_id, len(found), *(best or (None, None, None)), best and 1000 * best[1] // best[2], *digest)


def some_words(draw):
    """Words in which runs of many periods meet, nest and touch."""
    w = []
    for _ in range(draw.randint(1, 6)):
        root = [draw.choice("abc") + draw.choice(["", str(draw.randint(0, 30))]) for _ in range(draw.choice([1, 1, 2, 3, 5, 8, 16, 17, 31, 32, 33, 40, 64, 65, 90, 128, 129]))]
        w += (root * 9)[: draw.randint(1, 9 * len(root))] + [draw.choice("abxyz") for _ in range(draw.randint(0, 5))]
    return w


def test_runs_of_all_periods():
    draw = random.Random(5)
    for _ in range(60):
        texts = [some_words(draw) for _ in range(draw.randint(1, 4))]
        names = {x: k for k, x in enumerate(sorted({x for w in texts for x in w}))}
        codes = [c for k, w in enumerate(texts) for c in [*(names[x] for x in w), len(names) + k]]
        got = periodic_runs.find_runs(np.array(codes), np.array([len(w) for w in texts]))
        want, at = [], 0
        for w in texts:
            want += [(s + at, length, q) for s, length, q in plain_runs(w)]
            at += len(w) + 1
        assert sorted(map(tuple, got.tolist())) == sorted(want)


def test_window_minima():
    draw = np.random.default_rng(1)
    for n, width in ((1, 1), (5, 7), (40, 3), (64, 8), (100, 16)):
        values = draw.integers(0, 50, n).astype(np.uint64)
        windows = [values[i : i + width] for i in range(n - width + 1)]
        assert periodic_runs.window_minima(values, width).tolist() == [w.min() for w in windows]
        assert periodic_runs.minimizers(values, width).tolist() == sorted({i + k for i, w in enumerate(windows) for k in np.flatnonzero(w == w.min())})


ODD = [(1, None), (2, ""), (3, " \n\t\r\x0b\x0c"), (4, "a " * 5), (5, "a " * 6), (6, "a\xa0b a\x85b " * 8), (7, "é\nü\t" * 900), (7, "é\nü\t" * 900), (8, "Aa aA " * 3 + "Aa"), (9, "x" * 100_000)]


@pytest.mark.parametrize("rows", [ODD, []])
def test_runs_of_odd_documents(documents, rows):
    got = [tuple(r) for r in periodic_runs.run_report(periodic_runs.periodic_runs(documents(rows))).collect()]
    assert sorted(got, key=str) == sorted((plain_report(i, t, False) for i, t in rows), key=str)
    got = [tuple(r) for r in periodic_runs.run_report(periodic_runs.periodic_runs(periodic_runs.planted(documents(rows)))).collect()]
    assert sorted(got, key=str) == sorted((plain_report(i, t, True) for i, t in rows), key=str)


def test_documents_without_id_are_not_edited(documents):
    rows = [(None, "a b c d e f g h"), (None, None)]
    got = periodic_runs.periodic_runs(periodic_runs.planted(documents(rows))).collect()
    assert {(r["doc_id"], r["collapsed"]) for r in got} == {(None, "a b c d e f g h"), (None, "")}


def test_registered_runs(spark, sf_dir):
    rows = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()
    short = {r["doc_id"]: r["text"] for r in rows if len(r["text"] or "") < 20_000}
    got = {r["doc_id"]: tuple(r) for r in queries.op11_periodic_runs(spark, sf_dir).collect()}
    assert len(got) == len(rows) and any(g[1] for g in got.values())
    for i, text in short.items():
        assert got[i] == plain_report(i, text, True), i


def plain_clusters(rows, k=40, rounds=5):
    kept = [(i, [int(np.floor(256 * float(x))) for x in v]) for i, v in rows if v is not None and len(v) == 64 and all(x is not None and np.isfinite(x) for x in v)]
    key = {i: hashlib.sha256(f"2:{'' if i is None else i}".encode()).hexdigest() for i, _ in kept}
    means = [v for _, v in sorted(kept, key=lambda r: (key[r[0]], r[1]))[:k]]

    def assign():
        return [min((sum((a - b) ** 2 for a, b in zip(v, m, strict=True)), c) for c, m in enumerate(means)) for _, v in kept]

    for _ in range(rounds):
        near = assign()
        for c in range(len(means)):
            own = [v for (_, v), (_, n) in zip(kept, near, strict=True) if n == c]
            if own:
                means[c] = [sum(x) // len(own) for x in zip(*own, strict=True)]
    near = assign()
    total = defaultdict(int)
    for d, c in near:
        total[c] += d
    names = [hashlib.sha256(",".join(map(str, m)).encode()).hexdigest() for m in means]
    return [(i, c, d, total[c], sum(total.values()), names[c]) for (i, _), (d, c) in zip(kept, near, strict=True)]


VECTORS = "vec_id long, embedding array<float>, cluster string, distance int, ints int"


@pytest.mark.parametrize("n", [0, 3, 300])
def test_clusters(spark, n):
    draw = np.random.default_rng(3)
    points = (draw.normal(size=(8, 64))[draw.integers(0, 8, n)] + 0.3 * draw.normal(size=(n, 64))).astype(np.float32)
    points[n // 2 :] = np.round(points[n // 2 :])  # ties
    points[n // 3 : n // 3 + 20] = points[n // 3 : n // 3 + 1]  # empty centroids
    rows = [(i, [float(x) for x in v]) for i, v in enumerate(points)]
    if n:
        rows += [rows[1], rows[2], (None, [0.5] * 64), (900, None), (901, [1.0] * 63), (902, [float("nan")] * 64), (903, [None] * 64), (904, [float("inf")] * 64), (905, []), (906, [0.0] * 64)]
    df = spark.createDataFrame([(i, v, "x", 1, 2) for i, v in rows], VECTORS)
    got = [tuple(r) for r in centroids.cluster_report(centroids.cluster(df)).collect()]
    assert sorted(got, key=str) == sorted(plain_clusters(rows), key=str)


def test_nearest_is_exact():
    draw = np.random.default_rng(9)
    for size in (1, 2, 8, 64):
        vectors, means = draw.integers(-3, 4, (400, size)), draw.integers(-3, 4, (40, size))
        vectors[:50] *= 2_000_000
        far = ((vectors[:, None] - means[None]) ** 2).sum(2)
        number, distance = centroids.nearest(vectors, means)
        assert number.tolist() == far.argmin(1).tolist() and distance.tolist() == far.min(1).tolist()


def check_sequences(rows, docs, library, longest, end_id=2):
    """Every id once, every sequence gapless and a power of two long; the sequences' lengths."""
    ids = {i: [*library.encode(t or "", add_special_tokens=False).ids, end_id] for i, t in docs}
    placed, pieces = defaultdict(list), defaultdict(list)
    for r in rows:
        own = ids[r["doc_id"]]
        assert r["doc_tokens"] == len(own)
        assert r["ids_crc32"] == zlib.crc32(np.array(own[r["start"] : r["start"] + r["length"]], "<u4").tobytes())
        placed[r["sequence_id"]].append((r["offset"], r["length"], r["tier"]))
        pieces[r["doc_id"]].append((r["start"], r["length"]))
    for i, own in ids.items():
        parts = sorted(pieces[i])
        repeats = sum(1 for j, _ in docs if j == i)
        assert sum(n for _, n in parts) == repeats * len(own) and {k for s, n in parts for k in range(s, s + n)} == set(range(len(own)))
    for parts in placed.values():
        ends = np.cumsum([n for _, n, _ in sorted(parts)])
        assert [at for at, _, _ in sorted(parts)] == [0, *ends[:-1]]
        assert {ends[-1]} == {t for _, _, t in parts} and ends[-1] <= longest and not ends[-1] & (ends[-1] - 1)
    return [sum(n for _, n, _ in parts) for parts in placed.values()]


@pytest.mark.parametrize("rows", [[(3, "Hello there, world."), (1, None), (2, ""), (2, ""), (None, "no id here"), (9, "word " * 3000), (7, "x" * 5000), (5, "the the the")], []])
def test_tiered_packing(documents, rows):
    got = tiered_packing.tiered_pack(documents(rows), WORD_BPE, tiers=(64, 32, 16)).collect()
    sizes = check_sequences(got, rows, Tokenizer.from_file(WORD_BPE), 64)
    assert sum(n < 16 for n in sizes) <= 4


def test_tiers_are_powers_of_two(documents):
    with pytest.raises(ValueError):
        tiered_packing.tiered_pack(documents([]), WORD_BPE, tiers=(48, 32))


@pytest.mark.parametrize("seed", range(6))
def test_plan_places_every_piece(seed):
    draw = random.Random(seed)
    counts = {n: draw.choice([1, 3, 700]) for n in draw.sample(range(1, 257), draw.choice([1, 5, 200]))}
    plan = tiered_packing.Plan(counts, (256, 128, 64), 1024)
    length = np.array([n for n, c in counts.items() for _ in range(c)])
    k = np.array([i for c in counts.values() for i in range(c)])
    piece, at, part, sequence, offset, tier, step = plan.place(length, k)
    assert np.bincount(piece, part).tolist() == length.tolist()
    bins, steps = defaultdict(list), defaultdict(set)
    for s, o, n, t, g in zip(sequence.tolist(), offset.tolist(), part.tolist(), tier.tolist(), step.tolist(), strict=True):
        bins[s].append((o, n, t, g))
        steps[g].add((s, t))
    assert sorted(bins) == list(range(len(bins)))
    for parts in bins.values():
        ends = np.cumsum([n for _, n, _, _ in sorted(parts)])
        assert [o for o, *_ in sorted(parts)] == [0, *ends[:-1]] and {ends[-1]} == {t for _, _, t, _ in parts}
        assert len({g for *_, g in parts}) == 1
    assert all(len({t for _, t in own}) == 1 and sum(t for _, t in own) <= 1024 for own in steps.values())
    partial = [g for g, own in steps.items() if sum(t for _, t in own) < 1024]
    assert len(partial) <= 3 + 8  # the last step of a tier, and the end of the pour


def test_registered_tiers(spark, sf_dir):
    docs = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()]
    rows = queries.op13_tiered_packing(spark, sf_dir).collect()
    check_sequences(rows, docs, Tokenizer.from_file(WORD_BPE), 4096)
    assert len(rows) <= 1.5 * len(docs) + sum(r["length"] for r in rows) / 4096 + 12


def test_a_large_component_meets_only_the_rest_of_its_bucket(spark, monkeypatch):
    """One bucket of 200 linked sets and 3 others: rows to compare grow with the members, not with their square, and no link is lost."""
    import numpy as np
    from tidegauge.llm import near_dups
    from tidegauge.llm.common import Scratch

    monkeypatch.setattr(near_dups, "BLOCK", 10)
    texts = [(i, " ".join(f"w{k}" for k in range(60)) + f" x{i}") for i in range(200)]
    texts += [(900 + i, " ".join(f"{'w' if k < 56 - 15 * (i > 0) else f'v{i}_'}{k}" for k in range(60)) + f" x{i}y") for i in range(3)]
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    rows = []
    keep = Scratch.keep

    def spied(self, df):
        if "_rest" in df.columns:
            rows.append(keep(self, df).selectExpr("sum(_rest * (_n + _m) + _most * _n)", "sum(_rest + _most)").first())
        return keep(self, df)

    monkeypatch.setattr(Scratch, "keep", spied)
    signature = bytes(np.arange(228, dtype=np.uint8))
    sketches = spark.createDataFrame([(d, signature, 57) for d, _ in texts], "doc_id long, signature binary, n long")
    members = sketches.selectExpr("doc_id", "n", "7L AS key")
    roots = spark.createDataFrame([(i, 0) for i in range(200)], "node long, root long")
    with Scratch(spark, "test") as scratch:
        found = near_dups._across(members, sketches, docs, roots, 5, 150, 80, scratch).collect()
    assert found and all(a < 200 and b == 900 for a, b in found)  # one link from each task at most
    (made, sent), = rows
    assert made <= 2.5 * sent
