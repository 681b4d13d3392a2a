"""Neighbours against brute force, the registered queries, and the pipeline against a plain version."""

import hashlib
import zlib

import brute
import corpus_pipeline
import numpy as np
import oracle
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tidegauge.llm import neighbours, queries
from tidegauge.llm.queries import BYTE_BPE, WORD_BPE


def plain_neighbours(rows, asked, k):
    out = {}
    ids = np.array([i for i, _ in rows])
    vectors = np.array([v for _, v in rows])
    for q in asked:
        far = np.sqrt(((vectors - vectors[ids == q][0]) ** 2).sum(1))
        out[q] = [int(ids[i]) for i in np.lexsort((ids, far)) if ids[i] != q][:k]
    return out


@pytest.mark.parametrize("hashes, probes", [(1, 16), (2, 128)])
def test_neighbours(spark, hashes, probes):
    draw = np.random.default_rng(1)
    centres = draw.normal(size=(20, 24))
    points = (centres[draw.integers(0, 20, 600)] + 0.5 * draw.normal(size=(600, 24))).astype(np.float32)
    points[100:160] = points[99]  # a common vector
    rows = [(i, [float(x) for x in v]) for i, v in enumerate(points)]
    odd = [(1000, None), (1001, [0.0] * 24), (1002, [float("nan")] * 24), (1003, [1.0] * 23), (1004, [None] * 24), (1005, [float("inf")] * 24), (None, [1.0] * 24)]
    df = spark.createDataFrame([(i, v, "x", 3) for i, v in [*rows, *odd, rows[5]]], "vec_id long, embedding array<float>, score string, bucket int")
    got = {}
    for r in neighbours.nearest(df, df.filter("vec_id % 20 = 0"), k=10, hashes=hashes, probes=probes).orderBy("query_id", "rank").collect():
        got.setdefault(r["query_id"], []).append((r["vec_id"], r["score"]))
    want = plain_neighbours(rows, range(0, 600, 20), 10)
    assert set(got) == set(want) and all(len(g) == 10 for g in got.values())
    found = np.mean([len({i for i, _ in got[q]} & set(want[q])) / 10 for q in want])
    assert found >= 0.9
    assert [i for i, _ in got[100]] == want[100]
    for q, near in got.items():
        exact = [float(np.sqrt(((points[i].astype(float) - points[q].astype(float)) ** 2).sum())) for i, _ in near]
        assert np.allclose([s for _, s in near], exact, rtol=1e-12)


def test_few_vectors_find_all(spark):
    rows = [(100 * i, [float(i), 1.0, -1.0]) for i in range(5)]
    df = spark.createDataFrame([*rows, (1, [1.0, 2.0])], "vec_id long, embedding array<double>")
    got = neighbours.nearest(df, df, k=10).collect()
    assert {(r["query_id"], r["vec_id"]) for r in got} == {(a, b) for a, _ in rows for b, _ in rows if a != b}
    assert neighbours.nearest(df.limit(0), df.limit(0)).count() == 0


def sha(text):
    return hashlib.sha256(text.encode() if isinstance(text, str) else text).hexdigest()


def token_bytes(library, text, end=()):
    return np.array([*library.encode(text or "", add_special_tokens=False).ids, *end], "<u4").tobytes()


def plain_quality(rows, docs, labels):
    assert all(r["held_out"] == (zlib.crc32(str(i).encode()) % 5 == 0) and r["predicted"] == (r["score"] >= 0.3) and 0 <= r["score"] <= 1 for i, r in rows.items())
    # Nineteen held-out labels at the smallest scale, and some seventy to learn from.
    assert np.mean([rows[i]["predicted"] == q for i, q in labels.items() if rows[i]["held_out"]]) > 0.85


def plain_pii(rows, docs, labels):
    for i, text in docs.items():
        spans = brute.personal_data(text)
        assert rows[i]["base_sha256"] == sha(",".join(f"{kind}:{start}:{stop}" for start, _, stop, kind in spans))
        assert {k: rows[i][f"n_{k}"] for k in brute.PATTERNS} == {k: sum(s[3] == k for s in spans) for k in brute.PATTERNS}


def plain_bpe(rows, docs, labels):
    library = Tokenizer.from_file(BYTE_BPE)
    for i, text in docs.items():
        ids = token_bytes(library, text)
        decoded = library.decode(np.frombuffer(ids, "<u4").tolist(), skip_special_tokens=False)
        assert (rows[i]["n_tokens"], rows[i]["ids_sha256"], rows[i]["decoded_sha256"]) == (len(ids) // 4, sha(ids), sha(decoded))


def plain_files(rows, docs, labels):
    library, start = Tokenizer.from_file(WORD_BPE), 0
    for i in sorted(docs):
        ids = token_bytes(library, docs[i], (1,))
        assert (rows[i]["start"], rows[i]["n_tokens"], rows[i]["ids_crc32"]) == (start, len(ids) // 4, zlib.crc32(ids))
        start += len(ids) // 4


def plain_fingerprints(rows, docs, labels):
    order = sorted(docs, reverse=True)
    same = {}
    for i, after in zip(order, [*order[1:], order[0]], strict=True):
        text, other = docs[i] or "", docs[after] or ""
        n = len(text) // 3
        edited = text[: len(text) - n] + other[:n]
        assert (rows[i]["n_chars"], rows[i]["edited_sha256"]) == (len(text), sha(edited))
        assert same.setdefault(text, rows[i]["fingerprint"]) == rows[i]["fingerprint"]
        assert (rows[i]["near_edited"] == 1) >= (edited == text) and 0 <= rows[i]["near_next"] <= 1


PLAIN = {"op1_quality": plain_quality, "op2_pii": plain_pii, "op6_bpe": plain_bpe, "op7_token_files": plain_files, "op8_fingerprints": plain_fingerprints}


@pytest.mark.parametrize("key", list(PLAIN))
def test_registered_queries_against_plain_versions(spark, sf_dir, key):
    read = lambda name: spark.read.parquet(f"{sf_dir}/{name}.parquet").collect()
    docs = {r["doc_id"]: r["text"] for r in read("documents")}
    found = queries.QUERIES[key](spark, sf_dir).collect()
    rows = {r["doc_id"]: r for r in found}
    assert len(found) == len(rows) == len(docs)
    PLAIN[key](rows, docs, {r["doc_id"]: r["quality"] for r in read("labels")})


def test_registered_packing_against_the_library(spark, sf_dir):
    docs = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    rows, library, bins = queries.QUERIES["op4_packing"](spark, sf_dir).collect(), Tokenizer.from_file(WORD_BPE), {}
    want = set()
    for i, text in docs.items():
        ids = token_bytes(library, text, (0,))
        want |= {(i, k, at // 4, len(ids[at : at + 8192]) // 4, zlib.crc32(ids[at : at + 8192])) for k, at in enumerate(range(0, len(ids), 8192))}
    assert {tuple(r[c] for c in ("doc_id", "piece", "start", "length", "ids_crc32")) for r in rows} == want and len(rows) == len(want)
    for r in rows:
        bins.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for parts in bins.values():
        ends = np.cumsum([n for _, n in sorted(parts)])
        assert [at for at, _ in sorted(parts)] == [0, *ends[:-1]] and ends[-1] <= 2048
    assert len(bins) <= 1.02 * sum(r["length"] for r in rows) / 2048 + 1


def test_registered_neighbours_against_all_distances(spark, sf_dir):
    rows = [(r["vec_id"], r["embedding"]) for r in spark.read.parquet(f"{sf_dir}/embeddings.parquet").collect()]
    want = plain_neighbours(rows, [i for i, _ in rows if i % 100 == 0], 10)
    got = {}
    for r in queries.QUERIES["op5_neighbours"](spark, sf_dir).collect():
        got.setdefault(r["query_id"], set()).add(r["vec_id"])
    assert np.mean([len(got[q] & set(w)) / 10 for q, w in want.items()]) >= 0.9


def test_registered_pages_against_a_plain_parser(spark, sf_dir):
    pages = {r["page_id"]: r["html"] for r in spark.read.parquet(f"{sf_dir}/pages.parquet").collect()}
    got = {r["page_id"]: r["text"] for r in queries.QUERIES["op10_html_text"](spark, sf_dir).collect()}
    assert got == {i: brute.main_text(page) for i, page in pages.items()}


@pytest.mark.parametrize("key", list(queries.ORACLES))
def test_registered_queries_against_their_sql(spark, sf_dir, key):
    assert oracle.difference(queries.QUERIES[key](spark, sf_dir), oracle.connect(sf_dir), queries.ORACLES[key]) is None


def test_every_registered_query_is_compared():
    apart = {"op4_packing", "op5_neighbours", "op10_html_text", "op11_periodic_runs", "op13_tiered_packing"}
    assert set(queries.QUERIES) == {*PLAIN, *queries.ORACLES, *apart}


def test_pipeline_keeps_what_a_plain_version_keeps(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    steps = dict(corpus_pipeline.STAGES)
    good = steps["quality"](spark, docs, sf_dir)
    assert good.schema == docs.schema
    kept = sorted((r["doc_id"], r["text"]) for r in good.collect())
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{sf_dir}/labels.parquet").collect()}
    kept_ids = {i for i, _ in kept}
    assert np.mean([(i in kept_ids) == bool(q) for i, q in labels.items()]) > 0.95
    single = steps["near copies"](spark, good, sf_dir)
    roots = brute.near_duplicates(kept, 5)
    assert {r["doc_id"] for r in single.collect()} == {i for i, (_, root) in roots.items() if i == root}
    masked = steps["personal data"](spark, single, sf_dir)
    assert masked.schema.names == docs.schema.names
    texts = {r["doc_id"]: r["text"] for r in masked.collect()}
    source = dict(kept)
    for i, text in texts.items():
        spans = brute.personal_data(source[i])
        assert not brute.personal_data(text) and (text != source[i]) >= bool(spans)
    library = Tokenizer.from_file(WORD_BPE)
    packed = steps["packing"](spark, masked, sf_dir).collect()
    sizes = {i: len(library.encode(t, add_special_tokens=False).ids) + 1 for i, t in texts.items()}
    assert {i: sum(r["length"] for r in packed if r["doc_id"] == i) for i in sizes} == sizes
    assert len({r["sequence_id"] for r in packed}) <= 1.02 * sum(sizes.values()) / 2048 + 1
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality", "near copies", "personal data", "packing"]


def test_pipeline_stages_on_odd_rows(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").withColumn("_match_email", F.lit("m")).withColumn("label", F.lit(7))
    good = docs.filter("length(text) > 2000").limit(1).collect()[0].asDict()
    odd = [{**good, "doc_id": i, "text": t} for i, t in [(None, None), (None, good["text"]), (10**9, ""), (10**9 + 1, "\n\n"), (10**9 + 2, good["text"] + " x@y.org"), (10**9 + 2, good["text"] + " x@y.org"), (10**9 + 3, "word " * 60_000)]]
    for rows in (docs.unionByName(spark.createDataFrame(odd, docs.schema)), docs.limit(0)):
        kept, empty = rows, rows.count() == 0
        for name, stage in corpus_pipeline.STAGES[:-1]:
            before = kept.count()
            kept = stage(spark, kept, sf_dir)
            assert kept.schema.names == docs.schema.names and kept.count() <= before, name
        ids = [r["doc_id"] for r in kept.select("doc_id").collect() if r["doc_id"] is not None]
        assert len(ids) == len(set(ids)) and not kept.filter("text LIKE '%x@y.org%'").count()
        packed = corpus_pipeline.STAGES[-1][1](spark, kept, sf_dir)
        assert packed.filter("start = 0").count() == kept.count() and (packed.count() == 0) == empty
