"""The operators over the sample tables: op1 to op13, and the SQL that checks them where SQL can."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bpe, centroids, fingerprints, html_text, lm_scores, near_dups, neighbours, packing, periodic_runs, pii, quality, tiered_packing, token_files
from .common import read_table, shared_folder

WORD_BPE = public_tokenizers.path("word_bpe_49k.json")
BYTE_BPE = public_tokenizers.path("byte_bpe_50k.json")


def op1_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents", "doc_id", "text")
    return quality.score_quality(docs, quality.train(docs, read_table(spark, sf_dir, "labels", "doc_id", "quality")))


def op2_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.span_report(pii.find_spans(read_table(spark, sf_dir, "documents", "doc_id", "text")))


def op3_near_dups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dups.near_duplicates(read_table(spark, sf_dir, "documents", "doc_id", "text"), shingle=4, threshold=80)


def op4_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents", "doc_id", "text")
    return packing.best_fit_pack(docs, WORD_BPE, size=2048, end_id=0)


def op5_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = read_table(spark, sf_dir, "embeddings", "vec_id", "embedding")
    return neighbours.nearest(vectors, vectors.filter("vec_id % 100 = 0"), k=10)


def op6_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.encode_and_decode(read_table(spark, sf_dir, "documents", "doc_id", "text"), BYTE_BPE)


def op7_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = shared_folder(spark, "token-files")
    token_files.write_token_files(read_table(spark, sf_dir, "documents", "doc_id", "text"), path, WORD_BPE, end_id=1)
    return token_files.read_token_files(spark, path).drop("ids")


def op8_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.fingerprints(read_table(spark, sf_dir, "documents", "doc_id", "text"))


def op9_lm_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    scores = lm_scores.stupid_backoff(read_table(spark, sf_dir, "documents", "doc_id", "text"), order=3, alpha=0.4)
    return scores.select("doc_id", "n_tokens", *(F.round(c, 6).alias(c) for c in ("log_score", "mean_log_score")))


def op10_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract_text(read_table(spark, sf_dir, "pages", "page_id", "url", "html"))


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = periodic_runs.planted(read_table(spark, sf_dir, "documents", "doc_id", "text"))
    return periodic_runs.run_report(periodic_runs.periodic_runs(docs))


def op12_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return centroids.cluster_report(centroids.cluster(read_table(spark, sf_dir, "embeddings", "vec_id", "embedding"), k=40, rounds=5))


def op13_tiered_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents", "doc_id", "text")
    return tiered_packing.tiered_pack(docs, WORD_BPE, tiers=(4096, 2048, 1024, 512), end_id=2)


OP9_SQL = r"""
WITH words AS (
  SELECT doc_id, unnest(w) AS w, generate_subscripts(w, 1) AS i
  FROM (SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[ 	

]+'), lambda x: x <> '') AS w FROM documents)),
grams AS (
  SELECT doc_id, i, w AS g1, lag(w) OVER t AS u, lag(w, 2) OVER t AS s FROM words WINDOW t AS (PARTITION BY doc_id ORDER BY i)),
keyed AS (
  SELECT doc_id, i, g1, CASE WHEN i > 1 THEN u || ' ' || g1 END AS g2, CASE WHEN i > 2 THEN s || ' ' || u || ' ' || g1 END AS g3,
         CASE WHEN i > 1 THEN u END AS b1, CASE WHEN i > 2 THEN s || ' ' || u END AS b2 FROM grams),
each AS (
  SELECT doc_id, unnest([g1, g2, g3]) AS g FROM keyed),
own AS (SELECT doc_id, g, count(*) AS n FROM each WHERE g IS NOT NULL GROUP BY ALL),
total AS (SELECT g, sum(n)::BIGINT AS n FROM own GROUP BY g),
other AS (SELECT doc_id, g, total.n - own.n AS n FROM own JOIN total USING (g)),
sizes AS (SELECT doc_id, count(*) AS n FROM words GROUP BY doc_id),
scored AS (
  SELECT k.doc_id, CASE
    WHEN c3.n > 0 THEN ln(c3.n) - ln(d2.n)
    WHEN c2.n > 0 THEN ln(c2.n) - ln(d1.n) + CASE WHEN k.i > 2 THEN ln(0.4::DOUBLE) ELSE 0 END
    ELSE ln(c1.n + 1) - ln((SELECT sum(n) FROM sizes) - z.n + 1) + (least(k.i, 3) - 1) * ln(0.4::DOUBLE) END AS s
  FROM keyed k JOIN sizes z USING (doc_id)
  JOIN other c1 ON c1.doc_id = k.doc_id AND c1.g = k.g1
  LEFT JOIN other c2 ON c2.doc_id = k.doc_id AND c2.g = k.g2
  LEFT JOIN other c3 ON c3.doc_id = k.doc_id AND c3.g = k.g3
  LEFT JOIN other d1 ON d1.doc_id = k.doc_id AND d1.g = k.b1
  LEFT JOIN other d2 ON d2.doc_id = k.doc_id AND d2.g = k.b2),
summed AS (SELECT doc_id, count(*) AS n_tokens, fsum(s) AS s FROM scored GROUP BY doc_id)
SELECT d.doc_id, coalesce(n_tokens, 0)::BIGINT AS n_tokens, round(coalesce(s, 0), 6) AS log_score, round(s / n_tokens, 6) AS mean_log_score
FROM documents d LEFT JOIN summed USING (doc_id)"""


OP3_SQL = r"""
WITH RECURSIVE words AS (
  SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[ \t\n\v\f\r]+'), lambda x: x <> '') AS w
  FROM documents),
sets AS (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 4 THEN [array_to_string(w, ' ')]
    ELSE list_distinct(list_transform(range(1, len(w) - 2), lambda i: concat_ws(' ', w[i], w[i + 1], w[i + 2], w[i + 3]))) END AS s FROM words),
sizes AS (SELECT doc_id, len(s)::BIGINT AS n FROM sets),
each AS (SELECT doc_id, unnest(s) AS g FROM sets),
common AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS k FROM each a JOIN each b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY ALL),
links AS (
  SELECT a, b FROM common JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b WHERE 100 * k >= 80 * (x.n + y.n - k)),
both_ways AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reach AS (
  SELECT doc_id AS node, doc_id AS other FROM sizes
  UNION SELECT both_ways.a, reach.other FROM reach JOIN both_ways ON both_ways.b = reach.node)
SELECT doc_id, n AS n_shingles, min(other) AS component_id, min(other) = doc_id AS kept FROM sizes JOIN reach ON node = doc_id GROUP BY doc_id, n"""


def _op12_sql() -> str:
    """Rounds of assignment and exact floors, over components as rows."""
    rounds = "".join(f"""
near{r} AS (
  SELECT vec_id, arg_min(c, (d, c)) AS c, min(d) AS d FROM (
    SELECT v.vec_id, m.c, list_sum(list_transform(list_zip(v.x, m.x), lambda p: (p[1] - p[2]) * (p[1] - p[2])))::BIGINT AS d FROM kept v, means{r} m)
  GROUP BY vec_id),
summed{r} AS (
  SELECT c, i, sum(x) AS s, count(*) AS n FROM (
    SELECT c, unnest(x) AS x, generate_subscripts(x, 1) AS i FROM kept JOIN near{r} USING (vec_id)) GROUP BY c, i),
means{r + 1} AS (
  SELECT m.c, coalesce(s.x, m.x) AS x FROM means{r} m LEFT JOIN (
    SELECT c, list(((s - ((s % n) + n) % n) // n)::BIGINT ORDER BY i) AS x FROM summed{r} GROUP BY c) s USING (c)),""" for r in range(5))
    return f"""
WITH kept AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS x FROM embeddings
  WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
means0 AS (
  SELECT row_number() OVER (ORDER BY h) - 1 AS c, x FROM (SELECT sha256('2:' || vec_id) AS h, x FROM kept ORDER BY h LIMIT 40)),{rounds}
last AS (
  SELECT vec_id, arg_min(c, (d, c)) AS c, min(d) AS d FROM (
    SELECT v.vec_id, m.c, list_sum(list_transform(list_zip(v.x, m.x), lambda p: (p[1] - p[2]) * (p[1] - p[2])))::BIGINT AS d FROM kept v, means5 m)
  GROUP BY vec_id)
SELECT vec_id, c::INTEGER AS cluster, d AS distance, (sum(d) OVER (PARTITION BY c))::BIGINT AS cluster_inertia, (sum(d) OVER ())::BIGINT AS inertia,
       sha256(array_to_string(x, ',')) AS centroid_sha256
FROM last JOIN means5 USING (c)"""


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_quality": op1_quality,
    "op2_pii": op2_pii,
    "op3_near_dups": op3_near_dups,
    "op4_packing": op4_packing,
    "op5_neighbours": op5_neighbours,
    "op6_bpe": op6_bpe,
    "op7_token_files": op7_token_files,
    "op8_fingerprints": op8_fingerprints,
    "op9_lm_scores": op9_lm_scores,
    "op10_html_text": op10_html_text,
    "op11_periodic_runs": op11_periodic_runs,
    "op12_centroids": op12_centroids,
    "op13_tiered_packing": op13_tiered_packing,
}
ORACLES: dict[str, str] = {
    "op3_near_dups": OP3_SQL,
    "op9_lm_scores": OP9_SQL,
    "op12_centroids": _op12_sql(),
}
