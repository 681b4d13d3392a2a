"""A training corpus from `documents`: reject bad quality, drop near copies, mask personal data, pack.

Each stage takes all rows that its predecessor kept; all but the last return the
columns of documents, whatever else these are called.

A null text counts as empty: it is scored like one, has no near copies and no personal
data, and packs as the end id alone. Rows without doc_id are never near copies of each
other. Rows that repeat a doc_id are one document from the second stage on: one of them
stays. An empty table gives an empty result; without labels of both kinds the first
stage keeps every row.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidegauge.llm import near_dups, packing, pii, quality
from tidegauge.llm.common import read_table, shared_folder
from tidegauge.llm.queries import WORD_BPE


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose quality score is at least 0.3; the field is fitted on those that are left here and labelled."""
    field = quality.train(docs, read_table(spark, sf_dir, "labels", "doc_id", "quality"))
    return quality.good_documents(docs, field)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: five-word shingles, similarity 0.8."""
    return near_dups.one_of_each(docs, shingle=5, threshold=80)


def mask_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every span of personal data becomes its kind in brackets; n_chars follows the text."""
    text = pii.masked(F.col("text"), F.col("pii_spans"))
    masked = pii.find_spans(docs).withColumn("text", text).withColumn("n_chars", F.length("text").cast("long"))
    return masked.select(*docs.columns)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Best-fit packing of all that is left."""
    return packing.best_fit_pack(docs, WORD_BPE, size=2048, end_id=0)


STAGES = [
    ("quality", keep_good),
    ("near copies", drop_near_copies),
    ("personal data", mask_personal_data),
    ("packing", pack),
]

#: A fitted field and a tokenizer's ids are not within SQL; tests compare run() with a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to `documents`, each written to the shared folder and reread."""
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        path = shared_folder(spark, "pipeline-" + name.replace(" ", "-"))
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
