"""Where samples go: JSON or columnar files, one folder per event type."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter
from pyspark.sql.types import StructType


def payload(samples: DataFrame, event_type: str) -> DataFrame:
    """``event_type, instance, collected_at, payload``: one JSON text per sample.

    Null fields do not appear in the text.
    """
    tagged = samples.withColumn("event_type", F.lit(event_type))
    body = [c for c in tagged.columns if c not in ("instance", "collected_at")]
    return tagged.select("event_type", "instance", "collected_at", F.to_json(F.struct(*[F.col(f"`{c}`") for c in body])).alias("payload"))


def emit_samples(payloads: DataFrame, path: str, fmt: str = "parquet", mode: str = "append") -> None:
    """Append samples below ``path``, partitioned by event type."""
    payloads.write.mode(mode).partitionBy("event_type").format(fmt).save(path)


def read_payloads(written: DataFrame, shapes: dict[str, StructType]) -> DataFrame:
    """Samples back from their payloads, typed: ``event_type, instance, collected_at`` and the columns of all shapes.

    ``shapes`` has the fields of each event type; a column that an event type
    lacks is null. Where ``written`` is partitioned by event type, each part is
    read once.
    """
    out = None
    for event, shape in shapes.items():
        body = written.filter(F.col("event_type") == event).withColumn("_body", F.from_json("payload", shape))
        part = body.select("event_type", "instance", "collected_at", *[F.col("_body")[f.name].alias(f.name.replace(".", "_")) for f in shape])
        out = part if out is None else out.unionByName(part, allowMissingColumns=True)
    return out


_COMMITS = "batch long, event_type string, samples long"


def emit_stream(payloads: DataFrame, path: str, checkpoint: str) -> DataStreamWriter:
    """Stream sink of ``payload`` rows: every micro-batch is there once, whole or not at all.

    A micro-batch writes its samples below ``data/batch=<id>``, by event type, and
    then its commit, how many there are of each type, below ``commits/batch=<id>``.
    A batch that is run again finds its commit and adds nothing; one that died
    before its commit is written again over its remains. ``emitted`` reads only
    committed batches.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        if committed(spark, path).filter(F.col("batch") == batch_id).count():
            return
        folder = f"{path}/data/batch={batch_id}"
        batch.write.mode("overwrite").partitionBy("event_type").parquet(folder)
        counts = spark.read.schema(batch.schema).parquet(folder).groupBy("event_type").agg(F.count(F.lit(1)).alias("samples"))
        # One file is the commit: it is there or not.
        counts.coalesce(1).write.mode("overwrite").parquet(f"{path}/commits/batch={batch_id}")

    spark = payloads.sparkSession
    spark.createDataFrame([], "event_type string, samples long").write.mode("ignore").parquet(f"{path}/commits/batch=-1")
    return payloads.writeStream.option("checkpointLocation", checkpoint).foreachBatch(write)


def committed(spark: SparkSession, path: str) -> DataFrame:
    """The commit log: how many samples of each event type every committed batch holds."""
    return spark.read.schema(_COMMITS).parquet(f"{path}/commits")


def emitted(spark: SparkSession, path: str, schema: str = "event_type string, instance string, collected_at timestamp_ntz, payload string") -> DataFrame:
    """The samples of committed batches; folders of others are not read."""
    batches = committed(spark, path).select("batch", "event_type").distinct()
    written = spark.read.schema(f"batch long, {schema}").parquet(f"{path}/data")
    return written.join(batches, ["batch", "event_type"], "left_semi").drop("batch")
