"""Records on their way out: identity, long form, batches."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidegauge import KEYS, settings
from tidegauge.operators.ranking import numbered

# Event names.
SERVER_SAMPLE = "MysqlSample"
SLOW_QUERIES_SAMPLE = "MysqlSlowQueriesSample"
INDIVIDUAL_QUERIES_SAMPLE = "MysqlIndividualQueriesSample"
QUERY_EXECUTION_SAMPLE = "MysqlQueryExecutionSample"
WAIT_EVENTS_SAMPLE = "MysqlWaitEventsSample"
BLOCKING_SESSION_SAMPLE = "MysqlBlockingSessionSample"
NODE_ENTITY = "node"


def entity_tags(df: DataFrame) -> DataFrame:
    """Identity of a sample from ``hostname, port, is_remote``.

    A remote server is the entity host:port and shows its host name; a local
    one is anonymous. The port is text in both cases.
    """
    remote, host, port = F.col("is_remote"), F.col("hostname"), F.col("port").cast("string")
    return df.withColumns(
        {
            "entity_name": F.when(remote, F.concat(host, F.lit(":"), port)),
            "entity_type": F.when(remote, F.lit(NODE_ENTITY)),
            "hostname": F.when(remote, host),
            "port": port,
        }
    )


def split_instance(df: DataFrame) -> DataFrame:
    """``hostname`` and ``port`` of a remote ``instance`` (host:port)."""
    parts = F.split("instance", ":")
    return df.withColumns({"hostname": F.get(parts, F.lit(0)), "port": F.get(parts, F.lit(1))})


def record_to_metrics(
    records: DataFrame,
    source_types: dict[str, str],
    identity: Sequence[str] = KEYS,
) -> DataFrame:
    """Long form of typed records; a null field is omitted.

    ``source_types`` maps a field to gauge or attribute; anything else counts
    as gauge. Gauges keep their number, attributes their text.
    """
    fields = []
    for name, kind in source_types.items():
        attribute = kind == "attribute"
        fields.append(
            F.struct(
                F.lit(name).alias("metric"),
                F.lit("attribute" if attribute else "gauge").alias("source_type"),
                (F.lit(None) if attribute else F.col(name)).cast("double").alias("value"),
                (F.col(name) if attribute else F.lit(None)).cast("string").alias("text"),
            )
        )
    long = records.select(*identity, F.inline(F.array(*fields)))
    return long.filter(F.col("value").isNotNull() | F.col("text").isNotNull())


def publish_batches(
    samples: DataFrame, key: Sequence[str], model: Column | None = None, cell_digits: int = 3
) -> DataFrame:
    """``batch_id`` per instance, collection and event type.

    A batch is published when it exceeds the limit, so it holds limit + 1
    samples; the rest goes out last. Rows whose ``model`` is null are skipped.
    ``key`` identifies a sample. Any order of samples will do, so they are
    ordered by a digest of the key: its first ``cell_digits`` hexadecimal digits
    cut a group into 16 ** cell_digits equal parts for numbering; raise it where
    a group has more than some hundred million samples.
    """
    if model is not None:
        samples = samples.filter(model.isNotNull())
    digest = F.md5(F.concat_ws("|", *[F.col(c).cast("string") for c in key]))
    marked = samples.withColumn("_digest", digest)
    placed = numbered(
        marked, (*KEYS, "event_type"), [F.asc("_digest")], F.substring("_digest", 1, cell_digits), "_place"
    )
    size = settings.PUBLISH_THRESHOLD + 1
    return placed.withColumn("batch_id", F.floor(F.col("_place") / size).cast("long")).drop("_place", "_digest")
