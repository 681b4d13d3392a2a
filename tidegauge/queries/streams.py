"""The streaming operators over the sample tables as file streams."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidegauge.queries.oracle_text import EXCLUDED, iso, mean_ms, statement_type, truncated
from tidegauge.queries.metrics import RATES_SQL
from tidegauge.queries.registry import ORACLES, Sample, query
from tidegauge.session import shared_dir
from tidegauge.sources.sample_tables import VIEWS, oracle_query
from tidegauge.streaming import jobs

_EVENTS = "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string"


def execution_stream(t: Sample) -> DataFrame:
    """The executions of v_st_history, read as a stream of event files."""
    # The pattern takes both one file and a folder of files.
    events = t.spark.readStream.schema(_EVENTS).parquet(f"{t.sf_dir}/events.parque[t]")
    name = f"tg_stream_events_{abs(hash(t.sf_dir))}"
    events.createOrReplaceTempView(name)
    text = VIEWS["v_st_history"].replace("NTZ", "timestamp_ntz")
    return t.spark.sql(text.replace("FROM events", f"FROM {name}"))


def batch_folders(path: str):
    """Sink of a foreachBatch job: a batch replaces its own folder."""

    def write(df: DataFrame, batch_id: int) -> None:
        df.write.mode("overwrite").parquet(f"{path}/batch={batch_id}")

    return write


_WINDOWS = {
    "o_windows": """
SELECT instance, window_end AS collected_at, current_schema AS schema_name, digest, digest_text,
  count(*) AS n, sum(cpu_time) AS cpu, sum(timer_wait) AS timer, sum(rows_examined) AS examined, sum(rows_affected) AS affected,
  sum(no_index_used) AS no_index, max(ts) AS last_seen
FROM (SELECT *, make_timestamp((epoch_us(ts) // 30000000 + 1) * 30000000) AS window_end FROM v_st_history)
GROUP BY instance, window_end, current_schema, digest, digest_text""",
}


@query(
    "stream_slow_queries",
    f"""SELECT * EXCLUDE (place) FROM (
      SELECT *, row_number() OVER (PARTITION BY instance, collected_at ORDER BY avg_elapsed_time_ms DESC, query_id NULLS FIRST,
        database_name)::integer AS place FROM (
        SELECT instance, collected_at, digest AS query_id, {truncated("digest_text")} AS query_text, schema_name AS database_name,
          n AS execution_count, {mean_ms("cpu", "n")} AS avg_cpu_time_ms, {mean_ms("timer", "n")} AS avg_elapsed_time_ms,
          CASE WHEN no_index > 0 THEN 'Yes' ELSE 'No' END AS has_full_table_scan, {statement_type("digest_text")} AS statement_type,
          {iso("last_seen")} AS last_execution_timestamp, examined::double / n AS avg_disk_reads, affected::double / n AS avg_disk_writes,
          'N/A' AS schema_name, {iso("collected_at")} AS collection_timestamp
        FROM o_windows WHERE schema_name IS NOT NULL AND schema_name NOT IN {EXCLUDED}))
    WHERE place <= 20 AND query_id IS NOT NULL""",
    _WINDOWS,
)
def stream_slow_queries(t):
    path, spark = shared_dir(t.spark, "stream-slow"), t.spark
    beat = lambda rows: spark.createDataFrame(rows, "ts timestamp_ntz").write.mode("append").parquet(f"{path}-beats")
    for rows in ([], [(jobs.END_OF_INPUT,)]):  # the input, and then its end
        beat(rows)
        beats = spark.readStream.schema("ts timestamp_ntz").parquet(f"{path}-beats")
        jobs.run_available(jobs.stream_slow_queries(execution_stream(t), batch_folders(path), f"{path}-checkpoint", heartbeats=beats))
    return spark.read.parquet(path).drop("batch", "slow_rank")


@query(
    "stream_dedup_executions",
    "SELECT DISTINCT instance, event_id, thread_id FROM v_st_history WHERE event_id IS NOT NULL AND thread_id IS NOT NULL",
)
def stream_dedup_executions(t):
    path = shared_dir(t.spark, "stream-dedup")
    unique = jobs.stream_dedup_executions(execution_stream(t), execution_stream(t))
    writer = unique.writeStream.format("parquet").option("path", path).option("checkpointLocation", f"{path}-checkpoint")
    jobs.run_available(writer)
    return t.spark.read.parquet(path).select("instance", "event_id", "thread_id")


def stream_prate(t):
    path = shared_dir(t.spark, "stream-prate")
    spark = t.spark
    # The counters need a batch, as they are a running sum: landed whole, once, then handed on
    # in four spans of time one after another, each a folder of any number of files and a
    # micro-batch. The query stops after each span, so rates cross restarts by the state.
    t.v_counters.write.parquet(f"{path}-landed")
    landed = spark.read.schema(t.v_counters.schema).parquet(f"{path}-landed")
    first, last = landed.agg(F.min("ts"), F.max("ts")).first()
    samples = spark.readStream.schema(t.v_counters.schema)
    for k in range(4 if first else 0):
        begin, end = (first + (last - first) * i / 4 for i in (k, k + 1))
        within = (F.col("ts") >= F.lit(begin)) & ((F.col("ts") < F.lit(end)) | F.lit(k == 3))
        landed.filter(within).write.parquet(f"{path}-arrived/span={k}")
        rates = jobs.stream_prate(samples.parquet(f"{path}-arrived/span=*"), ("instance", "name"), "ts", "value", 21_600, ("event_id",))
        with jobs.rocksdb_state(spark):
            jobs.run_available(rates.writeStream.format("parquet").option("path", path).option("checkpointLocation", f"{path}-checkpoint"))
    if first is None:
        return landed.select("instance", "name", "ts", "event_id", "value", F.lit(0.0).alias("rate"))
    return spark.read.parquet(path).select("instance", "name", "ts", "event_id", "value", "rate")


query("stream_prate")(stream_prate)
ORACLES["stream_prate"] = oracle_query(RATES_SQL)
