"""The operators over unbounded input, with Structured Streaming."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter, StatefulProcessor, StatefulProcessorHandle

from tidegauge import settings
from tidegauge.operators import metrics as M
from tidegauge.operators import statements as ST


#: A heartbeat after which no execution can be on time.
END_OF_INPUT = dt.datetime(9999, 1, 1)


def run_available(writer: DataStreamWriter) -> None:
    """Process what has arrived, then stop."""
    writer.trigger(availableNow=True).start().awaitTermination()


def digest_windows(executions: DataFrame, seconds: int, delay: str, heartbeats: DataFrame | None = None) -> DataFrame:
    """Digest summary per closed window; the window end is the collection.

    The collection period of the collector is the window length, so windows
    tumble and every execution is reported once. The watermark also sees the
    ``ts`` of ``heartbeats``, which belong to no window.
    """
    since = lambda at: F.lit(at).cast("timestamp").alias("_since")
    rows = executions.select("*", since(dt.datetime(1, 1, 2)))
    if heartbeats is not None:
        rows = rows.unionByName(heartbeats.select("ts", since(END_OF_INPUT + dt.timedelta(days=300))), allowMissingColumns=True)
    # Event time must be an instant: wall clocks are read in the session zone.
    timed = rows.withColumn("ts", F.col("ts").cast("timestamp")).withWatermark("ts", delay)
    # No execution is from before year 1, no heartbeat beyond the last one. A condition on event time stays above the
    # watermark, which so sees them; any other would be applied before it.
    timed = timed.filter(F.col("ts") > F.col("_since"))
    window = F.window("ts", f"{seconds} seconds").alias("_w")
    grouped = timed.groupBy("instance", window, F.col("current_schema").alias("schema_name"), "digest", "digest_text").agg(
        *ST.summary_columns(), F.max("ts").cast("timestamp_ntz").alias("last_seen")
    )
    return grouped.withColumn("collected_at", F.col("_w.end").cast("timestamp_ntz")).drop("_w")


def stream_slow_queries(
    executions: DataFrame,
    sink: Callable[[DataFrame, int], None],
    checkpoint: str,
    seconds: int = settings.DEFAULT_LOOKBACK_SECONDS,
    delay: str = "1 minute",
    k: int = settings.DEFAULT_TOP_K,
    ceiling: int | None = settings.MAX_TOP_K,
    heartbeats: DataFrame | None = None,
) -> DataStreamWriter:
    """Slowest digests of each window, once it is closed.

    A window is closed in one micro-batch with all its digests, so ranking
    inside that batch is exact. ``sink`` gets the ranked rows and the batch id.
    ``heartbeats`` is a stream of ``ts``: time goes on by them where executions
    fail to come, and one beyond all windows (END_OF_INPUT) closes the last ones.
    """

    def rank(batch: DataFrame, batch_id: int) -> None:
        sink(ST.topk_slow(ST.slow_queries(batch, seconds), k, ceiling), batch_id)

    windows = digest_windows(executions, seconds, delay, heartbeats)
    return windows.writeStream.outputMode("append").option("checkpointLocation", checkpoint).foreachBatch(rank)


def stream_dedup_executions(current: DataFrame, history: DataFrame, delay: str = "10 minutes") -> DataFrame:
    """Executions seen in either table, once; state is kept for ``delay`` only."""
    both = ST.union_executions(current, history)
    known = both.filter(F.col("event_id").isNotNull() & F.col("thread_id").isNotNull())
    known = known.withColumn("ts", F.col("ts").cast("timestamp"))
    return known.withWatermark("ts", delay).dropDuplicatesWithinWatermark(["instance", "event_id", "thread_id"])


class LastSamples(StatefulProcessor):
    """Rates of one key's samples; the state is the last sample of each of its series.

    A row is: the key's two columns, the series' others, ``_at``, time, ties, value, ``_copy``.
    """

    def __init__(self, series: int, ties: int, max_gap: int, state: str, names: Sequence[str], keep_ms: int | None) -> None:
        self._series, self._ties, self._gap, self._schema, self._keep = series, ties, max_gap * 1_000_000, state, keep_ms
        self._row = Row(*names)

    def init(self, handle: StatefulProcessorHandle) -> None:
        self._last = handle.getListState("last", self._schema, self._keep)

    def handleInputRows(self, key: tuple, rows: Iterator[Row], timerValues: object) -> Iterator[Row]:
        n, end = self._series, self._series + 2 + self._ties
        place = lambda r: (r[n], *((x is not None, x) for x in r[n + 2 : end]))  # noqa: E731 - nulls first
        last = {tuple(r[:n]): tuple(r) for r in self._last.get()} if self._last.exists() else {}
        for row in sorted((tuple(r)[2:] for r in rows), key=place):
            before = last.get(row[:n])
            if before is not None and place(row) <= place(before):
                continue  # out of order
            last[row[:n]] = row[:-1]
            if row[-1]:
                continue
            us = None if before is None or row[n] - before[n] > self._gap else row[n] - before[n]
            if us is None:
                rate = 0.0
            elif us > 0 and row[end] >= before[end]:
                rate = float(row[end] - before[end]) / (us / 1e6)
            else:
                continue
            yield self._row(key[0], *row[:n], *row[n + 1 : end + 1], rate)
        self._last.put(list(last.values()))

    def close(self) -> None:
        pass


def stream_prate(
    samples: DataFrame,
    series: Sequence[str] = ("instance", "metric"),
    time: str = "collected_at",
    value: str = "value",
    max_gap: int = settings.DEFAULT_MAX_RATE_GAP_SECONDS,
    tie: Sequence[str] = (),
    shards: int = 2,
    slots: int = 4,
    keep_ms: int | None = None,
) -> DataFrame:
    """Counter rates over a stream: ``series``, ``time``, ``tie``, ``value`` and ``rate``.

    The state store holds the last sample of each series and writes only those
    that a micro-batch changed; silent ones cost nothing. A key is the series'
    first column (the instance), a hash of the others and a slot of time: as in
    the batch form a hot series is cut into time buckets, which take the slots in
    turn, so a bucket meets in its slot no sample nearer than ``max_gap`` but its
    own. The state of a series is at most ``slots`` samples.

    A sample not after its key's last one, by time and then ``tie``, is out of
    order and dropped. No clock of another host matters. ``keep_ms`` lets the
    state of hosts that are gone run out by the wall clock; Spark then runs
    micro-batches without end, so leave it out with ``availableNow``. The session
    needs the RocksDB state store (``rocksdb_state``).
    """
    first, *rest = series
    timed = M.time_buckets(samples.filter(F.col(value).isNotNull()), time, max_gap)
    slot = F.struct(F.pmod(F.xxhash64(*series), F.lit(shards)), F.pmod("_bucket", F.lit(slots)))
    columns = [*rest, "_at", time, *tie, value]
    keyed = timed.select(F.col(first), slot.cast("string").alias("_slot"), *columns, "_copy")
    types = {f.name: f.dataType.simpleString() for f in keyed.schema}
    typed = lambda names: ", ".join(f"`{c}` {types[c]}" for c in names)
    shown = [first, *rest, time, *tie, value]
    processor = LastSamples(len(rest), len(tie), max_gap, typed(columns), [*shown, "rate"], keep_ms)
    out = typed(shown) + ", rate double"
    mode = "None" if keep_ms is None else "ProcessingTime"
    return keyed.groupBy(first, "_slot").transformWithState(processor, out, "Append", mode)


@contextmanager
def rocksdb_state(spark: SparkSession) -> Iterator[None]:
    """Queries started within keep their state in RocksDB; the session's own setting comes back after."""
    name, value = "spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    before = spark.conf.get(name)
    spark.conf.set(name, value)
    try:
        yield
    finally:
        spark.conf.set(name, before)
