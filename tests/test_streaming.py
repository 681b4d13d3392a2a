import datetime as dt
import random

from pyspark.sql import functions as F

from tidegauge.operators import metrics
from tidegauge.queries.streams import batch_folders
from tidegauge.streaming import jobs

SCHEMA = "instance string, metric string, collected_at timestamp_ntz, value long"


def counters(n):
    rng, at, out = random.Random(5), dt.datetime(2024, 1, 1), []
    for i in range(n):
        at += dt.timedelta(seconds=rng.choice([1, 30, 60, 400]))
        out.append((f"h{i % 3}", "m", at, rng.randint(0, 1000) + i * 50))
    return out


def run_rates(spark, path, stream, **options):
    rates = jobs.stream_prate(stream, **options)
    with jobs.rocksdb_state(spark):
        jobs.run_available(rates.writeStream.format("parquet").option("path", f"{path}/out").option("checkpointLocation", f"{path}/cp"))
    return spark.read.parquet(f"{path}/out")


def test_rates_over_several_batches_equal_one_batch(spark, tmp_path):
    """Four micro-batches, the query started anew for each; buckets of time and slots are crossed."""
    rows = counters(160)
    landing = str(tmp_path / "in")
    for start in range(0, 160, 40):
        spark.createDataFrame(rows[start : start + 40], SCHEMA).coalesce(1).write.mode("append").parquet(landing)
        if start == 40:
            # out of order for its series, and without a value: must change nothing
            late = [(h, "m", dt.datetime(2024, 1, 1), v) for h, v in (("h0", 10**6), ("h1", None))]
            spark.createDataFrame(late, SCHEMA).coalesce(1).write.mode("append").parquet(landing)
        streamed = run_rates(spark, tmp_path, spark.readStream.schema(SCHEMA).parquet(landing), max_gap=300)
    batch = metrics.rates(spark.createDataFrame(rows, SCHEMA), ("instance", "metric"), "collected_at", "value")
    pick = lambda df: sorted(map(tuple, df.select("instance", "metric", "collected_at", "value", "rate").collect()))
    assert pick(streamed) == pick(batch)


def test_a_fast_clock_and_equal_times_across_batches(spark, tmp_path):
    """One host two hours ahead changes no other host's rates, and a tie that spans batches is still a predecessor."""
    t0 = dt.datetime(2024, 1, 1)
    at = lambda s: t0 + dt.timedelta(seconds=s)
    schema = "instance string, metric string, collected_at timestamp_ntz, event_id long, value long"
    batches = [
        [("a", "m", at(0), 1, 100), ("b", "m", at(0), 2, 100), ("ahead", "m", at(7200), 3, 5)],
        [("a", "m", at(30), 4, 400), ("b", "m", at(0), 5, 130), ("ahead", "m", at(7230), 6, 65)],
        [("b", "m", at(30), 7, 700), ("a", "m", at(60), 8, 1000), ("a", "m", at(500), 9, 2000)],
    ]
    landing = str(tmp_path / "in")
    for rows in batches:
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(landing)
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(landing)
    streamed = run_rates(spark, tmp_path, stream, tie=("event_id",))
    whole = spark.createDataFrame([r for b in batches for r in b], schema)
    batch = metrics.rates(whole, ("instance", "metric"), "collected_at", "value", tie=("event_id",))
    pick = lambda df: sorted(map(tuple, df.select("instance", "collected_at", "event_id", "rate").collect()))
    assert pick(streamed) == pick(batch)
    assert {r["event_id"]: r["rate"] for r in batch.collect()}[4] == 10.0


def test_silent_series_are_not_written_again(spark, tmp_path):
    """A micro-batch updates the states of its own hosts alone; the others stay, and are known later."""
    t0 = dt.datetime(2024, 1, 1)
    row = lambda h, s, v: (h, "m", t0 + dt.timedelta(seconds=s), v)
    landing = str(tmp_path / "in")
    batches = [[row(f"h{i}", 0, 0) for i in range(40)], [row("h1", 60, 60)], [row("h2", 120, 360), row(None, 0, 1)]]
    updated = []
    for rows in batches:
        spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(landing)
        rates = jobs.stream_prate(spark.readStream.schema(SCHEMA).parquet(landing))
        with jobs.rocksdb_state(spark):
            writer = rates.writeStream.format("parquet").option("path", str(tmp_path / "out")).option("checkpointLocation", str(tmp_path / "cp"))
            running = writer.trigger(availableNow=True).start()
            running.awaitTermination()
        updated.append(sum(s.numRowsUpdated for s in running.lastProgress.stateOperators))
    assert max(updated[1:]) < updated[0]
    got = {r["instance"]: r["rate"] for r in spark.read.parquet(str(tmp_path / "out")).filter("rate > 0").collect()}
    assert got == {"h1": 1.0, "h2": 3.0}


def test_rates_in_a_zone_with_daylight_saving(spark):
    rows = [("h", "m", dt.datetime(2024, 3, 10, 1, 59) + dt.timedelta(seconds=30 * i), 60 * i) for i in range(6)]
    zone = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        got = metrics.rates(spark.createDataFrame(rows, SCHEMA), ("instance", "metric"), "collected_at", "value").collect()
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)
    assert sorted(r["rate"] for r in got) == [0.0] + [2.0] * 5


def test_windows_close_with_the_watermark(spark, tmp_path):
    base = dt.datetime(2024, 1, 1)
    columns = (
        "instance string, collected_at timestamp_ntz, event_id long, thread_id long, digest string, digest_text string, timer_wait long, "
        "cpu_time long, rows_examined long, rows_affected long, no_index_used long, current_schema string, ts timestamp_ntz"
    )
    row = lambda s, d: ("a", base, s, 1, d, "SELECT", 10**9 * (s + 1), 0, 1, 1, 0, "db", base + dt.timedelta(seconds=s))
    spark.createDataFrame([row(1, "x"), row(2, "y"), row(29, "x"), row(31, "x"), row(200, "x")], columns).write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(columns).parquet(str(tmp_path / "in"))
    writer = jobs.stream_slow_queries(stream, batch_folders(str(tmp_path / "out")), str(tmp_path / "cp"), k=1)
    jobs.run_available(writer)
    got = spark.read.parquet(str(tmp_path / "out")).sort("collected_at").select("collected_at", "query_id", "execution_count").collect()
    assert [tuple(r) for r in got] == [
        (base + dt.timedelta(seconds=30), "x", 2),
        (base + dt.timedelta(seconds=60), "x", 1),
    ]


def test_a_heartbeat_closes_the_last_windows(spark, tmp_path):
    """Time goes on by heartbeats, also by one that comes while executions do not; none of them is an execution."""
    base = dt.datetime(2024, 1, 1)
    columns = (
        "instance string, collected_at timestamp_ntz, event_id long, thread_id long, digest string, digest_text string, timer_wait long, "
        "cpu_time long, rows_examined long, rows_affected long, no_index_used long, current_schema string, ts timestamp_ntz"
    )
    at = lambda s: base + dt.timedelta(seconds=s)
    row = lambda s, d: ("a", base, s, 1, d, "SELECT", 10**9 * (s + 1), 0, 1, 1, 0, "db", at(s))
    arrived, beats, out = (str(tmp_path / x) for x in ("in", "beats", "out"))
    spark.createDataFrame([row(1, "x"), row(31, "y"), row(200, "z")], columns).write.parquet(arrived)
    seen = []
    for beat in ([], [(at(150),)], [(at(330),)], [(jobs.END_OF_INPUT,)]):
        spark.createDataFrame(beat, "ts timestamp_ntz").write.mode("append").parquet(beats)
        if beat and beat[0][0] == at(330):
            spark.createDataFrame([row(320, "w")], columns).write.mode("append").parquet(arrived)
        streams = [spark.readStream.schema(c).parquet(p) for c, p in ((columns, arrived), ("ts timestamp_ntz", beats))]
        jobs.run_available(jobs.stream_slow_queries(streams[0], batch_folders(out), str(tmp_path / "cp"), heartbeats=streams[1]))
        seen.append(sorted(r["query_id"] for r in spark.read.parquet(out).collect()))
    assert seen == [["x", "y"], ["x", "y"], ["x", "y", "z"], ["w", "x", "y", "z"]]


def test_dedup_over_two_streams(spark, tmp_path):
    rows = [("a", i % 7, 1, dt.datetime(2024, 1, 1, 0, 0, i)) for i in range(20)] + [("a", None, 1, dt.datetime(2024, 1, 1))]
    schema = "instance string, event_id long, thread_id long, ts timestamp_ntz"
    spark.createDataFrame(rows, schema).write.parquet(str(tmp_path / "in"))
    read = lambda: spark.readStream.schema(schema).parquet(str(tmp_path / "in"))
    unique = jobs.stream_dedup_executions(read(), read())
    writer = unique.writeStream.option("checkpointLocation", str(tmp_path / "cp")).format("parquet").option("path", str(tmp_path / "out"))
    jobs.run_available(writer)
    out = spark.read.parquet(str(tmp_path / "out"))
    assert sorted(r.event_id for r in out.select("event_id").collect()) == list(range(7))
    assert out.agg(F.count(F.lit(1))).first()[0] == 7


def test_registered_rates_take_four_micro_batches(spark, sf_dir, monkeypatch):
    """A span is one micro-batch of as many files as its last stage has tasks."""
    from tidegauge.queries import QUERIES, streams

    paths, plain = [], streams.shared_dir
    monkeypatch.setattr(streams, "shared_dir", lambda *a: (paths.append(plain(*a)), paths[-1])[1])
    QUERIES["stream_prate"](spark, sf_dir)
    arrived = spark.read.parquet(f"{paths[0]}-arrived")
    assert sorted(r["span"] for r in arrived.select("span").distinct().collect()) == [0, 1, 2, 3]
    commits = spark.read.text(f"{paths[0]}-checkpoint/commits").select(F.input_file_name().alias("file")).distinct().collect()
    assert sorted(r["file"].rsplit("/", 1)[1] for r in commits) == ["0", "1", "2", "3"]


def test_a_replayed_micro_batch_adds_nothing(spark, tmp_path):
    """The sink's commit log outlives a lost query commit; what a batch left without its commit is not read."""
    from tidegauge.sources import sinks

    t0 = dt.datetime(2024, 1, 1)
    schema = "event_type string, instance string, collected_at timestamp_ntz, payload string"
    rows = lambda n: [("AB"[i % 2], f"h{i}", t0, f'{{"id":{n * 10 + i},"x.y":"{i}"}}') for i in range(4)]
    arrived, path = str(tmp_path / "in"), str(tmp_path / "out")
    run = lambda checkpoint: jobs.run_available(
        sinks.emit_stream(spark.readStream.schema(schema).parquet(arrived), path, str(tmp_path / checkpoint))
    )
    for n in range(2):
        spark.createDataFrame(rows(n), schema).coalesce(1).write.mode("append").parquet(arrived)
        run("cp")
    shown = lambda: sorted(r["payload"] for r in sinks.emitted(spark, path).collect())
    once = sorted(r[3] for n in range(2) for r in rows(n))
    assert shown() == once
    # The query's checkpoint is lost: the same input comes again as batch 0, which is committed.
    run("another")
    assert shown() == once
    # A driver died while it wrote batch 2: its samples are there, its commit is not.
    spark.createDataFrame(rows(9), schema).write.partitionBy("event_type").parquet(f"{path}/data/batch=2")
    assert shown() == once
    spark.createDataFrame(rows(2), schema).coalesce(1).write.mode("append").parquet(arrived)
    run("cp")
    assert shown() == sorted([*once, *(r[3] for r in rows(2))])
    counts = {(r["batch"], r["event_type"]): r["samples"] for r in sinks.committed(spark, path).collect()}
    assert counts == {(n, e): 2 for n in range(3) for e in "AB"}
    from pyspark.sql import types as T

    shapes = {"A": T.StructType([T.StructField("id", T.LongType()), T.StructField("x.y", T.StringType())]), "B": T.StructType([T.StructField("id", T.LongType())])}
    got = {(r["event_type"], r["id"], r["x_y"]) for r in sinks.read_payloads(sinks.emitted(spark, path), shapes).collect()}
    assert got == {("AB"[i % 2], n * 10 + i, None if i % 2 else str(i)) for n in range(3) for i in range(4)}
