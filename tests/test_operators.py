import datetime as dt
import hashlib
import random

from pyspark.sql import functions as F

from tidegauge.operators import backup, blocking, kv, metrics, ranking, samples, statements, waits
from tidegauge.operators.catalog import METRICS, metric_names, version_flags
from tidegauge.operators.contract import sample_contract

NOW = dt.datetime(2024, 1, 31)
EXECUTION = (
    "instance string, collected_at timestamp_ntz, source int, slow_rank int, event_id long, thread_id long, "
    "digest string, timer_wait long"
)


def test_dedup_keeps_the_first_and_drops_unknown_ids(spark):
    rows = [
        ("a", NOW, 1, 1, 5, 1, "x", 900),
        ("a", NOW, 0, 2, 5, 1, "y", 100),
        ("a", NOW, 0, 1, 6, 1, "x", 100),
        ("a", NOW, 0, 1, 6, 1, "z", 300),
        ("a", NOW, 0, 1, None, 1, "x", 1),
        ("a", NOW, 0, 1, 7, None, "x", 1),
        ("b", NOW, 1, 1, 5, 1, "x", 1),
    ]
    out = statements.dedup_executions(spark.createDataFrame(rows, EXECUTION))
    got = sorted((r.instance, r.event_id, r.digest) for r in out.collect())
    assert got == [("a", 5, "y"), ("a", 6, "z"), ("b", 5, "x")]


def test_null_digest_takes_a_place_but_is_not_reported(spark):
    schema = "instance string, collected_at timestamp_ntz, query_id string, database_name string, query_text string, avg_elapsed_time_ms double"
    rows = [("a", NOW, None, "d", "t", 9.0), ("a", NOW, "q1", "d", "t", 8.0), ("a", NOW, "q2", "d", "t", 7.0)]
    out = statements.topk_slow(spark.createDataFrame(rows, schema), 2).collect()
    assert [(r.query_id, r.slow_rank) for r in out] == [("q1", 2)]
    assert statements.topk_slow(spark.createDataFrame(rows, schema), 0).count() == 0


def test_database_groups_need_database_and_text(spark):
    schema = "instance string, collected_at timestamp_ntz, query_id string, database_name string, query_sample_text string"
    rows = [("a", NOW, "1", "db1", "s"), ("a", NOW, "2", "db1", "s"), ("a", NOW, "3", None, "s"), ("a", NOW, "4", "db2", None)]
    out = statements.database_groups(spark.createDataFrame(rows, schema)).collect()
    assert [(r.database_name, r.query_count) for r in out] == [("db1", 2)]


def test_wait_totals_repeat_per_statement_row(spark):
    w = spark.createDataFrame(
        [("a", NOW, 0, 1, "idle", 2_000_000_000), ("a", NOW, 1, 1, "idle", 1_000_000_000)],
        "instance string, collected_at timestamp_ntz, source int, thread_id long, event_name string, timer_wait long",
    )
    s = spark.createDataFrame(
        [("a", NOW, 1, "q", "db", "t")] * 3 + [("a", NOW, 1, None, "db", "t"), ("a", NOW, 2, "z", "db", "t")],
        "instance string, collected_at timestamp_ntz, thread_id long, query_id string, database_name string, query_text string",
    )
    (row,) = waits.wait_events(w, s).collect()
    assert (row.total_wait_time_ms, row.wait_event_count, row.avg_wait_time_ms) == (9.0, 6, "1.500")


def test_wait_totals_pass_64_bits(spark):
    big = 9_000_000_000_000_000_000
    w = spark.createDataFrame(
        [("a", NOW, 1, "idle", big)] * 2, "instance string, collected_at timestamp_ntz, thread_id long, event_name string, timer_wait long"
    )
    s = spark.createDataFrame(
        [("a", NOW, 1, "q", "db", "t")] * 5,
        "instance string, collected_at timestamp_ntz, thread_id long, query_id string, database_name string, query_text string",
    )
    (row,) = waits.wait_events(w, s).collect()
    assert row.total_wait_time_ms == 9e10


def _naive_rates(rows, max_gap):
    out, last = [], {}
    for key, at, tie, v in sorted(rows):
        before = last.get(key)
        last[key] = (at, v)
        if before is None or (at - before[0]).total_seconds() > max_gap:
            out.append((key, at, tie, 0.0))
        else:
            seconds, change = (at - before[0]).total_seconds(), v - before[1]
            if seconds > 0 and change >= 0:
                out.append((key, at, tie, change / seconds))
    return sorted(out)


def test_rates_equal_a_plain_scan_across_bucket_borders(spark):
    rng = random.Random(1)
    rows, value = [], 0
    start = dt.datetime(2024, 1, 1)
    for i in range(3000):
        start += dt.timedelta(seconds=rng.choice([0, 1, 30, 60, 299, 300, 301, 3600]), microseconds=rng.choice([0, 0, 7]))
        value = rng.randint(0, 10**6) if rng.random() < 0.1 else value + rng.randint(0, 99)
        rows.append((rng.choice(["hot", "hot", "x"]), start, i, value))
    df = spark.createDataFrame(rows, "k string, at timestamp_ntz, tie long, v long").repartition(7)
    out = metrics.rates(df, ("k",), "at", "v", 300, ("tie",))
    got = sorted((r.k, r.at, r.tie, r.rate) for r in out.collect())
    want = _naive_rates(rows, 300)
    assert [g[:3] for g in got] == [w[:3] for w in want]
    assert all(abs(g[3] - w[3]) < 1e-9 for g, w in zip(got, want))


def test_numbering_is_gapless_in_a_hot_group(spark):
    df = spark.range(5000).select(F.when(F.col("id") % 3 == 0, "b").otherwise("a").alias("g"), "id")
    out = ranking.numbered(df, ["g"], [F.asc("id")], F.floor(F.col("id") / 700), "n").toPandas()
    for _, group in out.groupby("g"):
        assert group.sort_values("id")["n"].tolist() == list(range(len(group)))


def test_batches_hold_601_and_skip_null_models(spark):
    df = spark.range(1300).select(
        F.lit("a").alias("instance"),
        F.lit(NOW).cast("timestamp_ntz").alias("collected_at"),
        F.lit("E").alias("event_type"),
        F.col("id").alias("event_id"),
        F.when(F.col("id") < 1250, "m").alias("model"),
    )
    out = samples.publish_batches(df, ("event_id",), F.col("model"))
    sizes = {r.batch_id: r["count"] for r in out.groupBy("batch_id").count().collect()}
    assert sizes == {0: 601, 1: 601, 2: 48}


def test_record_fields_default_to_gauge_and_omit_null(spark):
    df = spark.createDataFrame([("a", 1, None, "x")], "instance string, n long, missing double, t string")
    out = samples.record_to_metrics(df, {"n": "other", "missing": "gauge", "t": "attribute"}, ("instance",))
    assert sorted(map(tuple, out.collect())) == [("a", "n", "gauge", 1.0, None), ("a", "t", "attribute", None, "x")]


def test_bag_shapes(spark):
    pairs = spark.createDataFrame(
        [("a", NOW, 1, "x", "old"), ("a", NOW, 2, "x", "new"), ("a", NOW, 3, "y", None)],
        "instance string, collected_at timestamp_ntz, ordinal long, name string, raw string",
    )
    assert sorted((r.name, r.raw) for r in kv.kv_rows(pairs).collect()) == [("x", "new"), ("y", "")]
    wide = spark.createDataFrame(
        [("a", NOW, 2, "late", 1, None), ("a", NOW, 1, "first", 2, None)],
        "instance string, collected_at timestamp_ntz, ordinal long, p string, q long, r string",
    )
    assert sorted((r.name, r.raw) for r in kv.kv_rows_wide(wide).collect()) == [("p", "first"), ("q", "2"), ("r", "")]


def _ratios(spark, pairs, version="5.7.0", node_type="master"):
    bag = spark.createDataFrame(
        [("a", NOW, n, v) for n, v in pairs.items()] or [("zz", NOW, "x", "x")],
        "instance string, collected_at timestamp_ntz, name string, raw string",
    )
    nodes = spark.createDataFrame(
        [("a", NOW, version, node_type)], "instance string, collected_at timestamp_ntz, version string, node_type string"
    )
    groups = ("default", "extended", "innodb", "myisam")
    return metrics.server_sample(nodes, bag, groups).collect()[0].asDict()


def test_ratios_without_denominator_are_zero(spark):
    for pairs in ({}, {"Queries": "0", "Connections": "0", "Qcache_total_blocks": "0", "key_buffer_size": "0"}, {"Queries": "1.5"}):
        row = _ratios(spark, pairs)
        names = ("db_qCacheUtilization", "db_qCacheHitRatio", "db_threadCacheMissRate", "db_myisam_keyCacheUtilization")
        assert [row[n] for n in names] == [0.0] * 4


def test_ratio_without_numerator_is_omitted_and_version_gates(spark):
    row = _ratios(spark, {"Queries": "10", "Connections": "4", "Threads_created": "1"})
    assert row["db_qCacheHitRatio"] is None and row["db_threadCacheMissRate"] == 0.25
    assert _ratios(spark, {"Queries": "10", "Qcache_hits": "5"}, "8.0.40")["db_qCacheHitRatio"] is None


def test_replica_states(spark):
    yes = {"Slave_IO_Running": "Yes", "Slave_SQL_Running": "Yes"}
    assert _ratios(spark, yes, "8.0.40", "slave")["cluster_slaveRunning"] == 1.0
    assert _ratios(spark, yes | {"Slave_SQL_Running": "No"}, "8.0.40", "slave")["cluster_slaveRunning"] == 0.0
    assert _ratios(spark, yes, "8.4.0", "slave")["cluster_slaveRunning"] is None
    assert _ratios(spark, yes, "8.0.40", "master")["cluster_slaveRunning"] is None
    assert _ratios(spark, yes | {"Slave_SQL_Running": "1"}, "8.0.40", "slave")["cluster_slaveRunning"] is None


def test_first_rate_is_zero_and_text_gauge_is_omitted(spark):
    row = _ratios(spark, {"Queries": "10", "Open_files": "many", "Open_tables": "true"})
    assert (row["query_queriesPerSecond"], row["db_openFiles"], row["db_openTables"]) == (0.0, None, 1.0)


def test_catalogue_size():
    assert len(METRICS) == 146 and len(metric_names()) == 138


def test_empty_backup_tables_report_zero(spark, sf_dir):
    from tidegauge.queries.registry import Sample

    t = Sample(spark, sf_dir)
    none = lambda df: df.filter("false")
    rows = backup.backup_active(t.v_nodes, none(t.v_metadata_locks), none(t.v_trx)).collect()
    assert len(rows) == 4 and {r.total_backup_active for r in rows} == {0}
    rows = backup.backup_history(t.v_nodes, none(t.v_st_history)).collect()
    assert len(rows) == 4 and {(r.total_backup_history, r.table_lock_max_duration) for r in rows} == {(0, 0.0)}


def test_one_instance_alone_gives_the_same_rows(spark, sf_dir):
    from tidegauge.queries.registry import Sample

    t = Sample(spark, sf_dir)
    one = lambda df: df.filter("instance = 'db1:3306'")

    def sessions(pick):
        summary = statements.digest_rollup(pick(t.v_st_history))
        return blocking.blocking_sessions(
            pick(t.v_nodes), pick(t.v_lock_waits), pick(t.v_trx_lock_waits), pick(t.v_threads), pick(t.v_trx),
            pick(t.v_st_current), summary,
        )

    everything = sessions(lambda df: df)
    assert sorted(map(str, one(everything).collect())) == sorted(map(str, sessions(one).collect()))


def test_version_flags_parse_once(spark):
    df = spark.createDataFrame([("8.0.40",), ("8.4.0",), ("5.7.0",)], "version string")
    got = [(r.below_8, r.below_8_4) for r in version_flags(df).collect()]
    assert got == [(False, True), (False, False), (True, True)]


def test_contract_sees_missing_wrong_and_empty(spark):
    docs = [
        '{"event_type":"MysqlIndividualQueriesSample","event_id":1,"thread_id":2.0,"query_id":"","query_text":"{x}",'
        '"execution_time_ms":1.5,"rows_sent":"3","rows_examined":1.5,"database_name":"d"}',
        '{"event_type":"Other","event_id":null}',
    ]
    df = spark.createDataFrame([("MysqlIndividualQueriesSample", d) for d in docs], "event_type string, payload string")
    report = {r.field: (r.missing, r.wrong_type, r.empty) for r in sample_contract(df).collect()}
    assert report["query_id"] == (1, 0, 1)
    assert report["rows_sent"] == (1, 1, 0) and report["rows_examined"] == (1, 1, 0)
    assert report["thread_id"] == (1, 0, 0) and report["event_type"] == (0, 1, 0)
    assert report["port"] == (0, 0, 0) and report["query_text"] == (1, 0, 0)


def test_numbering_keeps_null_groups(spark):
    rows = [("a", NOW, "x", 1), ("a", NOW, None, 2), (None, NOW, "x", 3), (None, NOW, None, 4), (None, NOW, None, 5)]
    df = spark.createDataFrame(rows, "instance string, collected_at timestamp_ntz, event_type string, event_id long")
    out = samples.publish_batches(df, ("event_id",)).collect()
    assert sorted(r["event_id"] for r in out) == [1, 2, 3, 4, 5] and {r["batch_id"] for r in out} == {0}


def test_contract_counts_broken_samples_by_flavor(spark):
    slow = "MysqlSlowQueriesSample"
    rows = [("a", "mysql", '{"query_id":"q","avg_elapsed_time_ms":"1"}'), ("b", "mariadb", '{"query_id":""}')]
    df = spark.createDataFrame([(slow, *r) for r in rows], "event_type string, instance string, flavor string, payload string")
    got = {r["field"]: r for r in sample_contract(df).collect()}
    assert (got["avg_cpu_time_ms"]["samples"], got["avg_cpu_time_ms"]["missing"]) == (2, 1)
    assert got["avg_elapsed_time_ms"]["wrong_type"] == 1 and got["avg_elapsed_time_ms"]["missing"] == 1


def test_limits_are_defaults_that_a_caller_lifts(spark):
    rows = [("a", NOW, 0, None, i, i, "d", 100 + i) for i in range(60)]
    executions = spark.createDataFrame(rows, EXECUTION)
    assert statements.topk_per_digest(executions, 50).count() == 10
    assert statements.topk_per_digest(executions, 50, ceiling=None).count() == 50


def test_texts_are_anonymised_for_sessions_that_can_be_reported(spark):
    """Of sessions that differ in their texts alone the anonymised texts decide, and others' texts are not read."""
    df = lambda rows, schema: spark.createDataFrame([("a", NOW, *r) for r in rows], f"instance string, collected_at timestamp_ntz, {schema}")
    start = lambda hour: dt.datetime(2024, 1, 30, hour)
    trx = [("t1", 101, start(1), "z = 1"), ("t1", 101, start(1), "b = 2"), ("t2", 102, start(2), "c = 3"), ("t3", 103, start(3), None)]
    none = {"digest": "string", "digest_text": "string", "timer_wait": "long"}
    tables = {
        "nodes": df([("mariadb",)], "flavor string"),
        "lock_waits": df([], "requesting_thread_id long, blocking_thread_id long"),
        "trx_lock_waits": df([("t1", "t3"), ("t2", "t3"), ("t2", "t3")], "requesting_trx_id string, blocking_trx_id string"),
        "threads": df([(n, 100 + n, "h", "d", None) for n in (1, 2, 3)], "thread_id long, processlist_id long, processlist_host string, processlist_db string, processlist_state string"),
        "trx": df([(i, n, s, s, q) for i, n, s, q in trx], "trx_id string, trx_mysql_thread_id long, trx_started timestamp_ntz, trx_wait_started timestamp_ntz, trx_query string"),
        "current": df([], ", ".join(["thread_id long", *(f"{c} {kind}" for c, kind in none.items())])),
        "summary": df([], "digest string, digest_text string"),
    }
    shown = lambda k: sorted((r.blocked_txn_id, r.blocked_query) for r in blocking.blocking_sessions(**tables, k=k).collect())
    # Ids come before texts, and an id of a text is a digest of the raw one.
    first = min(("z = 1", "b = 2"), key=lambda text: hashlib.md5(text.encode()).hexdigest())
    assert shown(1) == [("t1", first.replace(first[-1], "?"))]
    assert shown(2) == [("t1", "b = ?"), ("t1", "z = ?")] and shown(3) == [*shown(2), ("t2", "c = ?")]
    assert shown(10) == [*shown(3), ("t2", "c = ?")] and shown(0) == []
    plan = blocking.blocking_sessions(**tables, k=1)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.rindex("regexp_replace(") < plan.index(" rank(")


def test_rows_that_tie_with_the_last_one_may_be_first(spark):
    rows = [("a", 1, "x"), ("a", 1, "y"), ("a", 2, "z"), (None, 5, "u"), (None, None, "v")]
    out = ranking.may_be_top_k(spark.createDataFrame(rows, "g string, n int, t string"), ["g"], [F.asc("n")], 1)
    assert sorted(r.t for r in out.collect()) == ["v", "x", "y"]


def test_only_waits_that_can_be_reported_are_joined(spark):
    """Sessions after the first are not looked up, and a session takes a place only by a wait that is reported."""
    df = lambda rows, schema: spark.createDataFrame(rows, f"instance string, collected_at timestamp_ntz, {schema}")
    both = lambda rows, schema: df([(i, NOW, *r) for i in ("my", "ma") for r in rows], schema)
    # Thread 1 is excluded by its database, 2 waits for a thread without a session, 5 and 6 started at once.
    threads = [(n, 100 + n, "h", "mysql" if n == 1 else "d", "s") for n in range(1, 10)]
    trx = [(f"t{n}", 100 + n, (s := dt.datetime(2024, 1, 30, min(n, 5))), s, f"q{n}") for n in range(1, 10)]
    waits = [(1, 9), (2, 10), (3, 9), (3, 8), (3, 8), (4, 9), (5, 9), (6, 9), (None, 9), (4, None)]
    tables = {
        "nodes": df([("my", NOW, "mysql"), ("ma", NOW, "mariadb")], "flavor string"),
        "lock_waits": both(waits, "requesting_thread_id long, blocking_thread_id long"),
        "trx_lock_waits": both([tuple(n and f"t{n}" for n in w) for w in waits], "requesting_trx_id string, blocking_trx_id string"),
        "threads": both(threads, "thread_id long, processlist_id long, processlist_host string, processlist_db string, processlist_state string"),
        "trx": both(trx, "trx_id string, trx_mysql_thread_id long, trx_started timestamp_ntz, trx_wait_started timestamp_ntz, trx_query string"),
        "current": both([(n, f"d{n}", f"text {n}", 10**9) for n in range(1, 10)], "thread_id long, digest string, digest_text string, timer_wait long"),
        "summary": both([(f"d{n}", f"text {n}") for n in range(1, 10) for _ in range(2)], "digest string, digest_text string"),
    }
    steps = {}

    def once(name, step):
        return steps.setdefault(name, step())

    def shown(k, **how):
        return [(r.instance, r.blocked_txn_id, r.blocking_txn_id) for r in blocking.blocking_sessions(**tables, k=k, **how).collect()]

    everything = sorted(shown(30))
    assert {r[1] for r in everything} == {"t3", "t4", "t5", "t6"} and len(everything) == 6 * 4 + 6
    for k in (0, 1, 4, 13):
        first = [r for i in ("ma", "my") for r in [x for x in everything if x[0] == i][:k]]
        assert sorted(shown(k)) == first, k
    assert sorted(shown(1, once=once)) == [("ma", "t3", "t8"), ("my", "t3", "t8")]
    assert [r.thread_id for r in steps["blocked_threads"].collect()] == [3]
    assert sorted(tuple(r)[2:] for r in steps["thread_waits"].collect()) == [(3, 8), (3, 8), (3, 9)]
    assert sorted(tuple(r)[2:] for r in steps["transaction_waits"].collect()) == [("t3", "t8"), ("t3", "t8"), ("t3", "t9")]
