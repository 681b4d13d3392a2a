"""Steps that several samples read are run once."""

import re
from pathlib import Path

from tidegauge.operators import samples as SM
from tidegauge.queries import fleet
from tidegauge.queries import statements as Q
from tidegauge.queries.registry import Sample, Written
from tidegauge.sources.sample_tables import VIEWS


def tables(df):
    return {Path(f).name for f in df.inputFiles() if f.endswith(("events.parquet", "orders.parquet", "lineitem.parquet"))}


def test_a_step_is_written_at_its_first_use(spark, sf_dir):
    runs = []

    def step():
        runs.append(1)
        return spark.createDataFrame([("a", 1), (None, 2), (None, 2)], "k string, n int")

    t = Written(Sample(spark, sf_dir))
    assert t.once("s", step).unionByName(t.once("s", step)).count() == 6 and runs == [1]
    assert Sample(spark, sf_dir).once("s", step).count() == 3


def test_relations_over_a_written_one_read_it(spark, tmp_path):
    """Rows that come twice and threads without an id stay, and what is written is what all read."""
    rows = [(1, "view", 7, 2.5), (2, "click", 7, 1.5), (2, "click", 7, 1.5), (3, "error", None, 0.5)]
    events = spark.createDataFrame(rows, "event_id bigint, event_type string, user_id bigint, value double").selectExpr("*", "timestamp_ntz'2024-01-01' AS ts")
    events.write.parquet(f"{tmp_path}/events.parquet")
    plain = Sample(spark, str(tmp_path))
    t = Written(plain)
    assert t.v_st_history.exceptAll(plain.v_st_history).count() == plain.v_st_history.exceptAll(t.v_st_history).count() == 0
    key = ("instance", "event_id", "thread_id")
    assert sorted(map(str, t.v_st_current.select(*key).collect())) == sorted(map(str, plain.v_st_current.select(*key).collect()))
    assert not any("events.parquet" in f for f in t.v_st_current.inputFiles())
    assert Q.summary(t).exceptAll(Q.summary(plain)).count() == 0 and not any("events.parquet" in f for f in Q.summary(t).inputFiles())


def test_samples_share_their_steps(spark, sf_dir):
    """The executions, the digests and the metrics are read where they were written, not from the tables again."""
    own = fleet.samples(Sample(spark, sf_dir))
    for event in (SM.SLOW_QUERIES_SAMPLE, SM.INDIVIDUAL_QUERIES_SAMPLE, SM.SERVER_SAMPLE):
        assert not tables(own[event]), event
    assert tables(own[SM.QUERY_EXECUTION_SAMPLE]) == {"lineitem.parquet"}


def test_batches_number_samples_that_are_there(spark, sf_dir):
    """Numbering reads its rows twice, so besides the history it reads keys that were written."""
    assert tables(fleet.publish_batches(Sample(spark, sf_dir))) == {"events.parquet"}


def test_relations_found_on_numbers_have_the_rows_of_their_text(spark, tmp_path):
    """Users, customers and orders may be null, negative or come twice."""
    at = "timestamp_ntz'2024-01-01'"
    events = [(n, "click", u, n / 4) for n, u in enumerate((7, 7, 8, None, None, -3, -3, 0))] + [(6, "click", -3, 1.5)]
    df = spark.createDataFrame(events, "event_id bigint, event_type string, user_id bigint, value double")
    df.selectExpr("*", f"{at} AS ts", "'{}' AS props").write.parquet(f"{tmp_path}/events.parquet")
    orders = [(n, c) for n in (0, 36, 7, -5, None) for c in (0, 8, 7, -1, None)] * 2
    df = spark.createDataFrame(orders, "o_orderkey bigint, o_custkey bigint")
    df.selectExpr("*", f"{at} AS o_orderdate", "'F' AS o_orderstatus").write.parquet(f"{tmp_path}/orders.parquet")
    t = Sample(spark, str(tmp_path))
    for name in ("events", "orders", "v_st_history"):
        t.table(name).createOrReplaceTempView(f"plain_{name}")
    for name in ("v_st_current", "v_lock_waits", "v_collections"):
        text = VIEWS[name].replace("NTZ", "timestamp_ntz")
        plain = spark.sql(re.sub(r"\bFROM (events|orders|v_st_history)\b", r"FROM plain_\1", text))
        found = t.table(name)
        assert found.columns == plain.columns
        assert found.exceptAll(plain).count() == plain.exceptAll(found).count() == 0, name
    # Texts are built after rows are sorted, and what is distinct is found on numbers.
    plan = lambda name: t.table(name)._jdf.queryExecution().optimizedPlan().toString()
    assert plan("v_st_current").rindex("md5") < plan("v_st_current").index("Window")
    for name in ("v_collections", "v_lock_waits"):
        (groups,) = re.findall(r"Aggregate \[(.*?)\]", plan(name))
        assert re.fullmatch(r"\w+#\d+L, \w+#\d+L", groups), name
