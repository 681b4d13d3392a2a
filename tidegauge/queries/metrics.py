"""Bags, catalogue, gauges, rates, ratios and the server sample."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidegauge.functions import scalars as S
from tidegauge.operators import backup as BK
from tidegauge.operators import catalog as C
from tidegauge.operators import kv as KV
from tidegauge.operators import metrics as M
from tidegauge.queries.oracle_metrics import METRICS_CTES, sample_columns
from tidegauge.queries.registry import Sample, query

DAY = 86_400
ROLLING_GAP = 2 * DAY


def collections(t: Sample) -> DataFrame:
    roles = KV.node_role(t.v_collections, t.v_replica)
    return roles.withColumn("version", S.sanitize_version(F.col("version"))).drop("replica_scan")


def bag(t: Sample) -> DataFrame:
    return t.once(
        "bag",
        lambda: KV.metrics_enrich(
            t.v_status,
            t.v_variables,
            KV.kv_rows_wide(t.v_replica),
            KV.bag_of(BK.backup_active_auto(t.v_nodes, t.v_metadata_locks, t.v_processlist, t.v_trx)),
            KV.bag_of(BK.backup_history(t.v_nodes, t.v_st_history)),
        ),
    )


def enriched(t: Sample) -> DataFrame:
    """The bag of status, replica and variables, without backups."""
    return KV.metrics_enrich(t.v_status, t.v_variables, KV.kv_rows_wide(t.v_replica))


def entries(t: Sample) -> DataFrame:
    dims = C.version_flags(collections(t)).drop("version")
    with_dims = enriched(t).join(dims, ["instance", "collected_at"])
    return M.applicable(with_dims, C.metric_catalog(t.spark))


@query("kv_rows", "SELECT instance, collected_at, name, raw FROM o_kv_status UNION ALL SELECT * FROM o_kv_replica", METRICS_CTES)
def kv_rows(t):
    return KV.kv_rows(t.v_status).unionByName(KV.kv_rows_wide(t.v_replica))


@query("inventory_items", "SELECT instance, collected_at, name, kind, v_long, v_double, v_bool, v_string FROM o_inventory", METRICS_CTES)
def inventory_items(t):
    return KV.inventory_items(t.v_variables)


@query("metrics_enrich", "SELECT * FROM o_bag", METRICS_CTES)
def metrics_enrich(t):
    return enriched(t)


@query("node_role", "SELECT instance, collected_at, node_type FROM o_collections", METRICS_CTES)
def node_role(t):
    return collections(t).select("instance", "collected_at", "node_type")


@query(
    "catalog_join",
    "SELECT b.instance, b.collected_at, c.metric, c.source_type, c.metric_group, b.raw FROM o_bag b JOIN o_catalog c ON c.source = b.name",
    METRICS_CTES,
)
def catalog_join(t):
    joined = C.catalog_join(enriched(t), C.metric_catalog(t.spark))
    return joined.select("instance", "collected_at", "metric", "source_type", "metric_group", "raw")


@query(
    "metric_catalog",
    """SELECT c.metric, c.source, c.source_type, c.metric_group, c.versions, c.role, coalesce(s.samples, 0)::bigint AS samples
    FROM o_catalog c LEFT JOIN (SELECT name, count(*) AS samples FROM v_status GROUP BY name) s ON s.name = c.source""",
    METRICS_CTES,
)
def metric_catalog(t):
    landed = t.v_status.groupBy("name").agg(F.count(F.lit(1)).alias("samples"))
    joined = C.metric_catalog(t.spark).join(landed, F.col("source") == F.col("name"), "left").drop("name")
    return joined.withColumn("samples", F.coalesce("samples", F.lit(0).cast("long")))


@query(
    "catalog_by_version",
    """SELECT x.instance, x.collected_at, c.metric, c.source FROM o_collections x JOIN o_catalog c ON
      c.versions = 'any' OR (c.versions = '<8' AND x.lt8) OR (c.versions = '<8.4' AND x.lt84) OR (c.versions = '>=8.4' AND NOT x.lt84)""",
    METRICS_CTES,
)
def catalog_by_version(t):
    return C.catalog_by_version(collections(t)).select("instance", "collected_at", "metric", "source")


@query(
    "catalog_by_role",
    """SELECT x.instance, x.collected_at, c.metric, c.source FROM o_collections x JOIN o_catalog c
      ON c.role IS NULL OR c.role = x.node_type""",
    METRICS_CTES,
)
def catalog_by_role(t):
    return C.catalog_by_role(collections(t)).select("instance", "collected_at", "metric", "source")


@query("gauge_metrics", "SELECT * FROM o_gauges", METRICS_CTES)
def gauge_metrics(t):
    return M.gauge_metrics(entries(t))


@query("attribute_metrics", "SELECT * FROM o_attributes", METRICS_CTES)
def attribute_metrics(t):
    return M.attribute_metrics(entries(t))


RATES_SQL = """SELECT instance, name, ts, event_id, value, CASE WHEN first THEN 0.0::double ELSE (value - before)::double / (us::double / 1e6) END AS rate
    FROM (SELECT *, before IS NULL OR us > 21600000000 AS first FROM (
      SELECT *, lag(value) OVER w AS before, date_sub('microsecond', lag(ts) OVER w, ts) AS us FROM v_counters
      WINDOW w AS (PARTITION BY instance, name ORDER BY ts, event_id)))
    WHERE first OR (us > 0 AND value >= before)"""


@query("prate_metrics", f"SELECT instance, name, ts, event_id, rate FROM ({RATES_SQL})")
def prate_metrics(t):
    """The catalogue form: raw texts of entries whose source type is a rate."""
    raw = F.col("value").cast("string").alias("raw")
    entries = t.v_counters.select("instance", F.col("ts").alias("collected_at"), F.col("name").alias("metric"), F.lit("prate").alias("source_type"), raw, "event_id")
    found = M.prate_metrics(entries, max_gap=21_600, tie=("event_id",))
    return found.select("instance", F.col("metric").alias("name"), F.col("collected_at").alias("ts"), "event_id", F.col("value").alias("rate"))


def _ratio(key: str, formula, oracle: str) -> None:
    @query(key, f"SELECT instance, collected_at, value FROM (SELECT *, {oracle} AS value FROM o_raw_wide) WHERE value IS NOT NULL", METRICS_CTES)
    def ratio(t):
        wide = M.raw_wide(enriched(t))
        return wide.select("instance", "collected_at", formula().alias("value")).filter("value IS NOT NULL")


_ratio(
    "ratio_qcache_utilization",
    M.ratio_qcache_utilization,
    "CASE WHEN coalesce(total_blocks, 0) = 0 THEN 0 ELSE 1 - free_blocks::double / total_blocks END",
)
_ratio("ratio_qcache_hit", M.ratio_qcache_hit, "CASE WHEN coalesce(queries, 0) = 0 THEN 0 ELSE hits::double / queries END")
_ratio(
    "ratio_thread_cache_miss",
    M.ratio_thread_cache_miss,
    "CASE WHEN coalesce(connections, 0) = 0 THEN 0 ELSE created::double / connections END",
)
_ratio(
    "ratio_key_cache_utilization",
    M.ratio_key_cache_utilization,
    "CASE WHEN coalesce(buffer_size, 0) = 0 THEN 0 ELSE 1 - unused::double * block_size::double / buffer_size::double END",
)


@query("replica_running", "SELECT instance, collected_at, running FROM o_running WHERE running IS NOT NULL", METRICS_CTES)
def replica_running(t):
    wide = C.version_flags(collections(t)).join(M.raw_wide(enriched(t)), ["instance", "collected_at"])
    running = M.replica_running().alias("running")
    return wide.select("instance", "collected_at", running).filter("running IS NOT NULL")


@query("server_sample", f"SELECT instance, collected_at, {sample_columns()} FROM o_sample GROUP BY instance, collected_at", METRICS_CTES)
def server_sample(t):
    return M.server_sample(collections(t), bag(t), C.GROUPS, ROLLING_GAP)
