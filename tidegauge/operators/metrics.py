"""Metrics of the server sample: gauges, attributes, rates and ratios."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidegauge import KEYS, settings
from tidegauge.functions.scalars import go_int
from tidegauge.functions.typed import is_text, numeric_value
from tidegauge.operators import catalog as C

def applicable(bag: DataFrame, catalog: DataFrame) -> DataFrame:
    """Catalogue metrics of a bag that also carries node_type and the version
    flags of its collection."""
    fits = C.fits_version(F.col("versions")) & C.fits_role(F.col("role"), F.col("node_type"))
    return C.catalog_join(bag, catalog).filter(fits)


def gauge_metrics(entries: DataFrame) -> DataFrame:
    """Numbers as they are; a value that is no number is omitted."""
    value = numeric_value(F.col("raw"))
    gauges = entries.filter(F.col("source_type") == "gauge").withColumn("value", value)
    return gauges.filter(F.col("value").isNotNull()).select(*KEYS, "metric", "value")


def attribute_metrics(entries: DataFrame) -> DataFrame:
    return entries.filter(F.col("source_type") == "attribute").select(*KEYS, "metric", F.col("raw").alias("text"))


def _wall_micros(clock: Column) -> Column:
    """Microseconds of a wall clock since 1970. An interval between wall clocks
    is the one form that does not read them in the session zone."""
    since = clock.cast("timestamp_ntz") - F.expr("TIMESTAMP_NTZ '1970-01-01 00:00:00'")
    part = lambda unit: F.extract(F.lit(unit), since)
    minutes = (part("DAY").cast("long") * 24 + part("HOUR")) * 60 + part("MINUTE")
    return minutes * F.lit(60_000_000).cast("long") + (part("SECOND") * 1_000_000).cast("long")


def time_buckets(rows: DataFrame, time: str, max_gap: int) -> DataFrame:
    """Rows with ``_at`` (microseconds), ``_bucket`` and ``_copy``.

    Time is cut into buckets, so no task holds a whole series. Only rows in the
    last ``max_gap`` of a bucket can precede a row of the next one: those few
    are repeated there, marked as copies.
    """
    width, gap = max(12 * max_gap, 3600) * 1_000_000, max_gap * 1_000_000
    bucket = F.floor(F.col("_at") / F.lit(width))
    near_end = F.col("_at") >= (F.col("_bucket") + 1) * F.lit(width) - F.lit(gap)
    copies = F.when(near_end, F.array(F.lit(False), F.lit(True))).otherwise(F.array(F.lit(False)))
    placed = rows.withColumn("_at", _wall_micros(F.col(time))).withColumn("_bucket", bucket)
    placed = placed.withColumn("_copy", F.explode(copies))
    return placed.withColumn("_bucket", F.col("_bucket") + F.col("_copy").cast("long"))


def _paired(rows: DataFrame, series: Sequence[str], time: str, value: str, max_gap: int, tie: Sequence[str]) -> DataFrame:
    """Each row with ``_before`` and ``_us``, the previous value of its series
    and the microseconds since; both null without one within ``max_gap``."""
    line = W.partitionBy(*series, "_bucket").orderBy("_at", *tie)
    placed = time_buckets(rows, time, max_gap)
    paired = placed.withColumns({"_before": F.lag(value).over(line), "_us": F.col("_at") - F.lag("_at").over(line)})
    far = F.col("_us") > max_gap * 1_000_000
    return (
        paired.filter(~F.col("_copy"))
        .withColumns({"_before": F.when(~far, F.col("_before")), "_us": F.when(~far, F.col("_us"))})
        .drop("_at", "_bucket", "_copy")
    )


def _per_second(value: str) -> tuple[Column, Column]:
    """(rate, whether the sample counts) of a paired row."""
    first, change = F.col("_us").isNull(), F.col(value) - F.col("_before")
    rate = change.cast("double") / (F.col("_us").cast("double") / F.lit(1e6))
    return F.when(first, F.lit(0.0)).when(F.col("_us") > 0, rate), first | ((F.col("_us") > 0) & (change >= 0))


def rates(
    samples: DataFrame,
    series: Sequence[str],
    time: str,
    value: str,
    max_gap: int = settings.DEFAULT_MAX_RATE_GAP_SECONDS,
    tie: Sequence[str] = (),
) -> DataFrame:
    """Adds ``rate``, the per-second change of a counter (``value`` not null).

    First sample of a series, or one after a gap over ``max_gap``: 0. A counter
    that went down, or no time passed: row dropped.
    """
    rate, counts = _per_second(value)
    paired = _paired(samples, series, time, value, max_gap, tie)
    return paired.filter(counts).withColumn("rate", rate).drop("_before", "_us")


def prate_metrics(
    entries: DataFrame, max_gap: int = settings.DEFAULT_MAX_RATE_GAP_SECONDS, tie: Sequence[str] = ()
) -> DataFrame:
    """Per-second rates of the catalogue's counters; ``tie`` orders samples of one time and is kept."""
    counter = numeric_value(F.col("raw"))
    samples = entries.filter(F.col("source_type") == "prate").select(*KEYS, "metric", *tie, counter.alias("_v"))
    changed = rates(samples.filter(F.col("_v").isNotNull()), ("instance", "metric"), "collected_at", "_v", max_gap, tie)
    return changed.select(*KEYS, "metric", *tie, F.col("rate").alias("value"))


# --- derived ------------------------------------------------------------

_INTEGER_KEYS = (
    "Qcache_free_blocks",
    "Qcache_total_blocks",
    "Qcache_hits",
    "Queries",
    "Threads_created",
    "Connections",
    "Key_blocks_unused",
    "key_cache_block_size",
    "key_buffer_size",
)
_STATE_KEYS = ("Slave_IO_Running", "Slave_SQL_Running", "Replica_IO_Running", "Replica_SQL_Running")


def _derived_input(name: Column, raw: Column) -> Column:
    """What derived metrics read of a raw value: the integer (null when it is
    none), or 1/0 for a thread state that is or is not "Yes" (null: no text)."""
    integer = F.when(name.isin(*_INTEGER_KEYS), go_int(raw))
    state = F.when(name.isin(*_STATE_KEYS) & is_text(raw), (raw == "Yes").cast("long"))
    return F.coalesce(integer, state)


def raw_wide(bag: DataFrame) -> DataFrame:
    """The inputs of the derived metrics, one row per collection."""
    wanted = bag.filter(F.col("name").isin(*_INTEGER_KEYS, *_STATE_KEYS))
    typed = wanted.select(*KEYS, "name", _derived_input(F.col("name"), F.col("raw")).alias("v"))
    picked = [F.max(F.when(F.col("name") == key, F.col("v"))).alias(key) for key in (*_INTEGER_KEYS, *_STATE_KEYS)]
    return typed.groupBy(*KEYS).agg(*picked)


def _ratio(denominator: Column, value: Column) -> Column:
    """0 without a non-zero integer denominator; null without a numerator."""
    return F.when(F.coalesce(denominator, F.lit(0)) == 0, F.lit(0.0)).otherwise(value)


def _share(part: Column, whole: Column) -> Column:
    return F.try_divide(part.cast("double"), whole.cast("double"))


def ratio_qcache_utilization() -> Column:
    total = F.col("Qcache_total_blocks")
    return _ratio(total, F.lit(1.0) - _share(F.col("Qcache_free_blocks"), total))


def ratio_qcache_hit() -> Column:
    return _ratio(F.col("Queries"), _share(F.col("Qcache_hits"), F.col("Queries")))


def ratio_thread_cache_miss() -> Column:
    return _ratio(F.col("Connections"), _share(F.col("Threads_created"), F.col("Connections")))


def ratio_key_cache_utilization() -> Column:
    size = F.col("key_buffer_size")
    unused = F.col("Key_blocks_unused").cast("double") * F.col("key_cache_block_size").cast("double")
    return _ratio(size, F.lit(1.0) - F.try_divide(unused, size.cast("double")))


def replica_running() -> Column:
    """1 when both replication threads say Yes, else 0; null when either state
    is missing or not text. The names switch at 8.4."""
    old = F.least("Slave_IO_Running", "Slave_SQL_Running")
    new = F.least("Replica_IO_Running", "Replica_SQL_Running")
    known = lambda kind: F.col(f"{kind}_IO_Running").isNotNull() & F.col(f"{kind}_SQL_Running").isNotNull()
    return F.when(F.col("below_8_4"), F.when(known("Slave"), old)).otherwise(F.when(known("Replica"), new)).cast("double")


DERIVED = {
    "<qcache_utilization>": ratio_qcache_utilization,
    "<qcache_hit>": ratio_qcache_hit,
    "<thread_cache_miss>": ratio_thread_cache_miss,
    "<key_cache_utilization>": ratio_key_cache_utilization,
    "<replica_running>": replica_running,
}


def _metric_values(entries: DataFrame, max_gap: int) -> DataFrame:
    """``metric, value, text`` of gauges, rates, attributes and inputs of derived
    metrics; only the rows of rate metrics go through the pairing."""
    kind = F.col("source_type")
    plain = F.when(kind == "input", _derived_input(F.col("name"), F.col("raw")).cast("double"))
    number = F.when(kind != "attribute", plain.otherwise(numeric_value(F.col("raw"))))
    rows = entries.select(*KEYS, "metric", "source_type", number.alias("_v"), F.when(kind == "attribute", F.col("raw")).alias("text"))
    as_is = rows.filter((kind != "prate") & (F.col("_v").isNotNull() | F.col("text").isNotNull()))
    changed = rates(rows.filter((kind == "prate") & F.col("_v").isNotNull()), ("instance", "metric"), "collected_at", "_v", max_gap)
    shown = lambda df, value: df.select(*KEYS, "metric", F.col(value).alias("value"), "text")
    return shown(as_is, "_v").unionByName(shown(changed, "rate"))


def server_sample(
    collections: DataFrame,
    bag: DataFrame,
    groups: Sequence[str] = ("default",),
    max_gap: int = settings.DEFAULT_MAX_RATE_GAP_SECONDS,
) -> DataFrame:
    """The wide sample: one row per instance and collection.

    ``collections`` has version and node_type. ``groups`` are the switched-on
    parts; only "default" is on by default. Columns are the catalogue's names
    with underscores for dots. One aggregation makes the row of a collection, of
    its numbers, texts and inputs of derived metrics and of the collection itself,
    so one without any input still gets the ratios (0 without a denominator).
    """
    dims = C.version_flags(collections.select(*KEYS, "version", "node_type")).drop("version")
    chosen = {m.column: m for m in C.METRICS if m.metric_group in groups}
    inputs = (*_INTEGER_KEYS, *_STATE_KEYS)
    wanted = [C.Metric(f"_{key}", key, "input", "default", "any", None) for key in inputs]
    catalog = C.metric_catalog(bag.sparkSession, tuple(groups), tuple(wanted))
    values = _metric_values(applicable(bag.join(dims, list(KEYS)), catalog), max_gap)

    own = [c for c in dims.columns if c not in KEYS]
    known = dims.select(*KEYS, F.struct(*own).alias("_own"))
    pick = lambda metric, column: F.max(F.when(F.col("metric") == metric, F.col(column)))
    landed = [
        pick(m.metric, "text" if m.source_type == "attribute" else "value").alias(column)
        for column, m in chosen.items()
        if not m.derived and m.source != "node_type"
    ]
    sample = values.unionByName(known, allowMissingColumns=True).groupBy(*KEYS)
    sample = sample.agg(F.max("_own").alias("_own"), *landed, *[pick(f"_{key}", "value").alias(key) for key in inputs])
    sample = sample.select("*", *[F.col("_own")[c].alias(c) for c in own])
    shown = []
    for column, m in chosen.items():
        if m.source == "node_type":
            value = F.col("node_type")
        elif m.derived:
            value = F.when(C.metric_applies(m), DERIVED[m.source]())
        else:
            value = F.col(column)
        shown.append(value.alias(column))
    return sample.select(*KEYS, *shown)


def under_metric_names(sample: DataFrame) -> DataFrame:
    """The server sample with the catalogue's own metric names, dots and all, as it is published."""
    shown = {m.column: m.metric for m in C.METRICS}
    return sample.select(*KEYS, *[F.col(c).alias(shown[c]) for c in sample.columns if c in shown])
