"""tidegauge: fleet-wide database telemetry analytics on Spark.

Every operator is ``f(df, ..., params) -> DataFrame`` over landed snapshots
that carry ``instance`` and ``collected_at``; nothing is collected to the
driver inside an operator.
"""

KEYS = ("instance", "collected_at")
