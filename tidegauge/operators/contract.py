"""Do emitted samples keep their contract? A data-quality report."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidegauge.functions import json_nodes as J
from tidegauge.operators.catalog import METRICS

# Field, type (a trailing ! is required, a + is non-empty).
_FIELDS = {
    "MysqlSlowQueriesSample": """
        avg_cpu_time_ms number!
        avg_disk_reads number!
        avg_disk_writes number!
        avg_elapsed_time_ms number!
        collection_timestamp date-time+!
        database_name string+!
        event_type event+!
        execution_count count!
        has_full_table_scan string+!
        last_execution_timestamp date-time+!
        port string+
        query_id string+!
        query_text string+!
        schema_name string+!
        statement_type string+!
    """,
    "MysqlIndividualQueriesSample": """
        database_name string+!
        event_id integer!
        event_type event+!
        execution_time_ms number!
        hostname string+
        port string+
        query_id string+!
        query_text string+!
        query_sample_text string
        rows_examined integer!
        rows_sent integer!
        thread_id integer!
    """,
    "MysqlQueryExecutionSample": """
        access_type string
        data_read_per_join string
        eval_cost string
        event_id count
        event_type string
        filtered string
        hostname string+
        key string
        key_length string
        port string+
        possible_keys string
        prefix_cost string
        query_cost string
        read_cost string
        ref string
        rows_examined_per_scan integer
        rows_produced_per_join integer
        step_id integer
        table_name string
        thread_id count
        used_key_parts string
        using_index string
    """,
    "MysqlWaitEventsSample": """
        avg_wait_time_ms string
        collection_timestamp date-time
        database_name string
        event_type string
        hostname string
        port string
        query_id string
        query_text string
        total_wait_time_ms number
        wait_category string
        wait_event_count integer
        wait_event_name string
    """,
    "MysqlBlockingSessionSample": """
        blocked_host string!
        blocked_pid string!
        blocked_query string!
        blocked_query_id string!
        blocked_query_time_ms number!
        blocked_status string!
        blocked_thread_id integer!
        blocked_txn_id string!
        blocked_txn_start_time date-time!
        blocking_host string!
        blocking_pid string!
        blocking_query string!
        blocking_query_id string!
        blocking_query_time_ms number!
        blocking_status string!
        blocking_thread_id integer!
        blocking_txn_id string!
        blocking_txn_start_time date-time!
        collection_timestamp date-time!
        database_name string
        event_type event+!
        hostname string
        port string
    """,
}
_SERVER_REQUIRED = [m for m in METRICS if m.metric_group == "default" and m.versions == "any" and m.role is None]
_FIELDS["MysqlSample"] = "\n".join(
    [f"{m.metric} string+!" if m.source_type == "attribute" else f"{m.metric} number!" for m in _SERVER_REQUIRED]
    + ["event_type event+!", "port string+"]
)



def contract_rows() -> list[tuple[str, str, str, bool, bool]]:
    """(event type, field, kind, required, not empty) for each field; about 130 rows."""
    rows = []
    for event, text in _FIELDS.items():
        for line in text.strip().splitlines():
            name, kind = line.split()
            rows.append((event, name, kind.rstrip("!+"), kind.endswith("!"), "+" in kind))
    return rows


def _conforms(value: str, kind: str, event: str) -> str:
    """Whether a marked text is of a kind, as SQL; never null."""
    number = f"coalesce({value} RLIKE '^-?[0-9]' AND try_cast({value} AS double) IS NOT NULL, false)"
    whole = f"coalesce({number} AND cast(try_cast(try_cast({value} AS double) AS bigint) AS double) = try_cast({value} AS double), false)"
    return {
        "number": number,
        "integer": whole,
        "count": f"coalesce({whole} AND try_cast({value} AS double) >= 0, false)",
        "event": f"{value} = '{J.MARK}{event}'",
        "date-time": f"{value} RLIKE r'^{J.MARK}[0-9]{{4}}-[0-9][0-9]-[0-9][0-9]T[0-9][0-9]:[0-9][0-9]:[0-9][0-9]'",
        "string": f"startswith({value}, '{J.MARK}')",
    }[kind]


def _report(payloads: DataFrame, event: str, fields: list[tuple[str, str, bool, bool]]) -> DataFrame:
    """The counts of one event type: one row of numbers, turned on its side."""
    own = payloads.filter(F.col("event_type") == event)
    shape = "struct<" + ", ".join(f"`{J.MARK}{name}`: string" for name, *_ in fields) + ">"
    read = own.select("flavor", J.fields(J.mark_strings(F.col("payload")), shape).alias("_read"))
    sums, rows = ["count(*) AS samples"], []
    for i, (name, kind, required, non_empty) in enumerate(fields):
        value = f"_read.`{J.MARK}{name}`"
        excused = " AND NOT flavor <=> 'mariadb'" if name == "avg_cpu_time_ms" else ""
        asked = {
            "missing": f"{value} IS NULL{excused}" if required else None,
            "wrong_type": f"{value} IS NOT NULL AND NOT {_conforms(value, kind, event)}",
            "empty": f"{value} = '{J.MARK}'" if non_empty else None,
        }
        sums += [f"count_if({condition}) AS {key}{i}" for key, condition in asked.items() if condition]
        shown = ", ".join(f"{f'{key}{i}' if condition else '0L'} AS {key}" for key, condition in asked.items())
        rows.append(f"struct('{event}' AS event_type, '{name}' AS field, '{kind}' AS kind, {str(required).lower()} AS required, samples, {shown})")
    return read.selectExpr(*sums).filter("samples > 0").selectExpr(f"inline(array({', '.join(rows)}))")


def sample_contract(payloads: DataFrame) -> DataFrame:
    """Counts per event type and field: samples, missing required values,
    values of a wrong type and empty values that must not be empty.

    ``payloads`` has ``event_type`` and the JSON text ``payload``, and may have
    ``flavor``: MariaDB reports no CPU time, so its slow samples may miss it.
    Every sample is read once, within its event type, and counted in one
    aggregation that keeps a few numbers for each field; a sample that is no JSON
    object misses everything.
    """
    flavor = F.col("flavor") if "flavor" in payloads.columns else F.lit(None).cast("string")
    given = payloads.select("event_type", flavor.alias("flavor"), "payload")
    out = None
    for event in _FIELDS:
        part = _report(given, event, [row[1:] for row in contract_rows() if row[0] == event])
        out = part if out is None else out.unionByName(part)
    return out
