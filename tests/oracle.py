"""Compare a Spark result with the oracle's, order-insensitively."""

from __future__ import annotations

import math

import duckdb

from tidegauge.sources.sample_tables import TABLES


def connect(sf_dir: str):
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'")
    return con


def _cell(value):
    if isinstance(value, float):
        if math.isnan(value):
            return "nan"
        if value == 0:
            return "0.0"
        return f"{value:.15g}"
    return repr(value)


def canonical(table) -> tuple[list[str], list[str], list[tuple]]:
    names = sorted(table.column_names)
    types = [str(table.schema.field(n).type) for n in names]
    columns = [[_cell(v) for v in table.column(n).to_pylist()] for n in names]
    return names, types, sorted(zip(*columns)) if columns else []


def difference(spark_df, con, sql: str) -> str | None:
    ours = canonical(spark_df.toArrow())
    theirs = canonical(con.sql(sql).to_arrow_table())
    if ours[0] != theirs[0]:
        return f"columns {ours[0]} != {theirs[0]}"
    same = {"large_string": "string"}
    if [same.get(t, t) for t in ours[1]] != [same.get(t, t) for t in theirs[1]]:
        return f"types {list(zip(*ours[:2]))} != {list(zip(*theirs[:2]))}"
    if len(ours[2]) != len(theirs[2]):
        return f"{len(ours[2])} rows != {len(theirs[2])}"
    for a, b in zip(ours[2], theirs[2]):
        if a != b:
            return f"{[x for x in zip(ours[0], a, b) if x[1] != x[2]]}"
    return None
