"""Oracle SQL of the metric operators."""

from __future__ import annotations

from tidegauge.operators.catalog import METRICS

_DECIMAL = "[+-]?([0-9](_?[0-9])*(\\.([0-9](_?[0-9])*)?)?|\\.[0-9](_?[0-9])*)([eE][+-]?[0-9](_?[0-9])*)?"


def as_int(raw: str) -> str:
    return f"CASE WHEN regexp_full_match({raw}, '[+-]?[0-9]+') THEN try_cast({raw} AS bigint) END"


# The oracle reads no hexadecimal floats: those of the sample values, by their values.
_HEX_FLOATS = {"0x1.8p3": 12.0, "0x_1Fp-2": 7.75, "-0X.8P1": -1.0}


def as_float(raw: str) -> str:
    number = f"try_cast(replace({raw}, '_', '') AS double)"
    hexes = " ".join(f"WHEN {raw} = '{text}' THEN {value}::double" for text, value in _HEX_FLOATS.items())
    return f"CASE WHEN ({as_int(raw)}) IS NULL AND regexp_full_match({raw}, '{_DECIMAL}') AND isfinite({number}) THEN {number} {hexes} END"


def as_bool(raw: str) -> str:
    return (
        f"CASE WHEN {raw} IN ('t','T','TRUE','true','True') THEN true "
        f"WHEN {raw} IN ('f','F','FALSE','false','False') THEN false END"
    )


def as_string(raw: str) -> str:
    return f"CASE WHEN ({as_int(raw)}) IS NULL AND ({as_float(raw)}) IS NULL AND ({as_bool(raw)}) IS NULL THEN {raw} END"


def typed(raw: str) -> str:
    return (
        f"CASE WHEN {raw} IS NULL THEN NULL WHEN ({as_int(raw)}) IS NOT NULL THEN 'int' WHEN ({as_float(raw)}) IS NOT NULL THEN 'float' "
        f"WHEN ({as_bool(raw)}) IS NOT NULL THEN 'bool' ELSE 'string' END AS kind, "
        f"{as_int(raw)} AS v_long, {as_float(raw)} AS v_double, {as_bool(raw)} AS v_bool, {as_string(raw)} AS v_string"
    )


def number(raw: str) -> str:
    return f"coalesce(({as_int(raw)})::double, {as_float(raw)}, ({as_bool(raw)})::integer::double)"


_VERSION = r"'^(\d+)(?:\.(\d+))?(?:\.(\d+))?'"


def sanitized(version: str) -> str:
    part = lambda i: f"coalesce(nullif(regexp_extract({version}, {_VERSION}, {i}), ''), '0')"
    return (
        f"CASE WHEN lower({version}) LIKE '%maria%' OR NOT regexp_matches({version}, '^[0-9]') THEN '5.7.0' "
        f"ELSE concat({part(1)}, '.', {part(2)}, '.', {part(3)}) END"
    )


def older(version: str, major: int, minor: int | None = None) -> str:
    first, second = (as_int(f"split_part({version}, '.', {i})") for i in (1, 2))
    if minor is None:
        return f"coalesce(({first}) < {major}, true)"
    return f"coalesce(({first}) < {major} OR (({first}) = {major} AND ({second}) < {minor}), true) OR ({second}) IS NULL"


def _quoted(value: str | None) -> str:
    return "NULL" if value is None else f"'{value}'"


_ROWS = ", ".join(
    "(" + ", ".join(map(_quoted, (m.metric, m.source, m.source_type, m.metric_group, m.versions, m.role))) + ")" for m in METRICS
)
_REPLICA = (
    "Slave_IO_Running Slave_SQL_Running Replica_IO_Running Replica_SQL_Running Seconds_Behind_Master Seconds_Behind_Source "
    "Last_IO_Errno Last_IO_Error Relay_Log_Space Master_Host Source_Host"
).split()
_COPIED = "('key_cache_block_size', 'key_buffer_size', 'version_comment', 'version')"
_ACTIVE = "total_backup_active logical_backup_active physical_backup_active table_lock_active".split()
_HISTORY = ["total_backup_history"] + [
    f"{kind}_{stat}"
    for kind in ("logical_backup", "physical_backup", "table_lock")
    for stat in ("count", "avg_duration", "max_duration")
]


def _one(name: str, key: str, cast=as_int) -> str:
    return f"max(CASE WHEN name = '{key}' THEN {cast('raw')} END) AS {name}"


# Statements that take a backup, by kind.
_BACKUP_SHAPES = (
    ("logical_backup", "%START TRANSACTION WITH CONSISTENT SNAPSHOT%"),
    ("physical_backup", "%FLUSH TABLES%WITH READ LOCK%"),
    ("table_lock", "LOCK TABLES %"),
)
_SHAPE_ROWS = ", ".join(f"('{kind}', '{shape}')" for kind, shape in _BACKUP_SHAPES)
_HISTORY = ", ".join(
    f"coalesce(max(n) FILTER (kind = '{kind}'), 0)::bigint AS {kind}_count, coalesce(max(mean) FILTER (kind = '{kind}'), 0) AS {kind}_avg_duration, "
    f"coalesce(max(longest) FILTER (kind = '{kind}'), 0) AS {kind}_max_duration"
    for kind, _ in _BACKUP_SHAPES
)

BACKUP_CTES = {
    # Who holds a backup, once for each kind; counted afterwards.
    "o_backup_members": """
SELECT instance, 'ftwrl' AS kind, owner_thread_id::varchar AS member FROM v_metadata_locks
WHERE lock_status = 'GRANTED' AND object_type = 'BACKUP' AND starts_with(lock_type, 'BACKUP_FTWRL') AND owner_thread_id IS NOT NULL
UNION
SELECT instance, 'tables', owner_thread_id::varchar FROM v_metadata_locks
WHERE lock_status = 'GRANTED' AND object_type = 'TABLE' AND lock_duration IN ('EXPLICIT', 'TRANSACTION') AND owner_thread_id IS NOT NULL
  AND lock_type IN ('SHARED_READ', 'SHARED_NO_READ_WRITE', 'EXCLUSIVE') AND object_schema NOT IN ('performance_schema', 'information_schema', 'sys')
UNION
SELECT instance, 'snapshot', trx_id::varchar FROM v_trx
WHERE trx_state = 'RUNNING' AND trx_rows_modified = 0 AND date_sub('second', trx_started, collected_at) >= 30
UNION
SELECT instance, 'statement', id::varchar FROM v_processlist WHERE starts_with(info, 'LOCK TABLES ')""",
    "o_backup_counts": """
SELECT n.instance, n.collected_at, coalesce(n.has_metadata_locks, false) AS by_locks, count(member) FILTER (kind = 'ftwrl') AS ftwrl,
  count(member) FILTER (kind = 'tables') AS tables, count(member) FILTER (kind = 'snapshot') AS snapshots,
  count(member) FILTER (kind = 'statement') AS statements
FROM v_nodes n LEFT JOIN o_backup_members USING (instance) GROUP BY ALL""",
    "o_backup_main": """
SELECT instance, collected_at, ftwrl + tables + snapshots AS total_backup_active, snapshots AS logical_backup_active,
  ftwrl AS physical_backup_active, tables AS table_lock_active FROM o_backup_counts""",
    "o_backup_fallback": """
SELECT instance, collected_at, statements + snapshots AS total_backup_active, snapshots AS logical_backup_active,
  0::bigint AS physical_backup_active, statements AS table_lock_active FROM o_backup_counts""",
    "o_backup_auto": """
SELECT * FROM o_backup_main WHERE instance IN (SELECT instance FROM o_backup_counts WHERE by_locks)
UNION ALL
SELECT * FROM o_backup_fallback WHERE instance IN (SELECT instance FROM o_backup_counts WHERE NOT by_locks)""",
    "o_backup_history": f"""
SELECT *, logical_backup_count + physical_backup_count + table_lock_count AS total_backup_history FROM (
  SELECT n.instance, n.collected_at, {_HISTORY} FROM v_nodes n LEFT JOIN (
    SELECT instance, kind, count(*) AS n, sum(timer_wait)::double / count(timer_wait) / 1e12 AS mean, max(timer_wait)::double / 1e12 AS longest
    FROM v_st_history JOIN (VALUES {_SHAPE_ROWS}) AS k(kind, shape) ON sql_text LIKE shape GROUP BY ALL) h ON h.instance = n.instance
  GROUP BY ALL)""",
}

METRICS_CTES = {
    **BACKUP_CTES,
    "o_catalog": f"SELECT * FROM (VALUES {_ROWS}) AS c(metric, source, source_type, metric_group, versions, role)",
    "o_kv_status": """
SELECT instance, collected_at, name, coalesce(raw, '') AS raw FROM (SELECT *, row_number() OVER (
  PARTITION BY instance, collected_at, name ORDER BY ordinal DESC) AS rn FROM v_status) WHERE rn = 1""",
    "o_kv_variables": """
SELECT instance, collected_at, name, coalesce(raw, '') AS raw FROM (SELECT *, row_number() OVER (
  PARTITION BY instance, collected_at, name ORDER BY ordinal DESC) AS rn FROM v_variables) WHERE rn = 1""",
    "o_replica_first": """
SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY instance, collected_at ORDER BY ordinal) AS rn FROM v_replica) WHERE rn = 1""",
    "o_kv_replica": " UNION ALL ".join(
        f"SELECT instance, collected_at, '{c}' AS name, coalesce({c}, '') AS raw FROM o_replica_first" for c in _REPLICA
    ),
    "o_inventory": f"SELECT instance, collected_at, name, {typed('raw')} FROM o_kv_variables",
    # The three bags have no name in common, so overriding cannot occur between them.
    "o_bag": f"""
SELECT * FROM o_kv_status UNION ALL SELECT * FROM o_kv_replica
UNION ALL SELECT * FROM o_kv_variables WHERE name IN {_COPIED}""",
    "o_collections": f"""
SELECT *, {older("version", 8)} AS lt8, {older("version", 8, 4)} AS lt84 FROM (
  SELECT c.instance, c.collected_at, {sanitized("c.version")} AS version,
    CASE WHEN replica_scan = 'failed' THEN NULL WHEN r.instance IS NULL THEN 'master' ELSE 'slave' END AS node_type
  FROM v_collections c LEFT JOIN o_replica_first r ON r.instance = c.instance AND r.collected_at = c.collected_at)""",
    "o_entries": """
SELECT b.instance, b.collected_at, c.metric, c.source_type, b.raw FROM o_bag b
JOIN o_collections x ON x.instance = b.instance AND x.collected_at = b.collected_at
JOIN o_catalog c ON c.source = b.name AND (c.role IS NULL OR c.role = x.node_type)
  AND (c.versions = 'any' OR (c.versions = '<8' AND x.lt8) OR (c.versions = '<8.4' AND x.lt84) OR (c.versions = '>=8.4' AND NOT x.lt84))""",
    "o_gauges": f"""
SELECT instance, collected_at, metric, {number("raw")} AS value FROM o_entries
WHERE source_type = 'gauge' AND ({number("raw")}) IS NOT NULL""",
    "o_attributes": "SELECT instance, collected_at, metric, raw AS text FROM o_entries WHERE source_type = 'attribute'",
    "o_prates": f"""
SELECT instance, collected_at, metric, CASE WHEN first THEN 0.0 ELSE (v - before) / (us::double / 1e6) END AS value FROM (
  SELECT *, before IS NULL OR us > 172800000000 AS first FROM (
    SELECT *, lag(v) OVER w AS before, date_sub('microsecond', lag(collected_at) OVER w, collected_at) AS us FROM (
      SELECT instance, collected_at, metric, {number("raw")} AS v FROM o_entries WHERE source_type = 'prate')
    WHERE v IS NOT NULL WINDOW w AS (PARTITION BY instance, metric ORDER BY collected_at)))
WHERE first OR (us > 0 AND v >= before)""",
    "o_raw_wide": f"""
SELECT instance, collected_at, {_one("free_blocks", "Qcache_free_blocks")}, {_one("total_blocks", "Qcache_total_blocks")},
  {_one("hits", "Qcache_hits")}, {_one("queries", "Queries")}, {_one("created", "Threads_created")},
  {_one("connections", "Connections")}, {_one("unused", "Key_blocks_unused")}, {_one("block_size", "key_cache_block_size")},
  {_one("buffer_size", "key_buffer_size")}, {_one("old_io", "Slave_IO_Running", as_string)},
  {_one("old_sql", "Slave_SQL_Running", as_string)}, {_one("new_io", "Replica_IO_Running", as_string)},
  {_one("new_sql", "Replica_SQL_Running", as_string)}
FROM o_bag WHERE name IN ('Qcache_free_blocks', 'Qcache_total_blocks', 'Qcache_hits', 'Queries', 'Threads_created', 'Connections',
  'Key_blocks_unused', 'key_cache_block_size', 'key_buffer_size', 'Slave_IO_Running', 'Slave_SQL_Running', 'Replica_IO_Running',
  'Replica_SQL_Running') GROUP BY instance, collected_at""",
    "o_running": """
SELECT x.*, w.* EXCLUDE (instance, collected_at), CASE WHEN lt84 AND old_io IS NOT NULL AND old_sql IS NOT NULL
    THEN (old_io = 'Yes' AND old_sql = 'Yes')::integer::double
  WHEN NOT lt84 AND new_io IS NOT NULL AND new_sql IS NOT NULL THEN (new_io = 'Yes' AND new_sql = 'Yes')::integer::double END AS running
FROM o_collections x LEFT JOIN o_raw_wide w ON w.instance = x.instance AND w.collected_at = x.collected_at""",
    "o_derived": """
SELECT instance, collected_at, 'db.qCacheUtilization' AS metric,
  CASE WHEN coalesce(total_blocks, 0) = 0 THEN 0 ELSE 1 - free_blocks::double / total_blocks END AS value FROM o_running WHERE lt8
UNION ALL SELECT instance, collected_at, 'db.qCacheHitRatio',
  CASE WHEN coalesce(queries, 0) = 0 THEN 0 ELSE hits::double / queries END FROM o_running WHERE lt8
UNION ALL SELECT instance, collected_at, 'db.threadCacheMissRate',
  CASE WHEN coalesce(connections, 0) = 0 THEN 0 ELSE created::double / connections END FROM o_running
UNION ALL SELECT instance, collected_at, 'db.myisam.keyCacheUtilization',
  CASE WHEN coalesce(buffer_size, 0) = 0 THEN 0 ELSE 1 - unused::double * block_size::double / buffer_size::double END FROM o_running
UNION ALL SELECT instance, collected_at, 'cluster.slaveRunning', running FROM o_running WHERE node_type = 'slave'""",
    "o_backup_gauges": " UNION ALL ".join(
        f"SELECT b.instance, b.collected_at, '{m.metric}' AS metric, b.{m.source}::double AS value FROM "
        f"{'o_backup_auto' if m.source in _ACTIVE else 'o_backup_history'} b JOIN o_collections x "
        "ON x.instance = b.instance AND x.collected_at = b.collected_at"
        for m in METRICS
        if m.metric_group in ("backup", "backup_history")
    ),
    "o_sample": """
SELECT instance, collected_at, metric, value, NULL::varchar AS text FROM (
  SELECT * FROM o_gauges UNION ALL SELECT * FROM o_prates UNION ALL SELECT * FROM o_backup_gauges
  UNION ALL SELECT * FROM o_derived WHERE value IS NOT NULL)
UNION ALL SELECT instance, collected_at, metric, NULL, text FROM o_attributes
UNION ALL SELECT instance, collected_at, 'cluster.nodeType', NULL, node_type FROM o_collections WHERE node_type IS NOT NULL""",
}


def sample_columns() -> str:
    columns = {}
    for m in METRICS:
        value = "text" if m.source_type == "attribute" else "value"
        columns[m.column] = f"max(CASE WHEN metric = '{m.metric}' THEN {value} END) AS {m.column}"
    return ", ".join(columns.values())
