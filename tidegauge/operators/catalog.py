"""The metric catalogue of the server sample."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidegauge.functions.json_nodes import constant_rows
from tidegauge.functions.scalars import version_lt

# Metric, raw source, kind. A source in <> is a derived metric.
DEFAULT = """
net.abortedClientsPerSecond Aborted_clients prate
net.abortedConnectsPerSecond Aborted_connects prate
net.bytesReceivedPerSecond Bytes_received prate
net.bytesSentPerSecond Bytes_sent prate
net.connectionErrorsMaxConnectionsPerSecond Connection_errors_max_connections prate
net.connectionsPerSecond Connections prate
net.maxUsedConnections Max_used_connections gauge
net.threadsConnected Threads_connected gauge
net.threadsRunning Threads_running gauge
query.comCommitPerSecond Com_commit prate
query.comDeletePerSecond Com_delete prate
query.comDeleteMultiPerSecond Com_delete_multi prate
query.comInsertPerSecond Com_insert prate
query.comInsertSelectPerSecond Com_insert_select prate
query.comReplaceSelectPerSecond Com_replace_select prate
query.comRollbackPerSecond Com_rollback prate
query.comSelectPerSecond Com_select prate
query.comUpdatePerSecond Com_update prate
query.comUpdateMultiPerSecond Com_update_multi prate
db.handlerRollbackPerSecond Handler_rollback prate
query.preparedStmtCountPerSecond Prepared_stmt_count prate
query.queriesPerSecond Queries prate
query.questionsPerSecond Questions prate
query.slowQueriesPerSecond Slow_queries prate
db.innodb.bufferPoolPagesData Innodb_buffer_pool_pages_data gauge
db.innodb.bufferPoolPagesFree Innodb_buffer_pool_pages_free gauge
db.innodb.bufferPoolPagesTotal Innodb_buffer_pool_pages_total gauge
db.innodb.dataReadBytesPerSecond Innodb_data_read prate
db.innodb.dataWrittenBytesPerSecond Innodb_data_written prate
db.innodb.logWaitsPerSecond Innodb_log_waits prate
db.innodb.rowLockCurrentWaits Innodb_row_lock_current_waits gauge
db.innodb.rowLockTimeAvg Innodb_row_lock_time_avg gauge
db.innodb.rowLockWaitsPerSecond Innodb_row_lock_waits prate
db.openFiles Open_files gauge
db.openTables Open_tables gauge
db.openedTablesPerSecond Opened_tables prate
db.tablesLocksWaitedPerSecond Table_locks_waited prate
software.edition version_comment attribute
software.version version attribute
cluster.nodeType node_type attribute
"""

# Fixed values, as above.
DEFAULT_ON_REPLICA = """
cluster.slaveRunning <replica_running> gauge
"""

DEFAULT_BELOW_8 = """
db.qCacheFreeMemoryBytes Qcache_free_memory gauge
db.qCacheNotCachedPerSecond Qcache_not_cached prate
db.qCacheUtilization <qcache_utilization> gauge
db.qCacheHitRatio <qcache_hit> gauge
"""

# Fixed values, as above.
EXTENDED = """
db.createdTmpDiskTablesPerSecond Created_tmp_disk_tables prate
db.createdTmpFilesPerSecond Created_tmp_files prate
db.createdTmpTablesPerSecond Created_tmp_tables prate
db.handlerDeletePerSecond Handler_delete prate
db.handlerReadFirstPerSecond Handler_read_first prate
db.handlerReadKeyPerSecond Handler_read_key prate
db.handlerReadRndPerSecond Handler_read_rnd prate
db.handlerReadRndNextPerSecond Handler_read_rnd_next prate
db.handlerUpdatePerSecond Handler_update prate
db.handlerWritePerSecond Handler_write prate
db.maxExecutionTimeExceededPerSecond Max_execution_time_exceeded prate
db.selectFullJoinPerSecond Select_full_join prate
db.selectFullJoinRangePerSecond Select_full_range_join prate
db.selectRangePerSecond Select_range prate
db.selectRangeCheckPerSecond Select_range_check prate
db.sortMergePassesPerSecond Sort_merge_passes prate
db.sortRangePerSecond Sort_range prate
db.sortRowsPerSecond Sort_rows prate
db.sortScanPerSecond Sort_scan prate
db.tableOpenCacheHitsPerSecond Table_open_cache_hits prate
db.tableOpenCacheMissesPerSecond Table_open_cache_misses prate
db.tableOpenCacheOverflowsPerSecond Table_open_cache_overflows prate
db.threadsCached Threads_cached gauge
db.threadsCreatedPerSecond Threads_created prate
db.threadCacheMissRate <thread_cache_miss> gauge
"""

EXTENDED_BELOW_8 = """
db.qCacheFreeBlocks Qcache_free_blocks gauge
db.qCacheHitsPerSecond Qcache_hits prate
db.qCacheInserts Qcache_inserts gauge
db.qCacheLowmemPrunesPerSecond Qcache_lowmem_prunes prate
db.qCacheQueriesInCachePerSecond Qcache_queries_in_cache prate
db.qCacheTotalBlocks Qcache_total_blocks gauge
"""

# Fixed values, as above.
INNODB = """
db.innodb.bufferPoolPagesDirty Innodb_buffer_pool_pages_dirty gauge
db.innodb.bufferPoolPagesFlushedPerSecond Innodb_buffer_pool_pages_flushed prate
db.innodb.bufferPoolReadAheadPerSecond Innodb_buffer_pool_read_ahead prate
db.innodb.bufferPoolReadAheadEvictedPerSecond Innodb_buffer_pool_read_ahead_evicted prate
db.innodb.bufferPoolReadAheadRndPerSecond Innodb_buffer_pool_read_ahead_rnd prate
db.innodb.bufferPoolReadRequestsPerSecond Innodb_buffer_pool_read_requests prate
db.innodb.bufferPoolReadsPerSecond Innodb_buffer_pool_reads prate
db.innodb.bufferPoolWaitFreePerSecond Innodb_buffer_pool_wait_free prate
db.innodb.bufferPoolWriteRequestsPerSecond Innodb_buffer_pool_write_requests prate
db.innodb.dataFsyncsPerSecond Innodb_data_fsyncs prate
db.innodb.dataPendingFsyncs Innodb_data_pending_fsyncs gauge
db.innodb.dataPendingReads Innodb_data_pending_reads gauge
db.innodb.dataPendingWrites Innodb_data_pending_writes gauge
db.innodb.dataReadsPerSecond Innodb_data_reads prate
db.innodb.dataWritesPerSecond Innodb_data_writes prate
db.innodb.logWriteRequestsPerSecond Innodb_log_write_requests prate
db.innodb.logWritesPerSecond Innodb_log_writes prate
db.innodb.numOpenFiles Innodb_num_open_files gauge
db.innodb.osLogFsyncsPerSecond Innodb_os_log_fsyncs prate
db.innodb.osLogPendingFsyncs Innodb_os_log_pending_fsyncs gauge
db.innodb.osLogPendingWrites Innodb_os_log_pending_writes gauge
db.innodb.osLogWrittenBytesPerSecond Innodb_os_log_written prate
db.innodb.pagesCreatedPerSecond Innodb_pages_created prate
db.innodb.pagesReadPerSecond Innodb_pages_read prate
db.innodb.pagesWrittenPerSecond Innodb_pages_written prate
db.innodb.rowsDeletedPerSecond Innodb_rows_deleted prate
db.innodb.rowsInsertedPerSecond Innodb_rows_inserted prate
db.innodb.rowsReadPerSecond Innodb_rows_read prate
db.innodb.rowsUpdatedPerSecond Innodb_rows_updated prate
"""

# Fixed values, as above.
MYISAM = """
db.myisam.keyBlocksNotFlushed Key_blocks_not_flushed gauge
db.myisam.keyCacheUtilization <key_cache_utilization> gauge
db.myisam.keyReadRequestsPerSecond Key_read_requests prate
db.myisam.keyReadsPerSecond Key_reads prate
db.myisam.keyWriteRequestsPerSecond Key_write_requests prate
db.myisam.keyWritesPerSecond Key_writes prate
"""

# Fixed values, as above.
REPLICA = """
cluster.lastIOErrno Last_IO_Errno gauge
cluster.lastIOError Last_IO_Error attribute
cluster.lastSQLErrno Last_SQL_Errno gauge
cluster.lastSQLError Last_SQL_Error attribute
db.relayLogSpace Relay_Log_Space gauge
"""

REPLICA_BELOW_8_4 = """
cluster.secondsBehindMaster Seconds_Behind_Master gauge
cluster.slaveIORunning Slave_IO_Running attribute
cluster.slaveSQLRunning Slave_SQL_Running attribute
cluster.masterLogFile Master_Log_File attribute
cluster.readMasterLogPos Read_Master_Log_Pos gauge
cluster.relayMasterLogFile Relay_Master_Log_File attribute
cluster.execMasterLogPos Exec_Master_Log_Pos gauge
cluster.masterHost Master_Host attribute
"""

REPLICA_FROM_8_4 = """
cluster.secondsBehindMaster Seconds_Behind_Source gauge
cluster.slaveIORunning Replica_IO_Running attribute
cluster.slaveSQLRunning Replica_SQL_Running attribute
cluster.masterLogFile Source_Log_File attribute
cluster.readMasterLogPos Read_Source_Log_Pos gauge
cluster.relayMasterLogFile Relay_Source_Log_File attribute
cluster.execMasterLogPos Exec_Source_Log_Pos gauge
cluster.masterHost Source_Host attribute
"""

# Fixed values, as above.
BACKUP = """
db.backupActive.total total_backup_active gauge
db.backupActive.logical logical_backup_active gauge
db.backupActive.physical physical_backup_active gauge
db.backupActive.tableLock table_lock_active gauge
"""

# Fixed values, as above.
BACKUP_HISTORY = """
db.backupHistory.total total_backup_history gauge
db.backupHistory.logical.count logical_backup_count gauge
db.backupHistory.logical.avgDuration logical_backup_avg_duration gauge
db.backupHistory.logical.maxDuration logical_backup_max_duration gauge
db.backupHistory.physical.count physical_backup_count gauge
db.backupHistory.physical.avgDuration physical_backup_avg_duration gauge
db.backupHistory.physical.maxDuration physical_backup_max_duration gauge
db.backupHistory.tableLock.count table_lock_count gauge
db.backupHistory.tableLock.avgDuration table_lock_avg_duration gauge
db.backupHistory.tableLock.maxDuration table_lock_max_duration gauge
"""

# text, group switched by a flag, version span, needed role
_SECTIONS = (
    (DEFAULT, "default", "any", None),
    (DEFAULT_ON_REPLICA, "default", "any", "slave"),
    (DEFAULT_BELOW_8, "default", "<8", None),
    (EXTENDED, "extended", "any", None),
    (EXTENDED_BELOW_8, "extended", "<8", None),
    (REPLICA, "extended", "any", "slave"),
    (REPLICA_BELOW_8_4, "extended", "<8.4", "slave"),
    (REPLICA_FROM_8_4, "extended", ">=8.4", "slave"),
    (INNODB, "innodb", "any", None),
    (MYISAM, "myisam", "any", None),
    (BACKUP, "backup", "any", None),
    (BACKUP_HISTORY, "backup_history", "any", None),
)

GROUPS = ("default", "extended", "innodb", "myisam", "backup", "backup_history")


@dataclass(frozen=True)
class Metric:
    metric: str
    source: str
    source_type: str
    metric_group: str
    versions: str
    role: str | None

    @property
    def derived(self) -> bool:
        return self.source.startswith("<")

    @property
    def column(self) -> str:
        """Name as a plain column: the dots of the metric become underscores."""
        return self.metric.replace(".", "_")


METRICS = tuple(
    Metric(*line.split(), group, versions, role)
    for text, group, versions, role in _SECTIONS
    for line in text.strip().splitlines()
)

SCHEMA = "metric string, source string, source_type string, metric_group string, versions string, role string"


def _entries(groups: tuple[str, ...], extra: tuple[Metric, ...] = ()) -> Column:
    """The catalogue as one array constant."""
    fields = SCHEMA.replace(" string", "").split(", ")
    chosen = [m for m in METRICS if m.metric_group in groups] + list(extra)
    return constant_rows([{f: getattr(m, f) for f in fields} for m in chosen], SCHEMA)


def metric_catalog(
    spark: SparkSession, groups: tuple[str, ...] = GROUPS, extra: tuple[Metric, ...] = ()
) -> DataFrame:
    """The catalogue as a table: 146 rows, always small enough to broadcast."""
    return spark.range(1).select(F.inline(_entries(groups, extra)))


def metric_names(groups: tuple[str, ...] = GROUPS) -> list[str]:
    """Distinct metric names, in catalogue order."""
    return list(dict.fromkeys(m.metric for m in METRICS if m.metric_group in groups))


def version_flags(collections: DataFrame, version: str = "version") -> DataFrame:
    """Adds ``below_8`` and ``below_8_4``: versions are parsed once per collection."""
    parsed = F.col(version)
    return collections.withColumns({"below_8": version_lt(parsed, 8), "below_8_4": version_lt(parsed, 8, 4)})


def fits_version(versions: Column) -> Column:
    """Query-cache groups need major < 8; replica names switch at 8.4."""
    return (
        (versions == "any")
        | ((versions == "<8") & F.col("below_8"))
        | ((versions == "<8.4") & F.col("below_8_4"))
        | ((versions == ">=8.4") & ~F.col("below_8_4"))
    )


def metric_applies(m: Metric) -> Column:
    """The rules of one metric, for a row with version flags and node_type."""
    span = {"any": F.lit(True), "<8": F.col("below_8"), "<8.4": F.col("below_8_4"), ">=8.4": ~F.col("below_8_4")}
    return span[m.versions] & (fits_role(F.lit(m.role), F.col("node_type")) if m.role else F.lit(True))


def fits_role(role: Column, node_type: Column) -> Column:
    return role.isNull() | F.coalesce(role == node_type, F.lit(False))


def catalog_by_version(collections: DataFrame, groups: tuple[str, ...] = GROUPS) -> DataFrame:
    """Catalogue entries that apply to each collection's server ``version``.

    The catalogue is one constant array unnested per row: no join, no shuffle.
    """
    attached = version_flags(collections).select("*", F.inline(_entries(groups)))
    return attached.filter(fits_version(F.col("versions"))).drop("below_8", "below_8_4")


def catalog_by_role(collections: DataFrame, groups: tuple[str, ...] = GROUPS) -> DataFrame:
    """Catalogue entries that apply to each collection's ``node_type``."""
    attached = collections.select(*collections.columns, F.inline(_entries(groups)))
    return attached.filter(fits_role(F.col("role"), F.col("node_type")))


def catalog_join(bag: DataFrame, catalog: DataFrame) -> DataFrame:
    """Metric entries for every raw key the bag has; a missing key is omitted.

    The bag carries ``name, raw``; collection columns it also carries (version,
    node_type) are kept for the applicability rules.
    """
    plain = catalog.filter(~F.col("source").startswith("<"))
    return bag.join(F.broadcast(plain), bag["name"] == plain["source"]).drop("source")
