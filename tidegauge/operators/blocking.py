"""Sessions blocked by other sessions."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidegauge import KEYS, settings
from tidegauge.functions import scalars as S
from tidegauge.operators import filters
from tidegauge.operators.ranking import may_be_top_k, top_k

SYSTEM = settings.SYSTEM_DATABASES

# Longest-blocked first, then ids, then texts.
_ORDER = ("blocked_txn_start_time", "blocked_txn_id", "blocking_txn_id", "blocked_query_id", "blocking_query_id")
_TEXTS = ("blocked_query", "blocking_query")

# The waiting and the blocking side of a lock wait.
_THREADS = ("requesting_thread_id", "blocking_thread_id")
_TRANSACTIONS = ("requesting_trx_id", "blocking_trx_id")


def _prefixed(df: DataFrame, prefix: str) -> DataFrame:
    return df.select(*KEYS, *[F.col(c).alias(f"{prefix}{c}") for c in df.columns if c not in KEYS])


def _both_sides(waits: DataFrame, sessions: DataFrame, key: str, waiting: str, blocking: str) -> DataFrame:
    """Lock waits joined to the session relation once per side (w_, b_)."""
    w, b = _prefixed(sessions, "w_"), _prefixed(sessions, "b_")
    blocked = waits.withColumnRenamed(waiting, f"w_{key}").withColumnRenamed(blocking, f"b_{key}")
    return blocked.join(w, [*KEYS, f"w_{key}"]).join(b, [*KEYS, f"b_{key}"])


def _participants(waits: DataFrame, columns: Sequence[str], key: str) -> DataFrame:
    """Ids on either side of a wait: the sessions worth looking up."""
    sides = [waits.select(*KEYS, F.col(c).alias(key)) for c in columns]
    return sides[0].unionByName(sides[1]).distinct()


def _first_blocked(
    waits: DataFrame, sessions: DataFrame, key: str, sides: Sequence[str], excluded: Sequence[str], zone: Column | str, k: int
) -> DataFrame:
    """``key`` of the sessions whose waits can be among the first ``k`` of an instance and collection.

    The report is ordered by start and id of the blocked transaction before all else, and
    every session here has a wait that is reported: those after the first k cannot be among them.
    """
    waiting, blocking = sides
    blockers = sessions.select(*KEYS, F.col(key).alias(blocking))
    blocked = waits.join(blockers, [*KEYS, blocking], "left_semi").select(*KEYS, F.col(waiting).alias(key))
    found = filters.exclude_databases(sessions, "processlist_db", excluded).join(blocked, [*KEYS, key], "left_semi")
    dated = found.select(*KEYS, key, S.utc_iso(F.col("trx_started"), zone).alias("_started"), F.col("trx_id").alias("_id"))
    return may_be_top_k(dated, KEYS, [F.asc("_started"), F.asc("_id")], k).select(*KEYS, key)


def _of_first(waits: DataFrame, first: DataFrame, key: str, waiting: str) -> DataFrame:
    return waits.join(first.withColumnRenamed(key, waiting), [*KEYS, waiting], "left_semi")


def _session_report(df: DataFrame, values: dict, zone: Column | str) -> DataFrame:
    """Transaction starts are wall clocks of the server in ``zone``; ``collected_at`` is landed in UTC."""
    fixed = {
        "blocked_txn_id": F.col("w_trx_id"),
        "blocked_thread_id": F.col("w_trx_mysql_thread_id"),
        "blocked_host": F.col("w_processlist_host"),
        "database_name": F.col("w_processlist_db"),
        "blocked_status": F.col("w_processlist_state"),
        "blocking_txn_id": F.col("b_trx_id"),
        "blocking_thread_id": F.col("b_trx_mysql_thread_id"),
        "blocking_host": F.col("b_processlist_host"),
        "blocked_txn_start_time": S.utc_iso(F.col("w_trx_started"), zone),
        "blocking_txn_start_time": S.utc_iso(F.col("b_trx_started"), zone),
        "collection_timestamp": S.utc_iso(F.col("collected_at")),
    }
    return df.select(*KEYS, *[c.alias(name) for name, c in {**fixed, **values}.items()])


def _open_threads(threads: DataFrame, trx: DataFrame, current: DataFrame) -> DataFrame:
    """Threads with an open transaction and a current statement."""
    open_trx = trx.select(*KEYS, "trx_id", "trx_mysql_thread_id", "trx_started").withColumn(
        "processlist_id", F.col("trx_mysql_thread_id")
    )
    running = current.select(*KEYS, "thread_id", "digest", "timer_wait")
    return threads.join(open_trx, [*KEYS, "processlist_id"]).join(running, [*KEYS, "thread_id"])


def first_blocked_mysql(
    lock_waits: DataFrame,
    threads: DataFrame,
    trx: DataFrame,
    current: DataFrame,
    summary: DataFrame,
    k: int,
    excluded: Sequence[str] = SYSTEM,
    zone: Column | str = "UTC",
) -> DataFrame:
    """Threads whose waits can be among the first ``k`` of ``blocking_sessions_mysql``."""
    sessions = _open_threads(threads, trx, current).join(summary.select(*KEYS, "digest"), [*KEYS, "digest"], "left_semi")
    return _first_blocked(lock_waits, sessions, "thread_id", _THREADS, excluded, zone, k)


def blocking_sessions_mysql(
    lock_waits: DataFrame,
    threads: DataFrame,
    trx: DataFrame,
    current: DataFrame,
    summary: DataFrame,
    excluded: Sequence[str] = SYSTEM,
    zone: Column | str = "UTC",
) -> DataFrame:
    """Blocked and blocking session of each lock wait, all joins inner.

    The digest summary is matched on the digest alone, so a digest known in n
    schemas yields n rows on that side.
    """
    waiting = _participants(lock_waits, _THREADS, "thread_id")
    digests = summary.select(*KEYS, "digest", F.col("digest_text").alias("summary_text"))
    sessions = _open_threads(threads.join(waiting, [*KEYS, "thread_id"], "left_semi"), trx, current).join(digests, [*KEYS, "digest"])
    joined = _both_sides(lock_waits, sessions, "thread_id", *_THREADS)
    return _session_report(
        filters.exclude_databases(joined, "w_processlist_db", excluded),
        {
            "blocked_pid": F.col("w_processlist_id").cast("string"),
            "blocking_pid": F.col("b_processlist_id").cast("string"),
            "blocked_query": F.col("w_summary_text"),
            "blocking_query": F.col("b_summary_text"),
            "blocked_query_id": F.col("w_digest"),
            "blocking_query_id": F.col("b_digest"),
            "blocking_status": F.col("b_processlist_state"),
            "blocked_query_time_ms": S.ps_to_ms(F.col("w_timer_wait")),
            "blocking_query_time_ms": S.ps_to_ms(F.col("b_timer_wait")),
        },
        zone,
    )


def thread_statements(threads: DataFrame, current: DataFrame) -> DataFrame:
    """Connected threads with their current statement, if any."""
    running = current.select(*KEYS, "thread_id", "digest_text", "digest", "timer_wait")
    return threads.filter(F.col("processlist_id").isNotNull()).join(running, [*KEYS, "thread_id"], "left")


def first_blocked_mariadb(
    trx_lock_waits: DataFrame, threads: DataFrame, trx: DataFrame, k: int, excluded: Sequence[str] = SYSTEM, zone: Column | str = "UTC"
) -> DataFrame:
    """Transactions whose waits can be among the first ``k`` of ``blocking_sessions_mariadb``."""
    connected = threads.select(*KEYS, "processlist_id", "processlist_db")
    open_trx = trx.select(*KEYS, "trx_id", F.col("trx_mysql_thread_id").alias("processlist_id"), "trx_started")
    sessions = open_trx.join(connected, [*KEYS, "processlist_id"])
    return _first_blocked(trx_lock_waits, sessions, "trx_id", _TRANSACTIONS, excluded, zone, k)


def blocking_sessions_mariadb(
    trx_lock_waits: DataFrame,
    threads: DataFrame,
    trx: DataFrame,
    current: DataFrame,
    excluded: Sequence[str] = SYSTEM,
    zone: Column | str = "UTC",
    first: int | None = None,
) -> DataFrame:
    """The same report from transaction ids; raw texts are anonymised.

    With ``first``, only the sessions that can be among so many of an instance and
    collection by ``topk_blocking``: texts decide last there, so only theirs are anonymised.
    """
    waiting = _participants(trx_lock_waits, _TRANSACTIONS, "trx_id")
    sessions = (
        trx.join(waiting, [*KEYS, "trx_id"], "left_semi")
        .withColumn("processlist_id", F.col("trx_mysql_thread_id"))
        .join(thread_statements(threads, current), [*KEYS, "processlist_id"])
    )
    joined = _both_sides(trx_lock_waits, sessions, "trx_id", *_TRANSACTIONS)
    text = lambda side: F.coalesce(F.col(f"{side}_digest_text"), F.col(f"{side}_trx_query"))
    query_id = lambda side: F.coalesce(
        F.col(f"{side}_digest"), F.md5(F.coalesce(F.col(f"{side}_trx_query"), F.lit("")))
    )
    waited_us = F.timestamp_diff("MICROSECOND", F.col("w_trx_wait_started"), F.col("collected_at"))
    report = _session_report(
        filters.exclude_databases(joined, "w_processlist_db", excluded),
        {
            "blocked_pid": F.col("w_trx_mysql_thread_id").cast("string"),
            "blocking_pid": F.col("b_trx_mysql_thread_id").cast("string"),
            "blocked_query": text("w"),
            "blocking_query": text("b"),
            "blocked_query_id": query_id("w"),
            "blocking_query_id": query_id("b"),
            "blocking_status": F.coalesce(F.col("b_processlist_state"), F.lit("Idle in transaction")),
            "blocked_query_time_ms": S.us_to_ms(waited_us),
            "blocking_query_time_ms": S.ps_to_ms(F.coalesce(F.col("b_timer_wait"), F.lit(0).cast("long"))),
        },
        zone,
    )
    if first is not None:
        report = may_be_top_k(report, KEYS, [F.asc(c) for c in _ORDER], first)
    return report.withColumns({c: S.anonymize_sql(F.col(c)) for c in _TEXTS})


def topk_blocking(
    sessions: DataFrame, k: int = settings.DEFAULT_TOP_K, ceiling: int | None = settings.MAX_TOP_K
) -> DataFrame:
    """Longest-blocked first: oldest start in UTC (whole seconds), then ids."""
    return top_k(sessions, KEYS, [F.asc(c) for c in (*_ORDER, *_TEXTS)], settings.top_k(k, ceiling))


def blocking_sessions(
    nodes: DataFrame,
    lock_waits: DataFrame,
    trx_lock_waits: DataFrame,
    threads: DataFrame,
    trx: DataFrame,
    current: DataFrame,
    summary: DataFrame,
    excluded: Sequence[str] = SYSTEM,
    k: int = settings.DEFAULT_TOP_K,
    zone: Column | str = "UTC",
    ceiling: int | None = settings.MAX_TOP_K,
    once: Callable[[str, Callable[[], DataFrame]], DataFrame] = lambda name, step: step(),
) -> DataFrame:
    """Top blocked sessions of every instance, by the form its flavor has.

    ``zone`` is the zone of the servers' clocks, or a column over ``instance``.
    Only waits that can be among the top are joined to their sessions; ``once`` may
    write them, as they are read for either side.
    """
    first = settings.top_k(k, ceiling)
    of = lambda df, flavor: df.join(
        nodes.filter(F.col("flavor") == flavor).select(*KEYS), list(KEYS), "left_semi"
    )
    by_thread, by_trx = of(lock_waits, "mysql"), of(trx_lock_waits, "mariadb")
    blocked = once("blocked_threads", lambda: first_blocked_mysql(by_thread, threads, trx, current, summary, first, excluded, zone))
    thread_waits = once("thread_waits", lambda: _of_first(by_thread, blocked, "thread_id", _THREADS[0]))
    mysql = blocking_sessions_mysql(thread_waits, threads, trx, current, summary, excluded, zone)
    blocked_trx = once("blocked_transactions", lambda: first_blocked_mariadb(by_trx, threads, trx, first, excluded, zone))
    trx_waits = once("transaction_waits", lambda: _of_first(by_trx, blocked_trx, "trx_id", _TRANSACTIONS[0]))
    mariadb = blocking_sessions_mariadb(trx_waits, threads, trx, current, excluded, zone, first)
    return topk_blocking(mariadb.unionByName(mysql), k, ceiling)
