"""Limits, defaults and parameter checks shared by the operators."""

from __future__ import annotations

import json

# Collector defaults and limits.
DEFAULT_LOOKBACK_SECONDS = 30
DEFAULT_MIN_EXECUTION_MS = 1
DEFAULT_TOP_K = 20
MAX_TOP_K = 30
MAX_EXECUTIONS_PER_DIGEST = 10
PUBLISH_THRESHOLD = 600
MAX_TEXT_CHARS = 4000
READY_CONSUMERS = 5
LONG_TRX_SECONDS = 30
DEFAULT_MAX_RATE_GAP_SECONDS = 300
FALLBACK_VERSION = "5.7.0"

# Databases never reported.
SYSTEM_DATABASES = ("", "mysql", "information_schema", "performance_schema", "sys")

# Consumers a server needs for statement and wait monitoring.
ESSENTIAL_CONSUMERS = (
    "events_waits_current",
    "events_waits_history_long",
    "events_waits_history",
    "events_statements_history_long",
    "events_statements_history",
    "events_statements_current",
    "events_statements_cpu",
)

MDL_INSTRUMENT = "wait/lock/metadata/sql/mdl"


def lookback_seconds(value: int) -> int:
    """Negative means default; zero is a legal, empty-looking window."""
    return DEFAULT_LOOKBACK_SECONDS if value < 0 else value


def min_execution_ms(value: int) -> int:
    return DEFAULT_MIN_EXECUTION_MS if value < 0 else value


def top_k(value: int, ceiling: int | None = MAX_TOP_K) -> int:
    """Negative means default; a caller raises the ceiling or lifts it with None."""
    wanted = DEFAULT_TOP_K if value < 0 else value
    return wanted if ceiling is None else min(wanted, ceiling)


def per_digest_k(value: int, ceiling: int | None = MAX_EXECUTIONS_PER_DIGEST) -> int:
    wanted = top_k(value, None if ceiling is None else max(ceiling, MAX_TOP_K))
    return wanted if ceiling is None else min(wanted, ceiling)


def excluded_databases(json_list: str = "[]") -> list[str]:
    """System databases plus the trimmed, non-empty names of a JSON array.

    Of an array the strings count, whatever else it holds; anything but a JSON
    array leaves the defaults.
    """
    try:
        names = json.loads(json_list)
    except ValueError:
        names = []
    if not isinstance(names, list):
        names = []
    extra = [n.strip() for n in names if isinstance(n, str) and n.strip()]
    return list(dict.fromkeys([*SYSTEM_DATABASES, *extra]))
