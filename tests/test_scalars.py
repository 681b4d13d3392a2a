import math
import random

import duckdb
import pytest
from pyspark.sql import functions as F

from tidegauge import settings
from tidegauge.functions import scalars as S
from tidegauge.functions.typed import is_text, numeric_value, typed_value
from tidegauge.operators import filters
from tidegauge.queries.oracle_text import anonymized

ANONYMIZED = [
    (None, None),
    ("  ", "  "),
    ("CALL close_day('2024-02-29', 17)", "CALL close_day(?, ?)"),
    ("DELETE FROM w1 WHERE w1.x2 IN (5,6 , 7.25)", "DELETE FROM w1 WHERE w1.x2 IN (?,? , ?)"),
    ("flags & 0x1f <> 0xAB00", "flags & ? <> ?"),
    ("LIMIT 10 OFFSET 200", "LIMIT ? OFFSET ?"),
    ("'''' || 'a''''b'", "? || ?"),
    (r"note LIKE '100\% \'sure\''", "note LIKE ?"),
    ("t_9.c9 = 9c AND 9.", "t_9.c9 = 9c AND ?."),
    ("price*1.5E2", "price*?.5E2"),
    ("never 'closed 8", "never 'closed ?"),
    ("''", "?"),
    ("b = 1é", "b = ?é"),
]


def test_anonymize_cases(column):
    assert column(S.anonymize_sql, [a for a, _ in ANONYMIZED]) == [b for _, b in ANONYMIZED]


def test_anonymize_random_texts_match_linear_time_engine(column):
    rng = random.Random(7)
    alphabet = ["'", "''", "\\", "0x", "1", "23", ".", "e", "_", " ", "a", "F", "é", "\n", "(", "-"]
    texts = ["".join(rng.choices(alphabet, k=rng.randint(0, 14))) for _ in range(4000)]
    con = duckdb.connect()
    expected = [
        con.execute(f"SELECT {anonymized('$1')}", [t]).fetchall()[0][0] for t in texts
    ]
    assert column(S.anonymize_sql, texts) == expected


def test_anonymize_long_literals_do_not_overflow_the_stack(column):
    texts = ["'" + "x" * 300_000 + "' 5", "'" + "it''s" * 50_000 + "' 5", "'" + r"\'" * 100_000 + "' 5"]
    assert column(S.anonymize_sql, texts) == ["? ?"] * 3


def test_truncation_limit(column):
    exact, longer = "x" * 4000, "é" * 4001
    assert column(S.truncate_text, [None, exact, longer]) == [None, exact, "é" * 3997 + "..."]


def test_statement_types_are_prefixes(column):
    texts = ["SELECT 1", "INSERT", "UPDATE t", "DELETE", "select 1", " SELECT", "REPLACE", None]
    expected = ["SELECT", "INSERT", "UPDATE", "DELETE", "OTHER", "OTHER", "OTHER", "OTHER"]
    assert column(S.statement_type, texts) == expected


def test_wait_categories(column):
    names = ["wait/io/file/innodb/x", "wait/io/file/csv/x", "wait/synch/rwlock/x", "wait/lock/metadata/sql/mdl", "idle"]
    assert column(S.wait_category, names) == ["InnoDB File IO", "Other", "Other", "Metadata Lock", "Other"]


def test_escaping_order(column):
    assert column(S.escape_json_strings, ['a\\b"c`d']) == ['a\\\\b\\"c\\`d']


TYPED = [
    ("10", "int", 10), ("+7", "int", 7), ("-0", "int", 0), ("0.12", "float", 0.12), ("1e5", "float", 1e5),
    (".5", "float", 0.5), ("5.", "float", 5.0), ("1_000", "float", 1000.0), ("_1", "string", "_1"), ("1__0", "string", "1__0"),
    ("99999999999999999999", "float", 1e20), ("1e400", "string", "1e400"), ("-Inf", "float", -math.inf),
    ("infinity", "float", math.inf), ("0x_1Fp0", "float", 31.0), ("0x1_0.8p1", "float", 33.0), ("0x1__Fp0", "string", "0x1__Fp0"),
    ("0x1FFFFFFFFFFFFFFFFFFp0", "float", float(0x1FFFFFFFFFFFFFFFFFF)), ("0x1p9999", "string", "0x1p9999"), ("0x1p-2", "float", 0.25), ("0x1.8p1", "float", 3.0), ("0x1F", "string", "0x1F"),
    ("true", "bool", True), ("T", "bool", True), ("f", "bool", False), ("FALSE", "bool", False), ("tRUE", "string", "tRUE"),
    ("Yes", "string", "Yes"), ("ON", "string", "ON"), ("", "string", ""), (" 5 ", "string", " 5 "), ("1d", "string", "1d"),
    ("5\n", "string", "5\n"), ("on or off", "string", "on or off"),
]


def test_typed_values(column):
    for (raw, kind, value), got in zip(TYPED, column(typed_value, [t[0] for t in TYPED])):
        values = [v for v in (got.v_long, got.v_double, got.v_bool, got.v_string) if v is not None]
        assert (got.kind, values) == (kind, [value]), raw
    nan, missing = column(typed_value, ["NaN", None])
    assert nan.kind == "float" and math.isnan(nan.v_double)
    assert missing.kind is None


def test_numeric_value_agrees_with_typing(column):
    raws = [t[0] for t in TYPED]
    for (raw, kind, value), number, text in zip(TYPED, column(numeric_value, raws), column(is_text, raws)):
        assert text == (kind == "string"), raw
        assert number == (None if kind == "string" else float(value)), raw


def test_sanitized_versions(column):
    shown = {
        "9.4.1": "9.4.1", "8.1": "8.1.0", "12.3.4.5": "12.3.4", "8.0.35-27-percona": "8.0.35", "eight": "5.7.0",
        "10.11.8-MariaDB-deb12": "5.7.0", None: "5.7.0",
    }
    assert column(S.sanitize_version, list(shown)) == list(shown.values())


@pytest.mark.parametrize("bound", [(8,), (8, 4), (10, 2)])
def test_version_order_over_a_grid(column, bound):
    """Versions made of all pairs of a few numbers compare like pairs of numbers."""
    grid = [(a, b) for a in (0, 5, 7, 8, 9, 10, 11, 80) for b in (0, 1, 2, 3, 4, 5, 11, 40)]
    texts = [f"{a}.{b}.17" for a, b in grid]
    expected = [pair[: len(bound)] < bound for pair in grid]
    assert column(lambda c: S.version_lt(c, *bound), texts) == expected
    assert column(lambda c: S.version_at_least(c, *bound), texts) == [not e for e in expected]


def test_flavors(column):
    flavors = {"9.1.0": "mysql", "11.5.2-MariaDB-ubu2404": "mariadb", "10.5.1-mariadb": "mariadb", "": "mysql", "Maria": "mariadb"}
    assert column(S.db_flavor, list(flavors)) == list(flavors.values())


def test_rounding_of_timers(column):
    values = [0, 499_999, 500_000, 1_499_999, 1_500_000, 9_000_000_000_000_000_000]
    ms = column(S.ps_to_ms, values, "c bigint")
    assert ms == [0.0, 0.0, 0.001, 0.001, 0.002, 9_000_000_000.0]
    mean = column(lambda c: S.mean_ps_to_ms(c, F.lit(2).cast("long")), [3_000_000, 1_000_000, None], "c bigint")
    assert mean == [0.002, 0.001, None]
    assert column(lambda c: S.mean_ps_to_ms(c, F.lit(0).cast("long")), [5], "c bigint") == [None]
    text = column(lambda c: S.mean_ps_to_ms_text(c, F.lit(1).cast("long")), [12_340_000_000, 5_000_000], "c bigint")
    assert text == ["12.340", "0.005"]


@pytest.mark.parametrize("places", [2, 5])
def test_fixed_decimals_print_like_c(column, places):
    rng = random.Random(3)
    values = [0.0, 100.0, 33.335, 1.005, 0.125, 0.375, 2.675, 0.000125, 0.00723, 1e-9, -1.005, 999.999999, 0.999999]
    values += [rng.uniform(0, 10 ** rng.randint(-6, 9)) for _ in range(2000)]
    values += [rng.randint(0, 10**8) / 1000 for _ in range(2000)] + [rng.randint(0, 10**7) / 2**9 for _ in range(500)]
    values += [2.0**53, 2.0**64, 1e20, -3e25, 1e300, 1.7976931348623157e308] + [rng.uniform(1, 9) * 10 ** rng.randint(15, 307) for _ in range(50)]
    got = column(lambda c: S.fixed_decimals(c, places), values, "c double")
    assert got == [f"{v:.{places}f}" for v in values]


def test_explainable(column):
    yes = ["SELECT * FROM t", "WITH c AS (SELECT 1) SELECT * FROM c", "select 1", "  SELECT 1", "\n\twith x", "Selection"]
    no = ["DROP TABLE t", "INSERT INTO t VALUES (1)", "UPDATE t SET a = 1", "", "   ", "SELECT ?", None]
    flags = column(lambda c: filters.explainable(F.lit("id"), c), yes + no)
    assert flags == [True] * len(yes) + [False] * len(no)
    assert column(lambda c: filters.explainable(F.lit(None).cast("string"), c), ["SELECT 1"]) == [False]


def test_parameters():
    assert [settings.top_k(k) for k in (-1, 0, 15, 30, 31)] == [20, 0, 15, 30, 30]
    assert [settings.lookback_seconds(s) for s in (-1, 0, 60)] == [30, 0, 60]
    assert [settings.min_execution_ms(s) for s in (-1, 0, 5)] == [1, 0, 5]
    assert [settings.per_digest_k(k) for k in (-1, 0, 5, 30)] == [10, 0, 5, 10]
    system = list(settings.SYSTEM_DATABASES)
    assert settings.excluded_databases('["db1","db2"]') == [*system, "db1", "db2"]
    assert settings.excluded_databases('[" db1 ", "", "mysql"]') == [*system, "db1"]
    assert settings.excluded_databases('["a", 1, null, "b"]') == [*system, "a", "b"]
    assert [settings.top_k(500, None), settings.top_k(500, 100), settings.per_digest_k(500, None)] == [500, 100, 500]
    for bad in ('["db1"', "[]", "", "{}", "[1]", "null"):
        assert settings.excluded_databases(bad) == system
