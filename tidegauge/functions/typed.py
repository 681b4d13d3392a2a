"""Typing of raw text values: integer, float, boolean, else text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidegauge.functions.json_nodes import let
from tidegauge.functions.scalars import go_int

# Underscores may separate digits; a point needs a digit on one side at least.
_DIGITS = r"[0-9](?:_?[0-9])*"
_DECIMAL = rf"^[+-]?(?:{_DIGITS}(?:\.(?:{_DIGITS})?)?|\.{_DIGITS})(?:[eE][+-]?{_DIGITS})?\z"
_SPECIAL = r"(?i)^(?:[+-]?inf(?:inity)?|nan)\z"
_HEX_DIGITS = "[0-9a-fA-F](?:_?[0-9a-fA-F])*"
_HEX = rf"^([+-]?)0[xX]((?:_?{_HEX_DIGITS})?)(?:\.((?:{_HEX_DIGITS})?))?[pP]([+-]?{_DIGITS})\z"

# Accepted spellings of booleans.
_TRUE = ("1", "t", "T", "TRUE", "true", "True")
_FALSE = ("0", "f", "F", "FALSE", "false", "False")


def _decimal_value(raw: Column) -> Column:
    number = F.replace(raw, F.lit("_"), F.lit("")).try_cast("double")
    # A decimal too large for a double is not a number, it stays text.
    in_range = F.abs(number) < F.lit(float("inf"))
    return F.when(raw.rlike(_DECIMAL) & in_range, number)


def _hex_value(raw: Column) -> Column:
    """Hexadecimal floats of any length, rounded once.

    The first 15 significant digits are 60 bits; a one below them stands for any
    digit other than 0 in the rest, so the conversion to double rounds as the
    whole number would.
    """
    plain = F.replace(raw, F.lit("_"), F.lit(""))
    parts = F.struct(*[F.regexp_extract(plain, _HEX, i).alias(n) for i, n in ((1, "sign"), (2, "whole"), (3, "part"), (4, "power"))])

    def split(read: Column) -> Column:
        digits = F.ltrim(F.concat(read["whole"], read["part"]), F.lit("0"))
        head, rest = F.substring(digits, 1, 15), F.substring(digits, 16, 2**31 - 1)
        number = F.when(head == "", F.lit(0).cast("long")).otherwise(F.conv(head, 16, 10).cast("long"))
        below = (F.ltrim(rest, F.lit("0")) != "").cast("long")
        exponent = read["power"].try_cast("double") + 4 * (F.length(rest) - F.length(read["part"]))
        given = F.length(read["whole"]) + F.length(read["part"]) > 0
        return F.struct(number.bitwiseOR(below).alias("number"), exponent.alias("exponent"), (read["sign"] == "-").alias("minus"), given.alias("given"))

    def value(read: Column) -> Column:
        # Two steps, as 2 to the power alone may be out of range when the product is not.
        half = F.floor(read["exponent"] / 2).cast("double")
        size = read["number"].cast("double") * F.pow(F.lit(2.0), half) * F.pow(F.lit(2.0), read["exponent"] - half)
        size = F.when(read["number"] == 0, F.lit(0.0)).otherwise(size)
        return F.when(read["given"] & (size < F.lit(float("inf"))), F.when(read["minus"], -size).otherwise(size))

    return F.when(raw.rlike(_HEX), let(let(parts, split), value))


def _special_value(raw: Column) -> Column:
    low = F.lower(raw)
    named = (
        F.when(low.contains("nan"), F.lit(float("nan")))
        .when(low.startswith("-"), F.lit(float("-inf")))
        .otherwise(F.lit(float("inf")))
    )
    return F.when(raw.rlike(_SPECIAL), named)


def typed_value(raw: Column) -> Column:
    """Struct ``kind, v_long, v_double, v_bool, v_string``; one value is set.

    Gated by shape first: a bare cast would also take ' 5 ', '1d' and 'yes'.
    """
    as_int = go_int(raw)
    as_float = F.when(as_int.isNull(), F.coalesce(_decimal_value(raw), _special_value(raw), _hex_value(raw)))
    as_bool = F.when(
        as_int.isNull() & as_float.isNull(),
        F.when(raw.isin(*_TRUE), True).when(raw.isin(*_FALSE), False),
    )
    kind = (
        F.when(as_int.isNotNull(), "int")
        .when(as_float.isNotNull(), "float")
        .when(as_bool.isNotNull(), "bool")
        .when(raw.isNotNull(), "string")
    )
    return F.struct(
        kind.alias("kind"),
        as_int.alias("v_long"),
        as_float.alias("v_double"),
        as_bool.alias("v_bool"),
        F.when(kind == "string", raw).alias("v_string"),
    )


def numeric_value(raw: Column) -> Column:
    """Number of a raw text as double; booleans count 1/0, other text is null.

    The same result as going through ``typed_value``, but each shape is tested
    once: integers read as doubles give the nearest double either way.
    """
    flag = F.when(raw.isin(*_TRUE), 1.0).when(raw.isin(*_FALSE), 0.0)
    return F.coalesce(_decimal_value(raw), flag, _special_value(raw), _hex_value(raw))


def is_text(raw: Column) -> Column:
    return raw.isNotNull() & numeric_value(raw).isNull()
