"""Reading the fields of JSON objects with the built-in parser, kinds told apart.

``from_json`` to texts gives nested values back as JSON text. Two things are lost in such text:
whether a value was a string, and whether a string that looks like an object
was one. So every string literal of the document is marked first; a value that
starts with the mark was a string, anything else is a number, boolean, null,
object or array.
"""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

MARK = "~"
_STRING = r'"([^"\\]*+(?:\\.[^"\\]*+)*+)"'
_STRICT = {"allowSingleQuotes": "false", "allowNonNumericNumbers": "false", "maxStringLen": str(2**31 - 1)}


def constant_rows(rows: list[dict], schema: str) -> Column:
    """Fixed rows as one array constant (``schema`` is "name type, ..."), for
    ``inline``: no driver-side relation and no Python worker is involved."""
    columns = ",".join(":".join(field.split()) for field in schema.split(","))
    return F.from_json(F.lit(json.dumps(rows)), f"array<struct<{columns}>>")


def mark_strings(document: Column) -> Column:
    """The document with marked strings; null unless the whole text is one object.

    It is read as a field of an object that ends with a field of its own. Text
    after the document is a parse error or closes the object too early; it
    cannot forge the last field, as its own names are marked.
    """
    marked = F.regexp_replace(document, _STRING, f'"{MARK}$1"')
    whole = F.from_json(F.concat(F.lit('{"doc":'), marked, F.lit(',"end":1}')), "struct<doc:string,end:int>", _STRICT)
    return let(whole, lambda read: F.when((read["end"] == 1) & is_object(read["doc"]), read["doc"]))


def fields(node: Column, shape: str) -> Column:
    """The named fields of a marked object as texts; of repeated keys the last one counts."""
    return F.from_json(node, shape, _STRICT)


def is_object(value: Column) -> Column:
    return value.startswith("{")


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def as_text(value: Column) -> Column:
    """The string; null for any other kind of value."""
    return F.when(value.startswith(MARK), F.substring(value, 2, 2**31 - 1))


def as_number(value: Column) -> Column:
    """A JSON number as double; null for any other kind of value."""
    return F.when(value.rlike(r"^-?[0-9]"), value.try_cast("double"))


def as_integer(value: Column) -> Column:
    """A JSON number without fraction; 1.0 counts, 1.5 and "1" do not."""
    number = as_number(value)
    # The cast to long cuts the fraction off, and is null out of range.
    return let(number.try_cast("long"), lambda cut: F.when(cut.cast("double") == number, cut))
