"""Execution-plan documents flattened to steps.

A document is parsed once, inside its own row, so the whole operator is one
map-only stage: no shuffle and no driver loop, and its work is linear in the
text whatever its depth. A text that is not one JSON object, or is nested deeper
than LEVELS, gives no steps; ``plan_rejects`` lists such documents.

Catalyst has no expression for this walk: variants sort an object's keys and
drop repeated ones, and ``from_json`` to maps reads a subtree again on each level.
"""

from __future__ import annotations

import json
import math
import re
from collections.abc import Iterator, Sequence
from operator import itemgetter

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidegauge import KEYS
from tidegauge.operators import filters

#: Objects and arrays nested deeper than this make a document unreadable.
LEVELS = 1000
#: Documents that are held as objects at once.
SLICE = 1000
STEP = {
    "step_id": "int",
    "query_cost": "string",
    "table_name": "string",
    "access_type": "string",
    "rows_examined_per_scan": "long",
    "rows_produced_per_join": "long",
    "filtered": "string",
    "read_cost": "string",
    "eval_cost": "string",
    "possible_keys": "string",
    "key": "string",
    "used_key_parts": "string",
    "ref": "string",
    "prefix_cost": "string",
    "data_read_per_join": "string",
    "using_index": "string",
    "key_length": "string",
}
_ARROW = {"int": pa.int32(), "long": pa.int64(), "string": pa.string()}


class _Repeated(list):
    """The pairs of an object that repeats keys."""


def _constant(name: str) -> None:
    raise ValueError(name)


_DEEPER = np.zeros(256, np.int32)
_DEEPER[[ord("{"), ord("[")]], _DEEPER[[ord("}"), ord("]")]] = 1, -1


def _nesting(text: str) -> int:
    """How deep objects and arrays are nested, in a text that is JSON; of another one, any number."""
    between = re.sub(r"\\.", "", text, flags=re.S).split('"')[::2]
    return int(_DEEPER[np.frombuffer("".join(between).encode(), np.uint8)].cumsum().max(initial=0))


def _all_pairs(pairs: list[tuple]) -> dict | _Repeated:
    found = dict(pairs)
    return found if len(found) == len(pairs) else _Repeated(pairs)


def _last_pairs(pairs: list[tuple]) -> dict:
    found = dict(pairs)
    if len(found) < len(pairs):
        found = {}
        for key, value in pairs:
            found.pop(key, None)
            found[key] = value
    return found


_DEEP = frozenset((dict, list, _Repeated))


def _most_keys(text: str) -> int:
    """No fewer than the keys that a JSON text writes: its colons, but for those after a quote within a string."""
    return text.count(":") - (0 if "\\\\" in text else text.count('\\":'))


def _keys(root: object) -> int:
    """The keys of all objects read."""
    found, level = 0, [root]
    while level:
        node = level.pop()
        if type(node) is dict:
            found += len(node)
            node = node.values()
        level += [v for v in node if type(v) in _DEEP]
    return found


class Reader:
    """Reads documents; made within a task, as decoders do not travel."""

    def __init__(self) -> None:
        self._plain = json.JSONDecoder(parse_constant=_constant)
        self._all = json.JSONDecoder(parse_constant=_constant, object_pairs_hook=_all_pairs)
        self._last = json.JSONDecoder(parse_constant=_constant, object_pairs_hook=_last_pairs)

    def document(self, text: str, mariadb: bool) -> dict | _Repeated | None:
        """The document's root object; null unless the whole text is one object within the limits.

        MariaDB repeats keys on purpose and keeps all; elsewhere the last of them
        stays, in its own place. Only a text that may repeat keys, as it writes more than
        a plain decoder finds, is read pair by pair there.
        """
        if text.count("{") + text.count("[") > LEVELS and _nesting(text) > LEVELS:
            return None
        try:
            root = (self._all if mariadb else self._plain).decode(text)
            if not mariadb and type(root) is dict and _most_keys(text) != _keys(root):
                root = self._last.decode(text)
        except (ValueError, RecursionError):
            return None
        return root if isinstance(root, (dict, _Repeated)) else None


def _number(value: object) -> float | None:
    """A JSON number within a double's range."""
    if type(value) not in (int, float):
        return None
    try:
        number = float(value)
    except OverflowError:
        return None
    return number if math.isfinite(number) else None


def _whole(value: object) -> int | None:
    """A number without fraction within 64 bits; 1.0 counts, 1.5 and "1" do not."""
    if type(value) is int and -(2**53) <= value <= 2**53:
        return value
    number = _number(value)
    return int(number) if number is not None and number.is_integer() and -(2.0**63) <= number < 2.0**63 else None


def _text(value: object) -> str:
    """The string; empty for any other kind of value."""
    return value if type(value) is str else ""


def _list(value: object) -> str:
    """An array of strings, null as the empty one, joined; empty when any element is of another kind."""
    if type(value) is not list:
        return ""
    try:
        return ",".join(value)
    except TypeError:
        return ",".join(e or "" for e in value) if all(e is None or type(e) is str for e in value) else ""


def _text_or_number(value: object, places: int) -> str:
    """String as it is, number with fixed decimals, else empty."""
    if type(value) is str:
        return value
    number = _number(value)
    return "" if number is None else f"{number:.{places}f}"


def _shown_cost(get: dict, info: dict, inherited: object) -> object:
    """``cost_info.query_cost``, else the flat number, else inherited."""
    quoted, flat = info.get("query_cost"), get.get("cost")
    if type(quoted) is str and quoted:
        return quoted
    return flat if type(flat) in (int, float) else inherited


def rows_examined(get: dict) -> int:
    """``rows_examined_per_scan``, else ``rows``; 0 is a value, not a gap."""
    first = _whole(get.get("rows_examined_per_scan"))
    return first if first is not None else _whole(get.get("rows")) or 0


def rows_produced(get: dict) -> int:
    return _whole(get.get("rows_produced_per_join")) or 0


def _reported(get: dict, info: dict) -> bool:
    """Whether any value makes the node a step."""
    filtered = get.get("filtered")
    if _text(get.get("table_name")) or _text(get.get("access_type")) or _text(filtered) or type(filtered) in (int, float):
        return True
    return bool(rows_examined(get) or rows_produced(get) or _text(info.get("read_cost")) or _text(info.get("eval_cost")))


def _first(node: object) -> dict:
    """An object for lookups, which find the first of repeated keys; empty for all else."""
    if isinstance(node, _Repeated):
        return dict(reversed(node))
    return node if isinstance(node, dict) else {}


#: A node without any of these fields is no step and shows the cost that it inherits.
_TELLING = frozenset("table_name access_type filtered rows_examined_per_scan rows rows_produced_per_join cost cost_info".split())


def walk(root: dict | _Repeated) -> Iterator[tuple[object, dict, dict]]:
    """Nodes to report in document pre-order: the cost each shows, its fields and its costs.

    Below a node are the objects that are its values, and those in its arrays.
    """
    stack: list[tuple[object, object]] = [(root, "")]
    while stack:
        node, cost = stack.pop()
        get = node if type(node) is dict else _first(node)
        if not _TELLING.isdisjoint(get):
            info = _first(get.get("cost_info"))
            cost = _shown_cost(get, info, cost)
            if _reported(get, info):
                yield cost, get, info
        values = node.values() if type(node) is dict else [v for _, v in node]
        below = [v for v in values if type(v) in _DEEP]
        if below:
            objects: list[object] = []
            for value in below:
                if type(value) is list:
                    objects += [e for e in value if type(e) is dict or type(e) is _Repeated]
                else:
                    objects.append(value)
            stack += [(child, cost) for child in reversed(objects)]


#: Fields of a step as they are read, texts first, and what stands for one that a node lacks.
_TEXTS = ("table_name", "access_type", "key", "key_length")
_OTHERS = ("filtered", "possible_keys", "used_key_parts", "ref", "using_index")
_LACKING = dict.fromkeys(_TEXTS, "") | dict.fromkeys(_OTHERS)
_COSTS = ("read_cost", "eval_cost", "prefix_cost", "data_read_per_join")
_LACKING_COSTS = dict.fromkeys(_COSTS, "")


def _all_texts(values: Sequence) -> Sequence[str]:
    return values if set(map(type, values)) == {str} else list(map(_text, values))


def _step_columns(places: list[int], nodes: list[tuple[object, dict, dict]]) -> list[Sequence]:
    """The columns of STEP, texts before they are escaped."""
    costs, gets, infos = zip(*nodes, strict=True)
    of_node, of_costs = itemgetter(*_TEXTS, *_OTHERS), itemgetter(*_COSTS)
    found = dict(zip((*_TEXTS, *_OTHERS), zip(*[of_node(_LACKING | get) for get in gets], strict=True), strict=True))
    found |= zip(_COSTS, zip(*[of_costs(_LACKING_COSTS | info) for info in infos], strict=True), strict=True)
    found |= {name: _all_texts(found[name]) for name in (*_TEXTS, *_COSTS)}
    found |= {name: list(map(_list, found[name])) for name in ("possible_keys", "used_key_parts", "ref")}
    found["step_id"] = places
    found["query_cost"] = [_text_or_number(cost, 5) for cost in costs]
    found["rows_examined_per_scan"] = list(map(rows_examined, gets))
    found["rows_produced_per_join"] = list(map(rows_produced, gets))
    found["filtered"] = [_text_or_number(value, 2) for value in found["filtered"]]
    found["using_index"] = ["true" if value is True else "false" for value in found["using_index"]]
    return [found[name] for name in STEP]


def _column(values: Sequence, kind: str) -> pa.Array:
    """Values as Arrow's, texts escaped; half a surrogate pair becomes a question mark."""
    try:
        column = pa.array(values, _ARROW[kind])
    except UnicodeEncodeError:
        column = pa.array([v.encode("utf-8", "replace").decode() for v in values], _ARROW[kind])
    if kind == "string":
        for mark, escaped in (("\\", "\\\\"), ('"', '\\"'), ("`", "\\`")):
            column = pc.replace_substring(column, mark, escaped)
    return column


def _documents(batch: pa.RecordBatch) -> Iterator[dict | _Repeated | None]:
    read = Reader().document
    for text, flavor in zip(batch.column("plan_json").to_pylist(), batch.column("flavor").to_pylist(), strict=True):
        yield None if text is None else read(text, flavor == "mariadb")


def _steps(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per reported node: the document's other columns and those of STEP."""
    for batch in (whole.slice(at, SLICE) for whole in batches for at in range(0, whole.num_rows, SLICE)):
        of, places, nodes = [], [], []
        for row, root in enumerate(_documents(batch)):
            found = list(walk(root)) if root is not None else []
            nodes += found
            places += range(len(found))
            of += [row] * len(found)
        if not nodes:
            continue
        kept = [c for c in batch.schema.names if c not in ("flavor", "plan_json")]
        same = [batch.column(c).take(pa.array(of, pa.int64())) for c in kept]
        shown = [_column(values, kind) for values, kind in zip(_step_columns(places, nodes), STEP.values(), strict=True)]
        yield pa.RecordBatch.from_arrays([*same, *shown], names=[*kept, *STEP])


def plan_steps(documents: DataFrame) -> DataFrame:
    """Steps of every plan document; ``step_id`` counts them from 0.

    ``documents`` has ``event_id, thread_id, flavor, plan_json`` and any other
    identifying columns, which are kept. A document that cannot be read whole,
    for any flavor also one with text after it, gives no steps.
    """
    kept = [c for c in documents.columns if c not in ("flavor", "plan_json")]
    # Identifying columns go by number: their names may be those of a step's columns.
    numbered = documents.select(*(F.col(c).alias(f"k{i}") for i, c in enumerate(kept)), F.col("flavor").cast("string"), F.col("plan_json").cast("string"))
    types = [f"k{i} {numbered.schema[i].dataType.simpleString()}" for i in range(len(kept))]
    found = numbered.mapInArrow(_steps, ", ".join([*types, *(f"{c} {kind}" for c, kind in STEP.items())]))
    return found.select(*(F.col(f"k{i}").alias(c) for i, c in enumerate(kept)), *STEP)


def plan_rejects(documents: DataFrame) -> DataFrame:
    """The documents that ``plan_steps`` cannot read: a text, but not one JSON object within the limits."""
    def unread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.array([root is None for root in _documents(batch)], pa.bool_()))

    return documents.filter(F.col("plan_json").isNotNull()).mapInArrow(unread, documents.schema)


def plan_samples(
    executions: DataFrame, documents: DataFrame, on: Sequence[str] = ("instance", "event_id", "thread_id")
) -> DataFrame:
    """Steps of the landed plans of reported executions.

    ``executions`` are those of ``individual_queries``; a plan is looked for if
    the execution has a database and a text whose plan may be asked for.
    ``documents`` has the columns ``on``, ``flavor`` and ``plan_json``.
    """
    fit = filters.explainable(F.col("query_id"), F.col("query_sample_text"))
    wanted = filters.require_db_and_text(executions).filter(fit).select(*KEYS, "event_id", "thread_id")
    # Where the executions are few enough to broadcast, Spark takes a semi join below the grouping that makes a document.
    landed = documents.select(*on, "flavor", "plan_json").join(wanted.select(*on), list(on), "left_semi")
    return plan_steps(wanted.join(landed, list(on)))
