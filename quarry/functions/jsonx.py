"""Tolerant JSON, coercions, recursive lookups and scrubbing."""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
from typing import Any

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

from .. import terms

_FENCE = re.compile(r"^```(?:json)?\s*$", re.M)
_CLOSE = {"{": "}", "[": "]"}
EMPTY = (None, "", [], {})


def _cuts(text: str) -> tuple[list[str], bool, int]:
    """Open brackets at the end, whether a string is open there, and the last comma between values."""
    stack: list[str] = []
    quoted, comma, skip = False, -1, False
    for i, c in enumerate(text):
        if skip:
            skip = False
        elif quoted:
            skip, quoted = c == "\\", c != '"'
        elif c == '"':
            quoted = True
        elif c in _CLOSE:
            stack.append(c)
        elif c in "}]" and stack:
            stack.pop()
        elif c == ",":
            comma = i
    return stack, quoted, comma


def _object(text: str) -> dict | None:
    try:
        out = json.loads(text)
    except ValueError:
        return None
    return out if isinstance(out, dict) else None


def _closed(text: str) -> dict | None:
    stack = _cuts(text)[0]
    return _object(text + "".join(_CLOSE[c] for c in reversed(stack))) or None


def parse_object(text: str | None) -> dict | None:
    """A JSON object from a model's answer: fenced, within prose, or cut off (then up to its last whole value)."""
    clean = _FENCE.sub("", text or "").strip()
    if (out := _object(clean)) is not None:
        return out
    start, end = clean.find("{"), clean.rfind("}")
    if start < 0:
        return None
    if end > start and (out := _object(clean[start : end + 1])) is not None:
        return out
    rest = clean[start:]
    stack, quoted, comma = _cuts(rest)
    if not stack:
        return None
    if not quoted and (out := _closed(rest.rstrip().removesuffix(","))) is not None:
        return out
    return _closed(rest[:comma]) if comma >= 0 else None


def repaired(column: pa.Array) -> pa.Array:
    found = [parse_object(x) if x is not None else None for x in column.to_pylist()]
    return pa.array([None if x is None else json.dumps(x, ensure_ascii=False) for x in found], pa.string())


def repair_json(text: Column) -> Column:
    """Whole JSON object text from a tolerant parse, or null. Texts that parse as they are never reach Python."""

    @F.arrow_udf("string")
    def repair(column: pa.Array) -> pa.Array:
        return repaired(column)

    whole = F.try_parse_json(text).isNotNull() & F.trim(text).startswith("{")
    return F.when(whole, F.trim(text)).otherwise(repair(F.when(~F.coalesce(whole, F.lit(False)), text)))


def str_list(value: Column) -> Column:
    """VARIANT or JSON value to ARRAY<STRING>: null is empty, a text is one item, blanks are dropped."""
    many = F.try_variant_get(value, "$", "array<string>")
    one = F.try_variant_get(value, "$", "string")
    items = F.coalesce(many, F.when(one.isNotNull(), F.array(one)), F.array().cast("array<string>"))
    return F.filter(F.transform(items, lambda s: F.trim(s)), lambda x: F.coalesce(x != "", F.lit(False)))


def plain_key(key: Any) -> str:
    return "".join(c for c in str(key).lower() if c.isalnum())


def alias_values(value: Any, keys: set[str], *, by_level: bool = False, depth: int = 25) -> Iterator[Any]:
    """Non-empty values whose normalised key is one of keys, in depth-first order.

    A value comes before what is in it. by_level: all of an object's own keys before anything in its values.
    """
    if depth < 0:
        return
    if isinstance(value, list):
        for v in value:
            yield from alias_values(v, keys, by_level=by_level, depth=depth - 1)
    elif isinstance(value, dict):
        own = {k: plain_key(k) in keys and v not in EMPTY for k, v in value.items()}
        if by_level:
            yield from (v for k, v in value.items() if own[k])
        for k, v in value.items():
            if own[k] and not by_level:
                yield v
            yield from alias_values(v, keys, by_level=by_level, depth=depth - 1)


def _as_text(value: Any) -> str:
    return value if isinstance(value, str) else json.dumps(value, ensure_ascii=False)


def _loaded(column: pa.Array) -> Iterator[Any]:
    for x in column.to_pylist():
        try:
            yield json.loads(x)
        except (TypeError, ValueError):
            yield None


def find_aliases(text: Column, aliases: list[str], *, by_level: bool = False, depth: int = 25) -> Column:
    """ARRAY<STRING> (JSON) of all different non-empty values under any of aliases, in the order of alias_values()."""
    keys = {plain_key(a) for a in aliases}

    @F.arrow_udf("array<string>")
    def find(column: pa.Array) -> pa.Array:
        out = []
        for value in _loaded(column):
            found: list[Any] = []
            for v in alias_values(value, keys, by_level=by_level, depth=depth):
                if v not in found:
                    found.append(v)
            out.append([_as_text(v) for v in found])
        return pa.array(out, pa.list_(pa.string()))

    return find(text)


def first_alias(text: Column, aliases: list[str], *, by_level: bool = False, depth: int = 25) -> Column:
    """The first of the values that find_aliases() gives, or null; the search ends there."""
    keys = {plain_key(a) for a in aliases}

    @F.arrow_udf("string")
    def find(column: pa.Array) -> pa.Array:
        found = (next(alias_values(v, keys, by_level=by_level, depth=depth), None) for v in _loaded(column))
        return pa.array([None if v is None else _as_text(v) for v in found], pa.string())

    return find(text)


def find_objects(text: Column, wanted: list[str], depth: int = 25) -> Column:
    """ARRAY<STRING> (JSON) of all nested objects that have every wanted key, down to a depth."""

    def walk(value: Any, left: int) -> Iterator[dict]:
        if left < 0:
            return
        if isinstance(value, dict):
            if all(k in value for k in wanted):
                yield value
            value = list(value.values())
        if isinstance(value, list):
            for v in value:
                yield from walk(v, left - 1)

    @F.arrow_udf("array<string>")
    def find(column: pa.Array) -> pa.Array:
        out = []
        for x in column:  # a page at a time becomes Python objects
            try:
                out.append([json.dumps(v, ensure_ascii=False) for v in walk(json.loads(x.as_py()), depth)])
            except (TypeError, ValueError):
                out.append([])
        return pa.array(out, pa.list_(pa.string()))

    return find(text)


def without_private(value: Any) -> Any:
    """A JSON value without private and secret entries, by their keys, and without nulls; None if it is one of these."""
    if isinstance(value, dict):
        kept = {k: without_private(v) for k, v in value.items() if k.lower() not in terms.PRIVATE_KEYS and not any(p in k.lower() for p in terms.SECRET_PARTS)}
        return {k: v for k, v in kept.items() if v is not None}
    if isinstance(value, list):
        return [v for v in map(without_private, value) if v is not None]
    return value


def scrub(text: Column) -> Column:
    """JSON text without the entries, at any depth, whose key is private or names a secret; null if it is no JSON."""

    @F.arrow_udf("string")
    def run(column: pa.Array) -> pa.Array:
        return pa.array([None if v is None else json.dumps(without_private(v), ensure_ascii=False) for v in _loaded(column)], pa.string())

    return run(text)
