"""Array and map functions: Column -> Column."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def distinct_in_order(items: Column) -> Column:
    return F.array_distinct(items)


def priority_order(items: Column, first: list[str], most: int = 30) -> Column:
    """Distinct items, those named first in that order, then the others by first sight; at most so many."""
    named = F.array(*(F.lit(x) for x in first))
    return F.slice(F.concat(F.array_intersect(named, items), F.array_except(items, named)), 1, most)


def key_by(entries: Column, key: str) -> Column:
    """ARRAY<STRUCT> to MAP by a field; of entries with one key the last stays."""
    keys = F.array_distinct(F.transform(entries, lambda e: e[key]))
    return F.map_from_entries(F.transform(keys, lambda k: F.struct(k, F.element_at(F.filter(entries, lambda e: e[key] == k), -1))))
