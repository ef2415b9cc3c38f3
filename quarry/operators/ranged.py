"""Ordered work on keys of any size: rows are sorted into ranges, and what crosses a range's edge is one small row.

A window by key alone sorts all of a key's rows in one task. Here a range of the total order (key, order)
is the largest unit: windows run by key and range, and each range takes over what the ranges before it
left behind, which is one row for each key and range.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialise


def ranged(df: DataFrame, key: list[str], order: list[str]) -> DataFrame:
    """df with _part (its range) and _at (its place in the order), sorted by key and order, written once."""
    by = [*key, *order]
    rows = df.repartitionByRange(*(F.col(c).asc_nulls_first() for c in by)).sortWithinPartitions(*(F.col(c).asc_nulls_first() for c in by))
    # bits above 33 number the partition, which is the range; those below the row
    rows = materialise(rows.withColumn("_at", F.monotonically_increasing_id()), "ranged")
    return rows.withColumn("_part", F.shiftright("_at", 33))


def _within(key: list[str]):
    return Window.partitionBy(*key, "_part").orderBy("_at")


def _by_key(left: DataFrame, right: DataFrame, key: list[str], *more: str) -> DataFrame:
    """Left join on keys that may be null."""
    names = [*key, *more]
    other = right.select(*(F.col(c).alias(f"_k_{c}") for c in names), *(c for c in right.columns if c not in names))
    on = [left[c].eqNullSafe(other[f"_k_{c}"]) for c in names]
    return left.join(other, on, "left").drop(*(f"_k_{c}" for c in names))


def previous(rows: DataFrame, key: list[str], value: Column, name: str) -> DataFrame:
    """Ranged rows with the value of the row before, per key (null: none before)."""
    rows = rows.withColumn("_v", value)
    ends = rows.groupBy(*key, "_part").agg(F.max_by("_v", "_at").alias("_end"))
    ends = ends.withColumn("_before", F.lag("_end").over(Window.partitionBy(*key).orderBy("_part"))).drop("_end")
    out = _by_key(rows, ends, key, "_part")
    first = F.row_number().over(_within(key)) == 1
    return out.withColumn(name, F.when(first, F.col("_before")).otherwise(F.lag("_v").over(_within(key)))).drop("_v", "_before")


def running_sum(rows: DataFrame, key: list[str], value: str, name: str) -> DataFrame:
    """Ranged rows with the sum of value up to each row, per key."""
    sums = rows.groupBy(*key, "_part").agg(F.sum(value).alias("_sum"))
    upto = Window.partitionBy(*key).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.withColumn("_before", F.coalesce(F.sum("_sum").over(upto), F.lit(0))).drop("_sum")
    own = F.sum(value).over(_within(key).rowsBetween(Window.unboundedPreceding, 0))
    return _by_key(rows, sums, key, "_part").withColumn(name, F.col("_before") + own).drop("_before")


def runs(rows: DataFrame, key: list[str], bad: Column, name: str = "run") -> DataFrame:
    """Ranged rows with how many bad rows in a row end at each (0 on a good one), and _carry: the run before its range."""
    rows = rows.withColumn("_bad", bad.cast("long"))
    upto = _within(key).rowsBetween(Window.unboundedPreceding, 0)
    rows = rows.withColumn("_island", F.sum(1 - F.col("_bad")).over(upto))
    inner = Window.partitionBy(*key, "_part", "_island").orderBy("_at").rowsBetween(Window.unboundedPreceding, 0)
    rows = rows.withColumn("_run", F.sum("_bad").over(inner))
    ends = rows.groupBy(*key, "_part").agg(F.max_by("_run", "_at").alias("_tail"), F.max((F.col("_bad") == 0).cast("int")).alias("_good"))
    # a range's run goes on from the last range with a good row and all after it
    along = Window.partitionBy(*key).orderBy("_part")
    ends = ends.withColumn("_since", F.sum("_good").over(along.rowsBetween(Window.unboundedPreceding, 0)))
    ends = ends.withColumn("_sum", F.sum("_tail").over(Window.partitionBy(*key, "_since").orderBy("_part").rowsBetween(Window.unboundedPreceding, 0)))
    ends = ends.withColumn("_carry", F.coalesce(F.lag("_sum").over(along), F.lit(0))).select(*key, "_part", "_carry")
    rows = _by_key(rows, ends, key, "_part")
    return rows.withColumn(name, F.col("_run") + F.when((F.col("_island") == 0) & (F.col("_bad") == 1), F.col("_carry")).otherwise(0)).drop("_island", "_run")
