"""SQL names for this package's functions, table functions and data sources."""

from __future__ import annotations

import json
from collections.abc import Iterator
from typing import Any

from pyspark.sql import Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.udtf import AnalyzeArgument, AnalyzeResult

from ..session import ship
from ..sources.arrivals import ArrivalSource
from ..sources.outbox import OutboxSource
from ..sources.readers import LandedSource
from . import dates, jsonx, profile


@F.udtf(returnType="nth int, value string")
class JsonAliases:
    """json_aliases(text, aliases): the values under any of the comma-separated aliases, one row each."""

    def eval(self, text: str, aliases: str) -> Iterator[tuple[int, str]]:
        try:
            value = json.loads(text)
        except (TypeError, ValueError):
            return
        keys = {jsonx.plain_key(a) for a in aliases.split(",")}
        for i, v in enumerate(jsonx.alias_values(value, keys)):
            yield i, v if isinstance(v, str) else json.dumps(v, ensure_ascii=False)


@F.udtf
class FailureRuns:
    """failure_runs(TABLE(...) PARTITION BY key ORDER BY ..., opens_at): for each key its longest run of failures and whether it is opens_at or longer.

    The table's first column is the key, whatever its type, and the column failed says how a row went (null:
    well). Rows are looked at one by one as they come, so a key of any number of rows takes no memory.
    """

    @staticmethod
    def analyze(table: AnalyzeArgument, opens_at: AnalyzeArgument) -> AnalyzeResult:
        if not table.isTable or "failed" not in table.dataType.names:
            raise ValueError("failure_runs takes a TABLE with a column named failed")
        if not isinstance(opens_at.dataType, T.IntegralType):
            raise ValueError("failure_runs takes a whole number of failures")
        key = table.dataType.fields[0]
        return AnalyzeResult(T.StructType([T.StructField(key.name, key.dataType), T.StructField("longest", T.LongType()), T.StructField("opened", T.BooleanType())]))

    def __init__(self) -> None:
        self.key, self.run, self.longest, self.opens_at = None, 0, 0, 0

    def eval(self, row: Row, opens_at: int) -> None:
        self.key, self.opens_at = row[0], opens_at
        self.run = self.run + 1 if row["failed"] else 0
        self.longest = max(self.longest, self.run)

    def terminate(self) -> Iterator[tuple[Any, int, bool]]:
        yield self.key, self.longest, self.longest >= self.opens_at


@F.arrow_udf(T.StringType())
def repair_json(column):
    """A whole JSON object's text from a tolerant parse, or null."""
    return jsonx.repaired(column)


def register(spark: SparkSession) -> None:
    """Make walkin_dates(text, as_of), repair_json(text), profile_sections(text) and condensed_profile(text) known to SQL,
    json_aliases(text, aliases) and failure_runs(TABLE ..., opens_at) as table functions, and "landed", "outbox" and "arrivals" as formats."""
    ship(spark)
    spark.udf.register("walkin_dates", dates._walkin)
    spark.udf.register("repair_json", repair_json)
    spark.udf.register("profile_sections", profile.profile_sections)
    spark.udf.register("condensed_profile", profile.condensed_profile)
    spark.udtf.register("json_aliases", JsonAliases)
    spark.udtf.register("failure_runs", FailureRuns)
    spark.dataSource.register(LandedSource)
    spark.dataSource.register(OutboxSource)
    spark.dataSource.register(ArrivalSource)
