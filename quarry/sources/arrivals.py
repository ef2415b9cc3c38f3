"""Landed responses in the order in which they arrived, as a table and as a stream.

Every landing is a commit with the next number, which only one writer gets, so the number of a commit is
an offset that no clock and no name decides: what comes later has a larger one. A stream that is started
again takes what its checkpoint has not seen, each landing once.
"""

from __future__ import annotations

import json
import sys
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, InputPartition

from ..session import ship
from . import stores
from .commits import CommitLog
from .stores import open_store

# Spark's own driver-side worker for streams has no access to shipped packages: what it runs travels by value
for _module in (sys.modules[__name__], stores):
    cloudpickle.register_pickle_by_value(_module)

#: landing: its number; body, origin: the response.
SCHEMA = "landing long, body string, origin string"


def land(responses: DataFrame, root: str) -> int:
    """Land responses (body, origin) as one arrival; its number. Readers see all of it or nothing."""
    name = f"data-{uuid.uuid4().hex}"
    responses.select("body", "origin").write.parquet(f"{root.rstrip('/')}/{name}")
    log = CommitLog(responses.sparkSession, root)
    while True:
        number = max(log.numbers(), default=0) + 1
        if log.commit(number, {"folder": name}):
            return number


def _numbers(root: str) -> list[int]:
    where, base = open_store(root)
    found = where.get_file_info(fs.FileSelector(base, allow_not_found=True))
    return sorted(int(x.base_name.removeprefix("commit-")) for x in found if x.base_name.startswith("commit-"))


@dataclass
class _File(InputPartition):
    landing: int
    path: str | None


def _files(root: str, after: int, upto: int) -> list[_File]:
    where, base = open_store(root)
    out = []
    for n in _numbers(root):
        if after < n <= upto:
            with where.open_input_stream(f"{base}/commit-{n:012d}") as stream:
                folder = json.loads(stream.read())["folder"]
            names = sorted(x.path for x in where.get_file_info(fs.FileSelector(f"{base}/{folder}")) if x.base_name.endswith(".parquet"))
            out += [_File(n, path) for path in names]
    return out or [_File(0, None)]


def _rows(root: str, partition: _File) -> Iterator[pa.RecordBatch]:
    if partition.path:
        where, _ = open_store(root)
        with where.open_input_file(partition.path) as file:
            for batch in pq.ParquetFile(file).iter_batches(256, columns=["body", "origin"]):
                yield pa.RecordBatch.from_arrays([pa.array([partition.landing] * batch.num_rows, pa.int64()), *(c.cast(pa.string()) for c in batch.columns)], ["landing", "body", "origin"])


class ArrivalReader(DataSourceReader):
    def __init__(self, root: str) -> None:
        self.root = root

    def partitions(self) -> list[_File]:
        return _files(self.root, 0, max(_numbers(self.root), default=0))

    def read(self, partition: _File) -> Iterator[pa.RecordBatch]:
        yield from _rows(self.root, partition)


class ArrivalStream(DataSourceStreamReader):
    """Offsets are numbers of landings."""

    def __init__(self, root: str) -> None:
        self.root = root

    def initialOffset(self) -> dict:
        return {"landing": 0}

    def latestOffset(self) -> dict:
        return {"landing": max(_numbers(self.root), default=0)}

    def partitions(self, start: dict, end: dict) -> list[_File]:
        return _files(self.root, start["landing"], end["landing"])

    def read(self, partition: _File) -> Iterator[pa.RecordBatch]:
        yield from _rows(self.root, partition)


class ArrivalSource(DataSource):
    """format("arrivals") with option path, a URI: all landings, to read() or to readStream()."""

    @classmethod
    def name(cls) -> str:
        return "arrivals"

    def schema(self) -> str:
        return SCHEMA

    def _root(self) -> str:
        root = self.options.get("path", "")
        if not root:
            raise ValueError("arrivals need a path")
        return root.rstrip("/")

    def reader(self, schema) -> ArrivalReader:
        return ArrivalReader(self._root())

    def streamReader(self, schema) -> ArrivalStream:
        return ArrivalStream(self._root())


def arrivals(spark: SparkSession, root: str) -> DataFrame:
    """All landings: landing, body, origin."""
    ship(spark)
    spark.dataSource.register(ArrivalSource)
    return spark.read.format("arrivals").option("path", root).load()


def take_new(spark: SparkSession, root: str, checkpoint: str, table: str) -> DataFrame:
    """Append the landings that earlier calls with this checkpoint have not taken to the table of those taken; the whole table.

    A call that fails half-way and is repeated appends nothing twice.
    """
    ship(spark)
    spark.dataSource.register(ArrivalSource)
    rows = spark.readStream.format("arrivals").option("path", root).load()
    rows.writeStream.format("parquet").option("path", table).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()
    return spark.read.schema(SCHEMA).parquet(table)

