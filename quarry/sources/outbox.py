"""A queue of rows for someone else to take: a sink with commit and abort, as a data source of Spark's.

Every task of a write puts its rows in a file of its own and reports it; the batch exists from the moment
its list of files does, and a write that fails leaves nothing to see. Batches are separate files, so
appending never rewrites what waits, and writers do not disturb each other. A batch that was handed on
gets a mark beside its list.
"""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.ipc as ipc
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceReader, InputPartition, WriterCommitMessage
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from ..session import ship


@dataclass
class Written(WriterCommitMessage):
    """What a task reports: its file, or none if it had no rows."""

    file: str | None
    rows: int


def _open(root: str) -> tuple[fs.FileSystem, str]:
    from quarry.sources.stores import open_store

    return open_store(root)


def _put(where: fs.FileSystem, path: str, body: bytes) -> None:
    """A file that is seen whole or not at all."""
    draft = f"{path}.draft"
    with where.open_output_stream(draft) as out:
        out.write(body)
    where.move(draft, path)


def _names(where: fs.FileSystem, folder: str, ending: str) -> list[str]:
    found = where.get_file_info(fs.FileSelector(folder, allow_not_found=True))
    return sorted(x.base_name.removesuffix(ending) for x in found if x.base_name.endswith(ending))


def waiting(root: str) -> list[str]:
    """Batches that are committed and not marked as sent, oldest first."""
    where, base = _open(root)
    sent = set(_names(where, f"{base}/batches", ".sent"))
    return [b for b in _names(where, f"{base}/batches", ".json") if b not in sent]


class OutboxWriter(DataSourceArrowWriter):
    def __init__(self, root: str, schema: StructType) -> None:
        self.root, self.schema = root, to_arrow_schema(schema)
        # sorts by time; a tie only leaves the order of two batches open
        self.batch = f"{time.time_ns():020d}-{uuid.uuid4().hex}"

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        where, base = _open(self.root)
        name, rows, out, stream = f"{self.batch}-{uuid.uuid4().hex}.arrow", 0, None, None
        try:
            for batch in iterator:
                if out is None:
                    where.create_dir(f"{base}/rows")
                    stream = where.open_output_stream(f"{base}/rows/{name}")
                    out = ipc.new_stream(stream, batch.schema)
                out.write_batch(batch)
                rows += batch.num_rows
        finally:
            if out is not None:
                out.close()
                stream.close()
        return Written(name if out is not None else None, rows)

    def commit(self, messages: list[Written | None]) -> None:
        where, base = _open(self.root)
        where.create_dir(f"{base}/batches")
        done = [m for m in messages if m is not None and m.file]
        _put(where, f"{base}/batches/{self.batch}.json", json.dumps({"files": [m.file for m in done], "rows": sum(m.rows for m in done)}).encode())

    def abort(self, messages: list[Written | None]) -> None:
        """Remove what the tasks wrote, also those that failed before they could report."""
        where, base = _open(self.root)
        for x in where.get_file_info(fs.FileSelector(f"{base}/rows", allow_not_found=True)):
            if x.base_name.startswith(self.batch):
                where.delete_file(x.path)


@dataclass
class _File(InputPartition):
    path: str | None


class OutboxReader(DataSourceReader):
    def __init__(self, root: str, batches: list[str]) -> None:
        self.root, self.batches = root, batches

    def partitions(self) -> list[_File]:
        where, base = _open(self.root)
        files = []
        for b in self.batches:
            with where.open_input_stream(f"{base}/batches/{b}.json") as stream:
                files += json.loads(stream.read())["files"]
        return [_File(f"{base}/rows/{f}") for f in files] or [_File(None)]

    def read(self, partition: _File) -> Iterator[pa.RecordBatch]:
        if partition.path:
            where, _ = _open(self.root)
            with where.open_input_stream(partition.path, compression=None) as stream:
                yield from ipc.open_stream(stream)


class OutboxSource(DataSource):
    """format("outbox") with option path, a URI: append rows as a batch; read (with a schema) the batches that wait.

    Option batches, a comma-separated list, reads those batches instead.
    """

    @classmethod
    def name(cls) -> str:
        return "outbox"

    def _root(self) -> str:
        root = self.options.get("path", "")
        if not root:
            raise ValueError("the outbox needs a path")
        return root.rstrip("/")

    def writer(self, schema: StructType, overwrite: bool) -> OutboxWriter:
        if overwrite:
            raise ValueError("an outbox is appended to, not overwritten")
        return OutboxWriter(self._root(), schema)

    def reader(self, schema: StructType) -> OutboxReader:
        asked = self.options.get("batches")
        return OutboxReader(self._root(), waiting(self._root()) if asked is None else [b for b in asked.split(",") if b])


def put(df: DataFrame, root: str) -> None:
    """Append df as one batch."""
    _ready(df.sparkSession)
    df.write.format("outbox").mode("append").option("path", root).save()


def pending(spark: SparkSession, root: str, schema: StructType, batches: list[str] | None = None) -> DataFrame:
    """The rows of the batches that wait, or of those given."""
    _ready(spark)
    read = spark.read.format("outbox").schema(schema).option("path", root)
    return (read if batches is None else read.option("batches", ",".join(batches))).load()


def drain(spark: SparkSession, root: str, schema: StructType, send: Callable[[DataFrame], None]) -> int:
    """Hand all waiting rows to send at once and mark their batches; if send fails they go on waiting. How many batches went.

    A send that succeeds but is not marked in time is repeated, so the receiver sees rows at least once.
    """
    batches = waiting(root)
    if batches:
        send(pending(spark, root, schema, batches))
        where, base = _open(root)
        for b in batches:
            _put(where, f"{base}/batches/{b}.sent", b"")
    return len(batches)


def clear(root: str, stale_seconds: float = 86_400.0) -> None:
    """Remove the rows and lists of batches that were sent, and rows that a failed write left longer ago than stale_seconds.

    Tasks that end after their write was given up leave such rows; no list names them, so nobody sees them.
    """
    where, base = _open(root)
    listed = set(_names(where, f"{base}/batches", ".json"))
    sent = set(_names(where, f"{base}/batches", ".sent"))
    too_old = f"{time.time_ns() - int(stale_seconds * 1e9):020d}"
    for x in where.get_file_info(fs.FileSelector(f"{base}/rows", allow_not_found=True)):
        batch = "-".join(x.base_name.split("-")[:2])
        if batch in sent or (batch not in listed and batch < too_old):
            where.delete_file(x.path)
    # the mark goes last: without its list it means nothing, but a list without its mark would be sent again
    for b in sent:
        if b in listed:
            where.delete_file(f"{base}/batches/{b}.json")
        where.delete_file(f"{base}/batches/{b}.sent")


def _ready(spark: SparkSession) -> None:
    ship(spark)
    spark.dataSource.register(OutboxSource)
