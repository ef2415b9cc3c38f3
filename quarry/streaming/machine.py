"""The evaluation state machine and provider health as streaming operators with keyed state.

Keys are held in buckets, each with one state: a state for each key costs a dozen calls between Python and
the JVM a micro-batch, whatever its number of rows. Rows reach a state packed, many of a bucket as one row of arrays:
Spark's runner of states makes Python objects of every row it is given.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator
from typing import ClassVar

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from .. import terms

_ALLOWED = frozenset(terms.TRANSITIONS)
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


# Spark's own driver-side worker has no access to shipped packages: these classes travel by value
for _module in (sys.modules[__name__], terms):
    cloudpickle.register_pickle_by_value(_module)


#: Keys share a state by a hash: what Spark asks of Python for each state and micro-batch costs a thousand rows.
BUCKETS = 4096


#: Rows of a task that are packed together, and so the most that a packed row holds.
PACKED_ROWS = 1 << 17


def _packed(batches: list[pa.RecordBatch]) -> pa.RecordBatch:
    """A row for each bucket, with the other columns' values as lists."""
    table = pa.Table.from_batches(batches).sort_by("bucket").combine_chunks()
    bucket = table["bucket"].to_numpy()
    starts = np.flatnonzero(np.diff(bucket, prepend=-1))
    edges = pa.array(np.append(starts, len(bucket)), pa.int32())
    lists = [pa.ListArray.from_arrays(edges, table[c].combine_chunks()) for c in table.column_names[1:]]
    return pa.RecordBatch.from_arrays([pa.array(bucket[starts], table["bucket"].type), *lists], names=table.column_names)


def _pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held, n = [], 0
    for batch in batches:
        held.append(batch)
        n += batch.num_rows
        if n >= PACKED_ROWS:
            yield _packed(held)
            held, n = [], 0
    if n:
        yield _packed(held)


def _by_bucket(events: DataFrame, buckets: int, *columns):
    """The given columns of a stream, of which the first is the key, by buckets of keys; rows of a bucket are packed."""
    head, *others = events.select(*columns).columns
    key = F.col(head).cast("string")
    rows = events.select(*columns).select(F.pmod(F.xxhash64(key), F.lit(buckets)).alias("bucket"), key.alias("key"), *others)
    packed = ", ".join(f"{f.name} array<{f.dataType.simpleString()}>" for f in rows.schema.fields[1:])
    return rows.mapInArrow(_pack, f"bucket long, {packed}").groupBy("bucket")


class _OfPacked:
    """A processor of rows that is given packed ones."""

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        return super().handleInputRows(key, (pd.DataFrame({c: np.concatenate(part[c].to_list()) for c in part.columns[1:]}) for part in rows), timerValues)


def _in_order(rows: Iterator[pd.DataFrame], *columns: str) -> Iterator[tuple]:
    """Key and named columns of a bucket's rows of one micro-batch, by the first of these. Only these columns are held,
    and no more than a trigger takes in (maxFilesPerTrigger, maxOffsetsPerTrigger)."""
    parts = [batch[["key", *columns]] for batch in rows]
    every = parts[0] if len(parts) == 1 else pd.concat(parts)
    yield from every.sort_values(columns[0], kind="stable").itertuples(index=False, name=None)


class _Keys:
    """The states of a bucket's keys: one value of parallel arrays, read and written once a micro-batch."""

    def __init__(self, handle: StatefulProcessorHandle, fields: dict[str, str]) -> None:
        self.width = len(fields)
        self.state = handle.getValueState("keys", ", ".join(f"{name} array<{kind}>" for name, kind in ({"key": "string"} | fields).items()))

    def get(self) -> dict[str | None, tuple]:
        if not self.state.exists():
            return {}
        keys, *values = self.state.get()
        return dict(zip(keys, zip(*values, strict=True), strict=True))

    def update(self, held: dict[str | None, tuple]) -> None:
        self.state.update((list(held), *([v[i] for v in held.values()] for i in range(self.width))))


class StateMachine(StatefulProcessor):
    """Per key: applies wanted transitions in order; emits every step with whether it was allowed.

    An evaluation takes a lease of processing time; when it runs out, the timer makes the key
    retryable and emits that step. Leases that a bucket's keys take in one micro-batch end together: one timer.
    """

    COLUMNS: ClassVar = ["key", "ord", "from_status", "to_status", "valid", "attempts"]

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.keys = _Keys(handle, {"status": "string", "attempts": "int", "lease": "long"})

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        held, out = self.keys.get(), []
        until, leased = timerValues.getCurrentProcessingTimeInMs() + terms.LEASE_SECONDS * 1000, False
        for name, order, wanted, error in _in_order(rows, "ord", "status", "error"):
            status, attempts, lease = held.get(name, ("QUEUED", 0, 0))
            text = (error or "").lower() if isinstance(error, str) else ""
            target = "PERMANENT_ERROR" if wanted == "RETRYABLE_ERROR" and any(m in text for m in terms.PERMANENT_ERRORS) else wanted
            before = status
            through = status == "QUEUED" and target in ("RETRYABLE_ERROR", "PERMANENT_ERROR")
            valid = target == status or (status, target) in _ALLOWED or through
            if valid:
                if (target == "EVALUATING" and status != "EVALUATING") or through:
                    attempts += 1
                if target == "EVALUATING" and status != "EVALUATING":
                    lease, leased = until, True
                status = target
            held[name] = (status, attempts, lease)
            out.append((name, int(order), before, target, valid, attempts))
        if leased:
            self.handle.registerTimer(until)
        self.keys.update(held)
        yield pd.DataFrame(out, columns=self.COLUMNS)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        held, now = self.keys.get(), expiredTimerInfo.getExpiryTimeInMs()
        late = [(name, attempts) for name, (status, attempts, lease) in held.items() if status == "EVALUATING" and now >= lease]
        if late:
            self.keys.update(held | {name: ("RETRYABLE_ERROR", attempts, 0) for name, attempts in late})
            yield pd.DataFrame([(name, -1, "EVALUATING", "RETRYABLE_ERROR", True, attempts) for name, attempts in late], columns=self.COLUMNS)

    def close(self) -> None:
        pass


class _PackedMachine(_OfPacked, StateMachine):
    pass


def run_state_machine(events: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """A stream of (key, ord, status, error) as a stream of steps. Needs the RocksDB state store.

    buckets: of how many keys a state is made follows from it; a checkpoint holds for one number only.
    """
    schema = "key string, ord long, from_status string, to_status string, valid boolean, attempts int"
    grouped = _by_bucket(events, buckets, "key", "ord", "status", "error")
    return grouped.transformWithStateInPandas(_PackedMachine(), outputStructType=schema, outputMode="Append", timeMode="ProcessingTime")


class RunningCounts(StatefulProcessor):
    """Per key: events, failures and the current run of failures."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.keys = _Keys(handle, {"n": "long", "failures": "long", "run": "long"})

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        held, new = self.keys.get(), {}
        for name, _, bad in _in_order(rows, "ord", "failed"):
            n, failures, run = new.get(name) or held.get(name, (0, 0, 0))
            new[name] = (n + 1, failures + int(bad), run + 1 if bad else 0)
        self.keys.update(held | new)
        yield pd.DataFrame([(name, *counts) for name, counts in new.items()], columns=["key", "n", "failures", "run"])

    def close(self) -> None:
        pass


class _PackedCounts(_OfPacked, RunningCounts):
    pass


def running_failures(events: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """A stream of (key, ord, failed) as a stream of the latest counts of each key that had events."""
    grouped = _by_bucket(events, buckets, "key", "ord", F.coalesce("failed", F.lit(False)).alias("failed"))
    counts = grouped.transformWithStateInPandas(_PackedCounts(), outputStructType="key string, n long, failures long, run long", outputMode="Update", timeMode="None")
    return counts.withColumn("key", F.col("key").cast("long"))
