"""Sums of arrays that many tasks send, in levels, so that no task meets more than a few of them."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import words as W

#: Arrays of one block that a task adds up at a level.
FAN_IN = 64
SENT = "block string, lane long, body binary"


def part() -> int:
    """The number of the partition that runs here: who sends, for sum_arrays() to deal by."""
    return TaskContext.get().partitionId() if TaskContext.get() else 0


def message(blocks: dict[str, np.ndarray]) -> pa.RecordBatch:
    """What a task sends: its arrays by name."""
    return pa.RecordBatch.from_arrays([pa.array(list(blocks), pa.string()), pa.array([part()] * len(blocks), pa.int64()), pa.array([x.tobytes() for x in blocks.values()], pa.binary())], ["block", "lane", "body"])


def sum_arrays(sent: DataFrame, tasks: int, dtype: str) -> dict[str, np.ndarray]:
    """The sum of each block's arrays; what reaches the driver is one array for each block."""

    def add(table: pa.Table) -> pa.Table:
        W.give_memory_back()  # this runs in workers only, some of which meet no text
        total = sum(np.frombuffer(x, dtype) for x in table["body"].to_pylist())
        return pa.table([table["block"].slice(0, 1), table["lane"].slice(0, 1), pa.array([total.tobytes()], pa.binary())], names=["block", "lane", "body"])

    while True:
        tasks = -(-tasks // FAN_IN)
        sent = sent.withColumn("lane", F.pmod("lane", F.lit(max(1, tasks)))).groupBy("block", "lane").applyInArrow(add, SENT)
        if tasks <= 1:
            return {r.block: np.frombuffer(r.body, dtype) for r in sent.collect()}
