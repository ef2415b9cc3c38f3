"""Which 64-bit hashes occur at least twice over all documents, without a row for each of them.

Documents are dealt into buckets. Each bucket sends every shard (a range of hashes) one packed,
sorted, distinct array; the shard answers with one bit per hash. A hash that occurs in very many
documents is sent once by each bucket, so no shard is hot.

With more than FAN shards messages would become short and more than there are hashes: then buckets send
to wide ranges, where what a group of buckets sends is merged and passed on to the shards, and answers
come back the same way. Either way the answers are the same.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .words import distinct

#: Bytes of documents for each shard. There are fewer shards than buckets, so that messages (one for each of
#: both) stay long; a shard holds about as many bytes of hashes at most.
SHARD_BYTES = 64 << 20
SENT = pa.schema([("shard", pa.int32()), ("bucket", pa.int32()), ("hashes", pa.binary()), ("several", pa.binary())])
SENT_DDL = "shard int, bucket int, hashes binary, several binary"
ANSWER_DDL = "bucket int, kind int, shard int, bits binary"


#: Shards that a bucket sends to directly.
FAN = 2048


@dataclass(frozen=True)
class Route:
    """How hashes travel: to shards, or by so many wide ranges of so many shards each; buckets meet there in groups."""

    shards: int
    first: int
    groups: int = 0

    @staticmethod
    def of(buckets: int, shards: int) -> Route:
        if shards <= FAN:
            return Route(shards, shards)
        ranges = int(np.ceil(np.sqrt(shards)))
        return Route(ranges * -(-shards // ranges), ranges, int(np.ceil(np.sqrt(buckets))))


def _cuts(sorted_hashes: np.ndarray, shards: int) -> np.ndarray:
    shard = ((sorted_hashes >> np.uint64(32)) * np.uint64(shards)) >> np.uint64(32)
    return np.searchsorted(shard, np.arange(shards + 1))


def pack(bucket: int, hashes: np.ndarray, shards: int, width: int = 8) -> pa.Table:
    """The bucket's messages to the shards. hashes: with repetitions; all but their first width bytes are 0."""
    value, count = np.unique(hashes, return_counts=True)
    return _messages(bucket, value, count > 1, _cuts(value, shards), width)


def _messages(sender: int, value: np.ndarray, several: np.ndarray, cut: np.ndarray, width: int, first: int = 0) -> pa.Table:
    some = np.flatnonzero(np.diff(cut))
    return pa.table(
        [
            pa.array(some + first, pa.int32()),
            pa.array(np.full(len(some), sender), pa.int32()),
            pa.array([value[cut[i] : cut[i + 1]].view(np.uint8).reshape(-1, 8)[:, 8 - width :].tobytes() for i in some], pa.binary()),
            pa.array([np.packbits(several[cut[i] : cut[i + 1]]).tobytes() for i in some], pa.binary()),
        ],
        schema=SENT,
    )


def _read(body: bytes, width: int) -> np.ndarray:
    if width == 8:
        return np.frombuffer(body, np.uint64)
    out = np.zeros((len(body) // width, 8), np.uint8)
    out[:, 8 - width :] = np.frombuffer(body, np.uint8).reshape(-1, width)
    return out.view(np.uint64).ravel()


def _blocks(table: pa.Table, width: int) -> tuple[list[np.ndarray], np.ndarray, np.ndarray]:
    """Each message's hashes; all messages' hashes; those among them that occur twice or more."""
    blocks = [_read(x, width) for x in table["hashes"].to_pylist()]
    several = [np.unpackbits(np.frombuffer(x, np.uint8), count=len(b)) for x, b in zip(table["several"].to_pylist(), blocks, strict=True)]
    every = np.concatenate(blocks)
    value, count = np.unique(np.concatenate([every, every[np.concatenate(several) > 0]]), return_counts=True)
    return blocks, value, value[count > 1]


def _answers(buckets, kind: int, shard, blocks: list[np.ndarray], twice: np.ndarray) -> pa.Table:
    bits = [np.packbits(isin(b, twice)).tobytes() for b in blocks]
    return pa.table([buckets, pa.array(np.full(len(blocks), kind), pa.int32()), shard, pa.array(bits, pa.binary())], names=["bucket", "kind", "shard", "bits"])


def answer(sent: DataFrame, kind: int, route: Route, width: int = 8) -> DataFrame:
    """(bucket, kind, shard, bits): bit i is set if the bucket's i-th hash of the shard occurs twice or more."""

    def shard(table: pa.Table) -> pa.Table:
        blocks, _, twice = _blocks(table, width)
        return _answers(table["bucket"], kind, table["shard"], blocks, twice)

    if not route.groups:
        return sent.groupBy("shard").applyInArrow(shard, ANSWER_DDL)
    each = route.shards // route.first

    def merge(table: pa.Table) -> pa.Table:
        """What a group of buckets has in a range, to the range's shards."""
        group, start = table["group"][0].as_py(), table["shard"][0].as_py() * each
        _, value, twice = _blocks(table, width)
        return _messages(group, value, isin(value, twice), _cuts(value, route.shards)[start : start + each + 1], width, start)

    def share(mine: pa.Table, known: pa.Table) -> pa.Table:
        """The shards' answers to a group, to its buckets."""
        blocks, value, _ = _blocks(mine, width)
        cut, yes = _cuts(value, route.shards), np.zeros(len(value), bool)
        for at, bits in zip(known["shard"].to_pylist(), known["bits"].to_pylist(), strict=True):
            a, b = cut[at], cut[at + 1]
            yes[a:b] = np.unpackbits(np.frombuffer(bits, np.uint8), count=b - a)
        return _answers(mine["bucket"], kind, mine["shard"], blocks, value[yes])

    sent = sent.withColumn("group", F.pmod("bucket", F.lit(route.groups)))
    merged = sent.groupBy("shard", "group").applyInArrow(merge, SENT_DDL)
    known = merged.groupBy("shard").applyInArrow(shard, ANSWER_DDL).select(F.floor(F.col("shard") / each).cast("int").alias("range"), F.col("bucket").alias("group"), "shard", "bits")
    return sent.groupBy("shard", "group").cogroup(known.groupBy("range", "group")).applyInArrow(share, ANSWER_DDL)


def isin(values: np.ndarray, among: np.ndarray) -> np.ndarray:
    """values in among (sorted, distinct).

    Most values are not: a table of some of their bits rules them out sooner than a search does.
    """
    if not len(among):
        return np.zeros(len(values), bool)
    some: slice | np.ndarray = slice(None)
    out = np.zeros(len(values), bool)
    if len(values) > 4096:
        bits = min(24, max(12, (8 * len(among)).bit_length()))
        slot = lambda x: ((x >> np.uint64(20)) & np.uint64((1 << bits) - 1)).astype(np.int64)
        table = np.zeros(1 << bits, bool)
        table[slot(among)] = True
        some = np.flatnonzero(table[slot(values)])
    asked = values[some]
    at = np.searchsorted(among, asked)
    at[at == len(among)] = 0
    out[some] = among[at] == asked
    return out


def _said(value: np.ndarray, answers: pa.Table, kind: int, shards: int) -> np.ndarray:
    """For each of a bucket's sorted distinct hashes whether it occurs twice or more."""
    cut = _cuts(value, shards)
    yes = np.zeros(len(value), bool)
    for k, shard, bits in zip(answers["kind"].to_pylist(), answers["shard"].to_pylist(), answers["bits"].to_pylist(), strict=True):
        if k == kind:
            a, b = cut[shard], cut[shard + 1]
            yes[a:b] = np.unpackbits(np.frombuffer(bits, np.uint8), count=b - a)
    return yes


def unpack(hashes: np.ndarray, answers: pa.Table, kind: int, shards: int) -> np.ndarray:
    """The distinct hashes of a bucket that occur twice or more, sorted. hashes: as given to pack()."""
    value = distinct(hashes)
    return value[_said(value, answers, kind, shards)]


def flags(hashes: np.ndarray, answers: pa.Table, kind: int, shards: int) -> np.ndarray:
    """For each of hashes, as given to pack(), whether it occurs twice or more."""
    value, place = np.unique(hashes, return_inverse=True)
    return _said(value, answers, kind, shards)[place]
