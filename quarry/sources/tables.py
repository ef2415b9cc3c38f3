"""Keyed tables that grow with a run's changes, not with what they hold: copy-on-write buckets and a key history.

Both keep data under names of their own and a manifest in a CommitLog: which folders make up each bucket
or range. A commit rewrites the manifest, and only what a run touched is written again.
"""

from __future__ import annotations

import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.state import by_priority
from ..session import materialise, parts, ship
from .commits import CommitLog, Conflict

#: How often a writer starts over when others keep changing what it read.
TRIES = 10


class _Parts:
    """Folders of data by number of a part, listed in a manifest."""

    def __init__(self, spark: SparkSession, root: str) -> None:
        self.spark, self.root, self.log = spark, root.rstrip("/"), CommitLog(spark, root)

    def _read(self, folders: list[str], schema: T.StructType) -> DataFrame:
        if not folders:
            return self.spark.range(0).select(*(F.lit(None).cast(f.dataType).alias(f.name) for f in schema.fields))
        return self.spark.read.schema(schema).parquet(*(f"{self.root}/{x}" for x in folders))

    def vacuum(self, keep: int = 3) -> None:
        """Remove folders that none of the last keep commits lists, and older commits. Not while others write."""
        numbers = self.log.numbers()
        used = {x.split("/")[0] for n in numbers[-keep:] for x in self._listed(self.log.read(n))}
        names = [str(x.getPath().getName()) for x in self.log.files.listStatus(self.log.path(""))] if numbers else []
        self.log.remove(*(n for n in names if not n.startswith((".", "commit-")) and n not in used), *(f"commit-{n:012d}" for n in numbers[:-keep]))

    def _listed(self, body: dict) -> list[str]:
        return [x for folders in body.get("parts", {}).values() for x in folders] + [run[kind][0] for run in body.get("runs", []) for kind in ("keys", "filters")]


class BucketTable(_Parts):
    """One row for each key, in buckets by the key's hash. An upsert rewrites the buckets that it touches and no others.

    Writers are optimistic: who finds the manifest changed since it was read keeps its work if none of its
    buckets changed, and otherwise starts over from the new state. A null key is a key like others.
    """

    def __init__(self, spark: SparkSession, root: str, key: str, buckets: int = 256) -> None:
        super().__init__(spark, root)
        self.key, self.buckets = key, buckets

    def _part(self) -> Column:
        return F.pmod(F.xxhash64(self.key), F.lit(self.buckets)).cast("int")

    def read(self) -> DataFrame | None:
        """All rows of the newest commit; None before the first."""
        _, body = self.log.latest()
        return None if body is None else self._rows(body, None)

    def _rows(self, body: dict, parts: list[int] | None) -> DataFrame:
        folders = [x for p, folders in body["parts"].items() if parts is None or int(p) in parts for x in folders]
        return self._read(folders, T.StructType.fromJson(body["schema"]))

    def upsert(self, new: DataFrame, order: list[str]) -> int:
        """Put in new rows, of each key the last by order; the number of the commit.

        Columns are those of the first upsert. What reaches the driver is the numbers of touched buckets.
        """
        new = materialise(new, "changes")
        last = new.groupBy(self.key).agg(F.max_by(F.struct(*new.columns), F.struct(*order)).alias("_r")).select("_r.*")
        touched = sorted(r[0] for r in new.select(self._part().alias("_part")).distinct().collect())
        for _ in range(TRIES):
            number, body = self.log.latest()
            if body and (body["key"], body["buckets"]) != (self.key, self.buckets):
                raise ValueError(f"{self.root} has key {body['key']} and {body['buckets']} buckets")
            own = T.StructType.fromJson(body["schema"]).fieldNames() if body else new.columns
            merged = by_priority([self._rows(body, touched), last], self.key) if body else last
            name = f"data-{uuid.uuid4().hex}"
            merged.select(*own).withColumn("_part", self._part()).repartition("_part").write.partitionBy("_part").parquet(f"{self.root}/{name}")
            mine = {str(p): [f"{name}/_part={p}"] for p in touched}
            base = body
            while True:
                after = {"key": self.key, "buckets": self.buckets, "schema": (base or {}).get("schema", new.schema.jsonValue()), "parts": {**(base or {}).get("parts", {}), **mine}}
                if self.log.commit(number + 1, after):
                    return number + 1
                number, base = self.log.latest()
                before, now = ((b or {}).get("parts", {}) for b in (body, base))
                if any(before.get(p) != now.get(p) for p in mine):
                    break
            self.log.remove(name)
        raise Conflict(f"{self.root}: others changed the same buckets {TRIES} times")


class History(_Parts):
    """Keys that were seen, in ranges of their hash, with Bloom filters beside them. Each run adds a piece of both.

    A batch first meets the filters of its ranges, about BITS / 8 bytes a key. Only keys that pass meet the
    keys themselves, and only those of their ranges: pieces are sorted by range and the manifest says which
    ranges each file holds, so other files are not opened.
    """

    BITS, HASHES = 20, 10
    #: Keys of a batch that meet a range's filter in one task; bytes of a file of keys.
    ASKED, FILE = 1 << 20, 32 << 20

    def __init__(self, spark: SparkSession, root: str, key: str = "job_url", ranges: int = 4096) -> None:
        super().__init__(spark, root)
        self.key, self.ranges = key, ranges

    def _hashed(self, df: DataFrame) -> DataFrame:
        """Distinct keys (nulls left out) with their range and two hashes."""
        keys = df.select(self.key).where(F.col(self.key).isNotNull()).distinct()
        range_of = F.pmod(F.shiftright(F.xxhash64(self.key), 20), F.lit(self.ranges)).cast("int")
        return keys.select(range_of.alias("_part"), F.xxhash64(self.key, F.lit(1)).alias("_a"), F.xxhash64(self.key, F.lit(2)).alias("_b"), self.key)

    def _sorted(self, df: DataFrame, files: int, kind: str) -> list:
        """Write df sorted by range; [folder, [[file, first range, last range], ...]]."""
        name = f"{kind}-{uuid.uuid4().hex}"
        df.repartitionByRange(files, "_part").sortWithinPartitions("_part").write.parquet(f"{self.root}/{name}")
        held = self.spark.read.schema(df.schema).parquet(f"{self.root}/{name}").groupBy(F.col("_metadata.file_name").alias("f")).agg(F.min("_part").alias("a"), F.max("_part").alias("b"))
        return [name, sorted([r.f, r.a, r.b] for r in held.collect())]

    def _of(self, runs: list[dict], kind: str, ranges: list[int], schema: str) -> DataFrame:
        """Rows of the ranges."""
        wanted = np.array(sorted(ranges))
        names = [f"{run[kind][0]}/{f}" for run in runs for f, a, b in run[kind][1] if np.searchsorted(wanted, a) < np.searchsorted(wanted, b, "right")]
        held = self._read(names, self.spark.range(0).selectExpr(*(f"cast(null as {t}) as {c}" for c, t in (x.split(" ", 1) for x in schema.split(", ")))).schema)
        return held.where(F.col("_part").isin(ranges)) if len(ranges) <= 64 else held

    def _bundles(self, keys: int) -> int:
        return min(self.ranges, -(-keys // (self.ASKED // 4)) or 1)

    def _run(self, keys: DataFrame) -> dict:
        """Write a piece of the history: keys (_part, _a, _b, key) and the filters of their ranges."""
        bits, hashes = self.BITS, self.HASHES

        def build(table: pa.Table) -> pa.Table:
            out = []
            for part, mine in _by_part(table):
                size = -(-bits * len(mine) // 64) * 64
                marks = np.zeros(size, np.uint8)
                for at in _places(mine, size, hashes):
                    marks[at] = 1
                out.append((part, np.packbits(marks, bitorder="little").tobytes()))
            return pa.table([pa.array([x for x, _ in out], pa.int32()), pa.array([x for _, x in out], pa.binary())], names=["_part", "bits"])

        n = keys.count()
        # several ranges meet in a task, as many as make enough keys of one
        bundle = F.pmod("_part", F.lit(self._bundles(n)))
        files = parts(keys, self.FILE)
        filters = keys.select("_part", "_a", "_b", bundle.alias("_bundle")).groupBy("_bundle").applyInArrow(build, "_part int, bits binary")
        return {"keys": self._sorted(keys.select("_part", self.key), files, "keys"), "filters": self._sorted(filters, -(-files // 16), "filters"), "n": n}

    def extend(self, df: DataFrame) -> int:
        """Add df's keys; the number of the commit. Keys that are there already are not added again.

        Writers do not disturb each other: pieces of two runs are both listed, a key that both add is there twice.
        """
        ship(self.spark)
        keys = materialise(self._hashed(self.unseen(df.select(self.key))), "keys")
        run = self._run(keys)
        while True:
            number, body = self.log.latest()
            body = body or {"key": self.key, "ranges": self.ranges, "type": keys.schema[self.key].dataType.simpleString(), "runs": []}
            if (body["key"], body["ranges"]) != (self.key, self.ranges):
                raise ValueError(f"{self.root} has key {body['key']} and {body['ranges']} ranges")
            if self.log.commit(number + 1, body | {"runs": [*body["runs"], run]}):
                return number + 1

    def _maybe(self, df: DataFrame, body: dict) -> DataFrame:
        """_part and key of df's distinct keys that pass their range's filters."""
        keys = materialise(self._hashed(df), "asked")
        asked = {r._part: r.n for r in keys.groupBy("_part").agg(F.count("*").alias("n")).collect()}
        # a range of which a batch has very many keys is dealt to several tasks, each with the range's filters
        salts = max(1, -(-max(asked.values(), default=0) // self.ASKED))
        hashes, key = self.HASHES, self.key
        filters = self._of(body["runs"], "filters", list(asked), "_part int, bits binary").withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))

        def test(mine: pa.Table, known: pa.Table) -> pa.Table:
            pieces: dict[int, list[np.ndarray]] = {}
            for part, body in zip(known["_part"].to_pylist(), known["bits"].to_pylist(), strict=True):
                pieces.setdefault(part, []).append(np.frombuffer(body, np.uint8))
            out = [mine.slice(0, 0)]
            for part, here in _by_part(mine):
                passed = np.zeros(len(here), bool)
                for marks in pieces.get(part, []):
                    yes = np.ones(len(here), bool)
                    for at in _places(here, 8 * len(marks), hashes):
                        yes &= (marks[at >> 3] >> (at & 7).astype(np.uint8)) & 1 == 1
                    passed |= yes
                out.append(here.filter(pa.array(passed)))
            return pa.concat_tables(out).select(["_part", key])

        bundle = F.pmod("_part", F.lit(self._bundles(sum(asked.values())))).alias("_bundle")
        salted = keys.select("*", bundle, F.pmod(F.col("_a"), F.lit(salts)).cast("int").alias("_salt"))
        schema = T.StructType([T.StructField("_part", T.IntegerType()), keys.schema[self.key]])
        return salted.groupBy("_bundle", "_salt").cogroup(filters.select("*", bundle).groupBy("_bundle", "_salt")).applyInArrow(test, schema)

    def unseen(self, df: DataFrame) -> DataFrame:
        """Rows of df whose key is not in the history; rows that repeat, and rows without a key, stay."""
        ship(self.spark)
        _, body = self.log.latest()
        if body is None:
            return df
        maybe = materialise(self._maybe(df, body), "maybe")
        ranges = [r[0] for r in maybe.select("_part").distinct().collect()]
        if not ranges:
            return df
        held = self._of(body["runs"], "keys", ranges, f"_part int, {self.key} {body['type']}")
        seen = maybe.select(self.key).join(held.select(self.key), self.key, "left_semi")
        return df.join(seen, self.key, "left_anti")

    def compact(self, most: int = 8) -> None:
        """With more than most runs, write all but the largest few as one: each run's filter passes some keys by chance.

        Runs that others add in the meantime stay beside it.
        """
        _, body = self.log.latest()
        runs = sorted((body or {}).get("runs", []), key=lambda r: -r["n"])
        if len(runs) <= most:
            return
        small = runs[most // 2 :]
        held = self._of(small, "keys", list(range(self.ranges)), f"_part int, {self.key} {body['type']}")
        one = self._run(materialise(self._hashed(held), "keys"))
        while True:
            number, now = self.log.latest()
            if self.log.commit(number + 1, now | {"runs": [r for r in now["runs"] if r not in small] + [one]}):
                return


def _by_part(table: pa.Table):
    """(range, rows) of each range in a table."""
    table = table.sort_by("_part")
    part = table["_part"].to_numpy()
    cut = np.flatnonzero(np.concatenate([[True], part[1:] != part[:-1], [True]])) if len(part) else np.zeros(1, np.int64)
    for a, b in zip(cut[:-1].tolist(), cut[1:].tolist(), strict=True):
        yield int(part[a]), table.slice(a, b - a)


def _places(table: pa.Table, size: int, hashes: int):
    """The places of each key in a filter of size bits, one array for each hash."""
    a, b = (table[c].to_numpy().view(np.uint64) for c in ("_a", "_b"))
    for i in range(hashes):
        yield ((a + np.uint64(i) * (b | np.uint64(1))) % np.uint64(size)).astype(np.int64)
