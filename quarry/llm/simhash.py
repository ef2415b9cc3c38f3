"""SimHash near-duplicates by shards of BK-trees.

A document's fingerprint has a bit set where more than half of its shingles' hashes have it. Distinct
fingerprints are dealt to shards: of radius + c blocks of bits, two fingerprints within the radius agree
in at least c, so each joins one shard for each choice of c blocks, and neighbours share a shard. In a
shard every key has a BK-tree, whose children are keyed by their integer Hamming distance to the parent;
a search at distance d from a node follows only the edges d - radius to d + radius. Trees are built and
searched a level at a time, over all keys of a shard at once.

Only connectivity is asked for, so a shard returns a forest, not its pairs. A key with more than TREE
fingerprints is first linked to the one of them with the most documents; those still apart from it ask
all trees of the key, each of at most TREE fingerprints, which are sent to every block of the questions.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialise, ship
from . import words as W
from .components import connected_components

#: Fingerprints in a tree; questions of a large key that meet its trees in one task.
TREE, ASKED = 4096, 1 << 15
#: Rows of a shard that a task holds (16 bytes each, and as much again for each of a few steps).
SHARD = 1 << 16
#: Fingerprints that a key has on average, at most, before more blocks have to agree.
CROWD = 64
#: Pairs of question and node that are compared at once.
STEP = 1 << 20
LINKS = "a long, b long"


# ---- fingerprints ----


def _bits(hashes: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """For each part, the bits that more than half of its hashes have; parts without any give 0."""
    out = np.zeros(len(bounds) - 1, np.uint64)
    for part in np.flatnonzero(np.diff(bounds)).tolist():
        a, b = bounds[part], bounds[part + 1]
        count = np.zeros(64, np.int64)
        for at in range(a, b, STEP):
            count += np.unpackbits(hashes[at : min(b, at + STEP)].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
        out[part] = np.packbits(2 * count > b - a, bitorder="little").view(np.uint64)[0]
    return out


def simhash(column: pa.Array, k: int = 4, seed: int = 42) -> Iterator[np.ndarray]:
    """Fingerprints of the texts, by chunks: of the XXH64 of their lower-cased k-word shingles, repeats included."""
    for w in W.split(column, lower=True, hashed=False):
        body, start, end = W.spaced(w.data, w.starts, w.ends)
        body, start, end = body.tobytes(), start[:-1], end
        count = np.diff(w.bounds)
        doc = w.doc_of_word()
        last = np.minimum(np.arange(len(doc)) + k - 1, w.bounds[1:][doc] - 1)
        # a shingle starts at each word with k - 1 more behind it; a shorter text is one shingle
        first = np.flatnonzero((np.arange(len(doc)) + k <= w.bounds[1:][doc]) | ((count[doc] < k) & (np.arange(len(doc)) == w.bounds[:-1][doc])))
        hashes = np.fromiter((xxhash.xxh64_intdigest(body[a:b], seed) for a, b in zip(start[first].tolist(), end[last[first]].tolist(), strict=True)), np.uint64, len(first))
        yield _bits(hashes, np.searchsorted(first, w.bounds))


# ---- BK-trees ----


def _apart(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    return np.bitwise_count(x ^ y).astype(np.int64)


class Forest:
    """BK-trees over distinct fingerprints, one for each stretch of equal roots; its root is the stretch's first."""

    EDGES = 65

    def __init__(self, prints: np.ndarray, roots: np.ndarray) -> None:
        self.prints, self.roots = prints, roots
        edge, child = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        left = np.flatnonzero(roots != np.arange(len(prints)))
        at = roots[left]
        while len(left):
            way = at * self.EDGES + _apart(prints[left], prints[at])
            ways, first, back = np.unique(way, return_index=True, return_inverse=True)
            edge.append(ways)
            child.append(left[first])
            at = left[first][back]
            others = np.ones(len(left), bool)
            others[first] = False
            left, at = left[others], at[others]
        self.edge = np.concatenate(edge)
        order = np.argsort(self.edge, kind="stable")
        self.edge, self.child = self.edge[order], np.concatenate(child)[order]

    def near(self, asked: np.ndarray, roots: np.ndarray, radius: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(question, node) within the radius of each other, a level of the trees at a time."""
        stack = [(np.arange(len(asked)), roots)]
        while stack:
            who, node = stack.pop()
            if len(who) > STEP:
                half = len(who) // 2
                stack += [(who[half:], node[half:]), (who[:half], node[:half])]
                continue
            apart = _apart(asked[who], self.prints[node])
            close = apart <= radius
            if close.any():
                yield who[close], node[close]
            low = np.searchsorted(self.edge, node * self.EDGES + np.maximum(apart - radius, 0))
            high = np.searchsorted(self.edge, node * self.EDGES + np.minimum(apart + radius, 64), "right")
            ways = high - low
            if ways.any():
                take = np.arange(ways.sum()) + np.repeat(low - (np.cumsum(ways) - ways), ways)
                stack.append((np.repeat(who, ways), self.child[take]))


def _hook(label: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
    """Join the classes of a and b; a class is known by its smallest place."""
    while True:
        x, y = label[a], label[b]
        apart = x != y
        if not apart.any():
            return
        a, b, x, y = a[apart], b[apart], x[apart], y[apart]
        np.minimum.at(label, np.maximum(x, y), np.minimum(x, y))
        while (label[label] != label).any():
            label[:] = label[label]


def _forest_links(prints: np.ndarray, key: np.ndarray, asks: np.ndarray | None, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Links that connect what is within the radius among rows of one key, no more than there are rows.

    asks marks the questions (none: every row asks); only the other rows, or all, are in trees.
    """
    value, number = np.unique(prints, return_inverse=True)
    label = np.arange(len(value))
    held = np.arange(len(prints)) if asks is None else np.flatnonzero(~asks)
    held = held[np.argsort(key[held], kind="stable")]
    new = np.ones(len(held), bool)
    new[1:] = key[held][1:] != key[held][:-1]
    first = np.flatnonzero(new)
    forest = Forest(prints[held], np.repeat(first, np.diff(np.append(first, len(held)))))
    who = held if asks is None else np.flatnonzero(asks)
    if len(held) and len(who):
        keys = key[held][first]
        root = first[np.minimum(np.searchsorted(keys, key[who]), len(keys) - 1)]
        same = key[held][root] == key[who]
        who, root = who[same], root[same]
        for q, node in forest.near(prints[who], root, radius):
            _hook(label, number[who[q]], number[held[node]])
    moved = np.flatnonzero(label != np.arange(len(value)))
    return value[label[moved]], value[moved]


# ---- shards ----


def choose_blocks(prints: int, radius: int) -> tuple[int, list[int]]:
    """(blocks that have to agree, a mask for each choice of them), so that a key has about CROWD fingerprints or fewer.

    Exact for any number: of radius + c blocks, two fingerprints within the radius agree in c.
    """
    agree = 1
    while agree < min(4, 64 - radius) and prints >> (64 // (radius + agree) * agree) > CROWD:
        agree += 1
    edges = [64 * i // (radius + agree) for i in range(radius + agree + 1)]
    blocks = [((1 << b) - 1) ^ ((1 << a) - 1) for a, b in zip(edges[:-1], edges[1:], strict=True)]
    return agree, [sum(x) for x in combinations(blocks, agree)]


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def near_links(prints: DataFrame, radius: int = 4) -> DataFrame:
    """(a, b) that connect all distinct fingerprints within the radius of each other. prints: print (distinct), docs.

    Every link joins fingerprints that a chain of such neighbours joins; a shard or tree sends fewer links
    than it has rows. A radius of 0 to 60.
    """
    spark = prints.sparkSession
    n = prints.count()
    _, masks = choose_blocks(n, radius)
    tables = F.explode(F.array(*[F.struct(F.lit(i).alias("choice"), F.col("print").bitwiseAND(F.lit(_signed(m))).alias("bits")) for i, m in enumerate(masks)]))
    rows = prints.select("print", "docs", tables.alias("of")).select("print", "docs", F.xxhash64("of.choice", "of.bits").alias("key"))
    total = n * len(masks)
    shards = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-total // SHARD))
    # keys that may be large are found by counts of hashed groups of keys, so that few keys are counted one by one
    groups = max(1 << 12, total // (TREE // 4))
    group = F.pmod(F.xxhash64("key", F.lit(1)), F.lit(groups))
    full = materialise(rows.groupBy(group.alias("group")).count().where(F.col("count") > TREE).select("group"), "full")
    large = None
    if not full.isEmpty():
        large = rows.withColumn("group", group).join(full, "group", "left_semi").groupBy("key").agg(F.count("*").alias("rows"), F.max_by("print", F.struct("docs", "print")).alias("lead"))
        large = materialise(large.where(F.col("rows") > TREE), "large")
        if large.isEmpty():
            large = None
    light = rows if large is None else rows.join(large.select("key"), "key", "left_anti")

    def search(table: pa.Table) -> pa.Table:
        W.give_memory_back()
        a, b = _forest_links(table["print"].to_numpy().view(np.uint64), table["key"].to_numpy(), None, radius)
        return pa.table([pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], names=["a", "b"])

    links = light.select("print", "key", F.pmod(F.xxhash64("key", F.lit(2)), F.lit(shards)).alias("shard")).groupBy("shard").applyInArrow(search, LINKS)
    return links if large is None else links.unionByName(_large_links(rows, large, radius))


def _large_links(rows: DataFrame, large: DataFrame, radius: int) -> DataFrame:
    """Links within the keys of more than TREE fingerprints. large: key, rows, lead."""
    own = rows.select("print", "key").join(large, "key")
    star = materialise(own.where((F.bit_count(F.col("print").bitwiseXOR(F.col("lead"))) <= radius) & (F.col("print") != F.col("lead"))).select(F.col("lead").alias("a"), F.col("print").alias("b")).distinct(), "star")
    part = materialise(connected_components(star), "part")
    named = own.join(part.withColumnRenamed("node", "print"), "print", "left").withColumn("component", F.coalesce("component", "print"))
    leads = part.select(F.col("node").alias("lead"), F.col("component").alias("main"))
    named = materialise(named.join(leads, "lead", "left").withColumn("asks", F.col("component") != F.coalesce("main", "lead")), "named")
    asking = named.where("asks").groupBy("key").agg(F.ceil(F.count("*") / ASKED).cast("int").alias("blocks"))
    both = named.join(asking, "key").withColumn("trees", F.ceil(F.col("rows") / TREE).cast("int"))
    part_of = lambda n, seed: F.pmod(F.xxhash64("print", F.lit(seed)), F.col(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    trees = both.select("key", "print", F.lit(False).alias("asks"), part_of("trees", 3).alias("tree"), every("blocks").alias("block"))
    asked = both.where("asks").select("key", "print", F.lit(True).alias("asks"), every("trees").alias("tree"), part_of("blocks", 4).alias("block"))

    def search(table: pa.Table) -> pa.Table:
        W.give_memory_back()
        a, b = _forest_links(table["print"].to_numpy().view(np.uint64), table["key"].to_numpy(), table["asks"].to_numpy(), radius)
        return pa.table([pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], names=["a", "b"])

    return star.unionByName(trees.unionByName(asked).groupBy("key", "tree", "block").applyInArrow(search, LINKS))


def simhash_components(df: DataFrame, *, k: int = 4, radius: int = 4, seed: int = 42, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, print (the fingerprint as a signed long) and component_id of every row of df.

    Words are lower-cased (A-Z) runs without white space; a text of fewer than k words is one shingle.
    Fingerprints link at radius or fewer differing bits; component_id is the smallest doc_id that links
    reach.

    Null and empty texts, or texts of white space, have fingerprint 0, which links like any other. Long
    texts are read whole. Equal fingerprints are one; of ties the smallest doc_id names the component.
    Rows that share a doc_id are one node. A row without an id has a fingerprint and a null component, and
    connects nothing. Empty tables give no rows; other columns are ignored.
    """
    spark = df.sparkSession
    ship(spark)

    def prints(batches):
        for batch in batches:
            for start in range(0, batch.num_rows, 1024):
                part = batch.slice(start, 1024)
                found = np.concatenate([np.zeros(0, np.uint64), *simhash(part.column(1), k, seed)])
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(found.view(np.int64))], ["doc_id", "print"])

    rows = materialise(df.select(F.col(doc_id).cast("long"), F.col(text).cast("string")).mapInArrow(prints, "doc_id long, print long"), "prints")
    held = rows.where("doc_id IS NOT NULL")
    distinct = materialise(held.groupBy("print").agg(F.min("doc_id").alias("rep"), F.count("*").alias("docs")), "distinct")
    links = near_links(distinct.select("print", "docs"), radius)
    rep = lambda c: distinct.select(F.col("print").alias(c), F.col("rep").alias(f"rep_{c}"))
    edges = links.join(rep("a"), "a").join(rep("b"), "b").select(F.col("rep_a").alias("a"), F.col("rep_b").alias("b"))
    # an id's fingerprints belong together, whatever they share
    several = held.groupBy("doc_id").agg(F.min("print").alias("low"), F.max("print").alias("high")).where("low <> high").select("doc_id")
    edges = edges.unionByName(held.join(several, "doc_id").join(distinct, "print").select(F.col("doc_id").alias("a"), F.col("rep").alias("b")))
    part = connected_components(materialise(edges.distinct(), "links"))
    named = distinct.join(part.select(F.col("node").alias("rep"), "component"), "rep", "left").select("print", F.coalesce("component", "rep").alias("component"))
    out = rows.join(named, "print", "left")
    return out.select("doc_id", "print", F.when(F.col("doc_id").isNotNull(), F.col("component")).alias("component_id"))
