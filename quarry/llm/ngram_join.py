"""N-gram Jaccard join by grouped prefixes.

Every document becomes the set of its distinct word shingles. All sets are ordered by one global
order, shingles of a single document first and frequent ones last, so that two sets of Jaccard
similarity t share a shingle within the first |x| - ceil(t|x|) + 1 of each. Shingles known to occur
in one document are not indexed; most documents have nothing else in their prefix. Documents with the
same prefix and size are collapsed into one group. Groups are paired by the shingles of their prefixes,
pairs of groups are filtered (size, position), and only those that are left are expanded to their
members, which are pruned by parity bitmaps and verified on whole sets.

Only connectivity is asked for, so a bucket of n groups that share a shingle is first joined to its
nearest group alone (n pairs); other pairs are formed only between groups that are not yet known to be
connected. A bucket of more than FEW groups is not written out in pairs: it is dealt into blocks, and
each pair of blocks is compared in memory, so that only pairs that pass the filters are rows. No link
between different components is lost, and copies are never expanded into all their pairs.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import input_bytes, materialise, parts, settled, shared_dir, ship
from . import recurring as R
from . import words as W
from .components import connected_components
from .sums import SENT, message, sum_arrays

SKETCH_BITS = 20
_PIECES = 64
#: Uniqueness is asked for half of all shingles, by the first 6 bytes of their hashes. A false "not unique" costs time only.
_ASKED, _WIDTH = np.uint64(1), 6
_SHORT = np.uint64(0xFFFFFFFFFFFF0000)
#: Groups in a bucket whose pairs are written out; rows in a block of a larger bucket.
FEW, BLOCK = 128, 2048


def _shingle_sets(column: pa.Array, k: int) -> Iterator[tuple[int, np.ndarray]]:
    """(row, sorted distinct shingle hashes); texts of fewer than k words give their whole sequence."""
    for w in W.split(column, lower=True):
        doc, _, value = W.runs(w, k)
        count = np.diff(w.bounds)
        short = np.flatnonzero((count > 0) & (count < k))
        if len(short):
            whole = [W.mix(np.array([len(h)], np.uint64) + W.rolling(h, len(h)))[0] for h in (w.hashes[w.bounds[i] : w.bounds[i + 1]] for i in short)]
            doc, value = np.concatenate([doc, short]), np.concatenate([value, np.array(whole, np.uint64)])
            order = np.argsort(doc, kind="stable")
            doc, value = doc[order], value[order]
        cut = np.searchsorted(doc, np.arange(w.docs + 1))
        value = W.sort_within(value, cut)
        for i in range(w.docs):
            s = value[cut[i] : cut[i + 1]]
            if len(s) > 1:
                new = np.ones(len(s), bool)
                np.not_equal(s[1:], s[:-1], out=new[1:])
                s = s[new]
            yield w.first + i, s


def frequency_sketch(df: DataFrame, k: int, text: str = "text") -> np.ndarray:
    """Documents that hold a shingle, counted over all documents by the first bits of its hash.

    Its size is fixed (2**SKETCH_BITS counters), whatever the input. It only ranks shingles:
    any ranking gives the same links, a good one gives few candidates.
    """

    def count(batches):
        table = np.zeros(1 << SKETCH_BITS, np.int64)
        for batch in batches:
            block = [s >> np.uint64(64 - SKETCH_BITS) for _, s in _shingle_sets(batch.column(0), k)]
            if block:
                table += np.bincount(np.concatenate(block).astype(np.int64), minlength=len(table))
        yield message({f"{i}": x for i, x in enumerate(np.split(table, _PIECES)) if x.any()})

    got = sum_arrays(df.select(text).mapInArrow(count, SENT), _tasks(df), "<i8")
    none = np.zeros((1 << SKETCH_BITS) // _PIECES, np.int64)
    return np.concatenate([got.get(f"{i}", none) for i in range(_PIECES)])


def _tasks(df: DataFrame) -> int:
    """About how many tasks a scan makes; only the number of levels of a sum depends on it."""
    return max(df.sparkSession.sparkContext.defaultParallelism, -(-input_bytes(df) // (8 << 20)))


def _levels(table: np.ndarray) -> np.ndarray:
    """Ranks of counters: 0 for all that chance could fill, then one for each doubling."""
    noise = table.sum() / len(table)
    return np.floor(np.log2(1 + table / (2 * noise + 16))).astype(np.int8)


def _bitmap(values: np.ndarray) -> np.ndarray:
    """Parity bits of a set: |A xor B| is at least the number of bits in which two sets' bitmaps differ."""
    bits = max(64, 1 << (max(len(values), 1) - 1).bit_length())
    parity = np.bincount((values & np.uint64(bits - 1)).astype(np.int64), minlength=bits) & 1
    return np.packbits(parity.astype(np.uint8), bitorder="little").view(np.int64)


def _index(df: DataFrame, k: int, percent: int, levels: np.ndarray) -> DataFrame:
    """One row per document: size and digest of its set, its prefix's digest and shingles (those known
    to be of one document left out; lead: how many), its bitmap."""
    ranks = df.sparkSession.sparkContext.broadcast(levels)
    n = parts(df)
    route = R.Route.of(n, parts(df, R.SHARD_BYTES))
    # dealt by row, so that rows that repeat do not meet in one bucket
    docs = settled(df).withColumn("bucket", F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(n)).cast("int")).groupBy("bucket")

    def asked(s: np.ndarray) -> np.ndarray:
        return s[(s & _ASKED) == 0] & _SHORT

    def sets_of(table: pa.Table) -> list[np.ndarray]:
        return [s for _, s in _shingle_sets(table["text"], k)]

    def every(sets: list[np.ndarray]) -> np.ndarray:
        return np.concatenate([np.zeros(0, np.uint64), *map(asked, sets)])

    def send(table: pa.Table) -> pa.Table:
        return R.pack(table["bucket"][0].as_py(), every(sets_of(table)), route.first, _WIDTH)

    def rows(table: pa.Table, answers: pa.Table) -> pa.Table:
        sets = sets_of(table)  # about as large as the bucket's texts
        level, several, at = ranks.value, R.flags(every(sets), answers, 1, route.first), 0
        out = []
        for s in sets:
            size = len(s)
            p = size - -(-percent * size // 100) + 1 if size else 0
            alone = (s & _ASKED) == 0
            n_asked = int(np.count_nonzero(alone))
            alone[alone] = ~several[at : at + n_asked]
            at += n_asked
            rank = np.where(alone, -1, level[(s >> np.uint64(64 - SKETCH_BITS)).astype(np.int64)])
            prefix = s[np.lexsort((s, rank))[:p]].view(np.int64)
            lead = min(p, int(alone.sum()))
            out.append((size, hashlib.blake2b(s.tobytes(), digest_size=16).hexdigest(), hashlib.blake2b(prefix.tobytes(), digest_size=16).hexdigest(), lead, prefix[lead:], _bitmap(s)))
        size, digest, key, lead, prefix, bits = zip(*out, strict=True)
        types = (pa.int64(), pa.string(), pa.string(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int64()))
        return pa.table([table["doc_id"], *(pa.array(x, t) for x, t in zip((size, digest, key, lead, prefix, bits), types, strict=True))], names=["doc_id", "n", "digest", "prefix_key", "lead", "prefix", "bits"])

    answers = R.answer(docs.applyInArrow(send, R.SENT_DDL), 1, route, _WIDTH).groupBy("bucket")
    return docs.cogroup(answers).applyInArrow(rows, "doc_id long, n long, digest string, prefix_key string, lead long, prefix array<long>, bits array<long>")


def _could_link(percent: int, n: str, i: str, m: str, j: str):
    """Size and positional filter of two sets (sizes n, m) whose first common shingle is at i and j."""
    need = F.ceil(F.col(n) * 0 + percent * (F.col(n) + F.col(m)) / F.lit(100.0 + percent) - 1e-6)
    return (F.least(n, m) * 100 >= F.greatest(n, m) * percent) & (1 + F.least(F.col(n) - F.col(i) - 1, F.col(m) - F.col(j) - 1) >= need)


_DIFFERENT = """
aggregate(
  zip_with(
    CASE WHEN size(bits_a) = 2 * size(bits_b) THEN zip_with(slice(bits_a, 1, size(bits_b)), slice(bits_a, size(bits_b) + 1, size(bits_b)), (x, y) -> x ^ y) ELSE bits_a END,
    CASE WHEN size(bits_b) = 2 * size(bits_a) THEN zip_with(slice(bits_b, 1, size(bits_a)), slice(bits_b, size(bits_a) + 1, size(bits_a)), (x, y) -> x ^ y) ELSE bits_b END,
    (x, y) -> coalesce(bit_count(x ^ y), 0)),
  0, (s, x) -> s + x)
"""


def _verify(pairs: DataFrame, units: DataFrame, docs: DataFrame, k: int, percent: int) -> DataFrame:
    """The pairs (a, b) of documents whose whole sets link. docs: doc_id, text."""
    side = lambda c: units.select(F.col("rep").alias(c), F.col("n").alias(f"n_{c}"), F.col("bits").alias(f"bits_{c}"))
    near = pairs.join(side("a"), "a").join(side("b"), "b")
    most = F.floor((F.col("n_a") + F.col("n_b")) * (100.0 - percent) / (100.0 + percent) + 1e-6)
    fits = F.expr("greatest(size(bits_a), size(bits_b)) > 2 * least(size(bits_a), size(bits_b))") | (F.expr(_DIFFERENT) <= most)
    near = materialise(near.where((F.least("n_a", "n_b") * 100 >= F.greatest("n_a", "n_b") * percent) & fits).select("a", "b").distinct(), "pairs")
    wanted = materialise(near.select(F.col("a").alias("doc_id")).unionByName(near.select(F.col("b").alias("doc_id"))).distinct(), "wanted")

    def sets(batches):
        for batch in batches:
            for start in range(0, batch.num_rows, 256):
                part = batch.slice(start, 256)
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array([s.view(np.int64) for _, s in _shingle_sets(part.column(1), k)], pa.list_(pa.int64()))], ["doc_id", "shingles"])

    found = docs.join(wanted, "doc_id", "left_semi").select("doc_id", "text").mapInArrow(sets, "doc_id long, shingles array<long>").distinct()
    found = materialise(found, "sets")
    both = near.join(found.select(F.col("doc_id").alias("a"), F.col("shingles").alias("sa")), "a").join(found.select(F.col("doc_id").alias("b"), F.col("shingles").alias("sb")), "b")
    both = both.select("a", "b", F.size("sa").alias("na"), F.size("sb").alias("nb"), F.size(F.array_intersect("sa", "sb")).alias("common"))
    return both.where(F.col("common") * 100 >= (F.col("na") + F.col("nb") - F.col("common")) * percent).select("a", "b").distinct()


def _folded(bits: list, size: int) -> np.ndarray:
    """Bitmaps of size words, or a multiple, as rows of size words."""
    out = np.array(bits, np.int64).reshape(len(bits), -1, size)
    return np.bitwise_xor.reduce(out, axis=1)


def _compare(table: pa.Table, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """Places (x, y) of the rows of a pair of blocks that may link; rows without a bitmap stand for several sets."""
    block, n, pos, low, high = (table[c].to_numpy() for c in ("block", "n", "pos", "low", "high"))
    first = block == table["i"][0].as_py()
    left = np.flatnonzero(first)
    right = np.flatnonzero(~first) if table["i"][0].as_py() != table["j"][0].as_py() else left
    bits = table["bits"].to_pylist()
    words = np.array([len(x) if x is not None else 0 for x in bits])
    found: list[list[np.ndarray]] = [[], []]
    for a in np.unique(words[left]).tolist():
        for b in np.unique(words[right]).tolist():
            x, y = left[words[left] == a], right[words[right] == b]
            width = min(a, b)
            mine = _folded([bits[i] for i in x], width) if width else None
            other = _folded([bits[i] for i in y], width) if width else None
            step = max(1, (1 << 22) // (len(y) * max(1, width)))
            for k in range(0, len(x), step):
                p = x[k : k + step][:, None]
                total = n[p] + n[y]
                ok = np.minimum(n[p], n[y]) * 100 >= np.maximum(n[p], n[y]) * percent
                ok &= ~((low[p] == high[p]) & (low[y] == high[y]) & (low[p] == low[y]))
                ok &= 1 + np.minimum(n[p] - pos[p], n[y] - pos[y]) - 1 >= np.ceil(percent * total / (100.0 + percent) - 1e-6)
                if left is right:
                    ok &= p < y
                if width and ok.any():
                    apart = np.bitwise_count(mine[k : k + step, None, :] ^ other[None, :, :]).sum(axis=2, dtype=np.int64)
                    ok &= apart <= np.floor(total * (100.0 - percent) / (100.0 + percent) + 1e-6)
                i, j = np.nonzero(ok)
                found[0].append(x[k : k + step][i])
                found[1].append(y[j])
    return tuple(np.concatenate([np.zeros(0, np.int64), *f]) for f in found)


def _pairs(rows: DataFrame, bits: DataFrame, percent: int) -> DataFrame:
    """(a, b), a < b: ids that share a bucket, may link, and are not known to be of one component.

    rows: bucket, id, n, pos, low and high (the least and greatest component of its sets). bits: id, bits
    (null: several sets), which only rows of large buckets are given.
    """
    size = rows.groupBy("bucket").agg(F.count("*").alias("rows"), F.min("low").alias("l"), F.max("high").alias("h")).where("l <> h AND rows > 1")
    rows = materialise(rows.join(size.select("bucket", "rows"), "bucket"), "buckets")
    few = rows.where(F.col("rows") <= FEW).select("bucket", "id", "n", "pos", "low", "high")
    other = few.select("bucket", F.col("id").alias("r"), F.col("n").alias("m"), F.col("pos").alias("j"), F.col("low").alias("l"), F.col("high").alias("h"))
    known = (F.col("low") == F.col("high")) & (F.col("l") == F.col("h")) & (F.col("low") == F.col("l"))
    out = few.join(other, (few["bucket"] == other["bucket"]) & (F.col("id") < F.col("r")) & ~known & _could_link(percent, "n", "pos", "m", "j")).select(F.col("id").alias("a"), F.col("r").alias("b"))

    many = rows.where(F.col("rows") > FEW)
    if many.isEmpty():
        return out.distinct()
    many = many.withColumn("blocks", F.ceil(F.col("rows") / BLOCK).cast("int"))
    many = many.withColumn("block", F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int")).withColumn("k", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    many = many.join(bits, "id").select("bucket", F.least("block", "k").alias("i"), F.greatest("block", "k").alias("j"), "block", "id", "n", "pos", "bits", "low", "high")

    def compare(table: pa.Table) -> pa.Table:
        x, y = _compare(table, percent)
        ids = table["id"].to_numpy()
        a, b = ids[x], ids[y]
        apart = a != b
        return pa.table([pa.array(np.minimum(a, b)[apart]), pa.array(np.maximum(a, b)[apart])], names=["a", "b"])

    return out.unionByName(many.groupBy("bucket", "i", "j").applyInArrow(compare, "a long, b long")).distinct()


def ngram_components(df: DataFrame, *, k: int = 5, percent: int = 80, doc_id: str = "doc_id", text: str = "text", star_rounds: int = 1) -> DataFrame:
    """doc_id, n_shingles, component_id of every row of df.

    Words are lower-cased (A-Z) runs without white space; two documents link when
    100 * |A and B| >= percent * |A or B| of their sets of k-word shingles. component_id is the
    smallest doc_id that links reach.

    Null or empty texts, or texts of white space: an empty set, linked with nothing, component_id is
    their own doc_id (unless another row of that doc_id has links). Fewer than k words: one shingle, the
    whole sequence. Long texts are read whole. Rows that share a doc_id are one node with several sets;
    of ties the smallest doc_id names the component. A null doc_id links with nothing and names itself.
    Empty tables give no rows; other columns are ignored. percent must be over 50.
    """
    spark = df.sparkSession
    ship(spark)
    shared_dir(spark)
    docs = df.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    index = materialise(_index(docs, k, percent, _levels(frequency_sketch(docs, k))), "index")
    some = index.where("n > 0 AND doc_id IS NOT NULL")

    # copies of a set are one unit; units with the same size and prefix are one group
    units = materialise(some.groupBy("digest").agg(F.min("doc_id").alias("rep"), F.first("n").alias("n"), F.first("prefix_key").alias("prefix_key"), F.first("bits").alias("bits"), F.first("lead").alias("lead"), F.first("prefix").alias("prefix")), "units")
    groups = units.groupBy("n", "prefix_key").agg(F.min("rep").alias("gid"), F.count("*").alias("members"), F.first("lead").alias("lead"), F.first("prefix").alias("prefix"))
    groups = materialise(groups, "groups")
    several = groups.where("members > 1").select("n", "prefix_key", "gid")
    # members of groups of several, the others are their group's only one
    crowd = materialise(units.join(several, ["n", "prefix_key"]).select("gid", "rep", "n"), "members")
    crowded = not crowd.isEmpty()

    tokens = groups.select("gid", "n", "lead", F.posexplode("prefix").alias("pos", "token")).select("token", F.col("gid").alias("id"), "n", (F.col("pos") + F.col("lead")).alias("pos"))
    shared = tokens.groupBy("token").agg(F.count("*").alias("groups")).where("groups > 1").select("token")
    tokens = materialise(tokens.join(shared, "token"), "tokens")

    # bitmaps are looked up for rows of large buckets alone; a group of several sets has none
    set_bits = units.select(F.col("rep").alias("id"), "bits")
    group_bits = groups.select(F.col("gid").alias("id"), "members").join(set_bits, "id").select("id", F.when(F.col("members") == 1, F.col("bits")).alias("bits"))

    # an id's sets belong together, whatever they share
    named = index.where("doc_id IS NOT NULL").groupBy("doc_id").agg(F.min(F.xxhash64("digest")).alias("low"), F.max(F.xxhash64("digest")).alias("high"))
    named = materialise(named.where("low <> high").select("doc_id"), "named")
    twice = not named.isEmpty()
    links = some.join(named, "doc_id").join(units.select("digest", "rep"), "digest").select(F.col("doc_id").alias("a"), F.col("rep").alias("b")).where("a <> b") if twice else None
    # an empty range, not an empty list: for a list every executor would start Python workers of its own
    nothing = lambda a, b: spark.range(0).select(F.col("id").alias(a), F.col("id").alias(b))
    links = materialise(links, "links") if twice else nothing("a", "b")
    part = connected_components(links) if twice else nothing("node", "component")

    def with_component(rows: DataFrame, rep: str) -> DataFrame:
        return rows.join(part.withColumnRenamed("node", rep), rep, "left").withColumn("component", F.coalesce("component", rep))

    def spans(rows: DataFrame) -> DataFrame:
        """Rows of groups (id) with the least and greatest component of their members."""
        own = with_component(rows, "id")
        if not crowded:
            return own.withColumns({"low": F.col("component"), "high": F.col("component")}).drop("component")
        span = with_component(crowd.select("gid", "rep"), "rep").groupBy("gid").agg(F.min("component").alias("low"), F.max("component").alias("high"))
        own = own.join(span.withColumnRenamed("gid", "id"), "id", "left")
        return own.withColumns({"low": F.coalesce("low", "component"), "high": F.coalesce("high", "component")}).drop("component")

    def linked(pairs: DataFrame) -> None:
        """Verify pairs of documents (a, b); add the links found to the components."""
        nonlocal links, part
        pairs = materialise(pairs.distinct(), "candidates")
        if pairs.isEmpty():
            return
        more = materialise(_verify(pairs, units, docs, k, percent), "links")
        if more.isEmpty():
            return
        links = links.unionByName(more)
        part = materialise(connected_components(links), "parts")

    def expanded(pairs: DataFrame) -> DataFrame:
        """Pairs of groups as pairs of their members; pairs of large groups go through blocks again."""
        if not crowded:
            return pairs
        sizes = crowd.groupBy("gid").agg(F.count("*").alias("members"))
        side = lambda c: sizes.select(F.col("gid").alias(c), F.col("members").alias(f"m_{c}"))
        work = F.coalesce("m_a", F.lit(1)) * F.coalesce("m_b", F.lit(1))
        pairs = materialise(pairs.join(side("a"), "a", "left").join(side("b"), "b", "left").withColumn("work", work), "group-pairs")
        of = lambda c: crowd.select(F.col("gid").alias(c), F.col("rep").alias(f"r_{c}"))
        light = pairs.where(F.col("work") <= FEW * FEW).join(of("a"), "a", "left").join(of("b"), "b", "left")
        light = light.select(F.coalesce("r_a", "a").alias("a"), F.coalesce("r_b", "b").alias("b"))
        heavy = pairs.where(F.col("work") > FEW * FEW).select(F.xxhash64("a", "b").alias("bucket"), F.explode(F.array("a", "b")).alias("gid"))
        alone = units.join(heavy.select(F.col("gid").alias("rep")), "rep", "left_semi").select(F.col("rep").alias("gid"), "rep", "n").join(sizes, "gid", "left_anti")
        return light.unionByName(_pairs(members(heavy.join(crowd.unionByName(alone), "gid")), set_bits, percent)).where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))

    def members(rows: DataFrame) -> DataFrame:
        """Rows (bucket, rep, n) as _pairs() takes them; members share their whole prefix, so their places say nothing."""
        rows = with_component(rows.select("bucket", "rep", "n").distinct(), "rep")
        return rows.select("bucket", F.col("rep").alias("id"), "n", F.lit(0).alias("pos"), F.col("component").alias("low"), F.col("component").alias("high"))

    # first everything that shares a shingle, or a group, with its nearest alone
    for nth in range(star_rounds):
        # the group with the fewest rarer shingles before this one is nearest to what the bucket has in common
        nearest = F.floor(F.col("pos") / 2**nth)
        at = spans(tokens)
        lead = at.groupBy("token").agg(F.min("low").alias("l"), F.max("high").alias("h"), F.min(F.struct(nearest, F.xxhash64(F.col("id"), F.lit(nth)), "id", "n", "pos")).alias("lead")).where("l <> h")
        star = at.join(lead.select("token", F.col("lead.id").alias("r"), F.col("lead.n").alias("m"), F.col("lead.pos").alias("j")), "token").where((F.col("id") != F.col("r")) & _could_link(percent, "n", "pos", "m", "j"))
        pairs = star.select(F.least("id", "r").alias("a"), F.greatest("id", "r").alias("b"))
        linked(pairs.unionByName(crowd.where("rep <> gid").select(F.col("gid").alias("a"), F.col("rep").alias("b"))))
    # then all others that are still apart
    pairs = expanded(_pairs(spans(tokens).withColumnRenamed("token", "bucket"), group_bits, percent))
    if crowded:
        pairs = pairs.unionByName(_pairs(members(crowd.withColumnRenamed("gid", "bucket")), set_bits, percent))
    linked(pairs)

    labelled = with_component(units.select("digest", "rep"), "rep").select("digest", "component")
    out = index.select("doc_id", "n", "digest").join(labelled, "digest", "left").withColumn("component", F.when((F.col("n") > 0) & F.col("doc_id").isNotNull(), F.col("component")))
    if twice:
        whole = some.join(named, "doc_id").join(labelled, "digest").groupBy("doc_id").agg(F.min("component").alias("whole"))
        out = out.join(whole, "doc_id", "left").withColumn("component", F.coalesce("whole", "component"))
    return out.select("doc_id", F.col("n").alias("n_shingles"), F.coalesce("component", "doc_id").alias("component_id"))


#: The rows of op1 for DuckDB (doc_ids are unique there).
JOIN_SQL = r"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
sets AS (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
                 ELSE list_distinct(list_transform(range(1, len(w) - 1), lambda i: array_to_string(w[i:i + 2], ' '))) END AS s
  FROM words),
shingles AS (SELECT doc_id, len(s) AS n, unnest(s) AS shingle FROM sets),
links AS (
  SELECT a.doc_id AS a, b.doc_id AS b FROM shingles a JOIN shingles b ON a.shingle = b.shingle AND a.doc_id < b.doc_id
  GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 90 * (a.n + b.n - count(*))),
both_ways AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reach AS (SELECT doc_id AS a, doc_id AS b FROM sets UNION SELECT r.a, l.b FROM reach r JOIN both_ways l ON r.b = l.a),
least AS (SELECT a, min(b) AS component_id FROM reach GROUP BY a)
SELECT doc_id, CAST(len(s) AS BIGINT) AS n_shingles, component_id FROM sets JOIN least ON doc_id = a
"""
