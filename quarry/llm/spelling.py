"""Spelling variants: words one edit apart, found by merging errata tries.

Words of an edit's two sides agree in the first or in the last half of the shorter one, so each word joins
shards by its halves, and pairs are found within shards. A shard is a trie of what its words do not share.
At each node the largest subtree is the heavy one; every light subtree is merged, with the character that
leads to it replaced or skipped, into the heavy one, into the node itself and, small to large, into the
trie of the light ones before it. Terminals that coincide are words one edit apart. A pair is found at the
one node where its words part, so each is found once. Shards of more than SHARD words are cut by halves of
what is left, again and again.

What leaves a task is one row for each word: how many neighbours it found and the commonest of them.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator
from itertools import groupby
from operator import itemgetter

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import materialise, ship
from . import words as W
from .crc import CRC32_SQL, crc32_sql

#: Words in a shard that one trie takes; rows of shards that meet in one task; counts a task merges before it sends them.
SHARD, ROWS, MERGED = 20_000, 1 << 16, 1 << 18
#: Bytes of a word above which its crc32 is taken by itself.
LONG = 64
_COUNTS = pa.schema([("word", pa.string()), ("n", pa.int64())])
_NEAR = "word string, near long, best string, best_n long"


# ---- words and their counts ----


def _crc_table() -> np.ndarray:
    c = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        c = np.where(c & 1, (c >> 1) ^ np.uint32(0xEDB88320), c >> 1).astype(np.uint32)
    return c


_CRC = _crc_table()


def _crc32(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, seeds: np.ndarray) -> np.ndarray:
    """crc32 of each word, carried on from seeds: a byte at a time, over all words that are that long."""
    size = np.minimum(ends - starts, LONG + 1)
    order = np.argsort(-size, kind="stable")
    at, left = starts[order], np.searchsorted(-size[order], -np.arange(1, LONG + 1), "right")
    state = ~seeds[order].astype(np.uint32)
    for j, n in enumerate(left.tolist()):
        if not n:
            break
        state[:n] = _CRC[(state[:n] ^ data[at[:n] + j]) & np.uint32(0xFF)] ^ (state[:n] >> np.uint32(8))
    out = np.empty(len(starts), np.uint32)
    out[order] = ~state
    for i in np.flatnonzero(size > LONG).tolist():
        out[i] = zlib.crc32(data[starts[i] : ends[i]].tobytes(), int(seeds[i]))
    return out


def _misspelt(w: W.Words, ids: list[int | None], every: int) -> np.ndarray:
    """Which bytes go: of each word whose crc32 with its document's id every divides, one code point."""
    gone = np.zeros(len(w.data), bool)
    seeds = np.array([0 if i is None else zlib.crc32(b"%d:" % i) for i in ids], np.uint32)
    doc = w.doc_of_word()
    h = _crc32(w.data, w.starts, w.ends, seeds[doc]).astype(np.int64)
    hit = np.flatnonzero((h % every == 0) & np.array([i is not None for i in ids], bool)[doc])
    points = np.flatnonzero((w.data & 0xC0) != 0x80)
    first = np.searchsorted(points, w.starts[hit])
    at = points[first + h[hit] % (np.searchsorted(points, w.ends[hit]) - first)]
    gone[at] = True
    wide = at[w.data[at] == 0xC3]
    gone[wide + 1] = True
    return gone


def count_words(ids: pa.Array, texts: pa.Array, least: int, every: int | None) -> Iterator[pa.RecordBatch]:
    """Distinct words of at least so many code points, with their counts, by chunks."""
    for w in W.split(texts, lower=True, letters=True, hashed=False):
        inside = np.zeros(len(w.data) + 1, np.int32)
        inside[w.starts] += 1
        inside[w.ends] -= 1
        keep = np.cumsum(inside[:-1]) > 0
        if every:
            keep &= ~_misspelt(w, ids.slice(w.first, w.docs).to_pylist(), every)
        at = np.concatenate([[0], np.cumsum(keep)])
        data = w.data[keep]
        starts, ends = at[w.starts], at[w.ends]
        points = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
        some = points[ends] - points[starts] >= least
        starts, ends = starts[some], ends[some]
        _, first, count = np.unique(W.hash_spans(data, starts, ends), return_index=True, return_counts=True)
        body, offsets = W.gather(data, starts[first], ends[first])
        words = pa.LargeStringArray.from_buffers(len(first), pa.py_buffer(offsets), pa.py_buffer(body)).cast(pa.string())
        yield pa.RecordBatch.from_arrays([words, pa.array(count)], schema=_COUNTS)


def vocabulary(df: DataFrame, *, least: int = 7, misspell_every: int | None = None, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """word, n: the maximal runs of Latin letters (A-Z and a-z, U+00C0 to U+00FF), A-Z lower-cased, of least code points or more.

    With misspell_every, words lose a code point where their crc32 with the document's id says so (not in rows without an id).
    """

    def merged(held: list[pa.RecordBatch]) -> pa.Table:
        return pa.Table.from_batches(held).group_by("word").aggregate([("n", "sum")]).rename_columns(["word", "n"]).select(["word", "n"])

    def counts(batches):
        held, rows = [], 0
        for batch in batches:
            for found in count_words(batch.column(0), batch.column(1), least, misspell_every):
                held.append(found)
                rows += found.num_rows
                if rows > MERGED:
                    held = merged(held).to_batches()
                    rows = sum(x.num_rows for x in held)
                    if rows > MERGED // 2:
                        yield from held
                        held, rows = [], 0
        if held:
            yield from merged(held).to_batches()

    return df.select(F.col(doc_id).cast("long"), F.col(text).cast("string")).mapInArrow(counts, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))


# ---- errata tries ----

# A trie's node is a dictionary from a character to a child; "" leads to the words that end there. A child with
# one rest is a leaf: the list of the words that have it (in a plain trie a single one).


def _enter(node: dict, i: int, words: list[str], at: int) -> list[int]:
    """Put words[i], from its at-th character on, under node; the words whose terminal it coincides with."""
    mine = words[i]
    while at < len(mine):
        child = node.get(mine[at])
        if child is None:
            node[mine[at]] = [i]
            return []
        at += 1
        if type(child) is list:
            other = words[child[0]]
            if other[at:] == mine[at:]:
                child.append(i)
                return child[:-1]
            child = {other[at : at + 1]: child}
            node[mine[at - 1]] = child
        node = child
    ends = node.setdefault("", [])
    ends.append(i)
    return ends[:-1]


def _meet(a, at: int, b, bt: int, words: list[str], pair: Callable[[int, int], None]) -> None:
    """Pair the words whose rests under a (from their at-th character) and under b (from their bt-th) are equal."""
    stack = [(a, at, b, bt)]
    while stack:
        a, at, b, bt = stack.pop()
        if type(a) is not list and type(b) is not list:
            if len(b) < len(a):
                a, at, b, bt = b, bt, a, at
            for c, x in a.items():
                y = b.get(c)
                if y is not None:
                    stack.append((x, at + 1, y, bt + 1) if c else (x, at, y, bt))
            continue
        if type(a) is not list:
            a, at, b, bt = b, bt, a, at
        mine = words[a[0]]
        while type(b) is not list and at < len(mine):
            b = b.get(mine[at], [])
            at, bt = at + 1, bt + 1
        if type(b) is not list:
            b, bt = b.get("", []), len(mine)
            if b:
                pair(a[0], b[0])
        elif b and words[b[0]][bt:] == mine[at:]:
            pair(a[0], b[0])


def _down(node, c: str, at: int, words: list[str]):
    """The subtree under node's child c, or None; node's words have at characters before it."""
    if type(node) is list:
        return node if words[node[0]][at : at + 1] == c and c else None
    return node.get(c)


def _members(node) -> Iterator[int]:
    stack = [node]
    while stack:
        node = stack.pop()
        if type(node) is list:
            yield from node
        else:
            stack += node.values()


def one_edit_pairs(words: list[str], until: int, pair: Callable[[int, int], None]) -> None:
    """Call pair(i, j) once for each two of the distinct words that one replaced, inserted or deleted character parts, in fewer than until characters from their starts."""
    root: dict = {}
    for i in range(len(words)):
        _enter(root, i, words, 0)
    nodes, order = [(root, 0)], []
    while nodes:
        node, depth = nodes.pop()
        order.append((node, depth))
        nodes += [(x, depth + 1) for c, x in node.items() if type(x) is dict]
    size: dict[int, int] = {}
    for node, depth in reversed(order):
        weight = {c: 1 if type(x) is list else size[id(x)] for c, x in node.items()}
        size[id(node)] = sum(weight.values())
        if depth >= until or len(node) < 2:
            continue
        ends = node.get("")
        ways = [c for c in node if c]
        heavy = max(ways, key=weight.__getitem__)
        tree, at = node[heavy], depth + 1
        if ends and (x := _down(tree, "", at, words) if type(tree) is dict else tree if len(words[tree[0]]) == at else None):
            pair(ends[0], x[0])
        errata: dict | None = {} if len(ways) > 2 else None
        for c in sorted((c for c in ways if c != heavy), key=weight.__getitem__, reverse=True):
            light = node[c]
            # replaced: v c s and v h s; skipped on the heavy side: v h c s and v c s
            _meet(light, at, tree, at, words, pair)
            if (x := _down(tree, c, at, words)) is not None:
                _meet(light, at, x, at + 1, words, pair)
            # skipped on the light side: v c s and v s, where s goes another way than c
            if type(light) is list:
                after = words[light[0]][at : at + 1]
                if after != c and (x := node.get(after)) is not None:
                    _meet(light, at + len(after), x, depth + len(after), words, pair)
            else:
                for after, x in light.items():
                    if after != c and (y := node.get(after)) is not None:
                        _meet(x, at + len(after), y, depth + len(after), words, pair)
            if errata is not None:
                for i in _members(light):
                    for j in _enter(errata, i, words, at):
                        pair(i, j)


# ---- shards ----


def _key() -> Column:
    """A shard: the class, and the halves that its words share."""
    tail = F.expr("right(word, g)")
    return F.xxhash64("m", "f", "g", "until", F.expr("left(word, f)"), tail)


def _halved(rows: DataFrame) -> DataFrame:
    """Each row twice: with half of what is left as a common start, and as a common end (of words that part within that half)."""
    half = F.expr("(m - f - g) div 2").cast("int")
    rows = rows.withColumn("half", half)
    starts = rows.withColumns({"f": F.col("f") + F.col("half")}).where("until > f")
    ends = rows.withColumns({"g": F.col("g") + F.col("half"), "until": F.least("until", F.col("f") + F.col("half"))})
    return starts.unionByName(ends).drop("half")


def _shards(words: DataFrame, least: int) -> DataFrame:
    """word, n, m, f, g, until: words of m and m + 1 code points that share f at the start and g at the end."""
    of = words.withColumn("m", F.explode(F.array(F.length("word"), F.length("word") - 1))).where(F.col("m") >= least)
    return _halved(of.select("word", "n", "m", F.lit(0).alias("f"), F.lit(0).alias("g"), F.lit(2**31 - 1).alias("until")))


def near_words(words: DataFrame, *, least: int = 7) -> DataFrame:
    """word, near, best, best_n: how many of the distinct words (word, n) are one edit from each, and the commonest of them.

    Words without such a neighbour have no row. Of neighbours with equal n, the smallest in code-point
    order is the best. All words have least code points or more; least is 2 or more.
    """
    spark = words.sparkSession
    ship(spark)
    rows = _shards(words, least)
    total = 4 * words.count()
    buckets = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-total // ROWS))
    groups = max(1 << 12, total // max(1, SHARD // 8))
    done = None
    while True:
        # shards that may be large are found by counts of hashed groups of shards, so that few are counted one by one
        group = F.pmod(F.xxhash64(_key(), F.lit(1)), F.lit(groups))
        full = materialise(rows.groupBy(group.alias("group")).count().where(F.col("count") > SHARD).select("group"), "full")
        if full.isEmpty():
            break
        keyed = rows.withColumns({"group": group, "key": _key()})
        large = keyed.join(full, "group", "left_semi").where("m - f - g >= 2").groupBy("key").count().where(F.col("count") > SHARD).select("key")
        large = materialise(large, "large")
        if large.isEmpty():
            break
        small = keyed.join(large, "key", "left_anti").drop("group", "key")
        done = small if done is None else done.unionByName(small)
        rows = _halved(keyed.join(large, "key", "left_semi").drop("group", "key"))
    rows = rows if done is None else done.unionByName(rows)

    def search(table: pa.Table) -> pa.Table:
        W.give_memory_back()
        word, n = table["word"].to_pylist(), table["n"].to_pylist()
        near, best = [0] * len(word), [-1] * len(word)
        shard = [(m, f, g, until, w[:f], w[len(w) - g :], i) for i, (w, m, f, g, until) in enumerate(zip(word, *(table[c].to_pylist() for c in ("m", "f", "g", "until")), strict=True))]
        shard.sort()
        for (m, f, g, until, _, _), rows in groupby(shard, itemgetter(slice(6))):
            at = [x[6] for x in rows]
            if len(at) < 2:
                continue

            def pair(x: int, y: int, at: list[int] = at, m: int = m) -> None:
                x, y = at[x], at[y]
                if len(word[x]) > m and len(word[y]) > m:
                    return  # of the next class
                for a, b in ((x, y), (y, x)):
                    near[a] += 1
                    c = best[a]
                    if c == -1 or n[b] > n[c] or (n[b] == n[c] and word[b] < word[c]):
                        best[a] = b

            one_edit_pairs([word[i][f : len(word[i]) - g] for i in at], until - f, pair)
        some = [i for i, x in enumerate(near) if x]
        return pa.table([pa.array([v[i] for i in some], t) for v, t in ((word, pa.string()), (near, pa.int64()))] + [pa.array([v[best[i]] for i in some], t) for v, t in ((word, pa.string()), (n, pa.int64()))], names=["word", "near", "best", "best_n"])

    found = rows.withColumn("bucket", F.pmod(_key(), F.lit(buckets))).groupBy("bucket").applyInArrow(search, _NEAR)
    first = F.struct((-F.col("best_n")).alias("n"), F.col("best").alias("word"))
    return found.groupBy("word").agg(F.sum("near").alias("near"), F.min(first).alias("best")).select("word", "near", F.col("best.word").alias("best"), (-F.col("best.n")).alias("best_n"))


def spelling_forms(words: DataFrame, *, least: int = 7, times: int = 10) -> DataFrame:
    """word, form, root, n, n_near, form_n of every row of words (word, n; words distinct, of least code points or more).

    n_near: words one inserted, deleted or replaced code point away. form: the commonest of them (ties: the
    smallest in code-point order) if its n is at least times the word's, else null; form_n its n. root: the
    last word that forms lead to from this one, itself without a form. times is 2 or more, so forms lead to
    ever commoner words and end; a few joins by doubled steps follow them. An empty table gives no rows.
    """
    near = near_words(words, least=least)
    known = words.join(near, "word", "left").withColumn("has", F.col("best_n") >= times * F.col("n"))
    known = known.select("word", "n", F.coalesce("near", F.lit(0)).cast("long").alias("n_near"), F.when(F.col("has"), F.col("best")).alias("form"), F.when(F.col("has"), F.col("best_n")).alias("form_n"))
    known = materialise(known, "forms")
    step = known.where("form IS NOT NULL").select("word", F.col("form").alias("root"))
    while True:
        onward = step.select(F.col("word").alias("root"), F.col("root").alias("next"))
        step = materialise(step.join(onward, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "roots")
        if step.where("moved").isEmpty():
            break
        step = step.drop("moved")
    return known.join(step.select("word", "root"), "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def spelling_groups(df: DataFrame, *, least: int = 7, at_least: int = 2, times: int = 10, misspell_every: int | None = None, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """spelling_forms() of the words of df's texts that occur at_least times.

    Null and empty texts have no words. Long texts, and long words, are taken whole. Rows that repeat count
    each. Without misspell_every ids do not matter; with it, words of rows without an id stay as they are.
    Empty tables give no rows; other columns are ignored.
    """
    ship(df.sparkSession)
    words = vocabulary(df, least=least, misspell_every=misspell_every, doc_id=doc_id, text=text)
    return spelling_forms(materialise(words.where(F.col("n") >= at_least), "words"), least=least, times=times)


#: The rows of op13 for DuckDB. Words are near if deleting a code point makes them alike at the same place, or makes the one the other.
FORMS_SQL = (
    CRC32_SQL
    + r""",
runs AS (
  SELECT doc_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[a-z\x{C0}-\x{FF}]+')) AS run
  FROM documents),
hashed AS (SELECT run, """
    + crc32_sql("(doc_id || ':' || run)")
    + r""" AS h FROM runs, crc_table WHERE length(run) >= 7),
spelt AS (SELECT CASE WHEN h % 31 = 0 THEN left(run, h % length(run)) || substr(run, CAST(h % length(run) AS BIGINT) + 2) ELSE run END AS word FROM hashed),
words AS (SELECT word, count(*) AS n FROM spelt WHERE length(word) >= 7 GROUP BY word HAVING count(*) >= 2),
less AS (SELECT word, n, i, left(word, i) || substr(word, i + 2) AS rest FROM (SELECT word, n, unnest(range(length(word))) AS i FROM words)),
near AS (
  SELECT a.word, b.word AS other, b.n AS other_n FROM less a JOIN less b ON a.rest = b.rest AND a.i = b.i AND a.word <> b.word
  UNION SELECT a.word, b.word, b.n FROM less a JOIN words b ON a.rest = b.word
  UNION SELECT b.word, a.word, a.n FROM less a JOIN words b ON a.rest = b.word),
best AS (SELECT word, count(*) AS n_near, arg_min(other, {'n': -other_n, 'w': encode(other)}) AS other, max(other_n) AS other_n FROM near GROUP BY word),
forms AS (
  SELECT w.word, n, coalesce(n_near, 0) AS n_near, CASE WHEN other_n >= 10 * n THEN other END AS form, CASE WHEN other_n >= 10 * n THEN other_n END AS form_n
  FROM words w LEFT JOIN best b ON w.word = b.word),
chains AS (SELECT word, word AS last, 0 AS k FROM forms UNION ALL SELECT c.word, f.form, k + 1 FROM chains c JOIN forms f ON c.last = f.word WHERE f.form IS NOT NULL),
roots AS (SELECT word, arg_max(last, k) AS root FROM chains GROUP BY word)
SELECT f.word, form, root, n, n_near, form_n FROM forms f JOIN roots r ON f.word = r.word
"""
)
