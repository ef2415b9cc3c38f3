"""Benchmark decontamination by template canonicalisation.

Words become lower-case tokens; numbers, names and units become typed slots, so that a question and
the same question with other parameters have the same template. Four kinds of windows are hash-joined:

* TEMPLATE: k template tokens, at least MIN_LITERALS of them literal. Matches on one diagonal (document
  place minus item place) belong together, and their slots must map the item's values consistently.
* VALUES: the other windows of k tokens, of items that have few of the first kind, with their values.
* WHOLE_TEMPLATE: for such items, the whole template after its first token (which is a name or not
  depending on what stands before it), if it has MIN_ANCHORS literals and k - 1 tokens or more.
* WHOLE_TEXT: for such items, and those under k tokens, the whole word sequence as it is.

So every item with a word can be found, whatever its share of slots. Items that have the same template,
with the same slots alike in it, are one for the first and third kind: the first of them stands for all,
and each is looked for word for word as well, so templated questions and templated pages do not make all
pairs.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialise, ship
from . import words as W

#: Units that make a slot after a number.
UNITS = (
    "mm cm m km inch inches foot feet yard yards mile miles mg g kg gram grams kilogram kilograms ton tons oz ounce ounces lb lbs "
    "pound pounds ml l liter liters litre litres gallon gallons s sec second seconds min minute minutes h hour hours day days week "
    "weeks month months year years cent cents dollar dollars euro euros usd eur gbp percent degree degrees mph kmh v volt volts w watt watts"
).split()
NUMBER, NAME, UNIT = (W.mix(np.array([i], np.uint64))[0] for i in (1, 2, 3))
#: Bits of the filter that thins documents' windows before the join; of fixed size.
_FILTER_BITS = 1 << 23
MIN_LITERALS, MIN_ANCHORS = 3, 2
TEMPLATE, VALUES, WHOLE_TEMPLATE, WHOLE_TEXT = range(4)


def _hash_of(words: list[str]) -> np.ndarray:
    return np.sort(np.concatenate([np.zeros(0, np.uint64), *(w.hashes for w in W.split(pa.array(words), lower=True, alnum=True))]))


class Template:
    """Template tokens of some texts: token hashes, slot values (0: literal), and what each token says."""

    units = _hash_of(UNITS)

    def __init__(self, w: W.Words):
        n, doc = len(w.starts), w.doc_of_word()
        value = w.hashes
        digits = np.concatenate([[0], np.cumsum((w.data >= 48) & (w.data <= 57))])
        number = (digits[w.ends] - digits[w.starts]) == (w.ends - w.starts)
        stop = np.concatenate([[0], np.cumsum(np.isin(w.raw, np.frombuffer(b".?!:\n", np.uint8)))])
        begins = np.ones(n, bool)
        begins[1:] = (doc[1:] != doc[:-1]) | (stop[w.starts[1:]] != stop[w.ends[:-1]])
        upper = (w.raw >= 65) & (w.raw <= 90)
        after = np.append(upper, False)[np.minimum(w.starts + 1, len(upper))]
        long = w.ends - w.starts > 1
        name = (upper[w.starts] & ~(after & long) & ~begins) if n else np.zeros(0, bool)
        unit = np.zeros(n, bool)
        if n > 1:
            at = np.searchsorted(self.units, value)
            at[at == len(self.units)] = 0
            unit[1:] = (self.units[at][1:] == value[1:]) & number[:-1] & (doc[1:] == doc[:-1])
            name &= ~unit
        # 3.5 and 1,000 are one number, "Mary Ann" is one name
        joined = np.zeros(n, bool)
        if n > 1:
            gap = w.starts[1:] - w.ends[:-1]
            between = w.raw[np.minimum(w.ends[:-1], len(w.raw) - 1)]
            same = doc[1:] == doc[:-1]
            joined[1:] = same & ((number[1:] & number[:-1] & (gap == 1) & np.isin(between, np.frombuffer(b".,", np.uint8))) | (name[1:] & name[:-1] & (gap == 1) & (between == 32)))
        first = np.flatnonzero(~joined)
        values = np.add.reduceat(value, first) if len(first) else value
        kind = np.where(number, 1, np.where(name, 2, np.where(unit, 3, 0)))[first]
        self.words, self.word_doc = w.hashes, doc
        self.doc, self.docs = doc[first], w.docs
        self.says = values
        self.slot = kind > 0
        self.values = np.where(self.slot, values, np.uint64(0))
        self.tokens = np.where(kind == 1, NUMBER, np.where(kind == 2, NAME, np.where(kind == 3, UNIT, values)))
        self.literals = np.concatenate([[0], np.cumsum(~self.slot)])

    def windows(self, kind: int, n: int) -> tuple[np.ndarray, np.ndarray]:
        """(first token, hash) of the windows of n tokens that lie in one text and suit their kind."""
        of, doc = (self.words, self.word_doc) if kind == WHOLE_TEXT else (self.says, self.doc) if kind == VALUES else (self.tokens, self.doc)
        if not 0 < n <= len(of):
            return np.zeros(0, np.int64), np.zeros(0, np.uint64)
        good = doc[: len(doc) - n + 1] == doc[n - 1 :]
        if kind != WHOLE_TEXT:
            literals = self.literals[n:] - self.literals[:-n]
            good &= literals >= MIN_LITERALS if kind == TEMPLATE else literals < MIN_LITERALS if kind == VALUES else literals >= MIN_ANCHORS
        at = np.flatnonzero(good)
        return at, W.mix(W.rolling(of, n)[at] + np.uint64(n * 4 + kind))

    def slots(self, kind: int, at: int, n: int) -> list[int]:
        v = self.values[at : at + n] if kind in (TEMPLATE, WHOLE_TEMPLATE) else self.values[:0]
        return v[v > 0].view(np.int64).tolist()


_ROW = pa.schema([("row", pa.int64()), ("id", pa.int64()), ("kind", pa.int32()), ("n", pa.int32()), ("place", pa.int64()), ("hash", pa.int64()), ("slots", pa.list_(pa.int64()))])
_ROW_DDL = "row long, id long, kind int, n int, place long, hash long, slots array<long>"
#: Of an item also which of its slots are alike (numbered in order), and whether its windows with literals are enough.
_ITEM = pa.schema([*_ROW, ("labels", pa.list_(pa.int64())), ("plain", pa.bool_())])
_ITEM_DDL = _ROW_DDL + ", labels array<long>, plain boolean"


def _emit(columns: list[list], ids: list, rows: np.ndarray, t: Template, kind: int, n: int, at: np.ndarray, value: np.ndarray) -> None:
    doc = (t.word_doc if kind == WHOLE_TEXT else t.doc)[at]
    start = np.searchsorted(t.word_doc if kind == WHOLE_TEXT else t.doc, doc)
    for column, x in zip(columns, (rows[doc].tolist(), [ids[i] for i in doc.tolist()], [kind] * len(at), [n] * len(at), (at - start).tolist(), value.view(np.int64).tolist(), [t.slots(kind, a, n) for a in at.tolist()]), strict=True):
        column += x


def _item_windows(batches, k: int, coverage: float):
    """All windows of the items; n of whole ones is their length."""
    for batch in batches:
        ids = batch.column(0).to_pylist()
        for w in W.split(batch.column(1), lower=True, alnum=True):
            t, columns = Template(w), [[] for _ in _ROW]
            rows, mine = np.arange(w.docs), ids[w.first : w.first + w.docs]
            length, words = np.bincount(t.doc, minlength=w.docs), np.diff(w.bounds)
            rich = t.windows(TEMPLATE, k)
            found = np.bincount(t.doc[rich[0]], minlength=w.docs)
            plain = (found >= coverage * np.maximum(length - k + 1, 1)) & (length >= k)
            _emit(columns, mine, rows, t, TEMPLATE, k, *rich)
            poor = t.windows(VALUES, k)
            keep = ~plain[t.doc[poor[0]]]
            _emit(columns, mine, rows, t, VALUES, k, poor[0][keep], poor[1][keep])
            first = np.searchsorted(t.doc, np.arange(w.docs))
            for i in np.flatnonzero(words > 0).tolist():
                for kind, n, start in ((WHOLE_TEMPLATE, int(length[i]) - 1, first[i] + 1), (WHOLE_TEXT, int(words[i]), w.bounds[i])):
                    if kind == WHOLE_TEMPLATE and (plain[i] or n < k - 1):
                        continue
                    at, value = t.windows(kind, n)
                    own = at == start
                    _emit(columns, mine, rows, t, kind, n, at[own], value[own])
            number: list[dict[int, int]] = [{} for _ in range(w.docs)]
            order = sorted(range(len(columns[0])), key=lambda j: (columns[2][j], columns[4][j]))
            labels: list = [None] * len(order)
            for j in order:
                seen = number[columns[0][j]]
                labels[j] = [seen.setdefault(v, len(seen)) for v in columns[6][j]]
            columns += [labels, [bool(plain[i]) for i in columns[0]]]
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, _ITEM, strict=True)], schema=_ITEM)


def _covered(places, k: int):
    """How many tokens the windows of k tokens at these places take in."""
    start = F.struct(F.lit(-k).cast("long").alias("last"), F.lit(0).cast("long").alias("n"))
    step = lambda s, p: F.struct(p.alias("last"), (s["n"] + F.least(F.lit(k).cast("long"), p - s["last"])).alias("n"))
    return F.aggregate(F.array_sort(places), start, step, lambda s: s["n"])


def _items(benchmark: DataFrame, k: int, coverage: float, item_id: str, item_text: str) -> tuple[DataFrame, DataFrame]:
    """(windows of the items, by item; item: item, item_id, team, members). An item is an id with a text."""
    named = benchmark.select(F.col(item_id).cast("long").alias("item_id"), F.col(item_text).cast("string").alias("text")).distinct()
    named = named.withColumn("item", F.xxhash64("item_id", "text"))
    rows = materialise(named.select("item", "text").mapInArrow(lambda batches: _item_windows(batches, k, coverage), _ITEM_DDL).drop("row").withColumnRenamed("id", "item"), "windows")
    # a team: items with the same windows, that differ in slots but not in which of them are alike
    alike = F.xxhash64(F.array_sort(F.collect_list(F.struct("kind", "n", "place", "hash", "labels"))))
    team = rows.where(F.when(F.col("plain"), F.col("kind") == TEMPLATE).otherwise(F.col("kind") == WHOLE_TEMPLATE)).groupBy("item").agg(alike.alias("team"))
    head = F.struct(F.col("item_id").isNull(), "item_id", "item")
    size = team.join(named, "item").groupBy("team").agg(F.count("*").alias("members"), F.min_by("item", head).alias("first"))
    known = materialise(named.select("item", "item_id").join(team, "item", "left").join(size, "team", "left"), "items")
    rows = rows.join(known.select("item", "members", (F.col("item") == F.col("first")).alias("leads")), "item")
    alone = F.coalesce(F.col("members") == 1, F.lit(True))
    # only the first of a team is looked for by template; an item that is alone needs its words only where templates say too little
    keep = F.when(F.col("kind") == WHOLE_TEXT, ~F.col("plain") | ~alone).when((F.col("kind") == WHOLE_TEMPLATE) | F.col("plain"), alone | F.col("leads")).otherwise(True)
    return rows.where(keep).select("item", "kind", "n", "place", "hash", "slots"), known.select("item", "item_id", F.coalesce("team", "item").alias("team"), F.coalesce("members", F.lit(1)).alias("members"), F.coalesce("first", "item").alias("first"))


def template_teams(benchmark: DataFrame, *, k: int = 5, coverage: float = 0.5, item_id: str = "item_id", item_text: str = "text") -> DataFrame:
    """item_id, representative: the item that find_leaks() names when a document holds their template with values that are no item's."""
    ship(benchmark.sparkSession)
    _, known = _items(benchmark, k, coverage, item_id, item_text)
    first = known.select(F.col("item").alias("first"), F.col("item_id").alias("representative"))
    return known.join(first, "first").select("item_id", "representative")


def find_leaks(df: DataFrame, benchmark: DataFrame, *, k: int = 5, coverage: float = 0.5, token_coverage: float = 0.8, consistency: float = 0.8, doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id", item_text: str = "text") -> DataFrame:
    """doc_id, item_id, windows, item_windows, coverage, consistent, exact, template_items: one row for each document and leaked item.

    An item leaks if at least coverage of its windows of k tokens are in the document, or windows that take
    in at least token_coverage of the tokens that all its windows do (so that words put in here and there
    do not hide it), and at least consistency of its slot values map to one value each along a diagonal.
    exact: all slot values are the item's own. Its windows are those with MIN_LITERALS literals; if these
    are under coverage of all, all windows count (the others match with equal values only), and the item
    also leaks if it occurs whole: word for word, or, with MIN_ANCHORS literals after its first token,
    with other values that map consistently. Items under k tokens, of one word even, leak word for word.

    Items of one template (template_items of them, see template_teams()) give a row for each of them that
    the document holds word for word, and else one row, for the first of them by id.

    Null or empty texts, of documents or items, have no windows; long ones are read whole. A row's windows
    are its own; of rows that share a doc_id, or have none (null), the best is given, once for each item.
    An item without an id is found and given as null; of different texts under one item_id each is looked
    for, and the best is given. Ties and repeated items give equal rows once. Empty tables give no rows;
    other columns are ignored. The benchmark may be of any size: documents' windows are thinned by a filter
    of fixed size and joined by hash, first with each item's rarest windows, of which a leak has one at least.
    """
    spark = df.sparkSession
    ship(spark)
    items, known = _items(benchmark, k, coverage, item_id, item_text)
    small = F.col("kind") <= VALUES
    size = items.groupBy("item").agg(F.count_distinct(F.when(small, F.col("place"))).alias("item_windows"), _covered(F.collect_set(F.when(small, F.col("place"))), k).alias("item_tokens"))
    often = items.groupBy("kind", "hash").agg(F.count_distinct("item").alias("items"))
    rare = F.row_number().over(Window.partitionBy("item", F.col("kind") >= WHOLE_TEMPLATE).orderBy("items", "hash", "place"))
    items = items.join(size, "item").join(often, ["kind", "hash"]).withColumn("nth", rare)
    # the fewest windows that a leak has
    fewest = F.least(F.ceil(F.col("item_windows") * coverage), F.ceil(F.col("item_tokens") * token_coverage / k))
    seed = (F.col("kind") >= WHOLE_TEMPLATE) | (F.col("nth") <= F.col("item_windows") - fewest + 1)
    items = materialise(items.select("item", "kind", "n", "place", "hash", "slots", F.greatest("item_windows", F.lit(1)).alias("item_windows"), F.greatest("item_tokens", F.lit(1)).alias("item_tokens"), seed.alias("seed")), "items")

    # one word for each 64 bits of the filter at most, whatever the benchmark's size
    slot = F.col("hash").bitwiseAND(F.lit(_FILTER_BITS - 1))
    bits = items.groupBy(F.shiftright(slot, 6).alias("word")).agg(F.bit_or(F.expr(f"shiftleft(1L, CAST(hash & {_FILTER_BITS - 1} & 63 AS INT))")).alias("bits")).toArrow()
    packed = np.zeros(_FILTER_BITS // 64, np.int64)
    packed[bits["word"].to_numpy()] = bits["bits"].to_numpy()
    used = sorted((r.kind, r.n) for r in items.select("kind", "n").distinct().collect())
    wanted = spark.sparkContext.broadcast(packed)

    def of_docs(batches):
        allowed = np.unpackbits(wanted.value.view(np.uint8), bitorder="little").astype(bool)
        row = (TaskContext.get().partitionId() if TaskContext.get() else 0) << 40
        for batch in batches:
            ids = batch.column(0).to_pylist()
            for w in W.split(batch.column(1), lower=True, alnum=True):
                t, columns = Template(w), [[] for _ in _ROW]
                for kind, n in used:
                    at, value = t.windows(kind, n)
                    hit = allowed[(value & np.uint64(_FILTER_BITS - 1)).astype(np.int64)]
                    _emit(columns, ids[w.first : w.first + w.docs], np.arange(row + w.first, row + w.first + w.docs), t, kind, n, at[hit], value[hit])
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, _ROW, strict=True)], schema=_ROW)
            row += batch.num_rows

    found = df.select(F.col(doc_id).cast("long"), F.col(text)).mapInArrow(of_docs, _ROW_DDL)
    found = materialise(found.select("row", F.col("id").alias("doc_id"), "kind", "hash", F.col("place").alias("at"), F.col("slots").alias("values")), "found")
    pairs = found.join(items.where("seed").select("kind", "hash", "item"), ["kind", "hash"]).select("row", "item").distinct()
    hits = found.join(pairs, "row").join(items, ["item", "kind", "hash"]).where(F.size("slots") == F.size("values"))
    whole = F.col("kind") >= WHOLE_TEMPLATE
    both = F.arrays_zip(F.col("slots").alias("own"), F.col("values").alias("other"))
    by_diagonal = hits.groupBy("row", "doc_id", "item", "item_windows", "item_tokens", F.when(whole, F.col("kind")).otherwise(-1).alias("whole"), (F.col("at") - F.col("place")).alias("diagonal"))
    as_is = F.collect_set(F.when(F.col("slots") == F.col("values"), F.col("place"))).alias("as_is")
    by_diagonal = by_diagonal.agg(F.collect_set("place").alias("places"), as_is, F.array_distinct(F.flatten(F.collect_set(both))).alias("pairs"))
    own = F.expr("size(array_distinct(transform(pairs, x -> x.own)))")
    single = F.expr("size(filter(array_distinct(transform(pairs, x -> x.own)), v -> size(filter(pairs, y -> y.own = v)) = 1))")
    by_diagonal = by_diagonal.withColumn("own", own).withColumn("single", single)
    # whole matches stand for themselves; the others add up over an item's diagonals
    alone = F.when(F.col("whole") > 0, F.col("diagonal"))
    leaks = by_diagonal.groupBy("row", "doc_id", "item", "item_windows", "item_tokens", "whole", alone.alias("alone")).agg(F.array_distinct(F.flatten(F.collect_list("places"))).alias("places"), F.flatten(F.collect_list("as_is")).alias("as_is"), F.sum("own").alias("own"), F.sum("single").alias("single"))
    leaks = leaks.withColumn("exact", F.size(F.array_except("places", "as_is")) == 0)
    full = F.col("whole") > 0
    leaks = leaks.withColumn("windows", F.when(full, F.col("item_windows")).otherwise(F.size("places")).cast("long")).withColumn("coverage", F.col("windows") / F.col("item_windows"))
    enough = full | (F.col("coverage") >= coverage) | (_covered(F.col("places"), k) >= token_coverage * F.col("item_tokens"))
    leaks = leaks.where(enough & (F.col("single") >= consistency * F.col("own"))).join(known, "item")
    # of one template, the items that a document holds as they are; else the first
    leaks = leaks.groupBy("row", "doc_id", "team").agg(F.max("exact").alias("as_is"), F.collect_set(F.struct("item_id", "members", "coverage", "exact", "windows", "item_windows")).alias("found"))
    leaks = leaks.select("doc_id", F.explode(F.filter("found", lambda x: x["exact"] | ~F.col("as_is"))).alias("x")).select("doc_id", "x.*")
    best = leaks.groupBy("doc_id", "item_id").agg(F.max(F.struct("coverage", "exact", "windows", "item_windows", "members")).alias("best"))
    return best.select("doc_id", "item_id", "best.windows", "best.item_windows", "best.coverage", F.lit(True).alias("consistent"), "best.exact", F.col("best.members").alias("template_items"))
