"""LM scoring: a hashed maximum-entropy model with a class-factored softmax.

P(word | history) = P(class | history) * P(word | class, history). A word's class is a function of its
spelling (its last two bytes, hashed), so every word has one and none needs a list.

* The class softmax sums the weights of four hashed features of the history: the last word, the last
  two, and the words two and three back (skip features). It is trained in rounds: the corpus is dealt
  into blocks by content, each round sums the gradient of one block over all tasks and makes one step.
* Within a class a word has its count's weight, times exp(weight) for the n-gram feature (hashed last
  word, word), for all such pairs that occur CUTOFF times or more. Pairs and counts are gathered from the
  whole corpus and stay in shards; rounds of updates alternate between the pairs' weights (in shards)
  and the normalisers of each (hashed last word, class), which are small.

Gradients are sums of whole numbers, so the model is the same however the rows are partitioned. All
tables grow with the corpus: shards in proportion, hashed histories with its cube root, class features
with its square root up to 2**16. The most frequent pairs, a bounded list, are scored where the texts
are; all other tokens meet their pair's weight in its shard.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import pairwise

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import input_bytes, materialise, ship
from . import sums
from . import words as W
from .sums import SENT, message, part, sum_arrays

CLASSES, FEATURES, END = 32, 4, 31
#: A class feature's step in a round is RATE * its mean gradient, held back by RESERVE tokens.
RATE, RESERVE, BLOCKS = 4.0, 20.0, 4
#: Gradients are counted in parts of 1 / GRAIN; MOST tokens' sums stay below 2**31, so that half an int64 holds them. STEP tokens' scores fit a cache.
GRAIN, MOST, MINIBATCH, STEP = 512, (1 << 22) - 1, 1 << 15, 1 << 10
#: Texts are split in pieces whose arrays of eight bytes a character stay in a cache, and below the size that give_memory_back() maps anew each time.
PIECE = (1 << 15) - 64
#: Pairs that occur less often are no features; PRIOR is the inverse variance of a pair's weight.
CUTOFF, PRIOR, ROUNDS = 2, 0.3, 4
HEAD_PAIRS, FLUSH, SHARD_BYTES, BATCH_BYTES = 1 << 16, 1 << 21, 32 << 20, 4 << 20
#: Bits by which the commonest pairs are looked up: four times as many prefixes as pairs.
PREFIX = 18


@dataclass(frozen=True)
class Sizes:
    """What the corpus' training bytes decide, whatever its partitions."""

    class_bits: int
    history_bits: int
    shards: int
    flushes: int

    @staticmethod
    def of(size: int, least: int) -> Sizes:
        log = float(np.log2(max(2, size / 6)))
        return Sizes(int(np.clip(log // 2 - 1, 6, 16)), int(np.clip(round(log / 3), 2, 15)), max(least, -(-size // SHARD_BYTES)), -(-size // (6 * FLUSH)))


@dataclass
class Tokens:
    """Words and ends of a chunk's documents in order."""

    doc: np.ndarray
    value: np.ndarray  # word hashes with their class in the lowest five bits; END for an end
    features: np.ndarray  # (FEATURES, tokens)
    history: np.ndarray  # the last word, hashed

    @property
    def target(self) -> np.ndarray:
        return (self.value & np.uint64(31)).astype(np.int64)


#: The class of a word, by its last byte and 256 times the one before.
_CLASS = (W.mix(np.arange(1 << 16)) % np.uint64(END)).astype(np.uint8)


def word_values(w: W.Words) -> np.ndarray:
    if not len(w.ends):
        return np.zeros(0, np.uint64)
    before = np.where(w.ends - w.starts > 1, w.data[w.ends - 2], 0).astype(np.int64)
    return (w.hashes & ~np.uint64(31)) | _CLASS[w.data[w.ends - 1] + before * 256]


def tokens(w: W.Words, sizes: Sizes, featured: bool = True) -> Tokens:
    """A chunk's tokens; their features of the class softmax only where asked for."""
    n = len(w.hashes) + w.docs
    at_end = w.bounds[1:] + np.arange(w.docs)
    start = w.bounds[:-1] + np.arange(w.docs)
    value = np.full(n, END, np.uint64)
    words = np.ones(n, bool)
    words[at_end] = False
    value[words] = word_values(w)
    doc = np.repeat(np.arange(w.docs), np.diff(w.bounds) + 1)

    def shifted(x: np.ndarray, k: int, marked: int, mark: np.uint64) -> np.ndarray:
        """x of the token k places before; mark for a text's first tokens, of which as many are marked."""
        out = np.empty(n, np.uint64)
        out[k:] = x[: max(0, n - k)]
        for j in range(marked):
            out[(start + j)[start + j <= at_end]] = mark
        return out

    # what stands before a text's first word is marked by its distance
    back = [shifted(value, k, k, np.uint64(k)) for k in ((1, 2, 3) if featured else (1,))]
    last = W.mix(back[0])
    history = (last >> np.uint64(64 - sizes.history_bits)).astype(np.uint16)
    features = np.empty((FEATURES, n if featured else 0), np.uint16)
    if featured:
        shift = np.uint64(64 - sizes.class_bits)
        two = shifted(last, 1, 2, W.mix(np.full(1, 2))[0])  # mix(back[1])
        for k, x in enumerate((last, W.mix(back[0] * np.uint64(3) + two), W.mix(back[1] + np.uint64(11)), W.mix(back[2] + np.uint64(13)))):
            features[k] = x >> shift
    return Tokens(doc, value, features, history)


def _log_softmax(x: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Each row's log probability of its target; x is used up.

    A weight moves by less than RATE in each of BLOCKS rounds, so a score is less than
    FEATURES * BLOCKS * RATE = 64 from the prior's, and no sum of exp over- or underflows.
    """
    own = x[np.arange(len(x)), target].astype(float)
    return own - np.log(np.einsum("ij->i", np.exp(x, out=x)).astype(float))


def _scores(weights: np.ndarray, prior: np.ndarray, features: np.ndarray, room: np.ndarray | None = None) -> np.ndarray:
    """Each token's score of every class, in room[0] if there is room (for 2 * STEP tokens)."""
    n = features.shape[1]
    total, more = (np.empty((2, n, CLASSES), np.float32) if room is None else room)[:, :n]
    # features are below the tables' lengths; "clip" only spares a copy
    weights[0].take(features[0], axis=0, out=total, mode="clip")
    for k in range(1, FEATURES):
        total += weights[k].take(features[k], axis=0, out=more, mode="clip")
    total += prior
    return total


class Gradient:
    """The class softmax's gradient, in parts of 1/GRAIN, and each feature's tokens."""

    def __init__(self, class_bits: int) -> None:
        self.slots = 1 << class_bits
        #: Of each feature: its tokens of each class, and the sums of their probabilities. An int64 holds two classes' sums, so half as many are added up.
        self.tokens = np.zeros((FEATURES, self.slots * CLASSES), np.int32)
        self.sums = np.zeros((FEATURES, CLASSES // 2, self.slots), np.int64)
        self.waiting = 0
        self.total: np.ndarray | None = None
        self.room = np.empty((2, STEP, CLASSES), np.float32)

    def add(self, weights: np.ndarray, prior: np.ndarray, features: np.ndarray, target: np.ndarray) -> None:
        size = min(MINIBATCH, MOST)
        for i in range(0, len(target), size):
            own = target[i : i + size]
            if self.waiting + len(own) > MOST:
                self._settle()
            self.waiting += len(own)
            self._add(weights, prior, features[:, i : i + size], own)

    def _add(self, weights: np.ndarray, prior: np.ndarray, features: np.ndarray, target: np.ndarray) -> None:
        n = len(target)
        shares = np.empty((CLASSES // 2, n), np.int64)
        for i in range(0, n, STEP):
            x = _scores(weights, prior, features[:, i : i + STEP], self.room)
            np.exp(x, out=x)
            x *= (GRAIN / np.einsum("ij->i", x))[:, None]
            np.rint(x, out=x)
            shares[:, i : i + STEP] = x.astype("<i4").view("<i8").T
        one = np.ones(n, np.int32)
        for k in range(FEATURES):
            f = features[k].astype(np.int64)
            np.add.at(self.tokens[k], f * CLASSES + target, one)
            for pair in range(CLASSES // 2):
                np.add.at(self.sums[k, pair], f, shares[pair])

    def _feature(self, k: int) -> np.ndarray:
        """What waits of a feature: (slots, CLASSES + 1), the last column for its tokens."""
        out = np.empty((self.slots, CLASSES + 1))
        tokens = self.tokens[k].reshape(self.slots, CLASSES)
        out[:, 0:CLASSES:2] = (self.sums[k] & 0xFFFFFFFF).T
        out[:, 1:CLASSES:2] = (self.sums[k] >> 32).T
        np.subtract(tokens * float(GRAIN), out[:, :CLASSES], out=out[:, :CLASSES])
        out[:, CLASSES] = tokens.sum(axis=1)
        return out

    def _settle(self) -> None:
        if self.total is None:
            self.total = np.zeros((FEATURES, self.slots, CLASSES + 1))
        for k in range(FEATURES):
            self.total[k] += self._feature(k)
        self.tokens[:], self.sums[:], self.waiting = 0, 0, 0

    def blocks(self) -> dict[str, np.ndarray]:
        """Each feature's sums by its number; features without tokens are left out."""
        out = {str(k): self._feature(k) + (0 if self.total is None else self.total[k]) for k in range(FEATURES)}
        return {k: x for k, x in out.items() if x.any()}


def _planes(x: np.ndarray) -> bytes:
    """An array byte plane by byte plane, which compresses well where values are small or sorted."""
    return np.ascontiguousarray(np.ascontiguousarray(x).view(np.uint8).reshape(len(x), x.itemsize).T).tobytes()


def _unplanes(body: bytes, kind: str) -> np.ndarray:
    size = np.dtype(kind).itemsize
    return np.ascontiguousarray(np.frombuffer(body, np.uint8).reshape(size, -1).T).view(kind).ravel()


def _read(batches: Iterator[pa.RecordBatch], column: int = 1):
    for batch in batches:
        for w in W.split(batch.column(column), lower=True, limit=PIECE):
            yield batch, w


# ---- pairs (hashed last word, word) and counts ----

_TABLE = "shard int, words binary, counts binary, sizes binary, histories binary, times binary"


def _firsts(sorted_values: np.ndarray) -> np.ndarray:
    """Where each different value starts."""
    new = np.ones(len(sorted_values), bool)
    new[1:] = sorted_values[1:] != sorted_values[:-1]
    return np.flatnonzero(new)


def _order(value: np.ndarray) -> np.ndarray:
    """The places of hashes in ascending order, equal ones as they came: a stable argsort, by sorting the first bits with the places."""
    if not len(value):
        return np.zeros(0, np.int64)
    low = np.uint64((1 << len(value).bit_length()) - 1)
    # a shard's hashes begin alike: what they share is taken off
    least = value.min()
    first = (value - least) << np.uint64(64 - max(1, int(value.max() - least).bit_length()))
    order = (np.sort((first & ~low) | np.arange(len(value), dtype=np.uint64)) & low).astype(np.int64)
    got = value[order]
    if (got[1:] < got[:-1]).any():  # some differ in their last bits only
        return np.argsort(value, kind="stable")
    return order


def _distinct(value: np.ndarray, history: np.ndarray, times: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sorted distinct pairs and how often each occurs (times: of each given pair; else once)."""
    order = _order(value)
    value, history = value[order], history[order]
    first = _firsts(value)
    known, place = value[first], np.repeat(np.arange(len(first), dtype=np.uint64), np.diff(np.append(first, len(value))))
    # a pair as one number: the word's place, then the history's 16 bits
    key = (place << np.uint64(16)) | history.astype(np.uint64)
    if times is None:
        key.sort()
        first = _firsts(key)
        key, total = key[first], np.diff(np.append(first, len(key)))
    else:
        again = np.argsort(key)
        first = _firsts(key[again])
        key, total = key[again][first], np.add.reduceat(times[order][again], first) if len(first) else times
    return known[key >> np.uint64(16)], (key & np.uint64(0xFFFF)).astype(np.uint16), total


def _pack_pairs(shards: np.ndarray, value: np.ndarray, history: np.ndarray, times: np.ndarray, counts: np.ndarray | None = None, keep: np.ndarray | None = None) -> list[list]:
    """Rows (shard, words, counts, sizes, histories, times) of sorted pairs, one for each shard in shards."""
    edge = np.append(np.searchsorted(shards, np.unique(shards)), len(shards))
    rows = []
    for a, b in pairwise(edge.tolist()):
        first = _firsts(value[a:b])
        word = value[a:b][first]
        own = keep[a:b] if keep is not None else np.ones(b - a, bool)
        size = np.add.reduceat(own.astype(np.int64), first)
        total = np.add.reduceat(times[a:b], first)
        rows.append([int(shards[a]), _planes(word), _planes(total.astype(np.int64)), _planes(size.astype(np.uint32)), _planes(history[a:b][own]), _planes(times[a:b][own].astype(np.int64))])
    return rows


def _unpack_pairs(words: bytes, counts: bytes, sizes: bytes, histories: bytes, times: bytes):
    """(words, counts, places of the pairs' words, histories, times)."""
    word = _unplanes(words, "<u8")
    return word, _unplanes(counts, "<i8"), np.repeat(np.arange(len(word)), _unplanes(sizes, "<u4")), _unplanes(histories, "<u2"), _unplanes(times, "<i8")


def _shard_of(value: np.ndarray, shards: int) -> np.ndarray:
    return (((value >> np.uint64(32)) * np.uint64(shards)) >> np.uint64(32)).astype(np.int64)


def gather_pairs(taught: DataFrame, sizes: Sizes) -> DataFrame:
    """One row for each shard: its words with their counts, and the pairs that occur CUTOFF times or more."""

    flush_at = FLUSH

    def table(rows: list[list], lane: int | None) -> pa.RecordBatch | pa.Table:
        columns = list(zip(*rows, strict=True)) if rows else [[] for _ in range(6)]
        arrays = [pa.array(columns[0], pa.int32()), *(pa.array(c, pa.binary()) for c in columns[1:])]
        if lane is not None:
            arrays.append(pa.array([lane] * len(rows), pa.int32()))
        return pa.table(arrays, names=["shard", "words", "counts", "sizes", "histories", "times", "lane"][: len(arrays)])

    def send(batches):
        held, waiting, flush = [], 0, 0

        def out():
            value, history = (np.concatenate(x) for x in zip(*held, strict=True))
            value, history, times = _distinct(value, history)
            return table(_pack_pairs(_shard_of(value, sizes.shards), value, history, times), (part() * 31 + flush) % (1 << 30)).to_batches()

        for _, w in _read(batches):
            t = tokens(w, sizes, featured=False)
            words = t.value != END
            held.append((t.value[words], t.history[words]))
            waiting += len(t.value)
            if waiting >= flush_at:
                yield from out()
                held, waiting, flush = [], 0, flush + 1
        if waiting:
            yield from out()

    def merge(final: bool):
        def add(rows: pa.Table) -> pa.Table:
            parts = [_unpack_pairs(*x) for x in zip(*(rows[c].to_pylist() for c in ("words", "counts", "sizes", "histories", "times")), strict=True)]
            value, history, times = _distinct(np.concatenate([p[0][p[2]] for p in parts]), np.concatenate([p[3] for p in parts]), np.concatenate([p[4] for p in parts]))
            if not len(value):
                return table([], None if final else 0)
            shards = np.full(len(value), rows["shard"][0].as_py())
            return table(_pack_pairs(shards, value, history, times, keep=times >= CUTOFF if final else None), None if final else 0)

        return add

    sent = taught.mapInArrow(send, _TABLE + ", lane int")
    # a frequent word is sent by every task with all its histories; they are merged in levels
    lanes = -(-sizes.flushes // sums.FAN_IN)
    if lanes > 1:
        sent = sent.withColumn("lane", F.pmod("lane", F.lit(lanes))).groupBy("shard", "lane").applyInArrow(merge(False), _TABLE + ", lane int")
    return materialise(sent.groupBy("shard").applyInArrow(merge(True), _TABLE), "pairs")


def _each(batches):
    """(words, counts, places, histories, times) of each shard's row."""
    for batch in batches:
        for row in zip(*(batch.column(i).to_pylist() for i in range(1, 6)), strict=True):
            yield _unpack_pairs(*row)


def count_words(pairs: DataFrame) -> np.ndarray:
    """For each class its words' tokens and how many different words it has."""

    def count(batches):
        total = np.zeros((2, CLASSES), np.int64)
        for word, counts, *_ in _each(batches):
            own = (word & np.uint64(31)).astype(np.int64)
            np.add.at(total[0], own, counts)
            np.add.at(total[1], own, 1)
        yield pa.RecordBatch.from_arrays([pa.array(np.tile(np.arange(CLASSES), 2), pa.int32()), pa.array(np.repeat([0, 1], CLASSES), pa.int32()), pa.array(total.ravel())], ["class", "kind", "n"])

    out = np.zeros((2, CLASSES), np.int64)
    for r in pairs.mapInArrow(count, "class int, kind int, n long").groupBy("class", "kind").agg(F.sum("n").alias("n")).collect():
        out[r.kind, r["class"]] = r.n
    return out


def pair_weights(n: np.ndarray, mass: np.ndarray) -> np.ndarray:
    """Weights x at which n - mass * exp(x) - PRIOR * x is 0: the gradient of pairs seen n times, which
    have the probability mass at weight 0. Newton's steps come down from above, so all converge."""
    with np.errstate(divide="ignore"):
        x = np.minimum(n / PRIOR, np.maximum(0, np.log(n / mass)))
    for _ in range(8):
        e = mass * np.exp(x)
        x = x + (n - e - PRIOR * x) / (e + PRIOR)
    return x


@dataclass
class Model:
    sizes: Sizes
    prior: np.ndarray  # the classes' log shares
    weights: np.ndarray  # (FEATURES, 2**class_bits, CLASSES)
    seen: np.ndarray  # training tokens of each (history, class)
    start: np.ndarray  # each class's words' weights, unknown words together having that of one word seen once less
    before: np.ndarray  # the normalisers that the pairs' weights were fitted to
    norm: np.ndarray  # and those they give
    ends: int
    total: int  # training tokens
    types: int
    head: dict[str, np.ndarray] | None = None

    def pair_values(self, word: np.ndarray, count: np.ndarray, history: np.ndarray, times: np.ndarray) -> np.ndarray:
        """Log weights, within their class, of pairs that are features."""
        own = (word & np.uint64(31)).astype(np.int64)
        mass = self.seen[history, own] * (count + 1) / self.before[history, own]
        return np.log(count + 1.0) + pair_weights(times.astype(float), mass)


def _class_rounds(taught: DataFrame, sizes: Sizes, prior: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The class softmax's weights, and the training tokens of each (history, class)."""
    spark = taught.sparkSession
    shape = (FEATURES, 1 << sizes.class_bits, CLASSES + 1)
    weights = np.zeros((*shape[:2], CLASSES), np.float32)
    seen = np.zeros((1 << sizes.history_bits) * CLASSES, np.int64)
    # a task reads many times what it sends
    tasks = max(spark.sparkContext.defaultParallelism, input_bytes(taught) * BLOCKS // (16 * int(np.prod(shape)) * 4))
    block = F.pmod(F.xxhash64("doc_id", "text"), F.lit(BLOCKS))
    for nth in range(BLOCKS):
        shared = spark.sparkContext.broadcast(weights)

        def learn(batches, shared=shared):
            start, total, count = shared.value, Gradient(sizes.class_bits), np.zeros(len(seen), np.int64)
            for _, w in _read(batches):
                t = tokens(w, sizes)
                target = t.target
                np.add.at(count, t.history.astype(np.int64) * CLASSES + target, np.ones(len(target), np.int64))
                total.add(start, prior, t.features, target)
            yield message({"seen": count.astype(float)} | total.blocks())

        got = sum_arrays(taught.where(block == nth).coalesce(tasks).mapInArrow(learn, SENT), tasks, "<f8")
        if "seen" in got:
            seen = seen + got["seen"].astype(np.int64)
        for k in range(FEATURES):
            if str(k) in got:
                step = got[str(k)].reshape(shape[1:])
                weights[k] += (RATE / GRAIN * step[:, :CLASSES] / (RESERVE + step[:, CLASSES:])).astype(np.float32)
        shared.unpersist()
    return weights, seen.reshape(-1, CLASSES)


def _normalise(pairs: DataFrame, model: Model) -> None:
    """Rounds of updates: pairs' weights for the present normalisers, then the normalisers they give."""
    spark = pairs.sparkSession
    for _ in range(ROUNDS):
        model.before = model.norm
        shared = spark.sparkContext.broadcast(model)

        def add(batches, shared=shared):
            m = shared.value
            total = np.zeros(m.norm.shape)
            for word, counts, at, history, times in _each(batches):
                value, count = word[at], counts[at]
                np.add.at(total, (history, (value & np.uint64(31)).astype(np.int64)), np.exp(m.pair_values(value, count, history, times)) - (count + 1.0))
            yield message({"z": total})

        tasks = max(1, -(-input_bytes(pairs) // (8 << 20)))
        got = sum_arrays(pairs.mapInArrow(add, SENT), tasks, "<f8")
        more = got["z"].reshape(model.norm.shape) if "z" in got else 0.0
        model.norm = model.start[None, :] + more
        shared.unpersist()


def _head(pairs: DataFrame, model: Model) -> dict[str, np.ndarray]:
    """The HEAD_PAIRS commonest pairs, sorted, with their words' counts."""
    most = HEAD_PAIRS

    def best(batches):
        held: list[tuple] = []

        def cut() -> tuple:
            word, history, count, times = (np.concatenate(x) for x in zip(*held, strict=True))
            top = np.lexsort((history, word, -times))[:most]
            return word[top], history[top], count[top], times[top]

        for word, counts, at, history, times in _each(batches):
            held.append((word[at], history, counts[at], times))
            held = [cut()]
        for word, history, count, times in held:
            yield pa.RecordBatch.from_arrays([pa.array(word.view(np.int64)), pa.array(history.astype(np.int32)), pa.array(count), pa.array(times)], ["word", "history", "count", "times"])

    rows = pairs.mapInArrow(best, "word long, history int, count long, times long").orderBy(F.desc("times"), "word", "history").limit(most).toArrow()
    word, history, count, times = (rows[c].to_numpy() for c in ("word", "history", "count", "times"))
    word, history = word.view(np.uint64), history.astype(np.uint16)
    key = _pair_key(word, history)
    order = np.argsort(key)
    value = model.pair_values(word, count, history, times)
    return {"key": key[order], "word": word[order], "history": history[order], "count": count[order], "value": value[order]}


def _pair_key(word: np.ndarray, history: np.ndarray) -> np.ndarray:
    return W.mix(word + W.mix(history.astype(np.uint64) + np.uint64(1)))


def _held(doc_id: Column, folds: int, held: int) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string")) % folds == held, F.lit(False))


def train(taught: DataFrame) -> tuple[Model, DataFrame]:
    """The model of all rows (doc_id, text), and its shards of words and pairs."""
    spark = taught.sparkSession
    size, ends = taught.agg(F.sum(F.octet_length("text")), F.count("*")).first()
    sizes = Sizes.of(size or 0, int(spark.conf.get("spark.sql.shuffle.partitions")))
    pairs = gather_pairs(taught, sizes)
    counts, types = count_words(pairs)
    share = counts + 0.0
    share[END] = ends
    prior = np.log((share + 1) / (share + 1).sum()).astype(np.float32)
    weights, seen = _class_rounds(taught, sizes, prior)
    start = counts + types + 1.0
    norm = np.repeat(start[None, :], 1 << sizes.history_bits, axis=0)
    model = Model(sizes, prior, weights, seen, start, norm, norm, ends, int(counts.sum()) + ends, int(types.sum()) + (ends > 0))
    _normalise(pairs, model)
    model.head = _head(pairs, model)
    return model, pairs


# ---- scoring ----

_SENT = "shard int, batch long, kind int, body binary, words binary, sizes binary, histories binary, docs binary"
_ANSWER = "batch long, kind int, shard int, body binary, base binary, known binary, value binary"


def _batches_of(chunks, limit: int):
    """Lists of chunks of about limit bytes."""
    held, size = [], 0
    for chunk in chunks:
        held.append(chunk)
        size += len(chunk[1].data) + 64 * chunk[1].docs
        if size >= limit:
            yield held
            held, size = [], 0
    if held:
        yield held


def _find(among: np.ndarray, value: np.ndarray, first: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """(place, whether it is there) of values among sorted ones; first: _first_places() of those."""
    if not len(among):
        return np.zeros(len(value), np.int64), np.zeros(len(value), bool)
    if first is None:
        at = np.searchsorted(among, value)
        at[at == len(among)] = 0
        return at, among[at] == value
    at = first[value >> np.uint64(64 - PREFIX)]
    low = np.flatnonzero(among[at] < value)
    while len(low):
        low = low[at[low] < len(among) - 1]
        at[low] += 1
        low = low[among[at[low]] < value[low]]
    return at, among[at] == value


def _first_places(among: np.ndarray) -> np.ndarray:
    """For each value of the first PREFIX bits, the place of the first of the sorted values that is no less (the last place, if none is)."""
    starts = np.arange(1 << PREFIX, dtype=np.uint64) << np.uint64(64 - PREFIX)
    return np.minimum(np.searchsorted(among, starts), max(0, len(among) - 1)).astype(np.int32)


def score_texts(df: DataFrame, *, folds: int = 7, held: int = 2, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score of every row of df.

    Tokens are a text's words (runs without white space, A-Z lower-cased) and one end. The model
    learns from rows whose crc32(doc_id as text) mod folds is not held. base_score is the add-one
    unigram log10 probability, score the model's; both sum over the tokens.

    Null and empty texts have one token, the end; long ones are scored whole. Rows without an id are
    trained on. Rows that repeat count as often as they occur and get equal scores, as do ties of any
    kind. With no training rows all words are unknown. Empty tables give no rows; other columns are
    ignored. Scores do not depend on how the rows are partitioned.
    """
    spark = df.sparkSession
    ship(spark)
    docs = df.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    out_of = _held(F.col("doc_id"), folds, held)
    model, pairs = train(docs.where(~out_of))
    shared, sizes = spark.sparkContext.broadcast(model), model.sizes
    log10, batch_bytes = float(np.log(10)), BATCH_BYTES

    def send(batches):
        m = shared.value
        norm = np.log(m.norm)
        norm[:, END] = 0
        norm = norm.ravel()
        head, first_places = m.head, _first_places(m.head["key"])
        head_base = np.log10(head["count"] + 1.0)
        room = np.empty((2, STEP, CLASSES), np.float32)
        nth = 0
        for group in _batches_of(_read(batches), batch_bytes):
            rows, tail, first = [], [], 0
            for batch, w in group:
                t = tokens(w, sizes)
                target, word = t.target, t.value != END
                lm = np.empty(len(target))
                for i in range(0, len(target), STEP):
                    lm[i : i + STEP] = _log_softmax(_scores(m.weights, m.prior, t.features[:, i : i + STEP], room), target[i : i + STEP])
                lm -= norm[t.history.astype(np.int64) * CLASSES + target]
                base = np.where(word, 0.0, np.log10(m.ends + 1))
                at, here = _find(head["key"], _pair_key(t.value, t.history), first_places)
                hit = np.flatnonzero(here & word)
                at = at[hit]
                same = (head["word"][at] == t.value[hit]) & (head["history"][at] == t.history[hit])
                hit, at = hit[same], at[same]
                lm[hit] += head["value"][at]
                base[hit] += head_base[at]
                away, known = word.copy(), ~word & (m.ends > 0)
                away[hit], known[hit] = False, True
                away = np.flatnonzero(away)
                per_doc = [np.bincount(t.doc, x, w.docs) for x in (np.ones(len(lm)), known, base, lm)]
                rows.append(pa.RecordBatch.from_arrays([*(batch.column(c).slice(w.first, w.docs) for c in (0, 2)), *(pa.array(x) for x in per_doc)], ["doc_id", "held_out", "n", "known", "base", "lm"]))
                tail.append((t.value[away], t.history[away], (t.doc[away] + first).astype(np.uint32)))
                first += w.docs
            sink = pa.BufferOutputStream()
            table = pa.Table.from_batches(rows).combine_chunks()
            with pa.ipc.new_stream(sink, table.schema) as stream:
                stream.write_table(table)
            key = (part() << 24) + nth
            nth += 1
            value, history, doc = (np.concatenate(x) for x in zip(*tail, strict=True))
            # a word's documents stay in their order
            order = _order(value)
            value, history, doc = value[order], history[order], doc[order]
            cut = np.searchsorted(_shard_of(value, sizes.shards), np.arange(sizes.shards + 1))
            some = np.flatnonzero(np.diff(cut))
            sent: list[list] = [[None, *([None] * len(some))] for _ in range(4)]
            for i, s in enumerate(some.tolist(), 1):
                a, b = cut[s], cut[s + 1]
                begin = _firsts(value[a:b])
                word, times = value[a:b][begin], np.diff(np.append(begin, b - a))
                for column, x in zip(sent, (word, times.astype(np.uint32), history[a:b], doc[a:b]), strict=True):
                    column[i] = _planes(x)
            bodies = [sink.getvalue().to_pybytes(), *([None] * len(some))]
            yield pa.RecordBatch.from_arrays([pa.array([key % sizes.shards, *some], pa.int32()), pa.array([key] * (1 + len(some)), pa.int64()), pa.array([0] + [1] * len(some), pa.int32()), pa.array(bodies, pa.binary()), *(pa.array(x, pa.binary()) for x in sent)], ["shard", "batch", "kind", "body", "words", "sizes", "histories", "docs"])

    def answer(asked: pa.Table, own: pa.Table) -> pa.Table:
        """A shard's answer to each batch: its documents' sums over the shard's words."""
        m = shared.value
        word = counts = np.zeros(0, np.uint64)
        key, value = np.zeros(0, np.int64), np.zeros(0)
        if len(own):
            word, counts, at, history, times = _unpack_pairs(*(own[c][0].as_py() for c in ("words", "counts", "sizes", "histories", "times")))
            # pairs lie by word, then history
            key, value = (at << 16) | history, m.pair_values(word[at], counts[at], history, times) - np.log(counts[at] + 1.0)
        out: list[list] = [[] for _ in range(7)]
        for batch, kind, shard, body, words, size, histories, docs in zip(*(asked[c].to_pylist() for c in ("batch", "kind", "shard", "body", "words", "sizes", "histories", "docs")), strict=True):
            row = [batch, kind, shard, body, None, None, None]
            if kind == 1:
                asked_word, doc, history = _unplanes(words, "<u8"), _unplanes(docs, "<u4"), _unplanes(histories, "<u2")
                many = _unplanes(size, "<u4")
                at, known = _find(word, asked_word)
                count = np.where(known, counts[at], 0) if len(word) else np.zeros(len(at), np.int64)
                count, known = np.repeat(count, many), np.repeat(known, many)
                at, found = _find(key, np.repeat(at << 16, many) | history)
                more = np.where(found & known, value[at], 0) if len(key) else np.zeros(len(at))
                who, place = np.unique(doc, return_inverse=True)
                got = [np.bincount(place, x) for x in (np.log10(count + 1.0), known, np.log(count + 1.0) + more)]
                row[3:] = [_planes(who), _planes(got[0]), _planes(got[1].astype(np.uint32)), _planes(got[2])]
            for column, x in zip(out, row, strict=True):
                column.append(x)
        return pa.table([pa.array(x, k) for x, k in zip(out, (pa.int64(), pa.int32(), pa.int32(), *[pa.binary()] * 4), strict=True)], names=["batch", "kind", "shard", "body", "base", "known", "value"])

    def gather(parts: pa.Table) -> pa.Table:
        parts = parts.sort_by([("kind", "ascending"), ("shard", "ascending")])
        rows = [r for r in parts.select(["kind", "body", "base", "known", "value"]).to_pylist()]
        t = pa.ipc.open_stream(rows[0]["body"]).read_all()
        base, known, lm = (t[c].to_numpy().copy() for c in ("base", "known", "lm"))
        for r in rows[1:]:
            who = _unplanes(r["body"], "<u4")
            base[who] += _unplanes(r["base"], "<f8")
            known[who] += _unplanes(r["known"], "<u4")
            lm[who] += _unplanes(r["value"], "<f8")
        n = t["n"].to_numpy()
        base -= n * np.log10(model_total + model_types + 1)
        return pa.table([t["doc_id"].cast(pa.int64()), t["held_out"], *(pa.array(x.astype(np.int64)) for x in (n, known)), pa.array(base), pa.array(lm / log10)], names=["doc_id", "held_out", "n_tokens", "n_known", "base_score", "score"])

    model_total, model_types = model.total, model.types
    asked = docs.withColumn("held_out", out_of).mapInArrow(send, _SENT)
    answers = asked.groupBy("shard").cogroup(pairs.groupBy("shard")).applyInArrow(answer, _ANSWER)
    out = answers.groupBy("batch").applyInArrow(gather, "doc_id long, held_out boolean, n_tokens long, n_known long, base_score double, score double")
    return out.select("doc_id", "held_out", "n_tokens", "n_known", F.lit(model.total).cast("long").alias("train_tokens"), "base_score", "score")
