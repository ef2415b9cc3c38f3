"""Substring dedup by repeated-phrase automata.

A window is W consecutive words of a document. Windows that occur twice or more, anywhere, are
found in three passes over the documents, which are dealt into buckets once:

1. Phrases. Of the short phrases in a window, the one with the smallest hash is its anchor; equal
   windows have equal anchors. Anchors that occur once rule out most windows cheaply.
2. Confirmation. A shard owns a range of windows. It gets those around each bucket's recurring phrases,
   counts them exactly over all documents and tells every bucket which of its are confirmed.
3. Automata. A bucket merges confirmed windows that follow each other into passages, compiles the
   different ones into Aho-Corasick automata, of a bounded number of words each, and streams all of its
   documents through them. What is removed is what hits cover, from their first to their last word.

A passage is made of confirmed windows alone, so wherever it stands all of its words are covered by
windows that recur; and each window of a bucket that recurs is in a passage of the bucket. So to stream
a bucket's documents through its own passages gives what streaming them through those of all buckets
would, at a cost that grows with the documents only.
"""

from __future__ import annotations

from itertools import compress

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import parts, settled, shared_dir, ship
from . import recurring as R
from . import words as W

ANCHOR = 6
#: Words in one automaton, a bound on its memory; words in a passage, beyond which another one starts.
WORDS, LONGEST = 1 << 17, 1 << 12
_SENT = "shard int, bucket int, windows binary, several binary"
_KNOWN = "bucket int, kind int, shard int, bits binary"


def _windows(w: W.Words, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Starts and anchors of a chunk's windows; places and hashes of its anchors.

    Anchors are the smallest hashes, so they are mixed again: shards are ranges of evenly spread values.
    """
    anchor = min(ANCHOR, size)
    _, at, _ = W.runs(w, size)
    if not len(at):
        empty = np.zeros(0, np.uint64)
        return at, empty, at, empty
    gram = W.rolling(w.hashes, anchor)
    span = size - anchor + 1  # phrases in a window
    low, width = gram, 1
    while width < span:
        step = min(width, span - width)
        low = np.minimum(low[: len(low) - step], low[step:])
        width += step
    least = low[at]
    # a phrase is an anchor if some window around it has no smaller one
    high = np.zeros(len(gram), np.uint64)
    full = np.zeros(len(gram) + span, np.uint64)
    full[at + span - 1] = least
    width = 1
    while width < span:
        step = min(width, span - width)
        full = np.maximum(full[: len(full) - step], full[step:])
        width += step
    high = full[: len(gram)]
    place = np.flatnonzero((high == gram) & (high > 0))
    return at, W.mix(least), place, W.mix(gram[place])


def _chunks(table: pa.Table):
    return W.split(table["text"].combine_chunks())


def _empty() -> np.ndarray:
    return np.zeros(0, np.uint64)


def _join(arrays) -> np.ndarray:
    return np.concatenate([_empty(), *arrays])


def _summary(w: W.Words, size: int) -> tuple[np.ndarray, ...]:
    """What is sent of a chunk, if it recurs, so that the chunk itself need not be held: its windows' anchors and
    hashes, and its different anchors."""
    at, least, _, own = _windows(w, size)
    return least, W.rolling(w.hashes, size)[at] if len(at) else _empty(), W.distinct(own)


def pack_windows(bucket: int, chunks: list[tuple], recurring: np.ndarray, shards: int) -> pa.Table:
    """What a bucket sends the shards: the windows around its recurring anchors, and which it has several times.

    Windows are dealt by their own hash, not by their anchor's, so a phrase that very many different windows
    share makes no shard hot.
    """
    value, count = np.unique(_join(x[1][R.isin(x[0], recurring)] for x in chunks), return_counts=True)
    cut = R._cuts(value, shards)
    some = np.flatnonzero(np.diff(cut))
    sent = [[value[cut[i] : cut[i + 1]].tobytes() for i in some], [np.packbits(count[cut[i] : cut[i + 1]] > 1).tobytes() for i in some]]
    return pa.table([pa.array(some, pa.int32()), pa.array(np.full(len(some), bucket), pa.int32()), *(pa.array(x, pa.binary()) for x in sent)], names=["shard", "bucket", "windows", "several"])


def confirm(sent: DataFrame) -> DataFrame:
    """(bucket, kind 2, shard, bits: the bucket's confirmed windows)."""

    def shard(table: pa.Table) -> pa.Table:
        windows = [np.frombuffer(x, np.uint64) for x in table["windows"].to_pylist()]
        again = [np.unpackbits(np.frombuffer(x, np.uint8), count=len(w)) > 0 for x, w in zip(table["several"].to_pylist(), windows, strict=True)]
        every = _join([*windows, *(w[x] for w, x in zip(windows, again, strict=True))])
        value, count = np.unique(every, return_counts=True)
        twice = value[count > 1]
        good = pa.array([w[R.isin(w, twice)].tobytes() for w in windows], pa.binary())
        return pa.table([table["bucket"], pa.array(np.full(len(windows), 2), pa.int32()), table["shard"], good], names=["bucket", "kind", "shard", "bits"])

    return sent.groupBy("shard").applyInArrow(shard, _KNOWN)


def merged_passages(w: W.Words, confirmed: np.ndarray, size: int) -> list[bytes]:
    """The words (as their hashes) of each stretch of a chunk that confirmed windows cover, cut between windows where it is over LONGEST words."""
    doc, at, value = W.runs(w, size)
    good = R.isin(value, confirmed)
    doc, at = doc[good], at[good]
    if not len(at):
        return []
    new = np.ones(len(at), bool)
    new[1:] = (doc[1:] != doc[:-1]) | (at[1:] > at[:-1] + size)
    start = at[new][np.cumsum(new) - 1]  # where each window's stretch starts
    new[1:] |= (at[1:] - start[1:]) // LONGEST != (at[:-1] - start[:-1]) // LONGEST
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(at)) - 1
    return [w.hashes[a:b].tobytes() for a, b in zip(at[first].tolist(), (at[last] + size).tolist(), strict=True)]


def _spell(number: np.ndarray, base: int) -> np.ndarray:
    """Three symbols for each word number, of ranges of their own, so that phrases match on whole words only.

    An automaton's nodes find their next symbol among their children one by one: three symbols of a
    small alphabet are found sooner than one of a large alphabet.
    """
    digits = np.stack([number // (base * base), number // base % base, number % base], axis=-1)
    return (digits + np.array([2, 2 + base, 2 + 2 * base])).astype("<u4")


def automata(passages: list[bytes]) -> list[tuple[np.ndarray, int, int, ahocorasick.Automaton]]:
    """(sorted word hashes, base of their spelling, words in the shortest passage, automaton) for each WORDS words of different passages."""
    out, some, held = [], [], 0
    for i, passage in enumerate(passages):
        some.append(np.frombuffer(passage, np.uint64))
        held += len(some[-1])
        if held < WORDS and i + 1 < len(passages):
            continue
        known, code = np.unique(np.concatenate(some), return_inverse=True)
        base = int(np.ceil(len(known) ** (1 / 3))) + 1
        text = _spell(code.reshape(-1), base).tobytes().decode("utf-32-le")
        automaton, at = ahocorasick.Automaton(ahocorasick.STORE_LENGTH), 0
        for x in some:
            automaton.add_word(text[at : at + 3 * len(x)])
            at += 3 * len(x)
        automaton.make_automaton()
        out.append((known, base, min(map(len, some)), automaton))
        some, held = [], 0
    return out


def covered_words(w: W.Words, machines: list[tuple[np.ndarray, int, int, ahocorasick.Automaton]]) -> np.ndarray:
    """Whether a hit of a passage covers each word of a chunk, from its first to its last word; hits lie within one document."""
    edge = np.zeros(len(w.hashes) + 1, np.int32)
    doc = w.doc_of_word()
    for known, base, width, automaton in machines:
        # a word that no passage has ends every match, and so does a document's end: only runs of words in between are read
        at = np.flatnonzero(R.isin(w.hashes, known))
        new = np.ones(len(at), bool)
        new[1:] = (np.diff(at) != 1) | (doc[at[1:]] != doc[at[:-1]])
        run = np.cumsum(new) - 1
        long = np.bincount(run, minlength=1)[run] >= width if len(at) else new
        at, new = at[long], new[long]
        if not len(at):
            continue
        place = 3 * np.arange(len(at)) + np.cumsum(new) - 1
        symbols = np.ones(int(place[-1]) + 3, "<u4")
        symbols[place[:, None] + np.arange(3)] = _spell(np.searchsorted(known, w.hashes[at]), base)
        longest: dict[int, int] = {}
        for end, length in automaton.iter(symbols.tobytes().decode("utf-32-le")):
            if length > longest.get(end, 0):
                longest[end] = length
        hits = np.fromiter(longest.items(), np.dtype((np.int64, 2)), len(longest))
        if len(hits):
            first = at[np.searchsorted(place, hits[:, 0] - hits[:, 1] + 1)]
            np.add.at(edge, first, 1)
            np.add.at(edge, first + hits[:, 1] // 3, -1)
    return np.cumsum(edge[:-1]) > 0


def drop_repeated_passages(df: DataFrame, *, size: int = 35, doc_id: str = "doc_id", text: str = "text", carry: tuple[str, ...] = (), verbatim: bool = False) -> DataFrame:
    """doc_id, kept_text, n_words, n_removed and the carried columns of every row of df.

    Words are runs without white space. Each word that lies in a window of size words whose sequence
    also starts elsewhere (in any document, itself included) is removed; windows are judged on the
    input. kept_text is the kept words joined by one space; with verbatim, texts that lose nothing
    (and nulls) come back as they are.

    Null and empty texts: no words, kept_text is ''. Texts of fewer than size words are kept. Rows
    that repeat remove each other's passages, whatever their ids (all occurrences go; none is kept as
    the first, so ties do not arise). Null ids are kept as null. Empty tables give no rows. Long texts
    are handled whole, with any number of different words; other columns but carry's are ignored.
    """
    spark = df.sparkSession
    ship(spark)
    shared_dir(spark)
    n = parts(df)
    shards = parts(df, R.SHARD_BYTES)
    route = R.Route.of(n, shards)
    inner = [f"_carry{i}" for i in range(len(carry))]
    docs = settled(df.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"), *(F.col(c).alias(x) for c, x in zip(carry, inner, strict=True))))
    # dealt by row, so that rows that repeat do not meet in one bucket
    docs = docs.withColumn("bucket", F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(n)).cast("int"))
    key = lambda table, left=None: (table if len(table) else left)["bucket"][0].as_py()

    def send_anchors(table: pa.Table) -> pa.Table:
        return R.pack(key(table), _join(_windows(w, size)[3] for w in _chunks(table)), route.first)

    def send_windows(table: pa.Table, answers: pa.Table) -> pa.Table:
        chunks = [_summary(w, size) for w in _chunks(table)]
        recurring = R.unpack(_join(x[2] for x in chunks), answers, 1, route.first)
        return pack_windows(key(table, answers), chunks, recurring, shards)

    fields = [f for f in docs.schema.fields if f.name in inner]
    schema = "doc_id long, kept_text string, n_words long, n_removed long" + "".join(f", {f.name} {f.dataType.simpleString()}" for f in fields)

    def locate(table: pa.Table, known: pa.Table) -> pa.Table:
        confirmed = W.distinct(_join(np.frombuffer(x, np.uint64) for x in known["bits"].to_pylist()))
        # each passage once; in the order of the documents, so that a task that is run again compiles the same
        machines = automata(list(dict.fromkeys(x for w in _chunks(table) for x in merged_passages(w, confirmed, size))))
        kept, n_words, n_removed = [], [], []
        valid = table["text"].is_valid().to_numpy()
        for w in _chunks(table):
            gone = covered_words(w, machines)
            raw = w.data.tobytes()
            for i in range(w.docs):
                mine = raw[w.text_at[i] : w.text_at[i + 1]].split()
                out = gone[w.bounds[i] : w.bounds[i + 1]]
                lost = int(out.sum())
                if verbatim and not lost:
                    kept.append(raw[w.text_at[i] : w.text_at[i + 1]] if valid[w.first + i] else None)
                else:
                    kept.append(b" ".join(compress(mine, ~out) if lost else mine))
                n_words.append(len(mine))
                n_removed.append(lost)
        columns = [table["doc_id"], pa.array(kept, pa.binary()).cast(pa.string()), pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64())]
        return pa.table(columns + [table[x] for x in inner], names=["doc_id", "kept_text", "n_words", "n_removed", *inner])

    by = lambda frame: frame.groupBy("bucket")
    first = R.answer(by(docs).applyInArrow(send_anchors, R.SENT_DDL), 1, route)
    known = confirm(by(docs).cogroup(by(first)).applyInArrow(send_windows, _SENT))
    out = by(docs).cogroup(by(known)).applyInArrow(locate, schema)
    return out.select("doc_id", "kept_text", "n_words", "n_removed", *(F.col(x).alias(c) for c, x in zip(carry, inner, strict=True)))


#: The rows of op3 for DuckDB (doc_ids are unique there).
PASSAGES_SQL = r"""
WITH texts AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
places AS (SELECT doc_id, w, unnest(range(1, len(w) + 1)) AS i FROM texts),
windows AS (SELECT doc_id, i, w[i] AS word, CASE WHEN i + 34 <= len(w) THEN sha256(array_to_string(w[i:i + 34], ' ')) END AS win FROM places),
again AS (SELECT win FROM windows WHERE win IS NOT NULL GROUP BY win HAVING count(*) > 1),
marked AS (
  SELECT doc_id, i, word, max(CASE WHEN a.win IS NOT NULL THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN 34 PRECEDING AND CURRENT ROW) AS gone
  FROM windows v LEFT JOIN again a ON v.win = a.win),
kept AS (SELECT doc_id, CAST(sum(gone) AS BIGINT) AS n_removed, string_agg(word, ' ' ORDER BY i) FILTER (WHERE gone = 0) AS kept_text FROM marked GROUP BY doc_id)
SELECT t.doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_removed, 0) AS n_removed, sha256(coalesce(kept_text, '')) AS kept_sha256
FROM texts t LEFT JOIN kept k ON t.doc_id = k.doc_id
"""
