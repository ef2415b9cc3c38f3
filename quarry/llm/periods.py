"""Periodic runs of words: maximal stretches in which every word equals the one a period before it.

Words that can lie in no run are ruled out first: a run of length L and period q repeats each of its
word k-grams at a distance of at most q, over a streak of L - q - k + 1 places. What is left (loops,
stutters, tables of one row) goes through a suffix automaton. Its states are visited from long to short,
and each hands its ordered set of end positions to its suffix link, the smaller set into the larger.
A position's new neighbour at distance d in a state of length l means that the same l words end d words
apart; where d is small against l, that overlap is a repetition of period d, which is extended to a run.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import ship
from . import words as W
from .crc import CRC32_SQL, crc32_sql

SCHEMA = "doc_id long, n_words long, runs array<struct<start: long, length: long, period: long>>, collapsed_text string"
_RUN = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))


class Positions:
    """An ordered set of numbers in blocks of bounded length, so that growing it at either end stays cheap."""

    BLOCK = 512

    def __init__(self, first: int) -> None:
        self.blocks, self.heads, self.size = [[first]], [first], 1

    def __iter__(self) -> Iterator[int]:
        for block in self.blocks:
            yield from block

    def add(self, x: int) -> tuple[int | None, int | None]:
        """Put x in; its neighbours below and above."""
        i = max(0, bisect_right(self.heads, x) - 1)
        block = self.blocks[i]
        at = bisect_left(block, x)
        below = block[at - 1] if at else None
        above = block[at] if at < len(block) else self.heads[i + 1] if i + 1 < len(self.heads) else None
        block.insert(at, x)
        if not at:
            self.heads[i] = x
        if len(block) > self.BLOCK:
            half = len(block) // 2
            self.blocks.insert(i + 1, block[half:])
            self.heads.insert(i + 1, block[half])
            del block[half:]
        self.size += 1
        return below, above


def suffix_automaton(words: list[int]) -> tuple[list[int], list[int], list[int]]:
    """Length, suffix link and own end position (-1: a split state's) of each state; state 0 is the root.

    Most states have one way on, so that one is kept apart and only states with several have a table.
    """
    length, link, own = [0], [-1], [-1]
    word, to, more = [-1], [-1], {}
    last = 0
    for place, c in enumerate(words):
        state = len(length)
        length.append(place + 1)
        link.append(0)
        own.append(place)
        word.append(-1)
        to.append(-1)
        p, q = last, -1
        while p != -1:
            q = to[p] if word[p] == c else more[p].get(c, -1) if p in more else -1
            if q != -1:
                break
            if word[p] == -1:
                word[p], to[p] = c, state
            else:
                more.setdefault(p, {})[c] = state
            p = link[p]
        if p != -1:
            if length[p] + 1 != length[q]:
                copy = len(length)
                length.append(length[p] + 1)
                link.append(link[q])
                own.append(-1)
                word.append(word[q])
                to.append(to[q])
                if q in more:
                    more[copy] = dict(more[q])
                while p != -1:
                    if word[p] == c and to[p] == q:
                        to[p] = copy
                    elif p in more and more[p].get(c) == q:
                        more[p][c] = copy
                    else:
                        break
                    p = link[p]
                link[q] = copy
                q = copy
            link[state] = q
        last = state
    return length, link, own


def runs_of(words: list[int], min_length: int = 6, min_exponent: int = 4) -> list[tuple[int, int, int]]:
    """(start, length, period) of the runs with length >= max(min_length, min_exponent * period), by start, then period."""
    length, link, own = suffix_automaton(words)
    ends: dict[int, Positions] = {}
    known: dict[int, tuple[list[int], list[int]]] = {}
    for state in np.argsort(-np.array(length), kind="stable").tolist():
        up = link[state]
        if up <= 0:  # the root's state holds no words, so nothing meets there
            continue
        mine = ends.pop(state, None) or Positions(own[state])
        theirs = ends.get(up)
        if theirs is None:
            if own[up] == -1:
                ends[up] = mine
                continue
            theirs = Positions(own[up])
        small, large = (mine, theirs) if mine.size <= theirs.size else (theirs, mine)
        ends[up] = large
        most, held = length[up] // (min_exponent - 1), length[up]
        for x in small:
            below, above = large.add(x)
            if below is not None and x - below <= most:
                _extend(words, x, x - below, held, known)
            if above is not None and above - x <= most:
                _extend(words, above, above - x, held, known)
    # a run is also found at multiples of its period: the smallest names it
    best: dict[tuple[int, int], int] = {}
    for period in sorted(known):
        for start, end in zip(*known[period], strict=True):
            best.setdefault((start, end), period)
    return [(start, end - start, q) for (start, end), q in sorted(best.items(), key=lambda x: (x[0][0], x[1])) if end - start >= max(min_length, min_exponent * q)]


def _extend(words: list[int], end: int, period: int, held: int, known: dict[int, tuple[list[int], list[int]]]) -> None:
    """Add the run of this period around the held words that end at end, and also a period before it."""
    first = end - period - held + 1
    starts, stops = known.setdefault(period, ([], []))
    i = bisect_right(starts, first)
    if i and stops[i - 1] > end:
        return
    stop = end + 1
    while stop < len(words) and words[stop] == words[stop - period]:
        stop += 1
    while first and words[first - 1] == words[first - 1 + period]:
        first -= 1
    i = bisect_left(starts, first)
    starts.insert(i, first)
    stops.insert(i, stop)


def _streaks(at: np.ndarray, doc: np.ndarray) -> np.ndarray:
    """Bounds of the stretches of at that follow each other within a document."""
    return np.flatnonzero(np.concatenate([[True], (np.diff(at) != 1) | (np.diff(doc) != 0), [True]]))


def candidates(w: W.Words, min_length: int, min_exponent: int) -> list[tuple[int, int]]:
    """Stretches (start, end) of words, each within a document, outside of which there are no runs."""
    k = min(max(min_length, min_exponent * q) - q for q in range(1, max(2, min_length) + 1))
    doc, at, value = W.runs(w, k)
    if not len(at):
        return []
    value = value ^ W.mix(doc.astype(np.uint64) + np.uint64(1))
    order = np.argsort(value, kind="stable")
    again = np.flatnonzero(value[order[1:]] == value[order[:-1]])
    back = np.zeros(len(at), np.int64)
    back[order[again + 1]] = at[order[again + 1]] - at[order[again]]
    at, doc, back = (x[back > 0] for x in (at, doc, back))
    while len(at):
        cut = _streaks(at, doc)
        room = np.repeat((np.diff(cut) + k - 1) // (min_exponent - 1), np.diff(cut))
        fits = back <= room
        if fits.all():
            break
        at, doc, back = at[fits], doc[fits], back[fits]
    if not len(at):
        return []
    cut = _streaks(at, doc)
    first, last = at[cut[:-1]], at[cut[1:] - 1]
    start = np.maximum(first - (last - first + k) // (min_exponent - 1), w.bounds[doc[cut[:-1]]])
    out: list[tuple[int, int]] = []
    for a, b in zip(start.tolist(), (last + k).tolist(), strict=True):
        while out and a < out[-1][1]:
            a = min(a, out.pop()[0])
        out.append((a, b))
    return out


def periodic_runs(df: DataFrame, *, min_length: int = 6, min_exponent: int = 4, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_words, runs (start, length, period; by start, then period) and collapsed_text of every row of df.

    Words are runs without white space, numbered from 0. A run is a stretch of words with smallest period
    q and a length of at least max(min_length, min_exponent * q) that no neighbouring word extends.
    collapsed_text is the words joined by one space, without those that a run holds after its first q.
    min_exponent is 2 or more.

    Null and empty texts: no words, no runs, ''. Rows are independent: rows that repeat, or share an id,
    give rows alike, and a null doc_id stays null. Of runs over the same words the one with the smallest
    period counts; runs that overlap all count. Texts are read whole; memory grows with the longest
    repetitive stretch of one text, not with the table. Empty tables give no rows; other columns are ignored.
    """
    ship(df.sparkSession)

    def rows(batches):
        for batch in batches:
            for w in W.split(batch.column(1)):
                found: list[list[dict[str, int]]] = [[] for _ in range(w.docs)]
                edge = np.zeros(len(w.starts) + 1, np.int64)
                stretches = candidates(w, min_length, min_exponent)
                owner = np.searchsorted(w.bounds, [a for a, _ in stretches], "right") - 1
                for (a, b), i in zip(stretches, owner.tolist(), strict=True):
                    ids = np.unique(w.hashes[a:b], return_inverse=True)[1].tolist()
                    for start, length, q in runs_of(ids, min_length, min_exponent):
                        found[i].append({"start": a + start - int(w.bounds[i]), "length": length, "period": q})
                        edge[a + start + q] += 1
                        edge[a + start + length] -= 1
                texts = W.joined(w, np.cumsum(edge[:-1]) == 0)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(w.first, w.docs), pa.array(np.diff(w.bounds)), pa.array(found, _RUN), texts], ["doc_id", "n_words", "runs", "collapsed_text"]
                )

    return df.select(F.col(doc_id).cast("long"), F.col(text).cast("string")).mapInArrow(rows, SCHEMA)


def loop_tails(text: str = "text", doc_id: str = "doc_id"):
    """The text that op11 judges: in a tenth of the documents (by crc32 of the id) the words from a place on repeat a stretch.

    Rows without an id stay as they are.
    """
    words = F.filter(F.split(text, r"[\x20\x09-\x0D]+"), lambda x: x != "")
    h = F.crc32(F.col(doc_id).cast("string").cast("binary"))
    g, n = F.floor(h / 10), F.size(words)
    a = (g % F.nullif(n, F.lit(0))).cast("int")
    p = (1 + F.floor((n - a) / (3 + g % 8))).cast("int")
    tail = F.flatten(F.array_repeat(F.slice(words, a + 1, p), F.ceil((n - a) / p).cast("int")))
    looped = F.array_join(F.concat(F.slice(words, F.lit(1), a), F.slice(tail, F.lit(1), n - a)), " ")
    return F.when((h % 10 == 0) & (n > 0), looped).otherwise(F.col(text))


def run_digests(runs: DataFrame) -> DataFrame:
    """The agreed columns of op11, from those of periodic_runs()."""
    none = F.lit(None).cast("struct<start: bigint, length: bigint, period: bigint>")
    best = F.aggregate("runs", none, lambda x, r: F.when(x.isNull() | (r["length"] * x["period"] > x["length"] * r["period"]), r).otherwise(x))
    lines = F.array_join(F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n"))), "")
    out = runs.select("doc_id", F.size("runs").cast("long").alias("n_runs"), best.alias("best"), F.sha2(lines, 256).alias("runs_sha256"), F.sha2("collapsed_text", 256).alias("collapsed_sha256"))
    exponent = F.floor(1000 * F.col("best.length") / F.col("best.period")).cast("long")
    return out.select("doc_id", "n_runs", "best.start", "best.length", "best.period", exponent.alias("exponent_milli"), "runs_sha256", "collapsed_sha256")


#: The rows of op11 for DuckDB. Runs come from all pairs of equal words that are at most a quarter of the text apart.
RUNS_SQL = (
    CRC32_SQL
    + r""",
texts AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^ 	-
]+') AS w FROM documents),
hashed AS (SELECT doc_id, w, len(w) AS n, """
    + crc32_sql("CAST(doc_id AS VARCHAR)")
    + r""" AS h FROM texts, crc_table),
placed AS (SELECT *, h // 10 AS g, CASE WHEN h % 10 = 0 AND n > 0 THEN (h // 10) % n END AS a FROM hashed),
staged AS (SELECT doc_id, w, n, a, 1 + (n - a) // (3 + g % 8) AS p FROM placed),
words AS (SELECT doc_id, i, w[1 + CASE WHEN i >= a THEN a + (i - a) % p ELSE i END] AS word, n FROM (SELECT *, unnest(range(n)) AS i FROM staged)),
equal AS (SELECT x.doc_id, x.i, y.i - x.i AS q FROM words x JOIN words y ON x.doc_id = y.doc_id AND x.word = y.word AND y.i > x.i AND 4 * (y.i - x.i) <= x.n),
islands AS (SELECT doc_id, q, i, i - row_number() OVER (PARTITION BY doc_id, q ORDER BY i) AS island FROM equal),
stretches AS (SELECT doc_id, q, min(i) AS s, count(*) + q AS l FROM islands GROUP BY doc_id, q, island),
runs AS (SELECT doc_id, s, l, min(q) AS q FROM stretches GROUP BY doc_id, s, l HAVING l >= greatest(6, 4 * min(q))),
best AS (
  SELECT doc_id, count(*) AS n_runs, string_agg(s || ',' || l || ',' || q || chr(10), '' ORDER BY s, q) AS lines,
         arg_min({'s': s, 'l': l, 'q': q}, {'e': -(CAST(l AS DOUBLE) / q), 's': s, 'q': q}) AS b
  FROM runs GROUP BY doc_id),
gone AS (SELECT DISTINCT doc_id, unnest(range(s + q, s + l)) AS i FROM runs),
kept AS (SELECT w.doc_id, string_agg(word, ' ' ORDER BY w.i) AS body FROM words w ANTI JOIN gone g ON w.doc_id = g.doc_id AND w.i = g.i GROUP BY w.doc_id)
SELECT t.doc_id, coalesce(n_runs, 0) AS n_runs, CAST(b.s AS BIGINT) AS start, CAST(b.l AS BIGINT) AS length, CAST(b.q AS BIGINT) AS period,
       CAST(1000 * b.l // b.q AS BIGINT) AS exponent_milli, sha256(coalesce(lines, '')) AS runs_sha256, sha256(coalesce(body, '')) AS collapsed_sha256
FROM texts t LEFT JOIN best ON t.doc_id = best.doc_id LEFT JOIN kept k ON t.doc_id = k.doc_id
"""
)
