"""Vectorised word spans and rolling hashes over the raw UTF-8 buffer of an Arrow string column.

Every separator used here is an ASCII byte, which never occurs inside a multi-byte UTF-8 character,
so words can be cut on bytes. Work is done in chunks of a few MB, whatever the batch size; one text
longer than that forms a chunk of its own.
"""

from __future__ import annotations

import ctypes
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache
from itertools import pairwise

import numpy as np
import pyarrow as pa
from pyspark import TaskContext

CHUNK_BYTES = 1 << 19


@cache
def give_memory_back() -> None:
    """Have freed arrays returned to the system: workers live on between tasks, and several share an executor."""
    pa.set_memory_pool(pa.system_memory_pool())
    try:
        ctypes.CDLL(None).mallopt(-3, 1 << 18)  # M_MMAP_THRESHOLD, which else grows with each freed array
    except (AttributeError, OSError):
        pass  # another C library


# in a worker only, before it reads any data: the driver's process is not ours to set up
if TaskContext.get() is not None:
    give_memory_back()

_BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
_INV = np.uint64(pow(int(_BASE), -1, 1 << 64))
_POWERS: dict[str, np.ndarray] = {}

_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_PUNCT = np.zeros(256, bool)
_PUNCT[[*range(0x00, 0x30), *range(0x3A, 0x61), *range(0x7B, 0x80)]] = True
_LETTER = np.zeros(256, bool)
_LETTER[[*range(0x41, 0x5B), *range(0x61, 0x7B)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def _powers(name: str, n: int) -> np.ndarray:
    """base**0 .. base**(n-1) mod 2**64, grown by doubling and kept for the life of the worker."""
    have = _POWERS.get(name)
    if have is None or len(have) < n:
        base = _BASE if name == "up" else _INV
        have = np.ones(1, np.uint64)
        while len(have) < n:
            step = np.uint64(pow(int(base), len(have), 1 << 64))
            have = np.concatenate([have, have * step])
        _POWERS[name] = have
    return have[:n]


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser, so that close inputs get unrelated outputs."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def distinct(values: np.ndarray) -> np.ndarray:
    """Sorted distinct values; by sorting, which for numbers is much faster than np.unique's table."""
    values = np.sort(values)
    new = np.ones(len(values), bool)
    new[1:] = values[1:] != values[:-1]
    return values[new]


def sort_within(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """values sorted within each of the parts that bounds give."""
    out = values.copy()
    for a, b in pairwise(bounds.tolist()):
        if b - a > 1:
            out[a:b].sort()
    return out


@dataclass
class Words:
    """The words of some documents: first..first+len(bounds)-1 of the batch."""

    first: int
    raw: np.ndarray  # bytes
    data: np.ndarray  # the same, lower-cased where asked for
    text_at: np.ndarray  # where each document's text starts in data, and the end
    starts: np.ndarray  # word starts in data
    ends: np.ndarray
    bounds: np.ndarray  # where each document's words start, and the end
    hashes: np.ndarray | None

    @property
    def docs(self) -> int:
        return len(self.bounds) - 1

    def doc_of_word(self) -> np.ndarray:
        return np.repeat(np.arange(self.docs), np.diff(self.bounds))


def buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Offsets and bytes of a string column; nulls count as empty texts."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_string())
    if column.null_count:
        column = column.fill_null("")
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    if not len(offsets):
        offsets = np.zeros(1, np.int64)
    raw = column.buffers()[2]
    return offsets, np.frombuffer(raw, np.uint8) if raw is not None and raw.size else np.zeros(0, np.uint8)


def chunks(column: pa.Array, limit: int = CHUNK_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, offsets, bytes) of runs of rows of at most limit bytes, or of one row."""
    offsets, data = buffers(column)
    row, rows = 0, len(offsets) - 1
    while row < rows:
        end = max(row + 1, int(np.searchsorted(offsets, offsets[row] + limit, "right")) - 1)
        yield row, end, offsets[row : end + 1] - offsets[row], data[offsets[row] : offsets[end]]
        row = end


def hash_spans(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A hash of the bytes of each span."""
    total = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * _powers("up", len(data)), out=total[1:])
    return mix((total[ends] - total[starts]) * _powers("down", len(data) + 1)[starts] + (ends - starts).astype(np.uint64))


def _latin(data: np.ndarray) -> np.ndarray:
    """Which bytes belong to Latin letters: A-Z, a-z and U+00C0 to U+00FF, which are two bytes, the first 0xC3."""
    wide = data == 0xC3
    letters = _LETTER[data] | wide
    letters[1:] |= wide[:-1]
    return letters


def split(column: pa.Array, *, lower: bool = False, alnum: bool = False, letters: bool = False, hashed: bool = True, limit: int = CHUNK_BYTES) -> Iterator[Words]:
    """Words of each chunk: runs without white space, or (alnum) runs of a-z, 0-9 and non-ASCII, or (letters) runs of Latin letters."""
    separator = _PUNCT if alnum else _SPACE
    for row, _, text_at, raw in chunks(column, limit):
        data = raw
        if lower:
            data = _LOWER[data]
        n = len(data)
        inside = np.zeros(n + 2, np.int8)
        inside[1 : n + 1] = _latin(data) if letters else ~separator[data]
        edge = np.diff(inside)
        # a word never runs from one text into the next
        starts, ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
        cuts = text_at[1:-1]
        cuts = distinct(cuts[(cuts > 0) & (cuts < n)])
        if len(cuts):
            cuts = cuts[(inside[cuts] == 1) & (inside[cuts + 1] == 1)]
            if len(cuts):
                starts, ends = np.sort(np.concatenate([starts, cuts])), np.sort(np.concatenate([ends, cuts]))
        hashes = hash_spans(data, starts, ends) if hashed else None
        yield Words(row, raw, data, text_at, starts, ends, np.searchsorted(starts, text_at), hashes)


def rolling(hashes: np.ndarray, k: int) -> np.ndarray:
    """Hash of each run of k consecutive words (of the whole chunk; runs over a document's end are for the caller to leave out)."""
    n = len(hashes) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    total = np.zeros(len(hashes) + 1, np.uint64)
    np.cumsum(hashes * _powers("up", len(hashes)), out=total[1:])
    return mix((total[k:] - total[:-k]) * _powers("down", n))


def runs(words: Words, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(document, start word, hash) of each run of k words that lies in one document."""
    hashes = rolling(words.hashes, k)
    doc = words.doc_of_word()
    inside = doc[: len(hashes)] == doc[k - 1 :] if len(hashes) else np.zeros(0, bool)
    at = np.flatnonzero(inside)
    return doc[at], at, hashes[at]


def joined(words: Words, keep: np.ndarray | None = None) -> pa.Array:
    """Each document's words (those that keep marks) joined by one space."""
    starts, ends, bounds = words.starts, words.ends, words.bounds
    if keep is not None:
        bounds = np.concatenate([[0], np.cumsum(keep)])[bounds]
        starts, ends = starts[keep], ends[keep]
    body, at, _ = spaced(words.data, starts, ends)
    # a document's last blank belongs to no one: cut it off by shifting what follows
    some = np.diff(bounds) > 0
    size = at[bounds[1:]] - at[bounds[:-1]] - some
    whole = np.ones(len(body), bool)
    whole[at[bounds[1:]][some] - 1] = False
    offsets = np.concatenate([[0], np.cumsum(size)])
    return pa.LargeStringArray.from_buffers(len(size), pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(body[whole])).cast(pa.string())


def spaced(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Words of data one after the other with a blank behind each; where each starts (and the end of all), where each ends."""
    at = np.concatenate([[0], np.cumsum(ends - starts + 1)])
    take = np.arange(at[-1]) + np.repeat(starts - at[:-1], np.diff(at))
    body = data[np.minimum(take, len(data) - 1)] if len(take) else np.zeros(0, np.uint8)
    body[at[1:] - 1] = 0x20
    return body, at, at[1:] - 1


def gather(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Spans of data one after the other, and their offsets."""
    offsets = np.concatenate([[0], np.cumsum(ends - starts)]).astype(np.int64)
    return data[np.arange(offsets[-1]) + np.repeat(starts - offsets[:-1], np.diff(offsets))], offsets
