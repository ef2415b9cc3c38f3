"""Many terms in one pass: which terms of which lists some texts contain.

All lists' terms make one Aho-Corasick automaton, which reads each text once, from Arrow batches, however
many terms and lists there are. A list can look at some of the texts alone and ask for word boundaries;
where a match lies is known from its place, so texts that are searched together are still read once.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right
from collections.abc import Callable
from dataclasses import dataclass

import ahocorasick
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Wanted:
    """A list of terms, looked for in the fields first to last, as they stand joined by blanks.

    words: only between word boundaries; letters and digits of any script, and _, are word characters.
    """

    terms: list[str]
    first: int = 0
    last: int = 0
    words: bool = False


class Finder:
    """Finds the terms of lists in texts that are lower-case already."""

    def __init__(self, lists: list[Wanted]) -> None:
        self.lists = lists
        #: for each term: (list, how often it is listed there), and whether some list asks for its boundaries
        self.uses: dict[str, dict[int, int]] = {}
        for i, wanted in enumerate(lists):
            for t in wanted.terms:
                use = self.uses.setdefault(t.lower(), {})
                use[i] = use.get(i, 0) + 1
        self.automaton = ahocorasick.Automaton()
        for t, use in self.uses.items():
            self.automaton.add_word(t, (t, any(lists[i].words for i in use)))
        if self.uses:
            self.automaton.make_automaton()

    def find(self, fields: list[str]) -> list[set[str]]:
        """For each list, which of its terms are there."""
        out: list[set[str]] = [set() for _ in self.lists]
        if not self.uses:
            return out
        text = " ".join(fields)
        ends, at = [], -1
        for x in fields:
            at += 1 + len(x)
            ends.append(at)
        seen: dict[tuple[str, int, int], bool] = {}
        for last, (term, bounded) in self.automaton.iter(text):
            start = last - len(term) + 1
            # a term that takes in the blank between two fields belongs to both
            key = (term, bisect_left(ends, start), bisect_right(ends, last))
            if key not in seen or bounded and not seen[key]:
                seen[key] = bounded and not (start and _word(text[start - 1])) and not (last + 1 < len(text) and _word(text[last + 1]))
        for (term, first, last), alone in seen.items():
            for i in self.uses[term]:
                wanted = self.lists[i]
                if wanted.first <= first and last <= wanted.last and (alone or not wanted.words):
                    out[i].add(term)
        return out

    def counts(self, fields: list[str]) -> list[int]:
        """For each list, how many of its terms (as often as they are listed) are there."""
        return [sum(self.uses[t][i] for t in found) for i, found in enumerate(self.find(fields))]


def _word(c: str) -> bool:
    return c.isalnum() or c == "_"


def _rows(columns: tuple[pa.Array, ...]):
    return zip(*([x or "" for x in c.to_pylist()] for c in columns), strict=True)


def term_counts(fields: list[Column], lists: dict[str, Wanted]) -> Column:
    """STRUCT of an INT for each list: how many of its terms the lower-case fields contain. Null fields count as empty."""
    names, finder = list(lists), _once(list(lists.values()))

    @F.arrow_udf("struct<" + ",".join(f"{n}:int" for n in names) + ">")
    def counts(*columns):
        count = finder().counts
        rows = [count(list(row)) for row in _rows(columns)]
        return pa.StructArray.from_arrays([pa.array([r[i] for r in rows], pa.int32()) for i in range(len(names))], names)

    return counts(*fields)


def terms_in(text: Column, terms: list[str]) -> Column:
    """The terms, in list order, that a lower-case text contains; null for a null text."""
    finder = _once([Wanted(terms)])

    @F.arrow_udf("array<string>")
    def found(column):
        find = finder().find
        sets = (find([x])[0] if x is not None else None for x in column.to_pylist())
        return pa.array([None if s is None else [t for t in terms if t.lower() in s] for s in sets], pa.list_(pa.string()))

    return found(text)


def _once(lists: list[Wanted]) -> Callable[[], Finder]:
    """A finder that each worker builds at its first batch; only the lists travel."""
    held: list[Finder] = []

    def get() -> Finder:
        if not held:
            held.append(Finder(lists))
        return held[0]

    return get
