"""Licence scan: an Aho-Corasick automaton finds notice phrases and identifier tags, a shunting-yard
parser evaluates the licence expressions behind the tags."""

from __future__ import annotations

import re
from dataclasses import dataclass

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import ship
from .words import _LOWER, _PUNCT

#: The phrases that are counted by place, and their labels.
BASE_PHRASES = {
    "mit license": "mit",
    "apache license": "apache",
    "general public license": "gpl",
}
#: Notices that give a label besides.
NOTICE_PHRASES = {
    "permission is hereby granted free of charge": "mit",
    "licensed under the apache": "apache",
    "gnu lesser general public license": "lgpl",
    "gnu affero general public license": "agpl",
    "redistribution and use in source and binary forms": "bsd",
    "bsd license": "bsd",
    "mozilla public license": "mpl",
    "eclipse public license": "epl",
    "boost software license": "boost",
    "isc license": "isc",
    "this is free and unencumbered software released into the public domain": "unlicense",
    "creative commons attribution": "cc-by",
    "licensed under cc by": "cc-by",
    "licensed under cc by nc": "cc-by-nc",
    "licensed under cc by sa": "cc-by-sa",
    "licensed under cc0": "cc0",
}
TAG_PHRASES = ("spdx license identifier", "license expression")
#: Public licence identifiers, as (label, what they ask for, identifiers). 0 permissive, 1 weak copyleft, 2 strong
#: copyleft or limits on use. A family of versions is written with the versions after a blank. More come with the parameter identifiers.
IDENTIFIERS = (
    ("mit", 0, "MIT MIT-0 MIT-Modern-Variant MIT-open-group MITNFA MIT-CMU MIT-feh MIT-enna MIT-advertising"),
    ("apache", 0, "Apache- 1.0 1.1 2.0"),
    ("gpl", 2, "GPL- 1.0 2.0 3.0"),
    ("lgpl", 1, "LGPL- 2.0 2.1 3.0"),
    ("lgpl", 1, "LGPLLR"),
    ("agpl", 2, "AGPL- 1.0 3.0"),
    ("gfdl", 2, "GFDL- 1.1 1.2 1.3"),
    ("bsd", 0, "BSD- 1-Clause 2-Clause 2-Clause-Patent 2-Clause-Views 3-Clause 3-Clause-Attribution 3-Clause-Clear 3-Clause-LBNL 3-Clause-Modification 4-Clause 4-Clause-UC Source-Code Protection"),
    ("0bsd", 0, "0BSD"),
    ("mpl", 1, "MPL- 1.0 1.1 2.0 2.0-no-copyleft-exception"),
    ("epl", 1, "EPL- 1.0 2.0"),
    ("cpl", 1, "CPL-1.0"),
    ("cddl", 1, "CDDL- 1.0 1.1"),
    ("eupl", 2, "EUPL- 1.0 1.1 1.2"),
    ("osl", 2, "OSL- 1.0 1.1 2.0 2.1 3.0"),
    ("afl", 0, "AFL- 1.1 1.2 2.0 2.1 3.0"),
    ("boost", 0, "BSL-1.0"),
    ("busl", 2, "BUSL-1.1"),
    ("sspl", 2, "SSPL-1.0"),
    ("elastic", 2, "Elastic-2.0"),
    ("isc", 0, "ISC"),
    ("zlib", 0, "Zlib zlib-acknowledgement"),
    ("libpng", 0, "Libpng libpng-2.0"),
    ("ofl", 1, "OFL- 1.0 1.1 1.0-RFN 1.1-RFN 1.0-no-RFN 1.1-no-RFN"),
    ("unlicense", 0, "Unlicense"),
    ("wtfpl", 0, "WTFPL"),
    ("artistic", 1, "Artistic- 1.0 1.0-cl8 1.0-Perl 2.0"),
    ("python", 0, "PSF-2.0 Python-2.0 Python-2.0.1 CNRI-Python"),
    ("postgresql", 0, "PostgreSQL"),
    ("ncsa", 0, "NCSA"),
    ("x11", 0, "X11"),
    ("curl", 0, "curl"),
    ("openssl", 0, "OpenSSL"),
    ("php", 0, "PHP- 3.0 3.01"),
    ("ruby", 1, "Ruby"),
    ("vim", 1, "Vim"),
    ("icu", 0, "ICU"),
    ("ftl", 0, "FTL"),
    ("hpnd", 0, "HPND"),
    ("upl", 0, "UPL-1.0"),
    ("ms-pl", 1, "MS-PL"),
    ("ms-rl", 1, "MS-RL"),
    ("lppl", 1, "LPPL- 1.0 1.1 1.2 1.3a 1.3c"),
    ("zpl", 0, "ZPL- 1.1 2.0 2.1"),
    ("ecl", 0, "ECL- 1.0 2.0"),
    ("cecill", 2, "CECILL- 1.0 1.1 2.0 2.1"),
    ("cecill-b", 0, "CECILL-B"),
    ("cecill-c", 1, "CECILL-C"),
    ("mulan", 0, "MulanPSL- 1.0 2.0"),
    ("blueoak", 0, "BlueOak-1.0.0"),
    ("unicode", 0, "Unicode-3.0 Unicode-DFS-2015 Unicode-DFS-2016 Unicode-TOU"),
    ("json", 2, "JSON"),
    ("cc0", 0, "CC0-1.0"),
    ("pddl", 0, "PDDL-1.0"),
    ("odbl", 1, "ODbL-1.0"),
    ("cc-by", 0, "CC-BY- 1.0 2.0 2.5 3.0 4.0"),
    ("cc-by-sa", 1, "CC-BY-SA- 1.0 2.0 2.5 3.0 4.0"),
    ("cc-by-nd", 2, "CC-BY-ND- 1.0 2.0 2.5 3.0 4.0"),
    ("cc-by-nc", 2, "CC-BY-NC- 1.0 2.0 2.5 3.0 4.0"),
    ("cc-by-nc-sa", 2, "CC-BY-NC-SA- 1.0 2.0 2.5 3.0 4.0"),
    ("cc-by-nc-nd", 2, "CC-BY-NC-ND- 1.0 2.0 2.5 3.0 4.0"),
)


def _known(groups) -> dict[str, tuple[str, int]]:
    """Lower-case identifier -> (label, what it asks for)."""
    out = {}
    for label, asks, names in groups:
        first, *rest = names.split()
        for name in [first + version for version in rest] if first.endswith("-") else [first, *rest]:
            out[name.lower()] = (label, asks)
    return out


_KNOWN = _known(IDENTIFIERS)
_VALUE = re.compile(rb"[ \t]*:[ \t]*([^\r\n]*)")
_WORD = re.compile(rb"[^ ]+")
_TOKEN = re.compile(r"\(|\)|[A-Za-z0-9][A-Za-z0-9.+:-]*")
_RANK = {"or": 1, "and": 2, "with": 3}


@dataclass(frozen=True)
class Licence:
    """What an expression comes to: all labels named, and what the cheapest choice asks for."""

    labels: frozenset[str]
    asks: int
    text: str


def _leaf(name: str, known: dict[str, tuple[str, int]]) -> Licence:
    """An identifier, exactly; a plus sign, -only and -or-later may follow."""
    low = name.lower().rstrip(".:-")
    for end in ("", "+", "-only", "-or-later"):
        if low.endswith(end) and (found := known.get(low.removesuffix(end) if end else low)):
            return Licence(frozenset([found[0]]), found[1], name)
    return Licence(frozenset(), 3, name)


def _apply(op: str, left: Licence, right: Licence) -> Licence:
    text = f"({left.text} {op.upper()} {right.text})"
    if op == "with":  # an exception lifts one step of what a copyleft licence asks for
        return Licence(left.labels, max(0, left.asks - 1) if left.asks < 3 else 3, f"{left.text} WITH {right.text}")
    pick = min if op == "or" else max
    return Licence(left.labels | right.labels, pick(left.asks, right.asks), text)


def evaluate(expression: str, known: dict[str, tuple[str, int]] = _KNOWN) -> Licence | None:
    """Shunting-yard over identifiers, AND, OR, WITH and brackets (WITH binds closest, OR loosest).

    What follows a whole expression on the line is ignored, as trailing prose is; None if there is no
    whole expression. Linear in the expression's length.
    """
    values: list[Licence] = []
    ops: list[str] = []

    def reduce() -> bool:
        if len(values) < 2:
            return False
        right, left = values.pop(), values.pop()
        values.append(_apply(ops.pop(), left, right))
        return True

    operand = True
    for match in _TOKEN.finditer(expression):
        token = match[0]
        low = token.lower()
        if token == "(":
            if not operand:
                break
            ops.append(token)
        elif token == ")":
            if operand or "(" not in ops:
                break
            while ops[-1] != "(":
                if not reduce():
                    return None
            ops.pop()
        elif low in _RANK:
            if operand:
                return None
            while ops and ops[-1] != "(" and _RANK[ops[-1]] >= _RANK[low]:
                if not reduce():
                    return None
            ops.append(low)
            operand = True
        else:
            if not operand:
                break
            values.append(_leaf(token, known))
            operand = False
    if operand:
        return None
    while ops:
        if ops[-1] == "(" or not reduce():
            return None
    return values[0] if len(values) == 1 else None


def _automaton() -> ahocorasick.Automaton:
    out = ahocorasick.Automaton()
    for phrase in {**BASE_PHRASES, **NOTICE_PHRASES, **dict.fromkeys(TAG_PHRASES)}:
        out.add_word(f" {phrase} ", (phrase, phrase.count(" ") + 1))
    out.make_automaton()
    return out


_WORDS_ONLY = np.where(_PUNCT[_LOWER], 32, _LOWER).astype(np.uint8).tobytes()


def scan_text(text: str | None, automaton: ahocorasick.Automaton, known: dict[str, tuple[str, int]] = _KNOWN) -> tuple:
    """(n_words, n_base, first_word, last_word, base_labels, labels, score, expressions, asks)."""
    raw = (text or "").encode("utf-8", "surrogatepass")
    spaced = raw.translate(_WORDS_ONLY)
    words = spaced.split()  # all other white space has become blanks
    flat = f" {b' '.join(words).decode('latin-1')} "
    base, labels, tags, places, done, at = set(), {}, [], [], 0, 0
    for end, (phrase, length) in automaton.iter(flat):
        done += flat.count(" ", at, end)  # spaces before the one that ends the phrase: words so far
        at = end
        if phrase in BASE_PHRASES:
            places.append(done - length)
            base.add(BASE_PHRASES[phrase])
            labels.setdefault(BASE_PHRASES[phrase], 0.5)
        elif phrase in NOTICE_PHRASES:
            labels.setdefault(NOTICE_PHRASES[phrase], 0.5)
        else:
            tags.append(done - 1)
    found = []
    if tags:
        # an expression starts after its tag's last word and a colon
        ends = [m.end() for m in _WORD.finditer(spaced)]
        values = (_VALUE.match(raw, ends[i]) for i in tags)
        found = [x for v in values if v and (x := evaluate(v[1].decode("utf-8", "replace"), known))]
    for x in found:
        labels |= dict.fromkeys(x.labels, 0.1)
    doubt = float(np.prod(list(labels.values()))) if labels else 1.0
    return (len(words), len(places), min(places, default=None), max(places, default=None), ",".join(sorted(base)), ",".join(sorted(labels)), 1.0 - doubt, [x.text for x in found], max((x.asks for x in found), default=None))


def scan_licenses(df: DataFrame, *, identifiers: tuple[tuple[str, int, str], ...] = (), doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score, expressions, asks.

    Words are lower-cased runs of a-z, 0-9 and non-ASCII characters. n_base counts every place where a
    base phrase's words stand consecutively (places may overlap); first_word and last_word are the
    smallest and largest starts, from 0. labels add those of notices and of tags' expressions. score
    is 1 minus the product of the labels' doubts: 0.5 from a phrase, 0.1 from a tag. asks is the
    strictest outcome over the text's expressions (0 permissive to 2 strong, 3 unknown licence).
    identifiers adds to IDENTIFIERS, in its form; identifiers in neither give no label.

    Null and empty texts: no words, no labels, score 0. Malformed expressions give nothing. Texts of
    any length are read whole; rows that repeat give equal rows, and a null doc_id stays null. Labels
    found in several ways count once, by the surest (ties alike). Empty tables give no rows; other
    columns are ignored.
    """
    ship(df.sparkSession)
    known = _KNOWN | _known(identifiers)

    def rows(batches):
        automaton = _automaton()
        for batch in batches:
            for start in range(0, batch.num_rows, 1024):
                part = batch.slice(start, 1024)
                out = list(zip(*(scan_text(t.as_py(), automaton, known) for t in part.column(1)), strict=True))
                yield pa.RecordBatch.from_arrays([part.column(0), *(pa.array(v, t) for v, t in zip(out, _TYPES, strict=True))], ["doc_id", *_NAMES])

    schema = "doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double, expressions array<string>, asks int"
    return df.select(F.col(doc_id).cast("long"), F.col(text)).mapInArrow(rows, schema)


_NAMES = ["n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score", "expressions", "asks"]
_TYPES = [pa.int64()] * 4 + [pa.string(), pa.string(), pa.float64(), pa.list_(pa.string()), pa.int32()]
