"""Text functions: Column -> Column."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .. import terms
from .matching import Wanted, term_counts, terms_in
from .url import _any, absolute_url, host

_MARKDOWN_LINK = r"!?\[([^\]]*)\]\([^)]*\)"


def first_email(text: Column) -> Column:
    return F.regexp_extract(F.coalesce(text, F.lit("")), terms.EMAIL_PATTERN, 0)


def company_domain(name: Column) -> Column:
    """Lower-case name without company suffixes (removed wherever they stand, in turn) and punctuation, plus ".com"."""
    out = F.trim(F.lower(F.coalesce(name, F.lit(""))))
    for suffix in terms.COMPANY_SUFFIXES:
        out = F.replace(out, F.lit(suffix), F.lit(""))
    out = F.regexp_replace(out, "[^a-z0-9]", "")
    return F.when(out == "", "").otherwise(F.concat(out, F.lit(".com")))


#: Up to so many terms are searched for one by one in generated code: a search ends at its first hit, and no text leaves the JVM.
FEW = 20


def term_hits(text: Column, wanted: list[str]) -> Column:
    """Those terms that the (lower-case) text contains as substrings, in list order."""
    if len(wanted) > FEW:
        return terms_in(text, wanted)
    return F.filter(F.array(*(F.lit(t) for t in wanted)), lambda t: F.contains(text, F.lower(t)))


def _count(text: Column, wanted: list[str], words: bool) -> Column:
    return F.when(text.isNotNull(), term_counts([text], {"n": Wanted(wanted, words=words)}).getField("n"))


def count_hits(text: Column, wanted: list[str]) -> Column:
    """How many of the terms the text contains."""
    if len(wanted) > FEW:
        return _count(text, wanted, words=False)
    out = F.lit(0)
    for t in wanted:
        out = out + text.contains(t.lower()).cast("int")
    return out


def count_word_hits(text: Column, wanted: list[str]) -> Column:
    """How many of the terms stand in the text between word boundaries (letters of any script count as word characters)."""
    if len(wanted) > FEW:
        return _count(text, wanted, words=True)
    out = F.lit(0)
    for t in wanted:
        # a plain search rules out most texts before the slower pattern is tried
        out = out + (text.contains(t.lower()) & text.rlike(rf"(^|[^\p{{L}}\p{{N}}_])\Q{t.lower()}\E([^\p{{L}}\p{{N}}_]|$)")).cast("int")
    return out


def any_term(text: Column, wanted: list[str]) -> Column:
    if len(wanted) > FEW:
        return count_hits(text, wanted) > 0
    return _any(text, [t.lower() for t in wanted])


def strip_markdown_links(text: Column) -> Column:
    """[text](url) and ![alt](url) down to the text, also where they are nested, however deep.

    Each pass takes away one level at least, so as many passes as "](" are left are enough; texts that
    three passes have cleared, nearly all, need no more.
    """
    once = lambda t: F.regexp_replace(t, _MARKDOWN_LINK, "$1")
    out = once(once(once(text)))
    left = ((F.length(out) - F.length(F.replace(out, F.lit("]("), F.lit("")))) / 2).cast("int")
    return F.trim(F.when(left > 0, F.aggregate(F.array_repeat(F.lit(0), left), out, lambda t, _: once(t))).otherwise(out))


def _good_title(title: Column) -> Column:
    return ~F.lower(title).isin(*terms.NAV_TITLES) & F.length(title).between(3, 160)


def page_title(markdown: Column, given: Column) -> Column:
    """The page's own title if it is a real one, else the first line that is, else the given one or a default."""
    given = strip_markdown_links(F.trim(F.coalesce(given, F.lit(""))))
    lines = F.transform(F.split(F.coalesce(markdown, F.lit("")), r"\r\n|[\n\r]"), lambda s: strip_markdown_links(F.trim(F.regexp_replace(F.trim(s), "^#+", ""))))
    first = F.get(F.filter(lines, _good_title), F.lit(0))
    return F.when(_good_title(given), given).otherwise(F.coalesce(first, F.nullif(given, F.lit("")), F.lit("Software Engineer")))


def _capitalise(text: Column) -> Column:
    return F.concat(F.upper(F.substring(text, 1, 1)), F.lower(F.substring(text, 2, 1 << 30)))


def company_from_title(title: Column, url: Column) -> Column:
    """The segment before "... years of experience", else what follows the first " at ", " - " or " | ", else the host's first label."""
    parts = F.filter(F.transform(F.split(title, " - "), lambda s: F.trim(s)), lambda p: p != "")
    before = F.try_element_at(parts, F.lit(-2))
    three = (F.size(parts) >= 3) & F.try_element_at(parts, F.lit(-1)).rlike(r"(?i)years? of experience|yrs? of experience") & F.length(before).between(2, 79)
    out = _capitalise(F.substring_index(host(url), ".", 1))
    for sep in (" | ", " - ", " at "):
        tail = F.btrim(F.substr(title, F.instr(title, sep) + len(sep)), F.lit(" -|"))
        out = F.when(title.contains(sep) & F.length(tail).between(2, 79), tail).otherwise(out)
    return F.when(three, before).otherwise(out)


def company_from_result(title: Column, url: Column) -> Column:
    """The second piece by the first separator that gives a name, else the host's first label."""
    out = _capitalise(F.regexp_extract(url, r"https?://(?:www\.)?([^./]+)\.", 1))
    for sep in (" | ", " - ", " at "):
        piece = F.btrim(F.split_part(title, F.lit(sep), F.lit(2)), F.lit(" -|"))
        out = F.when(title.contains(sep) & F.length(piece).between(2, 59), piece).otherwise(out)
    return out


def location_guess(text: Column, places: list[str] = terms.PREFERRED_LOCATIONS) -> Column:
    low, out = F.lower(F.coalesce(text, F.lit(""))), F.lit("India")
    for place in reversed(places):
        out = F.when(low.contains(place.lower()), place).otherwise(out)
    return out


def links_in_text(text: Column) -> Column:
    """Distinct markdown and bare links, in order of position by kind."""
    marked = F.transform(F.regexp_extract_all(text, F.lit(r"\[[^\]]*\]\(([^)]*)\)"), F.lit(1)), lambda s: F.trim(s))
    bare = F.transform(F.regexp_extract_all(text, F.lit(terms.URL_PATTERN), F.lit(0)), lambda u: F.rtrim(u, F.lit(").,;:")))
    return F.array_distinct(F.concat(marked, bare))


def job_links(text: Column, fallback: Column) -> Column:
    """ARRAY<STRUCT<url, title>>: links of each line but social ones, first sight kept, titled by the rest of their line."""
    blocked = lambda u: _any(F.lower(u), terms.NON_JOB_LINKS)
    per_line = F.transform(
        F.split(F.coalesce(text, F.lit("")), "\n"),
        lambda line: F.transform(
            F.regexp_extract_all(line, F.lit(terms.URL_PATTERN), F.lit(0)),
            lambda raw: F.struct(F.rtrim(raw, F.lit(").,;:")).alias("url"), F.coalesce(F.nullif(F.btrim(F.replace(line, raw, F.lit("")), F.lit(" -:|\t•—")), F.lit("")), fallback).alias("title")),
        ),
    )
    found = F.filter(F.flatten(per_line), lambda x: ~blocked(x["url"]))
    nothing = F.filter(found, lambda x: F.lit(False))
    return F.aggregate(found, nothing, lambda kept, x: F.when(F.exists(kept, lambda y: y["url"] == x["url"]), kept).otherwise(F.concat(kept, F.array(x))))


def harvested_links(markdown: Column, base: Column, found: Column) -> Column:
    """ARRAY<STRUCT<href, text>>: a page's markdown links, made absolute, then those that the fetcher
    found (ARRAY<STRUCT<href, text>>, internal before external ones); without an address: left out."""
    pattern = r"\[([^\]]+)\]\(([^)]+)\)"
    text = lambda i: F.transform(F.regexp_extract_all(F.coalesce(markdown, F.lit("")), F.lit(pattern), F.lit(i)), lambda s: F.trim(s))
    pairs = F.zip_with(text(2), text(1), lambda href, label: F.struct(absolute_url(href, base).alias("href"), label.alias("text")))
    given = F.transform(F.coalesce(found, F.array().cast("array<struct<href:string,text:string>>")), lambda x: F.struct(x["href"].alias("href"), x["text"].alias("text")))
    return F.filter(F.concat(pairs, given), lambda x: F.coalesce(x["href"] != "", F.lit(False)))


def error_class(message: Column, kind: Column) -> Column:
    """Class of a failure by its message and exception name; the first rule that applies decides."""
    text, name = F.lower(F.coalesce(message, F.lit(""))), F.lower(F.coalesce(kind, F.lit("")))
    return (
        F.when(name.contains("notconfigured"), "NOT_CONFIGURED")
        .when(name.contains("sourcedisabled"), "DISABLED")
        .when(text.contains("timeout") | name.contains("timeout"), "TIMEOUT")
        .when(_any(text, ["403", "forbidden"]), "HTTP_403")
        .when(_any(text, ["429", "too many requests", "rate limit"]), "HTTP_429")
        .when(_any(text, ["401", "unauthorized", "authentication", "api key"]), "AUTH_ERROR")
        .when(_any(text, ["500", "502", "503", "504", "server error"]), "HTTP_5XX")
        .when(_any(name, ["connection", "request", "network"]), "NETWORK_ERROR")
        .when(_any(text, ["blocked", "captcha", "bot detection", "robot"]), "BLOCKED")
        .when(_any(text, ["json", "parse", "parser", "schema"]), "PARSER_ERROR")
        .otherwise("UNKNOWN_ERROR")
    )


def is_permanent_error(message: Column) -> Column:
    return _any(F.lower(F.coalesce(message, F.lit(""))), terms.PERMANENT_ERRORS)


def is_job_text(text: Column, least: int = 250) -> Column:
    clean = F.trim(F.coalesce(text, F.lit("")))
    return (F.length(clean) >= least) & _any(F.lower(clean), terms.JOB_TEXT_SIGNALS)


def is_anti_bot(text: Column) -> Column:
    clean = F.trim(F.coalesce(text, F.lit("")))
    return F.length(clean).between(1, 399) & _any(F.lower(clean), terms.ANTI_BOT_SIGNALS)


def is_valid_detail(text: Column) -> Column:
    text = F.coalesce(text, F.lit(""))
    low = F.lower(text)
    return F.when((text == "") | _any(low, terms.DETAIL_BAD_SIGNALS), False).when(F.length(text) < 500, True).otherwise(_any(low, terms.DETAIL_SIGNALS))


def normalise_key(key: Column) -> Column:
    return F.regexp_replace(F.lower(key), r"[^\p{L}\p{N}]", "")


def slug(text: Column) -> Column:
    return F.replace(F.lower(text), F.lit(" "), F.lit("-"))


def md5_mod5(key: Column) -> Column:
    """md5(key) mod 5: 16 is 1 mod 5, so the sum of the hex digits mod 5."""
    digits = F.transform(F.filter(F.split(F.md5(key), ""), lambda c: c != ""), lambda c: F.conv(c, 16, 10).cast("bigint"))
    return (F.aggregate(digits, F.lit(0).cast("bigint"), lambda a, c: a + c) % 5).cast("int")


def rotate_query(term: Column, place: Column, as_of: Column) -> Column:
    """One of five wordings of a query, by term, place and day."""
    key = F.concat_ws(":", term, place, as_of.cast("string"))
    n = md5_mod5(key)
    out = F.concat_ws(" ", term, F.lit("walk-in"), place)
    wordings = [[term, F.lit("fresher jobs"), place], [term, F.lit("0-2 years"), place], [term, place, F.lit("fresher")], [term, F.lit("hiring"), place]]
    for i, words in enumerate(wordings):
        out = F.when(n == i, F.concat_ws(" ", *words)).otherwise(out)
    return out
