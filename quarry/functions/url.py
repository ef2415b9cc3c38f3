"""URL functions: Column -> Column, all inside whole-stage code generation."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .. import terms


def _any(text: Column, parts: list[str]) -> Column:
    out = F.lit(False)
    for p in parts:
        out = out | text.contains(p)
    return out


def _kept_pairs(query: Column) -> Column:
    tracking = "^(" + "|".join(terms.TRACKING_PREFIXES) + ")"
    pairs = F.filter(F.split(query, "&"), lambda p: (p != "") & ~F.lower(F.substring_index(p, "=", 1)).rlike(tracking))
    return F.nullif(F.array_join(pairs, "&"), F.lit(""))


def norm_url_loose(url: Column) -> Column:
    """Drop empty and tracking pairs from the query, which starts at the first "?"; null: ""."""
    url = F.coalesce(url, F.lit(""))
    at = F.instr(url, "?")
    return F.when(at == 0, url).otherwise(F.concat_ws("?", F.substring_index(url, "?", 1), _kept_pairs(F.substr(url, at + 1))))


def _parts(url: Column) -> tuple[Column, Column, Column, Column]:
    """Scheme, authority, path without ;params of the last segment, query."""
    grab = lambda i: F.regexp_extract(url, r"^(?i:(https?))://([^/?#]*)([^?#]*)(?:\?([^#]*))?", i)
    return F.lower(grab(1)), grab(2), F.regexp_replace(grab(3), r";[^/]*$", ""), grab(4)


def norm_url_strict(url: Column) -> Column:
    """scheme://host/path?query without fragment, ;params and tracking pairs; "" unless http(s) with a host."""
    url = F.coalesce(url, F.lit(""))
    scheme, host, path, query = _parts(url)
    whole = F.concat(scheme, F.lit("://"), host, F.when(path == "", "/").otherwise(path), F.coalesce(F.concat(F.lit("?"), _kept_pairs(query)), F.lit("")))
    return F.when((scheme == "") | (host == ""), "").otherwise(whole)


def host(url: Column) -> Column:
    """Lower-case authority without a leading "www."."""
    return F.regexp_replace(F.lower(F.regexp_extract(F.coalesce(url, F.lit("")), r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)", 1)), r"^www\.", "")


def allowed_host(url: Column, domains: list[str] = terms.BOARD_DOMAINS) -> Column:
    h = host(url)
    return (h != "") & ~h.isin(*terms.NON_JOB_DOMAINS) & h.isin(*domains)


def _without_dots(path: Column) -> Column:
    """A path without "." and ".." segments; those that lead above the root are dropped."""
    parts = F.split(path, "/")
    last = F.element_at(parts, -1)
    nothing = F.array().cast("array<string>")
    kept = F.aggregate(
        F.slice(parts, 2, F.greatest(F.size(parts) - 1, F.lit(0))), nothing,
        lambda out, s: F.when(s == "..", F.slice(out, 1, F.greatest(F.size(out) - 1, F.lit(0)))).when(s == ".", out).otherwise(F.concat(out, F.array(s))),
    )
    # a last "." or ".." names a folder
    return F.concat(F.lit("/"), F.array_join(kept, "/"), F.when(last.isin(".", "..") & (F.size(kept) > 0), "/").otherwise(""))


def absolute_url(link: Column, base: Column) -> Column:
    """A link as seen from a page: with its own scheme as it is; "//", "/", "?" and "#" forms; and names
    relative to the page's folder, in which "." and ".." are resolved."""
    origin = F.regexp_extract(base, r"^(\w+://[^/?#]*)", 1)
    path = F.regexp_extract(base, r"^\w+://[^/?#]*([^?#]*)", 1)
    folder = F.coalesce(F.nullif(F.regexp_extract(path, r"^(.*/)", 1), F.lit("")), F.lit("/"))
    scheme = F.regexp_extract(base, r"^(\w+:)", 1)
    own, rest = F.regexp_extract(link, r"^([^?#]*)", 1), F.regexp_extract(link, r"^[^?#]*(.*)$", 1)
    whole = F.when(own.startswith("/"), own).otherwise(F.concat(folder, own))
    plain = ~whole.rlike(r"(^|/)\.\.?(/|$)")
    return (
        F.when(link.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*:"), link)
        .when(link.startswith("//"), F.concat(scheme, link))
        .when(link == "", base)
        .when(link.startswith("?"), F.concat(F.regexp_extract(base, r"^([^?#]*)", 1), link))
        .when(link.startswith("#"), F.concat(F.regexp_extract(base, r"^([^#]*)", 1), link))
        .otherwise(F.concat(origin, F.when(plain, whole).otherwise(_without_dots(whole)), rest))
    )


def priority_tier(url: Column, domains: list[str] = terms.PRIORITY_DOMAINS) -> Column:
    """Index of the first domain that the URL contains; the list's length if none."""
    out = F.lit(len(domains))
    for i in reversed(range(len(domains))):
        out = F.when(url.contains(domains[i]), i).otherwise(out)
    return out


def _segments(url: Column) -> Column:
    return F.filter(F.split(_parts(url)[2], "/"), lambda s: s != "")


def looks_job_url(url: Column, title: Column, text: Column) -> Column:
    """Whether a URL is one posting, by its host, shape, title and link text; the first rule that applies decides."""
    clean = norm_url_strict(url)
    low, title, text = F.lower(clean), F.lower(F.coalesce(title, F.lit(""))), F.lower(F.coalesce(text, F.lit("")))
    authority = F.lower(_parts(clean)[1])
    ats = authority.contains("jobs.lever.co") | authority.contains("jobs.ashbyhq.com")
    depth = F.size(_segments(clean))
    signal = _any(title, terms.JOB_TITLE_SIGNALS) | _any(text, terms.JOB_LINK_TEXT_SIGNALS)
    return (
        F.when((clean == "") | ~allowed_host(clean), False)
        .when(_any(low, terms.AGGREGATE_MARKERS), False)
        .when(_parts(clean)[2].rlike(r"(?i)-jobs(-in-[a-z-]+)?(/?$|\?)"), False)
        .when(title.rlike(r"^\d[\d,]*\s+.*job\s+vacanc"), False)
        .when(low.rlike("|".join(terms.JOB_URL_PATTERNS)), True)
        .when(ats & (depth >= 2), True)
        .otherwise(signal & (depth >= 1))
    )


def _slash_parts(url: Column) -> Column:
    return F.split(F.element_at(F.split(url, "://"), -1), "/")


def is_aggregate_page(url: Column, title: Column) -> Column:
    """Whether a search result is a list of postings; social sites and "" are not."""
    url = F.coalesce(url, F.lit(""))
    low, title = F.lower(url), F.lower(F.coalesce(title, F.lit("")))
    segment = F.lit(False)
    for p in terms.PAGE_BAD_SEGMENTS:
        segment = segment | low.contains(f"/{p}/") | low.contains(f"/{p}?") | low.endswith(f"/{p}")
    return (
        F.when((url == "") | _any(low, terms.NON_JOB_DOMAINS), False)
        .when(low.contains("-jobs") & ~low.contains("/job/") & ~low.contains("/jobs/"), True)
        .when(low.contains("jobs.html") | low.contains("-jobs-"), True)
        .when((F.size(_slash_parts(url)) <= 2) & low.contains("jobs"), True)
        .otherwise(segment | _any(title, terms.PAGE_BAD_TITLES))
    )


def is_individual_job_url(url: Column, title: Column) -> Column:
    url = F.coalesce(url, F.lit(""))
    low, parts = F.lower(url), _slash_parts(url)
    return (
        F.when(_any(low, terms.NON_JOB_DOMAINS) | is_aggregate_page(url, title), False)
        .when(low.contains("/job/") | low.contains("/jobs/view/") | low.contains("/internship/detail/"), True)
        .when(low.contains("greenhouse.io") & low.contains("jobs") & (F.size(parts) >= 4), True)
        .otherwise((F.size(parts) > 2) & (F.length(F.element_at(parts, -1)) > 5))
    )


def video_id(url: Column) -> Column:
    first = lambda p: F.nullif(F.regexp_extract(url, p, 1), F.lit(""))
    return F.coalesce(first(r"[?&]v=([A-Za-z0-9_-]{11})"), first(r"youtu\.be/([A-Za-z0-9_-]{11})"), F.lit(""))


def channel_ref(url: Column) -> Column:
    """STRUCT<kind, id>: a channel id, a handle or a user name in a channel URL."""
    first = lambda p: F.nullif(F.regexp_extract(url, p, 1), F.lit(""))
    by_id, handle, user = first(r"/channel/([A-Za-z0-9_-]+)"), first(r"/@([A-Za-z0-9._-]+)"), first(r"/(?:c|user)/([A-Za-z0-9._-]+)")
    kind = F.when(by_id.isNotNull(), "id").when(handle.isNotNull(), "handle").when(user.isNotNull(), "user")
    return F.struct(kind.alias("kind"), F.coalesce(by_id, handle, user).alias("id"))
