"""Batch fetching on the executors, with failures as rows, fallback, retries and a probe."""

from __future__ import annotations

import concurrent.futures as cf
import time
from collections.abc import Callable, Iterator
from functools import reduce

import pandas as pd
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .. import terms
from ..functions.text import company_from_title, harvested_links, is_anti_bot, is_job_text, links_in_text, location_guess, page_title
from ..functions.url import absolute_url, allowed_host, host, looks_job_url, norm_url_strict
from ..operators.metrics import discovery_totals, seed_status
from ..session import materialise, ship
from .readers import search_web, wanted_details

Fetcher = Callable[[str], str]
PAGE = "url string, markdown string, error string, seconds double"


def with_timeout(call: Callable[[], str], seconds: float) -> str:
    """The call's result, or TimeoutError; a call that hangs does not hold up the caller."""
    pool = cf.ThreadPoolExecutor(1)
    try:
        return pool.submit(call).result(timeout=seconds)
    finally:
        pool.shutdown(wait=False, cancel_futures=True)


def with_retries(call: Callable[[], str], tries: int = 3, wait: float = 2.0, sleep: Callable[[float], None] = time.sleep) -> str:
    """The first result of up to so many tries; waits double."""
    for k in range(tries):
        try:
            return call()
        except Exception:
            if k == tries - 1:
                raise
            sleep(wait * 2**k)
    raise ValueError("tries must be positive")


def fetch_urls(urls: DataFrame, fetcher: Fetcher, *, concurrency: int = 4, timeout: float = 30.0, url: str = "url") -> DataFrame:
    """(url, markdown, error, seconds) of each distinct non-empty URL; a failure is a row, not an exception.

    concurrency is the number of tasks, so a slow site holds up one of them.
    """
    ship(urls.sparkSession)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for u in batch["url"]:
                start = time.monotonic()
                try:
                    text, error = with_timeout(lambda u=u: fetcher(u), timeout), None
                except Exception as e:
                    text, error = None, f"{type(e).__name__}: {e}"
                out.append((u, text, error, time.monotonic() - start))
            yield pd.DataFrame(out, columns=["url", "markdown", "error", "seconds"])

    some = urls.select(F.col(url).alias("url")).where("url IS NOT NULL AND url <> ''").distinct()
    return some.repartition(concurrency, "url").mapInPandas(run, PAGE)


def fetch_until_blocked(urls: DataFrame, fetcher: Fetcher, *, limit: int = 3, blocked: str = "406", timeout: float = 30.0, order: str = "ord", url: str = "url") -> DataFrame:
    """(ord, url, markdown, error, seconds) in order, until limit requests in a row were blocked: the rest is not asked.

    Blocked: a failure whose text contains blocked; other failures count neither way, an answer starts over. What a
    site allows depends on the requests before, so this is one task by nature, for lists of search pages.
    """
    ship(urls.sparkSession)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        run_of = 0
        for batch in batches:
            out = []
            for at, u in zip(batch["ord"], batch["url"], strict=True):
                if run_of >= limit:
                    break
                start = time.monotonic()
                try:
                    text, error, run_of = with_timeout(lambda u=u: fetcher(u), timeout), None, 0
                except Exception as e:
                    text, error = None, f"{type(e).__name__}: {e}"
                    run_of += blocked in error
                out.append((at, u, text, error, time.monotonic() - start))
            yield pd.DataFrame(out, columns=["ord", "url", "markdown", "error", "seconds"])

    rows = urls.select(F.col(order).cast("long").alias("ord"), F.col(url).alias("url")).where("url IS NOT NULL AND url <> ''")
    return rows.coalesce(1).sortWithinPartitions("ord").mapInPandas(run, "ord long, " + PAGE)


PROVIDERS = ("auto", "first", "second")


def fetch_with_fallback(urls: DataFrame, first: Fetcher, second: Fetcher, *, provider: str = "auto", **options) -> DataFrame:
    """Pages by the first fetcher and, for URLs that it brought nothing for, by the second; or by one of them alone."""
    if provider not in PROVIDERS:
        raise ValueError(f"provider must be one of {', '.join(PROVIDERS)}")
    if provider != "auto":
        return fetch_urls(urls, first if provider == "first" else second, **options)
    got = materialise(fetch_urls(urls, first, **options), "fetched")
    good = F.coalesce(F.trim("markdown") != "", F.lit(False))
    return got.where(good).unionByName(fetch_urls(got.where(~good).select("url"), second, **options))


def probe(spark: SparkSession, fetcher: Fetcher, url: str, least: int = 50) -> bool:
    """Whether a fetcher brings a page of some length."""
    row = fetch_urls(spark.createDataFrame([(url,)], "url string"), fetcher, concurrency=1).first()
    return len(row.markdown or "") >= least


def crawl(seeds: DataFrame, fetcher: Fetcher, *, depth: int = 2, pages: int = 20, width: int = 5, most_seeds: int = terms.CRAWL_SEEDS, keywords: tuple[str, ...] = tuple(terms.CRAWL_KEYWORDS), weight: float = terms.CRAWL_WEIGHT, domains: list[str] = terms.BOARD_DOMAINS, **options) -> DataFrame:
    """Best-first discovery from (url) seeds on allowed hosts: (seed, url, markdown, error, seconds, depth, score).

    Seeds on other hosts go before the first most_seeds are taken. Every seed has a budget of its own of
    so many pages, and a frontier of links on its host that were met and not fetched, of any depth up to
    depth. Links are scored by the share of keywords they have, times weight. Round by round each seed's
    width best links are fetched (ties: less deep ones, then by address), so a promising page deep in the
    site goes before a dull one near its root; with a width of 1 each page is chosen knowing all before it.
    Frontier and pages of a round are written before the next, so nothing is fetched twice for a seed.
    """
    hits = lambda c: sum((F.lower(c).contains(k).cast("int") for k in keywords), F.lit(0))
    score = lambda c: hits(F.regexp_replace(c, "[-_/+]", " ")) * (weight / max(1, len(keywords)))
    start = seeds.select(norm_url_strict(F.col("url")).alias("url")).where("url <> ''").where(allowed_host(F.col("url"), domains)).distinct()
    start = start.orderBy("url").limit(most_seeds)
    frontier = materialise(start.select(F.col("url").alias("seed"), "url", F.lit(0).alias("depth"), score(F.col("url")).alias("score")), "frontier")
    fetched, rounds = None, []
    while True:
        left = frontier if fetched is None else frontier.join(fetched.select("seed", "url"), ["seed", "url"], "left_anti")
        spent = frontier.select("seed").distinct().withColumn("spent", F.lit(0)) if fetched is None else fetched.groupBy("seed").agg(F.count("*").alias("spent"))
        nth = F.row_number().over(Window.partitionBy("seed").orderBy(F.desc("score"), "depth", "url"))
        best = left.withColumn("nth", nth).where(F.col("nth") <= width).join(spent, "seed").where(F.col("nth") <= pages - F.col("spent"))
        best = materialise(best.select("seed", "url", "depth", "score"), "best")
        if best.isEmpty() and rounds:
            return fetched
        got = best.join(fetch_urls(best, fetcher, **options), "url")
        rounds.append(materialise(got.select("seed", "url", "markdown", "error", "seconds", "depth", "score"), "crawl"))
        fetched = reduce(lambda a, b: a.unionByName(b), rounds)
        if best.isEmpty():
            return fetched
        links = rounds[-1].where((F.col("depth") < depth) & F.col("markdown").isNotNull()).select("seed", "url", "depth", F.explode(links_in_text(F.col("markdown"))).alias("link"))
        found = links.select("seed", norm_url_strict(absolute_url(F.col("link"), F.col("url"))).alias("url"), (F.col("depth") + 1).alias("depth")).where("url <> ''")
        found = found.where((host(F.col("url")) == host(F.col("seed"))) & allowed_host(F.col("url"), domains)).groupBy("seed", "url").agg(F.min("depth").alias("depth"))
        new = found.join(frontier, ["seed", "url"], "left_anti").select("seed", "url", "depth", score(F.col("url")).alias("score"))
        frontier = frontier.unionByName(materialise(new, "frontier"))


def discover(seeds: DataFrame, fetcher: Fetcher, *, enabled: bool = True, most: int = terms.CRAWL_ROWS, **options) -> tuple[DataFrame, DataFrame]:
    """(listings, diagnostics by seed) of a crawl. Fails if every seed failed, or if none had a candidate.

    A page that looks like a posting, by its address, is a candidate; so is each link to one.
    A candidate with a posting's text is a listing; the first of each address stays, most in all.
    """
    spark = seeds.sparkSession
    if not enabled:
        raise SourceDisabled("discovery is switched off")
    pages = crawl(seeds, fetcher, **options)
    title = page_title(F.col("markdown"), F.lit(""))
    own = pages.where("markdown IS NOT NULL").withColumn("title", title).withColumn("anti_bot", is_anti_bot(F.col("markdown")))
    own = own.withColumn("candidate", ~F.col("anti_bot") & looks_job_url(F.col("url"), F.lit(""), F.lit("")))
    links = own.where(~F.col("anti_bot")).select("seed", F.explode(harvested_links(F.col("markdown"), F.col("url"), F.lit(None).cast("array<struct<href:string,text:string>>"))).alias("l"))
    linked = links.where(looks_job_url(F.col("l.href"), F.col("l.text"), F.col("l.text"))).groupBy("seed").agg(F.count("*").alias("linked"))
    rows = own.where(F.col("candidate") & is_job_text(F.col("markdown")))
    rows = materialise(rows.withColumn("nth", F.row_number().over(Window.partitionBy("url").orderBy("depth", "seed"))).where("nth = 1").orderBy("depth", "url").limit(most).drop("nth"), "found")
    per = pages.groupBy("seed").agg(F.count_if(F.col("error").isNull()).alias("good"), F.count("*").alias("pages"))
    seen = own.groupBy("seed").agg(F.count_if("candidate").alias("own"), F.max("anti_bot").alias("anti_bot"))
    seed = per.join(seen, "seed", "left").join(linked, "seed", "left").join(rows.groupBy("seed").agg(F.count("*").alias("rows")), "seed", "left").na.fill(0).na.fill(False)
    seed = seed.select("seed", (F.col("good") > 0).alias("ok"), "pages", "rows", (F.col("own") + F.col("linked")).alias("candidates"), "anti_bot")
    seed = materialise(seed.withColumn("status", seed_status(F.col("anti_bot"), F.col("ok"), F.col("candidates"), F.col("rows"))), "seeds")
    problem = discovery_totals(seed).first().problem
    if problem:
        raise RuntimeError(f"discovery: {problem}")
    out = rows.select(
        F.col("url").alias("job_url"), "title", company_from_title(F.col("title"), F.col("url")).alias("company"),
        location_guess(F.concat_ws("\n", "title", F.substring("markdown", 1, 1200))).alias("location"), F.substring("markdown", 1, 6000).alias("description"), F.lit("discovery").alias("source"),
    )
    return spark.createDataFrame([], out.schema) if rows.isEmpty() else out, seed


class SourceDisabled(RuntimeError):
    """A source that is switched off."""


class NotConfigured(RuntimeError):
    """A source that lacks a key or a program."""


def required(value: str | None, name: str) -> str:
    """A setting that a source cannot do without."""
    if not value:
        raise NotConfigured(f"{name} is not set")
    return value


#: (query, most results) -> results with url, title, markdown and description.
Search = Callable[[str, int], list[dict]]
RESULT = "query int, nth int, url string, title string, markdown string, description string, error string"


def search_queries(queries: DataFrame, search: Search, *, limit: int = 10, concurrency: int = 4, timeout: float = 30.0) -> DataFrame:
    """Results of (query INT, text) rows: query, nth and a result's fields, with at most limit (100 at most) of each
    query; a query that fails is one row with an error, and stops no other."""
    ship(queries.sparkSession)
    limit = max(1, min(limit, 100))
    names = ("url", "title", "markdown", "description")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for number, text in zip(batch["query"], batch["text"], strict=True):
                try:
                    found = with_timeout(lambda text=text: search(text, limit), timeout)[:limit]
                    out += [(number, i, *(r.get(n) for n in names), None) for i, r in enumerate(found)]
                except Exception as e:
                    out.append((number, -1, None, None, None, None, f"{type(e).__name__}: {e}"))
            yield pd.DataFrame(out, columns=["query", "nth", *names, "error"])

    return queries.select("query", "text").repartition(concurrency, "query").mapInPandas(run, RESULT)


def web_search(queries: DataFrame, search: Search, fetcher: Fetcher, as_of: Column, *, enabled: bool = True, key: str | None = "", caps: dict[str, int] = terms.SEARCH_CAPS, **options) -> DataFrame:
    """Listings of a whole web search: queries are asked in order, lists among the results are followed, and
    the pages that they bring within the caps are fetched once. See search_web() for what counts."""
    if not enabled:
        raise SourceDisabled("web search is switched off")
    if key is not None:
        required(key, "the search key")
    asked = queries.where(F.col("query") < caps["queries"])
    results = materialise(search_queries(asked, search, limit=min(caps["results"], caps["total"])), "results").where("error IS NULL")
    pages = materialise(fetch_urls(wanted_details(results, caps), fetcher, **options), "details")
    return search_web(results, pages.select("url", F.lit(None).cast("string").alias("title"), "markdown"), as_of, caps=caps)


def seen_urls(spark: SparkSession, *paths: str) -> DataFrame:
    """Distinct job_url of the first table that exists, else none.

    A table that exists but cannot be read is an error: with an empty history everything would be sent again.
    """
    for path in paths:
        try:
            return spark.read.parquet(path).select("job_url").distinct()
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
    return spark.createDataFrame([], "job_url string")
