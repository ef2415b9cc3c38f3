"""Sources: landed responses of listing services, parsed into listings.

Fetching is not part of a query: each service's responses land as files (JSON, HTML or text), and a
reader turns them into rows of one schema. A new source is a function registered with source().
"""

from __future__ import annotations

import threading
from collections.abc import Callable
from concurrent.futures import Future, ThreadPoolExecutor
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from .. import terms
from ..functions.dates import posting_date_guess, utc_timestamp, within_hours
from ..functions.jsonx import find_objects
from ..functions.text import any_term, company_from_result, is_valid_detail, job_links, links_in_text, location_guess, page_title
from ..functions.text import company_from_title as company_of
from ..functions.url import absolute_url, is_aggregate_page, is_individual_job_url, looks_job_url, norm_url_loose, norm_url_strict, priority_tier
from ..session import materialise

LISTING = "job_url string, title string, company string, location string, description string, source string, posting_date string"
Parser = Callable[[DataFrame], DataFrame]
SOURCES: dict[str, Parser] = {}


def source(name: str) -> Callable[[Parser], Parser]:
    """Register a parser: a DataFrame of landed responses (body STRING, origin STRING) to listings."""

    def keep(parse: Parser) -> Parser:
        SOURCES[name] = parse
        return parse

    return keep


def _listing(df: DataFrame, name: str | Column, **columns: Column | str) -> DataFrame:
    get = lambda c: F.coalesce(columns.get(c, F.lit("")), F.lit("")).cast("string").alias(c)
    label = F.lit(name) if isinstance(name, str) else name
    return df.select(get("job_url"), get("title"), get("company"), get("location"), get("description"), label.alias("source"), F.col("posting_date") if columns.get("posting_date") is None and "posting_date" in df.columns else columns.get("posting_date", F.lit(None).cast("string")).alias("posting_date"))


@source("feed_a")
def feed_a(raw: DataFrame) -> DataFrame:
    """{data: [{title, company_name, url, tags, remote, location, description}]}, filtered by role terms."""
    schema = "data ARRAY<STRUCT<title:STRING,company_name:STRING,url:STRING,tags:ARRAY<STRING>,remote:BOOLEAN,location:STRING,description:STRING>>"
    rows = raw.select(F.explode(F.from_json("body", schema)["data"]).alias("j"))
    text = F.lower(F.concat_ws(" ", "j.title", F.array_join("j.tags", " ")))
    place = F.coalesce(F.nullif(F.col("j.location"), F.lit("")), F.when(F.col("j.remote"), "Remote"))
    return _listing(rows.where(any_term(text, terms.ROLES)), "feed_a", job_url=F.col("j.url"), title=F.col("j.title"), company=F.col("j.company_name"), location=place, description=F.col("j.description"))


@source("feed_b")
def feed_b(raw: DataFrame, site: str = "https://remoteok.com") -> DataFrame:
    """[notice, {position, company, url, tags, location, description}, ...]; elements without a position are notices."""
    schema = "ARRAY<STRUCT<position:STRING,company:STRING,url:STRING,tags:ARRAY<STRING>,location:STRING,description:STRING>>"
    rows = raw.select(F.explode(F.from_json("body", schema)).alias("j")).where("j.position IS NOT NULL")
    text = F.lower(F.concat_ws(" ", "j.position", F.array_join("j.tags", " ")))
    link = F.when(F.col("j.url").startswith("/"), F.concat(F.lit(site), F.col("j.url"))).otherwise(F.col("j.url"))
    return _listing(rows.where(any_term(text, terms.ROLES)), "feed_b", job_url=link, title=F.col("j.position"), company=F.col("j.company"), location=F.coalesce(F.nullif(F.col("j.location"), F.lit("")), F.lit("Remote")), description=F.col("j.description"))


@source("board_a")
def board_a(raw: DataFrame) -> DataFrame:
    """{jobs: [{title, absolute_url, location: {name}, content}]}; origin names the board."""
    schema = "jobs ARRAY<STRUCT<title:STRING,absolute_url:STRING,location:STRUCT<name:STRING>,content:STRING>>"
    rows = raw.select("origin", F.explode(F.from_json("body", schema)["jobs"]).alias("j"))
    return _listing(rows, "board_a", job_url=F.col("j.absolute_url"), title=F.col("j.title"), company=F.col("origin"), location=F.coalesce("j.location.name", F.lit("India")), description=F.col("j.content"))


@source("board_b")
def board_b(raw: DataFrame) -> DataFrame:
    """[{text, hostedUrl, categories: {location}, descriptionPlain}]; origin names the board."""
    schema = "ARRAY<STRUCT<text:STRING,hostedUrl:STRING,categories:STRUCT<location:STRING>,descriptionPlain:STRING>>"
    rows = raw.select("origin", F.explode(F.from_json("body", schema)).alias("j"))
    return _listing(rows, "board_b", job_url=F.col("j.hostedUrl"), title=F.col("j.text"), company=F.col("origin"), location=F.coalesce("j.categories.location", F.lit("India")), description=F.col("j.descriptionPlain"))


@source("search_api")
def search_api(raw: DataFrame) -> DataFrame:
    """{jobDetails: [{title, companyName, jdURL, jobDescription, placeholders: [{type, label}]}]}."""
    schema = "jobDetails ARRAY<STRUCT<title:STRING,companyName:STRING,jdURL:STRING,jobDescription:STRING,placeholders:ARRAY<STRUCT<type:STRING,label:STRING>>>>"
    rows = raw.select("origin", F.explode(F.from_json("body", schema)["jobDetails"]).alias("j"))
    place = F.get(F.filter("j.placeholders", lambda p: p["type"] == "location"), F.lit(0))["label"]
    return _listing(rows, "search_api", job_url=absolute_url(F.col("j.jdURL"), F.col("origin")), title=F.col("j.title"), company=F.col("j.companyName"), location=F.coalesce(place, F.lit("India")), description=F.col("j.jobDescription"))


@source("html_list")
def html_list(raw: DataFrame, marker: str = "/detail/") -> DataFrame:
    """Anchors of a list page whose address has a marker, with the text around each: from its block's start
    to the next anchor with the marker. The first row of each address of a page stays, unless it is unpaid."""
    anchor = rf"""(?is)<a\b[^>]*href=["'][^"']*{marker}[^"']*["'][^>]*>"""
    rows = raw.select("origin", F.posexplode(F.split("body", f"(?={anchor})")).alias("nth", "part"))
    # what stands before an anchor in its own block belongs to it, not to the anchor before
    block = r"(?is)<(?:div|li)\b(?!.*<(?:div|li)\b).*$"
    before = F.lag(F.regexp_extract("part", block, 0)).over(Window.partitionBy("origin").orderBy("nth"))
    plain = lambda c: F.trim(F.regexp_replace(F.regexp_replace(c, "<[^>]+>", " "), r"\s+", " "))
    rows = rows.withColumn("lead", F.coalesce(before, F.lit(""))).where(F.col("part").rlike("^" + anchor))
    link = F.regexp_extract("part", rf"""(?i)href=["']([^"']*{marker}[^"']*)""", 1)
    rows = rows.select("origin", "nth", link.alias("link"), plain(F.regexp_extract("part", r"(?is)^<a\b[^>]*>(.*?)</a>", 1)).alias("text"), plain(F.concat("lead", F.regexp_replace("part", block, ""))).alias("context"))
    # an address is known by its first anchor with a text, and goes with it
    first = rows.where(F.col("text") != "").groupBy("origin", "link").agg(F.min_by(F.struct("text", "context"), "nth").alias("f")).select("origin", "link", "f.*")
    first = first.where(~F.lower("context").contains("unpaid"))
    return _listing(first, "html_list", job_url=absolute_url(F.col("link"), F.col("origin")), title=F.col("text"), location=location_guess(F.col("context")), description=F.substring("context", 1, 500))


@source("embedded_json")
def embedded_json(raw: DataFrame) -> DataFrame:
    """Objects with a title and a slug, anywhere in a page's embedded JSON."""
    body = F.regexp_extract("body", r"(?is)<script[^>]*type=[\"']application/json[\"'][^>]*>(.*?)</script>", 1)
    text = F.when(body != "", body).otherwise(F.col("body"))
    rows = raw.select("origin", F.explode(find_objects(text, ["title", "slug"])).alias("o"))
    get = lambda p: F.get_json_object("o", p)
    return _listing(rows, "embedded_json", job_url=F.concat(F.regexp_replace("origin", "/+$", ""), F.lit("/jobs/"), get("$.slug")), title=get("$.title"), company=F.coalesce(get("$.startup.name"), get("$.company.name")), description=get("$.description"))


@source("search_frame")
def search_frame(raw: DataFrame) -> DataFrame:
    """Rows (job_url, title, company, location, description, site) of a search library; rows without a URL go."""
    site = F.coalesce(F.nullif(F.trim("site"), F.lit("")), F.lit("jobspy"))
    label = F.concat(F.upper(F.substring(site, 1, 1)), F.lower(F.substring(site, 2, 1000)))
    keep = raw.where(F.col("job_url").isNotNull() & (F.col("job_url") != ""))
    return _listing(keep, label, **{c: F.col(c) for c in ("job_url", "title", "company", "location", "description")})


def by_site(frame: DataFrame, site: str) -> DataFrame:
    return frame.where(F.lower("source") == site.lower())


@source("crawled_page")
def crawled_page(raw: DataFrame) -> DataFrame:
    """(url, title, markdown) of crawled pages that look like postings."""
    rows = raw.where(looks_job_url(F.col("url"), F.col("title"), F.substring("markdown", 1, 500)))
    title = page_title(F.col("markdown"), F.col("title"))
    return _listing(rows, "crawled_page", job_url=norm_url_strict(F.col("url")), title=title, company=company_of(title, F.col("url")), location=location_guess(F.substring("markdown", 1, 1200)), description=F.substring("markdown", 1, 6000))


@source("web_search")
def web_search(raw: DataFrame) -> DataFrame:
    """(url, title, description, markdown, published) of search results that are postings themselves."""
    rows = raw.where(is_individual_job_url(F.col("url"), F.col("title")) & is_valid_detail(F.coalesce("markdown", "description")))
    text = F.coalesce(F.nullif(F.col("markdown"), F.lit("")), F.col("description"))
    return _listing(rows, "web_search", job_url=F.col("url"), title=F.col("title"), company=company_from_result(F.col("title"), F.col("url")), location=location_guess(F.concat_ws(" ", "title", text)), description=F.substring(text, 1, 4000))


def _met(results: DataFrame, caps: dict[str, int]) -> tuple[DataFrame, DataFrame, list[str]]:
    """Of search results: the postings among them and the links that their lists bring within the caps, each address
    where it is met first; and the order of meeting."""
    asked = results.where((F.col("query") < caps["queries"]) & (F.col("nth") < caps["results"]))
    asked = asked.select("query", "nth", norm_url_loose(F.trim("url")).alias("url"), F.trim(F.coalesce("title", F.lit(""))).alias("title"), F.coalesce("markdown", F.lit("")).alias("markdown"), F.coalesce("description", F.lit("")).alias("snippet"))
    asked = asked.withColumns({"tier": priority_tier(F.col("url")), "single": is_individual_job_url(F.col("url"), F.col("title")), "many": is_aggregate_page(F.col("url"), F.col("title"))})
    # the caps bound these rows; written once, the rules are not worked out again for each use below
    asked = materialise(asked, "asked")
    order = ["query", "tier", "nth"]
    text = F.coalesce(F.nullif(F.trim("markdown"), F.lit("")), F.nullif(F.trim("snippet"), F.lit("")), F.col("title"))
    direct = asked.where("single").select(*order, F.lit(-1).alias("link_nth"), "url", "title", text.alias("text"))
    lists = asked.where("many AND NOT single").orderBy(*order).limit(caps["expansions"])
    inside = F.transform(links_in_text(F.col("markdown")), lambda x: absolute_url(x, F.col("url")))
    links = first_postings(lists.select(*order, F.col("title").alias("parent"), inside.alias("inside")), caps["links"])
    links = materialise(links.withColumn("url", norm_url_loose(F.col("link"))), "links")
    place = F.struct(*order, "link_nth")
    first = direct.select("url", place.alias("p")).unionByName(links.select("url", place.alias("p"))).groupBy("url").agg(F.min("p").alias("first"))
    here = lambda df: df.join(first, "url").where(place == F.col("first")).drop("first")
    order.append("link_nth")
    return here(direct), here(links).orderBy(*order).limit(caps["details"]), order


def first_postings(lists: DataFrame, most: int, inside: str = "inside") -> DataFrame:
    """Each list's first links (in the column inside) that are postings, with their place: a query of its own for every row."""
    links = lists.sparkSession.tvf.posexplode(F.col(inside).outer()).toDF("link_nth", "link")
    mine = links.where(is_individual_job_url(F.col("link"), F.lit(""))).orderBy("link_nth").limit(most)
    return lists.lateralJoin(mine).drop(inside)


def wanted_details(results: DataFrame, caps: dict[str, int] = terms.SEARCH_CAPS) -> DataFrame:
    """The pages (url) that search_web() will ask for as details."""
    return _met(results, caps)[1].select(F.col("link").alias("url")).distinct()


def search_web(results: DataFrame, details: DataFrame, as_of: Column, *, caps: dict[str, int] = terms.SEARCH_CAPS) -> DataFrame:
    """Listings of a web search: results (query, nth, url, title, markdown, description) and the pages that
    list results link to, details (url, title, markdown).

    Queries count in order, each with its first results; within a query, results on preferred sites come
    first. A result that is a posting counts by itself. One that is a list brings its first links to
    postings, as far as the caps on lists, links and pages go. An address counts once, where it is met
    first; what does not read like a posting goes. The first total listings are returned, with their place.
    """
    direct, wanted, order = _met(results, caps)
    pages = wanted.join(details.select(F.col("url").alias("link"), F.col("title").alias("own"), F.col("markdown").alias("text")), "link")
    pages = pages.select(*order, "url", F.coalesce("own", "parent").alias("title"), "text")
    found = direct.select(*order, "url", "title", "text").unionByName(pages).where(is_valid_detail(F.col("text"))).dropDuplicates(["url"])
    rows = found.orderBy(*order).limit(caps["total"])
    rows = rows.withColumn("place", F.row_number().over(Window.orderBy(*order)))  # of at most caps["total"] rows
    guess = F.concat_ws(" ", "title", F.substring("text", 1, 500))
    return rows.select(
        "place", F.col("url").alias("job_url"), "title", company_from_result(F.col("title"), F.col("url")).alias("company"), location_guess(guess).alias("location"),
        F.substring("text", 1, 4000).alias("description"), F.lit("web_search").alias("source"), posting_date_guess(F.substring("text", 1, 1500), as_of).alias("posting_date"),
    )


@source("video_channel")
def video_channel(raw: DataFrame, as_of: Column | None = None, hours: int = 48, videos: int = 3) -> DataFrame:
    """(url, title, channel, description, published) of videos: a row per job link in the description, or the video itself.

    A channel's newest videos alone, and of those (with as_of) the ones not older than so many hours; an
    unreadable time counts as recent. Without published all videos stay.
    """
    if "published" in raw.columns:
        at = utc_timestamp(F.col("published"))
        newest = F.row_number().over(Window.partitionBy("channel").orderBy(F.desc_nulls_last(at), "url"))
        raw = raw.withColumn("_nth", newest).where(F.col("_nth") <= videos)
        if as_of is not None:
            raw = raw.where(within_hours(at, as_of, hours))
    linked = raw.where(F.col("url") != "").withColumn("l", F.explode_outer(job_links(F.col("description"), F.col("title"))))
    return _listing(linked, "video_channel", job_url=F.coalesce("l.url", "url"), title=F.coalesce("l.title", "title"), company=F.col("channel"), description=F.substring("description", 1, 2000))


@source("posts")
def posts(raw: DataFrame, least: int = 40) -> DataFrame:
    """(permalink, author, text) of posts that are long enough and have an address."""
    rows = raw.where((F.length("text") >= least) & F.col("permalink").isNotNull() & (F.col("permalink") != ""))
    return _listing(rows, "posts", job_url=F.col("permalink"), title=F.substring("text", 1, 80), company=F.col("author"), location=location_guess(F.col("text")), description=F.col("text"))


def union_sources(frames: dict[str, DataFrame]) -> DataFrame:
    """All sources' listings with arrival_ord, a total order: by source, then by the place in its responses.

    A row's place is its partition's number and its number there, so rows need not meet to be counted.
    The union is written once: whoever reads it later sees the same order.
    """
    both = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), (f.withColumn("arrival_ord", F.lit(i).cast("long") * (1 << 56) + F.monotonically_increasing_id()) for i, f in enumerate(frames.values())))
    return materialise(both, "arrivals")


def try_sources(frames: dict[str, Callable[[], DataFrame]]) -> tuple[dict[str, DataFrame], dict[str, Exception]]:
    """The sources that deliver, and why others do not: one broken source does not stop the rest.

    Sources run side by side, and each is read to its end and written here, so one that breaks while its rows
    are read is found out as well as one that cannot be planned. An empty source delivers.
    """

    def land(make: Callable[[], DataFrame]) -> DataFrame | Exception:
        try:
            return materialise(make(), "source")
        except Exception as e:
            return e

    with ThreadPoolExecutor(max(1, min(len(frames), 13))) as pool:
        got = dict(zip(frames, pool.map(land, frames.values()), strict=True))
    return {k: v for k, v in got.items() if isinstance(v, DataFrame)}, {k: v for k, v in got.items() if isinstance(v, Exception)}


class OncePerRun:
    """Makes something once, however many threads ask for it: the first makes it, the others wait and get the same,
    or the same failure. A search that several sources share is asked once."""

    def __init__(self, make: Callable[[], DataFrame]):
        self._make, self._lock, self._made = make, threading.Lock(), None

    def __call__(self) -> DataFrame:
        with self._lock:
            if self._made is None:
                self._made = Future()
                try:
                    self._made.set_result(self._make())
                except Exception as e:
                    self._made.set_exception(e)
        return self._made.result()


class _Landed(InputPartition):
    def __init__(self, path: str):
        self.path = path


class LandedReader(DataSourceReader):
    def __init__(self, options: dict):
        self.paths = [p for p in options.get("paths", "").split(",") if p]

    def partitions(self) -> list[InputPartition]:
        return [_Landed(p) for p in self.paths] or [_Landed("")]

    def read(self, partition: _Landed):
        from quarry.sources.stores import open_store

        if partition.path:
            where, path = open_store(partition.path)
            with where.open_input_stream(path, compression=None) as stream:
                yield (stream.read().decode("utf-8", "replace"), partition.path)


class LandedSource(DataSource):
    """spark.read.format("landed").option("paths", "uri,uri"): one partition per landed response (body, origin)."""

    @classmethod
    def name(cls) -> str:
        return "landed"

    def schema(self) -> str:
        return "body string, origin string"

    def reader(self, schema) -> DataSourceReader:
        return LandedReader(self.options)


def read_landed(spark: SparkSession, name: str, path: str) -> DataFrame:
    """Parse a folder of landed responses, one file each, by a registered source."""
    raw = spark.read.text(path, wholetext=True).select(F.col("value").alias("body"), F.col("_metadata.file_path").alias("origin"))
    return SOURCES[name](raw)


def read_json_rows(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Rows of files that hold a JSON array of objects each (or one object), with the columns of schema and _bad.

    Other keys are left out. A value that does not fit its column is null and makes its row bad, as does an
    element that is no object; the other rows of the file are as good as without it. A file that is no JSON
    gives one bad row.
    """
    parsed = F.try_parse_json("value")
    items = F.coalesce(F.try_variant_get(parsed, "$", "array<variant>"), F.array(parsed))
    rows = spark.read.text(path, wholetext=True).select(F.explode(items).alias("v"))
    fields = StructType.fromDDL(schema).fields
    own = [F.try_variant_get("v", f"$.{f.name}", f.dataType.simpleString()).alias(f.name) for f in fields]
    given = lambda f: F.coalesce(~F.is_variant_null(F.try_variant_get("v", f"$.{f.name}", "variant")), F.lit(False))
    unfit = reduce(lambda a, b: a | b, (given(f) & c.isNull() for f, c in zip(fields, own, strict=True)))
    is_object = F.coalesce(F.schema_of_variant("v").startswith("OBJECT"), F.lit(False))
    return rows.select(*own, (unfit | ~is_object).alias("_bad"))


def read_latest_log(spark: SparkSession, path: str) -> DataFrame:
    """Lines of the newest log file in a folder; a file that starts with a UTF-16 mark is read as such."""
    files = spark.read.format("binaryFile").load(path).select(F.col("path").alias("file"), "modificationTime")
    latest = files.agg(F.max_by("file", F.struct("modificationTime", "file"))).first()[0]
    if latest is None:
        return spark.createDataFrame([], "line string")
    mark = F.substring(F.col("content"), 1, 2)
    whole = spark.read.format("binaryFile").load(latest)
    if not whole.select(mark.isin(bytearray(b"\xff\xfe"), bytearray(b"\xfe\xff")).alias("wide")).first().wide:
        return spark.read.text(latest).select(F.col("value").alias("line"))
    # Spark reads lines of single-byte line ends only: such a file is decoded whole
    return whole.select(F.explode(F.split(F.decode("content", "UTF-16"), r"\r\n|[\r\n]")).alias("line"))
