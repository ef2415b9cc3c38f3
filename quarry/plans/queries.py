"""Registered queries of the listing operators, on the driver's tables, each with its SQL for DuckDB."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import terms
from ..functions import dates as D
from ..functions import jsonx as J
from ..functions import score as S
from ..functions import text as X
from ..functions import url as U
from ..operators import listings as L
from ..operators import metrics as M
from ..operators import state as ST
from ..session import scratch, shared_dir, ship

AS_OF = "1998-08-02"
#: Common words of the tables' texts stand in for role and technology terms.
WORDS = ["the", "and", "de", "la", "der", "die", "que", "el"]
Query = Callable[[SparkSession, str], DataFrame]
_QUERIES: dict[str, Query] = {}
_SQL: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    def keep(f: Query) -> Query:
        _QUERIES[f.__name__] = f
        if sql is not None:
            _SQL[f.__name__] = sql
        return f

    return keep


def queries() -> dict[str, Query]:
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(_SQL)


def _t(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _sql_any(text: str, parts: list[str]) -> str:
    return "(" + " OR ".join(f"contains({text}, '{p.lower().replace(chr(39), chr(39) * 2)}')" for p in parts) + ")"


def _sql_hits(text: str, parts: list[str]) -> str:
    return "(" + " + ".join(f"CAST(contains({text}, '{p.lower()}') AS INTEGER)" for p in parts) + ")"


def _sql_words(text: str, parts: list[str]) -> str:
    return "(" + " + ".join(rf"CAST(regexp_matches({text}, '(^|[^\p{{L}}\p{{N}}_])\Q{p.lower()}\E([^\p{{L}}\p{{N}}_]|$)') AS INTEGER)" for p in parts) + ")"


_TRACK = "^(" + "|".join(terms.TRACKING_PREFIXES) + ")"


def _sql_pairs(q: str) -> str:
    return f"nullif(array_to_string(list_filter(string_split({q}, '&'), lambda p: p <> '' AND NOT regexp_matches(lower(split_part(p, '=', 1)), '{_TRACK}')), '&'), '')"


_LOOSE = f"CASE WHEN NOT contains(url, '?') THEN url ELSE split_part(url, '?', 1) || coalesce('?' || {_sql_pairs('substr(url, strpos(url, chr(63)) + 1)')}, '') END"
_RE = r"^(https?)://([^/?#]*)([^?#]*)(?:\?([^#]*))?"


@query(f"SELECT page_id, {_LOOSE} AS clean FROM pages")
def url_normalize_loose(spark, d):
    return _t(spark, d, "pages").select("page_id", U.norm_url_loose(F.col("url")).alias("clean"))


@query(f"""WITH p AS (SELECT page_id, regexp_extract(url, '{_RE}', 1) s, regexp_extract(url, '{_RE}', 2) h, regexp_replace(regexp_extract(url, '{_RE}', 3), ';[^/]*$', '') p, regexp_extract(url, '{_RE}', 4) q FROM pages)
SELECT page_id, CASE WHEN s = '' OR h = '' THEN '' ELSE s || '://' || h || CASE WHEN p = '' THEN '/' ELSE p END || coalesce('?' || {_sql_pairs('q')}, '') END AS clean FROM p""")
def url_normalize_strict(spark, d):
    return _t(spark, d, "pages").select("page_id", U.norm_url_strict(F.col("url")).alias("clean"))


@query(r"SELECT page_id, regexp_replace(lower(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)', 1)), '^www\.', '') AS host FROM pages")
def url_host(spark, d):
    return _t(spark, d, "pages").select("page_id", U.host(F.col("url")).alias("host"))


@query(r"SELECT page_id FROM pages WHERE regexp_replace(lower(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)', 1)), '^www\.', '') IN ('ththre.example.com', 'thther.example.org', 'example.com')")
def url_host_allowed(spark, d):
    return _t(spark, d, "pages").where(U.allowed_host(F.col("url"), ["ththre.example.com", "thther.example.org", "example.com"])).select("page_id")


_PATH = f"string_split(CASE WHEN contains(url, '://') THEN string_split(url, '://')[-1] ELSE url END, '/')"
_SEG = " OR ".join(f"contains(lower(url), '/{p}/') OR contains(lower(url), '/{p}?') OR ends_with(lower(url), '/{p}')" for p in terms.PAGE_BAD_SEGMENTS)
_TITLE = r"regexp_extract(html, '(?is)<title>(.*?)</title>', 1)"
_AGG = f"""CASE WHEN url = '' OR {_sql_any('lower(url)', terms.NON_JOB_DOMAINS)} THEN false
 WHEN contains(lower(url), '-jobs') AND NOT contains(lower(url), '/job/') AND NOT contains(lower(url), '/jobs/') THEN true
 WHEN contains(lower(url), 'jobs.html') OR contains(lower(url), '-jobs-') THEN true
 WHEN len({_PATH}) <= 2 AND contains(lower(url), 'jobs') THEN true
 ELSE ({_SEG}) OR {_sql_any(f'lower({_TITLE})', terms.PAGE_BAD_TITLES)} END"""


@query(f"""SELECT page_id, {_AGG} AS aggregate, CASE WHEN {_sql_any('lower(url)', terms.NON_JOB_DOMAINS)} OR {_AGG} THEN false
 WHEN contains(lower(url), '/job/') OR contains(lower(url), '/jobs/view/') OR contains(lower(url), '/internship/detail/') THEN true
 WHEN contains(lower(url), 'greenhouse.io') AND contains(lower(url), 'jobs') AND len({_PATH}) >= 4 THEN true
 ELSE len({_PATH}) > 2 AND length({_PATH}[-1]) > 5 END AS individual FROM pages""")
def page_classes(spark, d):
    title = F.regexp_extract("html", r"(?is)<title>(.*?)</title>", 1)
    return _t(spark, d, "pages").select("page_id", U.is_aggregate_page(F.col("url"), title).alias("aggregate"), U.is_individual_job_url(F.col("url"), title).alias("individual"))


@query(f"SELECT page_id, {_TITLE} AS title FROM pages")
def page_title(spark, d):
    return _t(spark, d, "pages").select("page_id", F.regexp_extract("html", r"(?is)<title>(.*?)</title>", 1).alias("title"))


_NAV = ", ".join(f"'{t}'" for t in terms.NAV_TITLES)
_STRIP = "trim({})".replace("{}", "regexp_replace(regexp_replace(regexp_replace({}, '!?\\[([^\\]]*)\\]\\([^)]*\\)', '\\1', 'g'), '!?\\[([^\\]]*)\\]\\([^)]*\\)', '\\1', 'g'), '!?\\[([^\\]]*)\\]\\([^)]*\\)', '\\1', 'g')")


_LINES = "'# Menu' || chr(10) || '## [' || replace(replace(left(x, 60), '[', ''), ']', '') || '](u) ![i](j)' || chr(10) || 'ab' || chr(10) || '# A [good [title](a)](b) of page ' || page_id"
_GIVEN = "CASE page_id % 4 WHEN 0 THEN x WHEN 1 THEN 'Home' WHEN 2 THEN '[' || replace(x, ']', '') || '](u)' ELSE '' END"


@query(f"""SELECT page_id, CASE WHEN lower(t) NOT IN ({_NAV}) AND length(t) BETWEEN 3 AND 160 THEN t ELSE coalesce(
 list_filter(list_transform(string_split(u, chr(10)), lambda s: {_STRIP.replace('{}', "trim(regexp_replace(trim(s), '^#+', ''))")}), lambda s: lower(s) NOT IN ({_NAV}) AND length(s) BETWEEN 3 AND 160)[1], nullif(t, ''), 'Software Engineer') END AS title
FROM (SELECT page_id, {_STRIP.replace('{}', f'trim({_GIVEN})')} AS t, {_LINES} AS u FROM (SELECT page_id, {_TITLE} AS x FROM pages))""")
def page_title_clean(spark, d):
    n, x = F.col("page_id"), F.regexp_extract("html", r"(?is)<title>(.*?)</title>", 1)
    given = F.when(n % 4 == 0, x).when(n % 4 == 1, "Home").when(n % 4 == 2, F.concat(F.lit("["), F.replace(x, F.lit("]"), F.lit("")), F.lit("](u)"))).otherwise("")
    second = F.concat(F.lit("## ["), F.translate(F.substring(x, 1, 60), "[]", ""), F.lit("](u) ![i](j)"))
    lines = F.concat(F.lit("# Menu\n"), second, F.lit("\nab\n# A [good [title](a)](b) of page "), n)
    return _t(spark, d, "pages").select("page_id", X.page_title(lines, given).alias("title"))


@query(f"""SELECT page_id, i AS nth, links[i] AS link FROM (SELECT page_id, regexp_extract_all(html, 'href="([^"]*)"', 1) AS links FROM pages), unnest(range(1, len(links) + 1)) AS r(i)""")
def page_links(spark, d):
    links = F.regexp_extract_all("html", F.lit(r'href="([^"]*)"'), F.lit(1))
    return _t(spark, d, "pages").select("page_id", F.posexplode(links).alias("at", "link")).select("page_id", (F.col("at") + 1).cast("long").alias("nth"), "link")


@query(f"""SELECT page_id, link, CAST(nth AS INTEGER) AS nth FROM (SELECT page_id, link, row_number() OVER (PARTITION BY page_id ORDER BY first, link) AS nth FROM (
 SELECT page_id, links[i] AS link, min(i) AS first FROM (SELECT page_id, regexp_extract_all(html, 'href="([^"]*)"', 1) AS links FROM pages), unnest(range(1, len(links) + 1)) AS r(i) GROUP BY page_id, links[i])) WHERE nth <= 5""")
def link_topk_per_page(spark, d):
    first = page_links(spark, d).groupBy("page_id", "link").agg(F.min("nth").alias("first"))
    return L.top_k_per_parent(first, parent="page_id", order=["first", "link"], k=5).select("page_id", "link", "nth")


@query(f"SELECT page_id, job_url FROM (SELECT page_id, {_LOOSE} AS job_url, row_number() OVER (PARTITION BY {_LOOSE} ORDER BY page_id) AS n FROM pages WHERE url <> '') WHERE n = 1")
def dedupe_first_by_url(spark, d):
    rows = _t(spark, d, "pages").select("page_id", F.col("url").alias("job_url"))
    return L.dedupe_by_url(rows, order="page_id").select("page_id", "job_url")


@query("SELECT min(doc_id) AS doc_id FROM documents WHERE text <> '' GROUP BY text")
def dedupe_first_by_text(spark, d):
    # the digest, not the text, crosses the network
    rows = _t(spark, d, "documents").where("text <> ''").select("doc_id", F.sha2("text", 256).alias("digest"))
    return L.first_wins(rows, "digest", ["doc_id"]).select("doc_id")


@query("SELECT source, count(*) AS n FROM documents GROUP BY source")
def source_breakdown(spark, d):
    return M.breakdown(_t(spark, d, "documents"))


@query("SELECT source, n, round_even(n * 100.0 / sum(n) OVER (), 2) AS share FROM (SELECT source, count(DISTINCT text) AS n FROM documents GROUP BY source)")
def source_share(spark, d):
    rows = _t(spark, d, "documents").select("source", F.sha2("text", 256).alias("digest"))
    return M.shares(rows.distinct())


@query("SELECT count(*) AS total, count(DISTINCT text) AS distinct_keys, count(*) - count(DISTINCT text) AS duplicates FROM documents")
def dup_summary(spark, d):
    return M.duplicate_summary(_t(spark, d, "documents").select(F.sha2("text", 256).alias("digest")), "digest")


@query(f"SELECT doc_id, regexp_extract(text, '{terms.EMAIL_PATTERN}') AS email FROM documents")
def email_first(spark, d):
    return _t(spark, d, "documents").select("doc_id", X.first_email(F.col("text")).alias("email"))


@query(f"SELECT source, count(*) FILTER (WHERE regexp_extract(text, '{terms.EMAIL_PATTERN}') <> '') AS contacts, count(*) AS n FROM documents GROUP BY source")
def email_share(spark, d):
    return _t(spark, d, "documents").groupBy("source").agg(F.count_if(X.first_email(F.col("text")) != "").alias("contacts"), F.count("*").alias("n"))


def _nested_replace(x: str) -> str:
    for s in terms.COMPANY_SUFFIXES:
        x = f"replace({x}, '{s}', '')"
    return x


_DOMAIN = f"regexp_replace({_nested_replace('trim(lower(c_name))')}, '[^a-z0-9]', '', 'g')"


@query(f"SELECT c_custkey, CASE WHEN {_DOMAIN} = '' THEN '' ELSE {_DOMAIN} || '.com' END AS domain FROM customer")
def domain_guess(spark, d):
    return _t(spark, d, "customer").select("c_custkey", X.company_domain(F.col("c_name")).alias("domain"))


@query(f"SELECT doc_id, array_to_string(list_filter({WORDS}, lambda w: contains(lower(text), w)), ',') AS hits FROM documents")
def term_hits_substring(spark, d):
    return _t(spark, d, "documents").select("doc_id", F.array_join(X.term_hits(F.lower("text"), WORDS), ",").alias("hits"))


@query(f"SELECT doc_id, {_sql_words('lower(text)', WORDS)} AS hits FROM documents")
def term_hits_word(spark, d):
    return _t(spark, d, "documents").select("doc_id", X.count_word_hits(F.lower("text"), WORDS).alias("hits"))


@query(f"""SELECT d.doc_id, CASE WHEN coalesce(l.toxic, 0) = 1 OR {_sql_words('lower(text)', WORDS[:4])} = 0 THEN 0 ELSE
 5 * least(3, {_sql_words('lower(text)', WORDS[:4])}) + least(6, {_sql_hits('lower(text)', WORDS)}) * 2 + CASE WHEN regexp_extract(text, '{terms.EMAIL_PATTERN}') <> '' THEN 1 ELSE 0 END END AS score
FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id""")
def keyword_score(spark, d):
    low = F.lower("text")
    facts = _t(spark, d, "documents").select("doc_id", X.count_word_hits(low, WORDS[:4]).alias("words"), X.count_hits(low, WORDS).alias("parts"), (X.first_email(F.col("text")) != "").cast("int").alias("email"))
    labels = _t(spark, d, "labels").select("doc_id", "toxic")
    points = 5 * F.least(F.lit(3), F.col("words")) + 2 * F.least(F.lit(6), F.col("parts")) + F.col("email")
    return facts.join(labels, "doc_id", "left").select("doc_id", F.when((F.coalesce("toxic", F.lit(0)) == 1) | (F.col("words") == 0), 0).otherwise(points).alias("score"))


@query("""WITH s AS (SELECT n_nationkey, r_name, (n_nationkey * 7) % 50 AS score FROM nation JOIN region ON n_regionkey = r_regionkey)
SELECT doc_id, source, score, CAST(rank AS INTEGER) AS rank FROM (
 WITH p AS (SELECT doc_id, source, n_chars % 97 AS score FROM documents WHERE n_chars % 97 >= 6),
 a AS (SELECT *, min(doc_id) OVER (PARTITION BY source) AS so, row_number() OVER (PARTITION BY source ORDER BY score DESC, doc_id) AS rn FROM p),
 b AS (SELECT *, row_number() OVER (ORDER BY rn > 5, CASE WHEN rn > 5 THEN rn ELSE so END, CASE WHEN rn > 5 THEN so ELSE rn END) AS pos FROM a),
 c AS (SELECT *, row_number() OVER (ORDER BY score DESC, pos) AS rank FROM b WHERE rn <= 5 OR pos <= 300)
 SELECT * FROM c WHERE rank <= 300)""")
def fair_topk(spark, d):
    rows = _t(spark, d, "documents").select("doc_id", "source", (F.col("n_chars") % 97).alias("score"))
    return L.fair_top_k(rows, score="score", group="source", order="doc_id").select("doc_id", "source", "score", "rank")


@query("""SELECT o_orderkey, o_orderpriority, CAST(pick AS INTEGER) AS pick FROM (SELECT *, row_number() OVER (ORDER BY rn, o_orderpriority) AS pick FROM (
 SELECT o_orderkey, o_orderpriority, row_number() OVER (PARTITION BY o_orderpriority ORDER BY o_orderkey) AS rn FROM orders)) WHERE pick <= 24""")
def round_robin_pick(spark, d):
    rows = _t(spark, d, "orders").select("o_orderkey", "o_orderpriority")
    return L.round_robin(rows, pool="o_orderpriority", order="o_orderkey", most=24)


@query("SELECT doc_id FROM documents WHERE length(trim(text)) < 300 ORDER BY doc_id LIMIT 25")
def short_text_first_k(spark, d):
    rows = _t(spark, d, "documents").select("doc_id", F.lit("u").alias("job_url"), F.col("text").alias("description"))
    return L.needs_description(rows, order="doc_id").select("doc_id")


@query("SELECT c_custkey, c_name FROM customer WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_orderstatus = 'F')")
def unseen_anti(spark, d):
    seen = _t(spark, d, "orders").where("o_orderstatus = 'F'").select(F.col("o_custkey").alias("c_custkey"))
    return L.unseen(_t(spark, d, "customer").select("c_custkey", "c_name"), seen, "c_custkey")


@query("""SELECT doc_id, 0 AS phase FROM documents WHERE lang = 'en' AND n_chars < 1000 UNION ALL
 SELECT doc_id, 1 AS phase FROM documents f WHERE n_chars < 2000 AND NOT EXISTS (SELECT 1 FROM documents e WHERE e.doc_id = f.doc_id AND e.lang = 'en' AND e.n_chars < 1000)""")
def deferred_first_union(spark, d):
    docs = _t(spark, d, "documents").select("doc_id", "lang", "n_chars")
    return L.deferred_first(docs.where("lang = 'en' AND n_chars < 1000"), docs.where("n_chars < 2000"), "doc_id", "doc_id").select("doc_id", "phase")


@query("""SELECT a.conv_id, a.turn, CASE WHEN length(trim(coalesce(b.text, ''))) > length(trim(coalesce(a.text, ''))) THEN b.text ELSE a.text END AS description
 FROM conversations a LEFT JOIN conversations b ON a.conv_id = b.conv_id AND b.turn = a.turn + 1 WHERE a.role = 'user'""")
def enrich_longer_wins(spark, d):
    turns = _t(spark, d, "conversations").select("conv_id", "turn", "role", F.col("text").alias("description"), F.lit("c").alias("company"))
    key = lambda t: F.concat_ws("/", "conv_id", t).alias("job_url")
    mine = turns.where("role = 'user'").select("conv_id", "turn", "description", "company", key("turn"))
    return L.enrich_descriptions(mine, turns.select("description", "company", key(F.col("turn") - 1))).select("conv_id", "turn", "description")


@query("""SELECT d.doc_id, CASE WHEN l.quality = 1 AND l.toxic = 0 THEN 'resumed' WHEN l.doc_id IS NOT NULL AND l.toxic = 1 THEN 'retry' ELSE 'new' END AS route
 FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id""")
def route_three_way(spark, d):
    docs = _t(spark, d, "documents").select(F.col("doc_id").alias("job_url"), F.lit("k").alias("evaluation_key"))
    status = F.when(F.col("toxic") == 1, "QUEUED").otherwise("PASSED")
    state = _t(spark, d, "labels").select(F.col("doc_id").alias("job_url"), status.alias("status"), F.when(F.col("quality") == 1, "k").otherwise("other").alias("evaluation_key"), F.lit("v").alias("verdict"))
    return L.route(docs, state, order="job_url", most_new=2_000_000_000).select(F.col("job_url").alias("doc_id"), "route")


@query("SELECT doc_id, rank <= 90 AS admitted FROM (SELECT doc_id, row_number() OVER (ORDER BY n_chars, doc_id) AS rank FROM documents)")
def admit_defer_split(spark, d):
    yes, no = L.split_admitted(_t(spark, d, "documents").select("n_chars", "doc_id"), 90, ["n_chars", "doc_id"])
    flag = lambda df, v: df.select("doc_id", F.lit(v).alias("admitted"))
    return flag(yes, True).unionByName(flag(no, False))


@query("""SELECT event_type, CAST(greatest(1, least(300, floor(2700.0 * 0.75 * greatest(0.5, 1 - least(0.5, 0.5 * (bad * 1.0 / n))) / greatest(m, 0.75 * x, 90.0) * 4))) AS INTEGER) AS admitted
 FROM (SELECT event_type, count(*) AS n, count(*) FILTER (WHERE value < 10) AS bad, avg(value) AS m, max(value) AS x FROM events GROUP BY event_type)""")
def admission_limit(spark, d):
    per = _t(spark, d, "events").groupBy("event_type").agg(F.count("*").alias("n"), F.count_if(F.col("value") < 10).alias("bad"), F.avg("value").alias("m"), F.max("value").alias("x"))
    return per.select("event_type", S.admission_limit(F.lit(2700.0), F.col("n"), F.col("bad"), F.col("m"), F.col("x")).alias("admitted"))


_CLAMPS = " + ".join(f"greatest(0, least({c}, {cap}))" for c, cap in zip(("l_linenumber * 5", "l_linenumber * 4", "CAST(l_quantity AS INTEGER)", "l_linenumber", "l_linenumber * 2", "l_linenumber", "l_linenumber - 3"), terms.COMPONENT_CAPS.values(), strict=True))


@query(f"""SELECT l_orderkey, l_linenumber, CAST(fit AS INTEGER) AS fit_score, CASE WHEN fit >= 90 THEN 'Exceptional' WHEN fit >= 80 THEN 'Strong' WHEN fit >= 70 THEN 'Good' WHEN fit >= 60 THEN 'Reasonable' ELSE 'Weak' END AS fit_tier,
 fit >= 70 AND l_returnflag = 'N' AS passed FROM (SELECT *, {_CLAMPS} AS fit FROM lineitem)""")
def verdict_clamp_tier(spark, d):
    n = F.col("l_linenumber")
    parts = dict(zip(terms.COMPONENT_CAPS, (n * 5, n * 4, F.col("l_quantity").cast("int"), n, n * 2, n, n - 3), strict=True))
    rows = _t(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_returnflag", *(v.alias(k) for k, v in parts.items()))
    rows = rows.withColumn("fit_score", S.fit_score())
    return rows.select("l_orderkey", "l_linenumber", "fit_score", S.tier(F.col("fit_score")).alias("fit_tier"), ((F.col("fit_score") >= terms.FIT_THRESHOLD) & (F.col("l_returnflag") == "N")).alias("passed"))


@query(f"""SELECT doc_id, CAST(rank AS BIGINT) AS rank FROM (SELECT doc_id, row_number() OVER (ORDER BY (regexp_extract(text, '{terms.EMAIL_PATTERN}') <> '') DESC, n_chars DESC, doc_id) AS rank FROM documents)""")
def final_rank(spark, d):
    rows = _t(spark, d, "documents").select("doc_id", "n_chars", X.first_email(F.col("text")).alias("recruiter_email"))
    return L.number_rows(L.final_rank(rows, score="n_chars", order="doc_id")).select("doc_id", "rank")


@query("""SELECT tier, count(*) AS n FROM (SELECT CASE WHEN s >= 90 THEN 'Exceptional' WHEN s >= 80 THEN 'Strong' WHEN s >= 70 THEN 'Good' WHEN s >= 60 THEN 'Reasonable' ELSE 'Weak' END AS tier FROM (SELECT CAST(floor(c_acctbal / 100) AS INTEGER) AS s FROM customer)) GROUP BY tier""")
def tier_buckets(spark, d):
    return _t(spark, d, "customer").groupBy(S.tier(F.floor(F.col("c_acctbal") / 100).cast("int")).alias("tier")).agg(F.count("*").alias("n"))


_AGE = f"date_diff('day', CAST(o_orderdate AS DATE), DATE '{AS_OF}')"


@query(f"SELECT o_orderkey, CAST({_AGE} AS INTEGER) AS age, CAST(CASE WHEN {_AGE} < 0 THEN 1 WHEN {_AGE} <= 3 THEN 4 WHEN {_AGE} <= 7 THEN 2 WHEN {_AGE} <= 30 THEN 0 ELSE -3 END AS INTEGER) AS score, {_AGE} > 30 AS reject FROM orders")
def freshness_score(spark, d):
    day, as_of = F.to_date("o_orderdate"), F.lit(AS_OF).cast("date")
    rows = _t(spark, d, "orders").select("o_orderkey", D.age_days(day, as_of).alias("age"), S.freshness_gate(day, as_of).alias("g"))
    return rows.select("o_orderkey", "age", "g.score", "g.reject")


_PHRASES = ["0-1 years", "up to 1 year", "2+ years required", "2-4 years required", "5 years preferred", "senior lead role", "12 yrs of experience", "no number"]
_LOW = "lower(phrase || ' ' || text)"
_YEARS = rf"coalesce(CAST(nullif(regexp_extract(t, '{terms.YEARS_PATTERN}\s*(?:of\s*experience)?\b', 1), '') AS INTEGER), 0)"


@query(f"""WITH p AS (SELECT doc_id, {_LOW} AS t FROM documents, (SELECT unnest({_PHRASES}) AS phrase)), y AS (SELECT doc_id, t, {_YEARS} AS years, regexp_matches(t, '{terms.YEARS_PATTERN}{terms.YEARS_PREFERRED}') AS pref, {_sql_any('t', terms.GRADUATE)} AS grad, {_sql_hits('t', terms.SENIOR)} AS senior FROM p)
SELECT doc_id, CAST(sum(years) AS BIGINT) AS years, count(*) FILTER (WHERE years > 0 AND pref) AS preferred, count(*) FILTER (WHERE NOT ((senior >= 2 AND NOT grad) OR (years > 1 AND NOT pref AND NOT grad))) AS eligible FROM y GROUP BY doc_id""")
def experience_parse(spark, d):
    docs = _t(spark, d, "documents").select("doc_id", F.explode(F.array(*(F.lit(p) for p in _PHRASES))).alias("phrase"), "text")
    rows = docs.select("doc_id", S.experience(F.concat_ws(" ", "phrase", "text")).alias("e"))
    return rows.groupBy("doc_id").agg(F.sum("e.min_years").alias("years"), F.count_if("e.preferred").alias("preferred"), F.count_if("e.eligible").alias("eligible"))


@query("""SELECT event_type, count(*) AS n, round_even(avg(v), 1) AS mean, list_sort(list(v))[CAST(round_even(0.95::DOUBLE * (count(*) - 1), 0) AS INTEGER) + 1] AS p95 FROM (SELECT event_type, value AS v FROM events WHERE value IS NOT NULL) GROUP BY event_type""")
def latency_mean_p95(spark, d):
    out = M.mean_and_p95(_t(spark, d, "events"), "value", ["event_type"])
    return out.select("event_type", "n", F.bround("mean", 1).alias("mean"), "p95")


@query("SELECT user_id, count(*) FILTER (WHERE event_type IN ('purchase', 'signup')) AS passed, count(*) FILTER (WHERE event_type = 'error') AS failed, count(*) FILTER (WHERE event_type IN ('view', 'click')) AS open FROM events GROUP BY user_id")
def status_counters(spark, d):
    return M.status_counters(_t(spark, d, "events"), "event_type", {"passed": ["purchase", "signup"], "failed": ["error"], "open": ["view", "click"]}, ["user_id"])


@query("SELECT event_id, json_extract_string(props, '$.k') AS k FROM events")
def json_props(spark, d):
    return _t(spark, d, "events").select("event_id", F.get_json_object("props", "$.k").alias("k"))


@query("SELECT doc_id, sha256(CAST(doc_id AS VARCHAR) || chr(10) || text || chr(10) || 'v2') AS key FROM documents")
def content_key(spark, d):
    return _t(spark, d, "documents").select("doc_id", S.stable_hash(F.col("doc_id"), F.col("text"), F.lit("v2")).alias("key"))


@query("SELECT c_mktsegment, sha256(string_agg(c_name, chr(10) ORDER BY c_name)) AS hash FROM customer WHERE c_name <> '' GROUP BY c_mktsegment")
def set_hash(spark, d):
    return M.set_hash(_t(spark, d, "customer"), "c_name", "c_mktsegment")


_MD5 = f"md5(c_name || ':' || c_mktsegment || ':{AS_OF}')"


@query(f"""SELECT c_custkey, CASE n WHEN 0 THEN c_name || ' fresher jobs ' || c_mktsegment WHEN 1 THEN c_name || ' 0-2 years ' || c_mktsegment WHEN 2 THEN c_name || ' ' || c_mktsegment || ' fresher' WHEN 3 THEN c_name || ' hiring ' || c_mktsegment ELSE c_name || ' walk-in ' || c_mktsegment END AS query
FROM (SELECT *, list_sum(list_transform(string_split({_MD5}, ''), lambda c: strpos('0123456789abcdef', c) - 1)) % 5 AS n FROM customer)""")
def query_rotation(spark, d):
    return _t(spark, d, "customer").select("c_custkey", X.rotate_query(F.col("c_name"), F.col("c_mktsegment"), F.lit(AS_OF)).alias("query"))


_STATUS = "CASE event_id % 5 WHEN 0 THEN 'QUEUED' WHEN 1 THEN 'EVALUATING' WHEN 2 THEN 'EVALUATED' WHEN 3 THEN 'PASSED' ELSE 'RETRYABLE_ERROR' END"
_OK = ", ".join(f"'{a}>{b}'" for a, b in terms.TRANSITIONS)


def _events_as_states(spark, d):
    n = F.col("event_id") % 5
    return _t(spark, d, "events").select("event_id", "user_id", "ts", F.when(n == 0, "QUEUED").when(n == 1, "EVALUATING").when(n == 2, "EVALUATED").when(n == 3, "PASSED").otherwise("RETRYABLE_ERROR").alias("status"))


@query(f"""SELECT event_id, from_status, status FROM (SELECT event_id, {_STATUS} AS status, lag({_STATUS}) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS from_status FROM events)
WHERE from_status IS NOT NULL AND from_status <> status AND NOT (from_status = 'QUEUED' AND status IN ('RETRYABLE_ERROR', 'PERMANENT_ERROR')) AND from_status || '>' || status NOT IN ({_OK})""")
def state_transitions_invalid(spark, d):
    return ST.invalid_steps(_events_as_states(spark, d), key="user_id", order=["ts", "event_id"], status="status").select("event_id", "from_status", "status")


@query(f"SELECT event_id, {_STATUS} = 'EVALUATING' AND TIMESTAMP '2024-01-15 00:00:00' >= ts + INTERVAL 3600 SECOND AS expired FROM events")
def lease_expired(spark, d):
    rows = _events_as_states(spark, d)
    lease = D.lease_until(F.col("ts"), terms.LEASE_SECONDS)
    return rows.select("event_id", ST.lease_expired(F.col("status"), lease, F.lit("2024-01-15 00:00:00").cast("timestamp_ntz")).alias("expired"))


_RUNS = """SELECT event_id, user_id, ts, sum(bad) OVER (PARTITION BY user_id, island ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS run FROM (
 SELECT *, sum(1 - bad) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS island FROM (SELECT event_id, user_id, ts, CASE WHEN value < 40 THEN 1 ELSE 0 END AS bad FROM events))"""


@query(f"""SELECT event_id, CAST(run AS BIGINT) AS run FROM (SELECT *, max(CASE WHEN run >= 3 THEN 1 ELSE 0 END) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS opened FROM ({_RUNS})) WHERE coalesce(opened, 0) = 0""")
def breaker_cut(spark, d):
    return ST.breaker_cut(_t(spark, d, "events"), key="user_id", order=["ts", "event_id"], failed=F.col("value") < 40).select("event_id", "run")


@query(f"SELECT user_id, CAST(max(run) AS BIGINT) AS longest, max(run) >= 3 AS opened FROM ({_RUNS}) GROUP BY user_id")
def consecutive_fail_open(spark, d):
    runs = ST.failure_runs(_t(spark, d, "events"), key="user_id", order=["ts", "event_id"], failed=F.col("value") < 40)
    return runs.groupBy("user_id").agg(F.max("run").alias("longest"), (F.max("run") >= 3).alias("opened"))


@query("""SELECT coalesce(n.user_id, o.user_id) AS user_id, coalesce(n.status, o.status) AS status FROM
 (SELECT user_id, max_by(event_type, event_id) AS status FROM events WHERE event_id % 2 = 0 GROUP BY user_id) o FULL JOIN
 (SELECT user_id, max_by(event_type, event_id) AS status FROM events WHERE event_id % 2 = 1 GROUP BY user_id) n ON o.user_id = n.user_id""")
def state_upsert(spark, d):
    rows = _t(spark, d, "events").select("user_id", "event_id", F.col("event_type").alias("status"))
    old = L.first_wins(rows.where("event_id % 2 = 0").withColumn("user_id", F.col("user_id").cast("string")).withColumn("_o", -F.col("event_id")), "user_id", ["_o"]).drop("_o").withColumn("user_id", F.col("user_id").cast("long"))
    return ST.upsert(old.select("user_id", "event_id", "status"), rows.where("event_id % 2 = 1"), "user_id", ["event_id"]).select("user_id", "status")


@query("""SELECT pattern, count(*) AS n FROM (SELECT unnest(list_filter([CASE WHEN contains(line, 'License') THEN 'license' END, CASE WHEN contains(line, '@') THEN 'mail' END, CASE WHEN contains(line, 'the') THEN 'word' END], lambda x: x IS NOT NULL)) AS pattern
 FROM (SELECT unnest(string_split(text, chr(10))) AS line FROM documents)) GROUP BY pattern""")
def pattern_counts(spark, d):
    lines = _t(spark, d, "documents").select(F.explode(F.split("text", "\n")).alias("line"))
    return M.pattern_counts(lines, "line", {"license": "License", "mail": "@", "word": "the"})


_MESSAGES = ["request timeout", "HTTP 429 rate limit", "403 forbidden", "401 unauthorized", "503 server error", "captcha required", "bad json", "other"]
_CLASS = f"""CASE WHEN contains(m, 'timeout') THEN 'TIMEOUT' WHEN {_sql_any('m', ['403', 'forbidden'])} THEN 'HTTP_403' WHEN {_sql_any('m', ['429', 'too many requests', 'rate limit'])} THEN 'HTTP_429'
 WHEN {_sql_any('m', ['401', 'unauthorized', 'authentication', 'api key'])} THEN 'AUTH_ERROR' WHEN {_sql_any('m', ['500', '502', '503', '504', 'server error'])} THEN 'HTTP_5XX'
 WHEN {_sql_any('m', ['blocked', 'captcha', 'bot detection', 'robot'])} THEN 'BLOCKED' WHEN {_sql_any('m', ['json', 'parse', 'parser', 'schema'])} THEN 'PARSER_ERROR' ELSE 'UNKNOWN_ERROR' END"""


@query(f"SELECT doc_id, {_CLASS} AS class FROM (SELECT doc_id, lower(CASE WHEN doc_id % 9 = 8 THEN text ELSE text || chr(10) || ({_MESSAGES})[doc_id % 9 + 1] END) AS m FROM documents)")
def error_class(spark, d):
    """Whole texts, most of them with a message at the end."""
    n = F.col("doc_id")
    said = F.concat_ws("\n", "text", F.get(F.array(*(F.lit(m) for m in _MESSAGES)), (n % 9).cast("int")))
    return _t(spark, d, "documents").select("doc_id", X.error_class(said, F.lit("ValueError")).alias("class"))


_PLAIN = r"""regexp_replace(text, '[\\"\n\r\t{}\[\],`]', ' ', 'g')"""


@query(f"""SELECT doc_id, CASE doc_id % 8 WHEN 0 THEN '{{"id": ' || doc_id || ', "tags": ["a", "b"], "text": "' || x || '"}}' WHEN 1 THEN '{{"id": ' || doc_id || ', "tags": ["a", "b"]}}' WHEN 2 THEN '{{"id": ' || doc_id || ', "tags": ["a"]}}' WHEN 3 THEN '{{"id": ' || doc_id || ', "text": "' || x || '"}}'
 WHEN 4 THEN '{{"id": ' || doc_id || ', "in": {{"text": "' || x || '"}}}}' WHEN 5 THEN '{{"id": ' || doc_id || '}}' WHEN 6 THEN NULL ELSE '{{"id": ' || doc_id || ', "n": [1, 2]}}' END AS repaired FROM (SELECT doc_id, {_PLAIN} AS x FROM documents)""")
def json_repair(spark, d):
    n, x = F.col("doc_id"), F.regexp_replace("text", r'[\\"\n\r\t{}\[\],`]', " ")
    head = F.concat(F.lit('{"id": '), n)
    cut = (
        F.when(n % 8 == 0, F.concat(F.lit("```json\n"), head, F.lit(', "tags": ["a", "b"], "text": "'), x, F.lit('"}\n```')))  # fenced
        .when(n % 8 == 1, F.concat(head, F.lit(', "tags": ["a", "b"], "text": "'), x))  # cut within a string
        .when(n % 8 == 2, F.concat(head, F.lit(', "tags": ["a", "b')))  # within a list
        .when(n % 8 == 3, F.concat(F.lit("Here it is: "), head, F.lit(', "text": "'), x, F.lit('"} Done.')))  # within prose
        .when(n % 8 == 4, F.concat(head, F.lit(', "in": {"text": "'), x, F.lit('"')))  # all brackets open
        .when(n % 8 == 5, F.concat(head, F.lit(', "next":')))  # after a key
        .when(n % 8 == 6, x).otherwise(F.concat(head, F.lit(', "n": [1, 2], ')))
    )
    return _t(spark, d, "documents").select("doc_id", J.repair_json(cut).alias("repaired"))


@query("""WITH d AS (SELECT o_orderkey AS k, CAST(o_orderdate + INTERVAL 30 YEAR AS DATE) AS a FROM orders)
SELECT k AS o_orderkey, CASE WHEN k % 8 IN (4, 7) THEN NULL WHEN k % 8 = 1 THEN strftime(date_trunc('month', a) + INTERVAL 4 DAY, '%Y-%m-%d') WHEN k % 8 = 6 AND (a < DATE '2027-01-01' OR a > DATE '2027-05-20') THEN '2027-05-20' ELSE strftime(a, '%Y-%m-%d') END AS first_day,
 CASE WHEN k % 8 IN (4, 7) THEN NULL WHEN k % 8 = 1 THEN strftime(date_trunc('month', a) + INTERVAL 6 DAY, '%Y-%m-%d') WHEN k % 8 = 6 AND (a < DATE '2027-01-01' OR a > DATE '2027-05-20') THEN '2027-05-20' ELSE strftime(a, '%Y-%m-%d') END AS last_day FROM d""")
def walkin_dates(spark, d):
    n, day = F.col("o_orderkey"), F.add_months("o_orderdate", 360)
    at = lambda f: F.date_format(day, f)
    text = (
        F.when(n % 8 == 0, F.concat(F.lit("Walk-in drive on "), at("d MMM yyyy"), F.lit(" at our campus, bring a resume. Our company, founded 12 Jan 2001")))
        .when(n % 8 == 1, F.concat(F.lit("Hiring drive, 5th to 7th "), at("MMMM yyyy"), F.lit(" (5 "), at("MMM yyyy"), F.lit(" and after)")))  # a range; its first day is in it
        .when(n % 8 == 2, F.concat(F.lit("Interview date: "), at("yyyy-MM-dd")))
        .when(n % 8 == 3, F.concat(F.lit("| walk in interview | x\nDrive: "), at("MMMM d"), F.lit("th "), at("yyyy")))
        .when(n % 8 == 4, F.concat(F.lit("Last walk-in was held on "), at("d MMM yyyy"), F.lit(". Deadline "), at("yyyy-MM-dd")))  # of the past
        .when(n % 8 == 5, F.concat(F.lit("walk-in "), at("MM/dd/yyyy")))
        .when(n % 8 == 6, F.concat(F.lit("Walk-in on "), at("d MMM yyyy"), F.lit("\nNext drive on 20 May 2027")))  # the first that is ahead, else the latest
        .otherwise(F.concat(F.lit("Walk-in. "), F.repeat(F.lit("far away "), 30), at("d MMM yyyy")))  # out of reach
    )
    rows = _t(spark, d, "orders").select("o_orderkey", D.walkin_dates(text, F.lit("2027-01-01").cast("date")).alias("w"))
    shown = lambda c: F.date_format(c, "yyyy-MM-dd")
    return rows.select("o_orderkey", shown("w.start").alias("first_day"), shown("w.end").alias("last_day"))


@query(r"""WITH l AS (SELECT page_id, unnest(regexp_extract_all(url || ' apply' || chr(10) || html, 'https?://[^\s\)\]\>"'']+')) AS raw FROM pages)
SELECT page_id, count(DISTINCT rtrim(raw, ').,;:')) AS n FROM l WHERE NOT """ + _sql_any("lower(rtrim(raw, ').,;:'))", terms.NON_JOB_LINKS) + " GROUP BY page_id")
def job_links(spark, d):
    rows = _t(spark, d, "pages").select("page_id", F.size(X.job_links(F.concat("url", F.lit(" apply\n"), "html"), F.lit("page"))).cast("long").alias("n"))
    return rows.where("n > 0")


#: Rows in a file of a stream of events.
_STREAM_ROWS = 100_000
#: Rows of a stream for each bucket of its keys, and the fewest buckets: what a bucket costs by itself is some 5,000 rows a micro-batch.
_BUCKET_ROWS, _BUCKETS = 1 << 16, 64


def _stream(spark, d, batches: int, columns: list):
    """events as a stream of so many micro-batches, in order of time, and their number; large micro-batches are several files, the same number each."""
    path = scratch(spark, "events")
    rows, n = _t(spark, d, "events"), F.col("event_id")
    edges = rows.agg(F.max("event_id")).first()[0] + 1
    within = [(n >= edges * i // batches) & (n < edges * (i + 1) // batches) for i in range(batches)]
    # the first has any id below zero too, the last all events without one
    within[0], within[-1] = n < edges // batches, (n >= edges * (batches - 1) // batches) | n.isNull()
    sizes = rows.agg(*(F.count_if(w).alias(f"n{i}") for i, w in enumerate(within))).first()
    # the smallest batch tells how many files all have: none is then without rows, for which no file is written
    files = max(1, min(sizes) // _STREAM_ROWS)
    for w in within:
        rows.where(w).select(*columns).repartition(files).write.mode("append").parquet(path)
    schema = rows.select(*columns).schema
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files).parquet(path), sum(sizes)


def _buckets(rows: int) -> int:
    return max(_BUCKETS, rows // _BUCKET_ROWS)


def _with_rocksdb(spark, run, buckets: int):
    """run() with states in RocksDB, in no more partitions than a quarter of the buckets: each is opened and committed in every micro-batch."""
    from ..streaming.machine import ROCKSDB

    shared_dir(spark)
    parts = "spark.sql.shuffle.partitions"
    wanted = {"spark.sql.streaming.stateStore.providerClass": ROCKSDB, parts: str(min(int(spark.conf.get(parts)), buckets // 4))}
    before = {name: spark.conf.get(name) for name in wanted}
    for name, value in wanted.items():
        spark.conf.set(name, value)
    try:
        return run()
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)


@query("SELECT user_id AS key, CAST(count(*) AS BIGINT) AS n, CAST(sum(CASE WHEN value < 40 THEN 1 ELSE 0 END) AS BIGINT) AS failures FROM events GROUP BY user_id")
def stream_state(spark, d):
    """Keyed state over a stream of events in four micro-batches, read to its end; the latest counts of each key."""
    from ..streaming.machine import running_failures

    out = scratch(spark, "stream")

    stream, total = _stream(spark, d, 4, [F.col("user_id").alias("key"), F.col("event_id").alias("ord"), (F.col("value") < 40).alias("failed")])
    buckets = _buckets(total)

    def run():
        writer = running_failures(stream, buckets).writeStream.outputMode("update").option("checkpointLocation", f"{out}-log").trigger(availableNow=True)
        writer.foreachBatch(lambda df, i: df.write.mode("overwrite").parquet(f"{out}/batch={i}")).start().awaitTermination()

    _with_rocksdb(spark, run, buckets)
    rows = spark.read.schema("key long, n long, failures long, run long, batch int").parquet(out)
    return rows.groupBy("key").agg(F.max_by("n", "batch").alias("n"), F.max_by("failures", "batch").alias("failures"))


_WANTED = "CASE event_id % 7 WHEN 0 THEN 'EVALUATING' WHEN 1 THEN 'EVALUATED' WHEN 2 THEN 'PASSED' WHEN 3 THEN 'RETRYABLE_ERROR' WHEN 4 THEN 'EVALUATING' WHEN 5 THEN 'DEADLINE_EXCEEDED' ELSE 'QUEUED' END"
_STEP = f"(status = target OR (status = 'QUEUED' AND target IN ('RETRYABLE_ERROR', 'PERMANENT_ERROR')) OR status || '>' || target IN ({_OK}))"


@query(f"""WITH RECURSIVE e AS (SELECT user_id // 10 * 1000 + event_id // 40 AS key, event_id, CASE WHEN event_id % 7 = 3 AND event_id % 2 = 0 THEN 'PERMANENT_ERROR' ELSE {_WANTED} END AS target, row_number() OVER (PARTITION BY user_id // 10 * 1000 + event_id // 40 ORDER BY event_id) AS i FROM events),
 s AS (SELECT key, CAST(0 AS BIGINT) AS i, 'QUEUED' AS status, CAST(NULL AS BIGINT) AS event_id, CAST(NULL AS VARCHAR) AS from_status, CAST(NULL AS VARCHAR) AS target, false AS valid FROM (SELECT DISTINCT key FROM e)
  UNION ALL SELECT e.key, e.i, CASE WHEN {_STEP.replace('target', 'e.target')} THEN e.target ELSE s.status END, e.event_id, s.status, e.target, {_STEP.replace('target', 'e.target')} FROM s JOIN e ON s.key = e.key AND e.i = s.i + 1)
SELECT event_id, from_status, target AS to_status, valid FROM s WHERE i > 0""")
def stream_machine(spark, d):
    """The evaluation state machine over events in four micro-batches; every step with whether it was allowed.

    Its leases are timers, with which a stream never runs out of work: it is stopped when all rows are in.
    """
    import time

    from ..streaming.machine import run_state_machine

    out, n = scratch(spark, "machine"), F.col("event_id")
    wanted = F.get(F.array(*(F.lit(x) for x in ("EVALUATING", "EVALUATED", "PASSED", "RETRYABLE_ERROR", "EVALUATING", "DEADLINE_EXCEEDED", "QUEUED"))), (n % 7).cast("int"))
    # a key's events are close in time, and the edges between batches fall among them
    key = (F.floor(F.col("user_id") / 10) * 1000 + F.floor(n / 40)).cast("string").alias("key")

    stream, total = _stream(spark, d, 4, [key, n.alias("ord"), wanted.alias("status"), F.when(n % 2 == 0, "invalid json").otherwise("timeout").alias("error")])
    buckets = _buckets(total)

    def run():
        steps = run_state_machine(stream, buckets).writeStream.format("parquet").option("path", out).option("checkpointLocation", f"{out}-log").start()
        try:
            while steps.isActive and sum(p["numInputRows"] for p in steps.recentProgress) < total:
                time.sleep(0.2)
            if not steps.isActive and steps.exception():
                raise steps.exception()
        finally:
            steps.stop()

    _with_rocksdb(spark, run, buckets)
    # the sink's log names the files of whole batches only
    return spark.read.parquet(out).where("ord >= 0").select(F.col("ord").alias("event_id"), "from_status", "to_status", "valid")
