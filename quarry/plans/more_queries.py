"""Further registered queries: classifiers, statuses, gates, cells, provider health and summaries."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import terms
from ..functions import collect as C
from ..functions import dates as D
from ..functions import score as S
from ..functions import text as X
from ..functions import url as U
from ..operators import listings as L
from ..operators import metrics as M
from ..operators import state as ST
from ..sources import sinks as K
from .queries import _CLASS, _MESSAGES, _TITLE, AS_OF, _sql_any, _sql_hits, _t, query

_PLACE = "(['Pune, Baner', 'Remote', 'New York, USA', 'Delhi', 'HSR Layout Bengaluru'])"
_PLACES = ["Pune, Baner", "Remote", "New York, USA", "Delhi", "HSR Layout Bengaluru"]


def _pick(items, n):
    return F.get(F.array(*(F.lit(x) for x in items)), n.cast("int"))


@query(f"""SELECT c_custkey, CAST(CASE WHEN h > 0 THEN least(5, 2 + h) WHEN r THEN 5 WHEN o THEN 0 ELSE 1 END AS INTEGER) AS score, h = 0 AND NOT r AND o AS reject
FROM (SELECT c_custkey, {_sql_hits('p', terms.PREFERRED_LOCATIONS)} AS h, {_sql_any('p', ['remote', 'work from home', 'wfh'])} AS r, {_sql_any('p', terms.OUTSIDE_LOCATIONS)} AS o FROM (SELECT c_custkey, lower({_PLACE}[CAST(c_custkey % 5 AS INTEGER) + 1]) AS p FROM customer))""")
def location_gate(spark, d):
    rows = _t(spark, d, "customer").select("c_custkey", S.location_gate(_pick(_PLACES, F.col("c_custkey") % 5)).alias("g"))
    return rows.select("c_custkey", "g.score", "g.reject")


_DEGREE = ["B.Tech degree", "any engineering branch", "Computer Science candidates only", "strictly it"]


@query(f"""SELECT c_custkey, CAST(CASE WHEN cs THEN 0 WHEN {_sql_any('t', terms.EDUCATION_OPEN)} THEN 4 ELSE 2 END AS INTEGER) AS score, cs AS reject
FROM (SELECT c_custkey, t, regexp_matches(t, '{terms.CS_ONLY_PATTERN}') AS cs FROM (SELECT c_custkey, lower(({_DEGREE})[CAST(c_custkey % 4 AS INTEGER) + 1]) AS t FROM customer))""")
def education_gate(spark, d):
    rows = _t(spark, d, "customer").select("c_custkey", S.education_gate(_pick(_DEGREE, F.col("c_custkey") % 4)).alias("g"))
    return rows.select("c_custkey", "g.score", "g.reject")


@query(f"""SELECT page_id, length(trim(html)) >= 250 AND {_sql_any('lower(html)', terms.JOB_TEXT_SIGNALS)} AS job_text, length(trim(html)) BETWEEN 1 AND 399 AND {_sql_any('lower(html)', terms.ANTI_BOT_SIGNALS)} AS anti_bot,
 CASE WHEN html = '' OR {_sql_any('lower(html)', terms.DETAIL_BAD_SIGNALS)} THEN false WHEN length(html) < 500 THEN true ELSE {_sql_any('lower(html)', terms.DETAIL_SIGNALS)} END AS detail FROM pages""")
def page_text_checks(spark, d):
    html = F.col("html")
    return _t(spark, d, "pages").select("page_id", X.is_job_text(html).alias("job_text"), X.is_anti_bot(html).alias("anti_bot"), X.is_valid_detail(html).alias("detail"))


def _sql_company() -> str:
    out = "concat(upper(left(h, 1)), lower(substr(h, 2)))"
    for sep in (" | ", " - ", " at "):
        piece = f"trim(split_part(t, '{sep}', 2), ' -|')"
        out = f"CASE WHEN contains(t, '{sep}') AND length({piece}) BETWEEN 2 AND 59 THEN {piece} ELSE {out} END"
    return out


@query(rf"SELECT page_id, {_sql_company()} AS company FROM (SELECT page_id, {_TITLE} AS t, regexp_extract(url, 'https?://(?:www\.)?([^./]+)\.', 1) AS h FROM pages)")
def company_guess(spark, d):
    title = F.regexp_extract("html", r"(?is)<title>(.*?)</title>", 1)
    return _t(spark, d, "pages").select("page_id", X.company_from_result(title, F.col("url")).alias("company"))


@query("SELECT page_id, CAST(CASE WHEN contains(url, 'example.com') THEN 0 WHEN contains(url, 'example.net') THEN 1 ELSE 2 END AS INTEGER) AS tier FROM pages")
def priority_tier(spark, d):
    return _t(spark, d, "pages").select("page_id", U.priority_tier(F.col("url"), ["example.com", "example.net"]).alias("tier"))


_UNITS, _HOURS = ["hour", "day", "week", "month"], [1, 24, 168, 720]
_AMOUNT, _UNIT = "(o_orderkey % 17 + 1)", f"({_UNITS})[o_orderkey % 4 + 1]"


@query(f"""SELECT o_orderkey, CASE WHEN o_orderkey % 9 = 0 THEN '{AS_OF}' WHEN o_orderkey % 9 = 1 THEN strftime(o_orderdate + INTERVAL 30 YEAR, '%Y-%m-%d') WHEN o_orderkey % 9 = 2 THEN ''
 ELSE strftime(TIMESTAMP '{AS_OF} 12:00:00' - INTERVAL 1 HOUR * ({_AMOUNT} * ({_HOURS})[o_orderkey % 4 + 1]), '%Y-%m-%d') || ' (approx, from ''posted ' || {_AMOUNT} || ' ' || {_UNIT} || '(s) ago'')' END AS posted FROM orders""")
def posting_date_guess(spark, d):
    as_of, n = F.lit(f"{AS_OF} 12:00:00").cast("timestamp_ntz"), F.col("o_orderkey")
    day = F.date_format(F.add_months("o_orderdate", 360), "yyyy-MM-dd")
    said = F.when(n % 9 == 0, "It is new: Just Posted").when(n % 9 == 1, F.concat(F.lit("since "), day, F.lit(", 2040-01-01"))).when(n % 9 == 2, "posted long ago 1999-01-01")
    ago = F.concat(F.lit("a role, POSTED "), n % 17 + 1, F.when(n % 2 == 0, "+ ").otherwise(" "), _pick(_UNITS, n % 4), F.lit("s ago, on 2031-01-01"))
    return _t(spark, d, "orders").select("o_orderkey", D.posting_date_guess(F.coalesce(said, ago), as_of).alias("posted"))


@query(f"""SELECT n_nationkey, CASE WHEN f AND c = 'HTTP_429' THEN 'RATE_LIMITED' WHEN f AND c IN ('HTTP_403', 'BLOCKED') THEN 'BLOCKED' WHEN f AND c = 'TIMEOUT' THEN 'TIMEOUT' WHEN f AND n > 0 THEN 'DEGRADED' WHEN f THEN 'FAILED' WHEN n = 0 THEN 'NO_RESULTS' ELSE 'SUCCESS' END AS status
FROM (SELECT n_nationkey, n_nationkey % 3 AS n, n_nationkey % 2 = 0 AS f, {_CLASS} AS c FROM (SELECT n_nationkey, lower(({_MESSAGES})[n_nationkey % 8 + 1]) AS m FROM nation))""")
def source_status(spark, d):
    bad = F.col("n_nationkey") % 2 == 0
    message = F.when(bad, _pick(_MESSAGES, F.col("n_nationkey") % 8))
    return _t(spark, d, "nation").select("n_nationkey", M.source_status(message, F.when(bad, "ValueError"), F.col("n_nationkey") % 3).alias("status"))


@query("SELECT n_nationkey, CASE WHEN n_nationkey % 7 = 0 THEN 'BLOCKED' WHEN n_nationkey % 2 = 1 THEN 'FAILED' WHEN n_nationkey % 3 = 0 THEN 'NO_CANDIDATES' WHEN n_nationkey % 5 = 0 THEN 'CANDIDATES_NOT_VALIDATED' ELSE 'SUCCESS' END AS status FROM nation")
def seed_status(spark, d):
    n = F.col("n_nationkey")
    return _t(spark, d, "nation").select("n_nationkey", M.seed_status(n % 7 == 0, n % 2 == 0, n % 3, n % 5).alias("status"))


@query("""SELECT p_partkey, regexp_replace(lower(p_name), '[^\\p{L}\\p{N}]', '', 'g') AS key, replace(lower(p_name), ' ', '-') AS slug FROM part""".replace("\\\\", "\\"))
def key_and_slug(spark, d):
    return _t(spark, d, "part").select("p_partkey", X.normalise_key(F.col("p_name")).alias("key"), X.slug(F.col("p_name")).alias("slug"))


@query("""SELECT c_custkey, CASE WHEN s = '' AND v = '' THEN 'See listing' ELSE concat_ws(' | ', nullif(CASE WHEN e <> '' AND e <> s THEN s || ' to ' || e ELSE s END, ''), CASE WHEN v <> '' THEN 'Venue: ' || v END) END AS details
FROM (SELECT c_custkey, CASE WHEN c_custkey % 2 = 0 THEN '2026-01-10' ELSE '' END AS s, CASE WHEN c_custkey % 4 = 0 THEN '2026-01-12' ELSE '' END AS e, CASE WHEN c_custkey % 3 = 0 THEN c_mktsegment ELSE '' END AS v FROM customer)""")
def walkin_details(spark, d):
    n, text = F.col("c_custkey"), lambda c, v: F.when(c, v).otherwise("")
    line = L.walkin_details(F.lit(""), text(n % 2 == 0, F.lit("2026-01-10")), text(n % 4 == 0, F.lit("2026-01-12")), F.lit(""), text(n % 3 == 0, F.col("c_mktsegment")))
    return _t(spark, d, "customer").select("c_custkey", line.alias("details"))


@query("SELECT CAST(event_id AS VARCHAR) AS event_id, array_to_string([event_type, CAST(user_id AS VARCHAR)], '; ') AS tags, CASE WHEN value < 40 THEN 'true' ELSE 'false' END AS low, coalesce(CASE WHEN event_id % 2 = 0 THEN event_type END, '') AS maybe FROM events")
def sheet_cells(spark, d):
    rows = _t(spark, d, "events").select("event_id", F.array("event_type", F.col("user_id").cast("string")).alias("tags"), (F.col("value") < 40).alias("low"), F.when(F.col("event_id") % 2 == 0, F.col("event_type")).alias("maybe"))
    return K.as_cells(rows)


@query("""WITH w AS (SELECT doc_id, string_split(lower(text), ' ') AS w FROM documents), e AS (SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS i FROM w),
 f AS (SELECT doc_id, word, CASE word WHEN 'la' THEN 0 WHEN 'the' THEN 1 WHEN 'de' THEN 2 ELSE 2 + min(i) END AS place FROM e GROUP BY doc_id, word),
 k AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY place) AS nth FROM f)
SELECT doc_id, string_agg(word, ' ' ORDER BY place) AS words FROM k WHERE nth <= 30 GROUP BY doc_id""")
def priority_words(spark, d):
    words = F.split(F.lower("text"), " ")
    return _t(spark, d, "documents").select("doc_id", F.array_join(C.priority_order(words, ["la", "the", "de"]), " ").alias("words"))


_KIND = "CASE event_id % 6 WHEN 0 THEN 'REQUEST' WHEN 1 THEN 'SUCCESS' WHEN 2 THEN 'TIMEOUT' WHEN 3 THEN 'HTTP_429' WHEN 4 THEN 'HTTP_5XX' ELSE CASE WHEN value < 50 THEN 'INVALID_JSON' ELSE 'SUCCESS' END END"


@query(f"""WITH k AS (SELECT user_id, event_id, {_KIND} AS kind FROM events), o AS (SELECT *, CASE WHEN kind = 'SUCCESS' THEN 0 ELSE 1 END AS bad FROM k WHERE kind <> 'REQUEST'),
 i AS (SELECT *, sum(1 - bad) OVER (PARTITION BY user_id ORDER BY event_id ROWS UNBOUNDED PRECEDING) AS island FROM o), r AS (SELECT *, sum(bad) OVER (PARTITION BY user_id, island ORDER BY event_id ROWS UNBOUNDED PRECEDING) AS run FROM i),
 g AS (SELECT user_id, max_by(run, event_id) AS run, max_by(kind, event_id) AS last, count(*) FILTER (WHERE kind = 'SUCCESS') AS successes, count(*) FILTER (WHERE kind = 'TIMEOUT') AS timeouts FROM r GROUP BY user_id)
SELECT CAST(k.user_id AS VARCHAR) AS provider, count(*) FILTER (WHERE kind = 'REQUEST') AS requests, any_value(successes) AS successes, any_value(timeouts) AS timeouts, CAST(any_value(run) AS BIGINT) AS consecutive_failures,
 CASE WHEN any_value(last) = 'SUCCESS' THEN 'AVAILABLE' WHEN any_value(run) >= 3 THEN 'CIRCUIT_OPEN' WHEN any_value(last) = 'TIMEOUT' THEN 'TIMEOUTING' WHEN any_value(last) = 'HTTP_429' THEN 'RATE_LIMITED' ELSE 'DEGRADED' END AS state
FROM k JOIN g ON k.user_id = g.user_id GROUP BY k.user_id""")
def provider_health(spark, d):
    n = F.col("event_id") % 6
    kind = F.when(n == 0, "REQUEST").when(n == 1, "SUCCESS").when(n == 2, "TIMEOUT").when(n == 3, "HTTP_429").when(n == 4, "HTTP_5XX").when(F.col("value") < 50, "INVALID_JSON").otherwise("SUCCESS")
    rows = _t(spark, d, "events").select(F.col("event_id").alias("ord"), F.col("user_id").cast("string").alias("provider"), kind.alias("kind"), F.lit(1.0).alias("latency_seconds"), F.lit(0.0).alias("cooldown_seconds"))
    return ST.provider_health(rows).select("provider", "requests", "successes", "timeouts", "consecutive_failures", "state")


@query("""WITH m AS (SELECT page_id, '[one](' || url || ') ' || url || '. ' || html || ' [two](/a/' || page_id || ')' AS t FROM pages),
 l AS (SELECT page_id, list_concat(list_transform(regexp_extract_all(t, '\\[[^\\]]*\\]\\(([^)]*)\\)', 1), lambda x: trim(x)), list_transform(regexp_extract_all(t, 'https?://[^\\s\\)\\]\\>"'']+'), lambda u: rtrim(u, ').,;:'))) AS links FROM m),
 e AS (SELECT page_id, unnest(links) AS link, unnest(range(1, len(links) + 1)) AS i FROM l)
SELECT page_id, string_agg(link, ' ' ORDER BY i) AS links FROM (SELECT page_id, link, min(i) AS i FROM e GROUP BY page_id, link) GROUP BY page_id""".replace("\\\\", "\\"))
def links_in_text(spark, d):
    text = F.concat(F.lit("[one]("), "url", F.lit(") "), "url", F.lit(". "), "html", F.lit(" [two](/a/"), "page_id", F.lit(")"))
    return _t(spark, d, "pages").select("page_id", F.array_join(X.links_in_text(text), " ").alias("links"))


@query("SELECT user_id, event_id FROM (SELECT user_id, min(event_id) AS event_id FROM events GROUP BY user_id) ORDER BY event_id LIMIT 100")
def first_wins_capped(spark, d):
    rows = _t(spark, d, "events").select(F.col("user_id").cast("string").alias("u"), "user_id", "event_id")
    return L.first_wins_capped(rows, "u", ["event_id"], 100).select("user_id", "event_id")


@query("SELECT d.doc_id, coalesce(l.title, CAST(d.doc_id AS VARCHAR)) AS title FROM documents d LEFT JOIN (SELECT doc_id, 'quality ' || CAST(quality AS VARCHAR) AS title FROM labels) l ON d.doc_id = l.doc_id")
def metadata_lookup(spark, d):
    urls = _t(spark, d, "documents").select(F.col("doc_id").cast("string").alias("job_url"))
    extra = _t(spark, d, "labels").select(F.col("doc_id").cast("string").alias("job_url"), F.concat(F.lit("quality "), F.col("quality").cast("string")).alias("title"), F.lit(None).cast("string").alias("location"))
    return L.with_metadata(urls, extra).select(F.col("job_url").cast("long").alias("doc_id"), "title")


@query("SELECT doc_id FROM documents d WHERE EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id AND l.toxic = 1)")
def retry_rows(spark, d):
    state = _t(spark, d, "labels").select("doc_id", F.when(F.col("toxic") == 1, "QUEUED").otherwise("PASSED").alias("status"))
    return L.retry_rows(_t(spark, d, "documents").select("doc_id"), state, "doc_id")


@query("""SELECT count(*) AS seeds_attempted, CAST(sum(CASE WHEN n_nationkey % 2 = 0 THEN 1 ELSE 0 END) AS BIGINT) AS seeds_succeeded, CAST(sum(n_nationkey) AS BIGINT) AS pages_seen, CAST(sum(n_nationkey % 3) AS BIGINT) AS candidate_urls_found FROM nation""")
def discovery_totals(spark, d):
    n = F.col("n_nationkey")
    seeds = _t(spark, d, "nation").select((n % 2 == 0).alias("ok"), n.alias("pages"), (n % 5).alias("rows"), (n % 3).alias("candidates"), (n % 7 == 0).alias("anti_bot"))
    return M.discovery_totals(seeds).select("seeds_attempted", "seeds_succeeded", "pages_seen", "candidate_urls_found")


@query("SELECT event_id, CASE WHEN event_id % 2 = 0 AND ts < TIMESTAMP '2024-01-15' THEN 'RETRYABLE_ERROR' WHEN event_id % 2 = 0 THEN 'EVALUATING' ELSE 'PASSED' END AS status FROM events")
def release_stale(spark, d):
    status = F.when(F.col("event_id") % 2 == 0, "EVALUATING").otherwise("PASSED")
    rows = _t(spark, d, "events").select("event_id", status.alias("status"), F.col("ts").alias("lease_expires_at"), F.lit(None).cast("string").alias("last_error"))
    return ST.release_stale(rows, F.lit("2024-01-14 23:59:59.999999").cast("timestamp_ntz")).select("event_id", "status")
