"""Registered queries of the listing rules: scores, verdicts, classifiers, texts, dates, numbers and JSON."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import terms
from ..functions import collect as C
from ..functions import dates as D
from ..functions import jsonx as J
from ..functions import profile as P
from ..functions import score as S
from ..functions import text as X
from ..functions import url as U
from ..operators import listings as L
from ..sources import readers as R
from . import pipeline as PL
from .queries import _RE, _TITLE, _YEARS, _sql_any, _sql_hits, _sql_pairs, _sql_words, _t, query

TODAY = "2026-01-10"


def _list(items: list[str]) -> str:
    return "[" + ", ".join("'" + x.replace("'", "''") + "'" for x in items) + "]"


def _nth(items: list[str], n):
    return F.get(F.array(*(F.lit(x) for x in items)), n.cast("int"))


# ---- listings made of documents: varied titles, places, dates and notices before whole texts ----
TITLES = ["Software Engineer", "Senior Backend Developer", "React Developer (Fresher)", "Cook", "Junior Software Developer", "Staff Engineer", "Graduate Engineer Trainee", "AI Engineer - LLM"]
PLACES = ["Pune", "Remote", "Berlin, Germany", "Bengaluru, HSR Layout", "Delhi", "Hyderabad", ""]
NOTICES = [
    "Fresher role. Skills: React, Node.js, SQL and Docker. Write to hr@acme.io", "Minimum 4 years experience required in backend work", "5 years of experience preferred, freshers welcome. Python and Java.",
    "Walk-in drive on 15 January 2026 at Baner for freshers. React.", "Walk-in drive on 5 January 2026 for freshers", "Computer science graduates only. Fresher.",
    "Any branch may apply, 2026 batch. MERN and MongoDB; RAG and LLM with error classification.", "Entry level. Lead a team, manager track.", "BPO voice process walk-in on 5 January 2026 for freshers",
    "Hiring drive 12 to 14 January 2026, trainee engineer, campus hire. TypeScript.", "nothing of note",
]
#: The walk-in that a notice announces: first and last day.
DAYS = {3: ("2026-01-15", "2026-01-15"), 4: ("2026-01-05", "2026-01-05"), 8: ("2026-01-05", "2026-01-05"), 9: ("2026-01-12", "2026-01-14")}
_MADE = f"""SELECT doc_id, source, ({_list(TITLES)})[doc_id % 8 + 1] AS title, ({_list(PLACES)})[doc_id % 7 + 1] AS location, ({_list(NOTICES)})[doc_id % 11 + 1] || chr(10) || text AS description,
 CASE WHEN doc_id % 9 = 0 THEN '' WHEN doc_id % 9 = 1 THEN 'on 2026-13-40' ELSE strftime(DATE '{TODAY}' - CAST(doc_id % 53 - 5 AS INTEGER), '%Y-%m-%d') END AS posting_date FROM documents"""


def _listings(spark, d):
    n = F.col("doc_id")
    posted = F.when(n % 9 == 0, "").when(n % 9 == 1, "on 2026-13-40").otherwise(F.date_format(F.date_sub(F.lit(TODAY).cast("date"), (n % 53 - 5).cast("int")), "yyyy-MM-dd"))
    return _t(spark, d, "documents").select(
        "doc_id", "source", _nth(TITLES, n % 8).alias("title"), F.col("source").alias("company"), _nth(PLACES, n % 7).alias("location"),
        F.concat(_nth(NOTICES, n % 11), F.lit("\n"), "text").alias("description"), posted.alias("posting_date"),
    )


def _case(of: int) -> str:
    return "CASE doc_id % 11 " + " ".join(f"WHEN {k} THEN DATE '{v[of]}'" for k, v in DAYS.items()) + " END"


def _eligible(text: str) -> str:
    senior, graduate, years = _sql_hits(text, terms.SENIOR), _sql_any(text, terms.GRADUATE), _YEARS.replace("(t,", f"({text},")
    return f"NOT (({senior} >= 2 AND NOT {graduate}) OR ({years} > 1 AND NOT regexp_matches({text}, '{terms.YEARS_PATTERN}{terms.YEARS_PREFERRED}') AND NOT {graduate}))"


_AGE = f"date_diff('day', try_cast(nullif(regexp_extract(posting_date, '\\b(20\\d{{2}}-\\d{{2}}-\\d{{2}})\\b', 1), '') AS DATE), DATE '{TODAY}')"
_PREFILTER = f"""
WITH l AS (SELECT *, lower(title) AS t, lower(description) AS d, lower(location) AS p, lower(title) || ' ' || lower(description) || ' ' || lower(source) || ' ' || lower(location) AS f FROM ({_MADE})),
facts AS (
  SELECT doc_id, 2 * {_sql_hits('t', terms.SENIOR)} + {_sql_hits('d', terms.SENIOR)} AS senior, {_eligible('d')} AS eligible, {_sql_words('t', terms.ROLES)} AS tr, {_sql_words('d', terms.ROLES)} AS dr,
    {_sql_hits('f', terms.CORE_TECH)} AS tech, {_sql_hits('f', terms.PROFILE)} AS prof, {_sql_hits('f', terms.INFRASTRUCTURE)} AS infra, {_sql_hits('f', terms.FRESHER)} AS fresh,
    {_sql_hits('p', terms.PREFERRED_LOCATIONS)} AS near, {_sql_any('p', ['remote', 'work from home', 'wfh'])} AS remote, {_sql_any('p', terms.OUTSIDE_LOCATIONS)} AS abroad,
    regexp_matches(t || ' ' || d, '{terms.CS_ONLY_PATTERN}') AS cs, {_sql_any("(t || ' ' || d)", terms.EDUCATION_OPEN)} AS open_to, {_AGE} AS age,
    {_sql_any('f', terms.WALKIN_POSITIVE)} AND NOT {_sql_any('f', terms.WALKIN_NEGATIVE)} AS walkin, {_sql_any('f', terms.NEIGHBOURHOODS)} AS hood, regexp_extract(description, '{terms.EMAIL_PATTERN}') <> '' AS mail, {_case(1)} AS last_day
  FROM l)
SELECT doc_id, CAST(CASE WHEN senior >= 2 OR NOT eligible OR (tr = 0 AND dr = 0) OR (near = 0 AND NOT remote AND abroad) OR cs OR coalesce(age > 30, false) OR (walkin AND coalesce(last_day < DATE '{TODAY}', false)) OR fresh = 0 THEN 0
  ELSE greatest(0, 5 * least(tr, 3) + least(dr, 3) + 2 * least(tech, 6) + least(prof, 8) + least(infra, 2) + 4 * least(fresh, 2)
    + CASE WHEN near > 0 THEN least(5, 2 + near) WHEN remote THEN 5 WHEN abroad THEN 0 ELSE 1 END + CASE WHEN cs THEN 0 WHEN open_to THEN 4 ELSE 2 END
    + CASE WHEN age IS NULL THEN 0 WHEN age < 0 THEN 1 WHEN age <= 3 THEN 4 WHEN age <= 7 THEN 2 WHEN age <= 30 THEN 0 ELSE -3 END
    + CASE WHEN walkin AND (tr > 0 OR (dr > 0 AND tech > 0)) THEN 15 + CASE WHEN hood THEN 35 ELSE 0 END ELSE 0 END + CASE WHEN mail THEN 1 ELSE 0 END - senior) END AS INTEGER) AS prefilter_score FROM facts"""


@query(_PREFILTER)
def prefilter_score(spark, d):
    return S.prefilter_score(_listings(spark, d), F.lit(TODAY).cast("date")).select("doc_id", "prefilter_score")


# ---- verdicts ----
_CLAIM = "CASE doc_id % 5 WHEN 0 THEN '' WHEN 1 THEN '2026-01-15' WHEN 2 THEN '2026-01-13' WHEN 3 THEN 'soon' ELSE '2026-02-31' END"
_POINTS = {"role_match": 3, "experience_match": 5, "technical_match": 7, "project_match": 11, "education_match": 13, "location_match": 17, "company_quality": 19}
_FIT = " + ".join(f"least({cap}, doc_id % {_POINTS[c]} * 5)" for c, cap in terms.COMPONENT_CAPS.items())
_WALKIN = r"SELECT *, regexp_matches(claimed, '\d{4}-\d{2}-\d{2}') AS has, try_cast(nullif(regexp_extract(claimed, '(\d{4}-\d{2}-\d{2})', 1), '') AS DATE) AS claim FROM l"
_DAY = "CASE WHEN has AND claim IS NULL THEN NULL WHEN has AND ((a IS NULL AND b IS NULL) OR coalesce(claim BETWEEN a AND b, false) OR coalesce(claim = a, false)) THEN claim ELSE a END"
_CONFLICT = "(has AND claim IS NOT NULL AND NOT ((a IS NULL AND b IS NULL) OR coalesce(claim BETWEEN a AND b, false) OR coalesce(claim = a, false))) OR (NOT has AND a IS NOT NULL AND claimed <> '' AND strftime(a, '%Y-%m-%d') <> claimed)"
_STATUS = f"CASE WHEN day IS NULL THEN 'unknown' WHEN DATE '{TODAY}' > coalesce(b, day) THEN 'expired' WHEN DATE '{TODAY}' >= coalesce(a, day) AND DATE '{TODAY}' <= coalesce(b, day) THEN 'active' ELSE 'upcoming' END"


@query(f"""WITH l AS (SELECT doc_id, title, description, doc_id % 3 > 0 AS walkin, CASE WHEN doc_id % 3 > 0 THEN {_case(0)} END AS a, CASE WHEN doc_id % 3 > 0 THEN {_case(1)} END AS b, {_CLAIM} AS claimed, doc_id % 4 > 0 AS fresher, {_FIT} AS fit,
   {_eligible("lower(title || ' ' || description)")} AS ok, ({_sql_hits("lower(title || ' ' || description)", terms.SENIOR)}) >= 2 AND NOT {_sql_any("lower(title || ' ' || description)", terms.GRADUATE)} AS too_senior, {_YEARS.replace("(t,", "(lower(title || ' ' || description),")} AS years FROM ({_MADE})),
 w AS ({_WALKIN}), x AS (SELECT *, {_DAY} AS day, {_CONFLICT} AS clash FROM w), s AS (SELECT *, CASE WHEN walkin THEN {_STATUS} END AS status FROM x),
 r AS (SELECT *, NOT ok OR coalesce(status = 'expired', false) AS reject FROM s)
SELECT doc_id, CAST(CASE WHEN reject THEN 0 ELSE fit END AS INTEGER) AS fit_score, fresher AND NOT reject AS fresher_appropriate,
  CASE WHEN reject THEN 'Reject' WHEN fit >= 90 THEN 'Exceptional' WHEN fit >= 80 THEN 'Strong' WHEN fit >= 70 THEN 'Good' WHEN fit >= 60 THEN 'Reasonable' ELSE 'Weak' END AS fit_tier,
  CASE WHEN NOT ok THEN CASE WHEN too_senior THEN 'Role appears too senior based on title/description keywords.' ELSE 'Mandatory experience (' || years || '+ years) exceeds 1 year and no fresher signal found.' END
       WHEN coalesce(status = 'expired', false) THEN 'Walk-in drive has expired.' WHEN doc_id % 2 = 0 THEN 'good; fit' ELSE 'because' END AS reason,
  coalesce(status, '') AS verification_status, walkin AND coalesce(clash, false) AS walkin_date_conflict, coalesce(CASE WHEN walkin THEN strftime(day, '%Y-%m-%d') END, '') AS walkin_date,
  NOT reject AND fit >= 70 AND fresher AS passed FROM r""")
def apply_verdict(spark, d):
    n = F.col("doc_id")
    claim = F.when(n % 5 == 0, "").when(n % 5 == 1, "2026-01-15").when(n % 5 == 2, "2026-01-13").when(n % 5 == 3, "soon").otherwise("2026-02-31")
    why = F.when(n % 2 == 0, F.array(F.lit("good"), F.lit("fit")))
    verdict = F.struct(
        *((n % m * 5).cast("int").alias(c) for c, m in _POINTS.items()), (n % 3 > 0).alias("is_walkin"), claim.alias("walkin_date"), F.lit("hall").alias("venue"),
        (n % 4 > 0).alias("is_fresher_appropriate"), why.alias("why"), F.lit("because").alias("reason"), F.lit(None).cast("array<string>").alias("gaps"),
    )
    judged = L.apply_verdict(_listings(spark, d).withColumn("verdict", verdict), F.lit(TODAY).cast("date"))
    return judged.select("doc_id", "fit_score", "fresher_appropriate", "fit_tier", "reason", "verification_status", "walkin_date_conflict", "walkin_date", "passed")


@query(f"""WITH l AS (SELECT o_orderkey, CASE WHEN o_orderkey % 4 = 0 THEN NULL ELSE CAST(o_orderdate AS DATE) END AS a, CASE WHEN o_orderkey % 4 = 0 THEN NULL ELSE CAST(o_orderdate AS DATE) + CAST(o_orderkey % 3 AS INTEGER) END AS b,
  CASE o_orderkey % 7 WHEN 0 THEN '' WHEN 1 THEN 'next week' WHEN 2 THEN '1998-02-30' ELSE strftime(CAST(o_orderdate AS DATE) + CAST(o_orderkey % 5 AS INTEGER), '%Y-%m-%d') END AS claimed FROM orders),
 w AS ({_WALKIN}), x AS (SELECT *, {_DAY} AS day, {_CONFLICT} AS clash FROM w)
SELECT o_orderkey, strftime(day, '%Y-%m-%d') AS day, {_STATUS.replace(TODAY, '1998-08-02')} AS status, coalesce(clash, false) AS conflict FROM x""")
def walkin_status(spark, d):
    n, day = F.col("o_orderkey"), F.to_date("o_orderdate")
    start = F.when(n % 4 > 0, day)
    claim = F.when(n % 7 == 0, "").when(n % 7 == 1, "next week").when(n % 7 == 2, "1998-02-30").otherwise(F.date_format(F.date_add(day, (n % 5).cast("int")), "yyyy-MM-dd"))
    found = D.walkin_status(start, F.when(n % 4 > 0, F.date_add(day, (n % 3).cast("int"))), claim, F.lit("1998-08-02").cast("date"))
    return _t(spark, d, "orders").select(n, found.alias("w")).select(n, F.date_format("w.date", "yyyy-MM-dd").alias("day"), "w.status", "w.conflict")


# ---- URLs and titles ----
HOSTS = ["https://www.naukri.com", "https://indeed.com", "https://jobs.lever.co", "http://wellfound.com", "https://youtube.com", "https://example.com", "ftp://indeed.com"]
PATHS = ["/job/x-1", "/jobs-in-pune", "/python-jobs", "/acme/id-9", "/viewjob?ref=1&jk=2", "/search/job", "/", "/careers/dev;v=1#top", "/a/b"]
_MADE_URL = f"({_list(HOSTS)})[page_id % 7 + 1] || ({_list(PATHS)})[page_id % 9 + 1]"
_LINK_TITLES = ["Software Engineer at X", "12,000 Python Job Vacancies", "About us", ""]
_STRICT = f"CASE WHEN s = '' OR h = '' THEN '' ELSE s || '://' || h || CASE WHEN p = '' THEN '/' ELSE p END || coalesce('?' || {_sql_pairs('q')}, '') END"
_HOST = "regexp_replace(lower(h), '^www\\.', '')"


@query(f"""WITH u AS (SELECT page_id, {_MADE_URL} AS url, lower(CASE WHEN page_id % 5 = 4 THEN {_TITLE} ELSE ({_list(_LINK_TITLES)})[page_id % 4 + 1] END) AS t, lower(CASE WHEN page_id % 3 = 0 THEN 'Apply now' ELSE '' END) AS x FROM pages),
 p AS (SELECT *, regexp_extract(url, '{_RE}', 1) AS s, regexp_extract(url, '{_RE}', 2) AS h, regexp_replace(regexp_extract(url, '{_RE}', 3), ';[^/]*$', '') AS p, regexp_extract(url, '{_RE}', 4) AS q FROM u),
 c AS (SELECT *, {_STRICT} AS c, len(list_filter(string_split(p, '/'), lambda y: y <> '')) AS depth FROM p)
SELECT page_id, CASE WHEN c = '' OR {_HOST} IN ({', '.join(f"'{x}'" for x in terms.NON_JOB_DOMAINS)}) OR {_HOST} NOT IN ({', '.join(f"'{x}'" for x in terms.BOARD_DOMAINS)}) THEN false
 WHEN {_sql_any('lower(c)', terms.AGGREGATE_MARKERS)} THEN false WHEN regexp_matches(p, '(?i)-jobs(-in-[a-z-]+)?(/?$|\\?)') THEN false WHEN regexp_matches(t, '^\\d[\\d,]*\\s+.*job\\s+vacanc') THEN false
 WHEN regexp_matches(lower(c), '{"|".join(terms.JOB_URL_PATTERNS)}') THEN true WHEN (contains(lower(h), 'jobs.lever.co') OR contains(lower(h), 'jobs.ashbyhq.com')) AND depth >= 2 THEN true
 ELSE ({_sql_any('t', terms.JOB_TITLE_SIGNALS)} OR {_sql_any('x', terms.JOB_LINK_TEXT_SIGNALS)}) AND depth >= 1 END AS job FROM c""")
def looks_job_url(spark, d):
    n = F.col("page_id")
    title = F.when(n % 5 == 4, F.regexp_extract("html", r"(?is)<title>(.*?)</title>", 1)).otherwise(_nth(_LINK_TITLES, n % 4))
    url = F.concat(_nth(HOSTS, n % 7), _nth(PATHS, n % 9))
    return _t(spark, d, "pages").select("page_id", U.looks_job_url(url, title, F.when(n % 3 == 0, "Apply now").otherwise("")).alias("job"))


_COMPANY_TITLE = f"CASE page_id % 6 WHEN 0 THEN 'Dev at ' || t WHEN 1 THEN 'Dev - ' || t WHEN 2 THEN 'Dev | ' || t || ' -' WHEN 3 THEN 'Dev - ' || left(t, 60) || ' - 3 Years of Experience' WHEN 4 THEN t ELSE 'Dev at X at ' || left(t, 40) END"


def _sql_company_from_title() -> str:
    host = r"regexp_replace(lower(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)', 1)), '^www\.', '')"
    out = f"concat(upper(left(split_part({host}, '.', 1), 1)), lower(substr(split_part({host}, '.', 1), 2)))"
    for sep in (" | ", " - ", " at "):
        tail = f"trim(substr(m, strpos(m, '{sep}') + {len(sep)}), ' -|')"
        out = f"CASE WHEN contains(m, '{sep}') AND length({tail}) BETWEEN 2 AND 79 THEN {tail} ELSE {out} END"
    parts = "list_filter(list_transform(string_split(m, ' - '), lambda s: trim(s, ' ')), lambda s: s <> '')"
    return f"CASE WHEN len({parts}) >= 3 AND regexp_matches({parts}[-1], '(?i)years? of experience|yrs? of experience') AND length({parts}[-2]) BETWEEN 2 AND 79 THEN {parts}[-2] ELSE {out} END"


@query(f"SELECT page_id, {_sql_company_from_title()} AS company FROM (SELECT page_id, url, {_COMPANY_TITLE} AS m FROM (SELECT page_id, url, left({_TITLE}, 70) AS t FROM pages))")
def company_from_title(spark, d):
    n, t = F.col("page_id"), F.substring(F.regexp_extract("html", r"(?is)<title>(.*?)</title>", 1), 1, 70)
    made = F.when(n % 6 == 0, F.concat(F.lit("Dev at "), t)).when(n % 6 == 1, F.concat(F.lit("Dev - "), t)).when(n % 6 == 2, F.concat(F.lit("Dev | "), t, F.lit(" -"))).when(n % 6 == 3, F.concat(F.lit("Dev - "), F.substring(t, 1, 60), F.lit(" - 3 Years of Experience"))).when(n % 6 == 4, t).otherwise(F.concat(F.lit("Dev at X at "), F.substring(t, 1, 40)))
    return _t(spark, d, "pages").select("page_id", X.company_from_title(made, F.col("url")).alias("company"))


@query(f"SELECT doc_id, coalesce(list_filter({_list(terms.PREFERRED_LOCATIONS)}, lambda p: contains(x, lower(p)))[1], 'India') AS place FROM (SELECT doc_id, lower(text || ' ' || location) AS x FROM ({_MADE.replace('FROM documents', ', text FROM documents')}))")
def location_guess(spark, d):
    made = _t(spark, d, "documents").select("doc_id", F.concat_ws(" ", "text", _nth(PLACES, F.col("doc_id") % 7)).alias("x"))
    return made.select("doc_id", X.location_guess(F.col("x")).alias("place"))


@query(f"SELECT event_id, {_sql_any('m', terms.PERMANENT_ERRORS)} AS permanent FROM (SELECT event_id, lower(({_list(terms.PERMANENT_ERRORS[:9] + ['timeout', 'HTTP_503', 'Down'])})[event_id % 12 + 1] || ': ' || event_type) AS m FROM events)")
def permanent_error(spark, d):
    m = F.concat_ws(": ", _nth([*terms.PERMANENT_ERRORS[:9], "timeout", "HTTP_503", "Down"], F.col("event_id") % 12), "event_type")
    return _t(spark, d, "events").select("event_id", X.is_permanent_error(m).alias("permanent"))


_VIDEO = "CASE event_id % 6 WHEN 0 THEN 'https://www.youtube.com/watch?t=1&v=' || v WHEN 1 THEN 'https://youtu.be/' || v || '?x=1' WHEN 2 THEN 'https://www.youtube.com/channel/UC' || v WHEN 3 THEN 'https://youtube.com/@name.' || user_id || '/videos' WHEN 4 THEN 'https://youtube.com/c/' || event_type ELSE 'https://youtube.com/watch?v=short' END"


@query(f"""SELECT event_id, coalesce(nullif(regexp_extract(u, '[?&]v=([A-Za-z0-9_-]{{11}})', 1), ''), nullif(regexp_extract(u, 'youtu\\.be/([A-Za-z0-9_-]{{11}})', 1), ''), '') AS video,
 CASE WHEN contains(u, '/channel/') THEN 'id' WHEN contains(u, '/@') THEN 'handle' WHEN contains(u, '/c/') THEN 'user' END AS kind,
 nullif(regexp_extract(u, '/(?:channel/|@|c/)([A-Za-z0-9._-]+)', 1), '') AS channel FROM (SELECT event_id, {_VIDEO} AS u FROM (SELECT *, lpad(CAST(event_id AS VARCHAR), 11, 'a') AS v FROM events))""")
def video_ids(spark, d):
    n, v = F.col("event_id"), F.lpad(F.col("event_id").cast("string"), 11, "a")
    made = F.when(n % 6 == 0, F.concat(F.lit("https://www.youtube.com/watch?t=1&v="), v)).when(n % 6 == 1, F.concat(F.lit("https://youtu.be/"), v, F.lit("?x=1"))).when(n % 6 == 2, F.concat(F.lit("https://www.youtube.com/channel/UC"), v)).when(n % 6 == 3, F.concat(F.lit("https://youtube.com/@name."), "user_id", F.lit("/videos"))).when(n % 6 == 4, F.concat(F.lit("https://youtube.com/c/"), "event_type")).otherwise("https://youtube.com/watch?v=short")
    rows = _t(spark, d, "events").select("event_id", made.alias("u"))
    return rows.select("event_id", U.video_id(F.col("u")).alias("video"), U.channel_ref(F.col("u")).alias("c")).select("event_id", "video", "c.kind", F.col("c.id").alias("channel"))


@query(r"""WITH l AS (SELECT page_id, url, regexp_extract_all(html, 'href="([^"]*)"', 1) AS links FROM pages), e AS (SELECT page_id, url, i AS nth, links[i] AS x FROM l, unnest(range(1, len(links) + 1)) AS r(i)),
 m AS (SELECT page_id, nth, url, CASE WHEN nth % 5 = 1 AND starts_with(x, '/') THEN substr(x, 2) WHEN nth % 5 = 2 THEN '?p=' || nth WHEN nth % 5 = 3 THEN '//cdn.example.org' || x ELSE x END AS x FROM e WHERE NOT contains(x, '..')),
 b AS (SELECT *, regexp_extract(url, '^(\w+://[^/?#]*)', 1) AS o, regexp_extract(url, '^(\w+:)', 1) AS s, regexp_extract(url, '^([^?#]*)', 1) AS plain, coalesce(nullif(regexp_extract(regexp_extract(url, '^\w+://[^/?#]*([^?#]*)', 1), '^(.*/)', 1), ''), '/') AS folder FROM m)
SELECT page_id, nth, CASE WHEN regexp_matches(x, '^[A-Za-z][A-Za-z0-9+.-]*:') THEN x WHEN starts_with(x, '//') THEN s || x WHEN x = '' THEN url WHEN starts_with(x, '?') THEN plain || x WHEN starts_with(x, '#') THEN regexp_extract(url, '^([^#]*)', 1) || x WHEN starts_with(x, '/') THEN o || x ELSE o || folder || x END AS link FROM b""")
def absolute_links(spark, d):
    links = F.regexp_extract_all("html", F.lit(r'href="([^"]*)"'), F.lit(1))
    rows = _t(spark, d, "pages").select("page_id", "url", F.posexplode(links).alias("at", "x")).withColumn("nth", (F.col("at") + 1).cast("long")).where(~F.col("x").contains(".."))
    n, x = F.col("nth") % 5, F.col("x")
    made = F.when((n == 1) & x.startswith("/"), F.expr("substr(x, 2)")).when(n == 2, F.concat(F.lit("?p="), "nth")).when(n == 3, F.concat(F.lit("//cdn.example.org"), x)).otherwise(x)
    return rows.select("page_id", "nth", U.absolute_url(made, F.col("url")).alias("link"))


@query(r"""WITH m AS (SELECT page_id, url, 'see [' || left(regexp_extract(html, '(?is)<title>([^<\[\]()]*)', 1), 30) || '](/a/' || page_id || ') and ![pic](https://x.org/i.png) [](empty)' AS md FROM pages)
SELECT page_id, nth, href, text FROM (
 SELECT page_id, 1 AS nth, regexp_extract(url, '^(\w+://[^/?#]*)', 1) || '/a/' || page_id AS href, trim(regexp_extract(md, '\[([^\]]+)\]', 1), ' ') AS text FROM m WHERE regexp_extract(md, '\[([^\]]*)\]', 1) <> ''
 UNION ALL SELECT page_id, CASE WHEN regexp_extract(md, '\[([^\]]*)\]', 1) <> '' THEN 2 ELSE 1 END, 'https://x.org/i.png', 'pic' FROM m
 UNION ALL SELECT page_id, CASE WHEN regexp_extract(md, '\[([^\]]*)\]', 1) <> '' THEN 3 ELSE 2 END, url, 'own' FROM m)""")
def link_harvest(spark, d):
    title = F.substring(F.regexp_extract("html", r"(?is)<title>([^<\[\]()]*)", 1), 1, 30)
    made = F.concat(F.lit("see ["), title, F.lit("](/a/"), "page_id", F.lit(") and ![pic](https://x.org/i.png) [](empty)"))
    found = F.array(F.struct(F.col("url").alias("href"), F.lit("own").alias("text")), F.struct(F.lit("").alias("href"), F.lit("none").alias("text")))
    rows = _t(spark, d, "pages").select("page_id", F.posexplode(X.harvested_links(made, F.col("url"), found)).alias("at", "l"))
    return rows.select("page_id", (F.col("at") + 1).cast("int").alias("nth"), "l.href", "l.text")


# ---- dates and numbers ----
_TEXT_DAY = "CASE event_id % 4 WHEN 0 THEN 'seen ' || strftime(ts, '%Y-%m-%d') || ', 2030-01-01' WHEN 1 THEN 'x2024-01-01' WHEN 2 THEN 'on 2024-02-30' ELSE strftime(ts, '%Y-%m-%d') END"


@query(f"""SELECT event_id, strftime(try_cast(nullif(regexp_extract(x, '\\b(20\\d{{2}}-\\d{{2}}-\\d{{2}})\\b', 1), '') AS DATE), '%Y-%m-%d') AS day, CASE event_id % 4 WHEN 2 THEN true ELSE ts >= TIMESTAMP '2024-01-14 12:00:00' - INTERVAL 48 HOUR END AS recent,
 greatest(0.0, epoch_us(TIMESTAMP '2024-01-10 00:00:00') / 1e6 - epoch_us(ts) / 1e6) AS seconds, abs(CAST(floor(epoch(ts)) AS BIGINT) - CAST(epoch(TIMESTAMP '2024-01-10 00:00:00') AS BIGINT)) > 300 AS drifted, strftime(ts, '%Y-%m-%d %H:%M') AS shown FROM (SELECT *, {_TEXT_DAY} AS x FROM events)""")
def event_dates(spark, d):
    n, at = F.col("event_id"), F.col("ts").cast("timestamp")
    day = F.date_format("ts", "yyyy-MM-dd")
    x = F.when(n % 4 == 0, F.concat(F.lit("seen "), day, F.lit(", 2030-01-01"))).when(n % 4 == 1, "x2024-01-01").when(n % 4 == 2, "on 2024-02-30").otherwise(day)
    fixed = lambda t: F.lit(t).cast("timestamp")
    text = F.when(n % 4 == 2, "no time").otherwise(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'"))
    return _t(spark, d, "events").select(
        "event_id", F.date_format(D.iso_date(x), "yyyy-MM-dd").alias("day"), D.within_hours(D.utc_timestamp(text), fixed("2024-01-14 12:00:00")).alias("recent"),
        D.duration_seconds(at, fixed("2024-01-10 00:00:00")).alias("seconds"), D.drifted(at, fixed("2024-01-10 00:00:00")).alias("drifted"), F.date_format("ts", "yyyy-MM-dd HH:mm").alias("shown"),
    )


@query("""SELECT o_orderkey, coalesce(try_cast(CASE WHEN regexp_matches(trim(x), '^[+-]?\\d+$') THEN trim(x) END AS INTEGER), -1) AS number, CASE WHEN lower(trim(x)) IN ('true', 'yes', '1') THEN true WHEN lower(trim(x)) IN ('false', 'no', '0') THEN false ELSE true END AS flag,
 CAST(least(60, 15 * pow(2, o_orderkey % 5)) AS INTEGER) AS pause, o_orderkey % 3 = 0 AS same
 FROM (SELECT o_orderkey, CASE o_orderkey % 8 WHEN 0 THEN '3.7' WHEN 1 THEN ' 12 ' WHEN 2 THEN 'Yes' WHEN 3 THEN 'no ' WHEN 4 THEN '1' WHEN 5 THEN '-4' WHEN 6 THEN '' ELSE CAST(o_custkey AS VARCHAR) END AS x FROM orders)""".replace("\\\\", "\\"))
def safe_numbers(spark, d):
    n = F.col("o_orderkey")
    x = F.when(n % 8 == 0, "3.7").when(n % 8 == 1, " 12 ").when(n % 8 == 2, "Yes").when(n % 8 == 3, "no ").when(n % 8 == 4, "1").when(n % 8 == 5, "-4").when(n % 8 == 6, "").otherwise(F.col("o_custkey").cast("string"))
    left = F.struct("o_custkey", F.when(n % 3 == 1, None).otherwise(F.col("o_orderstatus")).alias("s"))
    right = F.struct((F.col("o_custkey") + (n % 3 == 2).cast("int")).alias("o_custkey"), F.col("o_orderstatus").alias("s"))
    rows = _t(spark, d, "orders").select("o_orderkey", x.alias("x"), left.alias("a"), right.alias("b"))
    return rows.select("o_orderkey", S.as_int(F.col("x"), -1).alias("number"), S.as_bool(F.col("x"), True).alias("flag"), S.backoff_seconds(n % 5).alias("pause"), S.same_identity(["o_custkey", "s"], "a", "b").alias("same"))


# ---- JSON, lists and profiles ----
@query("""SELECT event_id, CASE event_id % 4 WHEN 0 THEN '' WHEN 1 THEN event_type WHEN 2 THEN event_type || '|' || user_id ELSE '' END AS items,
 CAST(event_id % 7 AS INTEGER) AS first, CAST(event_id % 5 AS VARCHAR) || ',' || CAST(event_id % 7 AS VARCHAR) AS by_level, CASE WHEN event_id % 5 = event_id % 7 THEN CAST(event_id % 7 AS VARCHAR) ELSE CAST(event_id % 7 AS VARCHAR) || ',' || CAST(event_id % 5 AS VARCHAR) END AS in_depth,
 '{"id":' || event_id || ',"in":[{"keep":"' || event_type || '"}]}' AS scrubbed FROM events""")
def json_lookups(spark, d):
    n = F.col("event_id")
    listed = F.when(n % 4 == 0, F.lit(None).cast("string")).when(n % 4 == 1, F.concat(F.lit('" '), "event_type", F.lit(' "'))).when(n % 4 == 2, F.concat(F.lit('["'), "event_type", F.lit('", "", " "], "x"'))).otherwise('""')
    listed = F.when(n % 4 == 2, F.concat(F.lit('["'), "event_type", F.lit('", " ", "'), "user_id", F.lit('"]'))).otherwise(listed)
    nested = F.concat(F.lit('{"a": {"The-Key": '), n % 7 + 0, F.lit('}, "thekey": '), n % 5, F.lit("}"))
    # zeros are values; only nothing at all is empty
    private = F.concat(F.lit('{"id": '), n, F.lit(', "phone": "1", "my_token": 2, "gone": null, "in": [{"keep": "'), "event_type", F.lit('", "Password2": "x"}, null]}'))
    levels = J.find_aliases(nested, ["the key"], by_level=True)
    return _t(spark, d, "events").select(
        "event_id", F.array_join(J.str_list(F.try_parse_json(listed)), "|").alias("items"), J.first_alias(nested, ["the_key"]).cast("int").alias("first"),
        F.when(n % 5 == n % 7, F.concat_ws(",", n % 5, n % 7)).otherwise(F.array_join(levels, ",")).alias("by_level"), F.array_join(J.find_aliases(nested, ["the_key"]), ",").alias("in_depth"),
        F.regexp_replace(J.scrub(private), r"([:,]) ", "$1").alias("scrubbed"),
    )


@query("""SELECT user_id, string_agg(DISTINCT event_type, ',' ORDER BY event_type) AS types, CAST(max(event_id) FILTER (WHERE event_type = 'click') AS BIGINT) AS last_click FROM events WHERE event_id < 3000 GROUP BY user_id""")
def maps_by_key(spark, d):
    rows = _t(spark, d, "events").where("event_id < 3000").groupBy("user_id").agg(F.array_sort(F.collect_list(F.struct("event_id", "event_type"))).alias("e"))
    keyed = rows.select("user_id", C.key_by(F.col("e"), "event_type").alias("m"), C.distinct_in_order(F.transform("e", lambda x: x["event_type"])).alias("t"))
    return keyed.select("user_id", F.array_join(F.array_sort("t"), ",").alias("types"), F.try_element_at("m", F.lit("click"))["event_id"].alias("last_click"))


_SKILLS = ["Go", "React", "Docker", "SQL", "Prisma"]


@query(f"""WITH n AS (SELECT n_nationkey AS k, n_name, ({_list(_SKILLS)})[n_nationkey % 5 + 1] AS s1, ({_list(_SKILLS)})[(n_nationkey + 2) % 5 + 1] AS s2 FROM nation)
SELECT k AS n_nationkey, 'CANDIDATE PROFILE (condensed)' || chr(10) || 'Headline: ' || n_name || chr(10) || chr(10) || '## Skills' || chr(10) ||
 array_to_string(list_concat(list_filter(['React', 'Prisma', 'Docker'], lambda x: x IN (s1, s2)), list_filter([s1, s2], lambda x: x IN ('Go', 'SQL'))), ', ') || chr(10) || chr(10) || '## Projects' || chr(10) || '- P — T. Stack: ' || s1 || ', ' || s2 || '. did ' || k || chr(10) || chr(10) ||
 '## Education' || chr(10) || 'BTech — in CS — IIT (2026)' || chr(10) || 'CGPA/GPA: 8.5' || chr(10) || chr(10) || '## Experience' || chr(10) || '- None listed' || chr(10) || chr(10) || '## Profile' || chr(10) || 'Career objective: grow' || chr(10) || chr(10) ||
 '## Achievements / Competitive Programming' || chr(10) || '- Best Rank: ' || k || chr(10) || chr(10) || '## Job Preferences' AS condensed, 6 AS sections, '"grow"' AS objective FROM n""")
def profile_parts(spark, d):
    n = F.col("n_nationkey")
    made = F.concat(
        F.lit('{"identity": {"headline": "'), "n_name", F.lit('", "phone": "1"}, "projects": {"flagship_projects": [{"name": "P", "tagline": "T", "technologies": {"verified": ["'), _nth(_SKILLS, n % 5), F.lit('", "'), _nth(_SKILLS, (n + 2) % 5),
        F.lit('"]}, "resume_bullets": ["did '), n, F.lit('"]}]}, "education": [{"degree": "BTech", "branch": "CS", "institution_short": "IIT", "graduation_year": 2026, "cgpa": 8.5}], "career_objective": "grow", "competitive_programming": {"best_rank": '), n, F.lit("}}"),
    )
    p = P.structured_profile(made)
    rows = _t(spark, d, "nation").select("n_nationkey", p.alias("p"))
    return rows.select("n_nationkey", "p.condensed", F.size("p.sections").alias("sections"), F.try_element_at("p.sections", F.lit("Career Objective")).alias("objective"))


# ---- rows, prompts, verdicts ----
@query("""SELECT c_custkey, CASE WHEN c_custkey % 4 = 0 THEN '' ELSE 'u/' || c_custkey END AS job_url, CASE WHEN c_custkey % 3 = 0 THEN 'Unknown' ELSE c_mktsegment END AS company, CASE WHEN c_custkey % 5 = 0 THEN 'India' ELSE c_name || ', x' END AS location, coalesce(CASE WHEN c_custkey % 2 = 0 THEN '  kept ' END, '') AS description FROM customer""")
def normalised_rows(spark, d):
    n = F.col("c_custkey")
    rows = _t(spark, d, "customer").select(
        "c_custkey", F.when(n % 4 == 0, "  ").otherwise(F.concat(F.lit(" u/"), n, F.lit(" "))).alias("job_url"), F.lit("t").alias("title"), F.when(n % 3 > 0, F.concat(F.lit(" "), "c_mktsegment")).alias("company"),
        F.when(n % 5 > 0, F.array(F.concat("c_name", F.lit(" ")), F.lit(" "), F.lit(None).cast("string"), F.lit("x"))).otherwise(F.array().cast("array<string>")).alias("location"), F.when(n % 2 == 0, "  kept ").alias("description"), F.lit("s").alias("source"),
    )
    return L.normalise_rows(rows).select("c_custkey", "job_url", "company", "location", "description")


@query(f"""SELECT doc_id, sha256('Rate this listing for the candidate. Answer with one JSON object.' || chr(10) || 'PROFILE: me' || chr(10) || 'TITLE: ' || title || chr(10) || 'COMPANY: ' || source || chr(10) || 'LOCATION: ' || location || chr(10) || 'DESCRIPTION: ' || substr(description, 1, 10000)) AS prompt FROM ({_MADE})""")
def prompts(spark, d):
    return _listings(spark, d).select("doc_id", F.sha2(PL.prompt("me"), 256).alias("prompt"))


@query("""SELECT doc_id, CAST(CASE WHEN doc_id % 4 = 0 THEN 0 ELSE doc_id % 30 END AS INTEGER) AS role_match, doc_id % 3 = 0 AS fresher, CASE WHEN doc_id % 2 = 0 THEN 'said' WHEN doc_id % 5 = 0 THEN 'one' ELSE 'a; ' || source END AS reason, CAST(CASE WHEN doc_id % 5 = 0 THEN 1 ELSE 2 END AS INTEGER) AS why, '' AS venue FROM documents""")
def verdict_rows(spark, d):
    n = F.col("doc_id")
    number = F.when(n % 4 == 0, '"many"').when(n % 4 == 1, F.concat(F.lit('"'), n % 30, F.lit('"'))).otherwise((n % 30).cast("string"))
    why = F.when(n % 5 == 0, '" one "').otherwise(F.concat(F.lit('["a", "'), "source", F.lit('"]')))
    made = F.concat(F.lit('{"role_match": '), number, F.lit(', "is_fresher_appropriate": '), F.when(n % 3 == 0, '"Yes"').otherwise("false"), F.lit(', "reason": '), F.when(n % 2 == 0, '" said "').otherwise("null"), F.lit(', "why": '), why, F.lit("}"))
    v = _t(spark, d, "documents").select("doc_id", PL.verdict_struct(made).alias("v"))
    return v.select("doc_id", "v.role_match", F.col("v.is_fresher_appropriate").alias("fresher"), "v.reason", F.size("v.why").alias("why"), "v.venue")


@query("SELECT c_custkey, '{\"key\":' || c_custkey || ',\"name\":\"' || c_name || '\",\"tags\":[\"' || c_mktsegment || '\"]}' AS body FROM customer")
def rows_as_json(spark, d):
    return _t(spark, d, "customer").select("c_custkey", F.to_json(F.struct(F.col("c_custkey").alias("key"), F.col("c_name").alias("name"), F.array("c_mktsegment").alias("tags"))).alias("body"))


@query("""WITH p AS (SELECT r_name AS place, row_number() OVER (ORDER BY r_regionkey) - 1 AS p FROM region), f AS (SELECT n_name AS family, n_nationkey AS f FROM nation WHERE n_nationkey < 3), w AS (SELECT family, t, family || t AS term FROM f, range(4) AS r(t)),
 k AS (SELECT place, family, term, t, p * 1000000 + f AS pool FROM p CROSS JOIN f JOIN w USING (family))
SELECT CAST(pick AS INTEGER) AS pick, place, family, term FROM (SELECT *, row_number() OVER (ORDER BY rn, pool) AS pick FROM (SELECT *, row_number() OVER (PARTITION BY pool ORDER BY t) AS rn FROM k)) WHERE pick <= 24""")
def search_combinations(spark, d):
    places = _t(spark, d, "region").select(F.col("r_name").alias("place"), F.col("r_regionkey").alias("p"))
    families = _t(spark, d, "nation").where("n_nationkey < 3").select(F.col("n_name").alias("family"), F.col("n_nationkey").alias("f"))
    words = families.select("family", F.explode(F.sequence(F.lit(0), F.lit(3))).alias("t")).withColumn("term", F.concat("family", "t"))
    return L.combinations(places, families, words)


@query("""SELECT c_custkey AS id, c_name AS name, c_acctbal AS balance, CAST(NULL AS VARCHAR) AS status FROM customer UNION ALL SELECT o_orderkey, NULL, NULL, o_orderstatus FROM orders""")
def union_of_columns(spark, d):
    customers = _t(spark, d, "customer").select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name"), F.col("c_acctbal").alias("balance"))
    orders = _t(spark, d, "orders").select(F.col("o_orderkey").alias("id"), F.col("o_orderstatus").alias("status"))
    return R.union_sources({"customers": customers, "orders": orders}).select("id", "name", "balance", "status")


