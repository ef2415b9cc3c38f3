import datetime as dt
import json
import random
import re
from functools import reduce

import pytest
from pyspark.sql import functions as F

from quarry import terms
from quarry.functions import dates as D
from quarry.functions import jsonx as J
from quarry.functions import profile as P
from quarry.functions import score as S
from quarry.functions import text as X
from quarry.functions import url as U
from quarry.functions.matching import Finder, Wanted, term_counts


def values(spark, rows, schema, *columns):
    return [tuple(r) for r in spark.createDataFrame(rows, schema).coalesce(1).select(*columns).collect()]


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first().x


def test_url_normalisers(spark):
    urls = ["https://a.b/c?utm_source=linkedin", "https://a.b/c?ref=123&other=456", "https://a.b/c", "https://A.b/c;v=1?x=1&&SRC=2#top", "ftp://a/b", "", None, "https://h?gclid=1&a=b=c"]
    got = values(spark, [(u,) for u in urls], "u string", U.norm_url_loose(F.col("u")), U.norm_url_strict(F.col("u")))
    assert [g[0] for g in got] == ["https://a.b/c", "https://a.b/c?other=456", "https://a.b/c", "https://A.b/c;v=1?x=1", "ftp://a/b", "", "", "https://h?a=b=c"]
    assert [g[1] for g in got] == ["https://a.b/c", "https://a.b/c?other=456", "https://a.b/c", "https://A.b/c?x=1", "", "", "", "https://h/?a=b=c"]


@pytest.mark.parametrize(
    ("url", "title", "want"),
    [
        ("https://www.naukri.com/job-listings-dev-123", "", True), ("https://boards.greenhouse.io/acme/jobs/123", "", True), ("https://jobs.lever.co/acme/abc", "", True),
        ("https://www.naukri.com/java-developer-jobs-in-bangalore", "Java Developer", False), ("https://www.naukri.com/x", "2,341 Developer Job Vacancies In Pune", False),
        ("https://evil.com/job/1", "Developer", False), ("https://internshala.com/search/dev", "Developer", False), ("https://wellfound.com/some-page", "Backend Developer", True), ("https://wellfound.com/", "Backend Developer", False),
    ],
)
def test_job_url_rules(spark, url, title, want):
    assert one(spark, U.looks_job_url(F.lit(url), F.lit(title), F.lit(""))) is want


def test_page_classes(spark):
    rows = [("https://x.in/python-jobs", ""), ("https://x.in/job/1234567", "A"), ("https://facebook.com/jobs", ""), ("https://x.in/jobs", ""), ("https://x.in/a/abcdefg", "Open positions"), ("https://x.in/a/abcdefg", "Dev")]
    got = values(spark, rows, "u string, t string", U.is_aggregate_page(F.col("u"), F.col("t")), U.is_individual_job_url(F.col("u"), F.col("t")))
    assert got == [(True, False), (False, True), (False, False), (True, False), (True, False), (False, True)]


def test_absolute_urls(spark):
    base = F.lit("https://a.b/x/y?z=1")
    got = one(spark, F.array(*(U.absolute_url(F.lit(u), base) for u in ("https://c/d", "/e", "f", "//g/h", ""))))
    assert got == ["https://c/d", "https://a.b/e", "https://a.b/x/f", "https://g/h", "https://a.b/x/y?z=1"]


def test_text_extraction(spark):
    assert one(spark, X.first_email(F.lit("Send resume to hr@company.com please"))) == "hr@company.com"
    assert one(spark, X.first_email(F.lit(None).cast("string"))) == ""
    assert one(spark, X.company_domain(F.lit("Acme Technologies Pvt Ltd"))) == "acme.com"
    assert one(spark, X.company_domain(F.lit(""))) == ""
    text = "Apply - https://a.com/1).\nhttps://instagram.com/x\nhttps://b.com/2 https://a.com/1"
    links = one(spark, X.job_links(F.lit(text), F.lit("video")))
    assert [x.url for x in links] == ["https://a.com/1", "https://b.com/2"]


def test_titles_and_companies(spark):
    assert one(spark, X.page_title(F.lit("Close\n[About](u)\n# Data Engineer"), F.lit("Menu"))) == "Data Engineer"
    assert one(spark, X.page_title(F.lit("[![Cutshort logo](i)](p)"), F.lit(None).cast("string"))) == "Cutshort logo"
    assert one(spark, X.page_title(F.lit(""), F.lit(""))) == "Software Engineer"
    assert one(spark, X.company_from_title(F.lit("Bengaluru - Coddle Technologies - 2 to 3 years of experience"), F.lit("https://n.com/1"))) == "Coddle Technologies"
    assert one(spark, X.company_from_result(F.lit("React Developer at Zeta Corp"), F.lit(""))) == "Zeta Corp"
    assert one(spark, X.company_from_result(F.lit("x"), F.lit("https://acme.com/jobs/1"))) == "Acme"
    assert one(spark, X.company_from_result(F.lit("x"), F.lit("not a url"))) == ""


def test_error_classes(spark):
    rows = [("request timeout", "E"), ("HTTP 429 rate limit", "E"), ("403 forbidden", "E"), ("x", "NotConfiguredError"), ("x", "ConnectionError"), (None, None)]
    got = [g[0] for g in values(spark, rows, "m string, k string", X.error_class(F.col("m"), F.col("k")))]
    assert got == ["TIMEOUT", "HTTP_429", "HTTP_403", "NOT_CONFIGURED", "NETWORK_ERROR", "UNKNOWN_ERROR"]


@pytest.mark.parametrize(
    ("text", "eligible"),
    [
        ("0-1 years", True), ("0–2 years", True), ("1+ years", True), ("up to 1 year", True), ("2+ years required", False), ("2-4 years required", False), ("3 yrs of experience", False),
        ("5 years preferred", True), ("senior lead", False), ("fresher, senior lead welcome to mentor", True), ("25 years of history", True),
    ],
)
def test_experience(spark, text, eligible):
    assert one(spark, S.experience(F.lit(text))).eligible is eligible


def test_gates(spark):
    gate = lambda c: tuple(one(spark, c))
    assert gate(S.location_gate(F.lit("Pune, Baner"))) == (4, False)
    assert gate(S.location_gate(F.lit("Remote"))) == (5, False)
    assert gate(S.location_gate(F.lit("New York, United States"))) == (0, True)
    assert gate(S.location_gate(F.lit("Delhi"))) == (1, False)
    assert gate(S.education_gate(F.lit("B.Tech degree"))) == (2, False)
    assert gate(S.education_gate(F.lit("any engineering branch"))) == (4, False)
    assert gate(S.education_gate(F.lit("Computer Science candidates only"))) == (0, True)
    day = lambda d: F.lit(d).cast("date")
    ages = {"2026-01-11": (1, False), "2026-01-08": (4, False), "2026-01-04": (2, False), "2025-12-20": (0, False), "2025-11-01": (-3, True)}
    for d, want in ages.items():
        assert gate(S.freshness_gate(day(d), day("2026-01-10"))) == want


def test_prefilter_score(spark):
    schema = "title string, description string, company string, location string, posting_date string"
    rows = [
        ("Software Engineer", "Fresher role with React and SQL. Mail hr@a.com", "Acme", "Pune", "2026-01-09"), ("Senior Software Engineer", "fresher", "A", "Pune", ""), ("Software Engineer", "fresher", "A", "New York, USA", ""),
        ("Software Engineer", "B.Tech in CS only, fresher", "A", "Pune", ""), ("Software Engineer", "fresher", "A", "Pune", "2025-01-01"), ("Gardener", "fresher", "A", "Pune", ""), ("Software Engineer", "nothing more", "A", "Pune", None),
        ("Software Engineer", "Fresher walk-in on 20 Jan 2026 in Pune", "A", "Pune", ""), ("Software Engineer", "Fresher walk-in on 2 Jan 2026 in Pune", "A", "Pune", ""), (None, None, None, None, None),
    ]
    got = [r.prefilter_score for r in S.prefilter_score(spark.createDataFrame(rows, schema).coalesce(1), F.lit("2026-01-10").cast("date")).collect()]
    assert got[1:7] == [0] * 6 and got[8:] == [0, 0]
    assert got[0] > 20 and got[7] > 50


def test_walkin_dates():
    today, day = dt.date(2026, 8, 1), dt.date
    find = lambda t: D.find_walkin_dates(t, today)
    assert find("Walk-in interview on 15 August 2026") == (day(2026, 8, 15), day(2026, 8, 15))
    assert find("Walk-in drive 10th-12th Aug 2026 at Pune") == (day(2026, 8, 10), day(2026, 8, 12))
    assert find("Company founded 12 March 2020. Apply now") is None
    assert find("Previous walk-in was on 2026-06-01") is None
    assert find("Walk-in on 2026-09-01\nWalk-in on 2026-08-05") == (day(2026, 8, 5), day(2026, 8, 5))
    assert find("Interview date 05/08/2026") == (day(2026, 5, 8), day(2026, 5, 8))
    assert find("Walk-in on 31 Feb 2026") is None
    assert find(None) is None and find("") is None


def test_dates(spark):
    now = F.lit("2026-01-10 12:00:00").cast("timestamp")
    guess = lambda t: one(spark, D.posting_date_guess(F.lit(t), now))
    assert guess("Posted 2 days ago") == "2026-01-08 (approx, from 'posted 2 day(s) ago')"
    assert guess("posted today") == "2026-01-10"
    assert guess("on 2026-01-02") == "2026-01-02"
    assert guess("none") == "" and guess(None) == ""
    assert one(spark, D.iso_date(F.lit("x 2026-13-40"))) is None
    status = lambda a, b, c: tuple(one(spark, D.walkin_status(F.lit(a).cast("date"), F.lit(b).cast("date"), F.lit(c), F.lit("2026-08-11").cast("date"))))[1:]
    assert status("2026-08-10", "2026-08-12", "") == ("active", False)
    assert status("2026-08-01", "2026-08-02", "2026-08-01") == ("expired", False)
    assert status("2026-08-20", "2026-08-20", "2026-09-01") == ("upcoming", True)
    assert status(None, None, "2026-08-20") == ("upcoming", False)
    assert status(None, None, "") == ("unknown", False)


def test_json(spark):
    assert J.parse_object('```json\n{"a": 1}\n```') == {"a": 1}
    assert J.parse_object('Here: {"a": [1]} done') == {"a": [1]}
    assert J.parse_object('{"a": "x", "b": "half') == {"a": "x"}
    assert J.parse_object('{"a": 1, "k":') == {"a": 1}
    assert J.parse_object('{"a": ["x", "y", "z') == {"a": ["x", "y"]}
    assert J.parse_object("{") is None and J.parse_object("") is None and J.parse_object(None) is None
    got = values(spark, [('{"a": 1}',), ('{"a": 1, "b": "x',), ("no",), (None,)], "t string", J.repair_json(F.col("t")))
    assert [g[0] for g in got] == ['{"a": 1}', '{"a": 1}', None, None]
    assert one(spark, J.str_list(F.try_parse_json(F.lit('[" a ", "", "b"]')))) == ["a", "b"]
    assert one(spark, J.str_list(F.try_parse_json(F.lit('"x"')))) == ["x"]
    assert one(spark, J.find_aliases(F.lit('{"a": {"Tech_Skills": ["x"]}, "techskills": "y"}'), ["tech skills"])) == ['["x"]', "y"]
    assert one(spark, J.find_aliases(F.lit('{"a": {"Tech_Skills": ["x"]}, "techskills": "y"}'), ["tech skills"], by_level=True)) == ["y", '["x"]']
    assert [one(spark, J.first_alias(F.lit('{"a": {"k": "x", "K": ""}, "k": "y"}'), ["k"], by_level=b)) for b in (False, True)] == ["x", "y"]
    assert one(spark, J.find_aliases(F.lit('[{"k": 1}, {"k": 1}, {"k": []}]'), ["k"])) == ["1"] and one(spark, J.first_alias(F.lit("no"), ["k"])) is None
    private = {"a": 1, "api_key": "s", "b": [{"Token": 2, "c": 3}, None], "phone": "1", "Full_Address": "x", "pin_code": 2, "resume_pdf": "y", "my_secret_x": 1, "n": None}
    assert json.loads(one(spark, J.scrub(F.lit(json.dumps(private))))) == {"a": 1, "b": [{"c": 3}]}
    assert one(spark, J.scrub(F.lit("no json"))) is None


@pytest.mark.parametrize("depth", [1, 3, 5, 9])
def test_markdown_links_to_any_depth(spark, depth):
    text = "x"
    for i in range(depth):
        text = f"[{text}](u{i})"
    assert one(spark, X.strip_markdown_links(F.lit(f"a {text} b ![i](j)"))) == "a x b i"


def test_absolute_urls_match_urljoin(spark):
    from urllib.parse import urljoin

    bases = ["https://a.com", "https://a.com/", "https://a.com/x/y/z.html?q=1#f", "http://a.com/x/"]
    links = ["b", "./b", "../b", "../../../b", "/b/./c/../d", "//c.org/e", "?k=v", "#g", "b?x=../y", "https://z.org/a/../b", "..", ".", "b/..", "c/./d/", ""]
    df = spark.createDataFrame([(b, x) for b in bases for x in links], "b string, x string")
    for r in df.select("b", "x", U.absolute_url(F.col("x"), F.col("b")).alias("u")).collect():
        assert r.u == urljoin(r.b, r.x), (r.b, r.x)


def test_harvested_links(spark):
    given = F.array(F.struct(F.lit("https://k.org/1").alias("href"), F.lit("t").alias("text")), F.struct(F.lit(None).cast("string").alias("href"), F.lit("u").alias("text")))
    got = one(spark, X.harvested_links(F.lit("[ One ](/a) and ![i](https://b.org/x)"), F.lit("https://a.com/p"), given))
    assert [(x.href, x.text) for x in got] == [("https://a.com/a", "One"), ("https://b.org/x", "i"), ("https://k.org/1", "t")]


def test_numbers(spark):
    assert [one(spark, S.as_int(F.lit(x), 7)) for x in ("82", "3.7", "", None)] == [82, 7, 7, 7]
    assert [one(spark, S.as_bool(F.lit(x))) for x in ("true", "Yes", "0", "?")] == [True, True, False, False]
    limit = lambda a, u, m=0.0, p=0.0: one(spark, S.admission_limit(F.lit(2700.0), F.lit(a), F.lit(u), F.lit(m), F.lit(p)))
    assert limit(0, 0) == 90
    assert limit(100, 60) < 90 and limit(100, 60) > limit(100, 100)
    assert limit(0, 0, 65.0, 400.0) == 27


PROFILE = {
    "identity": {"full_name": "N", "headline": "Builds", "phone": "1"}, "education": [{}, {"program": "BTech", "institution": "Long Name", "cgpa": {"value": 8.1}}],
    "projects": {"flagship_projects": [{"name": "P1", "tagline": "T", "technologies": {"verified": ["Go", "React", "Go"]}, "resume_bullets": ["did"]}], "ai_projects": [{"name": "AI SEO Audit Platform", "technologies": {"verified": ["Docker"]}}]},
    "experience": [{"role": "Dev", "organization": "Org", "dates": "2024", "highlights": ["h" * 400]}, "bad"], "deep": {"work_experience": "other", "Discipline": "CS"},
    "job_preferences": {"preferred_roles": ["SDE"], "salary": ""}, "competitive_programming": {"best_rank": 5}, "achievements": ["won"], "career_objective": "grow", "api_key": "secret",
}


def test_profile(spark):
    row = spark.range(1).select(P.structured_profile(F.lit(json.dumps(PROFILE))).alias("p"), P.structured_profile(F.lit("[]")).alias("q")).first()
    assert row.q.condensed is None and row.q.sections is None
    p = row.p
    assert json.loads(p.sections["Experience"]) == [PROFILE["experience"], "other"] and json.loads(p.sections["Education"]) == [{}, PROFILE["education"][1]]
    assert "Leadership" not in p.sections and "secret" not in p.raw_text and '"phone"' not in p.raw_text
    assert p.raw_text.count("\n## ") == 18 and "Complete Canonical Profile Snapshot" in p.raw_text and "No dedicated section" in p.raw_text
    for line in ("Headline: Builds", "React, Docker, Go", "- P1 — T. Stack: Go, React, Go. did", "BTech — in CS — Long Name", "CGPA/GPA: 8.1", "- Dev — Org (2024)", "  " + "h" * 280, "Career objective: grow", "- won", "- Best Rank: 5", "- Preferred Roles: ['SDE']"):
        assert line in p.condensed.split("\n"), line
    assert "SEO" not in p.condensed and len(p.condensed) < len(p.raw_text)
    made = json.loads(p.structured)
    assert (made["identity"]["name"], made["identity"]["career_stage"], made["raw_text"][:9]) == ("N", "entry-level", "CANONICAL")


# ---- many terms in one pass ----


def test_finder_matches_a_search_for_each_term():
    r = random.Random(4)
    letters = "ab é_1."
    word = re.compile(r"\w")
    for _ in range(300):
        term = lambda: "".join(r.choice(letters) for _ in range(r.randint(1, 4))).strip() or "a"
        fields = ["".join(r.choice(letters) for _ in range(r.randint(0, 12))) for _ in range(r.randint(1, 4))]
        lists = []
        for _ in range(4):
            first = r.randrange(len(fields))
            lists.append(Wanted([term() for _ in range(r.randint(0, 6))], first, r.randrange(first, len(fields)), r.random() < 0.5))
        for wanted, n, found in zip(lists, Finder(lists).counts(fields), Finder(lists).find(fields), strict=True):
            text = " ".join(fields[wanted.first : wanted.last + 1])

            def there(t, text=text, words=wanted.words):
                places = [i for i in range(len(text)) if text.startswith(t, i)]
                return any(not words or not (word.match(text[i - 1 : i]) or word.match(text[i + len(t) : i + len(t) + 1])) for i in places)

            assert n == sum(there(t) for t in wanted.terms)
            assert found == {t for t in wanted.terms if there(t)}


def test_many_terms_say_what_few_say(spark):
    texts = ["Senior LEAD engineer, 5+ years", "sde 1 or sde-1x; ÄSDE", "", None, "node.js and express.js. Nodes", "react" * 50 + " graduate engineer trainee"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "id int, text string")
    low = F.lower("text")
    for wanted in (terms.ROLES, terms.PROFILE + terms.PROFILE[:3], terms.FRESHER):
        few = [wanted[i : i + 5] for i in range(0, len(wanted), 5)]
        total = lambda f: reduce(lambda a, b: a + b, (f(low, some) for some in few))  # noqa: B023, E731
        row = df.select("id", X.count_hits(low, wanted).alias("a"), total(X.count_hits).alias("b"), X.count_word_hits(low, wanted).alias("c"), total(X.count_word_hits).alias("d"), X.any_term(low, wanted).alias("e"), X.term_hits(low, wanted).alias("f")).collect()
        for r in row:
            assert r.a == r.b
            assert r.c == r.d
            assert r.e == (None if r.a is None else r.a > 0)
            assert (r.f is None) == (r.a is None)
            assert r.f is None or r.f == [t for t in wanted if t.lower() in texts[r.id].lower()]


def test_terms_across_fields_count_for_lists_that_span_them(spark):
    df = spark.createDataFrame([("walk", "in drive", "x", "y")], "a string, b string, c string, d string")
    lists = {"both": Wanted(["walk in", "drive x y"], 0, 3), "first": Wanted(["walk in", "walk"]), "middle": Wanted(["in", "walk in", "drive x"], 1, 2, words=True)}
    assert tuple(df.select(term_counts([F.col(c) for c in "abcd"], lists).alias("n")).first().n) == (2, 1, 2)


def test_experience_with_and_without_years(spark):
    rows = [("3 years", 3, True, False, False), ("3 years preferred", 3, False, True, True), ("yearly bonus", 0, False, False, True), ("senior lead", 0, False, False, False), ("senior lead fresher", 0, False, False, True), (None, 0, False, False, True), ("2-4 YRS of experience, graduate", 4, True, False, True)]
    got = spark.createDataFrame([(r[0],) for r in rows], "t string").select("t", S.experience(F.col("t")).alias("e")).collect()
    assert [(r.t, r.e.min_years, r.e.required, r.e.preferred, r.e.eligible) for r in got] == rows
