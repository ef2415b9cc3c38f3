import datetime as dt
import json
import random
import time

import pytest
from pyspark.sql import functions as F

from quarry import terms
from quarry.operators import listings as L
from quarry.operators import metrics as M
from quarry.operators import state as ST
from quarry.plans import more_queries as MQ
from quarry.plans import pipeline as P
from quarry.plans import queries as Q
from quarry.plans import rule_queries, source_queries  # noqa: F401
from quarry.sources import outbox
from quarry.sources import readers as R
from quarry.sources import sinks as K


def rows(df, *columns):
    return sorted(tuple(r) for r in (df.select(*columns) if columns else df).collect())


def test_dedupe_keeps_first_arrival(spark):
    df = spark.createDataFrame([("u/1?utm_a=1", 3), ("u/1", 1), ("u/2?x=1&ref=2", 2), ("", 0), (None, 4)], "job_url string, arrival_ord long")
    assert rows(L.dedupe_by_url(df)) == [("u/1", 1), ("u/2?x=1", 2)]


def fair_by_hand(items, most, least, threshold):
    passed = [x for x in items if x[1] >= threshold]
    sources = []
    for s, _, _ in sorted(passed, key=lambda x: x[2]):
        if s not in sources:
            sources.append(s)
    pools = {s: sorted([x for x in passed if x[0] == s], key=lambda x: (-x[1], x[2])) for s in sources}
    out = [x for s in sources for x in pools[s][:least]]
    rest, depth = {s: pools[s][least:] for s in sources}, 0
    while len(out) < most and any(len(r) > depth for r in rest.values()):
        for s in sources:
            if len(rest[s]) > depth and len(out) < most:
                out.append(rest[s][depth])
        depth += 1
    return [x[2] for x in sorted(out, key=lambda x: -x[1])[:most]]


@pytest.mark.parametrize("seed", range(4))
def test_fair_top_k_is_the_sequential_rule(spark, seed):
    r = random.Random(seed)
    items = [(r.choice("abcde"), r.randint(0, 20), i) for i in range(r.randint(0, 120))]
    most, least = r.choice([10, 30]), r.choice([2, 5])
    df = spark.createDataFrame(items, "source string, score int, arrival_ord int")
    got = [x.arrival_ord for x in L.fair_top_k(df, score="score", group="source", order="arrival_ord", most=most, least=least, threshold=6).orderBy("rank").collect()]
    assert got == fair_by_hand(items, most, least, 6)


def test_routing_and_upsert(spark):
    state = spark.createDataFrame([("a", "PASSED", "k", "v"), ("b", "QUEUED", None, None), ("c", "PASSED", "old", "v")], "job_url string, status string, evaluation_key string, verdict string")
    new = spark.createDataFrame([(u, "k", i) for i, u in enumerate("abcde")], "job_url string, evaluation_key string, arrival_ord int")
    assert rows(L.route(new, state, most_new=2), "job_url", "route") == [("a", "resumed"), ("b", "retry"), ("c", "new"), ("d", "new"), ("e", "waiting")]
    changes = spark.createDataFrame([("a", "REJECTED", "k2", "w", 2), ("a", "PASSED", "k1", "w", 1), ("z", "QUEUED", None, None, 1)], "job_url string, status string, evaluation_key string, verdict string, ord int")
    assert rows(ST.upsert(state, changes, "job_url", ["ord"]), "job_url", "status") == [("a", "REJECTED"), ("b", "QUEUED"), ("c", "PASSED"), ("z", "QUEUED")]
    assert rows(ST.by_priority([state, state.where("job_url = 'a'").withColumn("status", F.lit("X"))], "job_url"), "job_url", "status")[0] == ("a", "X")


def test_admission_split_and_deferred(spark):
    df = spark.createDataFrame([(i, f"u{i}") for i in range(7)], "arrival_ord long, job_url string")
    yes, no = L.split_admitted(df, 3, ["arrival_ord"])
    assert (yes.count(), no.count()) == (3, 4)
    yes, no = L.split_admitted(df.withColumn("same", F.lit(1)), 2, ["same"])
    assert (yes.count(), no.count()) == (2, 5) and sorted(r.job_url for r in yes.unionByName(no).collect()) == [f"u{i}" for i in range(7)]
    yes, no = L.split_admitted(df, 0, ["arrival_ord"])
    assert (yes.count(), no.count()) == (0, 7)
    both = L.deferred_first(df.where("arrival_ord > 4"), df)
    assert rows(both, "phase", "arrival_ord") == [(0, 5), (0, 6), (1, 0), (1, 1), (1, 2), (1, 3), (1, 4)]


def test_enrichment(spark):
    a = spark.createDataFrame([("u", "short", ""), ("v", "a longer text", "C"), ("w", None, "C")], "job_url string, description string, company string")
    b = spark.createDataFrame([("u", "a longer one", "D"), ("v", "short", "D")], "job_url string, description string, company string")
    assert rows(L.enrich_descriptions(a, b).na.fill(""), "job_url", "description", "company") == [("u", "a longer one", "D"), ("v", "a longer text", "C"), ("w", "", "C")]


def test_metrics(spark):
    values = spark.createDataFrame([("a", float(x)) for x in (1, 2, 3)] + [("b", 5.0), ("b", None)], "k string, v double")
    assert rows(M.mean_and_p95(values, "v", ["k"])) == [("a", 3, 2.0, 3.0), ("b", 1, 5.0, 5.0)]
    assert rows(M.shares(spark.createDataFrame([("a",), ("a",), ("b",)], "source string"))) == [("a", 2, 66.67), ("b", 1, 33.33)]
    assert rows(M.duplicate_summary(spark.createDataFrame([("a",), ("a",)], "u string"), "u")) == [(2, 1, 1)]
    health = spark.createDataFrame([("s", True, [], 3, None), ("t", True, ["e"], 0, "TIMEOUT"), ("u", False, [], 0, None)], "name string, enabled boolean, errors array<string>, jobs_found int, error_classification string")
    health = M.finish_health(health.withColumn("started_at", F.lit("2026-01-01").cast("timestamp")).withColumn("finished_at", F.lit("2026-01-02").cast("timestamp")))
    assert rows(health, "name", "status") == [("s", "HEALTHY"), ("t", "FAILED"), ("u", "DISABLED")]
    row = M.search_summary(spark.createDataFrame([("s",), ("s",)], "source string"), health, 5).first()
    assert (row.sources_enabled, row.sources_healthy, row.sources_failed, row.duplicate_count, row.source_breakdown) == (2, 1, 1, 3, {"s": 2})
    seeds = spark.createDataFrame([(True, 4, 0, 0, True), (False, 0, 0, 0, False)], "ok boolean, pages int, rows int, candidates int, anti_bot boolean")
    assert M.discovery_totals(seeds).first().problem == "no candidates: anti-bot pages"


def test_provider_health(spark):
    events = [(1, "p", "REQUEST", 0.0), (2, "p", "success", 1.0), (3, "p", "timeout", 2.0), (4, "p", "HTTP_429", 0.0), (5, "p", "x", 0.0), (1, "q", "REQUEST", 0.0), (2, "q", "HTTP_5XX", 1.0), (3, "q", "SUCCESS", 1.0)]
    df = spark.createDataFrame([(*e, 0.0) for e in events], "ord long, provider string, kind string, latency_seconds double, cooldown_seconds double")
    got = {r.provider: (r.state, r.consecutive_failures, r.timeouts, r.average_latency_seconds, r.last_error) for r in ST.provider_health(df).collect()}
    assert got == {"p": ("CIRCUIT_OPEN", 3, 1, 3.0, "X"), "q": ("AVAILABLE", 0, 0, 2.0, None)}


def test_provider_recovery_and_cooldown(spark):
    kinds = ["TIMEOUT", "SUCCESS", "SUCCESS", "HTTP_429", "x", "SUCCESS", "HTTP_5XX"]
    events = [(i, "p", k, 1.0, 30.0 if k == "HTTP_429" else 1.0 if k == "HTTP_5XX" else 0.0, float(i)) for i, k in enumerate(kinds)]
    df = spark.createDataFrame(events, "ord long, provider string, kind string, latency_seconds double, cooldown_seconds double, at_seconds double")
    r = ST.provider_health(df).first()
    assert (r.recovery_count, r.cooldown_until, r.consecutive_failures, r.state, r.server_errors) == (2, 33.0, 1, "DEGRADED", 1)


@pytest.mark.parametrize("parts", [1, 7])
def test_ranges_do_not_change_runs(spark, parts):
    from quarry.operators import ranged

    r = random.Random(parts)
    events = [(r.choice(["a", "b", None]), i, r.random() < 0.7, r.choice("xyz")) for i in range(300)]
    df = spark.createDataFrame(events, "k string, ord long, bad boolean, s string")
    spark.conf.set("spark.sql.shuffle.partitions", str(parts))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = {x.ord: x.run for x in ST.failure_runs(df, key="k", order=["ord"], failed=F.col("bad")).collect()}
        before = {x.ord: x.from_status for x in ST.steps(df, key="k", order=["ord"], status="s").collect()}
        cut = {x.ord for x in ST.breaker_cut(df, key="k", order=["ord"], failed=F.col("bad"), limit=4).collect()}
        total = {x.ord: x.t for x in ranged.running_sum(ranged.ranged(df, ["k"], ["ord"]), ["k"], "ord", "t").collect()}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    now, last, opened, sums = {}, {}, set(), {}
    for k, i, bad, s in events:
        now[k] = now.get(k, 0) + 1 if bad else 0
        sums[k] = sums.get(k, 0) + i
        assert got[i] == now[k] and before[i] == last.get(k) and (i in cut) == (k not in opened) and total[i] == sums[k]
        last[k] = s
        if now[k] >= 4:
            opened.add(k)


def test_legacy_states(spark):
    old = [("a ", "unresolved", 1, "2", "e"), ("b", "Deadline", 2, None, None), ("c", "JUNK", 2, "1", None), ("", "QUEUED", 2, "1", None), ("d", None, 1, "x", None), ("e", "PASSED", 9, "1", None), ("f", "retryable", 2, "-3", None)]
    got = ST.migrate(spark.createDataFrame(old, "job_url string, status string, version int, attempt_count string, error string"))
    assert rows(got, "job_url", "status", "attempts", "last_error") == sorted([("a", "RETRYABLE_ERROR", 2, "e"), ("b", "DEADLINE_EXCEEDED", 0, None), ("d", "QUEUED", 0, None), ("f", "RETRYABLE_ERROR", 0, None)], key=str)
    progress = spark.createDataFrame([("a", True, None, 90, 0), ("b", False, "good_match", 90, 2), ("c", True, "Weak_match ", 10, None), ("d", None, None, None, 1), ("e", True, "reject", 99, 1), ("f", True, None, 50, 1)], "job_url string, fresher_appropriate boolean, decision string, fit_score int, attempts int")
    retries = spark.createDataFrame([("a", 4, ""), (" ", 1, "x"), ("z", None, "why")], "job_url string, attempts int, last_error string")
    assert rows(ST.import_legacy(progress, retries), "job_url", "status", "attempts", "last_error") == [
        ("a", "RETRYABLE_ERROR", 4, "legacy_retry_queue"), ("b", "REJECTED", 2, None), ("c", "PASSED", 1, None), ("d", "EVALUATED", 1, None), ("e", "REJECTED", 1, None), ("f", "REJECTED", 1, None), ("z", "RETRYABLE_ERROR", 0, "why"),
    ]


def test_state_machine_rules(spark):
    pairs = spark.createDataFrame([("QUEUED", "EVALUATING"), ("PASSED", "QUEUED"), ("QUEUED", "RETRYABLE_ERROR"), ("PASSED", "PASSED"), ("EVALUATED", "PASSED")], "a string, b string")
    assert [r[0] for r in pairs.coalesce(1).select(ST.allowed(F.col("a"), F.col("b"))).collect()] == [True, False, True, True, True]
    df = spark.createDataFrame([("RETRYABLE_ERROR", "Invalid JSON"), ("RETRYABLE_ERROR", "timeout")], "s string, e string")
    assert [r[0] for r in df.coalesce(1).select(ST.target_status(F.col("s"), F.col("e"))).collect()] == ["PERMANENT_ERROR", "RETRYABLE_ERROR"]
    assert len(rows(ST.transition_table(spark))) == len(terms.TRANSITIONS) == 14


def test_sources(spark):
    raw = lambda body, origin="o": spark.createDataFrame([(body, origin)], "body string, origin string")
    a = json.dumps({"data": [{"title": "Software Engineer", "company_name": "C", "url": "u", "tags": ["x"], "remote": True, "location": "", "description": "d"}, {"title": "Cook", "tags": []}]})
    assert rows(R.SOURCES["feed_a"](raw(a)), "job_url", "location") == [("u", "Remote")]
    b = json.dumps([{"legal": "notice"}, {"position": "Backend Developer", "company": "C", "url": "/r/1", "tags": [], "location": "", "description": "d"}])
    assert rows(R.SOURCES["feed_b"](raw(b)), "job_url", "location") == [("https://remoteok.com/r/1", "Remote")]
    c = json.dumps({"jobs": [{"title": "T", "absolute_url": "u", "location": None, "content": "x"}]})
    assert rows(R.SOURCES["board_a"](raw(c, "acme")), "company", "location") == [("acme", "India")]
    d = json.dumps({"jobDetails": [{"title": "T", "companyName": "C", "jdURL": "/j/1", "jobDescription": "d", "placeholders": [{"type": "location", "label": "Pune"}]}]})
    assert rows(R.SOURCES["search_api"](raw(d, "https://n.com/s")), "job_url", "location") == [("https://n.com/j/1", "Pune")]
    e = '<ul><li><h3>one</h3><a href="/x/detail/1">Dev</a><p>in Pune, paid</p></li><li><a href="/x/detail/2">Other</a> <i>Unpaid</i></li><li>Baner <a href="/x/detail/3">Third</a></li><a href="/about">About</a><a href="/x/detail/1">again</a></ul>'
    assert rows(R.SOURCES["html_list"](raw(e, "https://i.com/list")), "job_url", "title", "location") == [("https://i.com/x/detail/1", "Dev", "Pune"), ("https://i.com/x/detail/3", "Third", "Baner")]
    f = '<script type="application/json">{"a": [{"b": {"title": "T", "slug": "s-1"}}]}</script>'
    assert rows(R.SOURCES["embedded_json"](raw(f, "https://w.com/")), "job_url", "title") == [("https://w.com/jobs/s-1", "T")]
    frame = spark.createDataFrame([("u", "t", "c", "l", "d", "linkedin"), (None, "t", "c", "l", "d", "google"), ("v", "t", "c", "l", "d", None)], "job_url string, title string, company string, location string, description string, site string")
    assert rows(R.SOURCES["search_frame"](frame), "job_url", "source") == [("u", "Linkedin"), ("v", "Jobspy")]
    assert rows(R.by_site(R.SOURCES["search_frame"](frame), "linkedin"), "job_url") == [("u",)]
    video = spark.createDataFrame([("v1", "Title", "Ch", "Apply https://a.com/1\nhttps://t.me/x"), ("v2", "Title", "Ch", "none")], "url string, title string, channel string, description string")
    assert rows(R.SOURCES["video_channel"](video), "job_url", "title") == [("https://a.com/1", "Apply"), ("v2", "Title")]
    posts = spark.createDataFrame([("p", "A", "x" * 50), ("q", "A", "short"), (None, "A", "x" * 50)], "permalink string, author string, text string")
    assert rows(R.SOURCES["posts"](posts), "job_url") == [("p",)]
    both = R.union_sources({"a": R.SOURCES["feed_a"](raw(a)), "b": R.SOURCES["feed_b"](raw(b))})
    assert both.count() == 2 and both.select("arrival_ord").distinct().count() == 2
    many = json.dumps({"data": [{"title": "Software Engineer", "url": f"u{i * 7 % 10}", "tags": []} for i in range(10)]})
    both = R.union_sources({"x": R.SOURCES["feed_a"](raw(many)), "y": R.SOURCES["feed_a"](raw(many))})
    assert [r.job_url for r in both.orderBy("arrival_ord").collect()] == [f"u{i * 7 % 10}" for i in range(10)] * 2
    timed = spark.createDataFrame([(f"v{i}", "T", "Ch", "none", p) for i, p in enumerate(["2026-01-09T10:00:00Z", "2026-01-01T00:00:00Z", "bad", "2026-01-10T00:00:00Z", "2026-01-09T11:00:00Z"])], "url string, title string, channel string, description string, published string")
    assert rows(R.SOURCES["video_channel"](timed, F.lit("2026-01-10T12:00:00Z").cast("timestamp"))) != []
    assert rows(R.video_channel(timed, F.lit("2026-01-10 12:00:00").cast("timestamp"), 26, 4), "job_url") == [("v0",), ("v3",), ("v4",)]


def test_web_search(spark):
    text = "Requirements: React. Responsibilities and experience. Posted 2 days ago in Pune. " * 12
    results = [
        (0, 0, "https://b.in/job/9999999?utm_a=1", "Dev at Bee - x", text, ""),
        (0, 1, "https://naukri.com/python-jobs", "", "[a](https://x.in/job/1111111) [b](/job/2222222) [a](https://x.in/job/1111111) [c](https://x.in/job/3333333) [d](https://x.in/job/4444444)", ""),
        (0, 2, "https://naukri.com/job/8888888", "Dev | Nau", "", "snippet with skills to apply"),
        (1, 0, "https://b.in/job/9999999", "again", text, ""), (1, 1, "https://youtube.com/watch", "", "", ""), (9, 0, "https://b.in/job/7777777", "late query", text, ""),
    ]
    results = spark.createDataFrame(results, "query int, nth int, url string, title string, markdown string, description string")
    details = spark.createDataFrame([("https://x.in/job/1111111", "A at Ex", text), ("https://naukri.com/job/2222222", None, text), ("https://x.in/job/3333333", "C", "all jobs"), ("https://x.in/job/4444444", "D", text)], "url string, title string, markdown string")
    caps = terms.SEARCH_CAPS | {"queries": 5, "links": 3, "details": 2}
    got = R.search_web(results, details, F.lit("2026-01-10").cast("timestamp"), caps=caps).orderBy("place").collect()
    # preferred sites first: the list's links, then the posting on that site, then the other; the third link is beyond the cap on details
    assert [r.job_url for r in got] == ["https://x.in/job/1111111", "https://naukri.com/job/2222222", "https://naukri.com/job/8888888", "https://b.in/job/9999999"]
    assert (got[0].company, got[0].location, got[0].posting_date[:10]) == ("Ex", "Pune", "2026-01-08")
    assert [r.job_url for r in R.search_web(results, details, F.lit("2026-01-10").cast("timestamp"), caps=caps | {"total": 1, "expansions": 0}).collect()] == ["https://naukri.com/job/8888888"]


def test_sinks(spark, tmp_path):
    df = spark.createDataFrame([(1, ["a", "b"], None, True)], "b int, a array<string>, c string, d boolean")
    assert K.as_cells(df).first().asDict() == {"b": "1", "a": "a; b", "c": "", "d": "true"}
    K.export_stage(df, str(tmp_path), "raw", {"k": "v"})
    assert spark.read.option("header", True).csv(f"{tmp_path}/raw/csv").columns == ["a", "b", "c", "d"]
    sent = []
    row = spark.createDataFrame([(1,)], "x int")

    def fail(batch):
        raise OSError("down")

    assert K.append_with_queue(row, f"{tmp_path}/q", fail) is False
    assert K.append_with_queue(row, f"{tmp_path}/q", lambda batch: sent.append(batch.count())) is True
    assert sent == [2] and outbox.waiting(f"{tmp_path}/q") == []
    for i in range(5):
        K.publish(row.withColumn("x", F.lit(i)), f"{tmp_path}/t")
        assert [r.x for r in K.current(spark, f"{tmp_path}/t").collect()] == [i]
    assert [n for n, _ in K.versions(spark, f"{tmp_path}/t")] == [3, 4, 5]
    row.write.parquet(f"{tmp_path}/t/v-half")  # a writer that dies before its commit changes nothing
    assert [r.x for r in K.current(spark, f"{tmp_path}/t").collect()] == [4] and K.current(spark, f"{tmp_path}/none") is None
    listings = spark.createDataFrame([(90, "Exceptional", "A", "C", "u", "a@b.co", 2), (95, "Exceptional", "B", "C", "v", "", 1), (10, "Weak", "W", "C", "w", "", 3)], "fit_score int, fit_tier string, title string, company string, job_url string, recruiter_email string, arrival_ord int")
    text = K.digest_text(listings, spark.createDataFrame([("s", 2), ("t", 5)], "source string, n int"))
    assert text.splitlines() == ["2 matches, 1 with a contact", "", "t: 5", "s: 2", "", "== Exceptional (2) ==", "95 - B at C (v)", "90 - A at C (u)"]
    mail = []
    K.send_digest(text, 2, "10 Jan", lambda subject, body: mail.append((subject, body)))
    assert mail == [("2 matches - 10 Jan", text)]
    with pytest.raises(TypeError):
        K.only_scalars(df)


def answer(prompt):
    if "Broken" in prompt:
        raise ValueError("invalid json")
    if "Slow" in prompt:
        raise TimeoutError("timeout")
    good = {"role_match": 25, "experience_match": "20", "technical_match": 99, "project_match": 10, "education_match": 5, "location_match": 5, "company_quality": 0, "is_fresher_appropriate": "true", "why": "fits", "gaps": None}
    return "```json\n" + json.dumps(good) + "\n```"


def test_two_runs_resume(spark):
    import sys

    from pyspark import cloudpickle

    cloudpickle.register_pickle_by_value(sys.modules[__name__])
    schema = "job_url string, title string, company string, location string, description string, source string, posting_date string, arrival_ord long"
    text = "Fresher role with React and SQL"
    raw = spark.createDataFrame([("u/1", "Software Engineer", "A", "Pune", text, "s", "", 1), ("u/1?utm_x=1", "Software Engineer", "A", "Pune", text, "s", "", 2), ("u/2", "Software Engineer Broken", "A", "Pune", text, "s", "", 3), ("u/3", "Software Engineer Slow", "A", "Pune", text, "t", "", 4), ("u/4", "Cook", "A", "Pune", text, "t", "", 5)], schema)
    seen = spark.createDataFrame([], "job_url string")
    state = spark.createDataFrame([], f"job_url string, status string, attempts int, evaluation_key string, verdict struct<{', '.join(x.strip().replace(' ', ':', 1) for x in P.VERDICT.split(','))}>, last_error string, lease_expires_at timestamp, updated_at timestamp")
    deferred = spark.createDataFrame([], schema + ", prefilter_score int, rank int")
    when = {"as_of": F.lit("2026-01-10").cast("date"), "now": F.lit("2026-01-10").cast("timestamp")}
    one = P.run(raw, seen, deferred, state, [answer], **when)
    assert one.unique.count() == 4 and one.shortlist.count() == 3 and one.deferred.count() == 0
    assert rows(one.final, "job_url", "fit_score", "fit_tier", "reason") == [("u/1", 90, "Exceptional", "fits")]
    assert rows(one.state, "job_url", "status") == [("u/1", "PASSED"), ("u/2", "PERMANENT_ERROR"), ("u/3", "RETRYABLE_ERROR")]
    assert one.counts == {"raw": 5, "unique": 4, "passed": 1, "rejected": 0, "unfinished": 1}


def test_verdict_rules(spark):
    text = json.dumps({"is_walkin": True, "walkin_date": "2026-02-01", "role_match": 25, "technical_match": 25, "experience_match": 20, "is_fresher_appropriate": True, "why": ["a", "b"]})
    df = spark.createDataFrame([("t", "Fresher walk-in on 15 January 2026", text), ("t", "Fresher walk-in on 5 January 2026", text), ("t", "5+ years required", text)], "title string, description string, v string")
    got = L.apply_verdict(df.withColumn("verdict", P.verdict_struct(F.col("v"))), F.lit("2026-01-10").cast("date")).coalesce(1).collect()
    assert [(r.fit_score, r.fit_tier, r.verification_status, r.walkin_date_conflict, r.passed) for r in got] == [(70, "Good", "upcoming", True, True), (0, "Reject", "expired", True, False), (0, "Reject", "upcoming", False, False)]
    assert got[0].reason == "a; b" and got[0].walkin_date == "2026-01-15"


def test_query_names_have_oracles():
    assert set(Q.oracle_sql()) == set(Q.queries()) and len(Q.queries()) > 120


def documents(spark, folder, rows):
    """A documents table of (doc_id, text), as a folder for the registered queries."""
    spark.createDataFrame([(i, t, len(t)) for i, t in rows], "doc_id long, text string, n_chars long").write.parquet(f"{folder}/documents.parquet")
    return str(folder)


def test_priority_words_reads_whole_texts(spark, tmp_path):
    texts = ["x " * 200 + "The y la", " ".join(f"w{i % 40}" for i in range(300)) + " de", "a b" * 99 + " " + "long" * 60 + " the end"]
    want = []
    for t in texts:
        seen = list(dict.fromkeys(t.lower().split(" ")))
        want.append(" ".join(([x for x in ("la", "the", "de") if x in seen] + [x for x in seen if x not in ("la", "the", "de")])[:30]))
    got = MQ.priority_words(spark, documents(spark, tmp_path, list(enumerate(texts))))
    assert [r.words for r in got.orderBy("doc_id").collect()] == want


def test_experience_parse_reads_whole_texts(spark, tmp_path):
    far = "x " * 150
    texts = [far + "a fresher is welcome", far + "senior lead architect", far + "9 years, preferred", "plain"]
    got = Q.experience_parse(spark, documents(spark, tmp_path, list(enumerate(texts)))).orderBy("doc_id").collect()
    # the phrases alone have 2, 4, 5 (preferred) and 12 years; 'senior lead role' is too senior
    assert [(r.years, r.preferred, r.eligible) for r in got] == [(23, 1, 8), (23, 1, 2), (59, 8, 7), (23, 1, 4)]


def test_final_rank_ranks_all_rows(spark, tmp_path):
    texts = [("write to a@b.com " if i % 7 == 0 else "") + "x" * (i * 37 % 101) for i in range(700)]
    want = sorted(range(700), key=lambda i: (i % 7 > 0, -len(texts[i]), i))
    got = Q.final_rank(spark, documents(spark, tmp_path, list(enumerate(texts))))
    assert [(r["rank"], r.doc_id) for r in got.orderBy("rank").collect()] == list(enumerate(want, 1))


def test_chain_of_providers():
    from quarry.sources import providers as V

    class Time:
        now, slept = 0.0, []

        def sleep(self, s):
            self.slept.append(s)
            self.now += s

    good, log = {"choices": [{"message": {"content": '```json\n{"a": 1}\n```'}}]}, []
    time_ = Time()
    time_.slept = []
    clock = V.Clock(lambda: time_.now, time_.sleep)
    chat, generate, gateway = V.chat_binding("c", "key", "m"), V.generate_binding("g", "key"), V.gateway_binding("w")
    record = lambda *e: log.append(e[:2])

    def answers(*replies):
        left = list(replies)

        def transport(url, headers, payload, timeout):
            time_.now += 1
            reply = left.pop(0)
            if isinstance(reply, type):
                raise reply("x")
            return reply

        return transport

    ask = lambda b, *replies, **k: V.ask(b, "p", answers(*replies), record=record, clock=clock, **k)
    assert ask(chat, V.Reply(200, good)).found == {"a": 1}
    assert ask(chat, V.Reply(429, retry_after="3"), V.Reply(200, good)).found and time_.slept == [3.0]
    assert ask(chat, V.Reply(429), V.Reply(429)) == V.Outcome(limited=True) and time_.slept == [3.0, 5.0]
    assert ask(chat, V.Reply(404)) == V.Outcome() and log[-1] == ("chat", "HTTP_404")
    assert ask(generate, TimeoutError, V.Reply(200, {"candidates": [{"content": {"parts": [{"text": '{"b": 2}'}]}}]})).found == {"b": 2}
    assert ask(chat, V.Reply(200, {"choices": []}), V.Reply(200, good)).found and ("chat", "INVALID_RESPONSE") in log
    assert ask(gateway, V.Reply(200, {"content": ""})) == V.Outcome() and log[-1] == ("gateway", "INVALID_RESPONSE")
    assert ask(gateway, V.Reply(503), V.Reply(200, {"content": {"c": 3}})).found == {"c": 3} and time_.slept[-1] == 3.0
    assert ask(gateway, V.Reply(429)).limited and ask(chat, ConnectionError, ConnectionError) == V.Outcome() and log[-1] == ("chat", "NETWORK_ERROR")
    assert ask(V.chat_binding("c", "", "m")) == V.Outcome()
    chain = lambda *replies, **k: V.Chain([chat, gateway], answers(*replies), clock=clock, backoffs={}, **k)
    assert chain(V.Reply(404), V.Reply(200, {"content": {"c": 3}})).evaluate("p") == ({"c": 3}, None)
    c = chain(V.Reply(429), V.Reply(429), V.Reply(404), V.Reply(200, good), rounds=2)
    assert c.evaluate("p") == ({"a": 1}, None) and not c.backoffs["chat"].active() and c.backoffs["gateway"].active()
    assert chain(*[V.Reply(404)] * 6).evaluate("p") == (None, "all providers failed")
    assert chain(*[V.Reply(404)] * 6).evaluate("p", time_.now + 10) == (None, "deadline_exceeded")
    late = chain()
    late.backoff(chat).activate(100)
    assert late.evaluate("p", time_.now + 5) == (None, "deadline_exceeded")


def test_chain_in_a_review(spark):
    import sys

    from pyspark import cloudpickle

    from quarry.sources import providers as V

    cloudpickle.register_pickle_by_value(sys.modules[__name__])
    df = spark.createDataFrame([("u", "t", "c", "l", "d")], "job_url string, title string, company string, location string, description string")
    chain = V.Chain([V.gateway_binding("w")], lambda url, headers, payload, timeout: V.Reply(200, {"content": {"fit_score": 1}}))
    assert [(r.verdict_text, r.error) for r in P.evaluate(df, chain, P.Settings()).collect()] == [('{"fit_score": 1}', None)]
    assert [(r.verdict_text, r.error) for r in P.evaluate(df, chain, P.Settings(deadline=1.0)).collect()] == [(None, "deadline_exceeded")]
    with pytest.raises(ValueError):
        P.Settings(concurrency=0)


def test_monitor(spark, tmp_path):
    from quarry.plans import monitor as MO

    (tmp_path / "logs").mkdir()
    (tmp_path / "logs" / "run_1.log").write_text("fine")
    (tmp_path / "logs" / "run_2.log").write_bytes("an Error\nTRACEBACK error\nok".encode("utf-16"))
    import os

    os.utime(tmp_path / "logs" / "run_1.log", (1, 1))
    when = lambda m: F.lit(f"2026-01-10 10:{m}:00").cast("timestamp")
    files = spark.range(1).select(F.lit('{"status": "running"}').alias("progress"), when("00").alias("progress_at"), when("09").alias("metrics_at"))
    got = {r.check: (r.ok, r.detail) for r in MO.health_report(spark, log_folder=f"file://{tmp_path}/logs", artifacts=files, changed_files=["x"], ignore_file=b"a\x00").collect()}
    assert got == {"files": (False, "1 changed"), "ignore file": (False, "2 bytes"), "log": (False, "ERROR=2, Traceback=1"), "artifacts": (False, "progress and metrics are not of one run; status is running")}
    with pytest.raises(RuntimeError, match="ALERT_EMAIL_TO"):
        MO.validate({"GOOGLE_SHEET_ID": "x", "GOOGLE_SERVICE_ACCOUNT_JSON": "y"})
    assert MO.get_logger("quarry.test") is MO.get_logger("quarry.test") and len(MO.get_logger("quarry.test").handlers) == 1
    slept, said = [], []
    assert MO.run_every(lambda: 1 / 0, 2, times=3, sleep=slept.append, log=said.append) == 3 and slept == [7200, 7200] and len(said) == 3


def test_sql_names(spark, tmp_path):
    from quarry.functions.register import register

    register(spark)
    (tmp_path / "a.json").write_text('{"x": {"Tech_Skills": ["a"]}, "techskills": "b"}')
    landed = spark.read.format("landed").option("paths", f"file://{tmp_path}/a.json").load()
    landed.createOrReplaceTempView("landed_rows")
    assert [r.value for r in spark.sql("SELECT value FROM landed_rows, LATERAL json_aliases(body, 'tech skills') ORDER BY nth").collect()] == ['["a"]', "b"]
    row = spark.sql("SELECT repair_json('so {\"a\": [1, 2') AS j, walkin_dates('Walk-in drive on 15 January 2026', DATE '2026-01-10').start AS d").first()
    assert (row.j, str(row.d)) == ('{"a": [1, 2]}', "2026-01-15")


def test_sources_fail_alone_and_share(spark):
    import threading

    def late():
        @F.udf("string")
        def broken(x):
            raise ValueError("half way")

        return spark.range(3).select(broken("id").alias("x"))

    def unplanned():
        raise OSError("down")

    good, bad = R.try_sources({"a": lambda: spark.range(3).toDF("x"), "b": late, "c": unplanned, "d": lambda: spark.range(0).toDF("x")})
    assert {k: v.count() for k, v in good.items()} == {"a": 3, "d": 0} and set(bad) == {"b", "c"}
    asked = []
    once = R.OncePerRun(lambda: asked.append(1) or spark.range(2))
    threads = [threading.Thread(target=once) for _ in range(5)]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    assert len(asked) == 1 and once() is once()
    fails = R.OncePerRun(unplanned)
    for _ in range(2):
        with pytest.raises(OSError):
            fails()


def test_date_query(spark):
    assert dt.date.fromisoformat(Q.AS_OF)


def fetch(url):
    if "slow" in url:
        time.sleep(5)
    if "bad" in url:
        raise OSError("down")
    return "page of " + url * 10


def test_fetching(spark):
    import sys

    from pyspark import cloudpickle

    from quarry.sources import fetch as X

    cloudpickle.register_pickle_by_value(sys.modules[__name__])
    urls = spark.createDataFrame([("u1",), ("u1",), ("bad",), ("slow",), ("",), (None,)], "url string")
    got = {r.url: (r.markdown is not None, (r.error or "").split(":")[0]) for r in X.fetch_urls(urls, fetch, concurrency=2, timeout=1.0).collect()}
    assert got == {"u1": (True, ""), "bad": (False, "OSError"), "slow": (False, "TimeoutError")}
    both = X.fetch_with_fallback(urls.where("url = 'bad'"), fetch, lambda u: "second", concurrency=1).collect()
    assert [r.markdown for r in both] == ["second"]
    assert X.probe(spark, fetch, "https://example.com") and not X.probe(spark, fetch, "bad")
    asked = []
    got = X.fetch_with_fallback(urls.where("url = 'u1'"), fetch, lambda u: asked.append(u) or "second", concurrency=1).collect()
    assert len(got) == 1 and got[0].markdown.startswith("page") and not asked
    with pytest.raises(ValueError):
        X.fetch_with_fallback(urls, fetch, fetch, provider="third")
    site = {"https://indeed.com/a": "[x](/sde-b) https://other.com/c https://naukri.com/n [e](/e)", "https://indeed.com/sde-b": "[back](https://indeed.com/a) [d](d)", "https://indeed.com/d": "end", "https://indeed.com/e": "end", "https://naukri.com/s": "[t](/t)", "https://naukri.com/t": "end"}
    seeds = spark.createDataFrame([("https://indeed.com/a",), ("https://naukri.com/s",), ("https://other.com/x",)], "url string")
    found = X.crawl(seeds, lambda u: site[u], concurrency=1)
    assert rows(found, "url", "depth") == [("https://indeed.com/a", 0), ("https://indeed.com/d", 2), ("https://indeed.com/e", 1), ("https://indeed.com/sde-b", 1), ("https://naukri.com/s", 0), ("https://naukri.com/t", 1)]
    # each seed has two pages; the better link comes first
    assert rows(X.crawl(seeds, lambda u: site[u], concurrency=1, pages=2), "url") == [("https://indeed.com/a",), ("https://indeed.com/sde-b",), ("https://naukri.com/s",), ("https://naukri.com/t",)]
    post = "[Software Engineer at Acme](https://indeed.com/viewjob/1)\n" + "Responsibilities and skills to apply in Pune. " * 10
    pages = {"https://indeed.com/a": "[Software Engineer](https://indeed.com/viewjob/1)", "https://indeed.com/viewjob/1": post}
    listings, seeds_done = X.discover(seeds.where("url LIKE '%indeed%'"), lambda u: pages[u], concurrency=1)
    assert [(r.job_url, r.location) for r in listings.collect()] == [("https://indeed.com/viewjob/1", "Pune")]
    assert [(r.ok, r.pages, r["rows"], r.status) for r in seeds_done.collect()] == [(True, 2, 1, "SUCCESS")]
    with pytest.raises(RuntimeError, match="every seed failed"):
        X.discover(seeds, lambda u: {}[u], concurrency=1)
    with pytest.raises(X.SourceDisabled):
        X.discover(seeds, fetch, enabled=False)
    assert X.seen_urls(spark, "/nowhere/at/all").count() == 0
    good = "Requirements and skills to apply in Pune. "

    def search(text, most):
        if text == "bad":
            raise OSError("down")
        return [{"url": "https://x.in/python-jobs", "title": "list", "markdown": "[a](https://x.in/job/1111111) [b](https://x.in/job/2222222)"}, {"url": f"https://x.in/job/{text}", "title": "T at Co", "description": good}] * most

    queries = spark.createDataFrame([(0, "3333333"), (1, "bad"), (2, "4444444")], "query int, text string")
    when = F.lit("2026-01-10").cast("timestamp")
    got = X.web_search(queries, search, lambda u: good if u.endswith("2") else "all jobs", when, key="k", concurrency=1).orderBy("place").collect()
    assert [(r.job_url[-7:], r.location) for r in got] == [("2222222", "Pune"), ("3333333", "Pune"), ("4444444", "Pune")]
    assert [r.error for r in X.search_queries(queries.where("query = 1"), search).collect()] == ["OSError: down"]
    with pytest.raises(X.NotConfigured):
        X.web_search(queries, search, fetch, when)
    assert X.search_queries(queries.where("query = 0"), search, limit=500).count() == 100
    waits = []
    with pytest.raises(OSError):
        X.with_retries(lambda: fetch("bad"), sleep=waits.append)
    assert waits == [2.0, 4.0]


def test_search_summary_of_more_listings_than_raw_rows(spark, tmp_path):
    spark.range(5003).select(F.when(F.col("id") < 5000, "a").otherwise("b").alias("source")).write.parquet(f"{tmp_path}/documents.parquet")
    spark.range(4).select(F.col("id").alias("n_nationkey"), F.col("id").cast("string").alias("n_name")).write.parquet(f"{tmp_path}/nation.parquet")
    got = source_queries.search_summary(spark, str(tmp_path)).first()
    # as the query's SQL has it; the operator itself counts from 0
    assert (got.total_unique_jobs, got.duplicate_count, got.breakdown, got.largest) == (5003, -3, "a=5000,b=3", 99.94)


def test_made_responses_do_not_grow_with_the_table(spark, tmp_path):
    n = F.col("id")
    named = lambda word, k: F.concat(F.lit(word), n % k).alias
    table = spark.range(20_000).select(n.alias("p_partkey"), named("name ", 9)("p_name"), named("Brand", 5)("p_brand"), named("TYPE ", 4)("p_type"))
    table.write.parquet(f"{tmp_path}/part.parquet")
    longest = {}
    for keys in (2_000, 20_000):
        rows = source_queries._part_rows(spark, str(tmp_path)).where(F.col("p_partkey") < keys)
        for group in ("p_group", "p_brand"):
            body = source_queries._bodies(rows, group, F.struct("u"), "items")
            longest[keys, group] = body.agg(F.max(F.length("body"))).first()[0]
            assert body.select(F.sum(F.size(F.from_json("body", "items array<struct<u:string>>")["items"]))).first()[0] == keys
    assert all(longest[20_000, group] < 1.2 * longest[2_000, group] for group in ("p_group", "p_brand"))
    got = source_queries.source_embedded_json(spark, str(tmp_path))
    assert got.count() == got.select("job_url").distinct().count() == 20_000
    assert source_queries.landed_files(spark, str(tmp_path)).select("job_url").distinct().count() == 20_000


def test_streaming_state_machine(spark, tmp_path):
    from quarry.streaming.machine import ROCKSDB, run_state_machine

    rows_in = [("a", 1, "EVALUATING", None), ("a", 2, "EVALUATED", None), ("a", 3, "QUEUED", None), ("a", 4, "PASSED", None), ("b", 1, "RETRYABLE_ERROR", "invalid json"), ("c", 1, "PASSED", None)]
    spark.createDataFrame(rows_in, "key string, ord long, status string, error string").coalesce(1).write.parquet(f"{tmp_path}/in")
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)
    stream = spark.readStream.schema("key string, ord long, status string, error string").parquet(f"{tmp_path}/in")
    out = run_state_machine(stream).writeStream.format("parquet").option("path", f"{tmp_path}/out").option("checkpointLocation", f"{tmp_path}/log").start()
    # with processing-time timers a query never runs out of work: wait for the input, then stop
    for _ in range(600):
        if any(p["numInputRows"] for p in out.recentProgress):
            break
        time.sleep(0.1)
    out.stop()
    got = rows(spark.read.parquet(f"{tmp_path}/out"), "key", "ord", "from_status", "to_status", "valid")
    assert got == [("a", 1, "QUEUED", "EVALUATING", True), ("a", 2, "EVALUATING", "EVALUATED", True), ("a", 3, "EVALUATED", "QUEUED", False), ("a", 4, "EVALUATED", "PASSED", True), ("b", 1, "QUEUED", "PERMANENT_ERROR", True), ("c", 1, "QUEUED", "PASSED", False)]


def test_streaming_keys_share_states(spark, tmp_path):
    from quarry.streaming.machine import ROCKSDB, run_state_machine, running_failures

    r = random.Random(5)
    statuses = ["EVALUATING", "EVALUATED", "PASSED", "RETRYABLE_ERROR", "QUEUED"]
    events = [(r.choice([None, *range(300)]), i, r.choice(statuses), r.choice(["invalid json", None]), r.random() < 0.5) for i in range(2000)]
    for part in (events[:1000], events[1000:]):
        spark.createDataFrame(part, "key long, ord long, status string, error string, failed boolean").coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)
    stream = spark.readStream.schema("key long, ord long, status string, error string, failed boolean").option("maxFilesPerTrigger", 1).parquet(f"{tmp_path}/in")
    counts, steps = {}, {}
    for key, ord_, wanted, error, failed in events:
        n, failures, run = counts.get(key, (0, 0, 0))
        counts[key] = (n + 1, failures + failed, run + 1 if failed else 0)
        now = next((s[1] for s in reversed(steps.get(key, [])) if s[2]), "QUEUED")
        target = "PERMANENT_ERROR" if wanted == "RETRYABLE_ERROR" and error else wanted
        through = now == "QUEUED" and target in ("RETRYABLE_ERROR", "PERMANENT_ERROR")
        steps.setdefault(key, []).append((ord_, target, target == now or through or (now, target) in set(terms.TRANSITIONS)))

    done = running_failures(stream, buckets=8).writeStream.outputMode("update").option("checkpointLocation", f"{tmp_path}/log1").trigger(availableNow=True)
    done = done.foreachBatch(lambda df, i: df.write.parquet(f"{tmp_path}/out1/batch={i}")).start()
    done.awaitTermination()
    # one state for each bucket, whatever the number of keys
    assert max(p["stateOperators"][0]["numRowsTotal"] for p in done.recentProgress) == 8
    got = spark.read.schema("key long, n long, failures long, run long, batch int").parquet(f"{tmp_path}/out1")
    last = {x.key: (x.n, x.failures, x.run) for x in got.orderBy("batch").collect()}
    assert last == counts and got.where("batch = 0").count() < len(counts) < got.count()

    out = run_state_machine(stream, buckets=8).writeStream.format("parquet").option("path", f"{tmp_path}/out2").option("checkpointLocation", f"{tmp_path}/log2").start()
    for _ in range(600):
        if not out.isActive or sum(p["numInputRows"] for p in out.recentProgress) == 2000:
            break
        time.sleep(0.1)
    out.stop()
    got = {x.ord: (x.key, x.to_status, x.valid) for x in spark.read.parquet(f"{tmp_path}/out2").collect()}
    assert got == {o: (None if k is None else str(k), target, valid) for k, found in steps.items() for o, target, valid in found}


def test_stream_rows_are_packed_by_bucket(monkeypatch):
    import pyarrow as pa

    from quarry.streaming import machine

    r = random.Random(7)
    events = [(r.randrange(5), r.choice([None, "a", "b"]), r.choice([None, i]), r.choice([None, True, False])) for i in range(2500)]
    parts = [pa.RecordBatch.from_pylist([dict(zip(("bucket", "key", "ord", "failed"), x, strict=True)) for x in events[i : i + 100]]) for i in range(0, 2500, 100)]
    monkeypatch.setattr(machine, "PACKED_ROWS", 1000)
    packed = [batch.to_pylist() for batch in machine._pack(iter(parts))]
    # every thousand rows become a row for each bucket
    assert [[x["bucket"] for x in rows] for rows in packed] == [[0, 1, 2, 3, 4]] * 3
    for i, batch in enumerate(packed):
        for x in batch:
            assert list(zip(x["key"], x["ord"], x["failed"], strict=True)) == [e[1:] for e in events[1000 * i : 1000 * i + 1000] if e[0] == x["bucket"]]
    assert list(machine._pack(iter(batch.slice(0, 0) for batch in parts))) == []


def test_stream_state_takes_all_events_in_states_for_their_number(spark, tmp_path, monkeypatch):
    from pyspark.sql.streaming import StreamingQueryListener

    from quarry.streaming import machine

    states, r = [], random.Random(9)

    class Seen(StreamingQueryListener):
        onQueryStarted = onQueryIdle = onQueryTerminated = lambda self, event: None

        def onQueryProgress(self, event):
            states.extend((s.numRowsTotal, s.numShufflePartitions) for s in event.progress.stateOperators)

    # some without an id, with one below zero, without a value or a user
    events = [(r.choice([i] * 20 + [None, -i]), r.choice([None, *range(1000)]), r.choice([None, 10.0, 50.0])) for i in range(6000)]
    events.append((6000, 0, 50.0))
    spark.createDataFrame(events, "event_id long, user_id long, value double").write.parquet(f"{tmp_path}/events.parquet")
    monkeypatch.setattr(machine, "PACKED_ROWS", 500)
    before = {name: spark.conf.get(name) for name in ("spark.sql.shuffle.partitions", "spark.sql.streaming.stateStore.providerClass")}
    listener = Seen()
    spark.streams.addListener(listener)
    try:
        spark.conf.set("spark.sql.shuffle.partitions", "50")
        got = {x.key: (x.n, x.failures) for x in Q.stream_state(spark, str(tmp_path)).collect()}
        assert spark.conf.get("spark.sql.shuffle.partitions") == "50"
        for _ in range(100):
            if len(states) >= 4:
                break
            time.sleep(0.1)
    finally:
        spark.streams.removeListener(listener)
        for name, value in before.items():
            spark.conf.set(name, value)
    want = {}
    for _, user, value in events:
        n, failures = want.get(user, (0, 0))
        want[user] = (n + 1, failures + (value is not None and value < 40))
    assert got == want
    # 64 states, not one for each of the thousand keys, in 16 partitions
    assert max(states) == (64, 16)
    assert [Q._buckets(rows) for rows in (0, 6_000_000, 36_000_000)] == [64, 91, 549]


def test_leases_of_a_bucket_end_each_in_its_time():
    import pandas as pd

    from quarry.streaming.machine import StateMachine

    class Value:
        held = None
        exists = lambda self: self.held is not None
        get = lambda self: self.held

        def update(self, value):
            self.held = value

    class Handle:
        def __init__(self):
            self.value, self.timers = Value(), []

        def getValueState(self, *args, **more):
            return self.value

        def registerTimer(self, at):
            self.timers.append(at)

    class At:
        def __init__(self, ms):
            self.getCurrentProcessingTimeInMs = self.getExpiryTimeInMs = lambda: ms

    handle, machine, hour = Handle(), StateMachine(), terms.LEASE_SECONDS * 1000
    machine.init(handle)
    feed = lambda at, *keys: list(machine.handleInputRows((0,), iter([pd.DataFrame([(k, i, s, None) for i, (k, s) in enumerate(keys)], columns=["key", "ord", "status", "error"])]), At(at)))
    feed(0, ("a", "EVALUATING"), ("b", "EVALUATING"), ("c", "EVALUATING"), ("b", "EVALUATED"))
    feed(10, ("d", "EVALUATING"), ("e", "QUEUED"), ("c", "EVALUATED"))
    assert handle.timers == [hour, hour + 10]
    late = lambda at: [tuple(x) for df in machine.handleExpiredTimer((0,), None, At(at)) for x in df.itertuples(index=False)]
    assert late(hour) == [("a", -1, "EVALUATING", "RETRYABLE_ERROR", True, 1)]
    assert late(hour + 10) == [("d", -1, "EVALUATING", "RETRYABLE_ERROR", True, 1)]
    assert late(hour + 10) == []


def test_a_large_micro_batch_is_several_files(spark, tmp_path, monkeypatch):
    spark.range(1000).select(F.col("id").alias("event_id")).repartition(3).write.parquet(f"{tmp_path}/events.parquet")
    for size, files in ((100, 2), (500_000, 1)):
        monkeypatch.setattr(Q, "_STREAM_ROWS", size)
        stream, _ = Q._stream(spark, str(tmp_path), 4, ["event_id"])
        seen, reads = {}, []
        done = stream.writeStream.trigger(availableNow=True).option("checkpointLocation", f"{tmp_path}/log{size}")

        def take(df, i, seen=seen, reads=reads):
            got = df.select("event_id", F.input_file_name().alias("file")).collect()
            seen[i] = sorted(x.event_id for x in got)
            reads.append(len({x.file for x in got}))

        done.foreachBatch(take).start().awaitTermination()
        assert seen == {i: list(range(250 * i, 250 * i + 250)) for i in range(4)}
        assert reads == [files] * 4


def test_crawl_takes_the_best_link_of_any_depth(spark):
    import sys

    from pyspark import cloudpickle

    from quarry.sources import fetch as X

    cloudpickle.register_pickle_by_value(sys.modules[__name__])
    dull = " ".join(f"[d](/dull{i})" for i in range(6))
    site = {"/": dull + " [s](/sde-jobs)", "/sde-jobs": "[r](/react-node-software-engineer)", "/react-node-software-engineer": "[g](/graduate-backend-intern)", "/graduate-backend-intern": "end"}
    seeds = spark.createDataFrame([("https://indeed.com/",), ("https://naukri.com/",)], "url string")

    def fetch(url):
        return site.get("/" + url.split("/", 3)[3], "end")

    def path(budget, width, depth=3):
        got = X.crawl(seeds, fetch, concurrency=1, pages=budget, width=width, depth=depth).collect()
        assert len(got) == len({(r.seed, r.url) for r in got})
        return {seed: sorted((r.depth, r.url.split("/", 3)[3]) for r in got if r.seed == seed) for seed in {r.seed for r in got}}

    # the deep pages with keywords go before the dull ones next to the seed, and each seed has its own budget
    best = [(0, ""), (1, "sde-jobs"), (2, "react-node-software-engineer"), (3, "graduate-backend-intern")]
    assert path(4, 1) == {f"https://{h}.com/": best for h in ("indeed", "naukri")}
    assert path(5, 1)["https://indeed.com/"] == sorted([*best, (1, "dull0")])
    assert [u for _, u in path(4, 1, depth=2)["https://indeed.com/"]] == ["", "dull0", "sde-jobs", "react-node-software-engineer"]
    assert len(path(50, 3)["https://naukri.com/"]) == 10
