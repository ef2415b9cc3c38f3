import os
import threading

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from quarry.operators import listings as L
from quarry.plans import pipeline as P
from quarry.sources import arrivals as A
from quarry.sources import outbox as O
from quarry.sources import readers as R
from quarry.sources import sinks as K
from quarry.sources.commits import CommitLog, Conflict
from quarry.sources.tables import BucketTable, History


def keyed(spark, start, end, **columns):
    return spark.range(start, end).select(F.concat(F.lit("u/"), "id").alias("job_url"), *(F.lit(v).alias(k) for k, v in columns.items()))


# ---- commits ----


def test_a_number_is_committed_once(spark, tmp_path):
    log, won = CommitLog(spark, f"file://{tmp_path}/log"), []
    assert log.latest() == (0, None)

    def claim(i):
        if log.commit(1, {"who": i}):
            won.append(i)

    threads = [threading.Thread(target=claim, args=(i,)) for i in range(8)]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    assert len(won) == 1
    assert log.latest() == (1, {"who": won[0]})
    assert [x for x in os.listdir(tmp_path / "log") if "draft" in x and not x.endswith(".crc")] == []


def test_two_writers_of_one_base(spark, tmp_path):
    root = str(tmp_path / "t")
    K.publish(keyed(spark, 0, 3), root)
    base = K.current_number(spark, root)
    first, second = keyed(spark, 0, 4), keyed(spark, 0, 5)
    K.publish(first, root, base=base)
    with pytest.raises(Conflict):
        K.publish(second, root, base=base)
    assert K.current(spark, root).count() == 4
    K.publish(second.unionByName(K.current(spark, root)), root, base=K.current_number(spark, root))
    assert K.current(spark, root).count() == 9
    assert [n for n, _ in K.versions(spark, root)] == [1, 2, 3]


# ---- copy-on-write buckets ----


def folders(table):
    return {p: x for p, x in table.log.latest()[1]["parts"].items()}


def test_upsert_rewrites_touched_buckets_alone(spark, tmp_path):
    table = BucketTable(spark, str(tmp_path / "t"), "job_url", buckets=8)
    assert table.read() is None
    table.upsert(keyed(spark, 0, 100, status="QUEUED", n=1), ["n"])
    before = folders(table)
    files = {x: sorted(os.listdir(tmp_path / "t" / x)) for xs in before.values() for x in xs}
    table.upsert(spark.createDataFrame([("u/5", "PASSED", 2), ("u/5", "REJECTED", 3), ("new", "QUEUED", 1), (None, "QUEUED", 1), (None, "PASSED", 9)], "job_url string, status string, n int"), ["n"])
    after = folders(table)
    changed = {p for p in after if after[p] != before.get(p)}
    assert 1 <= len(changed) <= 3
    assert all(sorted(os.listdir(tmp_path / "t" / x)) == files[x] for p, xs in before.items() for x in xs if p not in changed)
    got = {r.job_url: r.status for r in table.read().collect()}
    assert len(got) == 102
    assert (got["u/5"], got["u/6"], got["new"], got[None]) == ("REJECTED", "QUEUED", "QUEUED", "PASSED")
    table.vacuum(keep=1)
    assert table.read().count() == 102


def test_writers_of_a_bucket_do_not_lose_each_others_rows(spark, tmp_path):
    root = str(tmp_path / "t")
    tables = [BucketTable(spark, root, "job_url", buckets=2) for _ in range(3)]
    errors = []

    def write(i):
        try:
            tables[i].upsert(keyed(spark, 10 * i, 10 * i + 10, who=i), ["who"])
        except Exception as e:
            errors.append(e)

    threads = [threading.Thread(target=write, args=(i,)) for i in range(3)]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    assert errors == []
    assert {r.who: r.n for r in tables[0].read().groupBy("who").agg(F.count("*").alias("n")).collect()} == {0: 10, 1: 10, 2: 10}


def test_a_lost_claim_is_rebased_or_redone(spark, tmp_path, monkeypatch):
    root = str(tmp_path / "t")
    mine, other = (BucketTable(spark, root, "job_url", buckets=64) for _ in range(2))
    mine.upsert(keyed(spark, 0, 20, n=1), ["n"])
    commit, calls = mine.log.commit, []

    def late(number, body):
        if not calls:
            calls.append(number)
            other.upsert(keyed(spark, 3, 4, n=5), ["n"])  # the same key, between mine's read and its commit
        return commit(number, body)

    monkeypatch.setattr(mine.log, "commit", late)
    mine.upsert(keyed(spark, 3, 5, n=2), ["n"])
    # both were the last to be put in when they were: the one committed later stands, and no other row is lost
    got = {r.job_url: r.n for r in mine.read().collect()}
    assert (got["u/3"], got["u/4"], len(got)) == (2, 2, 20)
    with pytest.raises(ValueError, match="has key"):
        BucketTable(spark, root, "job_url", buckets=8).upsert(keyed(spark, 0, 1, n=1), ["n"])


# ---- history ----


def test_history_is_exact_and_reads_few_ranges(spark, tmp_path, monkeypatch):
    seen = History(spark, str(tmp_path / "h"), ranges=32)
    assert seen.unseen(keyed(spark, 0, 3)).count() == 3
    seen.extend(keyed(spark, 0, 200))
    seen.extend(keyed(spark, 150, 400).unionByName(spark.createDataFrame([(None,)], "job_url string")))
    read, asked = seen._read, []
    monkeypatch.setattr(seen, "_read", lambda names, schema: (asked.extend(x for x in names if x.startswith("keys")), read(names, schema))[1])
    files = [f for run in seen.log.latest()[1]["runs"] for f in run["keys"][1]]
    batch = spark.createDataFrame([("u/3", 0), ("u/3", 1), ("new", 2), ("new", 3), (None, 4)], "job_url string, x int")
    assert sorted(r.x for r in L.unseen(batch, seen).collect()) == [2, 3, 4]
    assert 0 < len(asked) < len(files)  # only files that hold the one range of u/3
    asked.clear()
    assert seen.unseen(keyed(spark, 10_000, 10_004)).count() == 4
    assert asked == []  # nothing passed the filters: no keys were read
    assert sorted(r.job_url for r in seen.unseen(keyed(spark, 390, 405)).collect()) == [f"u/{i}" for i in range(400, 405)]
    assert sum(run["n"] for run in seen.log.latest()[1]["runs"]) == 400


@pytest.mark.parametrize("asked", [1 << 20, 7])
def test_history_with_filters_that_pass_everything(spark, tmp_path, monkeypatch, asked):
    monkeypatch.setattr(History, "BITS", 1)
    monkeypatch.setattr(History, "HASHES", 1)  # few bits and one hash: false positives in every range
    monkeypatch.setattr(History, "ASKED", asked)
    seen = History(spark, str(tmp_path / "h"), ranges=4)
    for i in range(0, 100, 20):
        seen.extend(keyed(spark, i, i + 20))
    assert seen._maybe(keyed(spark, 1000, 1200), seen.log.latest()[1]).count() > 5
    assert sorted(r.job_url for r in seen.unseen(keyed(spark, 90, 1000)).collect()) == sorted(f"u/{i}" for i in range(100, 1000))


def test_history_compacts(spark, tmp_path):
    seen = History(spark, str(tmp_path / "h"), ranges=2)
    for i in range(4):
        seen.extend(keyed(spark, 10 * i, 10 * i + 10))
    seen.compact(most=2)
    assert sorted(run["n"] for run in seen.log.latest()[1]["runs"]) == [10, 30]
    seen.extend(keyed(spark, 35, 50))
    seen.vacuum(keep=1)
    assert sorted(r.job_url for r in seen.unseen(keyed(spark, 0, 60)).collect()) == sorted(f"u/{i}" for i in range(50, 60))


# ---- outbox ----


def test_outbox_batches_are_whole_or_not_there(spark, tmp_path):
    root, rows = f"file://{tmp_path}/box", keyed(spark, 0, 40, n=1)
    O.put(rows.repartition(4), root)
    broken = F.when(F.col("job_url") == "u/7", F.raise_error(F.lit("broken"))).otherwise(F.col("job_url")).alias("job_url")
    with pytest.raises(PySparkException):
        O.put(rows.repartition(4).select(broken, "n"), root)
    O.put(rows.limit(0), root)
    assert len(O.waiting(root)) == 2
    assert O.pending(spark, root, rows.schema).count() == 40
    with pytest.raises(PySparkException):
        rows.write.format("outbox").mode("overwrite").option("path", root).save()


def test_outbox_hands_on_once_it_can(spark, tmp_path):
    root, rows, got = f"{tmp_path}/box", keyed(spark, 0, 10, n=1), []

    def down(batch):
        raise OSError("down")

    assert K.append_with_queue(rows, root, down) is False
    assert K.append_with_queue(keyed(spark, 10, 12, n=2), root, lambda batch: got.extend(batch.collect())) is True
    assert (len(got), O.waiting(root), os.listdir(f"{root}/rows")) == (12, [], [])
    assert K.append_with_queue(keyed(spark, 12, 13, n=3), root, lambda batch: got.extend(batch.collect())) is True
    assert len(got) == 13


def test_outbox_abort_removes_what_tasks_wrote(spark, tmp_path):
    rows = keyed(spark, 0, 5, n=1)
    writer, kept = (O.OutboxWriter(f"{tmp_path}/box", rows.schema) for _ in range(2))
    batch = rows.toArrow().to_batches()[0]
    messages = [writer.write(iter([batch])), writer.write(iter([])), None]
    kept.write(iter([batch]))
    assert [m.rows for m in messages[:2]] == [batch.num_rows, 0]
    writer.abort(messages)
    assert [x.startswith(kept.batch) for x in os.listdir(tmp_path / "box" / "rows")] == [True]
    O.clear(f"{tmp_path}/box")
    assert len(os.listdir(tmp_path / "box" / "rows")) == 1  # a write may still be going on
    O.clear(f"{tmp_path}/box", stale_seconds=-1)
    assert os.listdir(tmp_path / "box" / "rows") == []


# ---- arrivals ----


def test_a_stream_takes_each_landing_once(spark, tmp_path):
    root, taken = str(tmp_path / "in"), lambda: A.take_new(spark, root, str(tmp_path / "check"), str(tmp_path / "out"))
    responses = lambda *bodies: spark.createDataFrame([(b, "o") for b in bodies], "body string, origin string")
    assert A.land(responses("a", "b"), root) == 1
    assert sorted((r.landing, r.body) for r in taken().collect()) == [(1, "a"), (1, "b")]
    assert [A.land(responses(x), root) for x in "cd"] == [2, 3]
    responses("half").write.parquet(f"{root}/data-uncommitted")
    assert sorted((r.landing, r.body) for r in taken().collect()) == [(1, "a"), (1, "b"), (2, "c"), (3, "d")]
    assert taken().count() == 4
    assert sorted(map(tuple, A.arrivals(spark, root).collect())) == [(1, "a", "o"), (1, "b", "o"), (2, "c", "o"), (3, "d", "o")]
    assert A.arrivals(spark, str(tmp_path / "none")).count() == 0


# ---- lateral joins ----


def test_first_postings_of_each_list(spark):
    links = lambda *n: [f"https://{'x.in/job' if i % 2 else 'youtube.com/watch'}/100000{i}" for i in n]
    df = spark.createDataFrame([(1, links(1, 2, 3, 5, 7)), (2, links(2)), (3, []), (4, links(9)), (4, links(9))], "list int, inside array<string>")
    got = R.first_postings(df, 2)
    assert "LateralJoin" in got._jdf.queryExecution().analyzed().toString()
    assert sorted((r.list, r.link[-1]) for r in got.collect()) == [(1, "1"), (1, "3"), (4, "9"), (4, "9")]


# ---- numbering, evaluation ----


def test_places_are_long(spark):
    assert L.number_rows(keyed(spark, 0, 3).orderBy("job_url")).schema["rank"].dataType.simpleString() == "bigint"


def test_rows_without_or_with_one_address_are_all_evaluated_once(spark, tmp_path):
    marks = str(tmp_path)

    def answer(prompt):
        import tempfile

        tempfile.mkstemp(dir=marks)
        return '{"fit_score": 1}'

    rows = spark.createDataFrame([("u", "A"), ("u", "A"), ("u", "B"), (None, "A"), (None, None)], "job_url string, title string")
    rows = rows.withColumns({c: F.lit("x") for c in ("company", "location", "description")})
    got = P.evaluate(rows, [answer], P.Settings()).collect()
    assert sorted((r.job_url or "", r.title or "", r.verdict_text) for r in got) == [("", "", '{"fit_score": 1}'), ("", "A", '{"fit_score": 1}'), *[("u", "A", '{"fit_score": 1}')] * 2, ("u", "B", '{"fit_score": 1}')]
    assert len(os.listdir(marks)) == 3
