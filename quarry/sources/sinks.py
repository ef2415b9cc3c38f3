"""Sinks: stage snapshots, summaries, versioned tables, append queues, cells and digests."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.metrics import tier_counts, tier_lines
from . import outbox
from .commits import CommitLog, Conflict


def flat_for_csv(df: DataFrame) -> DataFrame:
    """Columns sorted by name; nested values as JSON text."""
    nested = (T.StructType, T.ArrayType, T.MapType, T.VariantType)
    return df.select(*(F.to_json(f.name).alias(f.name) if isinstance(f.dataType, nested) else F.col(f.name) for f in sorted(df.schema.fields, key=lambda f: f.name)))


def export_stage(df: DataFrame, path: str, stage: str, metadata: dict[str, str] | None = None) -> None:
    """A stage's rows as JSON (with the stage's name and metadata) and as CSV with a header."""
    pairs = [x for k, v in (metadata or {}).items() for x in (F.lit(k), F.lit(str(v)))]
    info = F.create_map(*pairs) if pairs else F.create_map().cast("map<string,string>")
    df.withColumns({"_stage": F.lit(stage), "_metadata_map": info}).write.mode("overwrite").json(f"{path}/{stage}/json")
    flat_for_csv(df).write.mode("overwrite").option("header", True).csv(f"{path}/{stage}/csv")


def export_summary(summary: DataFrame, path: str) -> None:
    summary.coalesce(1).write.mode("overwrite").json(path)


def best_effort(action, log=print) -> bool:
    """Run an export; a failure is logged and does not stop the run."""
    try:
        action()
        return True
    except Exception as e:
        log(f"export failed: {e}")
        return False


def versions(spark: SparkSession, root: str) -> list[tuple[int, str]]:
    """(number, version) of a table's committed versions, oldest first."""
    log = CommitLog(spark, root)
    return [(n, log.read(n)["version"]) for n in log.numbers()]


def publish(df: DataFrame, root: str, keep: int = 3, base: int | None = None) -> str:
    """Write a new version of a table and commit it: readers see the old or the new one, never half or none.

    The commit is one new file with the next number, which only one writer can create; nothing is renamed,
    replaced or deleted before. base is the number that df was made from: if another version has been
    committed since, this one is taken back and Conflict raised, so that no one's rows are lost unseen.
    Without base, df stands for itself and becomes the newest version whatever came between. Versions
    before the last keep are removed.
    """
    spark, version = df.sparkSession, uuid.uuid4().hex
    df.write.parquet(f"{root}/v-{version}")
    log = CommitLog(spark, root)
    while True:
        last = max(log.numbers(), default=0)
        if (base is None or base == last) and log.commit(last + 1, {"version": version}):
            break
        if base is not None:
            log.remove(f"v-{version}")
            raise Conflict(f"{root}: made from version {base}, but the newest is {max(log.numbers(), default=0)}")
    for n, old in versions(spark, root):
        if n <= last + 1 - keep:
            log.remove(f"commit-{n:012d}", f"v-{old}")
    return f"{root}/v-{version}"


def current(spark: SparkSession, root: str) -> DataFrame | None:
    """The published version of a table, or None."""
    body = CommitLog(spark, root).latest()[1]
    return spark.read.parquet(f"{root}/v-{body['version']}") if body else None


def current_number(spark: SparkSession, root: str) -> int:
    """What publish() takes as base; read it before current(), so that a version between the two is noticed."""
    return max(CommitLog(spark, root).numbers(), default=0)


def cell(c: Column, kind: T.DataType) -> Column:
    """A sheet cell: null "", booleans in words, lists joined by "; ", other nested values as compact JSON."""
    if isinstance(kind, T.ArrayType) and isinstance(kind.elementType, T.StringType):
        out = F.array_join(c, "; ")
    elif isinstance(kind, (T.ArrayType, T.StructType, T.MapType)):
        out = F.to_json(c)
    else:
        out = c.cast("string")
    return F.coalesce(out, F.lit(""))


def as_cells(df: DataFrame) -> DataFrame:
    return df.select(*(cell(F.col(f.name), f.dataType).alias(f.name) for f in df.schema.fields))


def sheet_rows(df: DataFrame, details: Column, now: Column) -> DataFrame:
    """Link, Company, Fit Score, Walk-in Details, Date Added, Recruiter Email."""
    return df.select(F.col("job_url").alias("Link"), F.col("company").alias("Company"), F.col("fit_score").alias("Fit Score"), details.alias("Walk-in Details"), F.date_format(now, "yyyy-MM-dd HH:mm").alias("Date Added"), F.coalesce("recruiter_email", F.lit("")).alias("Recruiter Email"))


def only_scalars(df: DataFrame) -> DataFrame:
    bad = [f.name for f in df.schema.fields if isinstance(f.dataType, (T.ArrayType, T.StructType, T.MapType))]
    if bad:
        raise TypeError(f"not scalar: {', '.join(bad)}")
    return df


def append_with_queue(df: DataFrame, pending: str, send) -> bool:
    """Queue new rows in the outbox at pending, then hand all that wait to send at once, oldest batch first; if sending fails everything waits for the next call."""
    outbox.put(only_scalars(df), pending)
    try:
        outbox.drain(df.sparkSession, pending, df.schema, send)
    except Exception:
        return False
    outbox.clear(pending)
    return True


def digest_text(df: DataFrame, counts: DataFrame) -> str:
    """The daily digest: counts by source, then the shown tiers, whose lines are streamed in order, not gathered first."""
    lines = [f"{r.source}: {r.n}" for r in counts.orderBy(F.desc("n"), "source").toLocalIterator()]
    tiers = {r.tier: r for r in tier_counts(df).orderBy("tier_rank").collect()}
    head = f"{sum(r.n for r in tiers.values())} matches, {sum(r.contacts for r in tiers.values())} with a contact"
    body: dict[str, list[str]] = {t: [f"== {t} ({r.n}) =="] for t, r in tiers.items()}
    for r in tier_lines(df).toLocalIterator():
        body[r.tier].append(r.line)
    return "\n\n".join([head, "\n".join(lines), *("\n".join(x) for x in body.values())])


def send_digest(body: str, matches: int, day: str, send) -> None:
    """Hand a digest to a mail transport: send(subject, body). Which one is the caller's choice."""
    send(f"{matches} matches - {day}", body)
