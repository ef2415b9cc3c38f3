"""Aggregates, health, run metrics and digests."""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F

from ..functions.text import error_class
from ..session import ship
from .ranged import ranged, running_sum


def breakdown(df: DataFrame, by: str = "source") -> DataFrame:
    return df.groupBy(by).agg(F.count("*").alias("n"))


def shares(df: DataFrame, by: str = "source") -> DataFrame:
    """Rows per group and their percentage of all, rounded to 2 places (half even). The total is one row, joined to each group."""
    n = breakdown(df, by)
    total = n.agg(F.sum("n").alias("_total"))
    share = F.coalesce(F.bround(F.col("n") * 100.0 / F.nullif("_total", F.lit(0)), 2), F.lit(0.0))
    return n.crossJoin(total).select(by, "n", share.alias("share"))


def duplicate_summary(df: DataFrame, key: str) -> DataFrame:
    """One row: rows, distinct keys, duplicates."""
    per_key = df.groupBy(key).agg(F.count("*").alias("c"))
    return per_key.agg(F.coalesce(F.sum("c"), F.lit(0)).alias("total"), F.count(F.col(key)).alias("distinct_keys")).withColumn("duplicates", F.greatest(F.lit(0), F.col("total") - F.col("distinct_keys")))


def mean_and_p95(df: DataFrame, value: str, by: list[str]) -> DataFrame:
    """Per group: n, mean and the exact 95th percentile at index round_half_even(0.95 * (n - 1)), each to 3 places.

    Exact without gathering a group: distinct values are counted (combined on the map side) and sorted
    into ranges, and the running count over ranges, not a list, finds the index.
    """
    counts = df.where(F.col(value).isNotNull()).groupBy(*by, F.col(value).alias("_v")).agg(F.count("*").alias("_c"))
    ranked = running_sum(ranged(counts, by, ["_v"]), by, "_c", "_upto")
    all_ = counts.groupBy(*by).agg(F.sum("_c").alias("n"), F.sum(F.col("_v") * F.col("_c")).alias("_s"))
    joined = ranked.join(all_, by)
    hit = F.col("_upto") > F.bround(0.95 * (F.col("n") - 1), 0)
    out = joined.groupBy(*by, "n", "_s").agg(F.min(F.when(hit, F.col("_v"))).alias("p95"))
    return out.select(*by, "n", F.bround(F.col("_s") / F.col("n"), 3).alias("mean"), F.bround("p95", 3).alias("p95"))


def status_counters(df: DataFrame, status: str, groups: dict[str, list[str]], by: list[str] | None = None) -> DataFrame:
    """Rows whose status is in each named list, in one pass."""
    return df.groupBy(*(by or [])).agg(*(F.count_if(F.col(status).isin(*values)).alias(name) for name, values in groups.items()))


def counted_write(df: DataFrame, path: str, counters: dict[str, Column]) -> dict[str, int]:
    """Write df as Parquet and return its counters (aggregates by name), which come with the write: no second pass over df."""
    seen = Observation()
    df.observe(seen, *(c.alias(name) for name, c in counters.items())).write.parquet(path)
    return seen.get


def status_counts(status: Column, groups: dict[str, list[str]]) -> dict[str, Column]:
    """Counters of rows whose status is in each named list, for counted_write() or observe()."""
    return {"total": F.count("*")} | {name: F.count_if(status.isin(*values)) for name, values in groups.items()}


def set_hash(df: DataFrame, key: str, by: str) -> DataFrame:
    """sha256 of a group's sorted non-empty keys (with repeats) joined by newlines: independent of order.

    A digest over all keys in order is sequential by nature: a group's keys are sorted (spilling as
    needed) and streamed through it, so a group of any size takes time but no memory.
    """
    ship(df.sparkSession)

    def digest(batches):
        now, state, first = None, None, True
        out: list[tuple] = []
        for batch in batches:
            for group, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if first or group != now:
                    if not first:
                        out.append((now, state.hexdigest()))
                    now, state, first = group, hashlib.sha256(text.encode()), False
                else:
                    state.update(b"\n" + text.encode())
        if not first:
            out.append((now, state.hexdigest()))
        yield pa.RecordBatch.from_arrays([pa.array([g for g, _ in out], batch_type), pa.array([h for _, h in out], pa.string())], [by, "hash"])

    from pyspark.sql.pandas.types import to_arrow_type

    field = df.schema[by]
    batch_type = to_arrow_type(field.dataType)
    some = df.where(F.col(key).isNotNull() & (F.col(key) != "")).select(by, key)
    rows = some.repartition(by).sortWithinPartitions(by, key)
    return rows.mapInArrow(digest, f"`{by}` {field.dataType.simpleString()}, hash string")


def pattern_counts(lines: DataFrame, line: str, patterns: dict[str, str]) -> DataFrame:
    """pattern, n: lines that contain each pattern; a line may count for several."""
    named = F.array(*(F.when(F.col(line).contains(p), F.lit(name)) for name, p in patterns.items()))
    hits = lines.select(F.explode(F.filter(named, lambda x: x.isNotNull())).alias("pattern"))
    return hits.groupBy("pattern").agg(F.count("*").alias("n"))


def source_status(error: Column, kind: Column, rows: Column) -> Column:
    """Outcome of a source's fetch from its failure, if any, and its number of rows."""
    cls = error_class(error, kind)
    failed = error.isNotNull() | kind.isNotNull()
    return (
        F.when(failed & cls.isin("NOT_CONFIGURED", "DISABLED"), cls)
        .when(failed & (cls == "HTTP_429"), "RATE_LIMITED")
        .when(failed & cls.isin("HTTP_403", "BLOCKED"), "BLOCKED")
        .when(failed & (cls == "TIMEOUT"), "TIMEOUT")
        .when(failed & (rows > 0), "DEGRADED")
        .when(failed, "FAILED")
        .when(rows == 0, "NO_RESULTS")
        .otherwise("SUCCESS")
    )


def finish_health(df: DataFrame) -> DataFrame:
    """status, error_classification and duration of sources from enabled, errors, jobs_found and their times."""
    bad = F.size("errors") > 0
    status = F.when(~F.col("enabled"), "DISABLED").when(bad & (F.col("jobs_found") == 0), "FAILED").when(bad, "DEGRADED").otherwise("HEALTHY")
    empty = F.col("enabled") & ~bad & (F.col("jobs_found") == 0)
    seconds = F.greatest(F.lit(0.0), (F.unix_micros("finished_at") - F.unix_micros(F.coalesce("started_at", "finished_at"))) / 1e6)
    return df.withColumns({"status": status, "error_classification": F.when(empty, "NO_RESULTS").otherwise(F.col("error_classification")), "duration_seconds": seconds})


def search_summary(listings: DataFrame, health: DataFrame, raw_rows: int) -> DataFrame:
    """One nested row: totals, sources by health, breakdown and percentages."""
    on = F.col("enabled")
    sources = health.agg(
        F.count_if(on).alias("sources_enabled"), F.count_if(on & F.col("status").isin("HEALTHY", "SUCCESS")).alias("sources_healthy"),
        F.count_if(on & (F.col("status") == "DEGRADED")).alias("sources_degraded"), F.count_if(on & (F.col("status") == "FAILED")).alias("sources_failed"),
        F.count_if(on & (F.col("jobs_found") == 0)).alias("sources_zero_results"),
        F.map_from_entries(F.collect_list(F.struct("name", F.struct("status", "jobs_found", "duration_seconds", "error_classification")))).alias("sources"),
    )
    per = shares(listings)
    totals = per.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("total_unique_jobs"), F.map_from_entries(F.collect_list(F.struct("source", "n"))).alias("source_breakdown"),
        F.map_from_entries(F.collect_list(F.struct("source", "share"))).alias("source_percentage"),
    )
    one = lambda d: d.withColumn("_one", F.lit(1))
    out = one(totals).join(one(sources), "_one").drop("_one")
    return out.withColumn("total_raw_jobs", F.lit(raw_rows)).withColumn("duplicate_count", F.greatest(F.lit(0), F.lit(raw_rows) - F.col("total_unique_jobs")))


def seed_status(anti_bot: Column, ok: Column, candidates: Column, rows: Column) -> Column:
    return F.when(anti_bot, "BLOCKED").when(~ok, "FAILED").when(candidates == 0, "NO_CANDIDATES").when(rows == 0, "CANDIDATES_NOT_VALIDATED").otherwise("SUCCESS")


def discovery_totals(seeds: DataFrame) -> DataFrame:
    """One row of totals, with problem: what the run as a whole should fail with, or null."""
    n = lambda c: F.coalesce(F.sum(F.col(c).cast("int")), F.lit(0))
    out = seeds.agg(F.count("*").alias("seeds_attempted"), n("ok").alias("seeds_succeeded"), n("pages").alias("pages_seen"), n("rows").alias("jobs_discovered"), n("candidates").alias("candidate_urls_found"), n("anti_bot").alias("anti_bot_seeds"))
    problem = F.when((F.col("seeds_attempted") > 0) & (F.col("seeds_succeeded") == 0), "every seed failed").when((F.col("seeds_succeeded") > 0) & (F.col("candidate_urls_found") == 0), F.when(F.col("anti_bot_seeds") > 0, "no candidates: anti-bot pages").otherwise("no candidates"))
    return out.withColumn("seed_failures", F.col("seeds_attempted") - F.col("seeds_succeeded")).withColumn("problem", problem)


def tier_counts(df: DataFrame, tiers: tuple[str, ...] = ("Exceptional", "Strong", "Good")) -> DataFrame:
    """tier_rank, tier, n and contacts of the shown tiers; listings of other tiers are in none."""
    rank = F.array_position(F.array(*(F.lit(t) for t in tiers)), F.col("fit_tier"))
    shown = df.where(F.col("fit_tier").isin(*tiers)).groupBy(rank.alias("tier_rank"), F.col("fit_tier").alias("tier"))
    return shown.agg(F.count("*").alias("n"), F.count_if(F.coalesce(F.col("recruiter_email"), F.lit("")) != "").alias("contacts"))


def tier_lines(df: DataFrame, tiers: tuple[str, ...] = ("Exceptional", "Strong", "Good")) -> DataFrame:
    """tier_rank, tier and line of the shown listings, sorted by tier, score and arrival: rows, not one list for each tier."""
    rank = F.array_position(F.array(*(F.lit(t) for t in tiers)), F.col("fit_tier"))
    line = F.format_string("%d - %s at %s (%s)", F.col("fit_score"), F.col("title"), F.col("company"), F.col("job_url"))
    rows = df.where(F.col("fit_tier").isin(*tiers)).select(rank.alias("tier_rank"), F.col("fit_tier").alias("tier"), line.alias("line"), "fit_score", "arrival_ord")
    return rows.orderBy("tier_rank", F.desc("fit_score"), "arrival_ord").drop("fit_score", "arrival_ord")
