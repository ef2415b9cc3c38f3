"""Keyed evaluation state in batch form: transitions, leases, upserts, breakers and provider health."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import terms
from ..functions.text import is_permanent_error
from .ranged import previous, ranged, runs


def transition_table(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(terms.TRANSITIONS, "from_status string, to_status string")


def target_status(wanted: Column, error: Column) -> Column:
    """A retryable failure with a permanent cause is permanent."""
    return F.when((wanted == "RETRYABLE_ERROR") & is_permanent_error(error), "PERMANENT_ERROR").otherwise(wanted)


def allowed(current: Column, target: Column) -> Column:
    """Whether a transition is allowed: listed, or to the same state, or from QUEUED through EVALUATING to a failure."""
    pairs = F.array(*(F.lit(f"{a}>{b}") for a, b in terms.TRANSITIONS))
    through = (current == "QUEUED") & target.isin("RETRYABLE_ERROR", "PERMANENT_ERROR")
    return (current == target) | through | F.array_contains(pairs, F.concat_ws(">", current, target))


def steps(events: DataFrame, *, key: str, order: list[str], status: str) -> DataFrame:
    """events with from_status: the status before, per key in order (null: none)."""
    return previous(ranged(events, [key], order), [key], F.col(status), "from_status").drop("_at", "_part")


def invalid_steps(events: DataFrame, *, key: str, order: list[str], status: str) -> DataFrame:
    moved = steps(events, key=key, order=order, status=status)
    return moved.where(F.col("from_status").isNotNull() & ~allowed(F.col("from_status"), F.col(status)))


def lease_expired(status: Column, lease: Column, now: Column) -> Column:
    return (status == "EVALUATING") & (lease.isNull() | (now >= lease))


def release_stale(state: DataFrame, now: Column) -> DataFrame:
    """Evaluations whose lease has run out become retryable."""
    stale = lease_expired(F.col("status"), F.col("lease_expires_at"), now)
    return state.withColumns({"last_error": F.when(stale, "lease expired").otherwise(F.col("last_error")), "lease_expires_at": F.when(stale, None).otherwise(F.col("lease_expires_at")), "status": F.when(stale, "RETRYABLE_ERROR").otherwise(F.col("status"))})


def start_attempt(state: DataFrame, now: Column, run_id: Column) -> DataFrame:
    return state.withColumns({
        "attempts": F.coalesce("attempts", F.lit(0)) + 1, "status": F.lit("EVALUATING"), "evaluation_started_at": now, "last_attempt_at": now,
        "lease_expires_at": now + F.make_dt_interval(secs=F.lit(terms.LEASE_SECONDS)), "run_id": run_id,
        "last_error": F.lit(None).cast("string"), "next_retry_at": F.lit(None).cast("timestamp"),
    })


def new_run(state: DataFrame, completed: bool) -> DataFrame:
    """After a completed run, finished rows lose their content key, so that they are evaluated again."""
    if not completed:
        return state
    return state.withColumn("evaluation_key", F.when(F.col("status").isin(*terms.TERMINAL), None).otherwise(F.col("evaluation_key")))


def migrate(legacy: DataFrame, version: int = 2) -> DataFrame:
    """State rows of this version from rows of versions 1 and 2: job_url, status, attempts, last_error.

    Old names of states are mapped, a missing state is QUEUED. Rows of other versions, without a URL or
    with an unknown state are left out. Columns that legacy lacks count as null.
    """
    get = lambda c: F.col(c) if c in legacy.columns else F.lit(None)
    raw = F.upper(F.coalesce(F.nullif(get("status").cast("string"), F.lit("")), F.lit("QUEUED")))
    status = F.coalesce(*(F.when(raw == old, new) for old, new in terms.STATUS_ALIASES.items()), raw)
    known = sorted({s for pair in terms.TRANSITIONS for s in pair})
    number = lambda c: get(c).cast("string").try_cast("int")
    whole = lambda c: F.when(number(c).isNotNull(), F.greatest(F.lit(0), number(c)))
    url = F.trim(F.coalesce(get("job_url").cast("string"), F.lit("")))
    rows = legacy.where(get("version").cast("string").try_cast("int").isin(1, version)).where(url != "").where(status.isin(*known))
    kept = [c for c in legacy.columns if c not in ("job_url", "status", "attempts", "attempt_count", "last_error", "error", "version")]
    error = F.coalesce(F.nullif(get("last_error").cast("string"), F.lit("")), get("error").cast("string"))
    return rows.select(*kept, url.alias("job_url"), status.alias("status"), F.coalesce(whole("attempts"), whole("attempt_count"), F.lit(0)).alias("attempts"), error.alias("last_error"), F.lit(version).alias("version"))


def verdict_status(fresher: Column, decision: Column, score: Column) -> Column:
    """The state that an old verdict amounts to: by its flag, then its decision, then its score."""
    word = F.lower(F.trim(F.coalesce(decision, F.lit(""))))
    yes = F.coalesce(fresher, F.lit(False))
    return (
        F.when((fresher == False) | (word == "reject"), "REJECTED")  # noqa: E712
        .when(word.isin("strong_match", "good_match", "weak_match"), F.when(yes, "PASSED").otherwise("REJECTED"))
        .when(score.isNull(), "EVALUATED")
        .otherwise(F.when((score >= terms.FIT_THRESHOLD) & yes, "PASSED").otherwise("REJECTED"))
    )


def import_legacy(progress: DataFrame, retries: DataFrame) -> DataFrame:
    """One state for each URL of two old files: verdicts (job_url, fresher_appropriate, decision, fit_score,
    attempts) and a retry queue (job_url, attempts, last_error). A waiting retry overrides a verdict."""
    url = F.trim(F.coalesce("job_url", F.lit("")))
    done = progress.where(url != "").select(
        F.col("job_url"), verdict_status(F.col("fresher_appropriate"), F.col("decision"), F.col("fit_score")).alias("status"),
        F.greatest(F.lit(1), F.coalesce("attempts", F.lit(1))).alias("attempts"), F.lit(None).cast("string").alias("last_error"),
    )
    waiting = retries.where(url != "").select(
        url.alias("job_url"), F.lit("RETRYABLE_ERROR").alias("status"), F.greatest(F.lit(0), F.coalesce("attempts", F.lit(0))).alias("attempts"),
        F.coalesce(F.nullif("last_error", F.lit("")), F.lit("legacy_retry_queue")).alias("last_error"),
    )
    return by_priority([done, waiting], "job_url")


def upsert(old: DataFrame, new: DataFrame, key: str, order: list[str]) -> DataFrame:
    """One row per key: the last of new by order, else the old one. Both sides are shuffled once, on the key.

    The last row is found by a grouped max, combined on the map side; a hot key stays one small row.
    """
    own = old.columns
    last = new.groupBy(key).agg(F.max_by(F.struct(*own), F.struct(*order)).alias("_n"))
    joined = old.select(key, F.struct(*own).alias("_o")).join(last, key, "full")
    return joined.select(F.coalesce("_n", "_o").alias("_r")).select("_r.*")


def by_priority(frames: list[DataFrame], key: str) -> DataFrame:
    """One row per key: from the last of the frames that has it."""
    own = frames[0].columns
    both = reduce(lambda a, b: a.unionByName(b), (f.select(*own).withColumn("_p", F.lit(i)) for i, f in enumerate(frames)))
    return both.groupBy(key).agg(F.max_by(F.struct(*own), "_p").alias("_r")).select("_r.*")


def failure_runs(events: DataFrame, *, key: str, order: list[str], failed: Column) -> DataFrame:
    """events with run: how many failures in a row end here (0 on a success)."""
    return runs(ranged(events, [key], order), [key], failed).drop("_at", "_part", "_bad", "_carry")


def breaker_cut(events: DataFrame, *, key: str, order: list[str], failed: Column, limit: int = 3) -> DataFrame:
    """Events up to and with the one that opens the breaker; what comes after is cut."""
    counted = runs(ranged(events, [key], order), [key], failed)
    opened = counted.where(F.col("run") >= limit).groupBy(F.col(key).alias("_key")).agg(F.min("_at").alias("_open"))
    kept = counted.join(opened, counted[key].eqNullSafe(opened["_key"]), "left").where(F.col("_open").isNull() | (F.col("_at") <= F.col("_open")))
    return kept.drop("_at", "_part", "_bad", "_carry", "_key", "_open")


def provider_health(events: DataFrame) -> DataFrame:
    """State and counters of each provider from (ord, provider, kind, latency_seconds, cooldown_seconds, at_seconds).

    kind is REQUEST, SUCCESS or a failure's name. The state follows from the last outcome and the run of
    failures that ends with it. recovery_count: successes that came right after a failure.
    cooldown_until: the latest end of a cooldown (at_seconds, where given, is when an event was). A few
    providers with long histories are no few long tasks: see ranged.
    """
    kind = F.upper("kind")
    at = F.col("at_seconds") if "at_seconds" in events.columns else F.lit(0.0)
    events = events.withColumn("_until", F.when(F.col("cooldown_seconds") > 0, at + F.col("cooldown_seconds")))
    outcomes = runs(ranged(events.where(kind != "REQUEST"), ["provider"], ["ord"]), ["provider"], kind != "SUCCESS")
    outcomes = previous(outcomes, ["provider"], F.col("_bad"), "_was")
    n = lambda name: F.count_if(F.col("_g") == name)
    last = lambda c: F.max_by(c, "_at")
    group = F.coalesce(*(F.when(kind.isin(*names), g) for g, names in terms.OUTCOME_GROUPS.items()), F.lit("OTHER"))
    ended = outcomes.withColumn("_g", group).groupBy("provider").agg(
        n("SUCCESS").alias("successes"), n("TIMEOUT").alias("timeouts"), n("RATE_LIMIT").alias("rate_limits"), n("SERVER").alias("server_errors"),
        n("INVALID").alias("invalid_responses"), n("OTHER").alias("other_errors"), last("run").alias("consecutive_failures"), last("_g").alias("_last"), last(kind).alias("_kind"),
        F.count_if((F.col("_bad") == 0) & (F.col("_was") == 1)).alias("recovery_count"),
        F.sum(F.greatest(F.lit(0.0), F.coalesce("latency_seconds", F.lit(0.0)))).alias("_latency"), F.max(F.when(F.col("_bad") == 1, F.col("_until"))).alias("cooldown_until"),
    )
    asked = events.groupBy("provider").agg(F.count_if(kind == "REQUEST").alias("requests"))
    state = (
        F.when(F.col("_last").isNull() | (F.col("_last") == "SUCCESS"), "AVAILABLE").when(F.col("consecutive_failures") >= 3, "CIRCUIT_OPEN")
        .when(F.col("_last") == "TIMEOUT", "TIMEOUTING").when(F.col("_last") == "RATE_LIMIT", "RATE_LIMITED").otherwise("DEGRADED")
    )
    out = asked.join(ended, "provider", "left")
    zero = {c: F.coalesce(c, F.lit(0)) for c in ("successes", "timeouts", "rate_limits", "server_errors", "invalid_responses", "other_errors", "consecutive_failures", "recovery_count")}
    mean = F.when(F.col("requests") > 0, F.round(F.coalesce("_latency", F.lit(0.0)) / F.col("requests"), 3)).otherwise(0.0)
    return out.withColumn("state", state).withColumns(zero).withColumn("average_latency_seconds", mean).withColumn("last_error", F.when(F.col("_last") != "SUCCESS", F.col("_kind"))).drop("_last", "_kind", "_latency")
