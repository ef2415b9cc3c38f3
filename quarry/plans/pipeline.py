"""The daily listing run as a chain of lazy stages, and row-wise evaluation with a pluggable evaluator."""

from __future__ import annotations

import json
import time
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import pandas as pd
from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from .. import terms
from ..functions import score as S
from ..functions.jsonx import parse_object
from ..operators import listings as L
from ..operators import metrics as M
from ..operators import state as ST
from ..session import materialise, ship
from ..sources.providers import Chain

VERDICT = (
    "fit_score INT, is_fresher_appropriate BOOLEAN, reason STRING, hit_rate_limit BOOLEAN, role_match INT, experience_match INT, technical_match INT, "
    "project_match INT, education_match INT, location_match INT, company_quality INT, is_walkin BOOLEAN, walkin_date STRING, walkin_end_date STRING, "
    "venue STRING, decision STRING, why ARRAY<STRING>, gaps ARRAY<STRING>"
)
#: prompt -> answer text. Raises to signal a failure; the message says what kind.
Evaluator = Callable[[str], str]


@dataclass(frozen=True)
class Settings:
    budget_seconds: float = 2700.0
    concurrency: int = 4
    safety: float = 0.75
    most: int = terms.MAX_CANDIDATES
    least_per_source: int = terms.MIN_PER_SOURCE
    threshold: int = terms.MIN_SCORE
    fresher_only: bool = True
    profile: str = ""
    attempts: int = 3
    #: Seconds since the epoch after which no evaluator is asked any more.
    deadline: float | None = None
    extra: dict = field(default_factory=dict)

    def __post_init__(self) -> None:
        bad = [k for k in ("budget_seconds", "concurrency", "most", "attempts") if getattr(self, k) <= 0]
        if bad or not 0 <= self.least_per_source <= self.most:
            raise ValueError(f"settings out of range: {', '.join(bad) or 'least_per_source'}")


def prompt(profile: str) -> Column:
    """What an evaluator is asked about a listing; the description is cut at 10,000 characters."""
    part = lambda c, n=10_000: F.substring(F.coalesce(F.col(c), F.lit("")), 1, n)
    return F.concat_ws("\n", F.lit("Rate this listing for the candidate. Answer with one JSON object."), F.lit(f"PROFILE: {profile}"), F.concat(F.lit("TITLE: "), part("title")), F.concat(F.lit("COMPANY: "), part("company")), F.concat(F.lit("LOCATION: "), part("location")), F.concat(F.lit("DESCRIPTION: "), part("description")))


def evaluate(df: DataFrame, evaluators: list[Evaluator] | Chain, settings: Settings) -> DataFrame:
    """df with verdict_text, error and tries: each prompt goes to the evaluators in turn until one answers with an object.

    evaluators: functions from prompt to answer text, or a Chain of providers, which has its own retries.
    After the deadline nothing is asked and the error is deadline_exceeded. Rows whose prompts are equal
    are asked about once and share the answer; every row of df comes back, whatever its address.

    Runs where the data is, in so many tasks as concurrency says. A retried task asks again, so
    evaluators must be idempotent; the content key of a row says whether it was asked before.
    """
    ship(df.sparkSession)
    tries, deadline = settings.attempts, settings.deadline

    def ask_chain(text: str) -> tuple[str | None, str | None, int]:
        left = None if deadline is None else evaluators.clock.now() + deadline - time.time()
        found, error = evaluators.evaluate(text, left)
        return (None if found is None else json.dumps(found)), error, 1

    def ask(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for text in batch["_prompt"]:
                if deadline is not None and time.time() >= deadline:
                    out.append((None, "deadline_exceeded", 0))
                    continue
                if isinstance(evaluators, Chain):
                    out.append(ask_chain(text))
                    continue
                answer, error, n = None, "no evaluator", 0
                for call in evaluators:
                    for _ in range(tries):
                        n += 1
                        try:
                            found = parse_object(call(text))
                        except Exception as e:
                            error = f"{type(e).__name__}: {e}"
                            if "rate" in error.lower():
                                break  # the next evaluator, not the same one again
                            continue
                        if found is not None:
                            answer, error = json.dumps(found), None
                            break
                        error = "invalid_response"
                    if answer is not None:
                        break
                out.append((answer, error, n))
            extra = pd.DataFrame(out, columns=["verdict_text", "error", "tries"], index=batch.index)
            yield pd.concat([batch.drop(columns=["_prompt"]), extra], axis=1)

    # rows are known by what is asked about them, not by their address, which may be missing or come twice
    df = df.withColumn("_asked", F.sha2(prompt(settings.profile), 256))
    asked = df.groupBy("_asked").agg(F.first(prompt(settings.profile)).alias("_prompt")).repartition(settings.concurrency, "_asked")
    answers = materialise(asked.mapInPandas(ask, "_asked string, verdict_text string, error string, tries int"), "answers")
    return df.join(answers, "_asked").drop("_asked")


def verdict_struct(text: Column) -> Column:
    """Typed verdict of an answer: numbers in text count, texts become lists, missing parts are 0, false or empty."""
    raw = F.try_parse_json(text)
    get = lambda k, t="string": F.try_variant_get(raw, f"$.{k}", t)
    whole = lambda k: S.as_int(get(k)).alias(k)
    flag = lambda k: S.as_bool(get(k)).alias(k)
    many = lambda k: F.coalesce(get(k, "array<string>"), F.when(F.trim(get(k)) != "", F.array(F.trim(get(k)))), F.array().cast("array<string>"))
    why = many("why")
    reason = F.coalesce(F.nullif(F.trim(get("reason")), F.lit("")), F.array_join(why, "; "))
    text_of = lambda k: F.coalesce(get(k), F.lit("")).alias(k)
    return F.struct(
        whole("fit_score"), flag("is_fresher_appropriate"), reason.alias("reason"), F.lit(False).alias("hit_rate_limit"),
        *(whole(c) for c in terms.COMPONENT_CAPS), flag("is_walkin"), text_of("walkin_date"), text_of("walkin_end_date"), text_of("venue"), text_of("decision"),
        why.alias("why"), many("gaps").alias("gaps"),
    )


def review(candidates: DataFrame, state: DataFrame, evaluators: list[Evaluator] | Chain, settings: Settings, as_of: Column, now: Column) -> tuple[DataFrame, DataFrame]:
    """(reviewed listings, new state rows): finished rows are resumed by content key, the others evaluated."""
    keyed = candidates.withColumn("evaluation_key", S.stable_hash(F.col("job_url"), F.col("description"), F.lit(settings.profile), F.lit("2")))
    routed = materialise(L.route(keyed, ST.release_stale(state, now), most_new=settings.most), "routed")
    asked = evaluate(routed.where(F.col("route").isin("retry", "new")), evaluators, settings)
    asked = asked.withColumn("verdict", F.when(F.col("verdict_text").isNotNull(), verdict_struct(F.col("verdict_text"))))
    resumed = routed.where("route = 'resumed'").withColumn("verdict", F.col("stored_verdict"))
    judged = L.apply_verdict(asked.where("verdict IS NOT NULL").unionByName(resumed, allowMissingColumns=True), as_of)
    judged = materialise(judged.withColumn("status", F.when(F.col("passed"), "PASSED").otherwise("REJECTED")), "judged")
    late = F.col("error") == "deadline_exceeded"
    failed = asked.where("verdict IS NULL").withColumn("status", F.when(late, "DEADLINE_EXCEEDED").otherwise(ST.target_status(F.lit("RETRYABLE_ERROR"), F.col("error"))))
    rows = lambda d, verdict, error: d.select("job_url", "status", F.coalesce("tries", F.lit(0)).alias("attempts"), "evaluation_key", verdict.alias("verdict"), error.alias("last_error"), F.lit(None).cast("timestamp").alias("lease_expires_at"), now.alias("updated_at"))
    none = F.lit(None).cast(judged.schema["verdict"].dataType)
    return judged, rows(judged, F.col("verdict"), F.lit(None).cast("string")).unionByName(rows(failed, none, F.col("error")))


@dataclass(frozen=True)
class Run:
    unique: DataFrame
    shortlist: DataFrame
    admitted: DataFrame
    deferred: DataFrame
    reviewed: DataFrame
    final: DataFrame
    state: DataFrame
    shares: DataFrame
    #: Rows that came in, different addresses, and verdicts by outcome; counted as they were written.
    counts: dict[str, int] = field(default_factory=dict)


def run(raw: DataFrame, seen: DataFrame, deferred: DataFrame, state: DataFrame, evaluators: list[Evaluator] | Chain, *, as_of: Column, now: Column, settings: Settings = Settings(), crawled: DataFrame | None = None, history: tuple[int, int, float, float] = (0, 0, 0.0, 0.0)) -> Run:
    """raw listings to ranked passes: dedupe, enrich, score, select fairly, drop the seen, admit, review, rank.

    history: attempted, unresolved, mean and p95 latency of the run before, for the admission limit.
    """
    ship(raw.sparkSession)
    seen_raw, seen_unique, judged = Observation(), Observation(), Observation()
    unique = L.dedupe_by_url(L.normalise_rows(raw.observe(seen_raw, F.count("*").alias("raw"))))
    if crawled is not None:
        unique = L.enrich_descriptions(unique, crawled)
    unique = materialise(unique.observe(seen_unique, F.count("*").alias("unique")), "unique")
    scored = S.prefilter_score(unique, as_of, fresher_only=settings.fresher_only)
    short = materialise(L.fair_top_k(scored, score="prefilter_score", group="source", order="arrival_ord", most=settings.most, least=settings.least_per_source, threshold=settings.threshold), "shortlist")
    queue = L.deferred_first(deferred, L.unseen(short, seen))
    limit = raw.sparkSession.range(1).select(S.admission_limit(F.lit(settings.budget_seconds), F.lit(history[0]), F.lit(history[1]), F.lit(history[2]), F.lit(history[3]), settings.concurrency, settings.safety, 1, settings.most).alias("n")).first().n
    admitted, later = L.split_admitted(materialise(queue, "queue"), limit, ["phase", "arrival_ord"])
    reviewed, rows = review(admitted, state, evaluators, settings, as_of, now)
    rows = materialise(rows.observe(judged, *(c.alias(n) for n, c in M.status_counts(F.col("status"), {"passed": ["PASSED"], "rejected": ["REJECTED"], "unfinished": terms.RESUMABLE}).items() if n != "total")), "rows")
    passed = L.unseen(L.first_wins(reviewed.where("passed"), "job_url", ["arrival_ord"]), seen)
    final = L.final_rank(L.enrich_contacts(passed))
    return Run(unique, short, admitted, later, reviewed, final, ST.upsert(state.select(*rows.columns), rows, "job_url", ["updated_at"]), M.shares(unique), seen_raw.get | seen_unique.get | judged.get)
