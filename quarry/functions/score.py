"""Scores, gates, tiers, limits and hashes: Column -> Column."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import terms
from .dates import age_days, iso_date, walkin_dates
from .matching import Wanted, term_counts
from .text import any_term, count_hits, first_email


#: Any statement of years holds one of these, so only texts that do are searched for one.
_YEAR_WORDS = ["year", "yr"]


def experience(text: Column) -> Column:
    """STRUCT<min_years, max_years, required, preferred, graduate_friendly, eligible, reason> of a description."""
    low = F.lower(F.coalesce(text, F.lit("")))
    found = term_counts([low], {"senior": Wanted(terms.SENIOR), "graduate": Wanted(terms.GRADUATE), "years": Wanted(_YEAR_WORDS)})
    return _experience(low, found.getField)


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """body of a value that is worked out once: conditions would work it out again at each use."""
    return F.transform(F.array(value), body).getItem(0)


def _experience(low: Column, found: Callable[[str], Column]) -> Column:
    """experience() of a lower-case text, of which found gives the counts of senior and graduate terms and of words for years."""
    counts = [found(x).alias(x) for x in ("senior", "graduate")]
    number = lambda t: F.coalesce(F.regexp_extract(t, terms.YEARS_PATTERN + r"\s*(?:of\s*experience)?\b", 1).try_cast("int"), F.lit(0))
    # only texts with a word for years are searched for a statement of them
    dated = _let(F.struct(F.when(found("years") > 0, low).alias("low"), *counts), lambda x: F.struct(x["low"].alias("low"), F.coalesce(number(x["low"]), F.lit(0)).alias("years"), x["senior"].alias("senior"), x["graduate"].alias("graduate")))

    def judged(x: Column) -> Column:
        years, graduate, preferred = x["years"], x["graduate"] > 0, x["preferred"]
        required = (years > 0) & ~preferred
        senior = (x["senior"] >= 2) & ~graduate
        too_long = required & (years > 1) & ~graduate
        reason = F.when(senior, "Role appears too senior based on title/description keywords.").when(too_long, F.concat(F.lit("Mandatory experience ("), years.cast("string"), F.lit("+ years) exceeds 1 year and no fresher signal found."))).otherwise("")
        return F.struct(years.alias("min_years"), F.lit(0).alias("max_years"), required.alias("required"), preferred.alias("preferred"), graduate.alias("graduate_friendly"), (~(senior | too_long)).alias("eligible"), reason.alias("reason"))

    preferred = lambda x: (x["years"] > 0) & F.coalesce(x["low"].rlike(terms.YEARS_PATTERN + terms.YEARS_PREFERRED), F.lit(False))
    known = _let(dated, lambda x: F.struct(x["years"].alias("years"), preferred(x).alias("preferred"), x["senior"].alias("senior"), x["graduate"].alias("graduate")))
    return _let(known, judged)


def _gate(score: Column, reject: Column) -> Column:
    return F.struct(score.cast("int").alias("score"), reject.alias("reject"))


def location_gate(location: Column) -> Column:
    """STRUCT<score, reject>: 2 and one for each preferred place up to 5; remote 5; elsewhere abroad: reject; else 1."""
    low = F.lower(F.coalesce(location, F.lit("")))
    hits = count_hits(low, terms.PREFERRED_LOCATIONS)
    remote, outside = any_term(low, ["remote", "work from home", "wfh"]), any_term(low, terms.OUTSIDE_LOCATIONS)
    return _gate(F.when(hits > 0, F.least(F.lit(5), 2 + hits)).when(remote, 5).when(outside, 0).otherwise(1), (hits == 0) & ~remote & outside)


def education_gate(text: Column) -> Column:
    low = F.lower(F.coalesce(text, F.lit("")))
    return _education(low, any_term(low, terms.EDUCATION_OPEN))


def _education(low: Column, open_to_all: Column) -> Column:
    # the pattern ends in "only" or starts with "strictly": a plain search rules out most texts
    only = (low.contains(" only") | low.contains("strictly ")) & low.rlike(terms.CS_ONLY_PATTERN)
    return _gate(F.when(only, 0).when(open_to_all, 4).otherwise(2), only)


def freshness_gate(posted: Column, as_of: Column, most: int = terms.FRESHNESS_DAYS) -> Column:
    """STRUCT<score, reject> by age of a posting date (DATE; null: unknown, 0)."""
    age = age_days(posted, as_of)
    score = F.when(age.isNull(), 0).when(age < 0, 1).when(age <= 3, 4).when(age <= 7, 2).when(age <= most, 0).otherwise(-3)
    return _gate(score, F.coalesce(age > most, F.lit(False)))


#: What prefilter_score counts, in title (0), description (1), company (2) and location (3).
_PREFILTER = {
    "senior_t": Wanted(terms.SENIOR), "senior": Wanted(terms.SENIOR, 1, 1), "graduate": Wanted(terms.GRADUATE, 1, 1), "years": Wanted(_YEAR_WORDS, 1, 1),
    "title_roles": Wanted(terms.ROLES, words=True), "roles": Wanted(terms.ROLES, 1, 1, words=True), "education": Wanted(terms.EDUCATION_OPEN, 0, 1),
    "tech": Wanted(terms.CORE_TECH, 0, 3), "profile": Wanted(terms.PROFILE, 0, 3), "infra": Wanted(terms.INFRASTRUCTURE, 0, 3), "fresher": Wanted(terms.FRESHER, 0, 3),
    "walkin": Wanted(terms.WALKIN_POSITIVE, 0, 3), "other": Wanted(terms.WALKIN_NEGATIVE, 0, 3), "near": Wanted(terms.NEIGHBOURHOODS, 0, 3),
}


def prefilter_score(df: DataFrame, as_of: Column, *, fresher_only: bool = True, name: str = "prefilter_score") -> DataFrame:
    """df with a relevance score from its title, description, company, location and posting_date; 0 for any failed gate.

    Texts are read once for the terms of all lists. Only rows that announce a walk-in go through the date
    search; everything else is generated code.
    """
    low = lambda c: F.lower(F.coalesce(F.col(c), F.lit("")))
    texts = df.withColumns({"_t": low("title"), "_d": low("description")})
    found = texts.withColumn("_n", term_counts([F.col("_t"), F.col("_d"), low("company"), low("location")], _PREFILTER))
    n = lambda x: F.col(f"_n.{x}")
    posted = iso_date(F.trim(F.coalesce(F.col("posting_date"), F.lit(""))))
    facts = found.withColumn("_f", F.struct(
        (2 * n("senior_t") + n("senior")).alias("senior"), _experience(F.col("_d"), n).getField("eligible").alias("eligible"),
        *(n(x).alias(x) for x in ("title_roles", "roles", "tech", "profile", "infra", "fresher")),
        location_gate(F.col("location")).alias("location"), _education(F.concat_ws(" ", "_t", "_d"), n("education") > 0).alias("education"), freshness_gate(posted, as_of).alias("fresh"),
        ((n("walkin") > 0) & (n("other") == 0)).alias("walkin"), (n("near") > 0).alias("near"), (first_email(F.col("description")) != "").alias("email"),
    )).drop("_t", "_d", "_n")
    f = lambda x: F.col(f"_f.{x}")
    # only announced walk-ins reach the Python worker with a text
    dates = walkin_dates(F.when(f("walkin"), F.col("description")), as_of)
    strong = (f("title_roles") > 0) | ((f("roles") > 0) & (f("tech") > 0))
    rejected = [
        f("senior") >= 2, ~f("eligible"), (f("title_roles") == 0) & (f("roles") == 0), f("location.reject"), f("education.reject"), f("fresh.reject"),
        f("walkin") & F.coalesce(dates.getField("end") < as_of, F.lit(False)), F.lit(fresher_only) & (f("fresher") == 0),
    ]
    cap = lambda x, most: F.least(f(x), F.lit(most))
    points = (
        5 * cap("title_roles", 3) + cap("roles", 3) + 2 * cap("tech", 6) + cap("profile", 8) + cap("infra", 2) + 4 * cap("fresher", 2)
        + f("location.score") + f("education.score") + f("fresh.score")
        + F.when(f("walkin") & strong, 15 + F.when(f("near"), 35).otherwise(0)).otherwise(0) + f("email").cast("int") - f("senior")
    )
    score = F.when(reduce(lambda a, b: a | b, rejected), 0).otherwise(F.greatest(F.lit(0), points)).cast("int")
    return facts.withColumn(name, score).drop("_f")


def tier(score: Column) -> Column:
    return F.when(score >= 90, "Exceptional").when(score >= 80, "Strong").when(score >= 70, "Good").when(score >= 60, "Reasonable").otherwise("Weak")


def clamp(x: Column, most: int) -> Column:
    return F.greatest(F.lit(0), F.least(F.coalesce(x, F.lit(0)), F.lit(most)))


def fit_score(caps: dict[str, int] = terms.COMPONENT_CAPS) -> Column:
    """Sum of the clamped components; a total that the model gives is not used."""
    return reduce(lambda a, b: a + b, (clamp(F.col(c), most) for c, most in caps.items()))


def admission_limit(budget: Column, attempted: Column, unresolved: Column, mean: Column, p95: Column, concurrency: int = 4, safety: float = 0.75, least: int = 1, most: int = 300) -> Column:
    """How many candidates a run can take in its time budget, by measured latency and reliability."""
    latency = F.greatest(F.coalesce(mean, F.lit(0.0)), 0.75 * F.coalesce(p95, F.lit(0.0)), F.lit(90.0))
    failed = F.when(attempted > 0, unresolved / attempted).otherwise(0.0)
    reliability = F.greatest(F.lit(0.5), 1 - F.least(F.lit(0.5), 0.5 * failed))
    effective = budget * F.lit(min(0.95, max(0.35, safety))) * reliability
    return F.greatest(F.lit(least), F.least(F.lit(most), F.floor(effective / latency * concurrency))).cast("int")


def stable_hash(*parts: Column) -> Column:
    """sha256 of the parts joined by newlines; null parts count as empty."""
    return F.sha2(F.concat_ws("\n", *(F.coalesce(p.cast("string"), F.lit("")) for p in parts)), 256)


def same_identity(fields: list[str], a: str, b: str) -> Column:
    return reduce(lambda x, y: x & y, (F.col(f"{a}.{f}").eqNullSafe(F.col(f"{b}.{f}")) for f in fields))


def as_int(x: Column, default: int = 0) -> Column:
    """Whole-number text to INT, anything else to the default."""
    return F.coalesce(F.when(F.trim(x).rlike(r"^[+-]?\d+$"), x.try_cast("int")), F.lit(default))


def as_bool(x: Column, default: bool = False) -> Column:
    low = F.lower(F.trim(x))
    return F.when(low.isin("true", "yes", "1"), True).when(low.isin("false", "no", "0"), False).otherwise(F.lit(default))


def backoff_seconds(attempt: Column, first: int = 15, most: int = 60) -> Column:
    return F.least(F.lit(most), first * F.pow(F.lit(2), attempt)).cast("int")
