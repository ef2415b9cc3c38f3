"""Relational operators on listings: dedupe, fair selection, routing, admission, enrichment, ranking."""

from __future__ import annotations

from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .. import terms
from ..functions import score as S
from ..functions.dates import walkin_dates, walkin_status
from ..functions.url import norm_url_loose
from ..session import materialise


def clean_text(c: Column, default: str = "") -> Column:
    return F.coalesce(F.nullif(F.trim(c), F.lit("")), F.lit(default))


def clean_list(c: Column) -> Column:
    """Non-blank items of an array joined by ", "."""
    return F.array_join(F.filter(F.transform(c, lambda s: F.trim(s)), lambda x: F.coalesce(x != "", F.lit(False))), ", ")


def normalise_rows(df: DataFrame) -> DataFrame:
    """Nulls to defaults, trimmed texts; description is not trimmed. List locations are joined."""
    place = clean_list(F.col("location")) if dict(df.dtypes)["location"].startswith("array") else F.col("location")
    fixed = {"job_url": clean_text(F.col("job_url")), "title": clean_text(F.col("title")), "company": clean_text(F.col("company"), "Unknown"), "location": clean_text(place, "India"), "description": F.coalesce(F.col("description"), F.lit("")), "source": clean_text(F.col("source"))}
    return df.withColumns({k: v for k, v in fixed.items() if k in df.columns})


def first_wins(df: DataFrame, key: str, order: list[str]) -> DataFrame:
    """The first row of each key by order; rows with a null or empty key go.

    min_by over the row is combined on the map side, so a key with very many rows is no hot partition,
    which a row_number() window would make of it; and rows cross the network once for each key and task,
    which a minimum joined back to all rows would not save. Rows that tie in order: any of them.
    """
    own = df.columns
    ranked = df.where(F.col(key).isNotNull() & (F.col(key) != "")).groupBy(F.col(key).alias("_key"))
    best = ranked.agg(F.min_by(F.struct(*own), F.struct(*order)).alias("_row"))
    return best.select("_row.*")


def dedupe_by_url(df: DataFrame, url: str = "job_url", order: str = "arrival_ord") -> DataFrame:
    """First arrival of each normalised URL, which becomes its URL."""
    return first_wins(df.withColumn(url, norm_url_loose(F.col(url))), url, [order])


def fair_top_k(df: DataFrame, *, score: str, group: str, order: str, most: int = terms.MAX_CANDIDATES, least: int = terms.MIN_PER_SOURCE, threshold: int = terms.MIN_SCORE) -> DataFrame:
    """The best rows by score, with at least so many of each group; adds rank.

    Rows over the threshold; the first least of each group by score are sure of a place; the others
    take turns, a row of each group by first arrival, until there are most; all of these are then ranked
    by score. Each group is cut to its best rows before anything is ranked across groups, which is two
    top-k selections: no task sees the rows of all groups, however many there are.
    """
    passed = materialise(df.where(F.col(score) >= threshold), "passed")
    first = passed.groupBy(group).agg(F.min(order).alias("_first"))
    within = Window.partitionBy(group).orderBy(F.desc(score), order)
    # a limit on the row number reaches the sort's map side
    best = passed.withColumn("_rn", F.row_number().over(within)).where(F.col("_rn") <= max(most, least)).join(first, group)
    best = materialise(best, "best")
    sure, extra = best.where(F.col("_rn") <= least), best.where(F.col("_rn") > least)
    turns = extra.orderBy("_rn", "_first").limit(max(0, most - sure.count()))
    chosen = sure.withColumn("_turn", F.struct(F.lit(0).alias("late"), F.col("_first").alias("a"), F.col("_rn").cast("long").alias("b")))
    chosen = chosen.unionByName(turns.withColumn("_turn", F.struct(F.lit(1).alias("late"), F.col("_rn").cast(dict(best.dtypes)["_first"]).alias("a"), F.col("_first").cast("long").alias("b"))))
    top = chosen.orderBy(F.desc(score), "_turn").limit(most)
    final = Window.orderBy(F.desc(score), "_turn")  # of most rows
    return top.withColumn("rank", F.row_number().over(final)).drop("_rn", "_first", "_turn")


def round_robin(df: DataFrame, *, pool: str, order: str, most: int) -> DataFrame:
    """The first rows of each pool in turn until there are most; adds pick."""
    within = Window.partitionBy(pool).orderBy(order)
    best = df.withColumn("_rn", F.row_number().over(within)).where(F.col("_rn") <= most)
    picked = best.orderBy("_rn", pool).limit(most)
    return picked.withColumn("pick", F.row_number().over(Window.orderBy("_rn", pool))).drop("_rn")  # of most rows


def top_k_per_parent(df: DataFrame, *, parent: str, order: list[str], k: int) -> DataFrame:
    return df.withColumn("nth", F.row_number().over(Window.partitionBy(parent).orderBy(*order))).where(F.col("nth") <= k)


def first_k(df: DataFrame, order: list[str], k: int) -> DataFrame:
    """The first k rows: a top-k, not a sort of all."""
    return df.orderBy(*order).limit(k)


def unseen(df: DataFrame, seen, key: str = "job_url") -> DataFrame:
    """Rows whose key is not in history (repeats stay).

    seen: a table of keys, which Catalyst broadcasts while they are few; or a sources.tables.History, of
    which only the ranges are read that the rows may be in, whatever has been seen before.
    """
    if not isinstance(seen, DataFrame):
        return seen.unseen(df)
    return df.join(seen.select(key).distinct(), key, "left_anti")


def deferred_first(deferred: DataFrame, fresh: DataFrame, key: str = "job_url", order: str = "arrival_ord") -> DataFrame:
    """Deferred rows, then fresh ones that are not among them; phase and order say which come first."""
    both = deferred.withColumn("phase", F.lit(0)).unionByName(unseen(fresh, deferred, key).withColumn("phase", F.lit(1)), allowMissingColumns=True)
    return both.withColumn("place", F.struct("phase", order))


def split_admitted(df: DataFrame, limit: int, order: list[str]) -> tuple[DataFrame, DataFrame]:
    """(admitted, deferred): the first limit rows, exactly, and the others.

    Rows are numbered by a range-partitioned sort and written once, so of rows that tie at the edge each
    is on one side, and on the same side whenever the two are read.
    """
    rows = number_rows(df.orderBy(*order), "_place")
    return rows.where(F.col("_place") <= limit).drop("_place"), rows.where(F.col("_place") > limit).drop("_place")


def enrich_descriptions(df: DataFrame, crawled: DataFrame, key: str = "job_url") -> DataFrame:
    """A crawled description if it is strictly longer; a crawled company if there is none."""
    more = crawled.select(F.col(key), F.col("description").alias("_d"), F.col("company").alias("_c"))
    out = df.join(more, key, "left")
    size = lambda c: F.length(F.trim(F.coalesce(F.col(c), F.lit(""))))
    return out.withColumns({
        "description": F.when(size("_d") > size("description"), F.col("_d")).otherwise(F.col("description")),
        "company": F.when(size("company") == 0, F.coalesce("_c", "company")).otherwise(F.col("company")),
    }).drop("_d", "_c")


def with_metadata(urls: DataFrame, metadata: DataFrame, key: str = "job_url") -> DataFrame:
    out = urls.join(metadata, key, "left")
    return out.withColumns({"title": F.coalesce("title", key), "location": F.coalesce("location", F.lit("India"))})


def needs_description(df: DataFrame, *, short: int = 300, most: int = 25, order: str = "arrival_ord") -> DataFrame:
    few = df.where((F.col("job_url") != "") & (F.length(F.trim(F.coalesce("description", F.lit("")))) < short))
    return first_k(few, [order], most)


def route(candidates: DataFrame, state: DataFrame, *, most_new: int = terms.MAX_CANDIDATES, key: str = "job_url", order: str = "arrival_ord") -> DataFrame:
    """candidates with route: resumed (a finished verdict for the same content), retry (unfinished), new,
    or waiting (new beyond most_new). candidates carry evaluation_key. The join is on the key alone."""
    known = state.select(F.col(key), F.col("status").alias("_status"), F.col("evaluation_key").alias("_key"), F.col("verdict").alias("stored_verdict"))
    out = candidates.join(known, key, "left")
    resumed = F.col("_status").isin(*terms.TERMINAL) & (F.col("_key") == F.col("evaluation_key")) & F.col("stored_verdict").isNotNull()
    kind = F.when(F.coalesce(resumed, F.lit(False)), "resumed").when(F.col("_status").isin(*terms.RESUMABLE), "retry").otherwise("new")
    out = out.withColumn("route", kind).drop("_status", "_key")
    # the edge is a top-k, not a sort of all; rows that tie in order go by key
    place = F.struct(order, key)
    edge = out.where("route = 'new'").select(order, key).orderBy(order, key).limit(most_new).agg(F.max(place)).first()[0]
    at = None if edge is None else F.struct(*(F.lit(v).cast(out.schema[c].dataType).alias(c) for c, v in zip((order, key), edge, strict=True)))
    late = F.lit(most_new <= 0) if at is None else place > at
    return out.withColumn("route", F.when((F.col("route") == "new") & late, "waiting").otherwise(F.col("route")))


def apply_verdict(df: DataFrame, as_of: Column) -> DataFrame:
    """Score, tier, walk-in status, reason and passed, from a listing joined with its verdict struct."""
    v = lambda name: F.col(f"verdict.{name}")
    parts = {c: S.clamp(v(c), most) for c, most in terms.COMPONENT_CAPS.items()}
    fit = reduce(lambda a, b: a + b, parts.values())
    gate = S.experience(F.concat_ws(" ", F.coalesce("title", F.lit("")), F.coalesce("description", F.lit(""))))
    walkin = F.coalesce(v("is_walkin"), F.lit(False))
    found = walkin_dates(F.when(walkin, F.col("description")), as_of)
    out = df.withColumns(parts).withColumn("_gate", gate).withColumn("_dates", found)
    status = walkin_status(F.col("_dates.start"), F.col("_dates.end"), v("walkin_date"), as_of)
    out = out.withColumn("_walkin", F.when(walkin, status))
    bad, expired = ~F.col("_gate.eligible"), F.coalesce(F.col("_walkin.status") == "expired", F.lit(False))
    reject = bad | expired
    total = F.when(reject, 0).otherwise(fit).cast("int")
    fresher = F.coalesce(v("is_fresher_appropriate"), F.lit(False)) & ~reject
    reason = F.when(bad, F.col("_gate.reason")).when(expired, "Walk-in drive has expired.").when(v("why").isNotNull(), F.array_join(v("why"), "; ")).otherwise(F.coalesce(v("reason"), F.lit("")))
    return out.withColumns({
        "fit_score": total, "fresher_appropriate": fresher, "reason": reason, "gaps": F.coalesce(v("gaps"), F.array().cast("array<string>")),
        "fit_tier": F.when(reject, "Reject").otherwise(S.tier(fit)), "is_walkin": walkin,
        "walkin_date": F.coalesce(F.date_format("_walkin.date", "yyyy-MM-dd"), F.lit("")), "walkin_end_date": F.col("_dates.end"),
        "verification_status": F.coalesce("_walkin.status", F.lit("")), "walkin_date_conflict": F.coalesce("_walkin.conflict", F.lit(False)),
        "venue": F.when(walkin, F.coalesce(v("venue"), F.lit(""))).otherwise(""),
        "passed": (total >= terms.FIT_THRESHOLD) & fresher,
    }).drop("_gate", "_dates", "_walkin")


def walkin_details(status: Column, start: Column, end: Column, time: Column, venue: Column, default: str = "See listing") -> Column:
    """Date or range, time and venue in one line, or a default."""
    text = lambda c: F.nullif(F.trim(c), F.lit(""))
    when = F.when(text(end).isNotNull() & (end != start), F.concat(start, F.lit(" to "), end)).otherwise(text(start))
    line = F.concat_ws(" | ", F.concat(when, F.coalesce(F.concat(F.lit(" @ "), text(time)), F.lit(""))), F.concat(F.lit("Venue: "), text(venue)))
    return F.coalesce(F.nullif(line, F.lit("")), F.lit(default))


def final_rank(df: DataFrame, *, email: str = "recruiter_email", score: str = "fit_score", order: str = "arrival_ord", most: int | None = None) -> DataFrame:
    """Rows with a contact first, then by score, then arrival. A range-partitioned sort; no single-task window."""
    out = df.orderBy(F.desc(F.coalesce(F.col(email), F.lit("")) != ""), F.desc(score), order)
    return out.limit(most) if most is not None else out


def number_rows(df: DataFrame, name: str = "rank") -> DataFrame:
    """df, which is sorted, with each row's place from 1: its place in its partition and the rows of the partitions before.

    Only one count per partition reaches the driver; no window gathers the rows in one task.
    """
    # bits above 33: the partition; below: the row's place in it
    rows = materialise(df.withColumn("_at", F.monotonically_increasing_id()), "numbered")
    part = F.shiftright("_at", 33)
    counts = {r.part: r.n for r in rows.groupBy(part.alias("part")).agg(F.count("*").alias("n")).collect()}
    before, total = [], 0
    for p in sorted(counts):
        before.append((p, total))
        total += counts[p]
    # an Arrow table, not a list: for a list every executor would start Python workers of its own
    offsets = df.sparkSession.createDataFrame(pa.table([pa.array([p for p, _ in before], pa.int64()), pa.array([n for _, n in before], pa.int64())], names=["_part", "_before"]))
    out = rows.withColumn("_part", part).join(F.broadcast(offsets), "_part")
    place = F.col("_before") + F.col("_at").bitwiseAND(F.lit((1 << 33) - 1)) + 1
    return out.select(*df.columns, place.alias(name))


def enrich_contacts(df: DataFrame, *lookups: DataFrame, key: str = "company", order: str = "arrival_ord", budget: int = 1) -> DataFrame:
    """recruiter_email: the description's own, else each lookup's in turn; a lookup serves the first budget rows still without."""
    from ..functions.text import first_email

    out = df.withColumn("recruiter_email", first_email(F.col("description")))
    for i, table in enumerate(lookups):
        asked = out.where("recruiter_email = ''").orderBy(order).limit(budget).select(order).withColumn("_asked", F.lit(True))
        out = out.join(asked, order, "left").join(table.select(key, F.col("email").alias(f"_e{i}")), key, "left")
        got = F.when(F.col("_asked") & (F.col("recruiter_email") == ""), F.coalesce(f"_e{i}", F.lit(""))).otherwise(F.col("recruiter_email"))
        out = out.withColumn("recruiter_email", got).drop("_asked", f"_e{i}")
    return out


def first_wins_capped(df: DataFrame, key: str, order: list[str], most: int = 1000) -> DataFrame:
    return first_wins(df, key, order).orderBy(*order).limit(most)


def combinations(places: DataFrame, families: DataFrame, words: DataFrame, most: int = 24) -> DataFrame:
    """Search combinations: every place with every family's terms, picked from the pools in turn.

    The three are short configuration lists, (place, p), (family, f) and (family, term, t); all pairs of
    places and families are what is asked for, so this is a cross join and written as one.
    """
    pools = places.crossJoin(families).join(words, "family")
    pools = pools.withColumn("pool", F.col("p") * 1_000_000 + F.col("f"))
    return round_robin(pools, pool="pool", order="t", most=most).select("pick", "place", "family", "term")


def retry_rows(listings: DataFrame, state: DataFrame, key: str = "job_url") -> DataFrame:
    return listings.join(state.where(F.col("status").isin(*terms.RESUMABLE)).select(key), key, "left_semi")
