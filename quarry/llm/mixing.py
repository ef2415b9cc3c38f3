"""Mixing sources to target weights by hash-threshold histograms.

Each document gets a fixed hash of its id and text. A source's words are summed by hash bucket; the
bucket in which its budget runs out is refined by the next bits of the hash, and only that one, until
it holds one document. Rows that are alike in id and text share a hash; if they are the bucket that
is left, it is refined further by a number that each row draws once. What lies below the threshold is
taken: no sort, no shuffle of texts, and a smaller budget always takes a subset of a larger one.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..operators.listings import number_rows
from ..session import materialise, ship
from . import words as W

WEIGHTS = (5, 2, 1)
_BITS, _STEP = 60, 12


def _count(column: pa.Array) -> pa.Array:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    out = []
    for w in W.split(column, hashed=False):
        out += (w.bounds[1:] - w.bounds[:-1]).tolist()
    return pa.array(out, pa.int64())


def word_count(text: Column) -> Column:
    """Runs without white space in a text; null: 0."""

    @F.arrow_udf("long")
    def count(column: pa.Array) -> pa.Array:
        return _count(column)

    return count(text)


def _hash(doc_id: Column, text: Column, seed: int) -> Column:
    """60 bits of the MD5 of id and text, which SQL can compute as well."""
    key = F.concat(F.lit(f"{seed}/"), F.coalesce(doc_id.cast("string"), F.lit("")), F.lit("/"), F.coalesce(text.cast("string"), F.lit("")))
    return F.conv(F.substring(F.md5(key), 1, _BITS // 4), 16, 10).cast("long")


def _draw() -> Column:
    """A number for each row, to tell rows apart that are alike; only written tables keep it."""
    return F.shiftrightunsigned(F.xxhash64(F.monotonically_increasing_id()), 64 - _BITS)


def source_targets(sizes: DataFrame, *, weights: tuple[int, ...] = WEIGHTS, share: float = 1.5, most: int = 2) -> DataFrame:
    """source, source_size, target from rows (source, size).

    Sources in code-point order, null last, weigh as weights says, over and over; together they get
    share times all words; none gets more than most times its own words, the excess goes to the
    others by weight until none is above. One row per source is handled, never the documents; sources
    are numbered by a range-partitioned sort, so there may be as many as hosts.
    """
    table = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    weight = F.element_at(F.array(*(F.lit(float(x)) for x in weights)), ((F.col("nth") - 1) % len(weights) + 1).cast("int"))
    table = materialise(number_rows(table.orderBy(F.col("source").asc_nulls_last()), "nth").withColumn("weight", weight), "sources")
    words = table.agg(F.sum("source_size")).first()[0] or 0
    level, full = 0.0, None
    while True:
        above = F.lit(level) * F.col("weight") > most * F.col("source_size") if full is None else full | (F.lit(level) * F.col("weight") > most * F.col("source_size"))
        stopped, rest, n = table.agg(F.sum(F.when(above, most * F.col("source_size")).otherwise(0)), F.sum(F.when(above, 0.0).otherwise(F.col("weight"))), F.count(F.when(above, 1))).first()
        if full is not None and n == known:
            break
        full, known = above, n
        level = (share * words - (stopped or 0)) / rest if rest else 0.0
    return table.select("source", "source_size", F.when(full, most * F.col("source_size")).otherwise(F.least(F.lit(level) * F.col("weight"), (most * F.col("source_size")).cast("double"))).cast("double").alias("target"))


def thresholds(sizes: DataFrame, targets: DataFrame) -> DataFrame:
    """targets with rounds, threshold and draw: take each document rounds times, and once more if its
    hash is below threshold, or equal to it and its draw below draw.

    sizes: rows (source, size, hash, draw). The words taken come within half a document of the target.
    """
    whole = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0)
    targets = targets.withColumn("rounds", whole).withColumn("left", F.col("target") - F.col("rounds") * F.col("source_size"))
    now, found = sizes, None
    budget = targets.select(F.col("source").alias("s"), "left", F.lit(0).cast("long").alias("fixed"))
    upto = Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, 0)
    for key in ("hash", "draw"):
        for shift in range(_BITS - _STEP, -1, -_STEP):
            hist = now.groupBy("source", F.shiftright(key, shift).alias("bucket")).agg(F.sum("size").alias("words"), F.count("*").alias("docs"))
            hist = hist.withColumn("upto", F.sum("words").over(upto))
            hist = hist.join(budget, hist["source"].eqNullSafe(budget["s"])).drop("s")
            edge = hist.where("upto > left AND upto - words <= left").withColumn("left", F.col("left") - (F.col("upto") - F.col("words")))
            edge = materialise(edge.select("source", "bucket", "words", "docs", "left", "fixed"), "edge")
            last = key == "draw" and shift == 0
            done = edge if last else edge.where("docs = 1")
            # the document at the edge is taken if that comes nearer to the target
            place = F.shiftleft(F.col("bucket") + F.when(F.col("words") < 2 * F.col("left"), 1).otherwise(0), shift)
            zero = F.lit(0).cast("long")
            done = done.select("source", *((place.alias("threshold"), zero.alias("draw")) if key == "hash" else (F.col("fixed").alias("threshold"), place.alias("draw"))))
            found = done if found is None else found.unionByName(done)
            edge = edge.where("docs > 1")
            if last or edge.isEmpty():
                break
            fixed = F.col("bucket") if key == "hash" else F.col("fixed")
            budget = edge.select(F.col("source").alias("s"), "left", fixed.alias("fixed"))
            at = edge.select(F.col("source").alias("s"), "bucket")
            now = now.join(at, now["source"].eqNullSafe(at["s"]) & (F.shiftright(now[key], shift) == at["bucket"]), "left_semi")
        else:
            continue
        break
    found = materialise(found.withColumnRenamed("source", "s"), "thresholds")
    parts = targets.join(found, targets["source"].eqNullSafe(found["s"]), "left")
    return parts.select("source", "source_size", "target", "rounds", *(F.coalesce(c, F.lit(0)).alias(c) for c in ("threshold", "draw")))


def mix_sources(df: DataFrame, *, weights: tuple[int, ...] = WEIGHTS, share: float = 1.5, most: int = 2, seed: int = 17, doc_id: str = "doc_id", source: str = "source", text: str = "text", keep_text: bool = False) -> DataFrame:
    """doc_id, size, source_size, target, taken of every row of df; with keep_text, df's own columns and
    size, source_size, target, taken.

    size is the text's number of words (null: 0); taken is the words the mix takes of the row, its
    repeats counted: 0, 1 or 2 times its size with the defaults. Each source's taken words come within
    half a document of its target.

    Null sources are one source, last in order. A null doc_id is a value like others. Null and empty
    texts take nothing; long ones are one document. Of rows alike in id and text as many are taken as
    the target needs, no matter which. Empty tables give no rows. The same rows always give the same mix,
    however they are partitioned. With keep_text, columns of df that are called like a result come back
    with "_in" appended; without, other columns are ignored.
    """
    ship(df.sparkSession)
    own = df.columns
    held = [F.struct(*(F.col(f"`{c}`") for c in own)).alias("own")] if keep_text else []
    rows = df.select(*held, F.col(doc_id).cast("long").alias("doc_id"), F.col(source).cast("string").alias("source"), word_count(F.col(text)).alias("size"), _hash(F.col(doc_id).cast("long"), F.col(text), seed).alias("hash"))
    rows = materialise(rows.withColumn("draw", _draw()), "sizes")
    sizes = rows.select("source", "size", "hash", "draw")
    plan = materialise(thresholds(sizes, source_targets(sizes, weights=weights, share=share, most=most)), "plan")
    plan = plan.select(F.col("source").alias("s"), "source_size", "target", "rounds", "threshold", F.col("draw").alias("upto"))
    below = (F.col("hash") < F.col("threshold")) | ((F.col("hash") == F.col("threshold")) & (F.col("draw") < F.col("upto")))
    out = rows.join(plan, rows["source"].eqNullSafe(plan["s"]))
    results = ["size", "source_size", "target", (F.col("size") * (F.col("rounds") + below.cast("long"))).alias("taken")]
    if not keep_text:
        return out.select("doc_id", *results)
    names = {"size", "source_size", "target", "taken"}
    kept = []
    for c in own:
        name = c
        while name in names:
            name += "_in"
        names.add(name)
        kept.append(F.col(f"own.`{c}`").alias(name))
    return out.select(*kept, *results)


#: The rows of op10 for DuckDB.
MIX_SQL = r"""
WITH docs AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size,
         CAST('0x' || substr(md5('17/' || coalesce(CAST(doc_id AS VARCHAR), '') || '/' || coalesce(text, '')), 1, 15) AS BIGINT) AS hash
  FROM documents),
sources AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size, row_number() OVER (ORDER BY source NULLS LAST) AS nth FROM docs GROUP BY source),
weighted AS (SELECT *, ([5.0, 2.0, 1.0])[CAST((nth - 1) % 3 + 1 AS INTEGER)]::DOUBLE AS weight FROM sources),
levels AS (
  SELECT *, (1.5::DOUBLE * sum(source_size) OVER ()
             - coalesce(sum(2 * source_size) OVER (ORDER BY source_size / weight, nth ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
            / sum(weight) OVER (ORDER BY source_size / weight, nth ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
  FROM weighted),
level AS (SELECT arg_min(level, source_size / weight) AS level FROM levels WHERE level * weight <= 2 * source_size),
targets AS (SELECT source, source_size, CAST(least(coalesce((SELECT level FROM level) * weight, 2 * source_size), 2 * source_size) AS DOUBLE) AS target FROM weighted),
budgets AS (SELECT *, CASE WHEN source_size > 0 THEN CAST(floor(target / source_size) AS BIGINT) ELSE 0 END AS rounds FROM targets),
run AS (
  SELECT d.*, b.source_size, b.target, b.rounds, b.target - b.rounds * b.source_size AS budget,
         sum(size) OVER (PARTITION BY d.source ORDER BY hash ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS upto
  FROM docs d JOIN budgets b ON d.source IS NOT DISTINCT FROM b.source)
SELECT doc_id, CAST(size AS BIGINT) AS size, source_size, target,
       CAST(size * (rounds + CASE WHEN upto <= budget OR (upto - size <= budget AND size < 2 * (budget - (upto - size))) THEN 1 ELSE 0 END) AS BIGINT) AS taken
FROM run
"""
