"""A training corpus from raw documents in five stages.

Each stage is f(spark, docs, sf_dir) -> DataFrame and works on all that the stage before it kept. All
but the last return the columns of documents. run() writes each stage's result and reads it again.

Decisions are on rows, not on doc_ids: rows without an id, and rows that share one, are judged like any
other. Two rows that are equal in all columns are one document. Empty tables give empty tables, and
columns beyond those of documents are dropped.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.llm.decontaminate import find_leaks
from quarry.llm.mixing import mix_sources
from quarry.llm.ngram_join import ngram_components
from quarry.llm.passages import drop_repeated_passages
from quarry.llm.quality import learn_quality, quality_score
from quarry.session import drop, materialise, released, scratch

#: Documents below this score go. It is lower than the classifier's own threshold (0.7) because a lost
#: clean document costs more here than a kept poor one, and poor ones score near 0.
REJECT_BELOW = 0.2
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def _key() -> Column:
    """What a row is known by: a hash of all its columns."""
    return F.xxhash64(*COLUMNS)


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Reject documents that the quality classifier scores below REJECT_BELOW.

    A null text is scored as an empty one. Long texts are scored whole. Equal texts have equal scores, so
    they stay or go together; a score of exactly REJECT_BELOW stays.
    """
    model = learn_quality(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return docs.where(quality_score(model, F.col("text")) >= REJECT_BELOW).select(COLUMNS)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document of each group of near duplicates: the one with the smallest doc_id.

    Groups are linked by sets of 5-word shingles with a Jaccard similarity of 0.8 or more, over whole
    texts. A null doc_id is larger than all others; ties (rows that share the smallest doc_id) go by the
    hash of all columns. Of rows equal in all columns one stays. Null and empty texts have no group: each
    different row of these stays.
    """
    rows = docs.select(_key().alias("key"), *COLUMNS)
    groups = materialise(ngram_components(rows, k=5, percent=80, doc_id="key").select(F.col("doc_id").alias("key"), "component_id"), "groups")
    known = rows.groupBy("key").agg(F.min("doc_id").alias("doc_id"), F.count("*").alias("rows"))
    order = F.struct(F.col("doc_id").isNull().alias("without"), "doc_id", "key")
    first = groups.distinct().join(known, "key").groupBy("component_id").agg(F.min_by(F.struct("key", "rows"), order).alias("first"))
    first = materialise(first.select("first.key", "first.rows"), "first")
    # as many keys as documents that stay, so a merge join at every size: broadcast, they would grow with the corpus
    kept = rows.join(first.select("key").hint("merge"), "key", "left_semi")
    again = first.where("rows > 1").select("key")
    if again.isEmpty():
        return kept.select(COLUMNS)
    # equal rows are combined where they are read: no task gets all copies of one
    once = kept.join(again.hint("merge"), "key", "left_semi").select(COLUMNS).distinct()
    return kept.join(again.hint("merge"), "key", "left_anti").select(COLUMNS).unionByName(once)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cut passages of 35 words or more that occur elsewhere too; texts without any stay as they are.

    All occurrences go, in rows with or without an id, of any length; none is kept as the first, so ties do
    not arise. A null text stays null, an empty one empty; a text that loses all becomes empty. Rows that
    repeat lose what they share.
    """
    kept = drop_repeated_passages(docs, size=35, carry=("lang", "source"), verbatim=True)
    return kept.select("doc_id", F.col("kept_text").alias("text"), "lang", "source", F.length("kept_text").cast("long").alias("n_chars"))


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents that hold a benchmark item, as it is or with other parameters.

    Rows are dropped by their own text, with or without a doc_id; rows that share an id or a text are
    judged alike where their texts are. Null and empty texts hold nothing; long ones are read whole.
    """
    rows = docs.select(_key().alias("key"), *COLUMNS)
    leaks = find_leaks(rows, spark.read.parquet(f"{sf_dir}/benchmark.parquet"), doc_id="key")
    leaks = materialise(leaks.select(F.col("doc_id").alias("key")).distinct(), "leaks")
    return rows.join(leaks, "key", "left_anti").select(COLUMNS)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the mix takes, with how many words of each (a document taken twice counts twice).

    Null and empty texts have no words and are not taken; a null source is a source; of rows that are
    alike as many are taken as the target needs.
    """
    return mix_sources(docs.select(COLUMNS), keep_text=True).where("taken > 0")


STAGES = [
    ("quality classifier", quality),
    ("n-gram Jaccard join", near_duplicates),
    ("substring dedup", repeated_passages),
    ("benchmark decontamination", decontaminate),
    ("source mixing", mix),
]

#: SQL can express neither the trained classifier nor the hashed mix.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, one after the other, over documents."""
    docs, before = spark.read.parquet(f"{sf_dir}/documents.parquet"), None
    for name, stage in STAGES[:-1]:
        path = scratch(spark, name.split()[0])
        with released(spark):
            docs = materialise(stage(spark, docs, sf_dir), name, path)
        if before:
            drop(spark, before)
        before = path
    return STAGES[-1][1](spark, docs, sf_dir)
