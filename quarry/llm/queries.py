"""The registered queries of this subpackage: thin adaptors from its operators to the agreed columns."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .chat import PERSPECTIVES_SQL, rotate_perspectives
from .decontaminate import find_leaks
from .fingerprints import neighbour_fingerprints
from .licenses import scan_licenses
from .maxent import score_texts
from .mixing import MIX_SQL, mix_sources
from .ngram_join import JOIN_SQL, ngram_components
from .passages import PASSAGES_SQL, drop_repeated_passages
from .periods import RUNS_SQL, loop_tails, periodic_runs, run_digests
from .quality import classify_quality
from .simhash import simhash_components
from .spelling import FORMS_SQL, spelling_groups
from .warc import WARC_SQL, read_warc, write_warc


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_components(_table(spark, sf_dir, "documents"), k=3, percent=90)


def op3_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = drop_repeated_passages(_table(spark, sf_dir, "documents"), size=35)
    return kept.select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


def op4_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_licenses(_table(spark, sf_dir, "documents"))


def op5_warc_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    back = read_warc(spark, write_warc(_table(spark, sf_dir, "pages")))
    return back.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op10_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix_sources(_table(spark, sf_dir, "documents"))


def op7_document_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbour_fingerprints(_table(spark, sf_dir, "documents"))


def op9_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classify_quality(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op8_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_leaks(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op6_chat_perspectives(spark: SparkSession, sf_dir: str) -> DataFrame:
    seen = rotate_perspectives(_table(spark, sf_dir, "conversations"))
    mask = F.array_join(F.transform("mask", lambda m: F.concat(m["start"], F.lit("+"), m["length"])), ",").alias("mask")
    return seen.select("conv_id", "perspective", "part", "piece", "n_turns", "n_trained", "rendered", mask)


def op2_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_texts(_table(spark, sf_dir, "documents"))


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", loop_tails().alias("text"))
    return run_digests(periodic_runs(docs))


def op12_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash_components(_table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lpad(F.lower(F.hex("print")), 16, "0").alias("fingerprint"), "component_id")


def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling_groups(_table(spark, sf_dir, "documents"), misspell_every=31)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_ngram_jaccard_join": op1_ngram_jaccard_join,
        "op3_substring_dedup": op3_substring_dedup,
        "op4_license_scan": op4_license_scan,
        "op5_warc_round_trip": op5_warc_round_trip,
        "op10_source_mixing": op10_source_mixing,
        "op7_document_fingerprints": op7_document_fingerprints,
        "op9_quality_classifier": op9_quality_classifier,
        "op8_benchmark_decontamination": op8_benchmark_decontamination,
        "op6_chat_perspectives": op6_chat_perspectives,
        "op2_lm_scoring": op2_lm_scoring,
        "op11_periodic_runs": op11_periodic_runs,
        "op12_simhash_near_dedup": op12_simhash_near_dedup,
        "op13_spelling_variants": op13_spelling_variants,
    }


def oracle_sql() -> dict[str, str]:
    """SQL for DuckDB; trained models, identifier scans, sketches and templates (2, 4, 7, 8, 9) have brute-force tests instead."""
    return {
        "op1_ngram_jaccard_join": JOIN_SQL,
        "op3_substring_dedup": PASSAGES_SQL,
        "op5_warc_round_trip": WARC_SQL,
        "op6_chat_perspectives": PERSPECTIVES_SQL,
        "op10_source_mixing": MIX_SQL,
        "op11_periodic_runs": RUNS_SQL,
        "op13_spelling_variants": FORMS_SQL,
    }
