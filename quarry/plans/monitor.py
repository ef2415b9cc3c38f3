"""Health report, settings check and the local loop: what surrounds a run."""

from __future__ import annotations

import logging
import sys
import time
from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.dates import drifted
from ..operators.metrics import pattern_counts
from ..sources.readers import read_latest_log

#: What a log line is counted for, whatever its case.
ERROR_PATTERNS = ["ERROR", "Traceback", "gateway unavailable", "rate limited", "deadline_exceeded", "Cloudflare JS challenge"]
REQUIRED_SETTINGS = ["GOOGLE_SHEET_ID", "GOOGLE_SERVICE_ACCOUNT_JSON", "ALERT_EMAIL_TO"]


def get_logger(name: str, level: int = logging.INFO) -> logging.Logger:
    """A logger to standard output with time, level and name; asked for again, the same one with one handler."""
    log = logging.getLogger(name)
    if not log.handlers:
        handler = logging.StreamHandler(sys.stdout)
        handler.setFormatter(logging.Formatter("%(asctime)s %(levelname)s %(name)s: %(message)s"))
        log.addHandler(handler)
        log.propagate = False
    log.setLevel(level)
    return log


def log_issues(lines: DataFrame) -> DataFrame:
    """pattern, n: the lines of a log (line) that contain each error pattern."""
    return pattern_counts(lines.select(F.lower("line").alias("line")), "line", {p: p.lower() for p in ERROR_PATTERNS})


def artifact_issues(progress: Column, progress_at: Column, metrics_at: Column, seconds: int = 300) -> Column:
    """ARRAY<STRING> of what is wrong with a run's files: progress is JSON text with a status; null times: a file is missing."""
    parsed = F.try_parse_json(progress)
    status = F.try_variant_get(parsed, "$.status", "string")
    missing = progress_at.isNull() | metrics_at.isNull()
    stale = F.when(drifted(progress_at, metrics_at, seconds), F.lit("progress and metrics are not of one run"))
    unread = F.when(parsed.isNull(), F.lit("progress is no JSON"))
    unfinished = F.when(F.coalesce(status, F.lit("")).isin("", "completed"), None).otherwise(F.concat(F.lit("status is "), status))
    found = F.when(parsed.isNull(), F.array(unread)).otherwise(F.array(stale, unfinished))
    return F.filter(F.when(missing, F.array().cast("array<string>")).otherwise(found), lambda x: x.isNotNull())


def health_report(spark: SparkSession, *, log_folder: str | None = None, artifacts: DataFrame | None = None, changed_files: list[str] | None = None, ignore_file: bytes | None = b"") -> DataFrame:
    """check, ok, detail: the log's error patterns, artifacts (progress, progress_at, metrics_at), changed files of the
    working copy, and its ignore file (None: missing; with NUL bytes: not UTF-8). A run is healthy if all are ok."""
    rows = []
    if changed_files is not None:
        rows.append(("files", not changed_files, f"{len(changed_files)} changed"))
    if ignore_file is None or ignore_file:
        rows.append(("ignore file", ignore_file is not None and b"\x00" not in ignore_file, "missing" if ignore_file is None else f"{len(ignore_file)} bytes"))
    out = spark.createDataFrame(rows, "check string, ok boolean, detail string")
    if log_folder is not None:
        found = log_issues(read_latest_log(spark, log_folder)).agg(F.count("*").alias("n"), F.array_join(F.array_sort(F.collect_list(F.concat_ws("=", "pattern", "n"))), ", ").alias("d"))
        out = out.unionByName(found.select(F.lit("log").alias("check"), (F.col("n") == 0).alias("ok"), F.col("d").alias("detail")))
    if artifacts is not None:
        issues = artifact_issues(F.col("progress"), F.col("progress_at"), F.col("metrics_at"))
        out = out.unionByName(artifacts.select(F.lit("artifacts").alias("check"), (F.size(issues) == 0).alias("ok"), F.array_join(issues, "; ").alias("detail")))
    return out


def validate(settings: Mapping[str, str]) -> None:
    """Fail with the names of all required settings that are missing or empty."""
    missing = [k for k in REQUIRED_SETTINGS if not settings.get(k)]
    if missing:
        raise RuntimeError("missing settings: " + ", ".join(missing))


def run_every(run: Callable[[], object], hours: float = 24.0, *, times: int | None = None, sleep: Callable[[float], None] = time.sleep, log: Callable[[str], None] | None = None) -> int:
    """Run again and again, for ever or so many times; a run that fails is logged and does not end the loop. How many failed."""
    log = log or get_logger("quarry.loop").warning
    done = failed = 0
    while times is None or done < times:
        try:
            run()
        except Exception as e:
            failed += 1
            log(f"run failed: {type(e).__name__}: {e}")
        done += 1
        if times is None or done < times:
            sleep(hours * 3600)
    return failed
