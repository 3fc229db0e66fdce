"""Read-only reports over ledger, logs and results."""

from __future__ import annotations

import re
from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.timestamps import parse_since
from tidemark.model import ERROR_LEVELS, LEVELS, RESOURCES
from tidemark.operators.ledger import TABLE, latest_runs

HISTORY_MAX = 100
_ID_PREFIX = re.compile(r"[a-f0-9-]{1,36}")


def status_label(run_status: Column, started_at: Column, enabled: Column, as_of: Column) -> Column:
    """DISABLED, NEVER, RUNNING, RUNNING > 1h, OK, FAIL or the status itself."""
    seconds = F.timestamp_diff("MICROSECOND", started_at, as_of) / 1e6
    return (
        F.when(~enabled, "DISABLED")
        .when(run_status.isNull(), "NEVER")
        .when((run_status == "running") & (seconds > 3600), "RUNNING > 1h")
        .when(run_status == "running", "RUNNING")
        .when(run_status == "success", "OK")
        .when(run_status == "failed", "FAIL")
        .otherwise(run_status)
    )


def status_report(
    pipelines: DataFrame, ledger: DataFrame, as_of: Column, resources: Sequence[str] = tuple(RESOURCES)
) -> DataFrame:
    """Every configured pipeline and resource with its last run.

    ``pipelines`` has ``pipeline``, ``enabled`` and ``disabled_resources``.
    """
    configured = pipelines.select(
        "pipeline", "enabled", "disabled_resources",
        F.explode(F.array(*(F.lit(r) for r in resources))).alias("resource"),
    )
    on = F.col("enabled") & ~F.coalesce(
        F.array_contains("disabled_resources", F.col("resource")), F.lit(False)
    )
    last = latest_runs(ledger).select(*TABLE, "status", "started_at", "finished_at", "upserted_count")
    return configured.join(last, list(TABLE), "left").select(
        *TABLE,
        F.col("finished_at").alias("last_sync"),
        status_label(F.col("status"), F.col("started_at"), on, as_of).alias("label"),
        F.when(F.col("status").isNotNull(), F.coalesce("upserted_count", F.lit(0))).alias("records"),
    )


def results_last_day(results: DataFrame, as_of: Column) -> DataFrame:
    """Warnings and failures of the last 24 hours per table."""
    recent = results.filter(F.col("created_at") >= as_of - F.expr("INTERVAL 24 HOURS"))
    return recent.groupBy(*TABLE).agg(
        F.count_if(F.col("status") == "warning").alias("warn_count"),
        F.count_if(F.col("status") == "failed").alias("fail_count"),
    )


def results_verdict(per_table: DataFrame) -> DataFrame:
    """One row: totals and ``failed``, ``warning`` or ``healthy``."""
    totals = per_table.agg(
        F.coalesce(F.sum("warn_count"), F.lit(0)).alias("warnings"),
        F.coalesce(F.sum("fail_count"), F.lit(0)).alias("failures"),
    )
    verdict = F.when(F.col("failures") > 0, "failed").when(F.col("warnings") > 0, "warning")
    return totals.withColumn("verdict", verdict.otherwise("healthy"))


def history(ledger: DataFrame, pipeline: str, last: int = 10) -> DataFrame:
    """The newest runs of a pipeline."""
    if not 1 <= last <= HISTORY_MAX:
        raise ValueError(f"last must be between 1 and {HISTORY_MAX}, not {last}")
    return (
        ledger.filter(F.col("pipeline") == pipeline)
        .orderBy(F.col("started_at").desc(), F.col("sync_id").desc())
        .limit(last)
        .select(
            "started_at", "sync_id", "resource", "mode", "status",
            F.coalesce("fetched_count", F.lit(0)).alias("fetched"),
            F.coalesce(F.col("duration_seconds").cast("double"), F.lit(0.0)).alias("duration_s"),
            F.substring(F.coalesce("error", F.lit("")), 1, 40).alias("error"),
        )
    )


def search_logs(
    logs: DataFrame,
    pipeline: str,
    as_of: datetime,
    errors: bool = False,
    since: str = "",
    limit: int = 100,
) -> DataFrame:
    """The newest log rows of a pipeline, oldest first. Text that is no time span does not filter."""
    rows = logs.filter(F.col("pipeline") == pipeline)
    if errors:
        rows = rows.filter(F.col("level").isin(*ERROR_LEVELS))
    span = parse_since(since) if since else None
    if span:
        rows = rows.filter(F.col("timestamp") >= F.lit(as_of - span))
    return rows.orderBy(F.col("timestamp").desc()).limit(limit).orderBy("timestamp")


def find_runs(ledger: DataFrame, prefix: str) -> DataFrame:
    """Runs whose id starts with ``prefix``, which may only hold hex digits and hyphens."""
    if not _ID_PREFIX.fullmatch(prefix):
        raise ValueError(f"{prefix!r} is no id or id prefix")
    return ledger.filter(F.col("sync_id").startswith(prefix))


def inspect_runs(runs: DataFrame, logs: DataFrame, results: DataFrame) -> DataFrame:
    """The run, its log lines and its rule results as one timeline per run.

    Rows stay rows: however many lines one run has, none are gathered into a list.
    """
    ids = runs.select("sync_id")
    head = runs.select(
        "sync_id", F.lit("run").alias("section"), F.col("started_at").alias("at"),
        F.col("status").alias("name"),
        F.concat_ws(" ", "pipeline", "resource", "mode").alias("detail"),
    )
    lines = logs.join(ids, "sync_id").select(
        "sync_id", F.lit("log").alias("section"), F.col("timestamp").alias("at"),
        F.col("event").alias("name"), F.col("message").alias("detail"),
    )
    checks = results.join(ids, "sync_id").select(
        "sync_id", F.lit("validation").alias("section"), F.col("created_at").alias("at"),
        F.col("rule").alias("name"), F.col("status").alias("detail"),
    )
    return head.unionByName(lines).unionByName(checks)


def timeline(sections: DataFrame) -> DataFrame:
    """``inspect_runs`` with the place of each row in its run: the run first, then in order of time."""
    place = Window.partitionBy("sync_id").orderBy(F.col("section") != "run", "at", "section", "name", "detail")
    return sections.withColumn("place", F.row_number().over(place))


def level_rank(level: Column) -> Column:
    """Place of a level in the order of severity; an unknown level ranks lowest."""
    return F.greatest(F.array_position(F.array(*(F.lit(x) for x in LEVELS)), F.upper(level)) - 1, F.lit(0))


def at_least(logs: DataFrame, minimum: str = "INFO", level: str = "level") -> DataFrame:
    """Log rows of at least this level; a row without a level counts as INFO."""
    floor = LEVELS.index(minimum.upper()) if minimum.upper() in LEVELS else 1
    return logs.filter(level_rank(F.coalesce(level, F.lit("INFO"))) >= floor)
