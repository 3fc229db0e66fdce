"""Retention of audit rows, and of snapshots by age tier."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.model import ERROR_LEVELS, Retention


def _older(ts: str, as_of: Column, days: int) -> Column:
    return F.coalesce(F.col(ts) < as_of - F.make_dt_interval(days=F.lit(days)), F.lit(False))


def expired_logs(as_of: Column, keep: Retention = Retention()) -> dict[str, Column]:
    is_error = F.col("level").isin(*ERROR_LEVELS)
    return {
        "logs": ~is_error & _older("timestamp", as_of, keep.logs),
        "error_logs": is_error & _older("timestamp", as_of, keep.error_logs),
    }


def expired_results(as_of: Column, keep: Retention = Retention()) -> dict[str, Column]:
    return {"results": _older("created_at", as_of, keep.results)}


def expired_runs(as_of: Column, keep: Retention = Retention()) -> dict[str, Column]:
    return {"runs": _older("started_at", as_of, keep.runs)}


def expired_requests(as_of: Column, keep: Retention = Retention()) -> dict[str, Column]:
    """Only requests that came to an end expire."""
    ended = F.col("status").isin("done", "failed", "cancelled")
    return {"requests": ended & _older("finished_at", as_of, keep.requests)}


def preview(table: DataFrame, expired: dict[str, Column]) -> DataFrame:
    """How many rows each predicate would remove: columns ``kind`` and ``expired_rows``."""
    counts = table.agg(*(F.count_if(c).alias(n) for n, c in expired.items()))
    pairs = (F.struct(F.lit(n).alias("kind"), F.col(n).alias("expired_rows")) for n in expired)
    return counts.select(F.inline(F.array(*pairs)))


def keep_rows(table: DataFrame, expired: dict[str, Column]) -> DataFrame:
    """The table without its expired rows."""
    for gone in expired.values():
        table = table.filter(~F.coalesce(gone, F.lit(False)))
    return table


def keep_by_tier(
    snapshots: DataFrame, taken_at: str, snapshot_id: str, daily: int = 7, weekly: int = 4, monthly: int = 6
) -> DataFrame:
    """Snapshots to keep: of the newest days, the newest Sundays and the newest first days of a month.

    The last snapshot of a day stands for it, so only days are ranked.
    """
    last = F.max_by(snapshot_id, F.struct(taken_at, snapshot_id))
    days = snapshots.groupBy(F.to_date(taken_at).alias("day")).agg(last.alias(snapshot_id))
    tiers = (
        ("daily", F.lit(True), daily),
        ("weekly", F.dayofweek("day") == 1, weekly),
        ("monthly", F.dayofmonth("day") == 1, monthly),
    )
    tagged = days.select(
        "day",
        snapshot_id,
        F.explode(F.array_compact(F.array(*(F.when(c, F.lit(t)) for t, c, _ in tiers)))).alias("tier"),
    )
    newest = Window.partitionBy("tier").orderBy(F.col("day").desc())
    limit = F.lit(0)
    for tier, _, n in tiers:
        limit = F.when(F.col("tier") == tier, n).otherwise(limit)
    ranked = tagged.withColumn("_rank", F.row_number().over(newest)).filter(
        F.col("_rank") <= max(daily, weekly, monthly)
    )
    return ranked.filter(F.col("_rank") <= limit).drop("_rank")
