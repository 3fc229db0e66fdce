"""The daily rollup of runs in a form that can be merged: counted values, from which percentiles stay exact."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.model import LOCAL_TIME_ZONE
from tidemark.operators.ledger import TABLE

GROUP = ("day", *TABLE, "mode")
VALUE = "duration_seconds"
_SUMS = ("runs", "successes", "failures", "fetched", "fetched_known", "upserted", "upserted_known")


def counted_runs(signed: DataFrame, time_zone: str = LOCAL_TIME_ZONE) -> DataFrame:
    """Finished scheduled runs per local day, table, mode and duration: how many, and sums. ``_sign`` is 1 for a run that
    comes and -1 for one that goes; sums that come to nothing are left out."""
    local = F.convert_timezone(F.lit("UTC"), F.lit(time_zone), F.col("finished_at").cast("timestamp_ntz"))
    done = signed.filter(F.col("finished_at").isNotNull() & (F.col("trigger") == "schedule"))
    sign, zero = F.col("_sign").cast("bigint"), F.lit(0).cast("bigint")
    measures = {
        "runs": sign,
        "successes": F.when(F.col("status") == "success", sign).otherwise(zero),
        "failures": F.when(F.col("status") == "failed", sign).otherwise(zero),
    }
    for name in ("fetched", "upserted"):
        value = F.col(f"{name}_count").cast("bigint")
        measures[name] = F.coalesce(value * sign, zero)
        measures[f"{name}_known"] = F.when(value.isNotNull(), sign).otherwise(zero)
    rows = done.select(F.date_trunc("day", local).cast("timestamp_ntz").alias("day"), *TABLE, "mode", VALUE, *[
        c.alias(n) for n, c in measures.items()
    ])
    return merged_counts(rows)


def merged_counts(counts: DataFrame) -> DataFrame:
    """One row per group and duration; those that add up to nothing go."""
    summed = counts.groupBy(*GROUP, VALUE).agg(*[F.sum(n).alias(n) for n in _SUMS])
    something = F.lit(False)
    for n in _SUMS:
        something = something | (F.col(n) != 0)
    return summed.filter(something)


def rollup_of(counts: DataFrame) -> DataFrame:
    """The rows of ``daily_rollup`` from counted runs."""
    duration, known = F.col(VALUE), F.when(F.col(VALUE).isNotNull(), F.col("runs"))
    return counts.groupBy(*GROUP).agg(
        F.sum("successes").alias("success_count"), F.sum("failures").alias("failure_count"),
        (F.sum(duration * F.col("runs")).cast("double") / F.sum(known)).alias("avg_duration_s"),
        F.percentile(duration.cast("double"), 0.95, F.col("runs")).alias("p95_duration_s"),
        F.when(F.sum("fetched_known") > 0, F.sum("fetched")).alias("total_fetched"),
        F.when(F.sum("upserted_known") > 0, F.sum("upserted")).alias("total_upserted"),
    )
