"""Data-quality rules, evaluated for every run of the ledger at once."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.model import LOOKBACK_RUNS, RESULT_STATUSES, Thresholds
from tidemark.operators.ledger import TABLE, successes, with_history
from tidemark.operators.merge import is_active
from tidemark.operators.sliding import sliding_median


def _percent(part: Column, whole: Column) -> Column:
    return part / F.greatest(whole, F.lit(1)) * 100


def _fetched() -> Column:
    return F.coalesce("fetched_count", F.lit(0))


def _result(rule: str, status: Column, percent: Column, details: Column) -> Column:
    return F.struct(
        F.lit(rule).alias("rule"),
        status.alias("status"),
        percent.cast("double").alias("percent"),
        details.alias("details"),
    )


def _json(**fields: Column) -> Column:
    return F.to_json(F.struct(*(c.alias(n) for n, c in fields.items())))


_NOTHING = "{}"

# Texts in the stored details.
SILENT_HINT = "Check access_token — may be expired"
SWEEP_STOPPED = "sweep ABORTED — manual review required"


def fetch_upsert_parity(limits: Thresholds = Thresholds()) -> Column:
    """Rows were fetched but not stored."""
    fetched, upserted = _fetched(), F.coalesce("upserted_count", F.lit(0))
    skipped = _percent(fetched - upserted, fetched)
    bad = skipped > limits.parity_max_skip
    details = _json(fetched=fetched, upserted=upserted, skipped_pct=F.round(skipped, 2))
    return _result(
        "fetch_upsert_parity",
        F.when(bad, "failed").otherwise("ok"),
        skipped,
        F.when(bad, details).otherwise(_NOTHING),
    )


def volume_sanity(limits: Thresholds = Thresholds()) -> Column:
    """An incremental run and the ones before it all fetched nothing. Needs ``prev_zeros``."""
    silent = (_fetched() <= 0) & (F.col("prev_zeros") >= limits.zero_streak - 1)
    incremental = F.col("mode") == "incremental"
    details = _json(zero_fetch_streak=F.lit(limits.zero_streak), hint=F.lit(SILENT_HINT))
    return _result(
        "volume_sanity",
        F.when(~incremental, "skipped").when(silent, "warning").otherwise("ok"),
        F.lit(None),
        F.when(incremental & silent, details).otherwise(_NOTHING),
    )


def weekly_full_drift(limits: Thresholds = Thresholds()) -> Column:
    """A full refresh differs from the one before. Needs ``prev_full_fetched``."""
    before = F.col("prev_full_fetched")
    applies = (F.col("mode") == "full_refresh") & before.isNotNull()
    drift = F.when(applies, _percent(F.abs(_fetched() - before), before))
    status = (
        F.when(~applies, "skipped")
        .when(drift > limits.drift_fail, "failed")
        .when(drift > limits.drift_warn, "warning")
        .otherwise("ok")
    )
    details = _json(drift_pct=F.round(drift, 2))
    return _result("weekly_full_drift", status, drift, F.when(applies, details).otherwise(_NOTHING))


def soft_delete_sanity(limits: Thresholds = Thresholds()) -> Column:
    """A full refresh would remove too many of the rows there were before it."""
    applies = F.col("mode") == "full_refresh"
    before = F.coalesce("rows_before", F.lit(0))
    deleted = F.when(applies, _percent(before - _fetched(), before))
    bad = deleted > limits.delete_max
    status = F.when(~applies, "skipped").when(bad, "failed").otherwise("ok")
    details = F.when(
        bad,
        _json(delete_pct=F.round(deleted, 2), action=F.lit(SWEEP_STOPPED)),
    ).otherwise(_json(delete_pct=F.round(deleted, 2)))
    return _result("soft_delete_sanity", status, deleted, F.when(applies, details).otherwise(_NOTHING))


# Rules that look at earlier runs of the same table.
volume_sanity.needs_history = weekly_full_drift.needs_history = True

RULES = (fetch_upsert_parity, volume_sanity, weekly_full_drift, soft_delete_sanity)


def evaluate_rules(
    ledger: DataFrame,
    limits: Thresholds = Thresholds(),
    rules: Sequence = RULES,
    few_runs: bool = False,
) -> DataFrame:
    """One row per successful run and rule. Earlier runs are looked at only if a rule needs them."""
    if any(getattr(rule, "needs_history", False) for rule in rules):
        runs = with_history(ledger, LOOKBACK_RUNS, limits.zero_streak, few_runs)
    else:
        runs = successes(ledger)
    return runs.select(
        "sync_id", *TABLE, "mode", "started_at", "finished_at",
        F.inline(F.array(*(rule(limits) for rule in rules))),
    )


def evaluate_rule(ledger: DataFrame, rule, limits: Thresholds = Thresholds()) -> DataFrame:
    return evaluate_rules(ledger, limits, (rule,))


def summarize(results: DataFrame) -> DataFrame:
    """Per run: did a rule fail, and which, and when the run ended; as many results as there are rules."""
    failed = F.when(F.col("status") == "failed", F.col("rule"))
    return results.groupBy("sync_id", *TABLE).agg(
        F.count("*").alias("rules_run"),
        F.coalesce(F.bool_or(F.col("status") == "failed"), F.lit(False)).alias("failed"),
        F.sort_array(F.collect_list(failed)).alias("failed_rules"),
        *([F.max("finished_at").alias("finished_at")] if "finished_at" in results.columns else []),
    )


def reconcile_counts(
    local: DataFrame,
    remote: DataFrame,
    by: Sequence[str] = ("resource",),
    limits: Thresholds = Thresholds(),
) -> DataFrame:
    """Active stored rows against source rows per group; each side is counted before the join."""
    ours = local.filter(is_active(local)).groupBy(*by).agg(F.count("*").alias("local_count"))
    theirs = remote.groupBy(*by).agg(F.count("*").alias("remote_count"))
    here, there = F.coalesce("local_count", F.lit(0)), F.coalesce("remote_count", F.lit(0))
    deviation = F.abs(here - there) / F.greatest(there, F.lit(1)) * 100
    return theirs.join(ours, list(by), "full_outer").select(
        *by,
        there.alias("remote_count"),
        here.alias("local_count"),
        deviation.alias("deviation_pct"),
        (deviation <= limits.count_tolerance).alias("within_tolerance"),
    )


def duplicate_keys(table: DataFrame, key: Sequence[str]) -> DataFrame:
    """All rows and distinct keys; equal when nothing is stored twice."""
    per_key = table.groupBy(*key).agg(F.count("*").alias("_n"))
    return per_key.agg(
        F.coalesce(F.sum("_n"), F.lit(0)).alias("total_rows"),
        F.count("*").alias("distinct_keys"),
        F.count_if(F.col("_n") > 1).alias("repeated_keys"),
    )


def rows_missing_fields(
    table: DataFrame, id_column: str, required: Sequence[str], limit: int = 10
) -> DataFrame:
    """Ids of up to ``limit`` rows without a required field."""
    missing = F.lit(False)
    for c in required:
        missing = missing | F.col(c).isNull()
    return table.filter(missing).select(id_column).orderBy(F.col(id_column).asc_nulls_first()).limit(limit)


def row_count_delta(ledger: DataFrame, limits: Thresholds = Thresholds()) -> DataFrame:
    """Active rows after each run against those after the run before it; a big drop is a warning.

    Full refreshes and first runs are skipped.
    """
    before, now = F.col("prev_rows"), F.col("rows_after")
    applies = before.isNotNull() & (before > 0) & (F.col("mode") != "full_refresh")
    drop = F.when(applies, (before - now) / F.greatest(before, F.lit(1)) * 100)
    status = F.when(~applies, "skipped").when(drop > limits.row_drop_warn, "warning").otherwise("ok")
    return with_history(ledger).select("sync_id", *TABLE, status.alias("status"), drop.alias("delta_pct"))


def volume_against_median(ledger: DataFrame, limits: Thresholds = Thresholds()) -> DataFrame:
    """Rows fetched by each run against the median run of the preceding days of its table.

    Days are whole UTC days, so the history of a run is shared by all runs of its day: it is a
    median over counted values, and no window over raw runs is needed.
    """
    runs = ledger.filter(F.col("status") == "success").select(
        "sync_id", *TABLE, F.to_date("started_at").alias("day"), _fetched().alias("fetched")
    )
    counted = runs.groupBy(*TABLE, "day", "fetched").agg(F.count("*").alias("n"))
    ahead = F.explode(F.sequence(F.lit(1), F.lit(limits.volume_days)))
    history = (
        counted.select(*TABLE, "fetched", "n", "day", ahead.alias("_d"))
        .withColumn("day", F.date_add("day", F.col("_d")))
        .groupBy(*TABLE, "day")
        .agg(F.sum("n").alias("samples"), F.percentile("fetched", 0.5, F.col("n")).alias("median"))
    )
    return _volume_verdict(runs.join(history, [*TABLE, "day"], "left"), limits)


def volume_against_sliding_median(
    ledger: DataFrame, limits: Thresholds = Thresholds(), rows_per_bucket: int = 200_000
) -> DataFrame:
    """Rows fetched by each run against the median run of exactly the days before its start, to the microsecond."""
    runs = ledger.filter(F.col("status") == "success").select(
        "sync_id", *TABLE, "started_at", _fetched().alias("fetched")
    )
    history = sliding_median(runs, TABLE, "started_at", "fetched", limits.volume_days, rows_per_bucket)
    renamed = history.select(*[F.col(c).alias(f"_{c}") for c in (*TABLE, "started_at")], "samples", "median")
    same = [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in TABLE] + [F.col("started_at") == F.col("_started_at")]
    return _volume_verdict(runs.join(renamed, same, "left"), limits)


def _volume_verdict(runs: DataFrame, limits: Thresholds) -> DataFrame:
    known = F.col("samples") >= limits.volume_min_samples
    odd = (F.col("fetched") < F.col("median") * limits.volume_lower) | (
        F.col("fetched") > F.col("median") * limits.volume_upper
    )
    return runs.select(
        "sync_id", *TABLE, "fetched",
        F.coalesce("samples", F.lit(0)).alias("samples"), "median",
        F.when(~F.coalesce(known, F.lit(False)), "skipped").when(odd, "warning").otherwise("ok").alias("status"),
    )


def in_domain(table: DataFrame, column: str, allowed: Sequence[str] = RESULT_STATUSES) -> DataFrame:
    """The table with ``_reject`` set where the value is none of ``allowed``; NULL is not checked."""
    bad = F.col(column).isNotNull() & ~F.col(column).isin(*allowed)
    return table.withColumn("_reject", F.when(bad, F.concat(F.lit(f"{column}="), F.col(column))))


def stuck_requests(requests: DataFrame, as_of: Column, minutes: int = 5) -> DataFrame:
    """Requests claimed for longer than ``minutes``."""
    limit = as_of - F.make_dt_interval(mins=F.lit(minutes))
    return requests.filter((F.col("status") == "claimed") & (F.col("claimed_at") < limit))


def staleness(
    seen: DataFrame, last_seen: str, as_of: Column, report_after_s: int = 120, alert_after_s: int = 7200
) -> DataFrame:
    """Age of a last sign of life, and whether it is old enough to report or to alert."""
    age = F.timestamp_diff("MICROSECOND", F.col(last_seen), as_of) / 1e6
    return (
        seen.withColumn("age_seconds", age)
        .withColumn("is_stale", F.col("age_seconds") > report_after_s)
        .withColumn("is_dead", F.col("age_seconds") > alert_after_s)
    )


def health_verdict(beats: DataFrame, last_seen: str, requests: DataFrame, as_of: Column) -> DataFrame:
    """One row: is the newest beat fresh (under two minutes), is nothing stuck, is all well."""
    age = F.timestamp_diff("MICROSECOND", F.max(last_seen), as_of) / 1e6
    beat = beats.agg(F.coalesce(age < 120, F.lit(False)).alias("heartbeat_fresh"))
    stuck = stuck_requests(requests, as_of).agg(F.count("*").alias("n")).scalar()
    return beat.withColumn("no_stuck_requests", stuck == 0).withColumn(
        "healthy", F.col("heartbeat_fresh") & F.col("no_stuck_requests")
    )
