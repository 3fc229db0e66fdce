from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tidemark.model import Retention
from tidemark.operators import reports, retention
from tidemark.operators.ledger import duration_histogram, fold_entries
from tests.test_rules import START, ledger, run

NOW = datetime(2026, 4, 10)


@pytest.mark.parametrize(
    "status, age_s, enabled, label",
    [
        ("success", 0, False, "DISABLED"), (None, 0, True, "NEVER"), ("running", 3600, True, "RUNNING"),
        ("running", 3601, True, "RUNNING > 1h"), ("success", 9999, True, "OK"), ("failed", 1, True, "FAIL"),
        ("cancelled", 1, True, "cancelled"), (None, 0, False, "DISABLED"),
    ],
)
def test_status_label(spark, status, age_s, enabled, label):
    row = spark.createDataFrame([(status, NOW - timedelta(seconds=age_s), enabled)], "s string, t timestamp, e boolean")
    got = row.select(reports.status_label(F.col("s"), F.col("t"), F.col("e"), F.lit(NOW)).alias("l"))
    assert got.first().l == label


def test_status_report(spark):
    pipelines = spark.createDataFrame([("p", True, ["products"]), ("q", False, None)],
                                      "pipeline string, enabled boolean, disabled_resources array<string>")
    got = {(r.pipeline, r.resource): r for r in
           reports.status_report(pipelines, ledger(spark, run(0), run(1, status="failed")), F.lit(NOW)).collect()}
    assert len(got) == 10
    assert got["p", "orders"].label == "FAIL" and got["p", "orders"].records == 100
    assert got["p", "products"].label == "DISABLED" and got["p", "customers"].label == "NEVER"
    assert got["p", "customers"].records is None and got["q", "orders"].label == "DISABLED"


def test_history(spark):
    runs = ledger(spark, *(run(n, error="e" * 60 if n == 5 else None) for n in range(20)))
    got = reports.history(runs, "p", 15).collect()
    assert [r.sync_id for r in got] == [f"{n:04d}" for n in range(19, 4, -1)]
    assert got[-1].error == "e" * 40 and got[0].duration_s == 1.5
    for bad in (0, 101):
        with pytest.raises(ValueError):
            reports.history(runs, "p", bad)
    plan = reports.history(runs, "p")._jdf.queryExecution().executedPlan().toString()
    assert "TakeOrderedAndProject" in plan


def test_search_logs(spark):
    rows = [("p", ["INFO", "ERROR", "CRITICAL"][n % 3], NOW - timedelta(minutes=n), n) for n in range(300)]
    logs = spark.createDataFrame(rows, "pipeline string, level string, timestamp timestamp, n int")
    assert [r.n for r in reports.search_logs(logs, "p", NOW).collect()] == list(range(99, -1, -1))
    recent = reports.search_logs(logs, "p", NOW, errors=True, since="30m").collect()
    assert [r.n for r in recent] == [n for n in range(30, -1, -1) if n % 3]
    assert reports.search_logs(logs, "p", NOW, since="soon").count() == 100
    assert reports.search_logs(logs, "q", NOW).isEmpty()


def test_find_runs(spark):
    runs = ledger(spark, run(0, sync_id="550e8400-e29b"), run(1, sync_id="550f"))
    assert reports.find_runs(runs, "550").count() == 2 and reports.find_runs(runs, "550e").count() == 1
    for bad in ("", "%", "55_", "550E", "x" * 3, "a" * 37):
        with pytest.raises(ValueError):
            reports.find_runs(runs, bad)


def test_verdict(spark):
    def verdict(*statuses):
        rows = [("p", "orders", s, NOW - timedelta(hours=h)) for s, h in statuses]
        results = spark.createDataFrame(rows, "pipeline string, resource string, status string, created_at timestamp")
        return reports.results_verdict(reports.results_last_day(results, F.lit(NOW))).first().verdict

    assert verdict(("ok", 1), ("warning", 1), ("failed", 24)) == "failed"
    assert verdict(("ok", 1), ("warning", 1), ("failed", 25)) == "warning"
    assert verdict(("ok", 1), ("skipped", 1)) == "healthy" and verdict(("failed", 30)) == "healthy"


def test_histogram_is_cumulative(spark):
    from decimal import Decimal

    runs = ledger(spark, *(run(n, duration_seconds=Decimal(d)) for n, d in enumerate(["0.50", "1.00", "1.01", "9000"])))
    got = {r.le: r.runs for r in duration_histogram(runs).collect()}
    assert (got["1"], got["5"], got["7200"], got["+Inf"]) == (2, 3, 3, 4)


def test_fold(spark):
    entries = spark.createDataFrame(
        [("a", 1, "running", None), ("a", 2, "success", 5), ("b", 1, "running", None)],
        "sync_id string, entry_at int, status string, fetched_count int",
    )
    got = {r.sync_id: (r.status, r.fetched_count) for r in fold_entries(entries, "entry_at").collect()}
    assert got == {"a": ("success", 5), "b": ("running", None)}


def ages(spark, name, days, **constant):
    rows = spark.createDataFrame([(d,) for d in days], "d double")
    rows = rows.select("d", (F.lit(NOW) - F.make_dt_interval(secs=F.col("d").cast("decimal(18,6)") * 86400)).alias(name))
    return rows.withColumns({k: F.lit(v) for k, v in constant.items()})


@pytest.mark.parametrize(
    "column, expired, constant, limit",
    [
        ("timestamp", retention.expired_logs, {"level": "INFO"}, 90), ("timestamp", retention.expired_logs, {"level": "ERROR"}, 30),
        ("timestamp", retention.expired_logs, {"level": "CRITICAL"}, 30), ("created_at", retention.expired_results, {}, 30),
        ("started_at", retention.expired_runs, {}, 90), ("finished_at", retention.expired_requests, {"status": "done"}, 30),
        ("finished_at", retention.expired_requests, {"status": "pending"}, None),
    ],
)
def test_retention(spark, column, expired, constant, limit):
    days = [0.0, 29.0, 30.0, 30.5, 89.0, 90.0, 90.5, 1000.0]
    rows, gone = ages(spark, column, days, **constant), expired(F.lit(NOW), Retention())
    kept = retention.keep_rows(rows, gone)
    assert sorted(r.d for r in kept.collect()) == [d for d in days if limit is None or d <= limit]
    assert sum(r.expired_rows for r in retention.preview(rows, gone).collect()) == len(days) - kept.count()
    assert sum(r.expired_rows for r in retention.preview(kept, gone).collect()) == 0, "a second run removes nothing"


def test_unfinished_requests_stay(spark):
    row = spark.createDataFrame([("failed", None)], "status string, finished_at timestamp")
    assert retention.keep_rows(row, retention.expired_requests(F.lit(NOW))).count() == 1


def test_tiers(spark):
    rows = [(datetime(2026, 1, 1) + timedelta(hours=h), h) for h in range(0, 24 * 120, 6)]
    snapshots = spark.createDataFrame(rows, "at timestamp, id int")
    got = retention.keep_by_tier(snapshots, "at", "id").collect()
    tiers = {t: sorted(r.day for r in got if r.tier == t) for t in ("daily", "weekly", "monthly")}
    assert [len(v) for v in tiers.values()] == [7, 4, 4]
    assert all(d.weekday() == 6 for d in tiers["weekly"]) and all(d.day == 1 for d in tiers["monthly"])
    assert all(r.id % 24 == 18 for r in got), "the last snapshot of each day"


def test_levels(spark):
    rows = spark.createDataFrame([("debug",), ("INFO",), ("Warning",), ("odd",), (None,)], "level string")
    assert sorted(str(r.level) for r in reports.at_least(rows, "INFO").collect()) == ["INFO", "None", "Warning"]
    assert reports.at_least(rows, "unknown").count() == 3 and reports.at_least(rows, "DEBUG").count() == 5
