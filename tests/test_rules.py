import random
from datetime import datetime, timedelta
from decimal import Decimal

import pytest

from tidemark.model import LEDGER_SCHEMA, Thresholds
from tidemark.operators import ledger as L
from tidemark.operators import rules

START = datetime(2026, 4, 1)
COLUMNS = [c.strip().split(" ")[0] for c in LEDGER_SCHEMA.replace("decimal(10,2)", "decimal").split(",")]


def run(n, mode="incremental", fetched=100, upserted=None, before=100, status="success", hours=1, **more):
    at = START + timedelta(hours=n * hours)
    values = {
        "sync_id": f"{n:04d}", "pipeline": "p", "resource": "orders", "mode": mode, "trigger": "schedule",
        "started_at": at, "finished_at": at, "status": status, "fetched_count": fetched,
        "upserted_count": fetched if upserted is None else upserted, "rows_before": before,
        "rows_after": before, "duration_seconds": Decimal("1.50"), **more,
    }
    return tuple(values.get(c) for c in COLUMNS)


def ledger(spark, *runs):
    return spark.createDataFrame(list(runs), LEDGER_SCHEMA)


def statuses(spark, rule, *runs, **kwargs):
    results = rules.evaluate_rule(ledger(spark, *runs), rule, **kwargs)
    return [r.status for r in results.orderBy("sync_id").collect()]


@pytest.mark.parametrize(
    "fetched, upserted, status",
    [(100, 99, "ok"), (1000, 989, "failed"), (100, 100, "ok"), (0, 0, "ok"), (100, 101, "ok"), (None, None, "ok")],
)
def test_parity(spark, fetched, upserted, status):
    assert statuses(spark, rules.fetch_upsert_parity, run(0, fetched=fetched, upserted=upserted)) == [status]


def test_third_silent_run_is_a_warning(spark):
    silent = [run(n, fetched=0) for n in range(4)]
    assert statuses(spark, rules.volume_sanity, *silent) == ["ok", "ok", "warning", "warning"]
    mixed = [run(0, fetched=0), run(1, fetched=None), run(2, fetched=0), run(3, "full_refresh", fetched=0)]
    assert statuses(spark, rules.volume_sanity, *mixed) == ["ok", "ok", "warning", "skipped"]


def test_failed_runs_are_neither_checked_nor_history(spark):
    runs = [run(0, fetched=0), run(1, fetched=5, status="failed"), run(2, fetched=0), run(3, fetched=0)]
    assert statuses(spark, rules.volume_sanity, *runs) == ["ok", "ok", "warning"]


@pytest.mark.parametrize(
    "before, now, status",
    [(100, 105, "ok"), (100, 106, "warning"), (100, 120, "warning"), (100, 121, "failed"), (100, 110, "warning"),
     (100, 79, "failed"), (0, 0, "ok"), (None, 1, "failed")],
)
def test_drift(spark, before, now, status):
    runs = [run(0, "full_refresh", before), run(1, "incremental", 1), run(2, "full_refresh", now)]
    assert statuses(spark, rules.weekly_full_drift, *runs) == ["skipped", "skipped", status]


def test_drift_looks_back_seven_runs(spark):
    near = [run(0, "full_refresh")] + [run(n) for n in range(1, 7)] + [run(7, "full_refresh")]
    far = [run(0, "full_refresh")] + [run(n) for n in range(1, 8)] + [run(8, "full_refresh")]
    assert statuses(spark, rules.weekly_full_drift, *near)[-1] == "ok"
    assert statuses(spark, rules.weekly_full_drift, *far)[-1] == "skipped"


@pytest.mark.parametrize(
    "before, fetched, status", [(100, 95, "ok"), (100, 94, "failed"), (0, 0, "ok"), (0, 10, "ok"), (None, 1, "ok")]
)
def test_soft_delete(spark, before, fetched, status):
    runs = run(0, "full_refresh", fetched, before=before)
    assert statuses(spark, rules.soft_delete_sanity, runs) == [status]
    assert statuses(spark, rules.soft_delete_sanity, run(0)) == ["skipped"]


def test_thresholds_are_arguments(spark):
    strict = Thresholds(parity_max_skip=0.0)
    assert statuses(spark, rules.fetch_upsert_parity, run(0, upserted=99), limits=strict) == ["failed"]


def test_details_and_summary(spark):
    runs = [run(0, "full_refresh", 80, upserted=70)]
    results = rules.evaluate_rules(ledger(spark, *runs))
    details = {r.rule: r.details for r in results.collect()}
    assert details["fetch_upsert_parity"] == '{"fetched":80,"upserted":70,"skipped_pct":12.5}'
    assert details["volume_sanity"] == "{}"
    assert details["soft_delete_sanity"].startswith('{"delete_pct":20.0,"action":')
    summary = rules.summarize(results).first()
    assert summary.failed and summary.failed_rules == ["fetch_upsert_parity", "soft_delete_sanity"]


def random_ledger(seed=1, n=300):
    rng = random.Random(seed)
    runs = []
    for i in range(n):
        at = START + timedelta(minutes=rng.choice([1, 5, 60, 3000]) * i)
        runs.append(
            run(i, rng.choice(["incremental", "full_refresh"]), rng.choice([0, 0, 10, 50, None]),
                status=rng.choice(["success", "success", "failed"]), started_at=at,
                resource=rng.choice(["orders", "orders", "products"]))
        )
    return runs


@pytest.mark.parametrize("rows_per_bucket", [1, 4, 1000])
def test_history_does_not_depend_on_the_buckets(spark, rows_per_bucket):
    runs = random_ledger()
    columns = ["prev_count", "prev_zeros", "prev_full_fetched", "prev_rows"]
    got = L.with_history(ledger(spark, *runs), rows_per_bucket=rows_per_bucket)
    got = {r.sync_id: tuple(r[c] for c in columns) for r in got.collect()}
    previous = L.previous_runs(ledger(spark, *runs), rows_per_bucket=rows_per_bucket)
    previous = {r.sync_id: r.previous for r in previous.collect()}

    rows = [dict(zip(COLUMNS, r)) for r in runs if r[COLUMNS.index("status")] == "success"]
    rows.sort(key=lambda r: (r["started_at"], r["sync_id"]))
    assert len(got) == len(rows) == len(previous)
    for i, row in enumerate(rows):
        past = [r for r in rows[:i] if r["resource"] == row["resource"]][::-1][:7]
        full = next((r["fetched_count"] or 0 for r in past if r["mode"] == "full_refresh"), None)
        zeros = sum(1 for r in past[:2] if not r["fetched_count"])
        assert got[row["sync_id"]] == (len(past), zeros, full, past[0]["rows_after"] if past else None)
        assert previous[row["sync_id"]] == [r["sync_id"] for r in past]


def test_few_runs_give_the_same_results(spark):
    runs = ledger(spark, *random_ledger(n=40))
    last = L.recent_runs(runs, "p", "orders")
    newest = last.first().sync_id
    assert last.count() == 8
    few = rules.evaluate_rules(last, few_runs=True).filter(f"sync_id = '{newest}'")
    full = rules.evaluate_rules(runs).filter(f"sync_id = '{newest}'")
    assert sorted(few.collect()) == sorted(full.collect())


def test_volume_against_median(spark):
    runs = [run(n, fetched=f, hours=24) for n, f in enumerate([100, 100, 120, 400, 15, 100])]
    got = rules.volume_against_median(ledger(spark, *runs)).orderBy("sync_id").collect()
    assert [r.status for r in got] == ["skipped", "skipped", "skipped", "warning", "warning", "ok"]
    assert got[3].median == 100.0 and got[3].samples == 3


def test_row_count_delta(spark):
    runs = [run(0, rows_after=100), run(1, rows_after=90), run(2, rows_after=80), run(3, "full_refresh", rows_after=1)]
    got = rules.row_count_delta(ledger(spark, *runs)).orderBy("sync_id").collect()
    assert [r.status for r in got] == ["skipped", "ok", "warning", "skipped"]


def test_reconcile(spark):
    remote = spark.createDataFrame([("orders",)] * 1000 + [("products",)] * 10, "resource string")
    local = spark.createDataFrame([("orders", None)] * 999 + [("orders", START), ("locations", None)],
                                  "resource string, _deleted_at timestamp")
    got = {r.resource: r for r in rules.reconcile_counts(local, remote).collect()}
    assert got["orders"].within_tolerance and got["orders"].deviation_pct == 0.1
    assert not got["products"].within_tolerance and got["products"].deviation_pct == 100.0
    assert got["locations"].deviation_pct == 100.0, "no division by zero"


def test_required_fields(spark):
    table = spark.createDataFrame([(n, None if n % 2 else "x") for n in range(40)], "id bigint, created_at string")
    assert [r.id for r in rules.rows_missing_fields(table, "id", ["id", "created_at"]).collect()] == list(range(1, 20, 2))


def test_ledger_entries(spark):
    started = ledger(spark, run(0, status="running"), run(1, status="running"))
    again = L.record_starts(started, ledger(spark, run(0, status="other"), run(2, status="running")))
    assert sorted((r.sync_id, r.status) for r in again.collect()) == [
        ("0000", "running"), ("0001", "running"), ("0002", "running")]
    done = spark.createDataFrame([("0001", "success", None), ("9999", "success", None)],
                                 "sync_id string, status string, error string")
    got = {r.sync_id: r.status for r in L.record_finishes(started, done).collect()}
    assert got == {"0000": "running", "0001": "success"}


def test_health(spark):
    from pyspark.sql import functions as F

    def check(age_s, claimed_s):
        beats = spark.createDataFrame([(START - timedelta(seconds=age_s),)], "last_beat timestamp")
        asked = spark.createDataFrame([("claimed", START - timedelta(seconds=claimed_s))], "status string, claimed_at timestamp")
        return tuple(rules.health_verdict(beats, "last_beat", asked, F.lit(START)).first())

    assert check(119, 300) == (True, True, True)
    assert check(120, 300) == (False, True, False)
    assert check(0, 301) == (True, False, False)
    none = spark.createDataFrame([], "last_beat timestamp")
    asked = spark.createDataFrame([], "status string, claimed_at timestamp")
    assert rules.health_verdict(none, "last_beat", asked, F.lit(START)).first().healthy is False
