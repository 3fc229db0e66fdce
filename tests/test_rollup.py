from datetime import datetime, timedelta
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tidemark.operators.ledger import daily_rollup
from tidemark.sinks.rollup import RollupView

START = datetime(2026, 4, 1)
SCHEMA = (
    "sync_id string, pipeline string, resource string, mode string, trigger string, status string, "
    "finished_at timestamp_ntz, duration_seconds decimal(10,2), fetched_count int, upserted_count int"
)


def run(i, hours, seconds=1, fetched=3, status="success", trigger="schedule"):
    at = None if hours is None else START + timedelta(hours=hours)
    return (f"s{i}", "p", "orders", "incremental", trigger, status, at, seconds and Decimal(seconds), fetched, fetched)


def signed(spark, rows, sign=1):
    return spark.createDataFrame(rows, SCHEMA).withColumn("_sign", F.lit(sign))


def rows_of(frame):
    return sorted((tuple(r[c] for c in sorted(frame.columns)) for r in frame.collect()), key=repr)


def recomputed(spark, rows):
    return rows_of(daily_rollup(spark.createDataFrame(rows, SCHEMA)))


def test_refreshes_equal_a_full_rollup(spark, tmp_path):
    view = RollupView(spark, str(tmp_path / "view"))
    with pytest.raises(LookupError):
        view.read()
    first = [run(i, i % 72, seconds=(i * 37) % 11 + 1) for i in range(200)]
    odd = [run(300, 1, None, None), run(301, None), run(302, 2, trigger="manual"), run(303, 90, None, None, "failed")]
    assert len(view.refresh(signed(spark, first + odd), "a")) == 5
    assert rows_of(view.read()) == recomputed(spark, first + odd)
    # One run of one day is put right: only that day is opened and written.
    before = {f.day: f.folder for f in view.versions.read().collect() if f.day}
    wrong, right = first[10], run(10, 10, 500, 9, "failed")
    assert view.refresh(signed(spark, [wrong], -1).unionByName(signed(spark, [right])), "b") == ["2026-04-01"]
    after = {f.day: f.folder for f in view.versions.read().collect() if f.day}
    assert {d for d in after if after[d] != before[d]} == {"2026-04-01"}
    now = [r for r in first if r != wrong] + odd + [right]
    assert rows_of(view.read()) == recomputed(spark, now)
    # A refresh that is repeated changes nothing, one with unfinished runs only neither.
    assert view.refresh(signed(spark, [right]), "b") == []
    assert view.refresh(signed(spark, [run(400, None)]), "c") == []
    assert rows_of(view.read()) == recomputed(spark, now)
    # A day that loses its last run is no day of the rollup any more.
    assert view.refresh(signed(spark, [odd[3]], -1), "d") == ["2026-04-05"]
    assert rows_of(view.read()) == recomputed(spark, [r for r in now if r != odd[3]])


def test_a_refresh_that_dies_leaves_the_view(spark, tmp_path, monkeypatch):
    view = RollupView(spark, str(tmp_path / "view"))
    view.refresh(signed(spark, [run(1, 1)]), "a")
    monkeypatch.setattr(view.versions, "publish", lambda *a: (_ for _ in ()).throw(OSError("lost")))
    with pytest.raises(OSError):
        view.refresh(signed(spark, [run(2, 1), run(3, 50)]), "b")
    again = RollupView(spark, str(tmp_path / "view"))
    assert rows_of(again.read()) == recomputed(spark, [run(1, 1)])
    again.refresh(signed(spark, [run(2, 1), run(3, 50)]), "b")
    assert rows_of(again.read()) == recomputed(spark, [run(1, 1), run(2, 1), run(3, 50)])
