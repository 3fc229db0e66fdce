import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tidemark.operators import alerts as A
from tidemark.streaming.alerts import dedupe_alert_stream

START = datetime(2026, 4, 1)
SCHEMA = "alert_id bigint, pipeline string, key string, at timestamp_ntz"


def frame(spark, rows):
    return spark.createDataFrame(
        [(n, p, k, START + timedelta(seconds=s)) for n, (p, k, s) in enumerate(rows)], SCHEMA
    )


def brute_force(rows):
    """One alert after the other, with the whole memory."""
    last, recent, sent = {}, {}, []
    for pipeline, key, second in rows:
        hour = [t for t in recent.get(pipeline, []) if second - t < 3600]
        quiet = key in last and second - last[key] < 300
        ok = not key or (not quiet and len(hour) < 3)
        if ok and key:
            last[key] = second
            recent[pipeline] = hour + [second]
        sent.append(ok)
    return sent


def sent(result):
    return [r.sent for r in sorted(result.collect(), key=lambda r: r.alert_id)]


CASES = {
    "repeat inside five minutes": ([("p", "a", 0), ("p", "a", 299)], [True, False]),
    "repeat after five minutes": ([("p", "a", 0), ("p", "a", 300)], [True, True]),
    "fourth within the hour": ([("p", k, n) for n, k in enumerate("abcd")], [True, True, True, False]),
    "fourth after the hour": ([("p", "a", 0), ("p", "b", 1), ("p", "c", 2), ("p", "d", 3600)], [True] * 4),
    "other pipeline": ([("p", k, 0) for k in "abcd"] + [("q", "e", 0)], [True, True, True, False, True]),
    "suppressed leaves no trace": ([("p", "a", 0), ("p", "a", 200), ("p", "a", 300)], [True, False, True]),
    "empty key": ([("p", "", 0)] * 5 + [("p", "a", 0)], [True] * 6),
}


@pytest.mark.parametrize("name", CASES)
def test_rules(spark, name):
    rows, expected = CASES[name]
    assert brute_force(rows) == expected
    assert sent(A.dedupe_alerts(frame(spark, rows))) == expected


def random_alerts(n=600, seed=3):
    rng, second, rows = random.Random(seed), 0, []
    for _ in range(n):
        second += rng.choice([0, 1, 10, 100, 900])
        pipeline = rng.choice("ppppq")
        rows.append((pipeline, rng.choice(["", *(f"{pipeline}{k}" for k in range(5))]), second))
    return rows


@pytest.mark.parametrize("slice_rows", [90, 250, 10**6])
def test_slices_give_the_same_result(spark, slice_rows):
    rows = random_alerts()
    assert sent(A.dedupe_alerts(frame(spark, rows), slice_rows=slice_rows)) == brute_force(rows)


def test_a_task_holds_a_batch_of_a_slice(spark, monkeypatch):
    def make_bounded(*limits, make=A.make_replay):
        replay = make(*limits)

        def bounded(times, keys, sends):
            if len(times) > 40:
                raise ValueError("more than a batch")
            return replay(times, keys, sends)

        return bounded

    monkeypatch.setattr(A, "make_replay", make_bounded)
    rows = random_alerts()
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 40)
    try:
        for slice_rows in (250, 10**6):
            assert sent(A.dedupe_alerts(frame(spark, rows), slice_rows=slice_rows)) == brute_force(rows)
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_a_minute_can_be_cut(spark):
    rows = [("p", f"k{n % 7}", n / 10) for n in range(200)] + [("p", "k1", 400 + n / 10) for n in range(50)]
    assert sent(A.dedupe_alerts(frame(spark, rows), slice_rows=80)) == brute_force(rows)


def test_stream_remembers_sends_between_batches(spark, tmp_path):
    import time

    rows = random_alerts(200)
    alerts = frame(spark, rows)
    for part in range(4):
        chunk = alerts.filter((F.col("alert_id") >= part * 50) & (F.col("alert_id") < part * 50 + 50))
        chunk.coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        time.sleep(1.1)  # files are read in the order of their times
    stream = spark.readStream.schema(alerts.schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    job = (
        dedupe_alert_stream(stream).writeStream.format("parquet").option("path", str(tmp_path / "out"))
        .option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start()
    )
    job.awaitTermination()
    assert len(job.recentProgress) >= 4
    assert sent(spark.read.parquet(str(tmp_path / "out"))) == brute_force(rows)


def test_alert_texts(spark):
    from tests.test_rules import ledger, run

    error = "bad `token` *x* y_z " + "e" * 400
    row = A.alerts_of_failed_runs(ledger(spark, run(0, status="failed", error=error, sync_id="abcdefghij"))).first()
    assert row.key == "sync_fail:p:orders"
    body = row.text.split("Error: ")[1].split("\nRun: ")
    assert body[0] == ("bad 'token' x y z " + "e" * 400)[: 300 - 2] and body[1] == "abcdefgh"
    beats = spark.createDataFrame([(START - timedelta(hours=2.5),), (START - timedelta(hours=2),)], "b timestamp")
    stale = A.alerts_of_stale_beats(beats, "b", F.lit(START)).collect()
    assert len(stale) == 1 and "(2.5h ago)" in stale[0].text and stale[0].pipeline == "__system__"
