import random
from datetime import datetime, timedelta

from tidemark.operators.rules import evaluate_rules
from tidemark.streaming.rules import RuleStream

START = datetime(2026, 4, 1)
SCHEMA = (
    "sync_id string, pipeline string, resource string, mode string, status string, started_at timestamp_ntz, "
    "finished_at timestamp_ntz, fetched_count bigint, upserted_count bigint, rows_before bigint, rows_after bigint"
)


def a_run(rng, i, minutes):
    at = START + timedelta(minutes=minutes)
    fetched = rng.choice((0, 0, 10, 14, 100))
    return (
        f"s{i}", f"p{rng.randrange(2)}", "orders", rng.choice(("incremental", "full_refresh")),
        rng.choice(("success", "success", "success", "failed")), at, at + timedelta(seconds=5), fetched,
        max(fetched - rng.randrange(2), 0), 100, fetched,
    )


def judged(frame):
    return sorted((r.sync_id, r.rule, r.status, r.percent, r.details) for r in frame.collect())


def feed(spark, tmp_path, stream, batches, name="in"):
    folder = str(tmp_path / name)
    for rows in batches:
        spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(folder)
        stream.start(spark.readStream.schema(SCHEMA).parquet(folder), str(tmp_path / "check")).awaitTermination()


def test_equals_the_rules_of_the_whole_ledger(spark, tmp_path):
    """Runs come up to an hour out of order, some twice, over restarts; a last run an hour on lets all of them go."""
    rng = random.Random(5)
    runs = [a_run(rng, i, 10 * i) for i in range(60)]
    order = sorted(runs, key=lambda r: (r[5] + timedelta(minutes=rng.randrange(50)), r[0]))
    batches = [order[:20], order[15:35], order[35:]]
    last = ("end", "p9", "orders", "incremental", "success", START + timedelta(minutes=700), None, 1, 1, 1, 1)
    none = [(None if i == 1 else "x", None if i == 1 else "p0", "orders", "incremental", "success",
             None if i == 5 else START, None, 1, 1, 1, 1) for i in (1, 5)]
    stream = RuleStream(spark, str(tmp_path / "out"), late_s=3600)
    feed(spark, tmp_path, stream, [*batches, [last], none])
    expected = judged(evaluate_rules(spark.createDataFrame(runs, SCHEMA)))
    assert [r for r in judged(stream.results()) if r[0] != "end"] == expected


def test_a_run_that_is_too_late_and_a_repeated_batch(spark, tmp_path):
    rng = random.Random(6)
    run = lambda i, at, fetched: (
        f"s{i}", "p", "orders", "full_refresh", "success", START + timedelta(hours=at), None, fetched, fetched, 100, 100
    )
    stream = RuleStream(spark, str(tmp_path / "out"))
    feed(spark, tmp_path, stream, [[run(1, 1, 100), run(2, 3, 100)], [run(3, 2, 50)]])
    # The late run is compared with the one before it; the one after it keeps its result.
    drift = {r.sync_id: (r.status, r.percent) for r in stream.results().filter("rule = 'weekly_full_drift'").collect()}
    assert drift == {"s1": ("skipped", None), "s2": ("ok", 0.0), "s3": ("failed", 50.0)}
    before = judged(stream.results())
    stream.save(spark.createDataFrame([run(3, 2, 50)], SCHEMA).select(*[c.split()[0] for c in SCHEMA.split(", ")]), 1)
    assert judged(stream.results()) == before
