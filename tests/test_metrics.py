from collections import Counter
from datetime import date, datetime, timedelta
from decimal import Decimal

from tidemark.streaming.metrics import read_metrics, start_metrics_stream

START = datetime(2026, 4, 1)
SCHEMA = (
    "pipeline string, resource string, mode string, status string, started_at timestamp, upserted_count bigint, "
    "duration_seconds decimal(10,2)"
)


def test_counters_over_restarts(spark, tmp_path):
    def run(hour, status="success", upserted=2):
        at = START + timedelta(hours=hour) if hour is not None else None
        return ("p", "orders", "incremental", status, at, upserted, None if upserted is None else Decimal(1))

    runs = [
        [run(1), run(2), run(3, "failed", None), run(None)],
        [run(5), run(30)],
        # The first day is closed by the run of the fourth; what comes for it afterwards is too late.
        [run(80)],
        [run(4), run(81)],
    ]
    folder, out = str(tmp_path / "in"), str(tmp_path / "out")
    for rows in runs:
        spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(folder)
        start_metrics_stream(spark.readStream.schema(SCHEMA).parquet(folder), out, str(tmp_path / "state")).awaitTermination()
    got = read_metrics(spark, out)
    found = Counter((r.status, r.day, r.runs, r.records_upserted, int(r.seconds)) for r in got.collect())
    assert found == Counter([
        ("success", date(2026, 4, 1), 3, 6, 3), ("failed", date(2026, 4, 1), 1, 0, 0),
        ("success", date(2026, 4, 2), 1, 2, 1), ("success", date(2026, 4, 4), 2, 4, 2),
    ])
    # A batch that is written again after a crash replaces what it wrote.
    last = max(int(p.name[6:]) for p in (tmp_path / "out").iterdir() if p.name.startswith("batch="))
    before = spark.read.parquet(f"{out}/batch={last}").collect()
    spark.createDataFrame(before, spark.read.parquet(f"{out}/batch={last}").schema).write.mode("overwrite").parquet(f"{out}/batch={last}")
    assert Counter((r.status, r.day, r.runs, r.records_upserted, int(r.seconds)) for r in read_metrics(spark, out).collect()) == found


def test_parts_of_the_state_have_tasks_of_their_own(spark, tmp_path):
    folder = str(tmp_path / "in")
    rows = [("p", f"r{n}", "incremental", "success", START, 1, Decimal(1)) for n in range(50)]
    spark.createDataFrame(rows, SCHEMA).coalesce(1).write.parquet(folder)
    arriving = spark.readStream.schema(SCHEMA).parquet(folder)
    job = start_metrics_stream(arriving, str(tmp_path / "out"), str(tmp_path / "state"))
    job.awaitTermination()
    tracker = spark.sparkContext.statusTracker()
    stages = [s for j in tracker.getJobIdsForGroup(str(job.runId)) for s in tracker.getJobInfo(j).stageIds]
    found = [tracker.getStageInfo(s) for s in stages]
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert parts in [s.numTasks for s in found if s], "a task for each part"
    assert read_metrics(spark, str(tmp_path / "out")).count() == 50
