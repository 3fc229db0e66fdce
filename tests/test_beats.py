from datetime import datetime, timedelta

import pytest

from tidemark.streaming.beats import stale_beats, timers

START = datetime(2026, 4, 1)
SCHEMA = "pipeline string, at timestamp, note string"


def test_silences_over_restarts(spark, tmp_path):
    """Every list of beats is a run of its own, which goes on from the state that the one before left."""
    runs = [
        [("a", 0), ("a", 100), ("b", 0), (None, 5), ("d", None)],
        # The watermark passes what was due of a and b, though neither has a row.
        [("c", 5000)],
        # Neither is told again when it comes back; c's silence shows in its next beat; rows of c that are late or repeated.
        [("a", 9000), ("c", 9001), ("c", 9001), ("c", 4900)],
        # a is overdue in the same run in which it comes back; all were silent for so long that b is forgotten.
        [("a", 20000), ("b", 40000)],
        [("b", 40010), ("e", 50000)],
    ]
    for number, beats in enumerate(runs):
        rows = [(k, START + timedelta(seconds=s) if s is not None else None, "x") for k, s in beats]
        spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        with timers(spark):
            job = (
                stale_beats(spark.readStream.schema(SCHEMA).parquet(str(tmp_path / "in")), after_s=3600, forget_s=10_000)
                .writeStream.format("parquet").option("path", str(tmp_path / "out"))
                .option("checkpointLocation", str(tmp_path / "state")).trigger(availableNow=True).start()
            )
        job.awaitTermination()
    found = spark.read.parquet(str(tmp_path / "out")).collect()
    assert all(r.due_at - r.last_beat == timedelta(hours=1) for r in found)
    told = sorted((r.pipeline, int((r.last_beat - START).total_seconds())) for r in found)
    assert told == [("a", 100), ("a", 9000), ("a", 20000), ("b", 0), ("b", 40010), ("c", 5000), ("c", 9001)]


def test_forgetting_comes_after_telling(spark):
    with pytest.raises(ValueError):
        stale_beats(spark.createDataFrame([], SCHEMA), after_s=10, forget_s=10)
