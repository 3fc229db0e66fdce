from datetime import datetime, timezone

import pytest
from pyspark.sql import functions as F

from tidemark.model import CHECKPOINT_SCHEMA
from tidemark.operators.cursor import load_checkpoint, merge_checkpoints, replay_cursor, watermark
from tidemark.sources.incremental import Cursor, overlap_scan, read_incremental

UTC = timezone.utc
SCHEMA = "id bigint, updated_at timestamp"


def t(minute, second=0, hour=10):
    return datetime(2026, 4, 1, hour, minute, second, tzinfo=UTC)


def rows(spark, *pairs):
    return spark.createDataFrame(list(pairs), SCHEMA)


def ids(frame):
    return sorted((r.id for r in frame.collect()), key=lambda i: (i is None, i))


def test_watermark_takes_the_higher_id_of_equal_times(spark):
    top = watermark(rows(spark, (7, t(1)), (9, t(1)), (50, t(0)), (99, None))).first()
    assert top.last_id == 9


def test_watermark_reads_a_missing_id_as_zero(spark):
    assert watermark(rows(spark, (None, t(1)))).first().last_id == 0


@pytest.mark.parametrize("pairs", [[], [(1, None), (2, None)]])
def test_no_watermark(spark, pairs):
    assert watermark(rows(spark, *pairs)).isEmpty()


def test_reads_behind_the_cursor_only(spark):
    data = rows(spark, (1, t(0)), (5, t(10)), (6, t(10)), (None, t(10)), (2, t(11)), (3, None))
    assert ids(read_incremental(data, Cursor(t(10), 5))) == [2, 3, 6]
    assert ids(read_incremental(data, None)) == [1, 2, 3, 5, 6, None]


def test_late_rows_of_the_overlap(spark):
    data = rows(spark, (1, t(4, 59)), (2, t(5)), (3, t(9)), (4, t(11)))
    assert ids(read_incremental(data, Cursor(t(10), 0))) == [4]
    assert ids(read_incremental(data, Cursor(t(10), 0), late_rows="reprocess")) == [2, 3, 4]
    assert ids(overlap_scan(data, Cursor(t(10), 0))) == [2, 3, 4]
    with pytest.raises(ValueError):
        read_incremental(data, Cursor(t(10), 0), late_rows="maybe")


@pytest.mark.parametrize("bucket_rows", [1, 2, 3, 1000])
def test_replay_keeps_strict_maxima_in_arrival_order(spark, bucket_rows):
    arrived = [(1, t(1)), (2, t(1)), (2, t(1)), (9, t(0)), (3, None), (1, t(2)), (0, t(2)), (None, t(3)), (4, t(3))]
    frame = spark.createDataFrame(
        [("r", n, i, ts) for n, (i, ts) in enumerate(arrived)], "r string, n bigint, " + SCHEMA
    )
    kept = [r.n for r in replay_cursor(frame, ["r"], "n", bucket_rows=bucket_rows).orderBy("n").collect()]
    assert kept == brute_force_replay(arrived, None)
    started = replay_cursor(frame, ["r"], "n", Cursor(t(1), 1), bucket_rows=bucket_rows)
    assert [r.n for r in started.orderBy("n").collect()] == brute_force_replay(arrived, (t(1), 1))


def brute_force_replay(arrived, cursor):
    kept = []
    for n, (i, ts) in enumerate(arrived):
        position = (ts, i or 0)
        if ts is not None:
            if cursor is not None and position <= cursor:
                continue
            cursor = position
        kept.append(n)
    return kept


def checkpoint(spark, ts, last_id=5):
    return spark.createDataFrame([("p", "orders", ts, last_id, "old", t(0), "success")], CHECKPOINT_SCHEMA)


@pytest.mark.parametrize(
    "stored, new, expected",
    [((t(5), 5), (t(4), 9), (t(5), 5)), ((t(5), 5), (t(5), 1), (t(5), 1)), ((t(5), 5), (t(6), 1), (t(6), 1))],
)
def test_checkpoint_is_not_set_back(spark, stored, new, expected):
    top = spark.createDataFrame(
        [("p", "orders", *new)], "pipeline string, resource string, last_updated_at timestamp, last_id bigint"
    )
    merged = merge_checkpoints(checkpoint(spark, *stored), top, "new", F.lit(t(9)))
    assert load_checkpoint(merged, "p", "orders") == Cursor(*expected)
    assert merged.count() == 1


def test_checkpoint_is_kept_without_a_watermark(spark):
    none = spark.createDataFrame([], "pipeline string, resource string, last_updated_at timestamp, last_id bigint")
    merged = merge_checkpoints(checkpoint(spark, t(5)), none, "new", F.lit(t(9)))
    assert load_checkpoint(merged, "p", "orders") == Cursor(t(5), 5)


def test_no_checkpoint(spark):
    assert load_checkpoint(checkpoint(spark, t(5)), "p", "products") is None
    assert load_checkpoint(checkpoint(spark, None), "p", "orders") is None
    assert load_checkpoint(checkpoint(spark, t(5), None), "p", "orders") == Cursor(t(5), 0)
