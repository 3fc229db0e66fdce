"""Properties of the physical plans that matter for big tables."""

from datetime import datetime
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from tidemark.operators.ledger import latest_runs, with_history
from tidemark.operators.marts import sales_rank
from tidemark.plans import catalog
from tidemark.plans.inputs import ledger, table
from tidemark.scratch import scratch_folder
from tidemark.sources.incremental import Cursor, overlap_scan, read_incremental

FOLDER = "/root/testdata/sf0.001"
CURSOR = Cursor(datetime(2024, 1, 15), 7)


def plan(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("late_rows", ["drop", "reprocess"])
def test_cursor_bound_reaches_the_scan(spark, late_rows):
    events = table(spark, FOLDER, "events")
    for frame in (
        overlap_scan(events, CURSOR, ts="ts"),
        read_incremental(events, CURSOR, "ts", "event_id", late_rows),
    ):
        assert "GreaterThanOrEqual(ts,2024-01-1" in plan(frame).split("PushedFilters:")[1]


def test_only_needed_columns_are_read(spark):
    counts = latest_runs(ledger(spark, FOLDER)).select("sync_id", "status")
    assert "value" not in plan(counts).split("ReadSchema:")[1] and "props" not in plan(counts).split("ReadSchema:")[1]


def test_top_rows_are_limited_before_the_shuffle(spark):
    items = table(spark, FOLDER, "part").select(F.col("p_partkey").alias("i"), "p_brand")
    lines = table(spark, FOLDER, "lineitem").select(F.col("l_partkey").alias("i"), F.col("l_quantity").alias("q"))
    for frame in (latest_runs(ledger(spark, FOLDER)), sales_rank(lines, items, "i", "q", "p_brand", 3)):
        assert "Partial" in plan(frame).split("WindowGroupLimit")[2]


def test_history_windows_are_cut_by_time(spark):
    text = plan(with_history(ledger(spark, FOLDER)))
    windows = [w for w in text.split("\n") if " Window [" in w and "sync_id" in w]
    assert windows and all("_bucket" in w for w in windows)


@pytest.mark.parametrize("name", sorted(set(catalog.QUERIES) - {"sync_job", "stream_upsert", "stream_logs", "stream_alert_dedup"}))
def test_no_query_multiplies_tables(spark, name):
    text = plan(catalog.QUERIES[name](spark, FOLDER))
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text


@pytest.mark.parametrize("shared, start", [("/shared/cp/", "/shared/cp/x-"), (None, "/")])
def test_scratch_folder_is_the_sessions(shared, start):
    session = SimpleNamespace(
        conf=SimpleNamespace(get=lambda key, default: shared if key == "spark.checkpoint.dir" else default),
        sparkContext=SimpleNamespace(getCheckpointDir=lambda: None, master="local[2]"),
    )
    assert scratch_folder(session, "x").startswith(start) and scratch_folder(session, "x") != scratch_folder(session, "x")


def test_scratch_folder_honours_the_contexts_folder_and_refuses_local_ones_on_clusters():
    conf = SimpleNamespace(get=lambda key, default: default)
    context = SimpleNamespace(getCheckpointDir=lambda: "hdfs://x/cp", master="yarn")
    assert scratch_folder(SimpleNamespace(conf=conf, sparkContext=context), "y").startswith("hdfs://x/cp/y-")
    context.getCheckpointDir = lambda: None
    with pytest.raises(ValueError, match="share"):
        scratch_folder(SimpleNamespace(conf=conf, sparkContext=context), "y")
