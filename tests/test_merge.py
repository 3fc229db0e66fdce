from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tidemark.model import RESOURCES, resource
from tidemark.operators.merge import active_rows, count_active, guarded_sweep, latest_per_key, sweep, upsert
from tidemark.operators.rules import duplicate_keys

NOW = datetime(2026, 4, 1)
STATE = "id bigint, updated_at timestamp, _raw string, _deleted_at timestamp, _sync_id string"


def state(spark, *rows):
    return spark.createDataFrame(list(rows), STATE)


def by_id(frame):
    return {r.id: r for r in frame.collect()}


def test_upsert_replaces_inserts_and_revives(spark):
    old = state(spark, (1, NOW, "a", None, "x"), (2, NOW, "b", NOW, "x"), (3, NOW, "c", NOW, "x"))
    new = spark.createDataFrame(
        [(2, datetime(2020, 1, 1), "older"), (4, NOW, "d"), (None, NOW, "no key")],
        "id bigint, updated_at timestamp, _raw string",
    ).withColumn("_sync_id", F.lit("y"))
    got = by_id(upsert(old, new, ["id"]))
    assert sorted(got) == [1, 2, 3, 4]
    assert got[2]._raw == "older" and got[2]._deleted_at is None, "an older record wins, and is active again"
    assert got[3]._deleted_at is not None and got[4]._sync_id == "y"


def test_upsert_twice_changes_nothing(spark):
    new = state(spark, (1, NOW, "a", None, "y"), (1, datetime(2027, 1, 1), "b", None, "y"))
    once = upsert(state(spark), new, ["id"], ["updated_at"])
    twice = upsert(once, new, ["id"], ["updated_at"])
    assert once.collect() == twice.collect() and once.first()._raw == "b"


def test_empty_upsert(spark):
    old = state(spark, (1, NOW, "a", None, "x"))
    assert upsert(old, state(spark), ["id"], ["updated_at"]).collect() == old.collect()


def test_composite_key(spark):
    schema = "item bigint, place bigint, updated_at timestamp, n int"
    rows = spark.createDataFrame([(1, 1, NOW, 1), (1, 2, NOW, 2), (1, 1, None, 3)], schema)
    merged = upsert(rows.limit(0), rows, ["item", "place"], ["updated_at"])
    assert sorted((r.item, r.place, r.n) for r in merged.collect()) == [(1, 1, 1), (1, 2, 2)]
    assert duplicate_keys(merged, ["item", "place"]).first().repeated_keys == 0


def test_hot_key_is_reduced_before_the_shuffle(spark):
    rows = spark.range(30_000).select(
        F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("k"), F.col("id").alias("v")
    )
    newest = latest_per_key(rows, ["k"], ["v"])
    plan = newest._jdf.queryExecution().executedPlan().toString()
    assert "row_number(), 1, Partial" in plan and "row_number(), 1, Final" in plan
    assert newest.filter("k = 0").first().v == 29_997


def test_sweep_leaves_touched_deleted_and_unmarked_rows(spark):
    earlier = datetime(2025, 1, 1)
    table = state(
        spark, (1, NOW, "", None, "cur"), (2, NOW, "", None, "old"), (3, NOW, "", earlier, "old"), (4, NOW, "", None, None)
    )
    got = by_id(sweep(table, "cur", F.lit(NOW)))
    assert got[1]._deleted_at is None and got[2]._deleted_at == NOW
    assert got[3]._deleted_at == earlier and got[4]._deleted_at is None
    assert by_id(sweep(table, "cur", F.lit(NOW), sweep_unmarked=True))[4]._deleted_at == NOW
    plain = table.drop("_deleted_at")
    assert sweep(plain, "cur", F.lit(NOW)) is plain and active_rows(plain).count() == 4


@pytest.mark.parametrize(
    "total, missing, swept",
    [(21, 1, 1), (20, 1, 1), (5, 2, 0), (100, 5, 5), (100, 6, 0), (0, 0, 0)],
)
def test_guard(spark, total, missing, swept):
    table = state(spark, *((n, NOW, "", None, "old" if n < missing else "cur") for n in range(total)))
    got = guarded_sweep(table, F.lit(total - missing), "cur", F.lit(NOW))
    assert got.filter("_deleted_at IS NOT NULL").count() == swept
    assert count_active(got).first().active_rows == total - swept


def test_resources():
    assert RESOURCES["inventory_levels"].key == ("inventory_item_id", "location_id")
    assert "_deleted_at" not in RESOURCES["inventory_levels"].state_schema.names
    assert not RESOURCES["orders"].state_schema["updated_at"].nullable
    with pytest.raises(ValueError, match="unknown resource"):
        resource("invoices")
