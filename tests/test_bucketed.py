"""Bucketed state tables, what changes between their versions, and tables kept up to date from that."""

import random
import re
from collections import Counter
from datetime import datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

from tidemark.model import RESOURCES
from tidemark.operators.feed import refreshed_groups, refreshed_sums, signed_rows
from tidemark.plans.sync import SyncSpec, Warehouse, run_sync
from tidemark.sinks.bucketed import BucketedTable
from tidemark.sinks.versions import WriterConflict

START = datetime(2026, 4, 1, tzinfo=timezone.utc)


def rows_of(spark, ids, raw):
    return spark.createDataFrame([(i, raw) for i in ids], "id bigint, _raw string").withColumn("updated_at", F.lit(START))


def new_table(spark, tmp_path, resource="orders", buckets=8):
    return BucketedTable(spark, str(tmp_path / "t"), RESOURCES[resource], buckets)


def merge(table, sync_id, ids, **options):
    return table.merge(rows_of(table.spark, ids, sync_id), sync_id, F.lit(START), **options)


def stored(table, version=None):
    return {r.id: r._raw for r in table.read(version).collect()}


def plan(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


def test_merges_equal_a_dictionary(spark, tmp_path):
    rng = random.Random(3)
    table, expected, versions = new_table(spark, tmp_path), {}, []
    for step in range(7):
        ids = rng.sample(range(400), 200 if step in (0, 4) else 15)
        result = merge(table, f"run{step}", [*ids, ids[0], None])
        new = len(set(ids) - set(expected))
        assert (result.rows_before, result.rows_after, result.upserted) == (len(expected), len(expected) + new, len(ids))
        expected |= {i: f"run{step}" for i in ids}
        versions.append(dict(expected))
        assert stored(table) == expected and table.active_count() == len(expected)
    assert [stored(table, v + 1) for v in range(7)] == versions, "old versions stay readable"
    assert len({m.generation for v in range(1, 8) for m in table._merges(v)}) > 1
    again = merge(table, "run6", [1, 2])
    assert again.upserted == 0 and stored(table) == expected, "a repeated run is merged once"
    assert merge(table, "none", []).rows_after == len(expected) and stored(table) == expected
    table.expire(1)
    assert stored(table) == expected


def test_stored_rows_are_not_shuffled(spark, tmp_path):
    table = new_table(spark, tmp_path)
    merge(table, "a", range(2000))
    merge(table, "b", range(0, 40))
    merge(table, "c", range(20, 60))
    assert "Exchange" not in plan(table.read())
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        arriving = rows_of(spark, range(10), "d").select("id")
        # Only the side that arrives is dealt out.
        joined = plan(table.read().join(arriving, "id", "left_anti"))
        assert joined.count("Exchange") == 1 and re.search(r"Bucketed: true", joined)
        assert "Exchange" not in plan(table.changes(1, 2))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.enabled")


def test_few_keys_open_few_buckets(spark, tmp_path):
    table = new_table(spark, tmp_path, buckets=16)
    merge(table, "a", range(1000))
    merge(table, "b", [7])
    found = table.lookup(7, 5000)
    assert [(r.id, r._raw) for r in found.collect()] == [(7, "b")]
    buckets = re.search(r"SelectedBucketsCount: (\d+) out of 16", plan(found))
    assert int(buckets[1]) <= 2


def test_dead_attempts_are_never_seen(spark, tmp_path, monkeypatch):
    table = new_table(spark, tmp_path)
    merge(table, "a", range(100))
    for ids in ([1, 500], range(90)):
        with monkeypatch.context() as patch:
            patch.setattr(table.versions, "publish", lambda *a: 1 / 0)
            with pytest.raises(ZeroDivisionError):
                merge(table, "dies", ids)
        assert stored(table) == dict.fromkeys(range(100), "a") and table.active_count() == 100
    assert merge(table, "b", [1, 600]).rows_after == 101
    assert stored(table) == {**dict.fromkeys(range(100), "a"), 1: "b", 600: "b"}
    assert merge(table, "c", range(90)).rows_after == 101
    assert stored(table)[1] == "c" and stored(table)[600] == "b"
    other = new_table(spark, tmp_path)
    claimed = table.versions.claim()
    with pytest.raises(WriterConflict):
        merge(other, "d", [1])
    table.versions.release(claimed)


def test_sweep_and_guard(spark, tmp_path):
    table = new_table(spark, tmp_path)
    merge(table, "a", range(100))
    result = merge(table, "b", range(3, 100), full_snapshot=True)
    assert (result.soft_deleted, result.rows_after, result.sweep_aborted) == (3, 97, False)
    assert {r.id for r in table.read().filter("_deleted_at IS NOT NULL").collect()} == {0, 1, 2}
    result = merge(table, "c", range(50, 100), full_snapshot=True)
    assert (result.soft_deleted, result.rows_after, result.sweep_aborted) == (0, 97, True)
    result = merge(table, "d", [0])
    assert (result.rows_before, result.rows_after) == (97, 98), "a row that comes back is active again"
    gone = merge(table, "e", [], full_snapshot=True)
    assert gone.sweep_aborted and table.active_count() == 98


def test_composite_keys(spark, tmp_path):
    table = new_table(spark, tmp_path, "inventory_levels")
    rows = spark.createDataFrame(
        [(i, j, "a") for i in range(5) for j in range(4)], "inventory_item_id bigint, location_id bigint, _raw string"
    ).withColumn("updated_at", F.lit(START))
    table.merge(rows, "a", F.lit(START))
    assert table.merge(rows.filter("location_id = 1").withColumn("_raw", F.lit("b")), "b", F.lit(START)).rows_after == 20
    assert Counter(r._raw for r in table.read().collect()) == {"a": 15, "b": 5}


def test_changes(spark, tmp_path):
    table = new_table(spark, tmp_path)
    merge(table, "a", range(100))
    merge(table, "b", [5, 6, 200])
    merge(table, "c", [6, 7])
    merge(table, "d", range(60, 100), full_snapshot=True, max_delete_percent=100.0)

    def seen(old, new):
        return {r.id: (r.before and r.before._raw, r.after and (r.after._raw, r.after._deleted_at is None)) for r in table.changes(old, new).collect()}

    assert seen(1, 1) == {} and seen(3, 3) == {}
    assert seen(1, 2) == {5: ("a", ("b", True)), 6: ("a", ("b", True)), 200: (None, ("b", True))}
    assert seen(1, 3) == {**seen(1, 2), 6: ("a", ("c", True)), 7: ("a", ("c", True))}
    whole = seen(3, 4)
    assert {i for i, (_, after) in whole.items() if not after[1]} == {*range(60), 200} and set(whole) == {*range(100), 200}
    assert set(seen(0, 1)) == set(range(100))
    assert seen(2, 4)[7] == ("a", ("c", False))


def test_refreshed_tables_equal_a_recompute(spark):
    rng = random.Random(8)
    schema = "id bigint, grp string, n bigint, _deleted_at timestamp"
    before = {i: (rng.choice("abc"), rng.randrange(100), None) for i in range(50)}
    before[3] = (None, 5, None)
    after = {i: v for i, v in before.items()}
    for i in rng.sample(range(60), 30):
        after[i] = (rng.choice(["a", "b", "d", None]), rng.randrange(100), START if i % 5 == 0 else None)
    after = {i: ("d" if v[0] == "c" else v[0], *v[1:]) for i, v in after.items()}
    frame = lambda rows: spark.createDataFrame([(i, *v) for i, v in rows.items()], schema)
    sides = [
        frame(rows).select("id", F.struct("grp", "n", "_deleted_at").alias(name)) for rows, name in ((before, "before"), (after, "after"))
    ]
    changes = sides[0].join(sides[1], "id", "full_outer").filter(~F.col("before").eqNullSafe(F.col("after")))
    live = frame(after).filter("_deleted_at IS NULL")
    totals = lambda rows: rows.groupBy("grp").agg(F.count("*").alias("rows"), F.sum("n").alias("total"))
    signed = signed_rows(changes, ["id"])
    got = refreshed_sums(totals(frame(before)), signed, ["grp"], "rows", {"total": F.col("n")})
    assert Counter(got.collect()) == Counter(totals(live).collect()) and got.filter("grp = 'c'").isEmpty()
    groups = spark.createDataFrame([(g,) for g in "abcde"], "grp string")
    peaks = lambda rows: lambda some: some.join(
        rows.groupBy("grp").agg(F.min("n").alias("least"), F.max("n").alias("most")), "grp", "left"
    )
    mart = peaks(frame(before))(groups)
    again = refreshed_groups(mart, signed, groups, "grp", peaks(live))
    assert Counter(again.collect()) == Counter(peaks(live)(groups).collect())


def test_sync_into_bucketed_tables(spark, tmp_path):
    warehouse = Warehouse(spark, str(tmp_path / "w"), buckets=4, bucketed=True)
    for run, (first, last) in enumerate([(0, 50), (40, 60)]):
        folder = tmp_path / f"pages{run}"
        folder.mkdir()
        at = (START + timedelta(days=run)).isoformat()
        records = ",".join(f'{{"id": {i}, "updated_at": "{at}"}}' for i in range(first, last))
        (folder / "p.json").write_text(f'{{"orders": [{records}]}}')
        result = run_sync(warehouse, SyncSpec("shop", "orders"), str(folder))
        assert result.status == "success", result.error
        assert (result.rows_after, result.upserted_count) == ((50, 50), (60, 20))[run]
    assert warehouse.state("shop", "orders").active().count() == 60
