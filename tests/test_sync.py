"""Whole syncs into a warehouse folder."""

import json
from datetime import datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

from tidemark.model import RESOURCES
from tidemark.operators.cursor import load_checkpoint
from tidemark.plans import sync as S
from tidemark.sinks.state import MOST_LAYERS as S_LAYERS
from tidemark.sinks.state import StateTable
from tidemark.sinks.tables import append_rows, expired_days, read_days
from tidemark.sinks.versions import VersionedTable
from tidemark.streaming.sync import start_sync_stream

START = datetime(2026, 4, 1, tzinfo=timezone.utc)


class Shop:
    """A source that lands pages, and the warehouse it is synced into."""

    def __init__(self, spark, folder):
        self.warehouse, self.folder, self.n = S.Warehouse(spark, str(folder / "w"), buckets=4), folder, 0

    def sync(self, records, resource="orders", mode="incremental", field=None, **spec):
        self.n += 1
        landing = self.folder / f"landing-{self.n}"
        landing.mkdir()
        for page, first in enumerate(range(0, max(len(records), 1), 10)):
            (landing / f"{page:03d}.json").write_text(json.dumps({field or resource: records[first:first + 10]}))
        spec = S.SyncSpec("shop", resource, mode, sync_id=f"run-{self.n}", **spec)
        return S.run_sync(self.warehouse, spec, str(landing), START + timedelta(hours=self.n))

    def rows(self, resource="orders"):
        return {r.id: r for r in self.warehouse.state("shop", resource).read().collect()}

    def results(self):
        results = self.warehouse.results().filter(f"sync_id = 'run-{self.n}'").collect()
        return {r.rule: r.status for r in results}

    def cursor(self, resource="orders"):
        return load_checkpoint(self.warehouse.checkpoints.read(), "shop", resource)


def order(n, minute=0, **more):
    at = START + timedelta(minutes=minute)
    return {"id": n, "updated_at": at.isoformat(), **more}


@pytest.fixture
def shop(spark, tmp_path):
    return Shop(spark, tmp_path)


def test_life_of_a_table(shop):
    first = shop.sync([order(n) for n in range(21)] + [{"updated_at": "2026-04-01"}])
    assert (first.status, first.fetched_count, first.upserted_count, first.skipped_invalid) == ("success", 22, 21, 1)
    assert (first.rows_before, first.rows_after) == (0, 21)
    assert (shop.cursor().ts, shop.cursor().id) == (START, 20)
    assert shop.results() == {"fetch_upsert_parity": "failed", "volume_sanity": "ok",
                              "weekly_full_drift": "skipped", "soft_delete_sanity": "skipped"}

    second = shop.sync([order(3, 5, note="changed"), order(99, 6), order(1, 0, note="late")])
    assert (second.fetched_count, second.upserted_count, second.rows_after) == (2, 2, 22)
    assert "changed" in shop.rows()[3]._raw and "late" not in shop.rows()[1]._raw
    assert (shop.cursor().ts, shop.cursor().id) == (START + timedelta(minutes=6), 99)

    third = shop.sync([order(n, 7) for n in range(21)], mode="full_refresh")
    assert (third.soft_deleted_count, third.rows_after, third.sweep_aborted) == (1, 21, False)
    assert shop.rows()[99]._deleted_at is not None

    fourth = shop.sync([order(n, 8) for n in range(10)], mode="full_refresh")
    assert (fourth.status, fourth.soft_deleted_count, fourth.sweep_aborted) == ("success", 0, True)
    assert shop.results()["soft_delete_sanity"] == "failed"

    fifth = shop.sync([order(99, 9)])
    assert fifth.rows_after == 22 and shop.rows()[99]._deleted_at is None

    ledger = {r.sync_id: r for r in shop.warehouse.ledger().collect()}
    assert len(ledger) == 5 and ledger["run-1"].mode == "incremental" and ledger["run-3"].soft_deleted_count == 1
    assert all(r.status == "success" and r.finished_at for r in ledger.values())


def test_same_data_twice(shop):
    data = [order(n, n) for n in range(30)]
    shop.sync(data, mode="full_refresh")
    again = shop.sync(data, mode="full_refresh")
    assert (again.rows_after, again.soft_deleted_count, again.upserted_count) == (30, 0, 30)
    nothing = shop.sync(data)
    assert (nothing.status, nothing.fetched_count, nothing.rows_after) == ("success", 0, 30)
    assert shop.cursor().id == 29


def test_empty_incremental_batch_keeps_the_checkpoint(shop):
    shop.sync([order(1, 5)])
    result = shop.sync([])
    assert (result.status, result.fetched_count, result.rows_after) == ("success", 0, 1)
    assert shop.cursor().ts == START + timedelta(minutes=5)


def test_late_rows_can_be_reprocessed(shop):
    shop.sync([order(1, 10)])
    shop.sync([order(2, 6, note="late"), order(3, 4)], late_rows="reprocess")
    assert sorted(shop.rows()) == [1, 2] and shop.cursor().ts == START + timedelta(minutes=10)


def test_duplicates_in_one_load(shop):
    shop.sync([order(1, 5, v="new"), order(1, 3, v="old"), order(1, 5, v="last page wins")])
    assert "last page wins" in shop.rows()[1]._raw and len(shop.rows()) == 1


def test_locations_always_sweep(shop):
    shop.sync([{"id": n} for n in range(1, 31)], "locations")
    result = shop.sync([{"id": n} for n in range(2, 31)], "locations")
    assert (result.soft_deleted_count, result.rows_after) == (1, 29) and shop.cursor("locations") is None


def test_guard_counts_accepted_products_only(shop):
    shop.sync([order(n) for n in range(20)], "products", "full_refresh")
    lost = [order(n) for n in range(18)] + [{"title": "no id"}] * 2
    assert shop.sync(lost, "products", "full_refresh").sweep_aborted
    shop.sync([order(n) for n in range(20)], "orders", "full_refresh")
    assert not shop.sync(lost, "orders", "full_refresh").sweep_aborted


def test_inventory(shop):
    level = {"inventory_item_id": 1, "location_id": 2, "available": 5}
    skipped = shop.sync([level], "inventory_levels", field="inventory_locations")
    assert (skipped.status, skipped.fetched_count) == ("success", 0)
    shop.sync([order(1, variants=[{"id": 11}])], "products")
    for _ in range(2):
        done = shop.sync([level, {**level, "location_id": 3}], "inventory_levels", field="inventory_locations")
        assert (done.status, done.rows_after, done.soft_deleted_count) == ("success", 2, 0)


def test_failed_load_leaves_the_checkpoint(shop, monkeypatch):
    shop.sync([order(1, 5)])

    def broken(*_, **__):
        raise RuntimeError("disk full")

    monkeypatch.setattr(StateTable, "merge", broken)
    result = shop.sync([order(2, 9)])
    assert result.status == "failed" and "disk full" in result.error
    assert shop.cursor().ts == START + timedelta(minutes=5) and shop.results() == {}
    monkeypatch.undo()
    assert shop.sync([order(2, 9)]).status == "success" and sorted(shop.rows()) == [1, 2]


def test_crash_between_state_and_checkpoint(shop, monkeypatch):
    shop.sync([order(1, 5)])
    publish = VersionedTable.publish

    def crash(self, rows, claimed=None):
        if "/checkpoints/" in self.path:
            raise RuntimeError("killed")
        return publish(self, rows, claimed)

    monkeypatch.setattr(VersionedTable, "publish", crash)
    assert shop.sync([order(2, 9)]).status == "failed"
    monkeypatch.undo()
    assert sorted(shop.rows()) == [1, 2] and shop.cursor().ts == START + timedelta(minutes=5)
    assert shop.sync([order(2, 9)]).status == "success"
    assert sorted(shop.rows()) == [1, 2] and shop.cursor().ts == START + timedelta(minutes=9)


def merge(spark, table, sync_id, *ids):
    rows = spark.createDataFrame([(i,) for i in ids], "id bigint").withColumns(
        {"updated_at": F.lit(START), "_raw": F.lit(sync_id), "_synced_at": F.lit(START), "_sync_id": F.lit(sync_id)}
    )
    return table.merge(rows, sync_id, F.lit(START))


def test_only_touched_buckets_are_rewritten(spark, tmp_path):
    table = StateTable(spark, str(tmp_path / "t"), RESOURCES["orders"], buckets=16)
    merge(spark, table, "a", *range(200))
    merge(spark, table, "b", 7)
    files = table.versions.read().collect()
    # Sixteen buckets, and one layer on top of one of them.
    assert sum("v=2" in f.folder for f in files) == 1 and len(files) == 17
    assert table.active_count() == table.read().count() == 200
    assert table.read(1).filter("_sync_id = 'b'").isEmpty(), "old versions stay readable"
    again = merge(spark, table, "b", 7, 8)
    assert again.upserted == 0 and table.versions.version() == 2, "a repeated batch is merged once"


def test_merge_stamps_its_rows(spark, tmp_path):
    table = StateTable(spark, str(tmp_path / "t"), RESOURCES["orders"], buckets=2)
    merge(spark, table, "a", 1, 2)
    carried = table.read()
    result = table.merge(carried, "b", F.lit(START), full_snapshot=True)
    assert (result.rows_after, result.soft_deleted) == (2, 0)
    assert {r._sync_id for r in table.read().collect()} == {"b"}


def test_unfinished_version_is_ignored(spark, tmp_path):
    table = StateTable(spark, str(tmp_path / "t"), RESOURCES["orders"], buckets=2)
    merge(spark, table, "a", 1, 2)
    (tmp_path / "t" / "versions" / "v=2").mkdir()
    (tmp_path / "t" / "versions" / "v=2" / "part-0.parquet").write_text("half")
    assert table.read().count() == 2
    merge(spark, table, "b", 3)
    assert table.read().count() == 3 and table.versions.version() == 2


def test_old_versions_can_be_dropped(spark, tmp_path):
    table = StateTable(spark, str(tmp_path / "t"), RESOURCES["orders"], buckets=4)
    merge(spark, table, "a", *range(50))
    for n in range(4):
        merge(spark, table, f"b{n}", n)
    before = sorted(r.id for r in table.read().collect())
    assert table.expire(keep=2) > 0
    assert sorted(r.id for r in table.read().collect()) == before and table.read(4).count() == 50
    assert table.expire(keep=2) == 0


def test_stream_resumes(spark, tmp_path):
    warehouse, landing = S.Warehouse(spark, str(tmp_path / "w"), buckets=4), tmp_path / "landing"
    landing.mkdir()

    def land(name, *records):
        (landing / name).write_text(json.dumps({"orders": records}))
        job = start_sync_stream(warehouse, "shop", "orders", str(landing), str(tmp_path / "cp"), files_per_batch=1)
        job.awaitTermination()
        return {r.id: r for r in warehouse.state("shop", "orders").read().collect()}

    assert sorted(land("1.json", order(1, 1), order(2, 2), {"no": "id"})) == [1, 2]
    rows = land("2.json", order(2, 3, note="again"), order(3, 1))
    assert sorted(rows) == [1, 2, 3] and "again" in rows[2]._raw
    assert load_checkpoint(warehouse.checkpoints.read(), "shop", "orders").ts == START + timedelta(minutes=3)
    assert warehouse.state("shop", "orders").versions.version() == 2


def test_day_partitions(spark, tmp_path):
    rows = spark.createDataFrame([(START.replace(tzinfo=None) + timedelta(days=n), n) for n in range(5)], "timestamp timestamp, n int")
    append_rows(rows, str(tmp_path / "logs"), "timestamp")
    days = read_days(spark, str(tmp_path / "logs"), first=datetime(2026, 4, 4).date())
    assert sorted(r.n for r in days.collect()) == [3, 4]
    assert "PartitionFilters: [isnotnull(log_date" in days._jdf.queryExecution().executedPlan().toString()
    gone = expired_days(read_days(spark, str(tmp_path / "logs")), datetime(2026, 4, 3).date())
    assert gone.count() == 2


def test_small_merges_are_layers(shop):
    state = shop.warehouse.state("shop", "orders")
    shop.sync([order(n) for n in range(400)])
    expected = {n: "" for n in range(400)}
    seen = set()
    for step in range(14):
        changed = [order(n, 10 + step, note=f"s{step}") for n in (step, 50 + step, 399, 400 + step)]
        result = shop.sync(changed)
        expected |= {r["id"]: f"s{step}" for r in changed}
        assert (result.upserted_count, result.rows_after) == (4, len(expected))
        files = state._files(state.versions.version())
        seen.add(max(sum(f.bucket == b for f in files) for b in range(4)))
        assert sum(f.active_count for f in files) == len(expected)
    rows = shop.rows()
    assert {n: json.loads(r._raw).get("note", "") for n, r in rows.items()} == expected
    # Layers grow, and are compacted before they are too many.
    assert 2 in seen and max(seen) <= S_LAYERS
    assert shop.sync([order(n, 100) for n in range(100, 414)], mode="full_refresh").sweep_aborted
    swept = shop.sync([order(n, 101) for n in range(5, 414)], mode="full_refresh")
    assert (swept.soft_deleted_count, swept.rows_after) == (5, 409)
    back = shop.sync([order(2, 102)])
    assert back.rows_after == 410 and shop.rows()[2]._deleted_at is None


def test_a_second_writer_fails_and_changes_nothing(shop):
    shop.sync([order(1)])
    state = shop.warehouse.state("shop", "orders")
    claimed = state.versions.claim()
    failed = shop.sync([order(2, 5)])
    assert failed.status == "failed" and "is being written" in failed.error
    assert sorted(shop.rows()) == [1] and shop.cursor().id == 1
    state.versions.release(claimed)
    assert shop.sync([order(2, 5)]).status == "success" and sorted(shop.rows()) == [1, 2]
    assert {r.sync_id: r.status for r in shop.warehouse.ledger().collect()} == {
        "run-1": "success", "run-2": "failed", "run-3": "success"
    }


def test_big_counters(shop):
    shop.warehouse.add_entry(sync_id="big", pipeline="p", resource="orders", status="success", fetched_count=3_000_000_000)
    assert shop.warehouse.ledger("p", "orders").first().fetched_count == 3_000_000_000


def test_retention_of_stored_runs_and_results(shop):
    shop.sync([order(1)])
    shop.sync([order(2, 5)])
    later = START + timedelta(hours=1, days=90, seconds=1)
    assert shop.warehouse.retain(later) == {"runs": 2, "results": 8}
    assert [r.sync_id for r in shop.warehouse.ledger().collect()] == ["run-2"]
    assert shop.warehouse.retain(later) == {"runs": 0, "results": 0}


def test_pages_are_landed_compressed_with_the_same_records(spark, tmp_path):
    from tidemark.plans.event_queries import _land_orders
    from tidemark.plans.inputs import as_records
    from tidemark.sources.pages import explode_pages, read_pages

    rows = [(n if n % 7 else None, n, "PO"[n % 2], n / 4, datetime(2000, 1, 1), "5-LOW") for n in range(600)]
    names = "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, o_orderdate timestamp_ntz, o_orderpriority string"
    orders = spark.createDataFrame([*rows, rows[1]], names)
    _land_orders(orders, str(tmp_path / "in"))
    files = [p.name for p in (tmp_path / "in").iterdir() if p.name.startswith("part-")]
    assert files and all(name.endswith(".gz") for name in files)
    got = explode_pages(read_pages(spark, str(tmp_path / "in"), False), RESOURCES["orders"]).select("_raw")
    assert sorted(r._raw for r in got.collect()) == sorted(r._raw for r in as_records(orders).collect())


@pytest.mark.parametrize("few", [0, 1000])
def test_what_arrives_is_written_once(spark, tmp_path, monkeypatch, few):
    monkeypatch.setattr("tidemark.sinks.state.FEW_LEFT", few)
    wrote = []
    write = StateTable._write

    def noted(self, rows, folder, buckets, mode):
        plan = rows._jdf.queryExecution().optimizedPlan().toString()
        wrote.append((mode, rows.count(), "Window" in plan))
        write(self, rows, folder, buckets, mode)

    monkeypatch.setattr(StateTable, "_write", noted)
    state = StateTable(spark, str(tmp_path), RESOURCES["orders"], 2)
    rows = lambda ids: spark.createDataFrame([(i, START, "{}") for i in ids], "id bigint, updated_at timestamp, _raw string")
    merge = lambda ids, name, **more: state.merge(rows(ids), name, F.lit(START), full_snapshot=True, **more)
    assert merge(range(100), "a", unique=True).rows_after == 100
    swept = merge(range(2, 100), "b", unique=True)
    assert (swept.upserted, swept.soft_deleted, swept.rows_after) == (98, 2, 98)
    repeated = merge([*range(2, 100), 5, 5], "c")
    assert (repeated.upserted, repeated.soft_deleted, repeated.rows_after) == (98, 0, 98)
    assert state.read().count() == 100 and state.active().count() == 98
    assert wrote == [
        ("overwrite", 100, False), ("overwrite", 98, False), ("append", 2, False), ("overwrite", 98, True), ("append", 2, False),
    ]
