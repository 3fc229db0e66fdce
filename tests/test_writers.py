"""Writers that die, writers that meet, and rewrites that are cut off."""

import time
from collections import Counter

import pytest

from tidemark.plans.sync import Warehouse
from tidemark.sinks import tables
from tidemark.sinks.tables import append_rows, compact_rows, recover_table, retain_rows
from tidemark.sinks.versions import VersionedTable, WriterConflict


def versioned(spark, tmp_path, lease):
    return VersionedTable(spark, str(tmp_path / "t"), "n bigint", lease)


def test_dead_writers_are_replaced_after_their_lease(spark, tmp_path):
    dead, next_one, third = (versioned(spark, tmp_path, 1.5) for _ in range(3))
    claimed = dead.claim()
    with pytest.raises(WriterConflict):
        next_one.claim()
    dead._renewals.pop(claimed).set()
    time.sleep(2)
    assert next_one.claim() == claimed
    with pytest.raises(WriterConflict):
        third.claim()
    with pytest.raises(WriterConflict, match="taken over"):
        dead.publish(spark.range(1).toDF("n"), claimed)
    dead.release(claimed)
    next_one.publish(spark.range(3).toDF("n"), claimed)
    next_one.release(claimed)
    assert third.read().count() == 3 and third.claim() == claimed + 1
    third.release(claimed + 1)


def test_living_writers_keep_their_claim(spark, tmp_path):
    slow, other = (versioned(spark, tmp_path, 1.2) for _ in range(2))
    claimed = slow.claim()
    time.sleep(3)
    with pytest.raises(WriterConflict):
        other.claim()
    assert slow.publish(spark.range(2).toDF("n"), claimed) == 1
    slow.release(claimed)
    assert other.publish(spark.range(4).toDF("n")) == 2


def test_a_claim_signed_meanwhile_is_put_back(spark, tmp_path):
    one, two = (versioned(spark, tmp_path, 60) for _ in range(2))
    claimed = one.claim()
    assert not two._set_aside(claimed, "who was there before")
    assert one._owner(claimed) == one.owner
    one.release(claimed)


def rows(spark, first, last):
    return spark.range(first, last).selectExpr("id", "CASE WHEN id % 2 = 0 THEN 'x' ELSE 'y' END AS kind")


def ids(spark, path):
    return Counter(r.id for r in spark.read.parquet(path).collect())


@pytest.mark.parametrize("by", [(), ("kind",)])
@pytest.mark.parametrize("died_at", [0, 1, 2, 3, None])
def test_no_row_is_lost_by_a_rewrite_that_dies(spark, tmp_path, monkeypatch, died_at, by):
    """The job dies before each of its moves; others append before the rewrite, and before the recovery."""
    path = str(tmp_path / "ledger")
    append_rows(rows(spark, 0, 20), path, by=by)
    scan = spark.read.parquet(path)
    kept = scan.filter("id >= 5")
    assert scan.count() == 20
    append_rows(rows(spark, 100, 104), path, by=by)
    moves, move = [], tables._Place._move

    def dying(self, start, end):
        if len(moves) == died_at:
            raise KeyboardInterrupt
        moves.append(start)
        move(self, start, end)

    with monkeypatch.context() as patch:
        patch.setattr(tables._Place, "_move", dying)
        try:
            assert retain_rows(scan, path, kept, by) == 5 and (died_at is None or len(moves) <= died_at)
        except KeyboardInterrupt:
            assert len(moves) == died_at
    append_rows(rows(spark, 200, 203), path, by=by)
    recover_table(spark, path)
    expected = Counter([*range(0 if died_at == 0 else 5, 20), *range(100, 104), *range(200, 203)])
    assert ids(spark, path) == expected
    recover_table(spark, path)
    assert ids(spark, path) == expected
    again = spark.read.parquet(path)
    assert retain_rows(again, path, again.filter("id >= 5"), by) == (5 if died_at == 0 else 0)
    assert set(ids(spark, path)) == {*range(5, 20), *range(100, 104), *range(200, 203)}


def test_a_rewrite_without_its_list_is_forgotten(spark, tmp_path):
    path = str(tmp_path / "ledger")
    append_rows(rows(spark, 0, 10), path)
    rows(spark, 0, 3).write.parquet(str(tmp_path / ".new.ledger"))
    recover_table(spark, path)
    assert set(ids(spark, path)) == set(range(10)) and not (tmp_path / ".new.ledger").exists()


@pytest.mark.parametrize("by", [(), ("kind",)])
@pytest.mark.parametrize("died_at", [0, 1, 2, 3, None])
def test_no_row_is_lost_by_a_compaction_that_dies(spark, tmp_path, monkeypatch, died_at, by):
    """The job dies before each of its moves; others append after its list of files, and before it goes on."""
    path = str(tmp_path / "ledger")
    for first in range(0, 30, 10):
        append_rows(rows(spark, first, first + 10), path, by=by)
    moves, move, write_new = [], tables._Place._move, tables._Place.write_new

    def dying(self, start, end):
        if len(moves) == died_at:
            raise KeyboardInterrupt
        moves.append(start)
        move(self, start, end)

    def meanwhile(self, *args):
        write_new(self, *args)
        append_rows(rows(spark, 100, 104), path, by=by)

    with monkeypatch.context() as patch:
        patch.setattr(tables._Place, "_move", dying)
        patch.setattr(tables._Place, "write_new", meanwhile)
        try:
            assert compact_rows(spark, path, "id long, kind string", by) >= 3
            assert died_at is None or len(moves) <= died_at
        except KeyboardInterrupt:
            assert len(moves) == died_at
    append_rows(rows(spark, 200, 203), path, by=by)
    compact_rows(spark, path, "id long, kind string", by)
    assert ids(spark, path) == Counter([*range(30), *range(100, 104), *range(200, 203)])
    assert len(spark.read.parquet(path).inputFiles()) == (2 if by else 1)
    assert compact_rows(spark, path, "id long, kind string", by) == 0
    assert sorted(x.name for x in tmp_path.iterdir()) == ["ledger"]


def test_compaction_leaves_large_files_and_single_ones(spark, tmp_path):
    path = str(tmp_path / "ledger")
    assert compact_rows(spark, path) == 0
    append_rows(spark.range(0, 50_000, 1, 1).selectExpr("id", "'007' AS kind"), path, by=("kind",))
    for first in (50_000, 50_010):
        append_rows(spark.range(first, first + 10, 1, 1).selectExpr("id", "'007' AS kind"), path, by=("kind",))
    append_rows(spark.range(60_000, 60_001, 1, 1).selectExpr("id", "'1 = 2/%*{x}' AS kind"), path, by=("kind",))
    large = max((tmp_path / "ledger").rglob("*.parquet"), key=lambda f: f.stat().st_size)
    assert compact_rows(spark, path, "id long, kind string", ("kind",), small=20_000) == 2
    assert large.exists() and len(list((tmp_path / "ledger").rglob("*.parquet"))) == 3
    stored = spark.read.schema("id long, kind string").parquet(path)
    assert {r.kind: r["count"] for r in stored.groupBy("kind").count().collect()} == {"007": 50_020, "1 = 2/%*{x}": 1}


def test_ledger_stays_as_it_is_when_its_files_are_written_together(spark, tmp_path):
    warehouse = Warehouse(spark, str(tmp_path / "w"))
    assert warehouse.compact() == {"runs": 0, "results": 0}
    for name in ("r1", "r2", "r3"):
        for status in ("running", "success"):
            warehouse.add_entry(sync_id=name, pipeline="007", resource="orders", status=status)
    before = warehouse.ledger("007").collect()
    assert warehouse.compact() == {"runs": 6, "results": 0} and warehouse.compact()["runs"] == 0
    assert Counter(warehouse.ledger("007").collect()) == Counter(before) and len(before) == 3
