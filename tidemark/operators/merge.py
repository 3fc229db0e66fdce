"""Keyed merge into a state table, soft delete and its guard."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.model import Thresholds


def latest_per_key(rows: DataFrame, key: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The last row per key by ``order``, NULL first.

    Spark limits each key to one row before the shuffle as well as after it, so a key that holds a
    large share of the rows is small when it reaches its task.
    """
    newest = Window.partitionBy(*key).orderBy(*(F.col(c).desc_nulls_last() for c in order))
    return rows.withColumn("_rank", F.row_number().over(newest)).filter("_rank = 1").drop("_rank")


def upsert(
    target: DataFrame,
    incoming: DataFrame,
    key: Sequence[str],
    order: Sequence[str] | None = None,
) -> DataFrame:
    """The target after a keyed merge: incoming rows replace stored ones, whatever their age.

    Columns the incoming rows do not have become NULL, so a soft-deleted row that comes back is
    active again. With ``order`` the incoming rows are first reduced to the last one per key;
    without it they must be unique. Rows with a NULL key are not merged.
    """
    for k in key:
        incoming = incoming.filter(F.col(k).isNotNull())
    if order:
        incoming = latest_per_key(incoming, key, order)
    incoming = incoming.select(*(c for c in target.columns if c in incoming.columns))
    untouched = target.join(incoming.select(*key), list(key), "left_anti")
    return untouched.unionByName(incoming, allowMissingColumns=True).select(*target.columns)


def load_counts() -> list[Column]:
    """Aggregates over rows that carry ``_reject``: fetched, accepted and skipped rows of a load."""
    good = F.col("_reject").isNull()
    return [
        F.count("*").alias("fetched"),
        F.count_if(good).alias("accepted"),
        F.count_if(~good).alias("skipped"),
    ]


def merge_counts(rows: DataFrame) -> DataFrame:
    return rows.agg(*load_counts())


def is_active(table: DataFrame) -> Column:
    return F.col("_deleted_at").isNull() if "_deleted_at" in table.columns else F.lit(True)


def active_rows(table: DataFrame) -> DataFrame:
    """Rows that are not soft-deleted; all rows of a table without soft delete."""
    return table.filter(is_active(table))


def count_active(table: DataFrame, name: str = "active_rows") -> DataFrame:
    return table.agg(F.count_if(is_active(table)).alias(name))


def is_stale(sync_id: str, sweep_unmarked: bool = False) -> Column:
    """An active row that the run did not touch.

    Rows that never had a marker are left alone unless ``sweep_unmarked`` is set.
    """
    other = F.col("_sync_id") != sync_id
    if sweep_unmarked:
        other = other | F.col("_sync_id").isNull()
    return F.coalesce(other, F.lit(False)) & F.col("_deleted_at").isNull()


def sweep(
    table: DataFrame,
    sync_id: str,
    as_of: Column,
    sweep_unmarked: bool = False,
    allowed: Column | None = None,
) -> DataFrame:
    """Soft-delete the rows that a full snapshot did not contain; a no-op without the columns."""
    if not {"_deleted_at", "_sync_id"} <= set(table.columns):
        return table
    stale = is_stale(sync_id, sweep_unmarked)
    if allowed is not None:
        stale = stale & allowed
    return table.withColumn("_deleted_at", F.when(stale, as_of).otherwise(F.col("_deleted_at")))


def percent_lost(active, fetched):
    """Share of the active rows that a sweep would remove; for columns and for plain numbers."""
    return (active - fetched) / active * 100


def guarded_sweep(
    table: DataFrame,
    fetched: Column,
    sync_id: str,
    as_of: Column,
    max_percent: float = Thresholds.delete_max,
    sweep_unmarked: bool = False,
) -> DataFrame:
    """``sweep`` of a table after its merge, or the table unchanged when the guard objects.

    ``fetched`` is a literal or a scalar subquery (``frame.scalar()``).
    """
    if not {"_deleted_at", "_sync_id"} <= set(table.columns):
        return table
    active = F.nullif(count_active(table).scalar(), F.lit(0))
    too_many = F.coalesce(percent_lost(active, fetched) > max_percent, F.lit(False))
    return sweep(table, sync_id, as_of, sweep_unmarked, ~too_many)


def keys_missing(table: DataFrame, snapshot: DataFrame, key: Sequence[str]) -> DataFrame:
    """Active rows whose key the snapshot does not have."""
    return active_rows(table).join(snapshot.select(*key), list(key), "left_anti")
