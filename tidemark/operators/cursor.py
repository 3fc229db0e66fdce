"""Watermarks, checkpoints and exact replay of cursor order."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime, timedelta, timezone

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.operators.buckets import running_max_before
from tidemark.sources.incremental import Cursor


def top_position(ts: str = "updated_at", id_column: str = "id") -> Column:
    """Aggregate: the greatest ``(ts, id)`` of rows that have a timestamp."""
    position = F.struct(F.col(ts).alias("ts"), F.coalesce(F.col(id_column), F.lit(0)).alias("id"))
    return F.max(F.when(F.col(ts).isNotNull(), position))


def watermark(
    rows: DataFrame, by: Sequence[str] = (), ts: str = "updated_at", id_column: str = "id"
) -> DataFrame:
    """The greatest ``(updated_at, id)`` per group; no row for a group without a timestamp."""
    top = rows.filter(F.col(ts).isNotNull()).groupBy(*by).agg(top_position(ts, id_column).alias("_top"))
    return top.filter(F.col("_top").isNotNull()).select(
        *by, F.col("_top.ts").alias("last_updated_at"), F.col("_top.id").alias("last_id")
    )


def load_checkpoint(checkpoints: DataFrame, pipeline: str, resource: str) -> Cursor | None:
    """The stored cursor of one table, or None."""
    stored = read_checkpoint(checkpoints, pipeline, resource)
    found = stored.select(F.unix_micros("last_updated_at").alias("micros"), "last_id").head()
    if found is None:
        return None
    epoch = datetime(1970, 1, 1, tzinfo=timezone.utc)
    return Cursor(epoch + timedelta(microseconds=found.micros), found.last_id)


def read_checkpoint(checkpoints: DataFrame, pipeline: str, resource: str) -> DataFrame:
    """As a table: no row when there is none or its timestamp is NULL; a NULL id reads as 0."""
    return checkpoints.filter(
        (F.col("pipeline") == pipeline)
        & (F.col("resource") == resource)
        & F.col("last_updated_at").isNotNull()
    ).select("last_updated_at", F.coalesce("last_id", F.lit(0)).alias("last_id"))


def merge_checkpoints(current: DataFrame, watermarks: DataFrame, sync_id: str, as_of: Column) -> DataFrame:
    """Store new watermarks by (pipeline, resource); an older timestamp than the stored is refused.

    An equal timestamp is stored even with a smaller id. Tables without a new watermark keep theirs.
    """
    keys = ["pipeline", "resource"]
    stamped = watermarks.filter(F.col("last_updated_at").isNotNull()).select(
        *keys,
        "last_updated_at",
        "last_id",
        F.lit(sync_id).alias("last_sync_id"),
        as_of.alias("last_sync_at"),
        F.lit("success").alias("last_status"),
    )
    values = [c for c in stamped.columns if c not in keys]
    old, new = current.alias("old"), stamped.alias("new")
    keep = F.col("new.last_updated_at").isNull() | (
        F.col("new.last_updated_at") < F.col("old.last_updated_at")
    )
    return old.join(new, keys, "full_outer").select(
        *keys, *(F.when(keep, F.col(f"old.{c}")).otherwise(F.col(f"new.{c}")).alias(c) for c in values)
    )


def replay_cursor(
    rows: DataFrame,
    group: Sequence[str],
    arrival: str,
    cursor: Cursor | None = None,
    ts: str = "updated_at",
    id_column: str = "id",
    bucket_rows: int = 200_000,
) -> DataFrame:
    """Keep a row only if it lies behind the cursor and behind every row that arrived before it.

    Rows without a timestamp are kept and do not move the cursor. ``arrival`` numbers the rows of a
    group; runs of ``bucket_rows`` numbers are compared on their own and with one summary row of
    each earlier run.
    """
    t = F.col(ts)
    position = F.struct(t.alias("ts"), F.coalesce(F.col(id_column), F.lit(0)).cast("bigint").alias("id"))
    bucket = F.floor(F.col(arrival) / bucket_rows)
    seen = running_max_before(rows, group, bucket, arrival, F.when(t.isNotNull(), position), "_seen")
    ahead = F.col("_seen").isNull() | (position > F.col("_seen"))
    if cursor is not None:
        start = F.struct(cursor.literal(rows, ts).alias("ts"), F.lit(cursor.id).cast("bigint").alias("id"))
        ahead = ahead & (position > start)
    return seen.filter(t.isNull() | ahead).drop("_seen")
