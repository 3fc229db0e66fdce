"""Incremental reads behind a composite ``(updated_at, id)`` cursor."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime, timedelta, timezone

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.model import OVERLAP_MINUTES


@dataclass(frozen=True)
class Cursor:
    """The last processed position. A time without a zone is UTC."""

    ts: datetime
    id: int = 0

    def literal(self, rows: DataFrame, ts: str, minutes_before: int = 0) -> Column:
        """The time as a constant of the column's own type, so that comparisons reach the file scan."""
        zoned = self.ts if self.ts.tzinfo else self.ts.replace(tzinfo=timezone.utc)
        moved = zoned.astimezone(timezone.utc) - timedelta(minutes=minutes_before)
        if isinstance(rows.schema[ts].dataType, T.TimestampNTZType):
            return F.lit(moved.replace(tzinfo=None).isoformat(" ")).cast("timestamp_ntz")
        return F.lit(moved.isoformat(" ")).cast("timestamp")


def overlap_scan(
    rows: DataFrame, cursor: Cursor, ts: str = "updated_at", minutes: int = OVERLAP_MINUTES
) -> DataFrame:
    """Rows no older than the cursor minus the overlap; the bound reaches the file scan."""
    return rows.filter(F.col(ts) >= cursor.literal(rows, ts, minutes))


def read_incremental(
    rows: DataFrame,
    cursor: Cursor | None,
    ts: str = "updated_at",
    id_column: str = "id",
    late_rows: str = "drop",
    minutes: int = OVERLAP_MINUTES,
) -> DataFrame:
    """Rows a run has to process; every row when there is no cursor.

    ``late_rows="drop"`` keeps rows behind the cursor only. ``"reprocess"`` also keeps the rows of
    the overlap before it, which a keyed merge makes harmless.
    """
    if late_rows not in ("drop", "reprocess"):
        raise ValueError(f"late_rows must be 'drop' or 'reprocess', not {late_rows!r}")
    if cursor is None:
        return rows
    t = F.col(ts)
    if late_rows == "reprocess":
        return rows.filter(t.isNull() | (t >= cursor.literal(rows, ts, minutes)))
    start, i = cursor.literal(rows, ts), F.coalesce(F.col(id_column), F.lit(0))
    # Two filters that the optimizer cannot merge into one: the first is pushed to the scan, the
    # second breaks ties on the id and is not.
    return rows.filter(t.isNull() | (t >= start)).filter(~t.eqNullSafe(start) | (i > cursor.id))
