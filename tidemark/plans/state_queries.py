"""Queries of cursor, merge, sweep and checkpoint operators."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F

from tidemark.operators.cursor import merge_checkpoints, read_checkpoint, replay_cursor, watermark
from tidemark.operators.merge import (
    guarded_sweep, is_active, keys_missing, latest_per_key, sweep, upsert,
)
from tidemark.plans.inputs import AS_OF, AS_OF_TEXT, STATE, arriving_orders, at, order_rows, stored_orders, table
from tidemark.plans.registry import query
from tidemark.sources.incremental import Cursor, overlap_scan, read_incremental

CURSOR = Cursor(datetime(2024, 1, 15), 5000)
_EVENT = ["event_id", "ts", "user_id", "event_type"]


def _changes(spark, folder):
    """Events as changed rows; sign-ups come without a timestamp, and several share an hour."""
    hour = F.when(F.col("event_type") != "signup", F.date_trunc("hour", "ts")).cast("timestamp_ntz")
    return table(spark, folder, "events").select("event_id", "user_id", hour.alias("updated_at"))


_CHANGES = """
changes AS (SELECT event_id, user_id,
  CASE WHEN event_type <> 'signup' THEN date_trunc('hour', ts) END AS updated_at FROM events)"""


@query(
    "keyset_incremental",
    f"""WITH {_CHANGES} SELECT * FROM changes
    WHERE updated_at IS NULL OR (updated_at, event_id) > (TIMESTAMP '2024-01-15 00:00:00', 5000)""",
)
def keyset_incremental(spark, folder):
    return read_incremental(_changes(spark, folder), CURSOR, id_column="event_id")


@query(
    "keyset_scan",
    """SELECT event_id, ts, user_id, event_type FROM events
    WHERE (ts, event_id) > (TIMESTAMP '2024-01-15 00:00:00', 5000)""",
)
def keyset_scan(spark, folder):
    """The same on a stored column: the cursor's time is pushed down to the files."""
    return read_incremental(table(spark, folder, "events").select(*_EVENT), CURSOR, "ts", "event_id")


@query(
    "late_rows_reprocessed",
    f"""WITH {_CHANGES} SELECT * FROM changes
    WHERE updated_at IS NULL OR updated_at >= TIMESTAMP '2024-01-14 23:55:00'""",
)
def late_rows_reprocessed(spark, folder):
    return read_incremental(_changes(spark, folder), CURSOR, id_column="event_id", late_rows="reprocess")


@query(
    "overlap_scan",
    "SELECT event_id, ts, user_id, event_type FROM events WHERE ts >= TIMESTAMP '2024-01-14 23:55:00'",
)
def overlap_scan_query(spark, folder):
    return overlap_scan(table(spark, folder, "events").select(*_EVENT), CURSOR, ts="ts")


@query(
    "keyset_dedup",
    f"""WITH {_CHANGES},
    seen AS (
      SELECT *, max(CASE WHEN updated_at IS NOT NULL THEN {{'ts': updated_at, 'id': user_id}} END) OVER (
        ORDER BY event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS top FROM changes)
    SELECT event_id, user_id, updated_at FROM seen
    WHERE updated_at IS NULL OR top IS NULL OR {{'ts': updated_at, 'id': user_id}} > top""",
)
def keyset_dedup(spark, folder):
    arrived = _changes(spark, folder).withColumn("resource", F.lit("events"))
    kept = replay_cursor(arrived, ["resource"], "event_id", id_column="user_id")
    return kept.select("event_id", "user_id", "updated_at")


@query(
    "watermark",
    f"""WITH {_CHANGES} SELECT user_id, top.ts AS last_updated_at, top.id AS last_id FROM (
      SELECT user_id, max({{'ts': updated_at, 'id': event_id}}) AS top FROM changes
      WHERE updated_at IS NOT NULL GROUP BY user_id)""",
)
def watermark_query(spark, folder):
    return watermark(_changes(spark, folder), ["user_id"], id_column="event_id")


def _positions(spark, folder, *kinds):
    rows = table(spark, folder, "events").filter(F.col("event_type").isin(*kinds))
    rows = rows.select(
        F.concat(F.lit("p"), F.col("user_id") % 3).alias("pipeline"),
        F.concat(F.lit("r"), F.col("user_id") % 50).alias("resource"),
        F.col("ts").alias("updated_at"), F.col("event_id").alias("id"),
    )
    return watermark(rows, ["pipeline", "resource"])


def _stored_positions(spark, folder):
    return _positions(spark, folder, "click", "error").withColumns(
        {
            "last_sync_id": F.lit("old"), "last_sync_at": at("2024-01-30 00:00:00"),
            "last_status": F.lit("success"),
        }
    )


_POSITIONS = """
positions AS (
  SELECT event_type, 'p' || CAST(user_id % 3 AS VARCHAR) AS pipeline,
    'r' || CAST(user_id % 50 AS VARCHAR) AS resource, ts, event_id FROM events),
old AS (
  SELECT pipeline, resource, max(ts) AS ts, max_by(event_id, ts) AS id FROM positions
  WHERE event_type IN ('click', 'error') GROUP BY ALL),
new AS (
  SELECT pipeline, resource, max(ts) AS ts, max_by(event_id, ts) AS id FROM positions
  WHERE event_type IN ('view', 'error') GROUP BY ALL)"""


@query(
    "checkpoint_merge",
    f"""WITH {_POSITIONS} SELECT pipeline, resource,
      CASE WHEN keep THEN old_ts ELSE new_ts END AS last_updated_at,
      CASE WHEN keep THEN old_id ELSE new_id END AS last_id,
      CASE WHEN keep THEN 'old' ELSE 'new' END AS last_sync_id,
      CASE WHEN keep THEN TIMESTAMP '2024-01-30 00:00:00' ELSE TIMESTAMP '{AS_OF_TEXT}' END AS last_sync_at,
      'success' AS last_status
    FROM (SELECT pipeline, resource, old.ts AS old_ts, new.ts AS new_ts, old.id AS old_id, new.id AS new_id,
            coalesce(new.ts < old.ts, new.ts IS NULL) AS keep
          FROM old FULL JOIN new USING (pipeline, resource))""",
)
def checkpoint_merge(spark, folder):
    new = _positions(spark, folder, "view", "error")
    return merge_checkpoints(_stored_positions(spark, folder), new, "new", at(AS_OF_TEXT))


@query(
    "checkpoint_read",
    f"""WITH {_POSITIONS} SELECT ts AS last_updated_at, id AS last_id FROM old
    WHERE pipeline = 'p1' AND resource = 'r7'""",
)
def checkpoint_read(spark, folder):
    return read_checkpoint(_stored_positions(spark, folder), "p1", "r7")


@query("upsert_single_key", f"WITH {STATE} SELECT * FROM merged")
def upsert_single_key(spark, folder):
    return upsert(stored_orders(spark, folder), arriving_orders(spark, folder), ["id"], ["updated_at"])


@query("dedup_latest", f"WITH {STATE} SELECT id, updated_at, _raw FROM latest")
def dedup_latest(spark, folder):
    rows = latest_per_key(arriving_orders(spark, folder), ["id"], ["updated_at"])
    return rows.select("id", "updated_at", "_raw")


_LINE_KEY = ["l_orderkey", "l_linenumber"]
_LINE_ORDER = ["l_shipdate", "l_partkey", "l_suppkey", "l_extendedprice"]
_LINE_COLUMNS = [*_LINE_KEY, *_LINE_ORDER, "l_quantity"]


@query(
    "upsert_composite_key",
    """WITH old AS (
      SELECT * FROM lineitem WHERE l_linestatus = 'F' QUALIFY row_number() OVER (
        PARTITION BY l_orderkey, l_linenumber
        ORDER BY l_shipdate DESC, l_partkey DESC, l_suppkey DESC, l_extendedprice DESC) = 1),
    new AS (
      SELECT * FROM lineitem WHERE l_returnflag <> 'R' QUALIFY row_number() OVER (
        PARTITION BY l_orderkey, l_linenumber
        ORDER BY l_shipdate DESC, l_partkey DESC, l_suppkey DESC, l_extendedprice DESC) = 1)
    SELECT l_orderkey, l_linenumber, l_shipdate, l_partkey, l_suppkey, l_extendedprice, l_quantity, 'a' AS _sync_id
    FROM old ANTI JOIN new USING (l_orderkey, l_linenumber)
    UNION ALL
    SELECT l_orderkey, l_linenumber, l_shipdate, l_partkey, l_suppkey, l_extendedprice, l_quantity, 'b' FROM new""",
)
def upsert_composite_key(spark, folder):
    lines = table(spark, folder, "lineitem")
    stored = lines.filter(F.col("l_linestatus") == "F").select(*_LINE_COLUMNS)
    stored = latest_per_key(stored, _LINE_KEY, _LINE_ORDER).withColumn("_sync_id", F.lit("a"))
    arriving = lines.filter(F.col("l_returnflag") != "R").select(*_LINE_COLUMNS, F.lit("b").alias("_sync_id"))
    return upsert(stored, arriving, _LINE_KEY, _LINE_ORDER)


@query(
    "upsert_stats",
    f"""WITH {STATE} SELECT (SELECT count(*) FROM arriving) AS fetched,
      (SELECT count(*) FROM latest) AS upserted,
      (SELECT count(*) FROM stored JOIN latest USING (id)) AS replaced,
      (SELECT count(*) FROM merged) AS total""",
)
def upsert_stats(spark, folder):
    # One row per key of either side says all there is to count.
    stored = stored_orders(spark, folder).select("id", F.lit(True).alias("_old"))
    arriving = arriving_orders(spark, folder).groupBy("id").agg(F.count("*").alias("_n"))
    both, fresh = F.col("_old").isNotNull() & F.col("_n").isNotNull(), F.col("_n").isNotNull()
    return stored.join(arriving, "id", "full_outer").agg(
        F.coalesce(F.sum("_n"), F.lit(0)).alias("fetched"), F.count_if(fresh).alias("upserted"),
        F.count_if(both).alias("replaced"), F.count("*").alias("total"),
    )


@query(
    "soft_delete_sweep",
    f"""WITH {STATE} SELECT id, _sync_id, CASE WHEN _sync_id <> 'b' AND _deleted_at IS NULL
      THEN TIMESTAMP '{AS_OF_TEXT}' ELSE _deleted_at END AS _deleted_at FROM stored""",
)
def soft_delete_sweep(spark, folder):
    return sweep(stored_orders(spark, folder), "b", at(AS_OF_TEXT)).select("id", "_sync_id", "_deleted_at")


@query(
    "soft_delete_sweep_unmarked",
    f"""WITH {STATE} SELECT id, _sync_id, CASE WHEN _sync_id IS DISTINCT FROM 'b' AND _deleted_at IS NULL
      THEN TIMESTAMP '{AS_OF_TEXT}' ELSE _deleted_at END AS _deleted_at FROM stored""",
)
def soft_delete_sweep_unmarked(spark, folder):
    swept = sweep(stored_orders(spark, folder), "b", at(AS_OF_TEXT), sweep_unmarked=True)
    return swept.select("id", "_sync_id", "_deleted_at")


def _snapshot_state(spark, folder, price):
    """All orders, those above the price not touched by run ``b``."""
    rows = order_rows(spark, folder)
    return rows.select(
        "id", F.lit(None).cast("timestamp_ntz").alias("_deleted_at"),
        F.when(F.col("o_totalprice") > price, "a").otherwise("b").alias("_sync_id"),
    )


def _guarded(spark, folder, price):
    state = _snapshot_state(spark, folder, price)
    fetched = state.agg(F.count_if(F.col("_sync_id") == "b")).scalar()
    return guarded_sweep(state, fetched, "b", at(AS_OF_TEXT))


_GUARDED = """
SELECT o_orderkey AS id, CASE WHEN o_totalprice > {price} THEN 'a' ELSE 'b' END AS _sync_id,
  CASE WHEN o_totalprice > {price} AND (
    SELECT (count(*) - count(*) FILTER (WHERE o_totalprice <= {price})) / count(*) * 100.0 <= 5.0 FROM orders)
  THEN TIMESTAMP '{as_of}' END AS _deleted_at
FROM orders"""


@query("soft_delete_guarded", _GUARDED.format(price=490000, as_of=AS_OF_TEXT))
def soft_delete_guarded(spark, folder):
    return _guarded(spark, folder, 490000)


@query("soft_delete_guard_stops", _GUARDED.format(price=400000, as_of=AS_OF_TEXT))
def soft_delete_guard_stops(spark, folder):
    return _guarded(spark, folder, 400000)


@query(
    "keys_missing",
    f"""WITH {STATE} SELECT id, updated_at FROM stored
    WHERE _deleted_at IS NULL AND id NOT IN (SELECT id FROM latest)""",
)
def keys_missing_query(spark, folder):
    missing = keys_missing(stored_orders(spark, folder), arriving_orders(spark, folder), ["id"])
    return missing.select("id", "updated_at")


@query(
    "active_count",
    f"""WITH {STATE} SELECT count(*) FILTER (WHERE _deleted_at IS NULL) AS active_rows,
      count(*) AS all_rows FROM merged""",
)
def active_count(spark, folder):
    merged = upsert_single_key(spark, folder)
    return merged.agg(F.count_if(is_active(merged)).alias("active_rows"), F.count("*").alias("all_rows"))
