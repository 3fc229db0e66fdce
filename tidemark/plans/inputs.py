"""Inputs of the registered queries, derived from the given tables: in Spark and, for the check, in SQL."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

AS_OF_TEXT = "2024-01-31 00:00:00"
AS_OF = datetime(2024, 1, 31)


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark.read.parquet(f"{folder}/{name}.parquet")


def at(text: str) -> Column:
    return F.lit(text).cast("timestamp_ntz")


def money(column: str) -> Column:
    return F.col(column).cast("decimal(12,2)")


def pick(position: Column, *values: str) -> Column:
    return F.element_at(F.array(*(F.lit(v) for v in values)), (position + 1).cast("int"))


# --- run ledger, one run per event ------------------------------------------------------------


def ledger(spark: SparkSession, folder: str) -> DataFrame:
    k = F.get_json_object("props", "$.k").cast("int")
    kind, event = F.col("event_type"), F.col("event_id")
    fetched = F.when(k < 40, 0).otherwise(k)
    running = kind == "signup"
    sync_id = F.md5(event.cast("string"))
    return table(spark, folder, "events").select(
        sync_id.alias("sync_id"),
        F.concat(F.lit("p"), F.col("user_id") % 3).alias("pipeline"),
        pick(F.col("user_id") % 5, "orders", "customers", "products", "inventory_levels", "locations")
        .alias("resource"),
        F.when(event % 7 == 0, "full_refresh").otherwise("incremental").alias("mode"),
        F.when(event % 4 == 0, "manual").otherwise("schedule").alias("trigger"),
        F.col("ts").alias("started_at"),
        F.when(~running, F.col("ts") + F.make_dt_interval(secs=F.col("value").cast("decimal(18,6)")))
        .alias("finished_at"),
        F.when(kind == "error", "failed").when(running, "running").otherwise("success").alias("status"),
        F.when(~running, fetched).alias("fetched_count"),
        F.when(~running, F.greatest(fetched - (event % 3).cast("int"), F.lit(0))).alias("upserted_count"),
        F.when(~running, fetched + (event % 9).cast("int")).alias("rows_before"),
        F.when(~running, fetched + (event % 5).cast("int")).alias("rows_after"),
        F.when(~running, F.col("value").cast("decimal(10,2)")).alias("duration_seconds"),
        F.when(kind == "error", F.concat(F.lit("HTTP 500: token=`"), sync_id, F.lit("` *bad_gateway*")))
        .alias("error"),
    )


LEDGER = """
raw_events AS (
  SELECT *, CASE WHEN CAST(json_extract_string(props, '$.k') AS INT) < 40 THEN 0
                 ELSE CAST(json_extract_string(props, '$.k') AS INT) END AS fetched,
         md5(CAST(event_id AS VARCHAR)) AS run_id
  FROM events),
ledger AS (
  SELECT run_id AS sync_id,
    'p' || CAST(user_id % 3 AS VARCHAR) AS pipeline,
    (['orders','customers','products','inventory_levels','locations'])[CAST(user_id % 5 AS INT) + 1] AS resource,
    CASE WHEN event_id % 7 = 0 THEN 'full_refresh' ELSE 'incremental' END AS mode,
    CASE WHEN event_id % 4 = 0 THEN 'manual' ELSE 'schedule' END AS trigger,
    ts AS started_at,
    CASE WHEN event_type <> 'signup' THEN ts + to_microseconds(CAST(round(value * 1000000) AS BIGINT)) END
      AS finished_at,
    CASE event_type WHEN 'error' THEN 'failed' WHEN 'signup' THEN 'running' ELSE 'success' END AS status,
    CASE WHEN event_type <> 'signup' THEN fetched END AS fetched_count,
    CASE WHEN event_type <> 'signup' THEN greatest(fetched - event_id % 3, 0) END AS upserted_count,
    CASE WHEN event_type <> 'signup' THEN fetched + event_id % 9 END AS rows_before,
    CASE WHEN event_type <> 'signup' THEN fetched + event_id % 5 END AS rows_after,
    CASE WHEN event_type <> 'signup' THEN CAST(value AS DECIMAL(10,2)) END AS duration_seconds,
    CASE WHEN event_type = 'error' THEN 'HTTP 500: token=`' || run_id || '` *bad_gateway*' END AS error
  FROM raw_events)"""

HISTORY = f"""{LEDGER},
history AS (
  SELECT *,
    count(*) OVER last7 AS prev_count,
    coalesce(sum(CASE WHEN coalesce(fetched_count, 0) = 0 THEN 1 ELSE 0 END) OVER last2, 0) AS prev_zeros,
    last_value(CASE WHEN mode = 'full_refresh' THEN coalesce(fetched_count, 0) END IGNORE NULLS) OVER last7
      AS prev_full_fetched,
    lag(rows_after) OVER ordered AS prev_rows
  FROM ledger WHERE status = 'success'
  WINDOW ordered AS (PARTITION BY pipeline, resource ORDER BY started_at, sync_id),
    last7 AS (PARTITION BY pipeline, resource ORDER BY started_at, sync_id ROWS BETWEEN 7 PRECEDING AND 1 PRECEDING),
    last2 AS (PARTITION BY pipeline, resource ORDER BY started_at, sync_id ROWS BETWEEN 2 PRECEDING AND 1 PRECEDING))"""

RESULTS = f"""{HISTORY},
percents AS (
  SELECT *,
    (fetched_count - upserted_count) / greatest(fetched_count, 1) * 100.0 AS skipped_pct,
    abs(fetched_count - prev_full_fetched) / greatest(prev_full_fetched, 1) * 100.0 AS drift_pct,
    (rows_before - fetched_count) / greatest(rows_before, 1) * 100.0 AS delete_pct
  FROM history),
results AS (
  SELECT sync_id, pipeline, resource, finished_at, 'fetch_upsert_parity' AS rule,
    CASE WHEN skipped_pct > 1.0 THEN 'failed' ELSE 'ok' END AS status, skipped_pct AS percent
  FROM percents
  UNION ALL
  SELECT sync_id, pipeline, resource, finished_at, 'volume_sanity',
    CASE WHEN mode <> 'incremental' THEN 'skipped' WHEN fetched_count > 0 THEN 'ok'
         WHEN prev_zeros >= 2 THEN 'warning' ELSE 'ok' END, NULL
  FROM percents
  UNION ALL
  SELECT sync_id, pipeline, resource, finished_at, 'weekly_full_drift',
    CASE WHEN mode <> 'full_refresh' OR prev_full_fetched IS NULL THEN 'skipped'
         WHEN drift_pct > 20.0 THEN 'failed' WHEN drift_pct > 5.0 THEN 'warning' ELSE 'ok' END,
    CASE WHEN mode = 'full_refresh' THEN drift_pct END
  FROM percents
  UNION ALL
  SELECT sync_id, pipeline, resource, finished_at, 'soft_delete_sanity',
    CASE WHEN mode <> 'full_refresh' THEN 'skipped' WHEN delete_pct > 5.0 THEN 'failed' ELSE 'ok' END,
    CASE WHEN mode = 'full_refresh' THEN delete_pct END
  FROM percents)"""

# --- logs, requests and signs of life ------------------------------------------------------------


def logs(spark: SparkSession, folder: str) -> DataFrame:
    kind = F.col("event_type")
    level = (
        F.when(kind == "error", "ERROR").when(kind == "signup", "CRITICAL")
        .when(kind == "purchase", "WARNING").when(kind == "view", "INFO").otherwise("DEBUG")
    )
    return table(spark, folder, "events").select(
        F.col("event_id"),
        F.col("ts").alias("timestamp"),
        level.alias("level"),
        kind.alias("event"),
        F.md5((F.col("event_id") - F.col("event_id") % 10).cast("string")).alias("sync_id"),
        F.concat(F.lit("p"), F.col("user_id") % 3).alias("pipeline"),
        F.concat(kind, F.lit(" by "), F.col("user_id")).alias("message"),
    )


LOGS = """
logs AS (
  SELECT event_id, ts AS "timestamp",
    CASE event_type WHEN 'error' THEN 'ERROR' WHEN 'signup' THEN 'CRITICAL' WHEN 'purchase' THEN 'WARNING'
      WHEN 'view' THEN 'INFO' ELSE 'DEBUG' END AS level,
    event_type AS event,
    md5(CAST(event_id - event_id % 10 AS VARCHAR)) AS sync_id,
    'p' || CAST(user_id % 3 AS VARCHAR) AS pipeline,
    event_type || ' by ' || CAST(user_id AS VARCHAR) AS message
  FROM events)"""


def requests(spark: SparkSession, folder: str) -> DataFrame:
    kind = F.col("event_type")
    status = (
        F.when(kind == "error", "failed").when(kind == "signup", "pending")
        .when(kind == "purchase", "claimed").when(kind == "view", "done").otherwise("cancelled")
    )
    ended = kind.isin("error", "view", "click")
    return table(spark, folder, "events").select(
        F.col("event_id").alias("id"),
        F.concat(F.lit("p"), F.col("user_id") % 3).alias("pipeline"),
        status.alias("status"),
        F.when(kind != "signup", F.col("ts")).alias("claimed_at"),
        F.when(ended, F.col("ts") + F.make_dt_interval(secs=F.col("value").cast("decimal(18,6)")))
        .alias("finished_at"),
    )


REQUESTS = """
requests AS (
  SELECT event_id AS id, 'p' || CAST(user_id % 3 AS VARCHAR) AS pipeline,
    CASE event_type WHEN 'error' THEN 'failed' WHEN 'signup' THEN 'pending' WHEN 'purchase' THEN 'claimed'
      WHEN 'view' THEN 'done' ELSE 'cancelled' END AS status,
    CASE WHEN event_type <> 'signup' THEN ts END AS claimed_at,
    CASE WHEN event_type IN ('error', 'view', 'click')
      THEN ts + to_microseconds(CAST(round(value * 1000000) AS BIGINT)) END AS finished_at
  FROM events)"""


def beats(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "events").groupBy("user_id").agg(
        F.min("ts").alias("started_at"), F.max("ts").alias("last_beat")
    )


BEATS = """
beats AS (SELECT user_id, min(ts) AS started_at, max(ts) AS last_beat FROM events GROUP BY user_id)"""

# --- source records: JSON text built from the rows --------------------------------------------------


def iso(column: str) -> Column:
    return F.date_format(column, "yyyy-MM-dd'T'HH:mm:ss'Z'")


def order_records(spark: SparkSession, folder: str) -> DataFrame:
    """One JSON order per row; open low-priority orders have lost their id."""
    return as_records(table(spark, folder, "orders"))


def as_records(orders: DataFrame, *others: str) -> DataFrame:
    """The JSON order of each row of ``orders``, and its columns ``others``."""
    key, customer = F.col("o_orderkey"), F.col("o_custkey")
    lost = (F.col("o_orderstatus") == "P") & (F.col("o_orderpriority") == "5-LOW")
    email = F.concat(F.lit("c"), customer, F.lit("@example.com"))
    price = money("o_totalprice").cast("string")
    line = lambda i: F.struct(
        (key * 10 + i).alias("id"), (customer + i).alias("product_id"),
        F.concat(F.lit("SKU-"), customer + i).alias("sku"), i.alias("quantity"), price.alias("price"),
    )
    payment = lambda i: F.struct(
        pick((key + i) % 3, "cod", "card", "bank").alias("gateway"), price.alias("amount")
    )
    record = F.struct(
        F.when(~lost, key).alias("id"),
        F.concat(F.lit("#"), key).alias("order_number"),
        price.alias("total_price"),
        F.col("o_orderstatus").alias("financial_status"),
        F.struct(customer.alias("id"), email.alias("email")).alias("customer"),
        F.struct(
            F.concat(F.lit("Customer "), customer).alias("name"),
            F.col("o_orderpriority").alias("city"), F.lit("VN").alias("country"),
        ).alias("shipping_address"),
        F.transform(F.sequence(F.lit(1), (customer % 4 + 1).cast("int")), line).alias("line_items"),
        F.transform(F.sequence(F.lit(1), (key % 2 + 1).cast("int")), payment).alias("transactions"),
        iso("o_orderdate").alias("updated_at"),
    )
    return orders.select(key.alias("o_orderkey"), *others, F.to_json(record).alias("_raw"))


def product_records(spark: SparkSession, folder: str) -> DataFrame:
    """One JSON product per row with its variants; products of the smallest sizes are soft-deleted."""
    key = F.col("p_partkey")
    variant = lambda i: F.struct(
        (key * 8 + i).alias("id"), key.alias("product_id"),
        F.concat("p_brand", F.lit("/"), i).alias("sku"),
        money("p_retailprice").cast("string").alias("price"), (key * 8 + i + 7).alias("inventory_item_id"),
        F.col("p_size").alias("inventory_quantity"),
    )
    record = F.struct(
        key.alias("id"), F.col("p_name").alias("title"),
        F.transform(F.sequence(F.lit(1), F.col("p_size") % 5 + 1), variant).alias("variants"),
    )
    return table(spark, folder, "part").select(
        key.alias("id"), F.to_json(record).alias("_raw"),
        F.when(F.col("p_size") < 5, at(AS_OF_TEXT)).alias("_deleted_at"),
    )


# --- order state: what is stored, and what arrives ---------------------------------------------------


def order_rows(spark: SparkSession, folder: str) -> DataFrame:
    raw = F.concat(
        F.lit('{"id":'), "o_orderkey", F.lit(',"status":"'), "o_orderstatus",
        F.lit('","total_price":"'), money("o_totalprice"), F.lit('"}'),
    )
    return table(spark, folder, "orders").select(
        F.col("o_orderkey").alias("id"), F.col("o_orderdate").alias("updated_at"), raw.alias("_raw"),
        "o_orderstatus", "o_orderpriority", "o_totalprice",
    )


def stored_orders(spark: SparkSession, folder: str) -> DataFrame:
    """Orders of the years before 2000, from two earlier runs; urgent ones are soft-deleted."""
    rows = order_rows(spark, folder).filter(F.col("updated_at") < at("2000-01-01 00:00:00"))
    return rows.select(
        "id", "updated_at", "_raw",
        at("2000-01-01 00:00:00").alias("_synced_at"),
        F.when(F.col("o_orderpriority") == "1-URGENT", at("1999-12-31 00:00:00")).alias("_deleted_at"),
        F.when(F.col("o_orderstatus") == "O", "a").when(F.col("o_orderstatus") == "F", "b").alias("_sync_id"),
    )


def arriving_orders(spark: SparkSession, folder: str) -> DataFrame:
    """Orders since 1998, each twice: as it is now, and as it was a day earlier."""
    rows = order_rows(spark, folder).filter(F.col("updated_at") >= at("1998-01-01 00:00:00"))
    now = rows.select("id", "updated_at", "_raw")
    earlier = rows.select("id", (F.col("updated_at") - F.expr("INTERVAL 1 DAY")).alias("updated_at"),
                          F.lit("{}").alias("_raw"))
    return now.unionByName(earlier).withColumns(
        {"_synced_at": at("2001-08-01 00:00:00"), "_sync_id": F.lit("c")}
    )


STATE = """
order_rows AS (
  SELECT o_orderkey AS id, o_orderdate AS updated_at,
    '{"id":' || CAST(o_orderkey AS VARCHAR) || ',"status":"' || o_orderstatus || '","total_price":"'
      || CAST(CAST(o_totalprice AS DECIMAL(12,2)) AS VARCHAR) || '"}' AS _raw,
    o_orderstatus, o_orderpriority, o_totalprice
  FROM orders),
stored AS (
  SELECT id, updated_at, _raw, TIMESTAMP '2000-01-01 00:00:00' AS _synced_at,
    CASE WHEN o_orderpriority = '1-URGENT' THEN TIMESTAMP '1999-12-31 00:00:00' END AS _deleted_at,
    CASE o_orderstatus WHEN 'O' THEN 'a' WHEN 'F' THEN 'b' END AS _sync_id
  FROM order_rows WHERE updated_at < TIMESTAMP '2000-01-01 00:00:00'),
arriving AS (
  SELECT id, updated_at, _raw FROM order_rows WHERE updated_at >= TIMESTAMP '1998-01-01 00:00:00'
  UNION ALL
  SELECT id, updated_at - INTERVAL 1 DAY, '{}' FROM order_rows
  WHERE updated_at >= TIMESTAMP '1998-01-01 00:00:00'),
latest AS (
  SELECT * FROM arriving QUALIFY row_number() OVER (PARTITION BY id ORDER BY updated_at DESC) = 1),
merged AS (
  SELECT * FROM stored WHERE id NOT IN (SELECT id FROM latest)
  UNION ALL
  SELECT id, updated_at, _raw, TIMESTAMP '2001-08-01 00:00:00', NULL, 'c' FROM latest)"""
