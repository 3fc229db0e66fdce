"""Queries of bucketed state tables, and of tables that are kept up to date from their changes."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.model import RESOURCES
from tidemark.operators.feed import refreshed_groups, refreshed_sums, signed_rows
from tidemark.operators.marts import customer_value, revenue_daily
from tidemark.operators.reconcile import checksums, reconcile
from tidemark.plans.inputs import AS_OF_TEXT, STATE, arriving_orders, at, ledger, money, stored_orders, table
from tidemark.plans.ledger_queries import ROLLUP
from tidemark.plans.registry import query
from tidemark.scratch import scratch_folder, stored
from tidemark.sinks.bucketed import BucketedTable
from tidemark.sinks.rollup import RollupView

ORDERS = RESOURCES["orders"]


def _bucketed(spark, rows, buckets=8):
    """A bucketed table of the rows, which keep the run they name, and a folder of its own."""
    state = BucketedTable(spark, scratch_folder(spark, "bucketed"), ORDERS, buckets, rows.schema)
    state.merge(rows, "first", at("2000-01-01 00:00:00"))
    return state


@query(
    "upsert_bucketed",
    f"""WITH {STATE} SELECT id, updated_at, _raw, CAST(_synced_at AS TIMESTAMP) AS _synced_at, _deleted_at,
      CASE WHEN _sync_id = 'c' THEN 'c' ELSE 'first' END AS _sync_id FROM merged""",
)
def upsert_bucketed(spark, folder):
    """The merge of ``upsert_single_key`` through a bucketed table."""
    state = _bucketed(spark, stored_orders(spark, folder))
    state.merge(arriving_orders(spark, folder), "c", at("2001-08-01 00:00:00"))
    return state.read()


@query(
    "upsert_bucketed_delta",
    f"""WITH {STATE},
    few AS (SELECT * FROM latest WHERE id % 100 = 7)
    SELECT id, updated_at, _raw, _deleted_at FROM stored WHERE id NOT IN (SELECT id FROM few)
    UNION ALL SELECT id, updated_at, _raw, NULL FROM few""",
)
def upsert_bucketed_delta(spark, folder):
    """A merge small enough to lie on top of the stored rows, which stay as they are."""
    state = _bucketed(spark, stored_orders(spark, folder))
    state.merge(arriving_orders(spark, folder).filter(F.col("id") % 100 == 7), "c", at("2001-08-01 00:00:00"))
    return state.read().select("id", "updated_at", "_raw", "_deleted_at")


@query(
    "bucketed_changes",
    f"""WITH {STATE},
    few AS (SELECT * FROM latest WHERE id % 100 = 7)
    SELECT id, stored.updated_at AS before_at, few.updated_at AS after_at, stored.id IS NULL AS is_new
    FROM few LEFT JOIN stored USING (id)""",
)
def bucketed_changes(spark, folder):
    """What a merge changed: every key that it brought, with the row before and the row after it."""
    state = _bucketed(spark, stored_orders(spark, folder))
    state.merge(arriving_orders(spark, folder).filter(F.col("id") % 100 == 7), "c", at("2001-08-01 00:00:00"))
    return state.changes(1, 2).select(
        "id", F.col("before.updated_at").alias("before_at"), F.col("after.updated_at").alias("after_at"),
        F.col("before").isNull().alias("is_new"),
    )


def _sold(spark, folder):
    """Orders as typed rows of a state table."""
    return table(spark, folder, "orders").select(
        F.col("o_orderkey").alias("id"), F.col("o_orderdate").alias("updated_at"), F.col("o_custkey").alias("customer"),
        money("o_totalprice").alias("price"), at("1998-01-01 00:00:00").alias("_synced_at"),
        F.lit(None).cast("timestamp_ntz").alias("_deleted_at"), F.lit("a").alias("_sync_id"),
    )


def _orders_in_motion(spark, folder):
    """A table in three versions: orders before 1998; then some orders moved to another day, price and customer, and
    new ones; then a full snapshot that lacks some, which are swept."""
    orders = _sold(spark, folder)
    state = _bucketed(spark, orders.filter(F.col("updated_at") < at("1998-01-01 00:00:00")))
    moved = orders.filter(F.col("id") % 11 == 3).withColumns({
        "updated_at": F.col("updated_at") + F.expr("INTERVAL 1 DAY"), "price": (F.col("price") + 10).cast("decimal(12,2)"),
        "customer": F.when(F.col("id") % 2 == 0, F.col("customer") + 1).otherwise(F.col("customer")),
    })
    state.merge(moved, "b", at("1999-01-01 00:00:00"))
    state.merge(state.read().filter(F.col("id") % 40 != 1), "c", at(AS_OF_TEXT), full_snapshot=True)
    return state


_LIVE = """
sold AS (
  SELECT o_orderkey AS id, o_orderdate AS ts, o_custkey AS customer, CAST(o_totalprice AS DECIMAL(12,2)) AS price
  FROM orders),
moved AS (
  SELECT id, ts + INTERVAL 1 DAY AS ts, CASE WHEN id % 2 = 0 THEN customer + 1 ELSE customer END AS customer,
    price + 10 AS price FROM sold WHERE id % 11 = 3),
live AS (
  SELECT * FROM (
    SELECT * FROM sold WHERE ts < TIMESTAMP '1998-01-01 00:00:00' AND id % 11 <> 3 UNION ALL SELECT * FROM moved)
  WHERE id % 40 <> 1)"""


@query(
    "revenue_daily_changes",
    f"""WITH {_LIVE} SELECT CAST(ts AS DATE) AS day, count(*) AS orders,
      CAST(sum(price) AS DECIMAL(22,2)) AS revenue FROM live GROUP BY 1""",
)
def revenue_daily_changes(spark, folder):
    """Daily revenue, computed once and then moved from version to version by the changes alone."""
    state = _orders_in_motion(spark, folder)
    mart = stored(revenue_daily(state.read(1), "updated_at", "price"), "revenue")
    for old in (1, 2):
        signed = signed_rows(state.changes(old, old + 1), ["id"]).withColumn("day", F.to_date("updated_at"))
        mart = stored(refreshed_sums(mart, signed, ["day"], "orders", {"revenue": F.col("price")}), "revenue")
    return mart


@query(
    "customer_ltv_changes",
    f"""WITH {_LIVE} SELECT c_custkey AS customer, count(id) AS orders_count,
      coalesce(CAST(sum(price) AS DECIMAL(22,2)), 0) AS total_spent, min(ts) AS first_order_at, max(ts) AS last_order_at
    FROM customer LEFT JOIN live ON live.customer = c_custkey GROUP BY 1""",
)
def customer_ltv_changes(spark, folder):
    """Value of customers: those whose orders changed are computed again, the others stay."""
    state = _orders_in_motion(spark, folder)
    customers = table(spark, folder, "customer").select(F.col("c_custkey").alias("customer"))
    valued = lambda orders: lambda some: customer_value(
        some, orders.filter("_deleted_at IS NULL"), "customer", "updated_at", "price"
    )
    mart = stored(valued(state.read(1))(customers), "values")
    for old in (1, 2):
        signed = signed_rows(state.changes(old, old + 1), ["id"])
        mart = stored(refreshed_groups(mart, signed, customers, "customer", valued(state.read(old + 1))), "values")
    return mart


@query("rollup_refresh", ROLLUP)
def rollup_refresh(spark, folder):
    """The rollup as a view: runs of the first weeks, then late and wrong ones, then corrections and all the others."""
    runs = ledger(spark, folder)
    view = RollupView(spark, scratch_folder(spark, "rollup"))
    early = F.col("finished_at") < at("2024-01-20 00:00:00")
    late, wrong = F.hash("sync_id") % 10 == 0, F.hash("sync_id") % 10 == 1
    mistaken = runs.withColumns({
        "duration_seconds": (F.col("duration_seconds") + 5).cast("decimal(10,2)"), "fetched_count": F.lit(None).cast("int"),
        "status": F.lit("failed"),
    })
    signed = lambda rows, sign: rows.withColumn("_sign", F.lit(sign))
    view.refresh(signed(runs.filter(early & ~late & ~wrong), 1).unionByName(signed(mistaken.filter(early & wrong), 1)), "a")
    view.refresh(
        signed(mistaken.filter(early & wrong), -1).unionByName(signed(runs.filter(early & (late | wrong)), 1)), "b"
    )
    view.refresh(signed(runs.filter(~early), 1), "c")
    return view.read().withColumn("p95_duration_s", F.round("p95_duration_s", 6))


_LINES = ["o_orderdate", "o_totalprice", "o_orderstatus"]


@query(
    "reconcile_rows",
    """SELECT o_orderkey, 'missing' AS status FROM orders WHERE o_orderkey % 5000 = 7
    UNION ALL SELECT o_orderkey, 'changed' FROM orders WHERE o_orderkey % 5000 = 8
    UNION ALL SELECT o_orderkey + 100000000, 'extra' FROM orders WHERE o_orderkey % 5000 = 9""",
)
def reconcile_rows(spark, folder):
    """Two copies of the orders that differ in a few rows, and the stored checksums of both."""
    source = table(spark, folder, "orders").select("o_orderkey", *_LINES)
    step = F.col("o_orderkey") % 5000
    extra = source.filter(step == 9).withColumn("o_orderkey", F.col("o_orderkey") + 100_000_000)
    price = F.when(step == 8, F.col("o_totalprice") + 1).otherwise(F.col("o_totalprice"))
    copy = source.filter(step != 7).withColumn("o_totalprice", price).union(extra)
    sides = [stored(rows.repartitionByRange(8, "o_orderkey"), "copy") for rows in (source, copy)]
    sums = [stored(checksums(rows, "o_orderkey", _LINES, narrow=64), "checksums") for rows in sides]
    return reconcile(*sides, "o_orderkey", _LINES, *sums, narrow=64)
