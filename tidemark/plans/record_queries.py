"""Queries of page reading, record projection, nested fields and marts."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.functions.json import as_variant
from tidemark.functions.timestamps import parse_iso
from tidemark.model import RESOURCES
from tidemark.operators import marts, unnest
from tidemark.operators.merge import count_active, merge_counts, upsert
from tidemark.plans.inputs import at, order_records, product_records, table
from tidemark.plans.registry import query
from tidemark.scratch import stored
from tidemark.sources.incremental import Cursor, read_incremental
from tidemark.sources.pages import accepted, explode_pages, project_records, usable_ids

ORDERS, PRODUCTS = RESOURCES["orders"], RESOURCES["products"]
SYNCED = "2024-02-01 00:00:00"

_RECORDS = """
records AS (
  SELECT CASE WHEN o_orderstatus <> 'P' OR o_orderpriority <> '5-LOW' THEN o_orderkey END AS id, *,
    CAST(CAST(o_totalprice AS DECIMAL(12,2)) AS DOUBLE) AS price
  FROM orders)"""


def _ntz(*columns):
    return {c: F.col(c).cast("timestamp_ntz") for c in columns}


def _order_pages(spark, folder):
    """Envelope pages of up to 250 orders, as they would be landed."""
    records = order_records(spark, folder)
    return (
        records.groupBy(F.floor(F.col("o_orderkey") / 250).alias("_page"))
        .agg(F.array_join(F.sort_array(F.collect_list("_raw")), ",").alias("body"))
        .select("_page", F.concat(F.lit('{"orders":['), "body", F.lit("]}")).alias("value"))
    )


def _projected(spark, folder):
    return project_records(order_records(spark, folder), ORDERS, "run-1", at(SYNCED))


@query(
    "envelope_pages",
    f"""WITH {_RECORDS} SELECT o_orderkey // 250 AS _page, count(*) AS records, count(id) AS with_id,
      CAST(max(row) AS INT) AS last_pos
    FROM (SELECT *, row_number() OVER (PARTITION BY o_orderkey // 250) - 1 AS row FROM records) GROUP BY ALL""",
)
def envelope_pages(spark, folder):
    records = explode_pages(_order_pages(spark, folder), ORDERS)
    rows = project_records(records, ORDERS, "run-1", at(SYNCED))
    return rows.groupBy("_page").agg(
        F.count("*").alias("records"), F.count("id").alias("with_id"), F.max("_pos").alias("last_pos")
    )


@query(
    "raw_el",
    f"""WITH {_RECORDS} SELECT id, o_orderdate AS updated_at, TIMESTAMP '{SYNCED}' AS _synced_at,
      'run-1' AS _sync_id FROM records WHERE id IS NOT NULL""",
)
def raw_el(spark, folder):
    rows = accepted(_projected(spark, folder)).withColumns(_ntz("updated_at", "_synced_at"))
    return rows.select("id", "updated_at", "_synced_at", "_sync_id")


@query(
    "raw_el_composite",
    """SELECT l_partkey AS inventory_item_id, l_suppkey AS location_id, l_shipdate AS updated_at,
      length('{"inventory_item_id":' || l_partkey || ',"location_id":' || l_suppkey || ',"available":'
        || CAST(l_quantity AS INT) || ',"updated_at":"' || strftime(l_shipdate, '%Y-%m-%dT%H:%M:%SZ') || '"}')
        AS raw_length
    FROM lineitem""",
)
def raw_el_composite(spark, folder):
    record = F.struct(
        F.col("l_partkey").alias("inventory_item_id"), F.col("l_suppkey").alias("location_id"),
        F.col("l_quantity").cast("int").alias("available"),
        F.date_format("l_shipdate", "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("updated_at"),
    )
    records = table(spark, folder, "lineitem").select(F.to_json(record).alias("_raw"))
    rows = accepted(project_records(records, RESOURCES["inventory_levels"], "run-1", at(SYNCED)))
    rows = rows.withColumns(_ntz("updated_at"))
    length = F.length("_raw").cast("bigint").alias("raw_length")
    return rows.select("inventory_item_id", "location_id", "updated_at", length)


@query(
    "reject_split",
    f"""WITH {_RECORDS} SELECT count(*) AS fetched, count(id) AS accepted, count(*) - count(id) AS skipped
    FROM records""",
)
def reject_split(spark, folder):
    return merge_counts(_projected(spark, folder))


@query(
    "reject_reasons",
    """SELECT CASE WHEN event_type = 'error' THEN 'bad_json' WHEN event_type = 'signup' THEN 'no_key'
      WHEN event_type = 'click' THEN 'no_updated_at' END AS reason, count(*) AS records FROM events GROUP BY ALL""",
)
def reject_reasons(spark, folder):
    """Records that are cut off, lack an id or have a time of day for a timestamp."""
    kind = F.col("event_type")
    record = F.struct(
        F.when(kind != "signup", F.col("event_id")).alias("id"),
        F.when(kind == "click", F.date_format("ts", "HH:mm:ss"))
        .otherwise(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")).alias("updated_at"),
    )
    text = F.to_json(record)
    cut = F.when(kind == "error", F.substring(text, 1, 12)).otherwise(text)
    rows = project_records(table(spark, folder, "events").select(cut.alias("_raw")), ORDERS, "r", at(SYNCED))
    return rows.groupBy(F.col("_reject").alias("reason")).agg(F.count("*").alias("records"))


@query(
    "iso_timestamps",
    """SELECT event_id, CASE event_type WHEN 'error' THEN NULL WHEN 'view' THEN ts - INTERVAL 7 HOUR
      WHEN 'signup' THEN date_trunc('day', ts) WHEN 'purchase' THEN date_trunc('second', ts) ELSE ts END AS parsed
    FROM events""",
)
def iso_timestamps(spark, folder):
    """With ``Z``, with an offset, naive, compact, a bare date and a bare time of day."""
    kind = F.col("event_type")
    full = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    text = (
        F.when(kind == "error", F.date_format("ts", "HH:mm:ss"))
        .when(kind == "view", F.concat(full, F.lit("+07:00")))
        .when(kind == "signup", F.date_format("ts", "yyyy-MM-dd"))
        .when(kind == "purchase", F.date_format("ts", "yyyyMMdd'T'HHmmss'Z'"))
        .when(F.col("event_id") % 2 == 0, full)
        .otherwise(F.concat(full, F.lit("Z")))
    )
    return table(spark, folder, "events").select(
        "event_id", parse_iso(text).cast("timestamp_ntz").alias("parsed")
    )


@query(
    "read_orders",
    f"""WITH {_RECORDS} SELECT id, o_orderdate AS updated_at FROM records
    WHERE (o_orderdate, coalesce(id, 0)) > (TIMESTAMP '1999-06-01 00:00:00', 100) AND id IS NOT NULL""",
)
def read_orders(spark, folder):
    """Pages, records and cursor together, as an incremental run reads them."""
    from datetime import datetime

    rows = project_records(explode_pages(_order_pages(spark, folder), ORDERS), ORDERS, "run-1", at(SYNCED))
    new = accepted(read_incremental(rows, Cursor(datetime(1999, 6, 1), 100)))
    return new.withColumns(_ntz("updated_at")).select("id", "updated_at")


@query(
    "read_customers",
    "SELECT c_custkey AS id, c_name AS name, c_mktsegment AS segment FROM customer",
)
def read_customers(spark, folder):
    record = F.struct(F.col("c_custkey").alias("id"), F.col("c_name").alias("name"),
                      F.col("c_mktsegment").alias("tags"), F.lit("2024-01-01T00:00:00Z").alias("updated_at"))
    bodies = table(spark, folder, "customer").select(
        F.concat(F.lit('{"customers":['), F.to_json(record), F.lit("]}")).alias("value")
    )
    resource = RESOURCES["customers"]
    rows = accepted(project_records(explode_pages(bodies, resource), resource, "r", at(SYNCED)))
    named = unnest.flatten(rows, {"name": ("name", "string"), "segment": ("tags", "string")})
    return named.select("id", "name", "segment")


@query("read_products", "SELECT p_partkey AS id, CAST(p_size % 5 + 1 AS BIGINT) AS variants FROM part")
def read_products(spark, folder):
    """Variants stay inside the record."""
    bodies = product_records(spark, folder).select(
        F.concat(F.lit('{"products":['), "_raw", F.lit("]}")).alias("value")
    )
    kept = explode_pages(bodies, PRODUCTS)
    rows = project_records(kept, PRODUCTS, "r", at(SYNCED))
    return rows.select("id", F.json_array_length(F.get_json_object("_raw", "$.variants")).cast("bigint").alias("variants"))


@query(
    "read_inventory",
    """SELECT p_partkey AS inventory_item_id, CAST(p_size AS BIGINT) AS location_id, p_size * 3 AS available
    FROM part WHERE p_size <> 7""",
)
def read_inventory(spark, folder):
    """Levels have a key of two fields and may lack a time; those without a place are rejected."""
    size = F.col("p_size")
    record = F.struct(F.col("p_partkey").alias("inventory_item_id"),
                      F.when(size != 7, size).alias("location_id"), (size * 3).alias("available"))
    bodies = table(spark, folder, "part").select(
        F.concat(F.lit('{"inventory_locations":['), F.to_json(record), F.lit("]}")).alias("value")
    )
    resource = RESOURCES["inventory_levels"]
    rows = accepted(project_records(explode_pages(bodies, resource), resource, "r", at(SYNCED)))
    levels = unnest.promote_field(rows, "available", "int")
    return levels.select("inventory_item_id", "location_id", "available")


@query("location_ids", "SELECT CAST(n_nationkey AS BIGINT) AS id FROM nation WHERE n_nationkey <> 0")
def location_ids(spark, folder):
    record = F.struct(F.col("n_nationkey").alias("id"), F.col("n_name").alias("name"))
    bodies = table(spark, folder, "nation").select(
        F.concat(F.lit('{"locations":['), F.to_json(record), F.lit("]}")).alias("value")
    )
    resource = RESOURCES["locations"]
    return usable_ids(project_records(explode_pages(bodies, resource), resource, "r", at(SYNCED)))


@query(
    "sync_orders",
    f"""WITH {_RECORDS}, stored AS (
      SELECT id, CAST(NULL AS VARCHAR) AS total FROM records
      WHERE o_orderdate < TIMESTAMP '2000-01-01' AND id IS NOT NULL),
    arriving AS (
      SELECT id, CAST(CAST(o_totalprice AS DECIMAL(12,2)) AS VARCHAR) AS total FROM records
      WHERE o_orderdate > TIMESTAMP '1999-06-01 00:00:00' AND id IS NOT NULL),
    merged AS (
      SELECT * FROM stored WHERE id NOT IN (SELECT id FROM arriving) UNION ALL SELECT * FROM arriving)
    SELECT count(*) AS active_rows, count(*) FILTER (WHERE total IS NULL) AS untouched,
      CAST(sum(CAST(total AS DECIMAL(12,2))) AS DOUBLE) AS arrived_total FROM merged""",
)
def sync_orders(spark, folder):
    """End to end: pages, records, cursor, merge, active rows."""
    from datetime import datetime

    rows = project_records(explode_pages(_order_pages(spark, folder), ORDERS), ORDERS, "run-1", at(SYNCED))
    columns = ["id", "updated_at", "_raw", "_synced_at", "_sync_id"]
    stored = accepted(rows).filter(F.col("updated_at") < at("2000-01-01 00:00:00")).select(*columns)
    stored = stored.withColumns(
        {"_raw": F.lit("{}"), "_sync_id": F.lit("run-0"), "_deleted_at": F.lit(None).cast("timestamp")}
    )
    new = accepted(read_incremental(rows, Cursor(datetime(1999, 6, 1), 10**15)))
    merged = upsert(stored, new, ["id"], ["updated_at", "_page", "_pos"])
    total = unnest.flatten(merged, {"total": ("total_price", unnest.MONEY)})
    return total.agg(
        F.count_if(F.col("_deleted_at").isNull()).alias("active_rows"),
        F.count_if(F.col("total").isNull()).alias("untouched"),
        F.sum("total").cast("double").alias("arrived_total"),
    )


# --- nested fields ------------------------------------------------------------------------------


@query(
    "unnest_lines",
    f"""WITH {_RECORDS} SELECT id AS order_id, o_orderkey * 10 + i AS id, o_custkey + i AS product_id,
      'SKU-' || (o_custkey + i) AS sku, CAST(i AS INT) AS quantity, price
    FROM records, unnest(range(1, o_custkey % 4 + 2)) AS t(i)""",
)
def unnest_lines(spark, folder):
    lines = unnest.order_lines(_projected(spark, folder))
    return lines.select(
        "order_id", "id", "product_id", "sku", "quantity", F.col("price").cast("double").alias("price")
    )


@query(
    "amount_by_gateway",
    f"""WITH {_RECORDS} SELECT (['cod', 'card', 'bank'])[(o_orderkey + i) % 3 + 1] AS gateway,
      CAST(sum(CAST(o_totalprice AS DECIMAL(12,2))) AS DOUBLE) AS total
    FROM records, unnest(range(1, o_orderkey % 2 + 2)) AS t(i) GROUP BY ALL""",
)
def amount_by_gateway(spark, folder):
    totals = unnest.amount_by_gateway(order_records(spark, folder))
    return totals.withColumn("total", F.col("total").cast("double"))


@query(
    "unnest_variants",
    """SELECT p_partkey * 8 + i AS id, p_partkey AS product_id, p_brand || '/' || i AS sku,
      p_partkey * 8 + i + 7 AS inventory_item_id, p_size AS inventory_quantity,
      CAST(CAST(p_retailprice AS DECIMAL(12,2)) AS DOUBLE) AS price
    FROM part, unnest(range(1, p_size % 5 + 2)) AS t(i)""",
)
def unnest_variants(spark, folder):
    variants = unnest.product_variants(product_records(spark, folder))
    return variants.select(
        "id", "product_id", "sku", "inventory_item_id", "inventory_quantity",
        F.col("price").cast("double").alias("price"),
    )


_VARIANT_IDS = """
ids AS (SELECT DISTINCT p_partkey * 8 + i AS id FROM part, unnest(range(1, p_size % 5 + 2)) AS t(i)
        WHERE p_size >= 5)"""


@query("unnest_variant_ids", f"WITH {_VARIANT_IDS} SELECT id FROM ids")
def unnest_variant_ids(spark, folder):
    return unnest.variant_ids(product_records(spark, folder))


@query(
    "request_batches",
    f"""WITH {_VARIANT_IDS}, numbered AS (SELECT id, (row_number() OVER (ORDER BY id) - 1) // 200 AS batch_no FROM ids)
    SELECT batch_no, string_agg(CAST(id AS VARCHAR), ',' ORDER BY id) AS variant_ids,
      (SELECT string_agg(CAST(n_nationkey AS VARCHAR), ',' ORDER BY n_nationkey) FROM nation) AS location_ids
    FROM numbered GROUP BY ALL""",
)
def request_batches(spark, folder):
    ids = unnest.variant_ids(product_records(spark, folder))
    return unnest.request_batches(ids, table(spark, folder, "nation"), location_column="n_nationkey")


@query(
    "flatten_object",
    f"""WITH {_RECORDS} SELECT o_orderkey, '#' || o_orderkey AS order_number, price AS total_price,
      o_orderstatus AS financial_status, o_custkey AS customer_id, 'c' || o_custkey || '@example.com' AS customer_email,
      CAST(NULL AS VARCHAR) AS customer_phone, 'Customer ' || o_custkey AS shipping_name,
      o_orderpriority AS shipping_city, 'VN' AS shipping_country
    FROM records""",
)
def flatten_object(spark, folder):
    flat = unnest.flatten(order_records(spark, folder), unnest.ORDER_COLUMNS)
    return flat.drop("_raw").withColumn("total_price", F.col("total_price").cast("double"))


@query(
    "field_mapping",
    """SELECT o_orderkey AS id, CAST(CAST(o_totalprice AS DECIMAL(12,2)) AS DOUBLE) AS revenue,
      TRY_CAST(substring(o_orderpriority, 1, 1) AS INT) AS priority,
      TRY_CAST(CASE WHEN o_orderstatus = 'O' THEN '1' ELSE o_orderstatus END AS INT) AS status,
      CASE WHEN o_orderstatus <> 'O' THEN 'type of status_text' END AS _reject
    FROM orders""",
)
def field_mapping(spark, folder):
    """Rename, skip and re-type; statuses that are no number are rejected."""
    rows = table(spark, folder, "orders").select(
        F.col("o_orderkey").alias("id"), F.col("o_totalprice").cast("string").alias("total_price"),
        F.substring("o_orderpriority", 1, 1).alias("priority"), "o_custkey",
        F.when(F.col("o_orderstatus") == "O", "1").otherwise(F.col("o_orderstatus")).alias("status_text"),
    )
    mapped = unnest.apply_mapping(
        rows, ["id"],
        rename={"total_price": "revenue", "status_text": "status"},
        skip=["o_custkey"],
        types={"total_price": unnest.MONEY, "priority": "int", "status_text": "int"},
    )
    return mapped.withColumn("revenue", F.col("revenue").cast("double"))


@query("promote_field", "SELECT event_id, CAST(json_extract_string(props, '$.k') AS INT) AS k FROM events")
def promote_field(spark, folder):
    rows = table(spark, folder, "events").select("event_id", F.col("props").alias("_raw"))
    return unnest.promote_field(rows, "k", "int").drop("_raw")


def _as_variants(rows):
    """The table with ``_raw`` stored as VARIANT."""
    return stored(rows.withColumn("_raw", as_variant(F.col("_raw"))), "variants")


@query(
    "promote_variant",
    f"""WITH {_RECORDS} SELECT id, '#' || o_orderkey AS order_number, price AS total_price, o_custkey AS customer_id,
      'c' || o_custkey || '@example.com' AS customer_email, CAST(NULL AS VARCHAR) AS customer_phone,
      o_orderpriority AS shipping_city FROM records""",
)
def promote_variant(spark, folder):
    """Typed columns out of records that are stored as VARIANT, objects within them included."""
    rows = _as_variants(_projected(spark, folder).select("id", "_raw"))
    for column in ("order_number", "total_price", "customer_id", "customer_email", "customer_phone", "shipping_city"):
        rows = unnest.promote_variant(rows, *unnest.ORDER_COLUMNS[column], column)
    return rows.withColumn("total_price", F.col("total_price").cast("double")).drop("_raw")


@query(
    "unnest_variant_lines",
    f"""WITH {_RECORDS} SELECT id AS order_id, o_orderkey * 10 + i AS id, o_custkey + i AS product_id,
      'SKU-' || (o_custkey + i) AS sku, CAST(i AS INT) AS quantity, price
    FROM records, unnest(range(1, o_custkey % 4 + 2)) AS t(i)""",
)
def unnest_variant_lines(spark, folder):
    """Lines of orders that are stored as VARIANT."""
    rows = _as_variants(_projected(spark, folder).select(F.col("id").alias("order_id"), "_raw"))
    lines = unnest.unnest_variant(rows, "line_items", unnest.LINE_FIELDS, ["order_id"])
    return lines.select("order_id", "id", "product_id", "sku", "quantity", F.col("price").cast("double").alias("price"))


# --- marts ---------------------------------------------------------------------------------------


@query(
    "revenue_daily",
    """SELECT strftime(o_orderdate, '%Y-%m-%d') AS day, count(*) AS orders,
      CAST(sum(CAST(o_totalprice AS DECIMAL(12,2))) AS DOUBLE) AS revenue FROM orders GROUP BY ALL""",
)
def revenue_daily(spark, folder):
    days = marts.revenue_daily(table(spark, folder, "orders"), "o_orderdate", "o_totalprice")
    return days.withColumns({"day": F.col("day").cast("string"), "revenue": F.col("revenue").cast("double")})


@query(
    "low_stock",
    """SELECT p_partkey, p_name, CAST(coalesce(sum(l_quantity), 0) AS BIGINT) AS available
    FROM part LEFT JOIN lineitem ON l_partkey = p_partkey GROUP BY ALL HAVING available < 700""",
)
def low_stock(spark, folder):
    levels = table(spark, folder, "lineitem").select(
        F.col("l_partkey").alias("p_partkey"), F.col("l_quantity").cast("bigint").alias("available")
    )
    items = table(spark, folder, "part").select("p_partkey", "p_name")
    return marts.low_stock(levels, items, "p_partkey", "available", 700)


@query(
    "customer_ltv",
    """SELECT c_custkey, c_name, count(o_orderkey) AS orders_count,
      CAST(coalesce(sum(CAST(o_totalprice AS DECIMAL(12,2))), 0) AS DOUBLE) AS total_spent,
      min(o_orderdate) AS first_order_at, max(o_orderdate) AS last_order_at
    FROM customer LEFT JOIN orders ON o_custkey = c_custkey GROUP BY ALL""",
)
def customer_ltv(spark, folder):
    customers = table(spark, folder, "customer").select("c_custkey", "c_name")
    orders = table(spark, folder, "orders").withColumnRenamed("o_custkey", "c_custkey")
    value = marts.customer_value(customers, orders, "c_custkey", "o_orderdate", "o_totalprice")
    return value.withColumn("total_spent", F.col("total_spent").cast("double"))


@query(
    "sales_rank",
    """WITH sold AS (
      SELECT p_partkey, p_brand, CAST(sum(l_quantity) AS BIGINT) AS sold FROM lineitem
      JOIN part ON p_partkey = l_partkey GROUP BY ALL)
    SELECT p_partkey, p_brand, sold, CAST(rank() OVER (PARTITION BY p_brand ORDER BY sold DESC) AS BIGINT) AS sales_rank
    FROM sold QUALIFY rank() OVER (PARTITION BY p_brand ORDER BY sold DESC) <= 10""",
)
def sales_rank(spark, folder):
    lines = table(spark, folder, "lineitem").select(
        F.col("l_partkey").alias("p_partkey"), F.col("l_quantity").cast("bigint").alias("quantity")
    )
    items = table(spark, folder, "part").select("p_partkey", "p_brand")
    ranked = marts.sales_rank(lines, items, "p_partkey", "quantity", "p_brand", 10)
    return ranked.withColumn("sales_rank", F.col("sales_rank").cast("bigint"))
