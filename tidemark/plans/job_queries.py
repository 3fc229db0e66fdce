"""Queries of the stored tables that whole jobs leave behind: state, checkpoints, ledger, results, logs."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import functions as F

from tidemark.functions.redact import CASE_PARTNERS, redact_json, redact_text
from tidemark.model import RESOURCES
from tidemark.operators import reports
from tidemark.operators.rules import RULES
from tidemark.plans.event_queries import _ACCEPTED, _land, _land_orders
from tidemark.plans.inputs import LEDGER, LOGS, RESULTS, ledger, logs, table
from tidemark.plans.ledger_queries import KEEP, _EXPIRED_LOGS, _results, now
from tidemark.plans.record_queries import _projected
from tidemark.plans.registry import query
from tidemark.plans.sync import SyncSpec, Warehouse, run_sync
from tidemark.scratch import scratch_folder
from tidemark.sinks.tables import append_rows, compact_rows, read_days, retain_days
from tidemark.sources.pages import explode_pages, project_records, rejected
from tidemark.streaming.sync import start_sync_stream


def _run(warehouse, landing, name, mode="incremental", day=1, resource="orders"):
    spec = SyncSpec("shop", resource, mode, sync_id=name)
    as_of = datetime(2024, 2, day, tzinfo=timezone.utc)
    return run_sync(warehouse, spec, landing, as_of, one_per_file=False)


def _warehouse(spark, work):
    return Warehouse(spark, f"{work}/warehouse", buckets=4)


@query(
    "broken_page_fails",
    f"""SELECT 'failed' AS status, true AS says_why, 0::BIGINT AS cursors, count(*) AS stored_after_repair
    FROM orders WHERE {_ACCEPTED}""",
)
def broken_page_fails(spark, folder):
    """A page that was cut off fails the run and leaves no checkpoint; landed whole, all of it is stored."""
    work = scratch_folder(spark, "broken-page")
    _land_orders(table(spark, folder, "orders"), f"{work}/whole")
    pages = spark.read.text(f"{work}/whole")
    half = F.substring("value", F.lit(1), (F.length("value") / 2).cast("int"))
    cut = F.when(F.xxhash64("value") == pages.agg(F.min(F.xxhash64("value"))).scalar(), half).otherwise(F.col("value"))
    pages.select(cut.alias("value")).write.option("compression", "gzip").text(f"{work}/cut")
    warehouse = _warehouse(spark, work)
    broken = _run(warehouse, f"{work}/cut", "run-1")
    cursors = warehouse.checkpoints.read().count()
    _run(warehouse, f"{work}/whole", "run-2")
    stored = warehouse.state("shop", "orders").read()
    return stored.agg(
        F.lit(broken.status).alias("status"), F.lit("no readable envelope" in (broken.error or "")).alias("says_why"),
        F.lit(cursors).cast("bigint").alias("cursors"), F.count("*").alias("stored_after_repair"),
    )


@query(
    "sync_guard_repeats",
    f"""SELECT o_orderkey AS id, false AS is_deleted, true AS aborted,
      (SELECT count(*) FROM orders WHERE {_ACCEPTED} AND o_orderkey % 2 = 0) AS upserted
    FROM orders WHERE {_ACCEPTED}""",
)
def sync_guard_repeats(spark, folder):
    """Half of the orders, landed twice, are half of the orders: the guard stops the sweep."""
    work = scratch_folder(spark, "guard-repeats")
    orders = table(spark, folder, "orders")
    _land_orders(orders, f"{work}/1")
    good = orders.filter(_ACCEPTED).select("o_orderkey")
    half = orders.join(good, "o_orderkey").filter(F.col("o_orderkey") % 2 == 0)
    _land_orders(half, f"{work}/2/a")
    _land_orders(half, f"{work}/2/b")
    warehouse = _warehouse(spark, work)
    _run(warehouse, f"{work}/1", "run-1")
    second = _run(warehouse, f"{work}/2", "run-2", "full_refresh", 2)
    rows = warehouse.state("shop", "orders").read()
    return rows.select(
        "id", F.col("_deleted_at").isNotNull().alias("is_deleted"), F.lit(second.sweep_aborted).alias("aborted"),
        F.lit(second.upserted_count).cast("bigint").alias("upserted"),
    )


def _two_streams(spark, folder, work):
    """Two streams into one table, with folders of their own; pages lie in folders by day."""
    orders = table(spark, folder, "orders")
    warehouse = _warehouse(spark, work)
    for n in (0, 1):
        _land_orders(orders.filter(F.col("o_orderkey") % 2 == n), f"{work}/landing-{n}/2026-04-0{n + 1}")
        start_sync_stream(
            warehouse, "shop", "orders", f"{work}/landing-{n}", f"{work}/checkpoint-{n}", one_per_file=False
        ).awaitTermination()
    return warehouse


@query(
    "stream_two_landings",
    f"""SELECT o_orderkey AS id, o_orderdate AS updated_at, '#' || o_orderkey AS order_number,
      CAST(o_totalprice AS DECIMAL(12,2))::VARCHAR AS total_price FROM orders WHERE {_ACCEPTED}""",
)
def stream_two_landings(spark, folder):
    warehouse = _two_streams(spark, folder, scratch_folder(spark, "two-landings"))
    rows = warehouse.state("shop", "orders").read()
    return rows.select(
        "id", F.col("updated_at").cast("timestamp_ntz").alias("updated_at"),
        F.get_json_object("_raw", "$.order_number").alias("order_number"),
        F.get_json_object("_raw", "$.total_price").alias("total_price"),
    )


@query(
    "stream_ledger",
    f"""SELECT 'stream' AS trigger, 'success' AS status, count(*) AS fetched,
      count(*) FILTER (WHERE {_ACCEPTED}) AS upserted, count(*) FILTER (WHERE NOT {_ACCEPTED}) AS skipped,
      {len(RULES)}::BIGINT AS rules FROM orders GROUP BY o_orderkey % 2""",
)
def stream_ledger(spark, folder):
    """Every batch of a stream is a run with counters and rule results."""
    warehouse = _two_streams(spark, folder, scratch_folder(spark, "stream-ledger"))
    rules = warehouse.results().groupBy("sync_id").agg(F.count("*").alias("rules"))
    return warehouse.ledger().join(rules, "sync_id", "left").select(
        "trigger", "status", F.col("fetched_count").alias("fetched"), F.col("upserted_count").alias("upserted"),
        F.col("skipped_invalid").alias("skipped"), "rules",
    )


@query(
    "checkpoint_two_tables",
    f"""SELECT 'orders' AS resource, max(o_orderdate) AS last_updated_at,
      max(o_orderkey) FILTER (WHERE o_orderdate = newest) AS last_id, 'orders-1' AS last_sync_id
    FROM (SELECT *, max(o_orderdate) OVER () AS newest FROM orders WHERE {_ACCEPTED})
    UNION ALL
    SELECT 'customers', TIMESTAMP '2024-01-05 00:00:00', max(c_custkey), 'customers-1' FROM customer""",
)
def checkpoint_two_tables(spark, folder):
    """Customers are synced while orders are on their way: both checkpoints stay."""
    work = scratch_folder(spark, "two-checkpoints")
    _land_orders(table(spark, folder, "orders"), f"{work}/orders")
    people = table(spark, folder, "customer").select(
        F.col("c_custkey").alias("o_orderkey"),
        F.to_json(F.struct(F.col("c_custkey").alias("id"), F.lit("2024-01-05T00:00:00Z").alias("updated_at"))).alias("_raw"),
    )
    _land(people, f"{work}/customers", "customers")
    warehouse = _warehouse(spark, work)
    save = warehouse.checkpoints.save

    def late(pipeline, resource, *rest):
        # Just before the checkpoint of orders is saved, a whole run of customers takes place.
        if resource == "orders":
            _run(warehouse, f"{work}/customers", "customers-1", resource="customers")
        save(pipeline, resource, *rest)

    warehouse.checkpoints.save = late
    _run(warehouse, f"{work}/orders", "orders-1")
    return warehouse.checkpoints.read().select(
        "resource", F.col("last_updated_at").cast("timestamp_ntz").alias("last_updated_at"), "last_id", "last_sync_id"
    )


def _two_runs(spark, folder, name):
    work = scratch_folder(spark, name)
    orders = table(spark, folder, "orders")
    _land_orders(orders, f"{work}/1")
    price = orders.select("o_orderkey", F.col("o_totalprice").alias("_price"))
    _land_orders(orders.join(price, "o_orderkey").filter(F.col("_price") <= 490000), f"{work}/2")
    warehouse = _warehouse(spark, work)
    _run(warehouse, f"{work}/1", "run-1")
    _run(warehouse, f"{work}/2", "run-2", "full_refresh", 2)
    return warehouse


_TWO_RUNS = f"""
counts AS (
  SELECT count(*) AS n, count(*) FILTER (WHERE {_ACCEPTED}) AS good,
    count(*) FILTER (WHERE o_totalprice <= 490000) AS n2,
    count(*) FILTER (WHERE {_ACCEPTED} AND o_totalprice <= 490000) AS good2
  FROM orders),
runs AS (
  SELECT 'run-1' AS sync_id, 'incremental' AS mode, n AS fetched, good AS upserted, n - good AS skipped,
    0 AS deleted, 0 AS rows_before, good AS rows_after FROM counts
  UNION ALL
  SELECT 'run-2', 'full_refresh', n2, good2, n2 - good2, good - good2, good, good2 FROM counts)"""


@query("sync_job_ledger", f"WITH {_TWO_RUNS} SELECT *, 'success' AS status, 'schedule' AS trigger FROM runs")
def sync_job_ledger(spark, folder):
    """The ledger as it is stored after two runs."""
    return _two_runs(spark, folder, "job-ledger").ledger("shop", "orders").select(
        "sync_id", "mode", F.col("fetched_count").alias("fetched"), F.col("upserted_count").alias("upserted"),
        F.col("skipped_invalid").alias("skipped"), F.col("soft_deleted_count").cast("int").alias("deleted"),
        "rows_before", "rows_after", "status", "trigger",
    ).withColumn("rows_before", F.col("rows_before").cast("bigint"))


@query(
    "sync_job_results",
    f"""WITH {_TWO_RUNS}
    SELECT sync_id, 'fetch_upsert_parity' AS rule,
      CASE WHEN (fetched - upserted) * 100.0 / greatest(fetched, 1) > 1.0 THEN 'failed' ELSE 'ok' END AS status FROM runs
    UNION ALL SELECT sync_id, 'volume_sanity', CASE mode WHEN 'incremental' THEN 'ok' ELSE 'skipped' END FROM runs
    UNION ALL SELECT sync_id, 'weekly_full_drift', 'skipped' FROM runs
    UNION ALL SELECT sync_id, 'soft_delete_sanity', CASE WHEN mode = 'incremental' THEN 'skipped'
      WHEN (rows_before - fetched) * 100.0 / greatest(rows_before, 1) > 5.0 THEN 'failed' ELSE 'ok' END FROM runs""",
)
def sync_job_results(spark, folder):
    """Rule results as they are stored after two runs."""
    return _two_runs(spark, folder, "job-results").results().select("sync_id", "rule", "status")


@query(
    "retention_stored",
    f"""WITH {LOGS} SELECT event_id, 0 AS second_time FROM logs WHERE NOT ({_EXPIRED_LOGS})""",
)
def retention_stored(spark, folder):
    """Expired rows leave the stored log table; a second time none is left to go."""
    path = scratch_folder(spark, "stored-logs")
    append_rows(logs(spark, folder), path, "timestamp")
    as_of = now_value(spark)
    retain_days(spark, path, as_of, KEEP)
    again = retain_days(spark, path, as_of, KEEP)
    rows = read_days(spark, path)
    return rows.select("event_id", F.lit(again["days"] + again["rows"]).alias("second_time"))


@query(
    "ledger_compacted",
    f"""WITH {LEDGER} SELECT sync_id, pipeline, resource, status, started_at, fetched_count, duration_seconds,
      true AS fewer_files, 0 AS second_time FROM ledger""",
)
def ledger_compacted(spark, folder):
    """A ledger appended in eight parts, its small files written together; a second time none is left to take."""
    path, by = scratch_folder(spark, "many-files"), ("pipeline", "resource")
    rows = ledger(spark, folder)
    for part in range(8):
        append_rows(rows.filter(F.pmod(F.xxhash64("sync_id"), F.lit(8)) == part), path, by=by)
    schema = ", ".join(f"{c} {kind}" for c, kind in rows.dtypes)
    before = len(spark.read.parquet(path).inputFiles())
    compact_rows(spark, path, schema, by)
    again = compact_rows(spark, path, schema, by)
    stored = spark.read.schema(schema).parquet(path)
    return stored.select(
        "sync_id", "pipeline", "resource", "status", "started_at", "fetched_count", "duration_seconds",
        F.lit(len(stored.inputFiles()) < before).alias("fewer_files"), F.lit(again).alias("second_time"),
    )


def now_value(spark) -> datetime:
    return spark.range(1).select(now().cast("timestamp_ntz").alias("t")).first().t.replace(tzinfo=timezone.utc)


@query(
    "rejected_records",
    f"""SELECT 'no_key' AS reason, '#' || o_orderkey AS order_number FROM orders WHERE NOT {_ACCEPTED}""",
)
def rejected_records(spark, folder):
    """Rejected records are rows, with their reason and their text."""
    return rejected(_projected(spark, folder)).select(
        F.col("_reject").alias("reason"), F.get_json_object("_raw", "$.order_number").alias("order_number")
    )


@query(
    "rejected_pages",
    f"""SELECT is_cut, CASE WHEN is_cut THEN 0 ELSE count(*) FILTER (WHERE {_ACCEPTED}) END AS accepted,
      CASE WHEN is_cut THEN count(DISTINCT o_orderkey // 250) ELSE 0 END AS bad_json
    FROM (SELECT *, o_orderkey // 250 % 3 = 0 AS is_cut FROM orders) GROUP BY is_cut""",
)
def rejected_pages(spark, folder):
    """With ``broken="reject"`` a third of the pages are a rejected record each: half of them are cut off, the others are
    envelopes of another kind that look like a record themselves."""
    work = scratch_folder(spark, "rejected-pages")
    _land_orders(table(spark, folder, "orders"), work)
    first = F.regexp_extract("value", r'"order_number":"#(\d+)"', 1).cast("bigint")
    pages = spark.read.text(work).withColumn("is_cut", F.floor(first / 250) % 3 == 0)
    other = F.lit('{"orders": {"id": 1}, "id": 5, "updated_at": "2023-01-01T00:00:00Z"}')
    cut = F.when(F.floor(first / 250) % 6 == 3, other).when(
        F.col("is_cut"), F.substring("value", F.lit(1), F.length("value") - 3)
    ).otherwise(F.col("value"))
    orders = RESOURCES["orders"]
    rows = project_records(
        explode_pages(pages.withColumn("value", cut), orders, broken="reject"), orders, "r", F.lit("2024-01-01").cast("timestamp")
    )
    return rows.groupBy("is_cut").agg(
        F.count_if(F.col("_reject").isNull()).alias("accepted"), F.count_if(F.col("_reject") == "bad_json").alias("bad_json")
    )


@query(
    "inspect_timeline",
    f"""WITH {RESULTS}, {LOGS.strip()}, sections AS (
    SELECT sync_id, 'run' AS section, started_at AS "at", status AS name,
      concat_ws(' ', pipeline, resource, mode) AS detail FROM ledger
    UNION ALL
    SELECT sync_id, 'log', "timestamp", event, message FROM logs WHERE sync_id IN (SELECT sync_id FROM ledger)
    UNION ALL
    SELECT sync_id, 'validation', finished_at, rule, status FROM results)
    SELECT *, CAST(row_number() OVER (PARTITION BY sync_id
      ORDER BY section <> 'run', "at", section, name, detail) AS INT) AS place FROM sections""",
)
def inspect_timeline(spark, folder):
    return reports.timeline(
        reports.inspect_runs(ledger(spark, folder), logs(spark, folder), _results(spark, folder))
    )


@query(
    "redact_unicode",
    """SELECT event_id, CASE WHEN event_type IN ('error', 'view') THEN 'call ' || word || '=***' || right(secret, 4)
      WHEN event_type = 'signup' THEN 'call nothing=' || secret ELSE 'call ' || word || '=***' || right(secret, 4) END AS text,
      '{"' || word || '": "***REDACTED***", "n": 1.' || event_id || '0000000000000000001}' AS json
    FROM (SELECT *, 'abcdefgh' || (1000 + event_id % 9000) AS secret,
      CASE event_id % 4 WHEN 0 THEN 'ap' || chr(305) || '_key' WHEN 1 THEN 'AP' || chr(304) || '_KEY'
        WHEN 2 THEN 'to' || chr(8490) || 'en' ELSE 'pa' || chr(383) || 'sword' END AS word FROM events)""",
)
def redact_unicode(spark, folder):
    """Words in letters that equal ASCII ones when case is ignored, and numbers that no double holds."""
    long_s, kelvin, dotless, dotted = CASE_PARTNERS
    which = F.col("event_id") % 4
    word = (
        F.when(which == 0, f"ap{dotless}_key").when(which == 1, f"AP{dotted}_KEY").when(which == 2, f"to{kelvin}en")
        .otherwise(f"pa{long_s}sword")
    )
    secret = F.concat(F.lit("abcdefgh"), 1000 + F.col("event_id") % 9000)
    name = F.when(F.col("event_type") == "signup", "nothing").otherwise(word)
    json = F.concat(
        F.lit('{"'), word, F.lit('": "'), secret, F.lit('", "n": 1.'), "event_id", F.lit("0000000000000000001}")
    )
    return table(spark, folder, "events").select(
        "event_id", redact_text(F.concat(F.lit("call "), name, F.lit("="), secret)).alias("text"),
        redact_json(json).alias("json"),
    )
