"""Queries of redaction, log rows, alerts, and of whole jobs and streams."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import functions as F

from tidemark.functions.redact import (
    MASK, VALUE_WORDS, redact_json, redact_json_native, redact_map_exact, redact_nested, redact_text,
)
from tidemark.functions.text import cap_payload, payload_size
from tidemark.model import RESOURCES
from tidemark.operators import alerts as A
from tidemark.operators import rules
from tidemark.operators.logs import log_rows
from tidemark.plans.inputs import (
    AS_OF_TEXT, BEATS, LEDGER, RESULTS, as_records, at, beats, ledger, table,
)
from tidemark.plans.registry import query
from tidemark.plans.sync import SyncSpec, Warehouse, run_sync
from tidemark.scratch import scratch_folder
from tidemark.sinks.tables import read_days
from tidemark.streaming.alerts import dedupe_alert_stream
from tidemark.streaming.beats import stale_beats, timers
from tidemark.streaming.logs import start_log_stream
from tidemark.streaming.metrics import read_metrics, start_metrics_stream
from tidemark.streaming.rules import RUN, RuleStream
from tidemark.streaming.sync import start_sync_stream

_SPACES = (
    r"\x09-\x0d\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
)
_SECRET = (
    rf"""(?i)({"|".join(VALUE_WORDS)})["']?[{_SPACES}]*[:=][{_SPACES}]*["']?"""
    rf"""[^{_SPACES}"',&]{{4,}}([^{_SPACES}"',&]{{4}})"""
).replace("'", "''")


def _clean(text):
    return rf"regexp_replace({text}, '{_SECRET}', '\1=***\2', 'g')"


@query("redact_text", f"SELECT doc_id, {_clean('text')} AS text FROM documents")
def redact_text_query(spark, folder):
    return table(spark, folder, "documents").select("doc_id", redact_text("text").alias("text"))


@query(
    "redact_keys",
    f"""SELECT doc_id, {_clean('text')} AS text, source AS login_user, '{MASK}' AS login_token,
      '{MASK}' AS first_secret, {_clean("'bearer: ' || source || 'abcdefgh'")} AS first_hint FROM documents""",
)
def redact_keys(spark, folder):
    """Secrets by key name at every depth of a typed value, and inside all other strings."""
    hint = F.concat(F.lit("bearer: "), "source", F.lit("abcdefgh"))
    value = F.struct(
        "doc_id", "text",
        F.struct(F.col("source").alias("user"), F.col("lang").alias("Access_Token")).alias("login"),
        F.array(F.struct(F.col("lang").alias("client_secret"), hint.alias("hint"))).alias("others"),
    )
    rows = table(spark, folder, "documents").select(value.alias("v"))
    clean = rows.select(redact_nested(F.col("v"), rows.schema["v"].dataType).alias("v"))
    return clean.select(
        "v.doc_id", "v.text", F.col("v.login.user").alias("login_user"),
        F.col("v.login.Access_Token").alias("login_token"),
        F.col("v.others")[0]["client_secret"].alias("first_secret"),
        F.col("v.others")[0]["hint"].alias("first_hint"),
    )


_JSON_SQL = f"""SELECT conv_id, turn, {_clean('text')} AS text, '{MASK}' AS password, role AS inner_role,
      {_clean("'token=' || role || '12345678'")} AS inner_note FROM conversations"""


def _json_redacted(spark, folder, redact):
    note = F.concat(F.lit("token="), "role", F.lit("12345678"))
    payload = F.to_json(
        F.struct("text", F.col("role").alias("db_Password"),
                 F.array(F.struct("role", note.alias("note"))).alias("list"))
    )
    clean = table(spark, folder, "conversations").select("conv_id", "turn", redact(payload).alias("j"))
    return clean.select(
        "conv_id", "turn",
        *(F.get_json_object("j", path).alias(name) for name, path in (
            ("text", "$.text"), ("password", "$.db_Password"),
            ("inner_role", "$.list[0].role"), ("inner_note", "$.list[0].note"),
        )),
    )


@query("redact_json", _JSON_SQL)
def redact_json_query(spark, folder):
    """The same for JSON text without a known schema."""
    return _json_redacted(spark, folder, redact_json)


@query("redact_json_native", _JSON_SQL)
def redact_json_native_query(spark, folder):
    """The same by built-in functions alone."""
    return _json_redacted(spark, folder, redact_json_native)


@query(
    "redact_exact",
    f"""SELECT event_id, '{MASK}' AS card_number, '{MASK}' AS token, event_type AS my_token FROM events""",
)
def redact_exact(spark, folder):
    kind = F.col("event_type")
    fields = F.create_map(
        F.lit("card_number"), F.col("user_id").cast("string"), F.lit("token"), kind, F.lit("my_token"), kind
    )
    rows = table(spark, folder, "events").select("event_id", redact_map_exact(fields).alias("f"))
    return rows.select("event_id", *(F.col("f")[k].alias(k) for k in ("card_number", "token", "my_token")))


def _log_events(spark, folder):
    kind = F.col("event_type")
    level = F.when(kind == "error", "error").when(kind == "view", "debug").otherwise("Info")
    fields = F.create_map(
        F.lit("timestamp"), F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'"),
        F.lit("level"), level,
        F.lit("event"), kind,
        F.lit("pipeline"), F.concat(F.lit("p"), F.col("user_id") % 3),
        F.lit("_internal"), F.lit("x"),
        F.lit("user"), F.col("user_id").cast("string"),
        F.lit("api_secret"), F.lit("s3cr3t"),
        F.lit("X-Authorization"), F.lit("basic"),
        F.lit("note"), F.concat(F.lit("password = "), kind, F.lit("-longer")),
        F.lit("exc_info"), F.when(kind == "error", F.concat(F.lit("at token:"), F.md5(kind))),
    )
    return table(spark, folder, "events").select(fields.alias("fields"))


_LOG_ROWS = f"""SELECT ts AS "timestamp", CASE event_type WHEN 'error' THEN 'ERROR' ELSE 'INFO' END AS level,
  event_type AS event, 'p' || CAST(user_id % 3 AS VARCHAR) AS pipeline, event_type AS message,
  '{{"user":"' || user_id || '","api_secret":"{MASK}","X-Authorization":"{MASK}","note":"'
    || {_clean("'password = ' || event_type || '-longer'")} || '"}}' AS payload,
  CASE WHEN event_type = 'error' THEN 'at token=***' || right(md5(event_type), 4) END AS exc_info
FROM events WHERE event_type <> 'view'"""
_LOG_COLUMNS = ["timestamp", "level", "event", "pipeline", "message", "payload", "exc_info"]


@query("log_project", _LOG_ROWS)
def log_project(spark, folder):
    rows = log_rows(_log_events(spark, folder)).select(*_LOG_COLUMNS)
    return rows.withColumn("timestamp", F.col("timestamp").cast("timestamp_ntz"))


@query(
    "payload_cap",
    r"""WITH sized AS (
      SELECT doc_id, text, lang, length(CAST(to_json({'text': text, 'lang': lang}) AS VARCHAR)) + 3
        + 5 * length(regexp_replace(text, '[\x00-\x7e]', '', 'g'))
        + 6 * length(regexp_replace(text, '[\x{0}-\x{ffff}]', '', 'g')) AS size
      FROM documents)
    SELECT doc_id, size, size > 10240 AS truncated,
      CASE WHEN size > 10240 THEN '{"_truncated":true,"original_size":' || size || '}' END AS marker,
      CASE WHEN size <= 10240 THEN text END AS text
    FROM sized""",
)
def payload_cap(spark, folder):
    fields = F.create_map(F.lit("text"), F.col("text"), F.lit("lang"), F.col("lang"))
    rows = table(spark, folder, "documents").select(
        "doc_id", payload_size(fields).cast("bigint").alias("size"), cap_payload(fields).alias("p")
    )
    marked = F.get_json_object("p", "$._truncated") == "true"
    return rows.select(
        "doc_id", "size", F.coalesce(marked, F.lit(False)).alias("truncated"),
        F.when(marked, F.col("p")).alias("marker"), F.get_json_object("p", "$.text").alias("text"),
    )


# --- alerts -------------------------------------------------------------------------------------


def _summary_with_time(spark, folder):
    summary = rules.summarize(rules.evaluate_rules(ledger(spark, folder)))
    return summary.withColumnRenamed("finished_at", "at")


@query(
    "alert_events",
    rf"""WITH {RESULTS}, {BEATS.strip()},
    failed_rules AS (
      SELECT sync_id, pipeline, resource, max(finished_at) AS "at",
        replace(replace(string_agg(rule, ', ' ORDER BY rule), '_', ' '), '*', '') AS rules
      FROM results WHERE status = 'failed' GROUP BY ALL)
    SELECT 'sync_fail:' || pipeline || ':' || resource AS key, pipeline, finished_at AS "at", sync_id,
      'Sync FAILED' || chr(10) || 'Pipeline: ' || pipeline || chr(10) || 'Resource: ' || resource || chr(10)
      || 'Error: ' || 'HTTP 500: token=''' || sync_id || ''' bad gateway' || chr(10)
      || 'Run: ' || substring(sync_id, 1, 8) AS text
    FROM ledger WHERE status = 'failed'
    UNION ALL
    SELECT 'validation_fail:' || pipeline || ':' || resource, pipeline, "at", sync_id,
      'Validation FAILED' || chr(10) || 'Pipeline: ' || pipeline || chr(10) || 'Resource: ' || resource || chr(10)
      || 'Rules: ' || rules || chr(10) || 'Run: ' || substring(sync_id, 1, 8)
    FROM failed_rules
    UNION ALL
    SELECT 'scheduler_dead', '__system__', TIMESTAMP '{AS_OF_TEXT}', NULL,
      'Scheduler DEAD' || chr(10) || 'Last heartbeat: ' || strftime(last_beat, '%Y-%m-%dT%H:%M:%S')
      || ' (' || printf('%.1f', (epoch_us(TIMESTAMP '{AS_OF_TEXT}') - epoch_us(last_beat)) / 3.6e9) || 'h ago)'
    FROM beats WHERE (epoch_us(TIMESTAMP '{AS_OF_TEXT}') - epoch_us(last_beat)) / 3.6e9 > 2.0""",
)
def alert_events(spark, folder):
    return (
        A.alerts_of_failed_runs(ledger(spark, folder))
        .unionByName(A.alerts_of_failed_rules(_summary_with_time(spark, folder)))
        .unionByName(A.alerts_of_stale_beats(beats(spark, folder), "last_beat", at(AS_OF_TEXT)))
    )


def _alerts(spark, folder):
    return ledger(spark, folder).select(
        F.col("sync_id").alias("alert_id"), "pipeline",
        F.concat_ws(":", "pipeline", "resource").alias("key"), F.col("started_at").alias("at"),
    )


# Walks each pipeline's alerts in time order; a, b, c are its last three sends.
_SENT = """WITH RECURSIVE alerts AS (
  SELECT md5(CAST(event_id AS VARCHAR)) AS alert_id, 'p' || CAST(user_id % 3 AS VARCHAR) AS pipeline,
    'p' || CAST(user_id % 3 AS VARCHAR) || ':' || (['orders','customers','products','inventory_levels',
      'locations'])[CAST(user_id % 5 AS INT) + 1] AS key, ts AS "at",
    row_number() OVER (PARTITION BY user_id % 3 ORDER BY ts, md5(CAST(event_id AS VARCHAR))) AS n
  FROM events),
walk AS (
  SELECT DISTINCT pipeline, CAST(0 AS BIGINT) AS n, CAST(NULL AS VARCHAR) AS alert_id, CAST(NULL AS VARCHAR) AS key,
    CAST(NULL AS TIMESTAMP) AS "at", false AS sent,
    CAST(NULL AS TIMESTAMP) AS ta, CAST(NULL AS TIMESTAMP) AS tb, CAST(NULL AS TIMESTAMP) AS tc,
    CAST(NULL AS VARCHAR) AS ka, CAST(NULL AS VARCHAR) AS kb, CAST(NULL AS VARCHAR) AS kc
  FROM alerts
  UNION ALL
  SELECT pipeline, n, alert_id, key, "at", sent,
    CASE WHEN sent THEN tb ELSE ta END, CASE WHEN sent THEN tc ELSE tb END, CASE WHEN sent THEN "at" ELSE tc END,
    CASE WHEN sent THEN kb ELSE ka END, CASE WHEN sent THEN kc ELSE kb END, CASE WHEN sent THEN key ELSE kc END
  FROM (
    SELECT x.pipeline, x.n, x.alert_id, x.key, x."at", ta, tb, tc, ka, kb, kc,
      coalesce(x."at" - ta >= INTERVAL 1 HOUR, true)
      AND NOT coalesce(ka = x.key AND x."at" - ta < INTERVAL 5 MINUTE, false)
      AND NOT coalesce(kb = x.key AND x."at" - tb < INTERVAL 5 MINUTE, false)
      AND NOT coalesce(kc = x.key AND x."at" - tc < INTERVAL 5 MINUTE, false) AS sent
    FROM walk w JOIN alerts x ON x.pipeline = w.pipeline AND x.n = w.n + 1))
SELECT alert_id, pipeline, key, "at", sent FROM walk WHERE n > 0"""


@query("alert_dedup", _SENT)
def alert_dedup(spark, folder):
    return A.dedupe_alerts(_alerts(spark, folder))


@query("stream_alert_dedup", _SENT)
def stream_alert_dedup(spark, folder):
    """The same on a stream of alert files that land one after another, a batch for each."""
    work = scratch_folder(spark, "alert-stream")
    rows = _alerts(spark, folder)
    for first, last in (("1900-01-01", "2024-01-10"), ("2024-01-10", "2024-01-20"), ("2024-01-20", "9999-01-01")):
        days = (F.col("at") >= at(first)) & (F.col("at") < at(last))
        rows.filter(days).coalesce(1).write.mode("append").parquet(f"{work}/in")
    reader = spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 1)
    arriving = reader.parquet(f"{work}/in")
    job = (
        dedupe_alert_stream(arriving)
        .writeStream.format("parquet")
        .option("path", f"{work}/out")
        .option("checkpointLocation", f"{work}/checkpoint")
        .trigger(availableNow=True)
        .start()
    )
    job.awaitTermination()
    return spark.read.parquet(f"{work}/out")


# --- jobs and streams -------------------------------------------------------------------------------


_SILENCE = 6 * 3600


@query(
    "stream_stale_beats",
    f"""WITH beats AS (
      SELECT 'p' || CAST(user_id % 50 AS VARCHAR) AS pipeline, ts,
        lead(ts) OVER (PARTITION BY user_id % 50 ORDER BY ts) AS next_at, max(ts) OVER () AS newest FROM events)
    SELECT pipeline, ts AS last_beat, ts + INTERVAL {_SILENCE} SECOND AS due_at FROM beats
    WHERE next_at - ts > INTERVAL {_SILENCE} SECOND
      OR (next_at IS NULL AND ts + INTERVAL {_SILENCE} SECOND < newest - INTERVAL 60 SECOND)""",
)
def stream_stale_beats(spark, folder):
    """Silences of a stream of beats. The stream is stopped between two date ranges and started again."""
    work = scratch_folder(spark, "beat-stream")
    events = table(spark, folder, "events")
    pipeline = F.concat(F.lit("p"), F.col("user_id") % 50)
    rows = events.select(pipeline.alias("pipeline"), F.col("ts").alias("at"))
    for first, last in (("1900-01-01", "2024-01-16"), ("2024-01-16", "9999-01-01")):
        rows.filter((F.col("at") >= at(first)) & (F.col("at") < at(last))).write.mode("append").parquet(f"{work}/in")
        arriving = spark.readStream.schema(rows.schema).parquet(f"{work}/in")
        with timers(spark):
            job = (
                stale_beats(arriving, after_s=_SILENCE, late_s=60)
                .writeStream.format("parquet")
                .option("path", f"{work}/out")
                .option("checkpointLocation", f"{work}/checkpoint")
                .trigger(availableNow=True)
                .start()
            )
        job.awaitTermination()
    found = spark.read.parquet(f"{work}/out")
    return found.select("pipeline", *[F.col(c).cast("timestamp_ntz").alias(c) for c in ("last_beat", "due_at")])


@query(
    "stream_run_metrics",
    f"""WITH {LEDGER} SELECT pipeline, resource, mode, status, CAST(started_at AS DATE) AS day, count(*) AS runs,
      CAST(coalesce(sum(upserted_count), 0) AS BIGINT) AS records_upserted,
      CAST(coalesce(sum(duration_seconds), 0) AS DECIMAL(20,2)) AS seconds
    FROM ledger WHERE status <> 'running' GROUP BY ALL""",
)
def stream_run_metrics(spark, folder):
    """Counters of finished runs, kept by a stream that is stopped in the middle of a day and started again."""
    work = scratch_folder(spark, "metrics-stream")
    runs = ledger(spark, folder).filter("status <> 'running'")
    for early in (True, False):
        rows = runs.filter((F.col("started_at") < at("2024-01-16 11:00:00")) == F.lit(early))
        rows.write.mode("append").parquet(f"{work}/in")
        arriving = spark.readStream.schema(runs.schema).parquet(f"{work}/in")
        start_metrics_stream(arriving, f"{work}/out", f"{work}/checkpoint").awaitTermination()
    return read_metrics(spark, f"{work}/out")


@query("stream_rules", f"WITH {RESULTS} SELECT sync_id, rule, status, percent FROM results")
def stream_rules(spark, folder):
    """Rules of runs that arrive by the time they finished, in three parts, the last of which lets all of them go."""
    work = scratch_folder(spark, "rule-stream")
    runs = ledger(spark, folder).filter("status <> 'running'").select(*RUN)
    ends = ["2024-01-11 11:00:00", "2024-01-20 05:00:00", "9999-01-01 00:00:00"]
    for begin, end in zip(["0001-01-01 00:00:00", *ends], ends):
        part = runs.filter((F.col("finished_at") >= at(begin)) & (F.col("finished_at") < at(end)))
        part.write.mode("append").parquet(f"{work}/in")
        rules_of = RuleStream(spark, f"{work}/out", late_s=0 if end == ends[-1] else 3600)
        rules_of.start(spark.readStream.schema(runs.schema).parquet(f"{work}/in"), f"{work}/checkpoint").awaitTermination()
    return rules_of.results().select("sync_id", "rule", "status", "percent")


@query("stream_logs", _LOG_ROWS)
def stream_logs(spark, folder):
    work = scratch_folder(spark, "log-stream")
    _log_events(spark, folder).write.parquet(f"{work}/in")
    arriving = spark.readStream.schema(spark.read.parquet(f"{work}/in").schema).parquet(f"{work}/in")
    start_log_stream(arriving, f"{work}/out", f"{work}/checkpoint").awaitTermination()
    rows = read_days(spark, f"{work}/out").select(*_LOG_COLUMNS)
    return rows.withColumn("timestamp", F.col("timestamp").cast("timestamp_ntz"))


def _land(records, folder, field="orders"):
    """Pages of one line each."""
    _write_pages(records.withColumn("_page", _page()), folder, field)


def _page():
    """The page of a record. A function, because this module is also imported where no session runs yet."""
    return F.floor(F.col("o_orderkey") / 250)


def _land_orders(orders, folder):
    """The same for rows of orders: these are dealt out by page before they become JSON, which is many times larger."""
    _write_pages(as_records(orders.withColumn("_page", _page()).repartition("_page"), "_page"), folder)


def _write_pages(records, folder, field="orders"):
    pages = records.groupBy("_page").agg(F.array_join(F.collect_list("_raw"), ",").alias("body"))
    value = F.concat(F.lit(f'{{"{field}":['), "body", F.lit("]}"))
    pages.select(value.alias("value")).write.option("compression", "gzip").text(folder)


_ACCEPTED = "(o_orderstatus <> 'P' OR o_orderpriority <> '5-LOW')"


@query("stream_upsert", f"SELECT o_orderkey AS id, o_orderdate AS updated_at FROM orders WHERE {_ACCEPTED}")
def stream_upsert(spark, folder):
    """Landed pages, merged in micro-batches into a state table."""
    work = scratch_folder(spark, "sync-stream")
    _land_orders(table(spark, folder, "orders"), f"{work}/landing")
    warehouse = Warehouse(spark, f"{work}/warehouse", buckets=4)
    start_sync_stream(
        warehouse, "shop", "orders", f"{work}/landing", f"{work}/checkpoint", one_per_file=False
    ).awaitTermination()
    rows = warehouse.state("shop", "orders").read()
    return rows.select("id", F.col("updated_at").cast("timestamp_ntz").alias("updated_at"))


@query(
    "sync_job",
    f"""SELECT o_orderkey AS id, o_orderdate AS updated_at, o_totalprice > 490000 AS is_deleted,
      CASE WHEN o_totalprice > 490000 THEN 'run-1' ELSE 'run-2' END AS _sync_id
    FROM orders WHERE {_ACCEPTED}""",
)
def sync_job(spark, folder):
    """Two runs into a new warehouse: everything, then a full snapshot that lacks the dearest orders."""
    work = scratch_folder(spark, "sync-job")
    orders = table(spark, folder, "orders")
    _land_orders(orders, f"{work}/landing/1")
    price = orders.select("o_orderkey", F.col("o_totalprice").alias("_price"))
    _land_orders(orders.join(price, "o_orderkey").filter(F.col("_price") <= 490000), f"{work}/landing/2")
    warehouse = Warehouse(spark, f"{work}/warehouse", buckets=4)
    for n, mode in ((1, "incremental"), (2, "full_refresh")):
        spec = SyncSpec("shop", "orders", mode, sync_id=f"run-{n}")
        as_of = datetime(2024, 2, n, tzinfo=timezone.utc)
        result = run_sync(warehouse, spec, f"{work}/landing/{n}", as_of, one_per_file=False)
        if result.status != "success":
            raise RuntimeError(result.error)
    return warehouse.state("shop", "orders").read().select(
        "id", F.col("updated_at").cast("timestamp_ntz").alias("updated_at"),
        F.col("_deleted_at").isNotNull().alias("is_deleted"), "_sync_id",
    )
