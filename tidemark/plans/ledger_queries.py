"""Queries of the run ledger: reports, metrics, rules and retention."""

from __future__ import annotations

from datetime import date

from pyspark.sql import functions as F

from tidemark.model import REQUEST_STATUSES, Retention
from tidemark.operators import ledger as L
from tidemark.operators import reports, retention, rules
from tidemark.operators.cursor import watermark
from tidemark.functions.timestamps import uptime_text
from tidemark.plans.inputs import (
    AS_OF, AS_OF_TEXT, BEATS, HISTORY, LEDGER, LOGS, REQUESTS, RESULTS,
    at, beats, ledger, logs, requests, table,
)
from tidemark.plans.registry import query
from tidemark.sinks.tables import expired_days

NOW = f"TIMESTAMP '{AS_OF_TEXT}'"


def now():
    return at(AS_OF_TEXT)


def _micros(later, earlier):
    return f"(epoch_us({later}) - epoch_us({earlier})) / 1000000.0"


# --- ledger rows --------------------------------------------------------------------------------

_RUN = ["sync_id", "pipeline", "resource", "mode", "status", "started_at", "finished_at", "fetched_count"]


@query("run_ledger_fold", f"WITH {LEDGER} SELECT {', '.join(_RUN)} FROM ledger")
def run_ledger_fold(spark, folder):
    """Start and finish entries, as a job appends them, folded to one row per run."""
    runs = ledger(spark, folder).select(*_RUN)
    starts = runs.withColumns(
        {
            "status": F.lit("running"), "entry_at": F.col("started_at"),
            "finished_at": F.lit(None).cast("timestamp_ntz"), "fetched_count": F.lit(None).cast("int"),
        }
    )
    ends = runs.filter(F.col("finished_at").isNotNull()).select(
        "sync_id", "status", "finished_at", "fetched_count", F.col("finished_at").alias("entry_at")
    )
    return L.fold_entries(starts.unionByName(ends, allowMissingColumns=True), "entry_at")


@query(
    "run_start_insert",
    f"""WITH {LEDGER} SELECT sync_id, pipeline, resource, mode, started_at,
    CASE WHEN trigger = 'manual' THEN status ELSE 'running' END AS status FROM ledger""",
)
def run_start_insert(spark, folder):
    """Manual runs are recorded already; starts come in for all runs."""
    columns = ["sync_id", "pipeline", "resource", "mode", "started_at"]
    runs = ledger(spark, folder)
    recorded = runs.filter(F.col("trigger") == "manual").select(*columns, "status")
    return L.record_starts(recorded, runs.select(*columns, F.lit("running").alias("status")))


@query(
    "run_finish_update",
    f"""WITH {LEDGER} SELECT sync_id, started_at, finished_at,
    status, CASE WHEN finished_at IS NOT NULL THEN fetched_count END AS fetched_count FROM ledger""",
)
def run_finish_update(spark, folder):
    runs = ledger(spark, folder)
    started = runs.select(
        "sync_id", "started_at", F.lit(None).cast("timestamp_ntz").alias("finished_at"),
        F.lit("running").alias("status"), F.lit(None).cast("int").alias("fetched_count"),
    )
    done = runs.filter(F.col("finished_at").isNotNull())
    return L.record_finishes(started, done.select("sync_id", "finished_at", "status", "fetched_count"))


@query(
    "latest_run",
    f"""WITH {LEDGER} SELECT sync_id, pipeline, resource, status, started_at, upserted_count FROM ledger
    QUALIFY row_number() OVER (PARTITION BY pipeline, resource ORDER BY started_at DESC, sync_id DESC) = 1""",
)
def latest_run(spark, folder):
    return L.latest_runs(ledger(spark, folder)).select(
        "sync_id", "pipeline", "resource", "status", "started_at", "upserted_count"
    )


@query(
    "prev_runs",
    f"""WITH {LEDGER} SELECT sync_id, pipeline, resource, array_to_string(list_reverse(list(sync_id) OVER (
      PARTITION BY pipeline, resource ORDER BY started_at, sync_id ROWS BETWEEN 7 PRECEDING AND 1 PRECEDING)), ',')
      AS previous FROM ledger WHERE status = 'success'""",
)
def prev_runs(spark, folder):
    runs = L.previous_runs(ledger(spark, folder))
    # SQL has no list, rather than an empty one, for the first run of a table.
    joined = F.when(F.size("previous") > 0, F.array_join("previous", ","))
    return runs.select("sync_id", "pipeline", "resource", joined.alias("previous"))


ROLLUP = f"""WITH {LEDGER} SELECT date_trunc('day', finished_at + INTERVAL 7 HOUR) AS day, pipeline, resource, mode,
      count(*) FILTER (WHERE status = 'success') AS success_count,
      count(*) FILTER (WHERE status = 'failed') AS failure_count,
      CAST(sum(duration_seconds) AS DOUBLE) / count(duration_seconds) AS avg_duration_s,
      round(quantile_cont(CAST(duration_seconds AS DOUBLE), 0.95), 6) AS p95_duration_s,
      CAST(sum(fetched_count) AS BIGINT) AS total_fetched,
      CAST(sum(upserted_count) AS BIGINT) AS total_upserted
    FROM ledger WHERE finished_at IS NOT NULL AND trigger = 'schedule'
    GROUP BY ALL"""


@query("daily_rollup", ROLLUP)
def daily_rollup(spark, folder):
    rollup = L.daily_rollup(ledger(spark, folder))
    # Interpolation is not computed in the same order; its result has at most four decimals here.
    return rollup.withColumn("p95_duration_s", F.round("p95_duration_s", 6))


@query(
    "duration_histogram",
    f"""WITH {LEDGER}, bounds AS (
      SELECT unnest([1, 5, 10, 30, 60, 180, 600, 1800, 7200]) AS le)
    SELECT pipeline, resource, mode, CAST(le AS VARCHAR) AS le,
      count(*) FILTER (WHERE duration_seconds <= le) AS runs
    FROM ledger, bounds WHERE duration_seconds IS NOT NULL GROUP BY ALL
    UNION ALL
    SELECT pipeline, resource, mode, '+Inf', count(*) FROM ledger WHERE duration_seconds IS NOT NULL GROUP BY ALL""",
)
def duration_histogram(spark, folder):
    return L.duration_histogram(ledger(spark, folder))


@query(
    "run_counters",
    f"""WITH {LEDGER} SELECT pipeline, resource, mode, status, count(*) AS runs,
      CAST(coalesce(sum(upserted_count), 0) AS BIGINT) AS records_upserted
    FROM ledger GROUP BY ALL""",
)
def run_counters(spark, folder):
    return L.run_counters(ledger(spark, folder))


@query(
    "success_rate",
    f"""WITH {LEDGER} SELECT pipeline, resource, count(*) AS runs,
      sum(CASE WHEN status = 'success' THEN 1 ELSE 0 END) / count(*) AS success_rate
    FROM ledger GROUP BY ALL""",
)
def success_rate(spark, folder):
    return L.success_rate(ledger(spark, folder))


@query(
    "freshness",
    f"""WITH {LEDGER} SELECT pipeline, resource, max(started_at) AS last_updated_at,
      {_micros(NOW, 'max(started_at)')} AS lag_seconds
    FROM ledger GROUP BY ALL""",
)
def freshness(spark, folder):
    runs = ledger(spark, folder).withColumn("id", F.lit(0))
    checkpoints = watermark(runs, L.TABLE, ts="started_at")
    return L.freshness(checkpoints, now())


@query(
    "sync_health",
    f"""WITH {LEDGER} SELECT pipeline, resource,
      max(finished_at) FILTER (WHERE status = 'success') AS last_success_at,
      {_micros(NOW, "max(finished_at) FILTER (WHERE status = 'success')")} AS lag_seconds,
      count(*) FILTER (WHERE error IS NOT NULL AND started_at > {NOW} - INTERVAL 1 HOUR) AS errors_1h
    FROM ledger GROUP BY ALL""",
)
def sync_health(spark, folder):
    return L.sync_health(ledger(spark, folder), now())


# --- reports ----------------------------------------------------------------------------------


@query(
    "history_topk",
    f"""WITH {LEDGER} SELECT started_at, sync_id, resource, mode, status,
      coalesce(fetched_count, 0) AS fetched, coalesce(CAST(duration_seconds AS DOUBLE), 0.0) AS duration_s,
      substring(coalesce(error, ''), 1, 40) AS error
    FROM ledger WHERE pipeline = 'p1' ORDER BY started_at DESC, sync_id DESC LIMIT 10""",
)
def history_topk(spark, folder):
    return reports.history(ledger(spark, folder), "p1", 10)


@query(
    "inspect_prefix",
    f"""WITH {LEDGER} SELECT count(*) AS matches, min_by(sync_id, started_at) AS first_match
    FROM ledger WHERE sync_id LIKE '0a%'""",
)
def inspect_prefix(spark, folder):
    found = reports.find_runs(ledger(spark, folder), "0a")
    return found.agg(F.count("*").alias("matches"), F.min_by("sync_id", "started_at").alias("first_match"))


@query(
    "inspect_run",
    f"""WITH {RESULTS}, {LOGS.strip()}
    SELECT sync_id, 'run' AS section, started_at AS "at", status AS name,
      concat_ws(' ', pipeline, resource, mode) AS detail FROM ledger
    UNION ALL
    SELECT sync_id, 'log', "timestamp", event, message FROM logs WHERE sync_id IN (SELECT sync_id FROM ledger)
    UNION ALL
    SELECT sync_id, 'validation', finished_at, rule, status FROM results""",
)
def inspect_run(spark, folder):
    return reports.inspect_runs(ledger(spark, folder), logs(spark, folder), _results(spark, folder))


@query(
    "status_label",
    f"""WITH {LEDGER} SELECT sync_id, CASE
      WHEN trigger = 'manual' THEN 'DISABLED'
      WHEN status = 'running' AND {_micros("TIMESTAMP '2024-01-16 00:00:00'", 'started_at')} > 3600 THEN 'RUNNING > 1h'
      WHEN status = 'running' THEN 'RUNNING' WHEN status = 'success' THEN 'OK' ELSE 'FAIL' END AS label
    FROM ledger""",
)
def status_label(spark, folder):
    on = F.col("trigger") != "manual"
    label = reports.status_label(F.col("status"), F.col("started_at"), on, at("2024-01-16 00:00:00"))
    return ledger(spark, folder).select("sync_id", label.alias("label"))


@query(
    "status_report",
    f"""WITH {LEDGER},
    names AS (SELECT 'p' || CAST(n_nationkey AS VARCHAR) AS pipeline, n_regionkey <> 2 AS enabled,
      n_nationkey = 1 AS no_products FROM nation),
    resources AS (SELECT unnest(['orders','customers','products','inventory_levels','locations']) AS resource),
    last AS (SELECT * FROM ledger QUALIFY row_number() OVER (
      PARTITION BY pipeline, resource ORDER BY started_at DESC, sync_id DESC) = 1)
    SELECT pipeline, resource, finished_at AS last_sync,
      CASE WHEN NOT enabled OR (no_products AND resource = 'products') THEN 'DISABLED'
        WHEN status IS NULL THEN 'NEVER'
        WHEN status = 'running' AND {_micros(NOW, 'started_at')} > 3600 THEN 'RUNNING > 1h'
        WHEN status = 'running' THEN 'RUNNING' WHEN status = 'success' THEN 'OK' ELSE 'FAIL' END AS label,
      CASE WHEN status IS NOT NULL THEN coalesce(upserted_count, 0) END AS records
    FROM names CROSS JOIN resources LEFT JOIN last USING (pipeline, resource)""",
)
def status_report(spark, folder):
    nation = table(spark, folder, "nation")
    pipelines = nation.select(
        F.concat(F.lit("p"), "n_nationkey").alias("pipeline"),
        (F.col("n_regionkey") != 2).alias("enabled"),
        F.when(F.col("n_nationkey") == 1, F.array(F.lit("products"))).alias("disabled_resources"),
    )
    return reports.status_report(pipelines, ledger(spark, folder), now())


@query(
    "log_search",
    f"""WITH {LOGS} SELECT event_id, "timestamp", level, event, message FROM logs
    WHERE pipeline = 'p1' AND level IN ('ERROR', 'CRITICAL') AND "timestamp" >= {NOW} - INTERVAL 20 DAY
    ORDER BY "timestamp" DESC LIMIT 100""",
)
def log_search(spark, folder):
    found = reports.search_logs(logs(spark, folder), "p1", AS_OF, errors=True, since="20d")
    return found.select("event_id", "timestamp", "level", "event", "message")


@query(
    "min_level",
    f"""WITH {LOGS} SELECT event_id, level FROM logs WHERE level IN ('WARNING', 'ERROR', 'CRITICAL')""",
)
def min_level(spark, folder):
    return reports.at_least(logs(spark, folder), "warning").select("event_id", "level")


def _results(spark, folder):
    results = rules.evaluate_rules(ledger(spark, folder))
    return results.withColumnRenamed("finished_at", "created_at")


@query(
    "validation_24h",
    f"""WITH {RESULTS} SELECT pipeline, resource, count(*) FILTER (WHERE status = 'warning') AS warn_count,
      count(*) FILTER (WHERE status = 'failed') AS fail_count
    FROM results WHERE finished_at >= {NOW} - INTERVAL 24 HOUR GROUP BY ALL""",
)
def validation_24h(spark, folder):
    return reports.results_last_day(_results(spark, folder), now())


@query(
    "validation_verdict",
    f"""WITH {RESULTS} SELECT count(*) FILTER (WHERE status = 'warning') AS warnings,
      count(*) FILTER (WHERE status = 'failed') AS failures, 'failed' AS verdict
    FROM results WHERE finished_at >= {NOW} - INTERVAL 24 HOUR""",
)
def validation_verdict(spark, folder):
    return reports.results_verdict(validation_24h(spark, folder))


# --- rules ------------------------------------------------------------------------------------


def _rule_sql(rule):
    return (
        f"WITH {RESULTS} SELECT sync_id, pipeline, resource, status, percent "
        f"FROM results WHERE rule = '{rule}'"
    )


def _rule(rule):
    def build(spark, folder):
        return rules.evaluate_rule(ledger(spark, folder), rule).select(
            "sync_id", "pipeline", "resource", "status", "percent"
        )

    return build


query("rule_parity", _rule_sql("fetch_upsert_parity"))(_rule(rules.fetch_upsert_parity))
query("rule_volume", _rule_sql("volume_sanity"))(_rule(rules.volume_sanity))
query("rule_drift", _rule_sql("weekly_full_drift"))(_rule(rules.weekly_full_drift))
query("rule_soft_delete", _rule_sql("soft_delete_sanity"))(_rule(rules.soft_delete_sanity))


@query(
    "validation_results",
    f"WITH {RESULTS} SELECT sync_id, rule, status, percent FROM results",
)
def validation_results(spark, folder):
    return _results(spark, folder).select("sync_id", "rule", "status", "percent")


@query(
    "validation_summary",
    f"""WITH {RESULTS} SELECT sync_id, pipeline, resource, count(*) AS rules_run,
      bool_or(status = 'failed') AS failed,
      coalesce(string_agg(rule, ',' ORDER BY rule) FILTER (WHERE status = 'failed'), '') AS failed_rules
    FROM results GROUP BY ALL""",
)
def validation_summary(spark, folder):
    summary = rules.summarize(_results(spark, folder))
    return summary.withColumn("failed_rules", F.array_join("failed_rules", ",")).drop("finished_at")


@query(
    "row_count_delta",
    f"""WITH {HISTORY}, deltas AS (
      SELECT *, CASE WHEN prev_rows > 0 AND mode <> 'full_refresh'
        THEN (prev_rows - rows_after) / prev_rows * 100.0 END AS delta FROM history)
    SELECT sync_id, pipeline, resource, CASE WHEN delta IS NULL THEN 'skipped' WHEN delta > 10.0 THEN 'warning'
      ELSE 'ok' END AS status, delta AS delta_pct FROM deltas""",
)
def row_count_delta(spark, folder):
    return rules.row_count_delta(ledger(spark, folder))


@query(
    "volume_median",
    f"""WITH {LEDGER}, runs AS (
      SELECT sync_id, pipeline, resource, CAST(started_at AS DATE) AS day, coalesce(fetched_count, 0) AS fetched
      FROM ledger WHERE status = 'success'),
    days AS (SELECT DISTINCT pipeline, resource, day FROM runs),
    past AS (
      SELECT d.pipeline, d.resource, d.day, count(*) AS samples, median(r.fetched) AS median
      FROM days d JOIN runs r ON r.pipeline = d.pipeline AND r.resource = d.resource
        AND r.day BETWEEN d.day - 7 AND d.day - 1
      GROUP BY ALL)
    SELECT sync_id, pipeline, resource, fetched, coalesce(samples, 0) AS samples, median,
      CASE WHEN coalesce(samples, 0) < 3 THEN 'skipped'
        WHEN fetched < median * 0.2 OR fetched > median * 3.0 THEN 'warning' ELSE 'ok' END AS status
    FROM runs LEFT JOIN past USING (pipeline, resource, day)""",
)
def volume_median(spark, folder):
    return rules.volume_against_median(ledger(spark, folder))


@query(
    "volume_median_exact",
    f"""WITH {LEDGER}, runs AS (
      SELECT sync_id, pipeline, resource, coalesce(fetched_count, 0) AS fetched,
        count(*) OVER before AS samples, median(coalesce(fetched_count, 0)) OVER before AS median
      FROM ledger WHERE status = 'success'
      WINDOW before AS (PARTITION BY pipeline, resource ORDER BY started_at
        RANGE BETWEEN INTERVAL 7 DAYS PRECEDING AND INTERVAL 1 MICROSECOND PRECEDING))
    SELECT sync_id, pipeline, resource, fetched, samples, median,
      CASE WHEN samples < 3 THEN 'skipped'
        WHEN fetched < median * 0.2 OR fetched > median * 3.0 THEN 'warning' ELSE 'ok' END AS status
    FROM runs""",
)
def volume_median_exact(spark, folder):
    """The volume rule over the seven days before each run itself."""
    return rules.volume_against_sliding_median(ledger(spark, folder))


@query(
    "enum_domain",
    f"""WITH {REQUESTS} SELECT id, CASE WHEN status NOT IN ('pending', 'claimed', 'done')
      THEN 'status=' || status END AS _reject FROM requests""",
)
def enum_domain(spark, folder):
    allowed = [s for s in REQUEST_STATUSES if s not in ("running", "failed", "cancelled")]
    return rules.in_domain(requests(spark, folder), "status", allowed).select("id", "_reject")


@query(
    "duplicate_keys",
    """WITH keys AS (SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem GROUP BY ALL)
    SELECT CAST(sum(n) AS BIGINT) AS total_rows, count(*) AS distinct_keys,
      count(*) FILTER (WHERE n > 1) AS repeated_keys FROM keys""",
)
def duplicate_keys(spark, folder):
    return rules.duplicate_keys(table(spark, folder, "lineitem"), ["l_orderkey", "l_linenumber"])


@query(
    "required_not_null",
    f"""WITH {LEDGER} SELECT sync_id FROM ledger WHERE finished_at IS NULL OR fetched_count IS NULL
    ORDER BY sync_id LIMIT 10""",
)
def required_not_null(spark, folder):
    return rules.rows_missing_fields(ledger(spark, folder), "sync_id", ["finished_at", "fetched_count"])


@query(
    "count_reconcile",
    """WITH remote AS (SELECT o_orderpriority AS resource, count(*) AS n FROM orders GROUP BY ALL),
    local AS (SELECT o_orderpriority AS resource, count(*) AS n FROM orders
      WHERE o_totalprice <= 499500 OR o_orderpriority = '5-LOW' GROUP BY ALL)
    SELECT resource, coalesce(remote.n, 0) AS remote_count, coalesce(local.n, 0) AS local_count,
      abs(coalesce(local.n, 0) - coalesce(remote.n, 0)) / greatest(coalesce(remote.n, 0), 1) * 100.0
        AS deviation_pct,
      abs(coalesce(local.n, 0) - coalesce(remote.n, 0)) / greatest(coalesce(remote.n, 0), 1) * 100.0 <= 0.1
        AS within_tolerance
    FROM remote FULL JOIN local USING (resource)""",
)
def count_reconcile(spark, folder):
    orders = table(spark, folder, "orders").withColumnRenamed("o_orderpriority", "resource")
    gone = (F.col("o_totalprice") > 499500) & (F.col("resource") != "5-LOW")
    stored = orders.withColumn("_deleted_at", F.when(gone, now()))
    return rules.reconcile_counts(stored, orders)


@query(
    "source_row_count",
    "SELECT o_orderstatus AS resource, count(*) AS remote_count FROM orders GROUP BY ALL",
)
def source_row_count(spark, folder):
    orders = table(spark, folder, "orders").withColumnRenamed("o_orderstatus", "resource")
    return orders.groupBy("resource").agg(F.count("*").alias("remote_count"))


# --- health -----------------------------------------------------------------------------------


@query(
    "stuck_requests",
    f"""WITH {REQUESTS} SELECT pipeline, count(*) AS stuck FROM requests
    WHERE status = 'claimed' AND claimed_at < TIMESTAMP '2024-01-20 12:00:00' - INTERVAL 5 MINUTE GROUP BY ALL""",
)
def stuck_requests(spark, folder):
    stuck = rules.stuck_requests(requests(spark, folder), at("2024-01-20 12:00:00"))
    return stuck.groupBy("pipeline").agg(F.count("*").alias("stuck"))


@query(
    "staleness",
    f"""WITH {BEATS} SELECT user_id, last_beat, {_micros(NOW, 'last_beat')} AS age_seconds,
      {_micros(NOW, 'last_beat')} > 120 AS is_stale, {_micros(NOW, 'last_beat')} > 7200 AS is_dead FROM beats""",
)
def staleness(spark, folder):
    return rules.staleness(beats(spark, folder).drop("started_at"), "last_beat", now())


@query(
    "health_verdict",
    f"""WITH {BEATS}, {REQUESTS.strip()}, signs AS (
      SELECT {_micros("TIMESTAMP '2024-01-30 23:58:00'", '(SELECT max(last_beat) FROM beats)')} < 120 AS fresh,
        (SELECT count(*) FROM requests WHERE status = 'claimed'
          AND claimed_at < TIMESTAMP '2024-01-30 23:58:00' - INTERVAL 5 MINUTE) = 0 AS clear)
    SELECT fresh AS heartbeat_fresh, clear AS no_stuck_requests, fresh AND clear AS healthy FROM signs""",
)
def health_verdict(spark, folder):
    as_of = at("2024-01-30 23:58:00")
    return rules.health_verdict(beats(spark, folder), "last_beat", requests(spark, folder), as_of)


@query(
    "uptime_text",
    f"""WITH {BEATS}, ages AS (
      SELECT user_id, CAST(floor({_micros('last_beat', 'started_at')}) AS BIGINT) AS s FROM beats)
    SELECT user_id, CASE WHEN s // 86400 > 0 THEN (s // 86400) || 'd ' || (s // 3600 % 24) || 'h'
      WHEN s // 3600 > 0 THEN (s // 3600 % 24) || 'h ' || (s // 60 % 60) || 'm'
      ELSE (s // 60 % 60) || 'm' END AS uptime FROM ages""",
)
def uptime(spark, folder):
    seconds = F.timestamp_diff("SECOND", F.col("started_at"), F.col("last_beat"))
    return beats(spark, folder).select("user_id", uptime_text(seconds).alias("uptime"))


# --- retention --------------------------------------------------------------------------------

# Shorter limits than the defaults, so that the month of test rows has both kinds.
KEEP = Retention(logs=20, error_logs=10, results=10, runs=20, requests=15)

_EXPIRED_LOGS = f""""timestamp" < {NOW} - CASE WHEN level IN ('ERROR', 'CRITICAL') THEN INTERVAL 10 DAY
  ELSE INTERVAL 20 DAY END"""


@query(
    "retention_preview",
    f"""WITH {RESULTS}, {LOGS.strip()}, {REQUESTS.strip()}
    SELECT 'logs' AS kind, count(*) AS expired_rows FROM logs
      WHERE {_EXPIRED_LOGS} AND level NOT IN ('ERROR', 'CRITICAL')
    UNION ALL SELECT 'error_logs', count(*) FROM logs WHERE {_EXPIRED_LOGS} AND level IN ('ERROR', 'CRITICAL')
    UNION ALL SELECT 'results', count(*) FROM results WHERE finished_at < {NOW} - INTERVAL 10 DAY
    UNION ALL SELECT 'runs', count(*) FROM ledger WHERE started_at < {NOW} - INTERVAL 20 DAY
    UNION ALL SELECT 'requests', count(*) FROM requests
      WHERE status IN ('done', 'failed', 'cancelled') AND finished_at < {NOW} - INTERVAL 15 DAY""",
)
def retention_preview(spark, folder):
    parts = (
        (logs(spark, folder), retention.expired_logs(now(), KEEP)),
        (_results(spark, folder), retention.expired_results(now(), KEEP)),
        (ledger(spark, folder), retention.expired_runs(now(), KEEP)),
        (requests(spark, folder), retention.expired_requests(now(), KEEP)),
    )
    previews = [retention.preview(rows, expired) for rows, expired in parts]
    result = previews[0]
    for other in previews[1:]:
        result = result.unionByName(other)
    return result


@query(
    "retention_apply",
    f"""WITH {LOGS}, {REQUESTS.strip()}
    SELECT 'logs' AS source, event_id AS id FROM logs WHERE NOT ({_EXPIRED_LOGS})
    UNION ALL SELECT 'requests', id FROM requests
      WHERE NOT coalesce(status IN ('done', 'failed', 'cancelled') AND finished_at < {NOW} - INTERVAL 15 DAY, false)""",
)
def retention_apply(spark, folder):
    kept = retention.keep_rows(logs(spark, folder), retention.expired_logs(now(), KEEP))
    asked = retention.keep_rows(requests(spark, folder), retention.expired_requests(now(), KEEP))
    return kept.select(F.lit("logs").alias("source"), F.col("event_id").alias("id")).unionByName(
        asked.select(F.lit("requests").alias("source"), "id")
    )


@query(
    "expired_log_days",
    f"""WITH {LOGS} SELECT DISTINCT strftime("timestamp", '%Y-%m-%d') AS log_date FROM logs
    WHERE CAST("timestamp" AS DATE) < DATE '2024-01-21'""",
)
def expired_log_days(spark, folder):
    """Days of which the whole partition can go."""
    dated = logs(spark, folder).withColumn("log_date", F.to_date("timestamp"))
    days = expired_days(dated, date(2024, 1, 21))
    return days.withColumn("log_date", F.col("log_date").cast("string"))


@query(
    "gfs_keep",
    """WITH days AS (
      SELECT CAST(o_orderdate AS DATE) AS d, max(o_orderkey) AS snapshot_id FROM orders GROUP BY ALL),
    tiers AS (
      SELECT *, 'daily' AS tier, 7 AS n FROM days
      UNION ALL SELECT *, 'weekly', 4 FROM days WHERE dayofweek(d) = 0
      UNION ALL SELECT *, 'monthly', 6 FROM days WHERE day(d) = 1)
    SELECT CAST(d AS VARCHAR) AS day, snapshot_id, tier FROM tiers
    QUALIFY row_number() OVER (PARTITION BY tier ORDER BY d DESC) <= n""",
)
def gfs_keep(spark, folder):
    taken = table(spark, folder, "orders").select("o_orderdate", F.col("o_orderkey").alias("snapshot_id"))
    kept = retention.keep_by_tier(taken, "o_orderdate", "snapshot_id")
    return kept.withColumn("day", F.col("day").cast("string"))
