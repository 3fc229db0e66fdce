"""One sync of one table, from landed pages to merged state, checkpoint, ledger and rule results."""

from __future__ import annotations

import logging
import uuid
from dataclasses import dataclass, field
from datetime import datetime, timezone
from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.model import LEDGER_SCHEMA, MODES, RESULT_SCHEMA, Resource, Retention, Thresholds, resource
from tidemark.operators.cursor import load_checkpoint, top_position
from tidemark.operators.ledger import fold_entries, recent_runs
from tidemark.operators.merge import load_counts
from tidemark.operators.retention import expired_results, expired_runs, keep_rows
from tidemark.operators.rules import evaluate_rules
from tidemark.operators.unnest import variant_rows
from tidemark.scratch import remove_folder
from tidemark.sinks.bucketed import BucketedTable
from tidemark.sinks.state import StateTable
from tidemark.sinks.tables import append_rows, compact_rows, recover_table, retain_rows
from tidemark.sinks.versions import Checkpoints
from tidemark.sources.incremental import read_incremental
from tidemark.sources.pages import accepted, explode_pages, project_records, read_pages


@dataclass(frozen=True)
class SyncSpec:
    pipeline: str
    resource: str
    mode: str = "incremental"
    trigger: str = "schedule"
    sync_id: str = field(default_factory=lambda: str(uuid.uuid4()))
    request_id: str | None = None
    late_rows: str = "drop"

    def __post_init__(self):
        if self.mode not in MODES:
            raise ValueError(f"mode must be one of {MODES}, not {self.mode!r}")


@dataclass
class SyncResult:
    sync_id: str
    status: str = "running"
    fetched_count: int = 0
    upserted_count: int = 0
    skipped_invalid: int = 0
    soft_deleted_count: int = 0
    rows_before: int = 0
    rows_after: int = 0
    duration_seconds: float = 0.0
    error: str | None = None
    sweep_aborted: bool = False


class Warehouse:
    """The tables of one installation below one shared folder. With ``bucketed`` state tables are Spark's bucketed
    tables, whose stored rows a merge leaves where they are; choose it once per installation."""

    def __init__(self, spark: SparkSession, root: str, buckets: int = 64, bucketed: bool = False):
        self.spark, self.root, self.buckets, self.bucketed = spark, root.rstrip("/"), buckets, bucketed
        self.checkpoints = Checkpoints(spark, f"{self.root}/checkpoints")
        self.ledger_path = f"{self.root}/ledger"
        self.results_path = f"{self.root}/results"

    def state(self, pipeline: str, name: str) -> StateTable | BucketedTable:
        kind = BucketedTable if self.bucketed else StateTable
        return kind(self.spark, f"{self.root}/state/{pipeline}/{name}", resource(name), self.buckets)

    def staging(self, sync_id: str) -> str:
        return f"{self.root}/landed/{sync_id}"

    def ledger(self, pipeline: str | None = None, name: str | None = None) -> DataFrame:
        """One row per run, of all tables or of one, folded from its start and finish entries."""
        entries = self._appended(self.ledger_path, f"{LEDGER_SCHEMA}, entry_at timestamp")
        if pipeline is not None:
            entries = entries.filter(F.col("pipeline") == pipeline)
        if name is not None:
            entries = entries.filter(F.col("resource") == name)
        return fold_entries(entries, "entry_at")

    def results(self) -> DataFrame:
        return self._appended(self.results_path, RESULT_SCHEMA)

    def retain(self, as_of: datetime, keep: Retention = Retention()) -> dict[str, int]:
        """Remove expired runs and rule results from the stored tables; returns how many entries went."""
        now = F.lit(as_of)
        for path in (self.ledger_path, self.results_path):
            recover_table(self.spark, path)
        entries = self._appended(self.ledger_path, f"{LEDGER_SCHEMA}, entry_at timestamp")
        runs = fold_entries(entries, "entry_at")
        old = runs.filter(expired_runs(now, keep)["runs"]).select("sync_id")
        results = self.results()
        return {
            "runs": retain_rows(
                entries, self.ledger_path, entries.join(old, "sync_id", "left_anti").select(*entries.columns),
                ("pipeline", "resource"),
            ),
            "results": retain_rows(results, self.results_path, keep_rows(results, expired_results(now, keep))),
        }

    def compact(self) -> dict[str, int]:
        """Write the small files that each run adds to ledger and results together; returns how many were taken."""
        return {
            "runs": compact_rows(
                self.spark, self.ledger_path, f"{LEDGER_SCHEMA}, entry_at timestamp", ("pipeline", "resource")
            ),
            "results": compact_rows(self.spark, self.results_path, RESULT_SCHEMA),
        }

    def _appended(self, path: str, schema: str) -> DataFrame:
        folder = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        if not folder.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(folder):
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(path)

    def add_entry(self, **values) -> None:
        entry = {"entry_at": datetime.now(timezone.utc), **values}
        schema = self.spark.createDataFrame([], f"{LEDGER_SCHEMA}, entry_at timestamp").schema
        row = tuple(entry.get(c) for c in schema.names)
        append_rows(self.spark.createDataFrame([row], schema), self.ledger_path, by=("pipeline", "resource"))


def run_sync(
    warehouse: Warehouse,
    spec: SyncSpec,
    landing: str,
    as_of: datetime | None = None,
    limits: Thresholds = Thresholds(),
    one_per_file: bool = True,
) -> SyncResult:
    """Read landed pages, merge them, save the checkpoint, record the run and check it.

    The state is published before the checkpoint: a crash in between leads to a harmless repeated
    merge. A failed load, an unreadable page among its causes, fails the run and leaves the checkpoint where
    it was.
    """
    started = as_of or datetime.now(timezone.utc)
    return record_run(
        warehouse, spec, read_pages(warehouse.spark, landing, one_per_file), started, limits, continuous=False
    )


def record_run(
    warehouse: Warehouse, spec: SyncSpec, pages: DataFrame, started: datetime, limits: Thresholds, continuous: bool
) -> SyncResult:
    """One load with its entries in the ledger and its rule results. ``continuous``: a batch of a stream, which
    merges all its rows and never sweeps."""
    table = resource(spec.resource)
    result = SyncResult(spec.sync_id)
    warehouse.add_entry(
        sync_id=spec.sync_id, pipeline=spec.pipeline, resource=spec.resource, mode=spec.mode,
        trigger=spec.trigger, request_id=spec.request_id, started_at=started, status="running",
    )
    clock = datetime.now(timezone.utc)
    try:
        _load(warehouse, spec, table, pages, started, limits, result, continuous)
        result.status = "success"
    except Exception as error:
        result.status, result.error = "failed", str(error)
    finally:
        if result.status == "running":
            result.status, result.error = "failed", "interrupted"
        result.duration_seconds = round((datetime.now(timezone.utc) - clock).total_seconds(), 2)
        _finish(warehouse, spec, result)
    if result.status == "success":
        _check(warehouse, spec, limits, started)
    return result


def _load(
    warehouse: Warehouse,
    spec: SyncSpec,
    table: Resource,
    pages: DataFrame,
    started: datetime,
    limits: Thresholds,
    result: SyncResult,
    continuous: bool,
) -> None:
    spark = warehouse.spark
    checkpoints = warehouse.checkpoints.of(spec.pipeline, spec.resource).read()
    cursor = load_checkpoint(checkpoints, spec.pipeline, spec.resource) if table.incremental else None
    # Without a checkpoint the first run has to take, and sweep, everything.
    full = not continuous and (spec.mode == "full_refresh" or cursor is None)
    if spec.resource == "inventory_levels":
        products = warehouse.state(spec.pipeline, "products").read()
        if variant_rows(products).isEmpty():
            return

    as_of = F.lit(started)
    records = explode_pages(pages, table)
    projected = project_records(records, table, spec.sync_id, as_of)
    wanted = projected if full or continuous else read_incremental(projected, cursor, late_rows=spec.late_rows)
    # JSON is read once; counting and merging work on the typed copy.
    landed = warehouse.staging(spec.sync_id)
    wanted.write.mode("overwrite").option("compression", "zstd").parquet(landed)
    rows = spark.read.parquet(landed)

    measures = load_counts()
    if table.incremental:
        # Rejected rows do not move the cursor.
        good_top = F.when(F.col("_reject").isNull(), F.col("updated_at"))
        rows = rows.withColumn("_cursor_ts", good_top)
        top = top_position("_cursor_ts")
        measures += [F.unix_micros(top["ts"]).alias("top_micros"), top["id"].alias("top_id")]
    counts = rows.agg(*measures).first()
    result.skipped_invalid = counts.skipped
    good = accepted(spark.read.parquet(landed))
    # A look at the keys alone often spares a shuffle of whole rows.
    unique = good.groupBy(*table.key).count().filter("count > 1").isEmpty()
    merged = warehouse.state(spec.pipeline, spec.resource).merge(
        good,
        spec.sync_id,
        as_of,
        order=("updated_at", "_page", "_pos"),
        full_snapshot=full,
        rejected=0 if table.guard_on_accepted else counts.skipped,
        max_delete_percent=limits.delete_max,
        unique=unique,
    )
    # A key that was landed several times is one record.
    result.upserted_count, result.soft_deleted_count = merged.upserted, merged.soft_deleted
    result.fetched_count = merged.upserted + counts.skipped
    result.rows_before, result.rows_after = merged.rows_before, merged.rows_after
    result.sweep_aborted = merged.sweep_aborted

    if table.incremental and counts.top_micros is not None:
        top = spark.createDataFrame([(counts.top_micros, counts.top_id)], "micros bigint, last_id bigint")
        top = top.withColumn("last_updated_at", F.timestamp_micros("micros"))
        warehouse.checkpoints.save(spec.pipeline, spec.resource, top, spec.sync_id, as_of)
    remove_folder(spark, landed)


def _finish(warehouse: Warehouse, spec: SyncSpec, result: SyncResult) -> None:
    warehouse.add_entry(
        sync_id=result.sync_id, pipeline=spec.pipeline, resource=spec.resource,
        finished_at=datetime.now(timezone.utc), status=result.status,
        fetched_count=result.fetched_count, upserted_count=result.upserted_count,
        skipped_invalid=result.skipped_invalid, soft_deleted_count=result.soft_deleted_count,
        rows_before=result.rows_before, rows_after=result.rows_after,
        duration_seconds=Decimal(str(result.duration_seconds)), error=result.error,
    )


def _check(warehouse: Warehouse, spec: SyncSpec, limits: Thresholds, started: datetime) -> None:
    """Rule results of this run; a failure here does not fail the run."""
    try:
        runs = recent_runs(warehouse.ledger(spec.pipeline, spec.resource), spec.pipeline, spec.resource)
        results = evaluate_rules(runs, limits, few_runs=True).filter(F.col("sync_id") == spec.sync_id)
        append_rows(
            results.select(
                "sync_id", "pipeline", "resource", "rule", "status", "details",
                F.lit(started).alias("created_at"),
            ),
            warehouse.results_path,
        )
    except Exception:
        logging.getLogger(__name__).exception("rules of run %s were not stored", spec.sync_id)
