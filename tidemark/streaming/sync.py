"""Continuous sync: landed pages are merged batch by batch, resumable and safe to repeat."""

from __future__ import annotations

import json
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from tidemark.model import Thresholds
from tidemark.plans.sync import SyncSpec, Warehouse, record_run
from tidemark.sources.pages import stream_pages


def stream_id(spark: SparkSession, checkpoint: str) -> str:
    """The id that a stream keeps in its checkpoint folder: another folder is another stream."""
    lines = spark.read.text(f"{checkpoint.rstrip('/')}/metadata").collect()
    return json.loads("".join(r.value for r in lines))["id"]


def start_sync_stream(
    warehouse: Warehouse,
    pipeline: str,
    name: str,
    landing: str,
    checkpoint: str,
    files_per_batch: int = 1000,
    one_per_file: bool = True,
    available_now: bool = True,
    limits: Thresholds = Thresholds(),
) -> StreamingQuery:
    """Merge new page files as they land. Every batch is a run of the ledger and one version of the state table.

    A run's id is that of the stream and of the batch: a batch that is repeated after a failure is merged once,
    and a second stream into the same table is never taken for the first. A batch that fails stops the stream.
    """

    def merge_batch(pages: DataFrame, batch: int) -> None:
        sync_id = f"{pipeline}-{name}-{stream_id(warehouse.spark, checkpoint)}-{batch}"
        spec = SyncSpec(pipeline, name, "incremental", "stream", sync_id)
        result = record_run(warehouse, spec, pages, datetime.now(timezone.utc), limits, continuous=True)
        if result.status != "success":
            raise RuntimeError(result.error)

    writer = (
        stream_pages(warehouse.spark, landing, files_per_batch, one_per_file)
        .writeStream.foreachBatch(merge_batch)
        .option("checkpointLocation", checkpoint)
        .queryName(f"sync-{pipeline}-{name}")
    )
    return (writer.trigger(availableNow=True) if available_now else writer).start()
