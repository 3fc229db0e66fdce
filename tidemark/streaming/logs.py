"""Log events from a stream into the day-partitioned log table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidemark.model import MAX_PAYLOAD_CHARS
from tidemark.operators.logs import log_rows


def start_log_stream(
    events: DataFrame,
    path: str,
    checkpoint: str,
    fields: str = "fields",
    min_level: str = "INFO",
    limit: int = MAX_PAYLOAD_CHARS,
    available_now: bool = True,
) -> StreamingQuery:
    """Filter, redact, cap and append; the file sink writes every batch exactly once."""
    rows = log_rows(events, fields, min_level, limit).withColumn("log_date", F.to_date("timestamp"))
    writer = (
        rows.writeStream.format("parquet")
        .partitionBy("log_date")
        .option("checkpointLocation", checkpoint)
        .option("path", path)
    )
    return (writer.trigger(availableNow=True) if available_now else writer).start()
