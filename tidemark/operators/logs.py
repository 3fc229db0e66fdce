"""Log events: from a map of fields to rows of the log table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.json import parse_once
from tidemark.functions.redact import redact_map, redact_map_exact, redact_text
from tidemark.functions.text import cap_payload
from tidemark.functions.timestamps import parse_iso
from tidemark.model import MAX_PAYLOAD_CHARS
from tidemark.operators.reports import at_least

# Fields that have a column of their own or are never stored.
NOT_IN_PAYLOAD = (
    "timestamp", "level", "event", "sync_id", "pipeline", "resource",
    "exc_info", "_record", "_logger", "_name",
)


def project_logs(events: DataFrame, fields: str = "fields", limit: int = MAX_PAYLOAD_CHARS) -> DataFrame:
    """Known fields become columns; the others become the redacted, size-capped JSON payload."""
    f = F.col(fields)

    def field(name):
        return F.try_element_at(f, F.lit(name))

    rest = F.map_filter(f, lambda k, _: ~k.isin(*NOT_IN_PAYLOAD) & ~k.startswith("_"))
    event = F.coalesce(field("event"), F.lit(""))
    # The redacted map is used several times below, and is costly.
    return parse_once(events, redact_map(redact_map_exact(rest)), "_payload").select(
        parse_iso(field("timestamp")).alias("timestamp"),
        F.upper(F.coalesce(field("level"), F.lit("INFO"))).alias("level"),
        event.alias("event"),
        field("sync_id").alias("sync_id"),
        field("pipeline").alias("pipeline"),
        field("resource").alias("resource"),
        event.alias("message"),
        cap_payload(F.col("_payload"), limit).alias("payload"),
        redact_text(field("exc_info")).alias("exc_info"),
    )


def log_rows(
    events: DataFrame, fields: str = "fields", min_level: str = "INFO", limit: int = MAX_PAYLOAD_CHARS
) -> DataFrame:
    """Events of at least ``min_level`` as log table rows; works on batches and on streams."""
    level = F.try_element_at(F.col(fields), F.lit("level"))
    kept = at_least(events.withColumn("_level", level), min_level, "_level")
    return project_logs(kept, fields, limit)
