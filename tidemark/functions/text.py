"""Text shapes of log payloads and alert messages."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidemark.model import MAX_PAYLOAD_CHARS


def payload_size(fields: Column) -> Column:
    """Characters of a string map printed as ASCII JSON with a space after each ``:`` and ``,``."""
    text = F.to_json(fields)
    entries = F.cardinality(fields)
    beyond_ascii = F.length(F.regexp_replace(text, r"[\x00-\x7e]+", ""))
    beyond_16_bit = F.length(F.regexp_replace(text, r"[\x{0}-\x{ffff}]+", ""))
    # A character outside ASCII is printed as \uXXXX, one outside 16 bits as two of those.
    escapes = beyond_ascii * 5 + beyond_16_bit * 6
    return F.length(text) + F.greatest(entries * 2 - 1, F.lit(0)) + escapes


def cap_payload(fields: Column, limit: int = MAX_PAYLOAD_CHARS) -> Column:
    """The map as JSON text, or a marker with the original size when it is too long."""
    size = payload_size(fields)
    marker = F.to_json(F.struct(F.lit(True).alias("_truncated"), size.alias("original_size")))
    return F.when(size > limit, marker).otherwise(F.to_json(fields))


def plain(text: Column) -> Column:
    """Text without the signs that chat markup would read as formatting."""
    return F.translate(text, "`_*", "' ")


def failed_run_text(pipeline: Column, resource: Column, error: Column, sync_id: Column) -> Column:
    return F.concat(
        F.lit("Sync FAILED\nPipeline: "), pipeline,
        F.lit("\nResource: "), resource,
        F.lit("\nError: "), plain(F.substring(F.coalesce(error, F.lit("")), 1, 300)),
        F.lit("\nRun: "), F.substring(sync_id, 1, 8),
    )


def failed_rules_text(pipeline: Column, resource: Column, rules: Column, sync_id: Column) -> Column:
    names = F.array_join(F.transform(rules, lambda r: F.translate(r, "_*", " ")), ", ")
    return F.concat(
        F.lit("Validation FAILED\nPipeline: "), pipeline,
        F.lit("\nResource: "), resource,
        F.lit("\nRules: "), names,
        F.lit("\nRun: "), F.substring(sync_id, 1, 8),
    )


def stale_beat_text(last_beat: Column, age_hours: Column) -> Column:
    return F.concat(
        F.lit("Scheduler DEAD\nLast heartbeat: "), last_beat,
        F.lit(" ("), F.format_string("%.1f", age_hours), F.lit("h ago)"),
    )
