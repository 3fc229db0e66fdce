"""The data model: synced resources, table schemas and default thresholds."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

# Defaults a user of the data model relies on.
OVERLAP_MINUTES = 5
ID_BATCH_SIZE = 200
LOOKBACK_RUNS = 7
MAX_PAYLOAD_CHARS = 10_240
LOCAL_TIME_ZONE = "Asia/Ho_Chi_Minh"
DURATION_BUCKETS = (1, 5, 10, 30, 60, 180, 600, 1800, 7200)
LEVELS = ("DEBUG", "INFO", "WARNING", "ERROR", "CRITICAL")
ERROR_LEVELS = ("ERROR", "CRITICAL")
REQUEST_STATUSES = ("pending", "claimed", "running", "done", "failed", "cancelled")
RESULT_STATUSES = ("ok", "warning", "failed", "skipped")
MODES = ("incremental", "full_refresh")


@dataclass(frozen=True)
class Resource:
    """One synced table: its key and which of the optional behaviours it has."""

    name: str
    key: tuple[str, ...] = ("id",)
    soft_delete: bool = True
    incremental: bool = True
    countable: bool = True
    updated_at_required: bool = True
    # The guard compares with all fetched rows, or only with the accepted ones.
    guard_on_accepted: bool = False
    envelope: str = ""

    @property
    def page_field(self) -> str:
        return self.envelope or self.name

    @property
    def state_schema(self) -> T.StructType:
        fields = [T.StructField(c, T.LongType(), False) for c in self.key]
        fields.append(T.StructField("updated_at", T.TimestampType(), not self.updated_at_required))
        fields.append(T.StructField("_raw", T.StringType(), False))
        fields.append(T.StructField("_synced_at", T.TimestampType(), False))
        if self.soft_delete:
            fields.append(T.StructField("_deleted_at", T.TimestampType(), True))
        fields.append(T.StructField("_sync_id", T.StringType(), True))
        return T.StructType(fields)


RESOURCES = {
    r.name: r
    for r in (
        Resource("orders"),
        Resource("customers"),
        Resource("products", guard_on_accepted=True),
        Resource(
            "inventory_levels",
            key=("inventory_item_id", "location_id"),
            soft_delete=False,
            incremental=False,
            countable=False,
            updated_at_required=False,
            envelope="inventory_locations",
        ),
        Resource("locations", incremental=False, countable=False, updated_at_required=False),
    )
}


def resource(name: str) -> Resource:
    if name not in RESOURCES:
        raise ValueError(f"unknown resource {name!r}, expected one of {sorted(RESOURCES)}")
    return RESOURCES[name]


@dataclass(frozen=True)
class Thresholds:
    """Limits of the data-quality rules, in percent where not said otherwise."""

    parity_max_skip: float = 1.0
    zero_streak: int = 3
    drift_warn: float = 5.0
    drift_fail: float = 20.0
    delete_max: float = 5.0
    count_tolerance: float = 0.1
    row_drop_warn: float = 10.0
    volume_lower: float = 0.2
    volume_upper: float = 3.0
    volume_min_samples: int = 3
    volume_days: int = 7


@dataclass(frozen=True)
class Retention:
    """Days to keep the rows of the audit tables."""

    logs: int = 90
    error_logs: int = 30
    results: int = 30
    runs: int = 90
    requests: int = 30


CHECKPOINT_SCHEMA = (
    "pipeline string, resource string, last_updated_at timestamp, last_id bigint, "
    "last_sync_id string, last_sync_at timestamp, last_status string"
)
LEDGER_SCHEMA = (
    "sync_id string, pipeline string, resource string, mode string, trigger string, "
    "request_id string, started_at timestamp, finished_at timestamp, status string, "
    "fetched_count bigint, upserted_count bigint, skipped_invalid bigint, soft_deleted_count bigint, "
    "rows_before bigint, rows_after bigint, duration_seconds decimal(10,2), error string"
)
RESULT_SCHEMA = (
    "sync_id string, pipeline string, resource string, rule string, status string, "
    "details string, created_at timestamp"
)
