"""State tables on plain Parquet: merged by key, published as a whole, written where and as far as touched.

Rows live in hash buckets of their key. A version is a small list that names, for every bucket, the
folders with its rows: a base, and on top of it layers with the rows of later merges, of which the newest
per key counts. A merge writes what arrives as one more layer; a bucket whose layers have grown to a share of
its base, or in number, is written as a new base instead. Then the next list is published. Files that a version
names are never changed, so readers and restarted writers see one version.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.model import Resource
from tidemark.operators.merge import (
    active_rows, is_active, is_stale, latest_per_key, percent_lost, sweep, upsert,
)
from tidemark.scratch import remove_folder
from tidemark.sinks.versions import VersionedTable, finished_versions

#: A bucket is compacted when its layers reach this part of its base, or this number.
LAYER_SHARE, MOST_LAYERS = 0.25, 8
#: Up to so many rows that a snapshot lacks are looked up by broadcast keys, and stored rows are not shuffled for them.
FEW_LEFT = 1_000_000

_LIST_SCHEMA = "bucket int, folder string, row_count bigint, active_count bigint, buckets int, sync_id string"


@dataclass(frozen=True)
class MergeResult:
    rows_before: int
    rows_after: int
    upserted: int
    soft_deleted: int
    sweep_aborted: bool = False


class StateTable:
    """``buckets`` is fixed by the first merge; about 1 to 4 GB of rows per bucket work well."""

    def __init__(self, spark: SparkSession, root: str, resource: Resource, buckets: int = 64):
        self.spark, self.root, self.resource = spark, root.rstrip("/"), resource
        self.versions = VersionedTable(spark, f"{self.root}/versions", _LIST_SCHEMA)
        self._buckets = buckets

    def _files(self, version: int) -> list:
        """One row per bucket and layer: bounded by the number of buckets."""
        return self.versions.read(version).collect() if version else []

    def _load(self, files: list, columns: list[str] | None = None) -> DataFrame:
        """The rows that the folders make up; only buckets with layers are reduced to the newest per key."""
        schema = self.resource.state_schema
        columns = columns or schema.names
        layers: dict[int, int] = {}
        for f in files:
            layers[f.bucket] = layers.get(f.bucket, 0) + 1
        single = [f"{self.root}/{f.folder}" for f in files if layers[f.bucket] == 1]
        layered = [f"{self.root}/{f.folder}" for f in files if layers[f.bucket] > 1]
        rows = self.spark.createDataFrame([], schema).select(*columns)
        if single:
            rows = self.spark.read.schema(schema).parquet(*single).select(*columns)
        if layered:
            key = list(self.resource.key)
            layer = F.regexp_extract(F.col("_metadata.file_path"), r"/data/v=(\d+)/", 1).cast("bigint")
            stacked = self.spark.read.schema(schema).parquet(*layered)
            stacked = stacked.select(*dict.fromkeys([*columns, *key]), layer.alias("_layer"))
            newest = latest_per_key(stacked, key, ["_layer"]).select(*columns)
            rows = rows.unionByName(newest) if single else newest
        return rows

    def read(self, version: int | None = None) -> DataFrame:
        """All rows of the newest or of a given version."""
        return self._load(self._files(self.versions.version() if version is None else version))

    def merge(
        self,
        rows: DataFrame,
        sync_id: str,
        as_of: Column,
        order: tuple[str, ...] = ("updated_at",),
        full_snapshot: bool = False,
        rejected: int = 0,
        max_delete_percent: float = 5.0,
        sweep_unmarked: bool = False,
        unique: bool = False,
    ) -> MergeResult:
        """Merge accepted rows; a full snapshot also sweeps the rows it lacks, if the guard agrees.

        The guard compares what is stored with the keys that arrived, each counted once, and ``rejected``
        records that were there but could not be used.
        The rows are stamped with this run, whatever they carried before, so that the sweep spares them.
        A ``sync_id`` that the newest version already holds is not merged again. ``unique`` says that no key arrives twice.
        """
        claimed = self.versions.claim()
        try:
            return self._merge(
                claimed, rows, sync_id, as_of, order, full_snapshot, rejected, max_delete_percent, sweep_unmarked, unique
            )
        finally:
            self.versions.release(claimed)

    def _merge(
        self, claimed, rows, sync_id, as_of, order, full_snapshot, rejected, max_delete_percent, sweep_unmarked, unique
    ) -> MergeResult:
        key = list(self.resource.key)
        version = claimed - 1
        files = self._files(version)
        before = sum(f.active_count for f in files)
        if files and files[0].sync_id == sync_id:
            return MergeResult(before, before, 0, 0)
        buckets = files[0].buckets if files else self._buckets

        # What arrives is written once, where it stays. It is read several times below, and as files its
        # size is known, so that the planner broadcasts it only if it is small.
        folder = f"data/v={version + 1}"
        rows = rows.withColumns({"_sync_id": F.lit(sync_id), "_synced_at": as_of.cast("timestamp")})
        seen = Observation()
        latest = rows if unique else latest_per_key(rows, key, order)
        latest = latest.observe(seen, F.count(F.lit(1)).alias("rows"))
        self._write(upsert(self._load([]), latest, key), folder, buckets, "overwrite")
        staged = self._written(folder)
        arriving = {r["_bucket"]: r["count"] for r in staged.groupBy("_bucket").count().collect()}
        # Where nothing arrives, the plan may end before the count and have none.
        upserted = seen.get["rows"] if arriving else 0

        sweeping = full_snapshot and self.resource.soft_delete
        touched = {f.bucket for f in files} | set(arriving) if sweeping else set(arriving)
        old = self._load([f for f in files if f.bucket in touched])

        allowed, aborted = False, False
        if sweeping:
            left = old.select(*key, "_deleted_at", "_sync_id").join(staged.select(*key), key, "left_anti")
            counts = left.agg(
                F.count("*").alias("all"),
                F.count_if(is_active(left)).alias("active"),
                F.count_if(is_stale(sync_id, sweep_unmarked)).alias("stale"),
            ).first()
            active = counts.active + upserted
            lost = percent_lost(active, upserted + rejected) if active else 0.0
            allowed = lost <= max_delete_percent
            aborted = not allowed
            if not allowed or not counts.stale:
                # Nothing is swept: buckets without arriving rows stay as they are.
                touched = set(arriving)
                old = self._load([f for f in files if f.bucket in touched])
        if not touched:
            self._publish(files, "", touched, buckets, sync_id, claimed)
            remove_folder(self.spark, f"{self.root}/{folder}")
            return MergeResult(before, before, upserted, 0, aborted)

        on_top = set() if allowed and counts.stale else self._on_top(files, arriving)
        gained = 0
        if on_top:
            below = [f for f in files if f.bucket in on_top]
            extra = ["_deleted_at"] if "_deleted_at" in self.resource.state_schema.names else []
            known = self._load(below, [*key, *extra])
            gained = {b: n for b, n in arriving.items() if b in on_top}
            met = known.filter(is_active(known)).join(staged.select(*key, "_bucket"), key).groupBy("_bucket").count()
            for found in met.collect():
                gained[found["_bucket"]] -= found["count"]
        below = [f for f in files if f.bucket in touched - on_top]
        if below and not (sweeping and not counts.all):
            # Rows of the buckets that are written anew and did not arrive come along.
            old = self._load(below)
            if sweeping and counts.all <= FEW_LEFT:
                untouched = old.join(F.broadcast(left.select(*key)), key, "left_semi")
            else:
                untouched = old.join(staged.select(*key), key, "left_anti")
            if sweeping:
                untouched = sweep(untouched, sync_id, as_of, sweep_unmarked, F.lit(allowed))
            self._write(untouched, folder, buckets, "append")
        self._publish(files, folder, touched, buckets, sync_id, claimed, gained or {})
        after = sum(f.active_count for f in self._files(version + 1))
        return MergeResult(before, after, upserted, counts.stale if allowed else 0, aborted)

    def _write(self, rows: DataFrame, folder: str, buckets: int, mode: str) -> None:
        """Add rows to the buckets of a folder. Rebalancing splits big buckets over several tasks and packs small ones
        together."""
        bucket = F.pmod(F.xxhash64(*self.resource.key), F.lit(buckets)).cast("int")
        rows = rows.select(*self.resource.state_schema.names, bucket.alias("_bucket")).hint("rebalance", "_bucket")
        rows.write.mode(mode).option("compression", "zstd").partitionBy("_bucket").parquet(f"{self.root}/{folder}")

    def _written(self, folder: str) -> DataFrame:
        schema = self.resource.state_schema.add("_bucket", T.IntegerType())
        return self.spark.read.schema(schema).parquet(f"{self.root}/{folder}")

    def _on_top(self, files: list, arriving: dict[int, int]) -> set[int]:
        """Buckets to which the arriving rows are added as a layer; the others are written anew."""
        sizes: dict[int, list[int]] = {}
        for f in sorted(files, key=lambda f: int(f.folder.split("/")[1][2:])):
            sizes.setdefault(f.bucket, []).append(f.row_count)
        return {
            b for b, n in arriving.items()
            if b in sizes and len(sizes[b]) < MOST_LAYERS and sum(sizes[b][1:]) + n < LAYER_SHARE * sizes[b][0]
        }

    def _publish(
        self, files: list, folder: str, touched: set, buckets: int, sync_id: str, claimed: int,
        gained: dict[int, int] | None = None,
    ) -> None:
        """List what stays and what was written; ``gained`` has the buckets that got a layer, and by how many
        active rows each has grown."""
        gained = gained or {}
        kept = [
            (f.bucket, f.folder, f.row_count, f.active_count, buckets, sync_id)
            for f in files
            if f.bucket not in touched or f.bucket in gained
        ]
        listed = self.spark.createDataFrame(kept, _LIST_SCHEMA)
        if touched:
            written = self._written(folder)
            counted = written.groupBy(F.col("_bucket").alias("bucket")).agg(
                F.count("*").alias("row_count"), F.count_if(is_active(written)).alias("active_count")
            )
            if gained:
                grown = self.spark.createDataFrame(list(gained.items()), "bucket int, _grown bigint")
                counted = counted.join(grown, "bucket", "left").withColumn(
                    "active_count", F.coalesce("_grown", "active_count")
                )
            listed = listed.unionByName(
                counted.select(
                    "bucket",
                    F.concat(F.lit(f"{folder}/_bucket="), "bucket").alias("folder"),
                    "row_count", "active_count",
                    F.lit(buckets).alias("buckets"),
                    F.lit(sync_id).alias("sync_id"),
                )
            )
        self.versions.publish(listed, claimed)

    def expire(self, keep: int = 5) -> int:
        """Delete folders that none of the newest ``keep`` versions name; returns how many.

        Readers of older versions fail from then on, and a merge must not be running.
        """
        versions = finished_versions(self.spark, self.versions.path)
        kept = [f"versions/v={v}" for v in versions[-keep:]]
        for v in versions[-keep:]:
            kept += [f.folder for f in self._files(v)]
        names = {k.split("/_bucket=")[0] for k in kept}
        Path = self.spark._jvm.org.apache.hadoop.fs.Path
        fs = Path(self.root).getFileSystem(self.spark._jsc.hadoopConfiguration())
        removed = 0
        for top in ("versions", "staged", "data"):
            folder = Path(f"{self.root}/{top}")
            for version in fs.listStatus(folder) if fs.exists(folder) else []:
                name = f"{top}/{version.getPath().getName()}"
                if name not in names:
                    removed += fs.delete(version.getPath(), True)
                elif top == "data":
                    for bucket in fs.listStatus(version.getPath()):
                        inner = f"{name}/{bucket.getPath().getName()}"
                        if bucket.isDirectory() and inner not in kept:
                            removed += fs.delete(bucket.getPath(), True)
        return removed

    def active(self) -> DataFrame:
        return active_rows(self.read())

    def active_count(self) -> int:
        """From the newest list of files, without reading rows."""
        return sum(f.active_count for f in self._files(self.versions.version()))
