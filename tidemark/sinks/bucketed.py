"""State tables as Spark's own bucketed tables: a merge leaves the stored rows where they are.

A generation is one bucketed table, hashed and sorted by key. A merge appends what arrives to it, marked with a number
and the name of the attempt; the newest number per key counts. Spark reads such a table already dealt out by key,
so neither the join with what arrives nor the choice of the newest row shuffles what is stored. Few keys are looked
up by value: Spark then opens the files of their buckets only, and the row groups whose range, or Bloom filter,
may hold them.

A small versioned list names the attempts that count. An attempt that died is named nowhere and its rows are never
seen. When what was appended reaches a share of the table, or a number of merges, the next merge writes a new
generation instead, again without a shuffle of stored rows.
"""

from __future__ import annotations

import hashlib
import uuid

from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.model import Resource
from tidemark.operators.merge import active_rows, is_active, is_stale, latest_per_key, percent_lost
from tidemark.scratch import remove_folder
from tidemark.sinks.state import LAYER_SHARE, MergeResult
from tidemark.sinks.versions import VersionedTable, finished_versions

#: Merges after which a generation is written anew.
MOST_MERGES = 16
#: Fewer rows than this are not worth a task.
ROWS_A_TASK = 10_000
#: Up to so many keys are looked up by value. They are the only keys that come to the driver.
FEW_KEYS = 1000

_LIST_SCHEMA = (
    "generation int, number int, attempt string, rows bigint, total bigint, active bigint, buckets int, sync_id string"
)


class BucketedTable:
    """``buckets`` is fixed for a generation; about 128 MB to 1 GB of rows per bucket work well."""

    def __init__(
        self, spark: SparkSession, root: str, resource: Resource, buckets: int = 64, schema: T.StructType | None = None
    ):
        self.spark, self.root, self.resource = spark, root.rstrip("/"), resource
        self.schema = schema or resource.state_schema
        self.key = list(resource.key)
        self.versions = VersionedTable(spark, f"{self.root}/versions", _LIST_SCHEMA)
        self._buckets = buckets

    # --- what is stored ---------------------------------------------------------------------

    def _merges(self, version: int | None = None) -> list:
        """The merges that make up a version, in order: at most ``MOST_MERGES`` and one."""
        version = self.versions.version() if version is None else version
        return sorted(self.versions.read(version).collect(), key=lambda m: m.number) if version else []

    def _folder(self, generation: int, buckets: int) -> str:
        return f"{self.root}/generation={generation}-{buckets}"

    def _name(self, generation: int, buckets: int) -> str:
        """The name of a generation in the session's catalog, where it is entered if it is not yet known."""
        folder = self._folder(generation, buckets)
        name = f"tidemark_{hashlib.md5(folder.encode()).hexdigest()[:16]}"
        if not self.spark.catalog.tableExists(name):
            fields = [*self.schema.fields, T.StructField("_number", T.IntegerType()), T.StructField("_attempt", T.StringType())]
            columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in fields)
            by = ", ".join(f"`{k}`" for k in self.key)
            blooms = ", ".join(f"'parquet.bloom.filter.enabled#{k}' 'true'" for k in self.key)
            self.spark.sql(
                f"CREATE TABLE {name} ({columns}) USING parquet OPTIONS ({blooms}) "
                f"CLUSTERED BY ({by}) SORTED BY ({by}) INTO {buckets} BUCKETS LOCATION '{folder}'"
            )
        return name

    def _stacked(self, merges: list) -> DataFrame:
        """All rows of the merges, several per key where several merges have it."""
        name = self._name(merges[-1].generation, merges[-1].buckets)
        self.spark.catalog.refreshTable(name)
        return self.spark.table(name).filter(F.col("_attempt").isin([m.attempt for m in merges]))

    def _rows(self, merges: list, columns: list[str] | None = None, keys: list | None = None) -> DataFrame:
        """The newest row per key; with ``keys`` of those keys only, found without opening other buckets."""
        columns = columns or self.schema.names
        if not merges:
            return self.spark.createDataFrame([], self.schema).select(*columns)
        rows = self._stacked(merges)
        if keys is not None:
            rows = rows.filter(F.col(self.key[0]).isin(keys))
        if len(merges) > 1:
            newest = Window.partitionBy(*self.key).orderBy(F.col("_number").desc())
            rows = rows.select(*dict.fromkeys([*columns, *self.key]), "_number")
            rows = rows.withColumn("_rank", F.row_number().over(newest)).filter("_rank = 1")
        return rows.select(*columns)

    def read(self, version: int | None = None) -> DataFrame:
        """All rows of the newest or of a given version."""
        return self._rows(self._merges(version))

    def lookup(self, *keys: int) -> DataFrame:
        """The rows of some keys of a table with a single key column."""
        return self._rows(self._merges(), keys=list(keys))

    def active(self) -> DataFrame:
        return active_rows(self.read())

    def active_count(self) -> int:
        """From the newest list, without reading rows."""
        merges = self._merges()
        return merges[-1].active if merges else 0

    # --- merging ----------------------------------------------------------------------------

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
        """Merge accepted rows, as ``StateTable.merge`` does: one per key, stamped with the run; a full snapshot also
        sweeps the rows it lacks, if the guard agrees; a run that the newest version holds is not merged again.
        """
        number = self.versions.claim()
        try:
            return self._merge(
                number, rows, sync_id, as_of, order, full_snapshot, rejected, max_delete_percent, sweep_unmarked, unique
            )
        finally:
            self.versions.release(number)

    def _merge(
        self, number, rows, sync_id, as_of, order, full_snapshot, rejected, max_delete_percent, sweep_unmarked, unique
    ) -> MergeResult:
        key, merges = self.key, self._merges()
        before = merges[-1].active if merges else 0
        if merges and merges[-1].sync_id == sync_id:
            return MergeResult(before, before, 0, 0)
        stamp = as_of.cast(self.schema["_synced_at"].dataType)
        rows = rows.withColumns({"_sync_id": F.lit(sync_id), "_synced_at": stamp})
        attempt = f"{number}-{uuid.uuid4().hex}"
        staged_path = f"{self.root}/staged/{attempt}"
        for k in key:
            rows = rows.filter(F.col(k).isNotNull())
        latest = rows if unique else latest_per_key(rows, key, order)
        missing = [F.lit(None).cast(f.dataType).alias(f.name) for f in self.schema if f.name not in latest.columns]
        # Counted as they are written.
        seen = Observation()
        latest = latest.select("*", *missing).select(*self.schema.names)
        latest.observe(seen, F.count(F.lit(1)).alias("rows")).write.parquet(staged_path)
        upserted = seen.get["rows"]
        staged = self.spark.read.schema(self.schema).parquet(staged_path)

        sweeping = full_snapshot and self.resource.soft_delete
        soft = "_deleted_at" in self.schema.names
        swept, aborted, allowed = 0, False, False
        if sweeping:
            left = self._rows(merges, [*key, "_deleted_at", "_sync_id"]).join(staged.select(*key), key, "left_anti")
            counts = left.agg(
                F.count("*").alias("all"), F.count_if(is_active(left)).alias("active"),
                F.count_if(is_stale(sync_id, sweep_unmarked)).alias("stale"),
            ).first()
            total = counts.all + upserted
            active = counts.active + upserted
            allowed = not active or percent_lost(active, upserted + rejected) <= max_delete_percent
            aborted = not allowed
            swept = counts.stale if allowed else 0
        elif merges:
            few = upserted <= FEW_KEYS and len(key) == 1
            keys = [r[0] for r in staged.select(*key).collect()] if few else None
            known = self._rows(merges, [*key, *(["_deleted_at"] if soft else [])], keys)
            met = known.join(staged.select(*key), key).agg(
                F.count("*").alias("all"), F.count_if(is_active(known)).alias("active")
            ).first()
            total, active = merges[-1].total + upserted - met.all, before + upserted - met.active
        else:
            total = active = upserted
        if not upserted and not swept:
            remove_folder(self.spark, staged_path)
            if merges:
                self._publish(merges[:-1], merges[-1], number, sync_id, merges[-1].active)
            return MergeResult(before, before, 0, 0, aborted)

        arriving = staged
        if swept:
            # Rows that go are rows like others: the stored ones again, with the time they went.
            stale = self._rows(merges).join(staged.select(*key), key, "left_anti").filter(is_stale(sync_id, sweep_unmarked))
            stale = stale.withColumn("_deleted_at", as_of.cast(self.schema["_deleted_at"].dataType))
            arriving = arriving.unionByName(stale)
        appended = sum(m.rows for m in merges[1:]) + upserted + swept
        base = merges[0] if merges else None
        if base and len(merges) <= MOST_MERGES and appended < LAYER_SHARE * base.rows:
            self._append(arriving, upserted + swept, base.generation, base.buckets, number, attempt)
            entry = (base.generation, number, attempt, upserted + swept, total, active - swept, base.buckets, sync_id)
        else:
            generation = base.generation + 1 if base else 1
            # A generation that an earlier attempt began is left to ``expire``; its rows carry another attempt.
            if merges:
                untouched = self._rows(merges).join(arriving.select(*key), key, "left_anti")
                dealt = base.buckets == self._buckets
                self._append(untouched, total, generation, self._buckets, number, attempt, dealt)
            self._append(arriving, upserted + swept, generation, self._buckets, number, attempt)
            merges = []
            entry = (generation, number, attempt, total, total, active - swept, self._buckets, sync_id)
        self.versions.publish(
            self.spark.createDataFrame([*[tuple(m) for m in merges], entry], _LIST_SCHEMA), number
        )
        remove_folder(self.spark, staged_path)
        return MergeResult(before, active - swept, upserted, swept, aborted)

    def _append(
        self, rows: DataFrame, count: int, generation: int, buckets: int, number: int, attempt: str, dealt: bool = False
    ) -> None:
        """Add ``count`` rows to a generation. Rows that lie ``dealt`` out by key already are not moved; others go to as
        many tasks as they fill, a bucket to one of them."""
        marked = rows.select(*self.schema.names, F.lit(number).alias("_number"), F.lit(attempt).alias("_attempt"))
        if not dealt:
            marked = marked.repartition(min(buckets, count // ROWS_A_TASK + 1), *self.key)
        marked.write.insertInto(self._name(generation, buckets))

    def _publish(self, earlier: list, last, number: int, sync_id: str, active: int) -> None:
        """The same rows as before under a new version, which knows that the run was merged."""
        entry = (*tuple(last)[:5], active, last.buckets, sync_id)
        self.versions.publish(self.spark.createDataFrame([*[tuple(m) for m in earlier], entry], _LIST_SCHEMA), number)

    # --- changes and cleaning ---------------------------------------------------------------

    def changes(self, old: int, new: int | None = None) -> DataFrame:
        """Key, ``before`` and ``after`` (rows as structs, null where there was none) of every key whose row differs
        between two versions.

        Within a generation only the keys of the merges in between are read in full; across generations the two tables,
        which lie in the same buckets, are compared row by row. Stored rows are not shuffled either way.
        """
        first, last = self._merges(old), self._merges(new)
        columns = [c for c in self.schema.names if c not in self.key]
        sides = {"before": self._rows(first), "after": self._rows(last)}
        if first and last and first[-1].generation == last[-1].generation:
            known = {m.attempt for m in first}
            between = [m for m in last if m.attempt not in known]
            if not between:
                sides = {side: rows.limit(0) for side, rows in sides.items()}
            else:
                touched = self._stacked(between).select(*self.key).distinct()
                sides = {side: rows.join(touched, self.key, "left_semi") for side, rows in sides.items()}
        before, after = (
            rows.select(*self.key, F.struct(*columns).alias(side)) for side, rows in sides.items()
        )
        return before.join(after, self.key, "full_outer").filter(~F.col("before").eqNullSafe(F.col("after")))

    def expire(self, keep: int = 5) -> int:
        """Delete lists and generations that none of the newest ``keep`` versions need; returns how many.

        Readers of older versions fail from then on, and a merge must not be running.
        """
        versions = finished_versions(self.spark, self.versions.path)
        kept = {f"versions/v={v}" for v in versions[-keep:]}
        kept |= {f"generation={m.generation}-{m.buckets}" for v in versions[-keep:] for m in self._merges(v)}
        Path = self.spark._jvm.org.apache.hadoop.fs.Path
        fs = Path(self.root).getFileSystem(self.spark._jsc.hadoopConfiguration())
        removed = 0
        for top in ("", "versions/", "staged/"):
            folder = Path(f"{self.root}/{top}")
            for found in fs.listStatus(folder) if fs.exists(folder) else []:
                name = f"{top}{found.getPath().getName()}"
                if name not in kept and (top or name.startswith("generation=")):
                    removed += fs.delete(found.getPath(), True)
        return removed
