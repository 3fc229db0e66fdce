"""The daily rollup as a stored view that is moved along by the runs that came or changed."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.model import LOCAL_TIME_ZONE
from tidemark.operators.rollup import counted_runs, merged_counts, rollup_of
from tidemark.scratch import remove_folder
from tidemark.sinks.versions import VersionedTable

_LIST = "day string, folder string, refresh_id string"


class RollupView:
    """Counted runs and their rollup, in a folder per local day. A version is a list with one row per day.

    A refresh opens and writes the days that its runs touch; folders that a list names are never changed, so one that
    dies leaves the view as it was. The list also has a row without a day that names the newest refresh, which changes
    nothing when it is repeated; refreshes come one after the other.
    """

    def __init__(self, spark: SparkSession, root: str, time_zone: str = LOCAL_TIME_ZONE):
        self.spark, self.root, self.time_zone = spark, root.rstrip("/"), time_zone
        self.versions = VersionedTable(spark, f"{self.root}/versions", _LIST)

    def read(self) -> DataFrame:
        """The rollup as it is, one row per day, table and mode; before the first refresh there is none."""
        files = self._days(self.versions.version())
        if files:
            return self.spark.read.parquet(*[f"{self.root}/rollup/{f.folder}" for f in files])
        raise LookupError(f"{self.root}: the rollup was never refreshed, or holds no run")

    def refresh(self, signed: DataFrame, refresh_id: str) -> list[str]:
        """Add runs with ``_sign`` 1 and take those with -1 away, as they were added. Gives the days that were written.

        Runs that did not finish, or were not scheduled, touch nothing.
        """
        claimed = self.versions.claim()
        try:
            return self._refresh(claimed, signed, refresh_id)
        finally:
            self.versions.release(claimed)

    def _refresh(self, claimed: int, signed: DataFrame, refresh_id: str) -> list[str]:
        if not self.versions.read(claimed - 1).filter(F.col("day").isNull() & (F.col("refresh_id") == refresh_id)).isEmpty():
            return []
        files = self._days(claimed - 1)
        staged = f"{self.root}/staged/{claimed}"
        counted = counted_runs(signed, self.time_zone)
        counted.write.mode("overwrite").parquet(staged)
        changes = self.spark.read.schema(counted.schema).parquet(staged)
        # One row per day, as the list has.
        touched = self._days_of(changes)
        folders = [f"{self.root}/counts/{f.folder}" for f in files if f.day in touched]
        counts = changes.unionByName(self.spark.read.schema(counted.schema).parquet(*folders)) if folders else changes
        counts = self._written("counts", claimed, merged_counts(counts))
        left = self._days_of(self._written("rollup", claimed, rollup_of(counts)))
        listed = [(f.day, f.folder, f.refresh_id) for f in files if f.day not in touched]
        listed += [(d, f"v={claimed}/_day={d}", refresh_id) for d in sorted(left)]
        self.versions.publish(self.spark.createDataFrame([*listed, (None, None, refresh_id)], _LIST), claimed)
        remove_folder(self.spark, staged)
        return sorted(touched)

    def _days(self, version: int) -> list:
        return self.versions.read(version).filter("day IS NOT NULL").collect()

    def _days_of(self, rows: DataFrame) -> set[str]:
        return {r[0] for r in rows.select(F.date_format("day", "yyyy-MM-dd")).distinct().collect()}

    def _written(self, name: str, version: int, rows: DataFrame) -> DataFrame:
        """The rows as a folder per day."""
        folder = f"{self.root}/{name}/v={version}"
        by_day = rows.withColumn("_day", F.date_format("day", "yyyy-MM-dd")).repartition("_day")
        by_day.write.mode("overwrite").partitionBy("_day").parquet(folder)
        return self.spark.read.schema(rows.schema).parquet(folder).select(*rows.columns)
