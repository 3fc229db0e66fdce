"""Counters of runs, fed by the stream of finished runs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidemark.operators.ledger import TABLE

GROUP = (*TABLE, "mode", "status", "day")
#: Files of a batch, at most.
FILES = 4


def daily_counters(runs: DataFrame, at: str = "started_at", late: str = "1 day") -> DataFrame:
    """Runs, rows written and seconds per table, mode, status and UTC day of a stream of finished runs.

    A day's state goes when the watermark, ``late`` behind the newest run, has passed its end; runs that come later
    still are not counted. Runs without a time are left out, null counts add nothing.
    """
    timed = runs.withColumn("_day_of", F.col(at).cast("timestamp")).filter(F.col("_day_of").isNotNull())
    day = F.window("_day_of", "1 day")
    return timed.withWatermark("_day_of", late).groupBy(*TABLE, "mode", "status", day.alias("_window")).agg(
        F.count("*").alias("runs"), F.coalesce(F.sum("upserted_count"), F.lit(0)).alias("records_upserted"),
        F.coalesce(F.sum("duration_seconds"), F.lit(0)).cast("decimal(20,2)").alias("seconds"),
    ).select(*TABLE, "mode", "status", F.to_date("_window.start").alias("day"), "runs", "records_upserted", "seconds")


def start_metrics_stream(runs: DataFrame, path: str, checkpoint: str, **options: str) -> StreamingQuery:
    """Write the counters that each batch changed, as totals, into a folder of the batch; a batch that is repeated
    after a crash replaces its folder."""

    def save(changed: DataFrame, batch: int) -> None:
        # Dealt out anew: coalesced, all parts of the state would be worked on, and held, by one task.
        changed.repartition(FILES, *GROUP).write.mode("overwrite").parquet(f"{path}/batch={batch}")

    return (
        daily_counters(runs, **options).writeStream.outputMode("update").foreachBatch(save)
        .option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    )


def read_metrics(spark: SparkSession, path: str) -> DataFrame:
    """The newest totals of each group: those of the last batch that changed it."""
    values = F.struct("batch", "runs", "records_upserted", "seconds")
    newest = spark.read.parquet(path).groupBy(*GROUP).agg(F.max(values).alias("_v"))
    return newest.select(*GROUP, "_v.runs", "_v.records_upserted", "_v.seconds")
