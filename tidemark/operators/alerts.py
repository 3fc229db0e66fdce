"""Alert rows derived from runs, and their de-duplication and rate limit."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.text import failed_rules_text, failed_run_text, stale_beat_text
from tidemark.operators.buckets import MINUTE_MICROS, with_time_bucket
from tidemark.operators.ledger import TABLE
from tidemark.scratch import scratch_folder

QUIET_SECONDS = 300
RATE_SECONDS = 3600
MAX_PER_RATE = 3


def alerts_of_failed_runs(ledger: DataFrame) -> DataFrame:
    failed = ledger.filter(F.col("status") == "failed")
    return failed.select(
        F.concat_ws(":", F.lit("sync_fail"), *TABLE).alias("key"),
        "pipeline",
        F.coalesce("finished_at", "started_at").alias("at"),
        "sync_id",
        failed_run_text(F.col("pipeline"), F.col("resource"), F.col("error"), F.col("sync_id")).alias("text"),
    )


def alerts_of_failed_rules(summary: DataFrame, at: str = "at") -> DataFrame:
    """From ``rules.summarize``, with the time of a run in the column ``at``."""
    failed = summary.filter("failed")
    return failed.select(
        F.concat_ws(":", F.lit("validation_fail"), *TABLE).alias("key"),
        "pipeline",
        F.col(at).alias("at"),
        "sync_id",
        failed_rules_text(
            F.col("pipeline"), F.col("resource"), F.col("failed_rules"), F.col("sync_id")
        ).alias("text"),
    )


def alerts_of_stale_beats(beats: DataFrame, last_beat: str, as_of: Column, hours: float = 2.0) -> DataFrame:
    age = F.timestamp_diff("MICROSECOND", F.col(last_beat), as_of) / 3.6e9
    return beats.filter(age > hours).select(
        F.lit("scheduler_dead").alias("key"),
        F.lit("__system__").alias("pipeline"),
        as_of.alias("at"),
        F.lit(None).cast("string").alias("sync_id"),
        stale_beat_text(F.date_format(last_beat, "yyyy-MM-dd'T'HH:mm:ss"), age).alias("text"),
    )


def make_replay(
    quiet_s: int = QUIET_SECONDS, rate_s: int = RATE_SECONDS, max_per_rate: int = MAX_PER_RATE
) -> Callable:
    """``replay(times, keys, sends)``: which alerts of one pipeline, in time order, are sent.

    ``times`` are sorted microseconds and ``sends`` the recent ``(time, key)`` sends, which it
    updates. An alert is sent unless its key was sent within the quiet time, or the pipeline sent
    its maximum within the rate window. While the maximum is reached, rows are skipped by search.
    """
    if quiet_s > rate_s:
        raise ValueError("the quiet time may not exceed the rate window, which is how far back sends are kept")
    quiet, rate = quiet_s * 1_000_000, rate_s * 1_000_000

    def replay(times, keys, sends):
        import numpy as np

        sent = np.zeros(len(times), dtype=bool)
        i = 0
        while i < len(times):
            now = int(times[i])
            while sends and now - sends[0][0] >= rate:
                sends.pop(0)
            if not keys[i]:
                sent[i] = True
            elif len(sends) >= max_per_rate:
                free = int(np.searchsorted(times, sends[0][0] + rate))
                sent[i:free] = [not k for k in keys[i:free]]
                i = free
                continue
            elif not any(k == keys[i] and now - t < quiet for t, k in sends):
                sent[i] = True
                sends.append((now, keys[i]))
            i += 1
        return sent

    return replay


def dedupe_alerts(
    alerts: DataFrame,
    pipeline: str = "pipeline",
    key: str = "key",
    at: str = "at",
    alert_id: str = "alert_id",
    quiet_s: int = QUIET_SECONDS,
    rate_s: int = RATE_SECONDS,
    max_per_rate: int = MAX_PER_RATE,
    slice_rows: int = 1_000_000,
) -> DataFrame:
    """Add ``sent`` to every alert. An alert with an empty key is always sent and not remembered.

    Whether an alert is sent depends on all sends before it, so a pipeline is replayed in time
    order. It is cut into slices of about ``slice_rows`` rows, made of minutes or of parts of a minute
    that has more: a task holds one slice, all pipelines run side by side, and only the last few
    sends of each pipeline, a small table of their own, go on to the next slice. Slices are replayed when
    this is called, each once, and kept in the shared folder.
    """
    bucketed = with_time_bucket(alerts, [pipeline], at, slice_rows, MINUTE_MICROS)
    counts = bucketed.groupBy(pipeline, "_bucket").agg(F.count("*").alias("_n"))
    before = Window.partitionBy(pipeline).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    slices = counts.select(
        F.col(pipeline).alias("_p"),
        F.col("_bucket").alias("_b"),
        F.floor(F.coalesce(F.sum("_n").over(before), F.lit(0)) / slice_rows).alias("_slice"),
    )
    last = slices.agg(F.max("_slice")).first()[0] or 0

    schema = T.StructType([*alerts.schema.fields, T.StructField("sent", T.BooleanType())])
    step = _slice_step(alerts.columns, pipeline, key, at, alert_id, make_replay(quiet_s, rate_s, max_per_rate))
    spark = alerts.sparkSession
    folder = scratch_folder(spark, "alerts")
    same = F.col(pipeline).eqNullSafe(F.col("_p")) & (F.col("_bucket") == F.col("_b"))
    sliced = bucketed.join(slices, same).drop("_p", "_b", "_bucket")
    sliced.write.partitionBy("_slice").parquet(f"{folder}/slices")
    newest = Window.partitionBy(pipeline).orderBy(F.col(at).desc(), F.col(alert_id).desc())
    for n in range(last + 1):
        rows = spark.read.parquet(f"{folder}/slices").filter(F.col("_slice") == n).drop("_slice")
        rows = rows.withColumn("_sent_before", F.lit(False))
        if n > 0:
            carried = spark.read.schema(alerts.schema).parquet(f"{folder}/sends/{n - 1}")
            rows = rows.unionByName(carried.withColumn("_sent_before", F.lit(True)))
        # Sorted by Spark, which spills, a slice goes through Python a batch at a time.
        dealt = rows.repartition(pipeline).sortWithinPartitions(
            pipeline, F.col("_sent_before").desc(), at, F.col(alert_id).asc_nulls_last()
        )
        dealt.mapInPandas(step, schema).write.parquet(f"{folder}/done/{n}")
        if n < last:
            done = spark.read.schema(schema).parquet(f"{folder}/done/{n}")
            sends = done.filter(F.col("sent") & (F.col(key) != "")).drop("sent")
            if n > 0:
                sends = sends.unionByName(carried)
            sends = sends.withColumn("_rank", F.row_number().over(newest))
            sends.filter(F.col("_rank") <= max_per_rate).drop("_rank").write.parquet(f"{folder}/sends/{n}")
    return spark.read.schema(schema).parquet(*(f"{folder}/done/{m}" for m in range(last + 1)))


def _slice_step(columns: list[str], pipeline: str, key: str, at: str, alert_id: str, replay: Callable) -> Callable:
    """Whole pipelines, each in order with its earlier sends first: between batches the recent sends are kept."""

    def step(batches):
        import pandas as pd

        last, sends = None, []
        for pdf in batches:
            names = pdf[pipeline]
            begins = names.ne(names.shift()) & ~(names.isna() & names.shift().isna())
            for _, part in pdf.groupby(begins.cumsum(), sort=False):
                name = part[pipeline].iloc[0]
                name = (None,) if pd.isna(name) else name
                if name != last:
                    last, sends = name, []
                micros = part[at].astype("datetime64[us]").astype("int64")
                old = part["_sent_before"].to_numpy(dtype=bool)
                sends.extend(zip(micros[old].tolist(), part[key][old].tolist()))
                new = part.loc[~old, columns]
                if len(new):
                    yield new.assign(sent=replay(micros[~old].to_numpy(), new[key].tolist(), sends))

    return step
