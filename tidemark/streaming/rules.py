"""Data-quality rules on a stream of finished runs."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tidemark.model import LOOKBACK_RUNS, Thresholds
from tidemark.operators.ledger import RUN_ORDER, TABLE, successes
from tidemark.operators.rules import RULES, evaluate_rules
from tidemark.scratch import remove_folder

#: What a run brings along, and what is kept of it.
RUN = (
    "sync_id", *TABLE, "mode", "status", "started_at", "finished_at", "fetched_count", "upserted_count",
    "rows_before", "rows_after",
)


class RuleStream:
    """Rules of a stream of runs, as tables below ``path``.

    The state is a ring of the last ``LOOKBACK_RUNS`` successes per table, and the runs that still wait: a run is
    judged when the newest start seen is ``late_s`` seconds after its own, so runs that finish out of order by less than
    that are judged as if they had come in order. One that comes later still is judged by those of the ring that
    started before it; results that were given stay. A run that is in the ring or waits already is not
    judged again, and runs without a start, a table or success are left out.

    Batch n reads the state of the batch before it and writes its own state and results as folders of its number, which a
    repeated batch replaces. State that is two batches old is removed.
    """

    def __init__(
        self, spark: SparkSession, path: str, late_s: int = 0, limits: Thresholds = Thresholds(), rules: Sequence = RULES
    ):
        self.spark, self.path, self.late, self.limits, self.rules = spark, path, late_s, limits, rules

    def start(self, runs: DataFrame, checkpoint: str) -> StreamingQuery:
        """Judge what there is now; started again on the same checkpoint it goes on."""
        return (
            runs.select(*RUN).writeStream.foreachBatch(self.save)
            .option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
        )

    def results(self) -> DataFrame:
        """One row per judged run and rule."""
        return self.spark.read.parquet(f"{self.path}/results").drop("batch")

    def save(self, runs: DataFrame, batch: int) -> None:
        kept = self._state(batch - 1, runs.schema)
        usable = runs.filter(F.col("started_at").isNotNull() & F.col("pipeline").isNotNull() & F.col("resource").isNotNull())
        fresh = successes(usable).dropDuplicates(["sync_id"]).join(kept.select("sync_id"), "sync_id", "left_anti")
        known = kept.unionByName(fresh.withColumn("judged", F.lit(False)))
        newest = known.agg(F.max("started_at")).scalar()
        due = F.col("started_at") <= newest - F.make_dt_interval(secs=F.lit(self.late))
        ready = known.withColumn("_due", F.col("judged") | due)
        ready.write.mode("overwrite").parquet(self._folder("ready", batch))
        ready = self.spark.read.schema(ready.schema).parquet(self._folder("ready", batch))

        judged = ready.filter("_due").drop("_due")
        found = evaluate_rules(judged, self.limits, self.rules)
        new = judged.filter("NOT judged").select("sync_id")
        found.join(new, "sync_id", "left_semi").write.mode("overwrite").parquet(self._folder("results", batch))

        ring = Window.partitionBy(*TABLE).orderBy(*[F.col(c).desc() for c in RUN_ORDER])
        last = judged.withColumn("_rank", F.row_number().over(ring)).filter(F.col("_rank") <= LOOKBACK_RUNS).drop("_rank")
        state = last.withColumn("judged", F.lit(True)).unionByName(ready.filter("NOT _due").drop("_due"))
        state.write.mode("overwrite").parquet(self._folder("state", batch))
        for name, number in (("ready", batch), ("state", batch - 2)):
            remove_folder(self.spark, self._folder(name, number))

    def _state(self, batch: int, schema: T.StructType) -> DataFrame:
        kept = T.StructType([*schema.fields, T.StructField("judged", T.BooleanType())])
        if batch < 0:
            return self.spark.createDataFrame([], kept)
        return self.spark.read.schema(kept).parquet(self._folder("state", batch))

    def _folder(self, name: str, batch: int) -> str:
        return f"{self.path}/{name}/batch={batch}"
