"""Alerts because nothing came: the silence of a pipeline, told while its stream goes on."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

_PROVIDER = "spark.sql.streaming.stateStore.providerClass"
_ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


@contextmanager
def timers(spark: SparkSession) -> Iterator[None]:
    """Within it streams are started with the state store that keeps timers."""
    before = spark.conf.get(_PROVIDER, None)
    spark.conf.set(_PROVIDER, _ROCKS)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(_PROVIDER)
        else:
            spark.conf.set(_PROVIDER, before)


class Silence(StatefulProcessor):
    """Keeps the last beat of a key and a timer for the time it is overdue.

    The state is one row per key. It is dropped ``forget_us`` after the last beat, when that silence was told.
    """

    def __init__(self, after_us: int, forget_us: int, columns: list[str]):
        self.after, self.forget, self.columns = after_us, forget_us, columns

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.last = handle.getValueState("last", "at bigint, told boolean")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        last, told = self.last.get() if self.last.exists() else (None, False)
        # Only the time of a beat counts; those that came late, or twice, change nothing.
        beats = sorted({int(t) for chunk in rows for t in chunk["beat_us"]})
        found = []
        for at in beats:
            if last is not None and at <= last:
                continue
            if last is not None and not told and at - last > self.after:
                found.append(last)
            last, told = at, False
        self.last.update((last, told))
        self._set_timer(last + (self.forget if told else self.after))
        yield self._alerts(key, found)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        found = []
        if self.last.exists():
            last, told = self.last.get()
            if told:
                self.last.clear()
            else:
                found.append(last)
                self.last.update((last, True))
                self._set_timer(last + self.forget)
        yield self._alerts(key, found)

    def _set_timer(self, at_us: int) -> None:
        for timer in list(self.handle.listTimers()):
            self.handle.deleteTimer(timer)
        self.handle.registerTimer(-(-at_us // 1000))

    def _alerts(self, key, found: list[int]) -> pd.DataFrame:
        times = {"last_beat": found, "due_at": [t + self.after for t in found]}
        frame = pd.DataFrame({n: pd.to_datetime(pd.Series(v, dtype="int64"), unit="us") for n, v in times.items()})
        for name, value in zip(self.columns, key):
            frame.insert(0, name, value)
        return frame[[*self.columns, "last_beat", "due_at"]]


def stale_beats(
    beats: DataFrame, key: str = "pipeline", at: str = "at", after_s: int = 7200, late_s: int = 0, forget_s: int = 30 * 86400
) -> DataFrame:
    """One row per silence of more than ``after_s`` seconds in a stream of beats: key, last beat, and when it was due.

    A silence is told when the watermark, ``late_s`` behind the newest beat of all keys, passes its time, or
    when the next beat shows it, whichever is first, and once only. A beat that is older than the key's last one
    changes nothing. Beats without key or time are left out. Started within ``timers(spark)``.
    """
    if forget_s <= after_s:
        raise ValueError("a key cannot be forgotten before it is overdue")
    timed = beats.select(F.col(key), F.col(at).cast("timestamp").alias("beat_time")).dropna()
    timed = timed.withColumn("beat_us", F.unix_micros("beat_time")).withWatermark("beat_time", f"{late_s} seconds")
    schema = T.StructType([
        beats.schema[key], T.StructField("last_beat", T.TimestampType()), T.StructField("due_at", T.TimestampType()),
    ])
    return timed.groupBy(key).transformWithStateInPandas(
        Silence(after_s * 1_000_000, forget_s * 1_000_000, [key]), schema, "Append", "EventTime"
    )
