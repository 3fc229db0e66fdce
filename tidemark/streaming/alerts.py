"""Alert de-duplication on a stream, with the recent sends of each pipeline as state."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import types as T
from pyspark.sql.streaming.state import GroupStateTimeout

from tidemark.operators.alerts import MAX_PER_RATE, QUIET_SECONDS, RATE_SECONDS, make_replay


def dedupe_alert_stream(
    alerts: DataFrame,
    pipeline: str = "pipeline",
    key: str = "key",
    at: str = "at",
    alert_id: str = "alert_id",
    quiet_s: int = QUIET_SECONDS,
    rate_s: int = RATE_SECONDS,
    max_per_rate: int = MAX_PER_RATE,
) -> DataFrame:
    """Add ``sent`` to every alert of a stream; rows of one batch are taken in time order.

    Batches have to follow each other in time. The trigger's size bounds what a task holds.
    """
    columns = alerts.columns
    replay = make_replay(quiet_s, rate_s, max_per_rate)

    def step(_, chunks, state):
        import pandas as pd

        pdf = pd.concat(list(chunks)).sort_values([at, alert_id], kind="stable")
        times, keys = state.get if state.exists else ([], [])
        sends = list(zip(times, keys))
        micros = pdf[at].astype("datetime64[us]").astype("int64").to_numpy()
        out = pdf[columns].assign(sent=replay(micros, pdf[key].tolist(), sends))
        state.update(([t for t, _ in sends], [k for _, k in sends]))
        yield out

    return alerts.groupBy(pipeline).applyInPandasWithState(
        step,
        T.StructType([*alerts.schema.fields, T.StructField("sent", T.BooleanType())]),
        "times array<bigint>, keys array<string>",
        "append",
        GroupStateTimeout.NoTimeout,
    )
