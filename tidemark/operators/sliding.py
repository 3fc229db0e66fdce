"""Medians over a stretch of time that moves with every row, for groups of any size.

A window with a RANGE frame puts a whole group into one task. Here the time of a group is cut into buckets of a width
that divides the span. For all rows of one bucket the buckets that lie wholly within the span are the same; only
the bucket at either end is seen in part. So the middle buckets are counted once per bucket, as values with counts, and
of these only the ranks are kept that the rows at the ends can move the median to.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.operators.buckets import DAY_MICROS
from tidemark.scratch import stored

#: A day is cut into so many buckets at most, the largest power of two that divides its microseconds.
MOST_PARTS = 8192


def _medians(rows: pd.DataFrame, span: int) -> pd.DataFrame:
    """Medians before each time of one bucket. ``kind`` 0: ranks of the middle; 1: the oldest bucket; 2: the own one."""
    values, place = np.unique(rows["value"].to_numpy(), return_inverse=True)
    kind, at, n = (rows[c].to_numpy() for c in ("kind", "at", "n"))
    tree = np.zeros(len(values) + 1, dtype=np.int64)
    top = 1 << (len(values).bit_length() - 1)

    def add(where: int, count: int) -> None:
        where += 1
        while where < len(tree):
            tree[where] += count
            where += where & -where

    def value_at(rank: int) -> float:
        """The value of a rank, counted from 0 among the rows in the tree."""
        node, step = 0, top
        while step:
            if node + step < len(tree) and tree[node + step] <= rank:
                node += step
                rank -= tree[node]
            step >>= 1
        return values[node]

    for row in np.flatnonzero(kind < 2):
        add(place[row], n[row])
    middle, oldest = rows["middle"].iloc[0], np.flatnonzero(kind == 1)
    below = int(rows["below"].iloc[0])
    total = int(middle) + int(n[oldest].sum())
    leaving = oldest[np.argsort(at[oldest], kind="stable")]
    own = np.flatnonzero(kind == 2)
    own = own[np.argsort(at[own], kind="stable")]
    times, gone, come, found = np.unique(at[own]), 0, 0, []
    for time in times:
        while gone < len(leaving) and at[leaving[gone]] < time - span:
            add(place[leaving[gone]], -n[leaving[gone]])
            total -= int(n[leaving[gone]])
            gone += 1
        while come < len(own) and at[own[come]] < time:
            add(place[own[come]], n[own[come]])
            total += int(n[own[come]])
            come += 1
        pair = (value_at((total - 1) // 2 - below), value_at(total // 2 - below)) if total else (np.nan, np.nan)
        found.append((time, total, (pair[0] + pair[1]) / 2))
    return pd.DataFrame(found, columns=["at", "samples", "median"])


def sliding_median(
    rows: DataFrame, keys: Sequence[str], at: str, value: str, days: int = 7, rows_per_bucket: int = 200_000
) -> DataFrame:
    """Per key and time: how many rows of the ``days`` before it there are, and the median of their values.

    The span ends before the time itself and begins with the row that is exactly ``days`` old. Rows without a time or
    a value are left out. A bucket holds about ``rows_per_bucket`` rows on the busiest day of its group, as far as
    a day can be cut. Each counted value goes to ``days`` times as many buckets as a day has.
    """
    span, key = days * DAY_MICROS, [F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)]
    names = [f"_k{i}" for i in range(len(keys))]
    counted = rows.filter(F.col(at).isNotNull() & F.col(value).isNotNull()).groupBy(
        *key, F.unix_micros(F.col(at).cast("timestamp")).alias("at"), F.col(value).cast("double").alias("value")
    ).agg(F.count("*").alias("n"))
    # Groups are compared as one struct, in which a null key is a key like any other.
    counted = counted.select(F.struct(*names).alias("_key"), "at", "value", "n")
    parts = F.ceil(F.log2(F.greatest(F.max("_rows") / rows_per_bucket, F.lit(1.0))))
    per_day = counted.groupBy("_key", F.floor(F.col("at") / DAY_MICROS).alias("_day")).agg(F.count("*").alias("_rows"))
    cuts = per_day.groupBy("_key").agg(
        F.least(F.pow(F.lit(2.0), parts), F.lit(float(MOST_PARTS))).cast("long").alias("_parts")
    ).select(F.col("_key").alias("_of"), "_parts")
    width = F.expr(f"{DAY_MICROS} div _parts")
    cut = counted.join(cuts, F.col("_key").eqNullSafe(F.col("_of"))).drop("_of")
    # Stored, as it is read for the middles, for both ends and for their sizes.
    cut = stored(cut.withColumn("_bucket", F.floor(F.col("at") / width)).withColumn("_across", days * F.col("_parts")), "cut")

    # What a bucket needs to know before its middle is counted: that it has rows, and how many there are at its ends.
    size = cut.groupBy("_key", "_bucket", "_across").agg(F.sum("n").alias("_n"))
    oldest = size.select("_key", (F.col("_bucket") + F.col("_across")).alias("_bucket"), F.col("_n").alias("_old"))
    same = ["_key", "_bucket"]
    ends = size.select(*same, "_n").join(oldest, same, "left").select(
        *same, (F.col("_n") + F.coalesce("_old", F.lit(0))).alias("_ends")
    )
    ahead = F.explode(F.sequence(F.col("_bucket") + 1, F.col("_bucket") + F.col("_across") - 1))
    values = cut.groupBy("_key", "_bucket", "_across", "value").agg(F.sum("n").alias("n"))
    middles = (
        values.filter("_across > 1").select("_key", ahead.alias("_bucket"), "value", "n")
        .join(size.select(*same), same, "left_semi").groupBy(*same, "value").agg(F.sum("n").alias("n"))
    )
    totals = middles.groupBy(*same).agg(F.sum("n").alias("middle"))
    upwards = Window.partitionBy(*same).orderBy("value").rowsBetween(Window.unboundedPreceding, 0)
    reach = F.col("_ends") / 2 + 1
    ranks = (
        middles.withColumn("_upto", F.sum("n").over(upwards)).join(totals, same).join(ends, same)
        .withColumn("below", F.col("_upto") - F.col("n"))
        .filter((F.col("_upto") >= F.col("middle") / 2 - reach) & (F.col("below") <= F.col("middle") / 2 + reach))
    )
    summary = ranks.groupBy(*same).agg(F.first("middle").alias("middle"), F.min("below").alias("below"))
    nothing = F.lit(0).cast("long")
    meeting = (
        ranks.select(*same, F.lit(0).alias("kind"), nothing.alias("at"), "value", "n")
        .union(
            cut.select("_key", (F.col("_bucket") + F.col("_across")).alias("_bucket"), F.lit(1).alias("kind"), "at", "value", "n")
            .join(size.select(*same), same, "left_semi")
        )
        .union(cut.select(*same, F.lit(2), "at", "value", "n"))
        .join(summary, same, "left").fillna(0, ["middle", "below"])
    )
    kind = cut.schema["_key"].dataType.simpleString()

    def medians(rows_of_bucket: pd.DataFrame) -> pd.DataFrame:
        found = _medians(rows_of_bucket, span)
        found.insert(0, "_key", [rows_of_bucket["_key"].iloc[0]] * len(found))
        return found

    found = meeting.groupBy(*same).applyInPandas(medians, f"_key {kind}, at long, samples long, median double")
    return found.select(
        *[F.col(f"_key.{n}").alias(k) for n, k in zip(names, keys)],
        F.timestamp_micros("at").cast(rows.schema[at].dataType).alias(at), "samples",
        F.when(F.col("samples") > 0, F.col("median")).alias("median"),
    )
