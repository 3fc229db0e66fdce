"""Ordered computations over groups of any size.

A window partitioned by the group alone would put a whole hot group into one task. Here every group
is cut into buckets (a stretch of time, or a run of row numbers), each bucket is a window partition of
its own, and only one summary row per bucket is ordered over the whole group.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def running_max_before(
    rows: DataFrame, keys: Sequence[str], bucket: Column, order: str, value: Column, out: str
) -> DataFrame:
    """Add the greatest ``value`` of all earlier rows of the group; NULL values do not count."""
    tagged = rows.withColumn("_bucket", bucket).withColumn("_value", value)
    own = Window.partitionBy(*keys, "_bucket")
    inside = F.max("_value").over(own.orderBy(order).rowsBetween(Window.unboundedPreceding, -1))
    earlier = (
        tagged.groupBy(*keys, "_bucket")
        .agg(F.max("_value").alias("_top"))
        .select(
            *(F.col(k).alias(f"_k_{k}") for k in keys),
            F.col("_bucket").alias("_b"),
            F.max("_top")
            .over(Window.partitionBy(*keys).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1))
            .alias("_carry"),
        )
        .filter(F.col("_carry").isNotNull())
    )
    same = [F.col(k).eqNullSafe(F.col(f"_k_{k}")) for k in keys] + [F.col("_bucket") == F.col("_b")]
    # greatest() skips NULL, but is not defined on structs: compare by hand.
    carry, seen = F.col("_carry"), F.col("_inside")
    best = F.when(seen.isNull() | (carry > seen), F.coalesce(carry, seen)).otherwise(seen)
    return (
        tagged.withColumn("_inside", inside)
        .join(earlier, same, "left")
        .withColumn(out, best)
        .drop("_bucket", "_value", "_inside", "_carry", "_b", *(f"_k_{k}" for k in keys))
    )


MINUTE_MICROS = 60_000_000
DAY_MICROS = 1440 * MINUTE_MICROS


def with_time_bucket(
    rows: DataFrame,
    keys: Sequence[str],
    ts: str,
    rows_per_bucket: int = 500_000,
    stretch_micros: int = DAY_MICROS,
) -> DataFrame:
    """Add ``_bucket``, the start of a stretch of time that holds about ``rows_per_bucket`` rows.

    A stretch is a whole UTC day of a group, or an even part of it when the day has more rows.
    """
    stretch = F.floor(F.col("_micros") / stretch_micros)
    timed = rows.withColumn("_micros", F.unix_micros(F.col(ts).cast("timestamp")))
    timed = timed.withColumn("_stretch", stretch)
    parts = timed.groupBy(*keys, "_stretch").agg(F.ceil(F.count("*") / rows_per_bucket).alias("_parts"))
    parts = parts.select(*(F.col(k).alias(f"_k_{k}") for k in keys), F.col("_stretch").alias("_s"), "_parts")
    same = [F.col(k).eqNullSafe(F.col(f"_k_{k}")) for k in keys] + [F.col("_stretch") == F.col("_s")]
    begin = F.col("_stretch") * stretch_micros
    part = F.floor((F.col("_micros") - begin) * F.col("_parts") / stretch_micros)
    return (
        timed.join(parts, same)
        .withColumn("_bucket", begin + part * F.floor(F.lit(stretch_micros) / F.col("_parts")))
        .drop("_micros", "_stretch", "_s", "_parts", *(f"_k_{k}" for k in keys))
    )


def with_lookback(
    tagged: DataFrame, keys: Sequence[str], order: Sequence[str], depth: int, carry: Sequence[str] = ()
) -> DataFrame:
    """Add to rows with a ``_bucket`` copies, marked ``_is_copy``, of the ``depth`` rows before it.

    A frame of up to ``depth`` preceding rows over ``(keys, _bucket)`` then sees what it would see
    over the whole group, in the columns ``order`` and ``carry``. Drop the copies afterwards.
    """
    newest_first = Window.partitionBy(*keys, "_bucket").orderBy(*(F.col(c).desc() for c in order))
    payload = list(dict.fromkeys([*order, *carry]))
    tails = (
        tagged.select(*keys, "_bucket", *payload).withColumn("_rank", F.row_number().over(newest_first))
        .filter(F.col("_rank") <= depth)
        .groupBy(*keys, "_bucket")
        .agg(F.sort_array(F.collect_list(F.struct(*order, F.struct(*payload).alias("_row")))).alias("_tail"))
    )
    # Every bucket in the summary has a row, so the last `depth` of them hold enough rows.
    before = Window.partitionBy(*keys).orderBy("_bucket").rowsBetween(-depth, -1)
    history = F.flatten(F.collect_list("_tail").over(before))
    copies = (
        tails.select(*keys, "_bucket", F.slice(F.reverse(history), 1, depth).alias("_history"))
        .select(*keys, "_bucket", F.explode("_history").alias("_h"))
        .select(*keys, *(F.col(f"_h._row.{c}").alias(c) for c in payload), "_bucket")
        .withColumn("_is_copy", F.lit(True))
    )
    return tagged.withColumn("_is_copy", F.lit(False)).unionByName(copies, allowMissingColumns=True)


def dense_index(ids: DataFrame, column: str, out: str) -> DataFrame:
    """Number distinct 64-bit ids 0, 1, 2, ... in ascending order without one big sort.

    Ids are counted per block of 65 536 values, the blocks per block of blocks and so on, so no
    window partition ever holds more than 65 536 rows.
    """
    bits = 16
    level = ids.select(F.shiftright(column, bits).alias("_b")).groupBy("_b").agg(F.count("*").alias("_n"))
    offsets = _offsets(level, bits, 2)
    inside = Window.partitionBy("_b").orderBy(column)
    numbered = ids.withColumn("_b", F.shiftright(column, bits)).withColumn("_r", F.row_number().over(inside))
    return (
        numbered.join(offsets, "_b")
        .withColumn(out, F.col("_offset") + F.col("_r") - 1)
        .drop("_b", "_r", "_offset")
    )


def _offsets(blocks: DataFrame, bits: int, levels_above: int) -> DataFrame:
    """How many ids lie below each block."""
    upper = blocks.withColumn("_u", F.shiftright("_b", bits))
    below = Window.partitionBy("_u").orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    inside = upper.withColumn("_offset", F.coalesce(F.sum("_n").over(below), F.lit(0)))
    parents = upper.groupBy(F.col("_u").alias("_b")).agg(F.sum("_n").alias("_n"))
    if levels_above == 0:
        # 64 bits less three times 16: at most 65 536 blocks are left.
        top = Window.partitionBy(F.lit(0)).orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
        above = parents.withColumn("_offset", F.coalesce(F.sum("_n").over(top), F.lit(0))).drop("_n")
    else:
        above = _offsets(parents, bits, levels_above - 1)
    above = above.select(F.col("_b").alias("_u"), F.col("_offset").alias("_base"))
    return inside.join(above, "_u").select("_b", (F.col("_offset") + F.col("_base")).alias("_offset"))
