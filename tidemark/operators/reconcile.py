"""Which rows two tables do not share, found from checksums of key ranges.

Checksums of narrow ranges are small tables that can be stored beside a table and renewed for the ranges that a load
touches. Two tables are compared by sums of wide ranges first, within differing ones by narrow ranges, and only the
rows of narrow ranges that differ are read and compared by key.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Keys in a narrow range, and narrow ranges in a wide one.
NARROW, WIDE = 1 << 10, 1 << 8
#: Up to so many ranges are looked up in filters that reach the files; beyond it ranges are joined.
MOST_STRETCHES = 500
#: So many stretches are conditions of their own; more are merged into wider ones first.
MOST_FILTERS = 32


def row_hash(columns: Sequence[str]) -> Column:
    """A hash of a row's values in which nulls have a place of their own, exact to add up."""
    values = [x for c in columns for x in (F.col(c), F.col(c).isNull())]
    return F.xxhash64(*values).cast("decimal(38,0)")


def checksums(rows: DataFrame, key: str, columns: Sequence[str], narrow: int = NARROW) -> DataFrame:
    """Number and hash sum of the rows of each narrow range of a whole-number key. Rows without a key are left out."""
    keyed = rows.filter(F.col(key).isNotNull())
    return keyed.groupBy(F.floor(F.col(key) / narrow).cast("long").alias("range")).agg(
        F.count("*").alias("rows"), F.sum(row_hash([key, *columns])).alias("sum")
    )


def _differing(left: DataFrame, right: DataFrame, by: str) -> DataFrame:
    other = right.select(F.col(by).alias("_by"), F.col("rows").alias("_rows"), F.col("sum").alias("_sum"))
    joined = left.join(other, F.col(by) == F.col("_by"), "full_outer")
    same = F.col("rows").eqNullSafe(F.col("_rows")) & F.col("sum").eqNullSafe(F.col("_sum"))
    return joined.filter(~same).select(F.coalesce(F.col(by), F.col("_by")).alias(by))


def differing_ranges(left: DataFrame, right: DataFrame, wide: int = WIDE) -> DataFrame:
    """Narrow ranges in which two tables of checksums differ; those of equal wide ranges are not compared."""
    top = F.floor(F.col("range") / wide).alias("top")
    tops = [
        sums.groupBy(top).agg(F.sum("rows").alias("rows"), F.sum("sum").alias("sum")) for sums in (left, right)
    ]
    differing = _differing(*tops, "top")
    inside = [sums.withColumn("top", top).join(differing, "top", "left_semi").drop("top") for sums in (left, right)]
    return _differing(*inside, "range")


def _stretches(ranges: list[int]) -> list[tuple[int, int]]:
    """Ranges that follow each other as one stretch, first and last."""
    found: list[tuple[int, int]] = []
    for number in sorted(ranges):
        if found and found[-1][1] == number - 1:
            found[-1] = found[-1][0], number
        else:
            found.append((number, number))
    return found


def _merged(stretches: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """At most ``MOST_FILTERS`` stretches that hold all the given ones, made by closing the smallest gaps."""
    gaps = sorted(range(1, len(stretches)), key=lambda n: stretches[n - 1][1] - stretches[n][0])
    begins = [0, *sorted(gaps[:MOST_FILTERS - 1])]
    ends = [*begins[1:], len(stretches)]
    return [(stretches[a][0], stretches[b - 1][1]) for a, b in zip(begins, ends)]


def within(rows: DataFrame, key: str, ranges: DataFrame, narrow: int = NARROW) -> DataFrame:
    """The rows whose key lies in one of the ranges.

    Hundreds of stretches in one condition are deeper than the planner's stack and more than is compiled: a few wider
    ones reach the files, and of the rows that these let through the range is looked up in a set.
    """
    few = [r[0] for r in ranges.limit(MOST_STRETCHES + 1).collect()]
    if len(few) > MOST_STRETCHES:
        return rows.withColumn("_range", F.floor(F.col(key) / narrow)).join(
            ranges.select(F.col("range").alias("_range")), "_range", "left_semi"
        ).drop("_range")
    if not few:
        return rows.filter(F.lit(False))
    stretches = [(F.col(key) >= a * narrow) & (F.col(key) < (b + 1) * narrow) for a, b in _merged(_stretches(few))]
    number = F.floor(F.col(key) / narrow).cast("long")
    return rows.filter(reduce(lambda x, y: x | y, stretches)).filter(number.isin(few))


def reconcile(
    left: DataFrame, right: DataFrame, key: str, columns: Sequence[str],
    left_sums: DataFrame | None = None, right_sums: DataFrame | None = None, narrow: int = NARROW,
) -> DataFrame:
    """key and status of every row that is ``missing`` from the right table, ``extra`` there, or ``changed``.

    With stored checksums only ranges that differ are read; without, each table is read once more to make them. Keys
    are unique in a sound table; rows that share one are compared as a group, by number and content.
    """
    sums = [
        given if given is not None else checksums(rows, key, columns, narrow)
        for rows, given in ((left, left_sums), (right, right_sums))
    ]
    ranges = differing_ranges(*sums)
    groups = [
        within(rows, key, ranges, narrow).groupBy(F.col(key).alias(name)).agg(
            F.count("*").alias(f"{name}_rows"), F.sum(row_hash([key, *columns])).alias(f"{name}_sum")
        ) for rows, name in ((left, "_a"), (right, "_b"))
    ]
    both = groups[0].join(groups[1], F.col("_a") == F.col("_b"), "full_outer")
    same = (F.col("_a_rows") == F.col("_b_rows")) & (F.col("_a_sum") == F.col("_b_sum"))
    status = F.when(F.col("_b").isNull(), "missing").when(F.col("_a").isNull(), "extra").when(~same, "changed")
    return both.select(F.coalesce("_a", "_b").alias(key), status.alias("status")).filter(F.col("status").isNotNull())
