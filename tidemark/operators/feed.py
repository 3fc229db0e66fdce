"""Tables kept up to date from the changes of the tables below them, instead of being computed again."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def signed_rows(changes: DataFrame, key: Sequence[str], deleted: str = "_deleted_at") -> DataFrame:
    """The rows that changes take away (``_sign`` -1) and those they add (1).

    ``changes`` has the key and the structs ``before`` and ``after``. A soft-deleted row counts as none.
    """
    both = F.array(
        F.struct(F.lit(-1).alias("_sign"), F.col("before").alias("_row")),
        F.struct(F.lit(1).alias("_sign"), F.col("after").alias("_row")),
    )
    rows = changes.select(*key, F.inline(both)).filter(F.col("_row").isNotNull())
    rows = rows.select(*key, "_sign", "_row.*")
    return rows.filter(F.col(deleted).isNull()) if deleted in rows.columns else rows


def refreshed_sums(
    stored: DataFrame, signed: DataFrame, by: Sequence[str], count: str, sums: dict[str, Column]
) -> DataFrame:
    """A stored table of counts and sums per group, after rows were taken away and added.

    ``signed`` has the group columns and ``_sign``; ``count`` names the stored number of rows, and a group without
    rows goes. Only changes are aggregated. Sums are exact for whole numbers and decimals; null groups are groups.
    """
    names = [count, *sums]
    change = signed.groupBy(*by).agg(
        F.sum("_sign").cast("bigint").alias(f"_{count}"), *[F.sum(F.col("_sign") * c).alias(f"_{n}") for n, c in sums.items()]
    )
    types = dict(stored.dtypes)
    group = F.lit(True)
    renamed = change.select(*[F.col(b).alias(f"_by_{b}") for b in by], *[f"_{n}" for n in names])
    for b in by:
        group = group & F.col(b).eqNullSafe(F.col(f"_by_{b}"))
    joined = stored.withColumn("_stored", F.lit(True)).join(renamed, group, "full_outer")
    added = lambda n: (F.coalesce(F.col(n), F.lit(0)) + F.coalesce(F.col(f"_{n}"), F.lit(0))).cast(types[n])
    old = F.col("_stored").isNotNull()
    after = joined.select(
        *[F.when(old, F.col(b)).otherwise(F.col(f"_by_{b}")).alias(b) for b in by], *[added(n).alias(n) for n in names]
    )
    return after.filter(F.col(count) != 0).select(*stored.columns)


def refreshed_groups(
    stored: DataFrame, signed: DataFrame, rows: DataFrame, by: str, aggregate: Callable[[DataFrame], DataFrame]
) -> DataFrame:
    """A stored table with one row per value of ``by``, in which the groups that changes touch are computed again.

    For aggregates that cannot be taken back, such as least and greatest. ``rows`` are the rows as they are now; only
    those of touched groups reach the aggregation. Rows without a group are no group.
    """
    touched = signed.select(by).filter(F.col(by).isNotNull()).distinct()
    again = aggregate(rows.join(touched, by, "left_semi"))
    return stored.join(touched, by, "left_anti").unionByName(again.select(*stored.columns))
