"""Analyst tables on top of the stored data."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def revenue_daily(orders: DataFrame, ts: str, amount: str) -> DataFrame:
    return orders.groupBy(F.to_date(ts).alias("day")).agg(
        F.count("*").alias("orders"), F.sum(F.col(amount).cast("decimal(12,2)")).alias("revenue")
    )


def low_stock(levels: DataFrame, items: DataFrame, item: str, available: str, threshold: int) -> DataFrame:
    """Items whose stock over all places is under the threshold; an item without levels has none."""
    stock = levels.groupBy(item).agg(F.sum(available).alias("available"))
    return (
        items.join(stock, item, "left")
        .withColumn("available", F.coalesce("available", F.lit(0)))
        .filter(F.col("available") < threshold)
    )


def customer_value(customers: DataFrame, orders: DataFrame, customer: str, ts: str, amount: str) -> DataFrame:
    """Orders, spending and first and last order per customer; orders are summed before the join."""
    spent = orders.groupBy(customer).agg(
        F.count("*").alias("orders_count"),
        F.sum(F.col(amount).cast("decimal(12,2)")).alias("total_spent"),
        F.min(ts).alias("first_order_at"),
        F.max(ts).alias("last_order_at"),
    )
    return customers.join(spent, customer, "left").withColumns(
        {
            "orders_count": F.coalesce("orders_count", F.lit(0)),
            "total_spent": F.coalesce("total_spent", F.lit(0).cast("decimal(22,2)")),
        }
    )


def sales_rank(lines: DataFrame, items: DataFrame, item: str, quantity: str, group: str, top: int) -> DataFrame:
    """Best-selling items of each group with their rank; ties share a rank."""
    sold = lines.groupBy(item).agg(F.sum(quantity).alias("sold"))
    best = Window.partitionBy(group).orderBy(F.col("sold").desc())
    ranked = items.join(sold, item).withColumn("sales_rank", F.rank().over(best))
    return ranked.filter(F.col("sales_rank") <= top)
