"""Sales aggregates: category x region totals, category and region metrics, counts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.functions.money import money_avg, money_sum


def category_region_sales(df: DataFrame, sort: bool = True) -> DataFrame:
    """category, region, total_sales, total_quantity, transaction_count."""
    totals = df.groupBy("category", "region").agg(
        money_sum("amount").alias("total_sales"),
        F.sum("quantity").alias("total_quantity"),
        F.count(F.lit(1)).alias("transaction_count"),
    )
    return totals.orderBy("category", "region") if sort else totals


def category_metrics(df: DataFrame, sort: bool = True) -> DataFrame:
    """category, average_amount, total_amount, transaction_count."""
    metrics = df.groupBy("category").agg(
        money_avg("amount").alias("average_amount"),
        money_sum("amount").alias("total_amount"),
        F.count(F.lit(1)).alias("transaction_count"),
    )
    return metrics.orderBy("category") if sort else metrics


def region_metrics(df: DataFrame, sort: bool = True) -> DataFrame:
    """region, total_quantity, average_amount, transaction_count."""
    metrics = df.groupBy("region").agg(
        F.sum("quantity").alias("total_quantity"),
        money_avg("amount").alias("average_amount"),
        F.count(F.lit(1)).alias("transaction_count"),
    )
    return metrics.orderBy("region") if sort else metrics


def category_counts(df: DataFrame) -> DataFrame:
    """category, count: the plain grouped count."""
    return df.groupBy("category").count()
