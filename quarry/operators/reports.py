"""Transaction reports: revenue by country, monthly category trends, customer spend, top-k."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.functions.money import money_avg, money_sum


def country_metrics(
    df: DataFrame,
    country: str = "country",
    amount: str = "amount",
    average_name: str = "avg_transaction_value",
    sort: bool = True,
) -> DataFrame:
    """country, total_transactions, total_revenue, <average_name>; by revenue, highest first."""
    metrics = df.groupBy(country).agg(
        F.count(F.lit(1)).alias("total_transactions"),
        money_sum(amount).alias("total_revenue"),
        money_avg(amount).alias(average_name),
    )
    return metrics.orderBy(F.desc("total_revenue"), F.asc(country)) if sort else metrics


def category_trends(
    df: DataFrame,
    category: str = "product_category",
    date: str = "date",
    amount: str = "amount",
    sort: bool = True,
) -> DataFrame:
    """category, year, month, total_sales, transaction_count; by year, month, then sales descending."""
    trends = (
        df.select(category, F.year(date).alias("year"), F.month(date).alias("month"), amount)
        .groupBy(category, "year", "month")
        .agg(
            money_sum(amount).alias("total_sales"),
            F.count(F.lit(1)).alias("transaction_count"),
        )
    )
    if not sort:
        return trends
    return trends.orderBy("year", "month", F.desc("total_sales"), F.asc(category))


def customer_spend(df: DataFrame, customer: str = "customer_id", amount: str = "amount") -> DataFrame:
    """customer_id, total_spent (rounded), purchase_count for every customer."""
    return df.groupBy(customer).agg(
        money_sum(amount).alias("total_spent"),
        F.count(F.lit(1)).alias("purchase_count"),
    )


def top_customers(
    df: DataFrame,
    k: int = 100,
    customer: str = "customer_id",
    amount: str = "amount",
) -> DataFrame:
    """The ``k`` customers with the highest rounded spend; ties go to the lower customer id.

    ``orderBy(...).limit(k)`` plans as TakeOrderedAndProject: each partition
    keeps its own top ``k`` and only those are merged, never a full sort.
    """
    if k <= 0:
        raise ValueError("k must be greater than zero")
    return highest_spend(customer_spend(df, customer, amount), k, customer)


def highest_spend(spend: DataFrame, k: int = 100, customer: str = "customer_id") -> DataFrame:
    """The ``k`` highest rows of a :func:`customer_spend` table; ties go to the lower customer id."""
    if k <= 0:
        raise ValueError("k must be greater than zero")
    return spend.orderBy(F.desc("total_spent"), F.asc(customer)).limit(k)
