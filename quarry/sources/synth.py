"""Partition-independent synthetic transactions and sales.

Each column is a pure function of the row id and a seed (see
:mod:`quarry.functions.hashing`), so generation is an embarrassingly parallel
``spark.range`` (or any id column) with no driver-side loop, and the output
does not change with the number of partitions or executors. The anchor date
is a parameter, so the data does not drift with the calendar.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.functions.hashing import hash_pick, hash_range

# Category and country names of the transaction data, and the
# category and region names of the sales data.
TRANSACTION_CATEGORIES = ["Electronics", "Clothing", "Books", "Home", "Sports"]
TRANSACTION_COUNTRIES = ["USA", "UK", "Canada", "Germany", "France", "Japan"]
SALES_CATEGORIES = ["Electronics", "Clothing", "Food", "Books", "Toys"]
SALES_REGIONS = ["North", "South", "East", "West", "Central"]
CUSTOMERS = 500_000
DAYS_BACK = 365  # dates are anchor - 0..364 days
MIN_CENTS, MAX_CENTS = 1_000, 100_000  # amounts 10.00 .. 1000.00
MAX_QUANTITY = 50
RECORDS_PER_FILE = 2_000_000

DEFAULT_SEED = 42
# Place of each generated column in a row's digest (see quarry.functions.hashing).
TRANSACTION_PLACES = {"date": 0, "customer": 1, "category": 2, "amount": 3, "country": 4}
SALES_PLACES = {"category": 0, "region": 1, "amount": 2, "quantity": 3}


def _amount(row_id: Column, seed: int, place: int) -> Column:
    cents = F.lit(MIN_CENTS) + hash_range(row_id, seed, place, MAX_CENTS - MIN_CENTS + 1)
    return F.round(cents / F.lit(100.0), 2)


def synth_transactions(ids: DataFrame, id_col: str = "id", anchor: dt.date = dt.date(2025, 1, 1), seed: int = DEFAULT_SEED) -> DataFrame:
    """Transactions for every id in ``ids`` (columns as :data:`quarry.sources.schemas.TRANSACTIONS`)."""
    row_id = F.col(id_col)
    return ids.select(
        row_id.cast("bigint").alias("transaction_id"),
        F.date_sub(F.lit(anchor), hash_range(row_id, seed, TRANSACTION_PLACES["date"], DAYS_BACK).cast("int")).alias("date"),
        (hash_range(row_id, seed, TRANSACTION_PLACES["customer"], CUSTOMERS) + 1).cast("bigint").alias("customer_id"),
        hash_pick(row_id, seed, TRANSACTION_PLACES["category"], TRANSACTION_CATEGORIES).alias("product_category"),
        _amount(row_id, seed, TRANSACTION_PLACES["amount"]).alias("amount"),
        hash_pick(row_id, seed, TRANSACTION_PLACES["country"], TRANSACTION_COUNTRIES).alias("country"),
    )


def synth_sales(ids: DataFrame, id_col: str = "id", seed: int = DEFAULT_SEED) -> DataFrame:
    """Sales lines for every id in ``ids`` (columns as :data:`quarry.sources.schemas.SALES`)."""
    row_id = F.col(id_col)
    return ids.select(
        row_id.cast("bigint").alias("transaction_id"),
        hash_pick(row_id, seed, SALES_PLACES["category"], SALES_CATEGORIES).alias("category"),
        hash_pick(row_id, seed, SALES_PLACES["region"], SALES_REGIONS).alias("region"),
        _amount(row_id, seed, SALES_PLACES["amount"]).alias("amount"),
        (hash_range(row_id, seed, SALES_PLACES["quantity"], MAX_QUANTITY) + 1).cast("int").alias("quantity"),
    )


def _ids(spark: SparkSession, num_records: int, partitions: int | None) -> DataFrame:
    if num_records <= 0:
        raise ValueError("num_records must be greater than zero")
    if partitions is None:  # files of about 100 MB whatever the record count
        partitions = max(spark.sparkContext.defaultParallelism, -(-num_records // RECORDS_PER_FILE))
    return spark.range(1, num_records + 1, 1, partitions)


def generate_transactions(
    spark: SparkSession,
    num_records: int,
    anchor: dt.date = dt.date(2025, 1, 1),
    partitions: int | None = None,
    seed: int = DEFAULT_SEED,
) -> DataFrame:
    """Ids 1..num_records as transactions; write with any sink (parallel, one file per task)."""
    return synth_transactions(_ids(spark, num_records, partitions), anchor=anchor, seed=seed)


def generate_sales(spark: SparkSession, num_records: int, partitions: int | None = None, seed: int = DEFAULT_SEED) -> DataFrame:
    """Ids 1..num_records as sales lines."""
    return synth_sales(_ids(spark, num_records, partitions), seed=seed)
