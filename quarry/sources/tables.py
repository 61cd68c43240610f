"""Adapters from the benchmark star schema onto the inputs the operators expect.

All mappings are plain projections and joins, so Catalyst prunes columns and
pushes filters into the Parquet scans. Dimension joins broadcast only after a
row-count check (:func:`quarry.plans.join_bounded`). The fact scans are not
round-robin spread: the joins and partial aggregations after them are cheap
per row, so a small single-file input runs faster in its scan task than after
a raw-row shuffle, and a large input already yields a partition per split.

The transactions mapping deliberately injects dirty values (null category,
NaN and negative amounts) driven by the order key, so that cleaning has real
work; every order row is still read and kept in the raw table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.plans.joins import bounded_sides, join_bounded
from quarry.sources import schemas


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One benchmark table, read with its declared schema (no inference job) when known."""
    reader = spark.read
    if name in schemas.TABLES:
        reader = reader.schema(schemas.TABLES[name])
    return reader.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """orders x customer x nation as (transaction_id, date, customer_id, product_category, amount, country)."""
    orders = table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_totalprice", "o_orderdate", "o_orderpriority"
    )
    customer = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    nation = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    # Star-join chain: every broadcast candidate is a base table, so one job
    # proves (or refutes) all the size bounds.
    small = bounded_sides({"customer": customer, "nation": nation})
    joined = join_bounded(orders, customer, orders.o_custkey == customer.c_custkey, small=small["customer"])
    joined = join_bounded(joined, nation, joined.c_nationkey == nation.n_nationkey, small=small["nation"])
    return joined.select(*_order_columns(), F.col("n_name").alias("country"))


def _order_columns() -> list[Column]:
    key = F.col("o_orderkey")
    return [
        key.alias("transaction_id"),
        F.col("o_orderdate").cast("date").alias("date"),
        F.col("o_custkey").alias("customer_id"),
        F.when(key % 17 == 0, F.lit(None).cast("string")).otherwise(F.col("o_orderpriority")).alias(
            "product_category"
        ),
        F.when(key % 23 == 0, F.lit(float("nan")))
        .when(key % 19 == 0, -F.col("o_totalprice"))
        .otherwise(F.col("o_totalprice"))
        .alias("amount"),
    ]


def order_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """:func:`transactions` without the country: the orders alone, before any join."""
    return table(spark, sf_dir, "orders").select(*_order_columns())


def customers_with_country(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``customer_id`` of the customers whose nation has a name."""
    customer = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    nation = table(spark, sf_dir, "nation").where(F.col("n_name").isNotNull()).select("n_nationkey")
    known = join_bounded(customer, nation, customer.c_nationkey == nation.n_nationkey, "left_semi")
    return known.select(F.col("c_custkey").alias("customer_id"))


def sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    """lineitem x part x supplier x nation x region as (transaction_id, category, region, amount, quantity)."""
    lineitem = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", "l_quantity"
    )
    part = table(spark, sf_dir, "part").select("p_partkey", "p_type")
    supplier = table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    nation = table(spark, sf_dir, "nation").select("n_nationkey", "n_regionkey")
    region = table(spark, sf_dir, "region").select("r_regionkey", "r_name")
    # Star-join chain over the line items: each dimension is a base table whose
    # size bound one job proves for all four; a dimension beyond the bound is
    # joined by sort-merge (AQE splits skewed partitions).
    small = bounded_sides({"part": part, "supplier": supplier, "nation": nation, "region": region})
    joined = join_bounded(lineitem, part, lineitem.l_partkey == part.p_partkey, small=small["part"])
    joined = join_bounded(joined, supplier, joined.l_suppkey == supplier.s_suppkey, small=small["supplier"])
    joined = join_bounded(joined, nation, joined.s_nationkey == nation.n_nationkey, small=small["nation"])
    joined = join_bounded(joined, region, joined.n_regionkey == region.r_regionkey, small=small["region"])
    return joined.select(
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("transaction_id"),
        F.col("p_type").alias("category"),
        F.col("r_name").alias("region"),
        F.col("l_extendedprice").alias("amount"),
        F.col("l_quantity").cast("int").alias("quantity"),
    )


def documents_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole document texts as text lines (column ``text``)."""
    return table(spark, sf_dir, "documents").select("text")


def measurements(spark: SparkSession, sf_dir: str) -> DataFrame:
    """events as a long measurement table (config, trial, seconds)."""
    events = table(spark, sf_dir, "events")
    return events.select(
        F.col("event_type").alias("config"),
        (F.col("event_id") % 3 + 1).cast("int").alias("trial"),
        F.col("value").alias("seconds"),
    )


def events_json_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """events.props as JSON text lines (column ``value``); every tenth one truncated."""
    events = table(spark, sf_dir, "events")
    return events.select(
        F.when(F.col("event_id") % 10 == 0, F.lit('{"k":')).otherwise(F.col("props")).alias("value")
    )
