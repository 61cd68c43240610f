"""Explicit schemas: no inference pass over the input, stable types for every report."""

from __future__ import annotations

from pyspark.sql.types import (
    DateType,
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
)

# Flat e-commerce transactions. customer_id is long so that customer keys of a
# very large table cannot overflow.
TRANSACTIONS = StructType(
    [
        StructField("transaction_id", LongType()),
        StructField("date", DateType()),
        StructField("customer_id", LongType()),
        StructField("product_category", StringType()),
        StructField("amount", DoubleType()),
        StructField("country", StringType()),
    ]
)

# Same columns with the date left as text, for sources whose date must be
# normalised on load (bad text becomes null and is dropped by cleaning).
TRANSACTIONS_TEXT_DATE = StructType(
    [StructField(f.name, StringType() if f.name == "date" else f.dataType) for f in TRANSACTIONS.fields]
)

# Sales lines. Declared non-nullable by the data's producer, but file sources
# never enforce that: every column can come back null.
SALES = StructType(
    [
        StructField("transaction_id", LongType()),
        StructField("category", StringType()),
        StructField("region", StringType()),
        StructField("amount", DoubleType()),
        StructField("quantity", IntegerType()),
    ]
)

# Long measurement table: one row per timing of a configuration in a trial.
MEASUREMENTS = StructType(
    [
        StructField("config", StringType()),
        StructField("trial", IntegerType()),
        StructField("seconds", DoubleType()),
    ]
)

TEXT_LINES = StructType([StructField("text", StringType())])

# Declared schemas of the benchmark star-schema tables. Passing them to the
# reader skips the footer-reading job Spark otherwise runs per table to infer
# a schema, and pins the types the adapters rely on.
TABLES = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": (
        "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
        "o_orderdate timestamp_ntz, o_orderpriority string"
    ),
    "lineitem": (
        "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
        "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, "
        "l_shipdate timestamp_ntz"
    ),
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
    "documents": "doc_id bigint, text string, lang string, source string, n_chars bigint",
}
