import datetime as dt
import math

import pytest
from pyspark.sql import functions as F

from quarry import operators as op
from quarry.sources import schemas
from tests.conftest import plan_text, rows

D = dt.date(2024, 3, 5)


@pytest.fixture()
def dirty(spark):
    data = [
        (1, D, 10, "Books", 10.5, "UK"),
        (2, D, 10, "Books", float("nan"), "UK"),
        (3, D, 11, "Books", None, "UK"),
        (4, D, 11, "Home", 0.0, "UK"),
        (5, D, 12, "Home", -1.0, "USA"),
        (6, None, 12, "Home", 20.0, "USA"),
        (7, D, 13, "Home", 30.0, None),
        (8, dt.date(2024, 4, 1), 13, "Home", 40.25, "USA"),
    ]
    return spark.createDataFrame(data, schemas.TRANSACTIONS)


def test_cleaning_drops_null_nan_and_non_positive(dirty):
    assert [r.transaction_id for r in op.clean_transactions(dirty).orderBy("transaction_id").collect()] == [1, 8]


def test_drop_incomplete_alone_drops_nan_but_keeps_non_positive(dirty):
    kept = {r.transaction_id for r in op.drop_incomplete(dirty).collect()}
    assert kept == {1, 4, 5, 8}


def test_positive_filter_alone_keeps_nan(dirty):
    # NaN sorts above every number in Spark, so amount > 0 alone keeps it.
    kept = {r.transaction_id for r in op.keep_positive(dirty).collect()}
    assert kept == {1, 2, 6, 7, 8}


def test_blank_country_subset(dirty):
    kept = {r.transaction_id for r in op.drop_incomplete(dirty, ["amount"]).collect()}
    assert kept == {1, 4, 5, 6, 7, 8}


def test_country_metrics_values_and_order(spark):
    df = spark.createDataFrame(
        [(1, D, 1, "A", 10.0, "UK"), (2, D, 2, "A", 20.0, "UK"), (3, D, 3, "A", 100.0, "USA")], schemas.TRANSACTIONS
    )
    out = op.country_metrics(df).collect()
    assert [(r.country, r.total_transactions, r.total_revenue, r.avg_transaction_value) for r in out] == [
        ("USA", 1, 100.0, 100.0),
        ("UK", 2, 30.0, 15.0),
    ]


def test_category_trends_types_and_order(spark, dirty):
    out = op.category_trends(op.clean_transactions(dirty))
    assert dict(out.dtypes)["year"] == "int" and dict(out.dtypes)["month"] == "int"
    assert [(r.product_category, r.year, r.month, r.total_sales, r.transaction_count) for r in out.collect()] == [
        ("Books", 2024, 3, 10.5, 1),
        ("Home", 2024, 4, 40.25, 1),
    ]


def test_rounding_is_half_up_on_decimal_text(spark):
    df = spark.createDataFrame([(1, D, 1, "A", 1.005, "UK")], schemas.TRANSACTIONS)
    assert op.country_metrics(df).first().total_revenue == 1.01


def test_top_customers_ties_go_to_lower_id(spark):
    data = [(i, D, c, "A", amt, "UK") for i, (c, amt) in enumerate([(5, 10.0), (3, 10.0), (4, 10.0), (9, 50.0)])]
    df = spark.createDataFrame(data, schemas.TRANSACTIONS)
    out = op.top_customers(df, 3).collect()
    assert [r.customer_id for r in out] == [9, 3, 4]


def test_top_customers_plans_without_full_sort(spark, dirty):
    assert "TakeOrderedAndProject" in plan_text(op.top_customers(dirty, 2))


def test_top_customers_rejects_non_positive_k(dirty):
    with pytest.raises(ValueError):
        op.top_customers(dirty, 0)


def test_positive_filter_reaches_the_scan(spark, out_dir):
    path = f"{out_dir}/tx"
    spark.createDataFrame([(1, D, 1, "A", 5.0, "UK")], schemas.TRANSACTIONS).write.parquet(path)
    plan = plan_text(op.keep_positive(spark.read.parquet(path)))
    assert "GreaterThan(amount,0.0)" in plan


def test_nan_is_not_a_number(spark):
    assert math.isnan(spark.range(1).select(F.lit(float("nan")).alias("x")).first().x)


def test_complete_predicate_equals_na_drop_and_is_pushed(spark, out_dir):
    data = [
        (1, "a", 1.0, 2.0), (2, None, 1.0, 2.0), (3, "c", float("nan"), 2.0), (4, "d", 1.0, float("nan")),
        (5, "e", None, 2.0), (None, "f", 1.0, 2.0), (7, "g", -1.0, 0.0),
    ]
    df = spark.createDataFrame(data, "i int, s string, x double, y float")
    def norm(frame):  # NaN != NaN in Python, so compare it as text
        return [tuple("NaN" if isinstance(v, float) and math.isnan(v) else v for v in r) for r in rows(frame)]

    assert norm(op.drop_incomplete(df)) == norm(df.na.drop(how="any"))
    assert norm(op.drop_incomplete(df, ["i", "x"])) == norm(df.na.drop(how="any", subset=["i", "x"]))
    df.write.parquet(f"{out_dir}/t")
    plan = plan_text(op.drop_incomplete(spark.read.parquet(f"{out_dir}/t")))
    assert "AtLeastNNonNulls" not in plan
    for column in ("i", "s", "x", "y"):
        assert f"IsNotNull({column})" in plan


def test_money_totals_do_not_depend_on_partitioning(spark):
    from pyspark.sql import functions as F

    big = spark.range(200_000).select(F.lit("x").alias("country"), (F.col("id") * 98765.43 % 9_999_999.99).cast("decimal(18,2)").cast("double").alias("amount"))
    totals = {tuple(op.country_metrics(big.repartition(n)).first()) for n in (1, 3, 7, 16)}
    assert len(totals) == 1


def test_money_totals_show_amounts_that_are_no_numbers(spark):
    df = spark.createDataFrame([("x", 1.5), ("x", float("nan")), ("y", 2.25), ("y", None)], "country string, amount double")
    got = {r.country: (r.total_revenue, r.avg_transaction_value) for r in op.country_metrics(df).collect()}
    assert got["x"][0] != got["x"][0] and got["y"] == (2.25, 2.25)
