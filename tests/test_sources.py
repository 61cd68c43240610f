import datetime as dt

import pytest
from pyspark.sql import functions as F

from quarry import operators as op
from quarry.plans import jobs
from quarry.sources import schemas, synth
from quarry.sources.files import read_csv, read_json_lines, write_csv, write_json
from tests.conftest import SF_SMALL, rows


def test_synthetic_data_is_partition_independent(spark):
    one = synth.generate_transactions(spark, 3000, partitions=1)
    many = synth.generate_transactions(spark, 3000, partitions=7)
    assert rows(one) == rows(many)
    s1, s7 = synth.generate_sales(spark, 3000, partitions=1), synth.generate_sales(spark, 3000, partitions=7)
    assert rows(s1) == rows(s7)


def test_synthetic_value_domains(spark):
    tx = synth.generate_transactions(spark, 5000, anchor=dt.date(2025, 1, 1))
    agg = tx.agg(
        F.min("date"), F.max("date"), F.min("customer_id"), F.max("customer_id"),
        F.min("amount"), F.max("amount"), F.countDistinct("product_category"), F.countDistinct("country"),
    ).first()
    assert agg[0] >= dt.date(2024, 1, 2) and agg[1] <= dt.date(2025, 1, 1)
    assert 1 <= agg[2] and agg[3] <= 500_000
    assert 10.0 <= agg[4] and agg[5] <= 1000.0
    assert (agg[6], agg[7]) == (5, 6)
    sales = synth.generate_sales(spark, 5000)
    q = sales.agg(F.min("quantity"), F.max("quantity"), F.countDistinct("region")).first()
    assert (q[0], q[1], q[2]) == (1, 50, 5)
    assert [(f.name, f.dataType) for f in tx.schema.fields] == [(f.name, f.dataType) for f in schemas.TRANSACTIONS.fields]
    assert [(f.name, f.dataType) for f in sales.schema.fields] == [(f.name, f.dataType) for f in schemas.SALES.fields]


def test_generators_reject_non_positive_sizes(spark):
    with pytest.raises(ValueError):
        synth.generate_transactions(spark, 0)
    with pytest.raises(ValueError):
        synth.generate_sales(spark, -1)


def test_range_map_reduce_example(spark):
    assert spark.range(1, 1001).agg(F.sum(F.col("id") * 2)).first()[0] == 1001000


def test_csv_roundtrip_with_schema_and_all_strings(spark, out_dir):
    df = synth.generate_transactions(spark, 500)
    path = write_csv(df, f"{out_dir}/tx")
    assert rows(read_csv(spark, path, schemas.TRANSACTIONS)) == rows(df)
    as_text = read_csv(spark, path)
    assert {t for _, t in as_text.dtypes} == {"string"}


def test_date_text_normalised_on_load_bad_text_dropped(spark, out_dir):
    raw = spark.createDataFrame(
        [(1, "2024-01-02", 1, "A", 5.0, "UK"), (2, "not a date", 1, "A", 5.0, "UK")], schemas.TRANSACTIONS_TEXT_DATE
    )
    path = write_csv(raw, f"{out_dir}/raw")
    loaded = read_csv(spark, path, schemas.TRANSACTIONS_TEXT_DATE).withColumn("date", F.try_to_date("date"))
    assert [(r.transaction_id, r.date) for r in op.clean_transactions(loaded).collect()] == [(1, dt.date(2024, 1, 2))]


def test_json_lines_fixed_schema_malformed_lines_become_null_rows(spark, out_dir):
    lines = spark.createDataFrame(
        [('{"transaction_id":1,"category":"A","region":"N","amount":2.5,"quantity":3}',), ('{"k":',)], "value string"
    )
    lines.write.text(f"{out_dir}/sales")
    df = read_json_lines(spark, f"{out_dir}/sales", schemas.SALES)
    assert df.count() == 2
    assert op.category_counts(df).where(F.col("category").isNull()).first()["count"] == 1


def test_json_sink_omits_nulls_and_inferred_read_is_alphabetical(spark, out_dir):
    df = spark.createDataFrame([(2, None, 1.5)], "b long, a string, c double")
    path = write_json(df, f"{out_dir}/j", single_file=True)
    back = read_json_lines(spark, path)
    assert back.columns == ["b", "c"]


def test_report_pipeline_both_modes_agree(spark, out_dir):
    raw = synth.generate_transactions(spark, 4000)
    a = jobs.read_reports(spark, jobs.run_reports(raw, f"{out_dir}/a", reuse="none"))
    b = jobs.read_reports(spark, jobs.run_reports(raw, f"{out_dir}/b", reuse="cache", repartition_on="country"))
    for name in a:
        assert rows(a[name]) == rows(b[name].select(*a[name].columns))
    assert a["top_customers"].count() == 100
    assert a["country_metrics"].count() == 6


def test_entry_smoke(spark):
    import __spark_entry__ as E

    out = E.entry(spark)
    assert out.columns == ["country", "total_transactions", "total_revenue", "avg_transaction_value"]
    assert out.count() > 0


def test_every_query_of_the_reference_has_an_oracle(spark):
    import __spark_entry__ as E

    extra = {"pipeline", *(E.llm.queries() if E.llm else ())}  # tested in tests/llm
    assert set(E.queries()) - set(E.oracle_sql()) <= extra
    for name, fn in E.queries().items():
        if name not in extra:
            assert fn(spark, SF_SMALL).columns, name


def test_seeds_give_other_rows_and_ids_do_not_repeat(spark):
    one, two = (synth.generate_sales(spark, 200, seed=s).drop("transaction_id") for s in (1, 2))
    assert one.collect() == synth.generate_sales(spark, 200, seed=1).drop("transaction_id").collect()
    assert one.collect() != two.collect()
    ids = spark.createDataFrame([(i + k * 2**31,) for i in range(20) for k in (0, 1)], "id long")
    rows = synth.synth_transactions(ids).orderBy("transaction_id").drop("transaction_id").collect()
    assert rows[:20] != rows[20:]
    assert synth.generate_sales(spark, 5_000_000).rdd.getNumPartitions() >= 3


def test_shared_folder_must_be_named():
    import pytest

    from quarry.plans.storage import shared_dir

    class Unset:
        class conf:
            get = staticmethod(lambda *_: None)

        class sparkContext:
            getCheckpointDir = staticmethod(lambda: None)
            master = "local[2]"

    with pytest.raises(RuntimeError):
        shared_dir(Unset)
