import os

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
from quarry.plans import storage
from quarry.sources.files import read_csv, read_ordered, write_ordered
from quarry.sources.inference import infer_types, read_csv_typed
from tests.conftest import SF_SMALL


def _tables(spark):
    root = storage.shared_dir(spark).removeprefix("file:") + "/quarry"
    return set(os.listdir(root)) if os.path.isdir(root) else set()


def test_a_scope_deletes_what_its_result_does_not_read(spark):
    before = _tables(spark)
    with storage.Scratch(spark) as scope:
        one = storage.saved_table(spark.range(5).toDF("x"), "one")
        two = storage.saved_table(one.select((F.col("x") * 2).alias("y")), "two")
        storage.saved_table(spark.range(3), "unread")
        with storage.Scratch(spark) as inner:
            inner.keep(storage.saved_table(spark.range(2), "inner-kept"))
            storage.saved_table(spark.range(2), "inner-unread")
        top = one.agg(F.max("x")).scalar()  # read in a subquery only
        result = scope.keep(two.where(F.col("y") > top))
    left = {name.rsplit("-", 1)[0] for name in _tables(spark) - before}
    assert left == {"one", "two"}
    assert sorted(r.y for r in result.collect()) == [6, 8]
    storage.release(result)
    assert {name.rsplit("-", 1)[0] for name in _tables(spark) - before} <= {"one"}
    with pytest.raises(KeyError), storage.Scratch(spark):
        storage.saved_table(spark.range(2), "lost")
        raise KeyError
    assert not [name for name in _tables(spark) - before if name.startswith("lost")]


def test_buckets_keep_their_rows_and_are_released(spark):
    table = storage.saved_buckets(spark.range(100).toDF("k"), "some-buckets", "k", 4)
    assert table.count() == 100 and storage.folders_read(table)
    cached = table.where("k < 10").cache()
    assert storage.folders_read(cached) == storage.folders_read(table)
    cached.unpersist()
    storage.release(table)
    assert not [name for name in _tables(spark) if name.startswith("some-buckets")]


@pytest.mark.parametrize("name", ["json_roundtrip", "report_roundtrip_check", "study_checks", "trial_ranking", "sales_json_load"])
def test_queries_leave_only_what_they_read(spark, name):
    before = _tables(spark)
    df = E.queries()[name](spark, SF_SMALL)
    read = {path.rsplit("/", 1)[-1] for path in storage.folders_read(df)} | {path.rsplit("/", 2)[-2] for path in storage.folders_read(df)}
    assert _tables(spark) - before <= read
    assert df.count() > 0


COLUMNS = {
    "whole": ["1", "-7", "+3", "007"], "long": ["1", "3000000000", "-2", ""], "huge": ["12345678901234567890", "5", "1", "2"], "only_huge": ["99999999999999999999", "12345678901234567890123", "", ""],
    "part": ["1", "2.5", "-1e3", ".5"], "odd": ["1.0", "NaN", "Inf", "-Inf"], "day": ["2024-01-31", "1999-12-01", "", "2000-02-29"], "bad_day": ["2024-01-31", "2024-13-01", "x", ""],
    "moment": ["2024-01-31 10:00:00", "2024-01-31T10:00:00", "2024-02-01", ""], "truth": ["true", "FALSE", "True", ""], "mixed": ["1", "true", "x", "2024-01-01"], "number_day": ["1", "2024-01-01", "", ""],
    "empty": ["", "", "", ""], "text": ["a", "b c", "d", "e"], "truth_number": ["true", "1", "", ""], "huge_part": ["12345678901234567890", "1.5", "", ""],
}


def test_inferred_types_equal_the_readers(spark, out_dir):
    names = list(COLUMNS)
    rows = [tuple(COLUMNS[n][i] or None for n in names) for i in range(4)]
    spark.createDataFrame(rows, ", ".join(f"{n} string" for n in names)).repartition(3).write.option("header", True).csv(out_dir)
    by_reader = read_csv(spark, out_dir, infer_schema=True)
    typed = read_csv_typed(spark, out_dir)
    assert {f.name: f.dataType.simpleString() for f in typed.schema} == {f.name: f.dataType.simpleString() for f in by_reader.schema}
    assert sorted(map(str, typed.collect())) == sorted(map(str, by_reader.collect()))
    assert [f.dataType.simpleString() for f in infer_types(spark.createDataFrame([], "a string, b string"))] == ["string", "string"]


@pytest.mark.parametrize("file_format", ["csv", "json", "parquet"])
def test_ordered_files_are_read_back_in_order(spark, out_dir, file_format):
    df = spark.range(5000).selectExpr("id", "cast(id * 7919 % 5003 AS double) AS v").repartition(4)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        write_ordered(df.orderBy(F.desc("v")), out_dir, file_format)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    manifest = spark.read.json(f"{out_dir}.manifest").collect()
    assert len(manifest) > 3 and sum(r.rows for r in manifest) == 5000
    saved = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4k")  # files are split
    try:
        back = [(r.id, r.v) for r in read_ordered(spark, out_dir, df.schema, file_format).collect()]
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", saved)
    assert [v for _, v in back] == sorted((v for _, v in back), reverse=True) and len(set(back)) == 5000
    df.limit(3).write.mode("append").format(file_format).save(out_dir)  # a file that the manifest does not name
    with pytest.raises(Exception, match="the manifest and the files differ"):
        read_ordered(spark, out_dir, df.schema, file_format).collect()


def test_reports_in_many_files_keep_their_order(spark, out_dir):
    from quarry import operators as op

    clean = op.clean_transactions(E.tables.transactions(spark, SF_SMALL))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        for name, report, file_format in (("c", op.country_metrics(clean), "csv"), ("t", op.category_trends(clean), "parquet")):
            write_ordered(report, f"{out_dir}/{name}", file_format)
            want = [tuple(r) for r in report.collect()]
            assert [tuple(r) for r in read_ordered(spark, f"{out_dir}/{name}", report.schema, file_format).collect()] == want and len(want) > 20
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
