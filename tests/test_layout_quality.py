import pytest
from pyspark.sql import functions as F

from quarry import operators as op
from quarry.plans.joins import has_at_most, join_bounded
from quarry.sources import synth
from quarry.sources.files import lines_frame, read_text_lines, write_text
from tests.conftest import plan_text, rows


@pytest.fixture()
def sales(spark):
    return synth.generate_sales(spark, 2000, partitions=3)


def test_partition_sweep_rows_identical_for_every_count(sales):
    swept = op.partition_sweep(sales, (1, 3, 8))
    per_n = {}
    for r in swept.collect():
        per_n.setdefault(r.partition_count, set()).add(
            (r.category, r.region, r.total_sales, r.total_quantity, r.transaction_count)
        )
    assert len(per_n) == 3 and per_n[1] == per_n[3] == per_n[8]
    assert len(per_n[1]) == 25


def test_partition_sweep_partials_equal_raw_rows_and_direct(sales):
    cols = ("partition_count", "category", "region", "total_sales", "total_quantity", "transaction_count")
    partials = rows(op.partition_sweep(sales, (2, 5)), *cols)
    assert partials == rows(op.partition_sweep(sales, (2, 5), move="rows"), *cols)
    direct = rows(op.category_region_sales(sales), *cols[1:])
    assert [r[1:] for r in partials if r[0] == 2] == direct
    with pytest.raises(ValueError):
        op.partition_sweep(sales, (2,), move="bogus")


def test_partition_sweep_scans_its_input_once(spark, sales, out_dir):
    path = f"{out_dir}/sales"
    sales.write.parquet(path)
    swept = op.partition_sweep(spark.read.parquet(path), (2, 4, 8))
    assert len(swept.collect()) == 3 * 25  # runs this frame's own (adaptive) plan to its final form
    plan = plan_text(swept).split("Initial Plan")[0]
    # The scan + partial aggregation exchange runs once; the other branches reuse it.
    assert plan.count("FileScan parquet") == 1
    assert plan.count("ReusedExchange") == 2


def test_repartition_changes_layout_not_rows(sales):
    base = rows(op.category_region_sales(sales))
    assert rows(op.category_region_sales(op.repartition_by(sales, "region"))) == base
    assert rows(op.category_region_sales(op.repartition_by(sales, "region", rebalance=True))) == base
    assert op.partition_count(op.repartition_evenly(sales, 5)) == 5
    profile = op.partition_profile(op.repartition_evenly(sales, 5))
    assert profile.agg(F.sum("rows")).first()[0] == 2000


def test_non_positive_partition_count_raises(sales):
    with pytest.raises(ValueError):
        op.repartition_evenly(sales, 0)


@pytest.mark.parametrize("strategy", ["none", "cache", "memory_and_disk"])
def test_reuse_strategies_give_identical_results(spark, sales, strategy, out_dir):
    run = op.run_reuse_workload(sales, 3, strategy, f"{out_dir}/{strategy}")
    assert run.result_rows == 30  # 3 iterations x (5 categories + 5 regions)
    got = spark.read.parquet(run.result_path)
    expected = op.workload_results(sales, 1)
    for i in (1, 2, 3):
        assert rows(got.where(F.col("iteration") == i)) == rows(expected.withColumn("iteration", F.lit(i)), *got.columns)
    assert sales.storageLevel.useMemory is False  # the operator released what it persisted


def test_reuse_rejects_bad_arguments(sales, out_dir):
    with pytest.raises(ValueError):
        op.run_reuse_workload(sales, 0, "cache", out_dir)
    with pytest.raises(ValueError):
        op.run_reuse_workload(sales, 1, "bogus", out_dir)


def test_json_line_validity(spark, out_dir):
    lines = ['{"a": 1}', '{"k":', "", "5", '{"a": 1} trailing', '{"a": 1, "a": 2}', '{"a":1}{"b":2}', "[1,2] z", "[1, 2]"]
    path = write_text(spark.createDataFrame([(l,) for l in lines], "value string"), "value", out_dir)
    got = op.json_line_validity(read_text_lines(spark, path)).first()
    # valid: the object, the scalar and the array that stand alone on their lines
    assert (got.total_lines, got.valid_lines, got.invalid_lines) == (9, 3, 6)


def test_expected_key_diff_both_directions(spark):
    actual = spark.createDataFrame([(1,), (2,), (2,), (5,)], "k int")
    expected = spark.createDataFrame([(1,), (2,), (3,)], "k int")
    assert rows(op.expected_key_diff(actual, expected, "k")) == [(3, "missing"), (5, "unexpected")]


def test_expected_key_diff_nulls_and_duplicates(spark):
    actual = spark.createDataFrame([(1,), (1,), (None,), (7,), (7,)], "k int")
    expected = spark.createDataFrame([(1,), (None,), (4,), (4,)], "k int")
    got = sorted(op.expected_key_diff(actual, expected, "k").collect(), key=lambda r: (r.status, str(r.k)))
    # null keys never match (as in an anti-join): one missing, one unexpected
    assert [(r.k, r.status) for r in got] == [(4, "missing"), (None, "missing"), (7, "unexpected"), (None, "unexpected")]


def test_roundtrip_diff_matches_except_all(spark):
    a = spark.createDataFrame([(1, "x"), (1, "x"), (1, "x"), (2, None), (3, "nan")], "i int, s string")
    b = spark.createDataFrame([(1, "x"), (2, None), (2, None), (4, "y")], "i int, s string")
    r = op.roundtrip_diff(a, b).first()
    assert (r.missing_rows, r.extra_rows) == (a.exceptAll(b).count(), b.exceptAll(a).count()) == (3, 2)
    nan = spark.createDataFrame([(float("nan"),), (1.0,)], "v double")
    assert tuple(op.roundtrip_diff(nan, nan).first()) == (0, 0)
    empty = a.limit(0)
    assert tuple(op.roundtrip_diff(empty, empty).first()) == (0, 0)
    assert tuple(op.roundtrip_diff(a, empty).first()) == (5, 0)


def test_bounds_check_counts_violations_and_nulls(spark):
    df = spark.createDataFrame([(1, 2.0), (0, 1.0), (2, None), (3, -1.0)], "trial int, seconds double")
    out = {r.rule: (r.checked_rows, r.violations) for r in op.bounds_check(
        df, {"trial_positive": F.col("trial") > 0, "seconds_positive": F.col("seconds") > 0}
    ).collect()}
    assert out == {"trial_positive": (4, 1), "seconds_positive": (4, 2)}


def test_count_gate_and_row_counts(spark, sales):
    gate = op.count_gate(sales, 2000, "sales").first()
    assert (gate.actual_rows, gate.expected_rows, gate.passed) == (2000, 2000, True)
    assert op.count_gate(sales, 1999).first().passed is False
    assert op.count_gate(sales, sales.limit(10)).first().expected_rows == 10
    counts = {r.stage: r.rows for r in op.row_counts({"all": sales, "few": sales.limit(7)}).collect()}
    assert counts == {"all": 2000, "few": 7}


def test_counts_where_one_pass(spark):
    df = spark.createDataFrame([(1,), (2,), (None,), (4,)], "x int")
    got = {r.stage: r.rows for r in op.counts_where(df, {"all": F.lit(True), "big": F.col("x") > 1}).collect()}
    assert got == {"all": 4, "big": 2}  # a null predicate counts as not kept
    with pytest.raises(ValueError):
        op.counts_where(df, {})


def test_roundtrip_diff_counts_multiset_differences(spark):
    a = spark.createDataFrame([(1,), (1,), (2,)], "x int")
    b = spark.createDataFrame([(1,), (2,), (3,)], "x int")
    r = op.roundtrip_diff(a, b).first()
    assert (r.missing_rows, r.extra_rows) == (1, 1)


def test_assert_passed_raises_on_violation(spark):
    check = spark.createDataFrame([("a", 0), ("b", 3)], "rule string, violations int")
    op.assert_passed(check.where("rule = 'a'"), F.col("violations") > 0)
    with pytest.raises(AssertionError):
        op.assert_passed(check, F.col("violations") > 0)


def test_size_check_bounds_rows_and_bytes(spark):
    from quarry.plans.joins import bounded_sides, row_bytes

    df = spark.createDataFrame([(1, "ab", 2.0), (2, None, 3.0), (3, "\u00e9", None)], "k int, s string, v double")
    # fixed widths 4 + 8 per row, plus the UTF-8 bytes of the strings (2 + 0 + 2)
    assert df.agg(F.sum(row_bytes(df))).first()[0] == 3 * 12 + 4
    wide = spark.createDataFrame([("x" * 1000,)] * 5, "s string")
    got = bounded_sides({"df": df, "wide": wide}, max_rows=10, max_bytes=1000)
    assert got == {"df": True, "wide": False}
    assert bounded_sides({"wide": wide}, max_rows=10, max_bytes=None) == {"wide": True}
    assert not has_at_most(df, 2) and has_at_most(df, 3)


def test_join_bounded_broadcasts_only_small_sides(spark):
    big = spark.range(1000).withColumnRenamed("id", "k")
    small = spark.range(10).withColumnRenamed("id", "k")
    assert has_at_most(small, 10) and not has_at_most(small, 9)
    assert "BroadcastHashJoin" in plan_text(join_bounded(big, small, "k", max_rows=10))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = plan_text(join_bounded(big, small, "k", max_rows=5))
        assert "BroadcastHashJoin" not in plan
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert join_bounded(big, small, "k", max_rows=5).count() == 10
