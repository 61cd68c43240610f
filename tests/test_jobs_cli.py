import pathlib

import pytest
from pyspark.sql import functions as F

from quarry.__main__ import main
from quarry.plans import jobs
from quarry.sources import schemas, synth
from quarry.sources.files import read_csv, write_json


def test_study_table_shape_and_improvement(spark):
    m = spark.createDataFrame(
        [(c, t, s, 0.5, 30) for c, vals in {"none": [3.0, 1.0, 2.0], "cache": [1.0, 1.0, 4.0]}.items() for t, s in zip((1, 2, 3), vals)],
        "config string, trial int, seconds double, materialise_seconds double, result_rows bigint",
    )
    rows = {r.config: r for r in jobs.study_table(m, baseline="none").collect()}
    assert rows["none"].median_seconds == 2.0 and rows["none"].improvement_percent == 0.0
    assert rows["cache"].median_seconds == 1.0 and rows["cache"].improvement_percent == 50.0
    assert rows["cache"].trial_3_seconds == 4.0 and rows["cache"].result_rows == 30
    assert rows["cache"].average_materialisation_seconds == 0.5


@pytest.mark.parametrize("move", ["partials", "rows"])
def test_partition_study_measures_every_count(spark, move):
    sales = synth.generate_sales(spark, 500, partitions=2)
    m = jobs.partition_study(sales, (2, 4), trials=3, move=move)
    assert m.count() == 6
    table = jobs.study_table(m)
    assert {r.config: r.result_rows for r in table.collect()} == {"2": 25, "4": 25}


SIZED = ("spark.sql.shuffle.partitions", "spark.sql.files.maxPartitionBytes", "spark.sql.adaptive.advisoryPartitionSizeInBytes")


@pytest.fixture()
def restore_sizing(spark):
    saved = {k: spark.conf.get(k, None) for k in SIZED}
    yield
    for k, v in saved.items():
        if v is None:
            spark.conf.unset(k)
        else:
            spark.conf.set(k, v)


def test_input_sizing_from_a_distributed_listing(spark, out_dir, restore_sizing):
    from quarry.session import input_bytes, scale_conf, size_for_input

    write_json(synth.generate_sales(spark, 400, partitions=3), f"{out_dir}/sales")
    data_files = [p for p in pathlib.Path(f"{out_dir}/sales").rglob("*") if p.is_file() and p.name[0] not in "._"]
    on_disk = sum(p.stat().st_size for p in data_files)
    assert input_bytes(spark, f"{out_dir}/sales") == on_disk
    conf = size_for_input(spark, f"{out_dir}/sales")
    assert spark.conf.get("spark.sql.shuffle.partitions") == conf["spark.sql.shuffle.partitions"]
    cores = spark.sparkContext.defaultParallelism
    assert conf["spark.sql.shuffle.partitions"] == str(2 * cores)  # small input: two waves of tasks
    # 100 TB: 200 MiB a reduce task, without a cap.
    assert scale_conf(100 * 2**40, 8000)["spark.sql.shuffle.partitions"] == str(100 * 2**40 // (200 * 2**20) + 1)


def test_cli_generate_reports_and_partition_study(spark, out_dir, restore_sizing):
    assert main(["generate-transactions", "--records", "3000", "--output", f"{out_dir}/tx.csv"]) == 0
    assert main(["reports", "--input", f"{out_dir}/tx.csv", "--output", f"{out_dir}/out", "--reuse", "cache"]) == 0
    country = read_csv(spark, f"{out_dir}/out/country_metrics", jobs.COUNTRY_METRICS)
    assert country.agg(F.sum("total_transactions")).first()[0] == 3000
    write_json(synth.generate_sales(spark, 400), f"{out_dir}/sales")
    assert main(["partition-study", "--input", f"{out_dir}/sales", "--output", f"{out_dir}/p.csv", "--partitions", "2", "4"]) == 0
    assert read_csv(spark, f"{out_dir}/p.csv").count() == 2


def test_study_checks_catch_missing_configs_and_bad_rows(spark):
    m = spark.createDataFrame(
        [("none", t, 1.0 + t, 0.0, 30) for t in (1, 2, 3)] + [("cache", t, 0.5, 0.1, 29) for t in (1, 2, 3)],
        "config string, trial int, seconds double, materialise_seconds double, result_rows bigint",
    )
    checks, ranking = jobs.verify_reuse_study(jobs.study_table(m, baseline="none"), 3, 10)
    got = {r.check: r.violations for r in checks.collect()}
    assert got == {
        "configurations_match_expected": 1,  # memory_and_disk missing
        "row_count_matches_expected": 1,
        "trials_positive": 0,
        "median_positive": 0,
        "result_rows_expected": 1,
    }
    assert [r.config for r in ranking.orderBy("rank").collect()] == ["cache", "none"]


def test_verify_partition_study(spark, out_dir):
    sales = synth.generate_sales(spark, 300)
    write_json(sales, f"{out_dir}/s")
    from quarry.sources.files import read_json_lines, read_text_lines

    data = read_json_lines(spark, f"{out_dir}/s", schemas.SALES)
    study = jobs.study_table(jobs.partition_study(data, (2, 4), trials=3))
    checks = jobs.verify_partition_study(read_text_lines(spark, f"{out_dir}/s"), data, study, 300, (2, 4))
    assert {r.check: r.violations for r in checks.collect()} == {
        "input_lines_valid_json": 0,
        "record_count": 0,
        "configurations_match_expected": 0,
        "row_count_matches_expected": 0,
        "trials_positive": 0,
        "median_positive": 0,
    }


def test_study_table_shows_every_trial_or_raises(spark):
    five = spark.createDataFrame([(c, t, float(t)) for c in ("16", "2") for t in range(1, 6)], "config string, trial int, seconds double")
    rows = jobs.study_table(five).collect()
    assert [r.config for r in rows] == ["2", "16"]  # counts sort as numbers
    assert rows[0].trial_5_seconds == 5.0 and rows[0].median_seconds == 3.0
    with pytest.raises(ValueError):
        jobs.study_table(five, trials=(1, 2, 3))


def test_study_checks_count_missing_trials_and_repeated_configurations(spark):
    study = spark.createDataFrame(
        [("a", 1.0, 2.0, 2.0), ("b", 1.0, None, 1.0), ("b", 1.0, 1.0, 1.0)], "config string, trial_1_seconds double, trial_2_seconds double, median_seconds double"
    )
    got = {r.check: (r.checked_rows, r.violations) for r in jobs.study_checks(study, ["a", "b"]).collect()}
    assert got["trials_positive"] == (3, 1)
    assert got["configurations_match_expected"] == (2, 0)
    assert got["row_count_matches_expected"] == (3, 1)


def test_word_count_command_checks_only_given_expectations(spark, out_dir, restore_sizing):
    from quarry.sources.files import write_text

    write_text(spark.createDataFrame([("one two two",)], "value string"), "value", f"{out_dir}/t")
    assert main(["wordcount", "--input", f"{out_dir}/t"]) == 0
    assert main(["wordcount", "--input", f"{out_dir}/t", "--expect", "two=2"]) == 0
    assert main(["wordcount", "--input", f"{out_dir}/t", "--expect", "two=3"]) == 1


def _transactions(spark, n=900):
    from quarry.sources import synth

    df = synth.generate_transactions(spark, n, partitions=3)
    return df.withColumn("amount", F.when(F.col("transaction_id") % 10 == 0, F.lit(-1.0)).otherwise(F.col("amount")))


@pytest.mark.parametrize(("reuse", "scans"), [("none", 3), ("cache", 1)])
def test_reports_count_in_the_pass_that_runs_anyway(spark, out_dir, reuse, scans):
    read = spark.sparkContext.accumulator(0)
    plain = _transactions(spark)

    def count(batches):
        for batch in batches:
            read.add(batch.num_rows)
            yield batch

    raw = plain.mapInArrow(count, plain.schema)
    run = jobs.run_reports(raw, f"{out_dir}/{reuse}", reuse=reuse, expected_loaded=900, expected_clean=810)
    assert (run.loaded_rows, run.clean_rows) == (900, 810)
    assert read.value == scans * 900
    with pytest.raises(ValueError, match="clean: expected 811 records, found 810"):
        jobs.run_reports(raw, f"{out_dir}/{reuse}-no", reuse=reuse, expected_clean=811)


def test_studies_refuse_another_record_count(spark, out_dir):
    from quarry.sources import synth

    sales = synth.generate_sales(spark, 300, partitions=2)
    assert jobs.partition_study(sales, (2,), trials=1, expected_records=300).count() == 1
    for move in ("partials", "rows"):
        with pytest.raises(ValueError, match="records: expected 299"):
            jobs.partition_study(sales, (2,), trials=1, move=move, expected_records=299)
    with pytest.raises(ValueError, match="records: expected 301"):
        jobs.reuse_study(lambda: sales, out_dir, trials=1, iterations=1, expected_records=301)


def test_cli_studies_are_verified(spark, out_dir, restore_sizing, capsys):
    data, study, reuse = (f"{out_dir}/{n}" for n in ("s", "p.csv", "r.csv"))
    assert main(["generate-sales", "--records", "400", "--output", data, "--partitions", "2"]) == 0
    assert main(["partition-study", "--input", data, "--output", study, "--partitions", "2", "4", "--expected-records", "400"]) == 0
    assert "best partition count: " in capsys.readouterr().out
    check = ["verify-partition-study", "--input", data, "--study", study, "--partitions", "2", "4"]
    assert main([*check, "--expected-records", "400"]) == 0
    assert main([*check, "--expected-records", "401"]) == 1
    assert main(["verify-partition-study", "--input", data, "--study", study, "--expected-records", "400"]) == 1
    assert main(["reuse-study", "--input", data, "--output", reuse, "--iterations", "2"]) == 0
    assert main(["verify-reuse-study", "--study", reuse, "--iterations", "2"]) == 0
    assert main(["verify-reuse-study", "--study", reuse, "--iterations", "3"]) == 1
