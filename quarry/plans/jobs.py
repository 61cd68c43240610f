"""Composite jobs: the report pipeline, the partition and reuse studies, word count with checks."""

from __future__ import annotations

import time
from collections.abc import Callable, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, LongType, StringType, StructField, StructType

from quarry.operators.clean import clean_transactions
from quarry.operators.layout import (
    PARTITION_COUNTS,
    STRATEGIES,
    partition_sweep,
    persist_with,
    repartition_by,
    run_reuse_workload,
)
from quarry.operators.quality import CountingPass, count_gate, expected_counts_check
from quarry.operators.reports import category_trends, country_metrics, top_customers
from quarry.operators.sales import category_counts
from quarry.operators.text import word_count
from quarry.plans.storage import saved_table
from quarry.sources.files import read_csv, read_json_lines, read_parquet, write_csv, write_json, write_parquet

COUNTRY_METRICS = StructType(
    [
        StructField("country", StringType()),
        StructField("total_transactions", LongType()),
        StructField("total_revenue", DoubleType()),
        StructField("avg_transaction_value", DoubleType()),
    ]
)


@dataclass(frozen=True)
class ReportRun:
    country_metrics: str
    category_trends: str
    top_customers: str
    loaded_rows: int | None = None
    clean_rows: int | None = None


def run_reports(
    raw: DataFrame,
    out_dir: str,
    reuse: str = "none",
    repartition_on: str | None = None,
    top_k: int = 100,
    expected_loaded: int | None = None,
    expected_clean: int | None = None,
) -> ReportRun:
    """Clean the transactions and write the three reports (CSV, Parquet, JSON lines).

    ``reuse="none"`` re-reads the input for each report (three scans);
    ``"cache"``/``"memory_and_disk"`` materialise the cleaned rows once and
    release them after the last write. ``repartition_on`` co-locates rows by
    a column first, using the skew-safe REBALANCE hint (a hot key is split
    instead of landing in one task).

    Rows loaded and kept are counted by the first pass over the input itself
    and returned; an expected count that they miss raises behind that pass, with
    no more than the first report written.
    """
    passing = CountingPass()
    counted = passing.watch(clean_transactions(passing.watch(raw, "loaded")), "clean")

    def laid_out(df: DataFrame) -> DataFrame:
        return repartition_by(df, repartition_on, rebalance=True) if repartition_on is not None else df

    paths = [f"{out_dir}/{name}" for name in ("country_metrics", "category_trends", "top_customers")]
    first = persist_with(laid_out(counted), reuse)
    later = first if reuse != "none" else laid_out(clean_transactions(raw))
    try:
        if reuse != "none":
            first.count()
            passing.require(loaded=expected_loaded, clean=expected_clean)
        # Small, bounded outputs (one row per country / top k): one file each.
        write_csv(country_metrics(first), paths[0], single_file=True)
        if reuse == "none":
            passing.require(loaded=expected_loaded, clean=expected_clean)
        write_parquet(category_trends(later), paths[1])
        write_json(top_customers(later, top_k), paths[2], single_file=True)
    finally:
        if reuse != "none":
            first.unpersist(blocking=True)
    return ReportRun(*paths, loaded_rows=passing.rows("loaded"), clean_rows=passing.rows("clean"))


def read_reports(spark: SparkSession, run: ReportRun) -> dict[str, DataFrame]:
    """Read every report back: CSV with its schema, Parquet as stored, JSON inferred (selected by name)."""
    return {
        "country_metrics": read_csv(spark, run.country_metrics, COUNTRY_METRICS),
        "category_trends": read_parquet(spark, run.category_trends),
        "top_customers": read_json_lines(spark, run.top_customers).select(
            "customer_id", "total_spent", "purchase_count"
        ),
    }


def _timed(action: Callable[[], object]) -> float:
    started = time.perf_counter()
    action()
    return time.perf_counter() - started


def partition_study(
    sales: DataFrame,
    counts: Sequence[int] = PARTITION_COUNTS,
    trials: int = 3,
    move: str = "partials",
    expected_records: int | None = None,
) -> DataFrame:
    """Time category x region totals at each partition count: (config, trial, seconds, result_rows).

    The untimed warm-up counts the records it reads; other than
    ``expected_records`` (if given) raise before anything is timed.

    Each timed run is one branch of :func:`partition_sweep` (``move`` as
    there: "partials" moves per-partition partial aggregates into ``n``
    partitions, "rows" moves the raw rows and suits study-sized inputs only).
    One untimed run warms up; then every count runs ``trials`` times in an order
    that reverses each trial. Timings are a handful of driver-side
    numbers; they become a DataFrame for the measurement operators.
    """
    if trials <= 0 or any(n <= 0 for n in counts):
        raise ValueError("trials and partition counts must be greater than zero")
    spark = sales.sparkSession
    passing = CountingPass()
    partition_sweep(passing.watch(sales, "records"), (4,), move).write.format("noop").mode("overwrite").save()
    passing.require(records=expected_records)
    order = list(counts)
    rows = []
    for trial in range(1, trials + 1):
        for n in order:
            result = partition_sweep(sales, (n,), move)
            seconds = _timed(lambda r=result: r.write.format("noop").mode("overwrite").save())
            rows.append((str(n), trial, seconds))
        order.reverse()
    schema = "config string, trial int, seconds double"
    result_rows = partition_sweep(sales, counts, move).groupBy(F.col("partition_count").cast("string").alias("config")).count()
    return spark.createDataFrame(rows, schema).join(result_rows.withColumnRenamed("count", "result_rows"), "config", "left")


def reuse_study(
    load: Callable[[], DataFrame],
    out_root: str,
    strategies: Sequence[str] = STRATEGIES,
    trials: int = 3,
    iterations: int = 3,
    expected_records: int | None = None,
) -> DataFrame:
    """Time the repeated workload under each reuse strategy: (config, trial, seconds, materialise_seconds, result_rows).

    An untimed grouped count warms up and counts the records it reads; other
    than ``expected_records`` (if given) raise before anything is timed.
    """
    if trials <= 0 or iterations <= 0:
        raise ValueError("trials and iterations must be greater than zero")
    passing = CountingPass()
    category_counts(passing.watch(load(), "records")).write.format("noop").mode("overwrite").save()
    passing.require(records=expected_records)
    rows = []
    order = list(strategies)
    spark = None
    for trial in range(1, trials + 1):
        for strategy in order:
            df = load()
            spark = df.sparkSession
            run = run_reuse_workload(df, iterations, strategy, f"{out_root}/{strategy}-{trial}")
            rows.append((strategy, trial, run.elapsed_seconds, run.materialise_seconds, run.result_rows))
        order.reverse()
    schema = "config string, trial int, seconds double, materialise_seconds double, result_rows bigint"
    return spark.createDataFrame(rows, schema)


# The expected counts of the word-count validation.
EXPECTED_WORD_COUNTS = [("spark", 2), ("distributed", 2), ("computing", 2)]


def word_count_job(lines: DataFrame, expected: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """Word counts plus the failed expectations (word, expected_count, actual_count)."""
    counts = word_count(lines)
    if expected is None:
        expected = lines.sparkSession.createDataFrame(EXPECTED_WORD_COUNTS, "word string, expected_count bigint")
    return counts, expected_counts_check(counts, expected)


MAX_TRIALS = 1000  # trials shown as columns of a study table


def study_table(
    measurements: DataFrame,
    baseline: str | None = None,
    trials: Sequence[int] | None = None,
) -> DataFrame:
    """One wide row per configuration of a timing study.

    config, trial_<n>_seconds..., median_seconds, minimum_seconds,
    maximum_seconds[, average_materialisation_seconds], result_rows
    [, improvement_percent] -- from a long (config, trial, seconds, ...) table
    such as :func:`partition_study` or :func:`reuse_study` returns, with one
    row per (config, trial). Every trial is shown: ``trials`` defaults to those
    the table holds, and a trial outside a given list raises.

    One aggregation by configuration gives all columns; it is written to the
    shared folder, so the baseline lookup reads that small table and not the
    measurements again.
    """
    rows = saved_table(measurements, "study")
    found = [r[0] for r in rows.select("trial").distinct().orderBy("trial").limit(MAX_TRIALS + 1).collect()]
    shown = list(trials) if trials is not None else found
    if len(found) > MAX_TRIALS or None in found or not set(found) <= set(shown):
        raise ValueError(f"trials {found[:10]} do not fit the columns {shown[:10]}")
    columns = [F.max(F.when(F.col("trial") == t, F.col("seconds"))).alias(f"trial_{t}_seconds") for t in shown]
    # at most MAX_TRIALS values a configuration, so its median fits one buffer
    columns.append(F.round(F.median("seconds"), 6).alias("median_seconds"))
    columns += [F.min("seconds").alias("minimum_seconds"), F.max("seconds").alias("maximum_seconds")]
    if "materialise_seconds" in rows.columns:
        columns.append(F.round(F.avg("materialise_seconds"), 6).alias("average_materialisation_seconds"))
    if "result_rows" in rows.columns:
        columns.append(F.max("result_rows").alias("result_rows"))
    table = rows.groupBy("config").agg(*columns)
    if baseline is not None:
        table = saved_table(table, "study-table")
        base = table.where(F.col("config") == F.lit(baseline)).select("median_seconds").scalar()
        change = F.round((base - F.col("median_seconds")) / base * 100, 2)
        table = table.withColumn("improvement_percent", F.when(F.col("config") == F.lit(baseline), F.lit(0.0)).otherwise(change))
    numeric = F.try_to_number("config", F.lit("999999999"))  # partition counts sort as numbers, names behind them
    return table.orderBy(numeric.asc_nulls_last(), "config")


def _as_checks(df: DataFrame, check: str, checked: str, violations) -> DataFrame:
    return df.select(
        F.lit(check).alias("check"), F.col(checked).cast("bigint").alias("checked_rows"), violations.cast("bigint").alias("violations")
    )


def study_checks(
    study: DataFrame,
    expected_configs: Sequence[str],
    expected_result_rows: int | None = None,
    trials: Sequence[int] | None = None,
) -> DataFrame:
    """check, checked_rows, violations for a study table (see :func:`study_table`).

    Configuration set equals ``expected_configs`` (both directions) with one
    row each, every trial is there and positive, so is the median, and each configuration produced
    ``expected_result_rows`` result rows.
    """
    from quarry.operators.quality import bounds_check

    spark = study.sparkSession
    expected = spark.createDataFrame([(str(c),) for c in expected_configs], "config string")
    configs = study.select(F.col("config").cast("string").alias("config"))
    # both directions: every key compared once, with how often it was expected and found
    both = expected.select("config", F.lit(1).alias("e"), F.lit(0).alias("a")).unionByName(
        configs.select("config", F.lit(0).alias("e"), F.lit(1).alias("a"))
    )
    keys = both.groupBy("config").agg(F.max("e").alias("e"), F.sum("a").alias("a"))
    counted = keys.agg(
        F.count(F.lit(1)).alias("n"), F.count_if((F.col("e") == 1) != (F.col("a") > 0)).alias("wrong"), F.coalesce(F.sum("a"), F.lit(0)).alias("rows")
    )
    key_check = _as_checks(counted, "configurations_match_expected", "n", F.col("wrong"))
    surplus = F.abs(F.col("rows") - F.lit(len(expected_configs)))
    row_check = _as_checks(counted, "row_count_matches_expected", "rows", surplus)
    shown = [c for c in study.columns if c.startswith("trial_") and c.endswith("_seconds")] if trials is None else [f"trial_{t}_seconds" for t in trials]
    rules = {
        # a missing trial is a violation, like one that is not positive
        "trials_positive": reduce(lambda a, b: a & b, [F.coalesce(F.col(c) > 0, F.lit(False)) for c in shown]),
        "median_positive": F.col("median_seconds") > 0,
    }
    if expected_result_rows is not None:
        rules["result_rows_expected"] = F.col("result_rows") == F.lit(expected_result_rows)
    bounds = bounds_check(study, rules).select(F.col("rule").alias("check"), "checked_rows", "violations")
    return key_check.unionByName(row_check).unionByName(bounds)


def verify_partition_study(
    input_lines: DataFrame,
    dataset: DataFrame,
    study: DataFrame,
    expected_records: int | DataFrame,
    expected_configs: Sequence[int | str] = PARTITION_COUNTS,
) -> DataFrame:
    """Input lines are valid JSON, the dataset has the expected record count, the study is complete."""
    from quarry.operators.quality import json_line_validity

    validity = _as_checks(json_line_validity(input_lines, "value"), "input_lines_valid_json", "total_lines", F.col("invalid_lines"))
    gate = _as_checks(
        count_gate(dataset, expected_records), "record_count", "actual_rows", F.when(F.col("passed"), 0).otherwise(1)
    )
    return validity.unionByName(gate).unionByName(study_checks(study, [str(c) for c in expected_configs]))


def verify_reuse_study(study: DataFrame, iterations: int, groups_per_iteration: int, strategies: Sequence[str] = STRATEGIES):
    """Checks of a reuse study plus the ranking of its strategies by median (fastest first)."""
    from quarry.operators.measure import trial_ranking

    checks = study_checks(study, strategies, iterations * groups_per_iteration)
    return checks, trial_ranking(study)
