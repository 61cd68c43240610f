"""Statistics over a long measurement table (config, trial, seconds).

Everything is a DataFrame aggregation, so a table of millions of timings is
summarised on the cluster. The exact median holds a configuration's timings
in one aggregation buffer only after a check proves the configuration small;
otherwise it never collects them into one task (:func:`quarry.plans.exact_median`).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.plans.joins import join_null_safe
from quarry.plans.ranking import DEFAULT_GROUP_ROWS, exact_median, global_row_number, largest_group
from quarry.plans.storage import saved_table

TRIALS = (1, 2, 3)
# Timings are reported with six decimals.
SECONDS_PLACES = 6


def trial_totals(
    df: DataFrame,
    config: str = "config",
    trial: str = "trial",
    seconds: str = "seconds",
) -> DataFrame:
    """One value per (config, trial): the rounded sum of its timings."""
    return df.groupBy(config, trial).agg(F.round(F.sum(seconds), 2).alias(seconds))


def trial_summary(
    df: DataFrame,
    config: str = "config",
    seconds: str = "seconds",
    materialise: str | None = None,
    max_group_rows: int | None = DEFAULT_GROUP_ROWS,
) -> DataFrame:
    """config, median_seconds, minimum_seconds, maximum_seconds, average_seconds, measurement_count
    (+ average_materialisation_seconds when ``materialise`` is given).

    Nothing is written and the result is lazy; one job before it finds the
    largest configuration's size (no value column is read for it). Where that
    is at most ``max_group_rows``, one aggregation gives every statistic;
    beyond, the median is selected by narrowing (:func:`quarry.plans.exact_median`;
    the same rows, null and all-null configurations included).
    """
    aggs = [
        F.min(seconds).alias("minimum_seconds"),
        F.max(seconds).alias("maximum_seconds"),
        F.round(F.avg(seconds), SECONDS_PLACES).alias("average_seconds"),
        F.count(seconds).alias("measurement_count"),
    ]
    if materialise is not None:
        aggs.append(F.round(F.avg(materialise), SECONDS_PLACES).alias("average_materialisation_seconds"))
    largest = largest_group(df, [config])
    if max_group_rows is not None and largest <= max_group_rows:
        stats = df.groupBy(config).agg(F.median(seconds).alias("median_seconds"), *aggs)
    else:
        medians = exact_median(df.select(config, seconds), [config], seconds, "median_seconds", max_group_rows, largest)
        stats = join_null_safe(df.groupBy(config).agg(*aggs), medians, [config], "left")
    others = [c for c in stats.columns if c not in (config, "median_seconds", "minimum_seconds", "maximum_seconds")]
    median = F.round("median_seconds", SECONDS_PLACES).alias("median_seconds")
    return stats.select(config, median, "minimum_seconds", "maximum_seconds", *others)


def trial_improvement(summary: DataFrame, baseline: str, config: str = "config") -> DataFrame:
    """config, median_seconds, improvement_percent = (base - median) / base * 100 (2 dp); 0 for the baseline.

    The baseline median is a scalar subquery over the whole summary, so that it
    reuses the summary's own aggregation; a missing baseline gives null
    improvements.
    """
    own = F.col(config) == F.lit(baseline)
    base = summary.select(config, "median_seconds").agg(F.max(F.when(own, F.col("median_seconds")))).scalar()
    improvement = F.round((base - F.col("median_seconds")) / base * 100, 2)
    return summary.select(
        config,
        "median_seconds",
        F.when(F.col(config) == F.lit(baseline), F.lit(0.0)).otherwise(improvement).alias("improvement_percent"),
    )


def trial_pivot(
    totals: DataFrame,
    config: str = "config",
    trial: str = "trial",
    seconds: str = "seconds",
    trials: Sequence[int] = TRIALS,
) -> DataFrame:
    """Long (one row per config x trial) to wide: config, trial_1_seconds, trial_2_seconds, ...

    The trial values are listed, so the pivot is a single aggregation with no
    extra job to discover them. A trial outside the list (or a null one) fails
    the query that uses the result: no measurement is left out unsaid.
    """
    shown = ", ".join(map(str, trials))
    listed = F.coalesce(F.col(trial).isin(list(trials)), F.lit(False))
    refused = F.raise_error(F.concat(F.lit("trial "), F.coalesce(F.col(trial).cast("string"), F.lit("null")), F.lit(f" is not one of {shown}")))
    checked = totals.withColumn(seconds, F.when(listed, F.col(seconds)).otherwise(refused))
    columns = [F.max(F.when(F.col(trial) == t, F.col(seconds))).alias(f"trial_{t}_seconds") for t in trials]
    strays = F.max(F.when(~listed, F.col(seconds))).alias("__strays")  # evaluates to the error
    return checked.groupBy(config).agg(*columns, strays).where(F.col("__strays").isNull()).drop("__strays")


def trial_best(summary: DataFrame, config: str = "config") -> DataFrame:
    """The configuration with the lowest median (the first in config order on ties)."""
    return summary.orderBy(F.asc("median_seconds"), F.asc(config)).limit(1)


def trial_ranking(summary: DataFrame, config: str = "config") -> DataFrame:
    """rank (1 = fastest median, ties by config), config, median_seconds.

    The summary's rows, one a configuration, are written once: their number is
    checked before they are ranked.
    """
    rows = saved_table(summary.select(config, "median_seconds"), "medians")
    ranked = global_row_number(rows, ["median_seconds", config], "rank")
    return ranked.select(F.col("rank").cast("int").alias("rank"), config, "median_seconds")
