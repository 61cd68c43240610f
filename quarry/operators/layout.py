"""Data layout and reuse: repartitioning, partition profiles, sweeps and reuse strategies.

None of these change results, only cost; the invariant tested is "same rows
under every setting".
"""

from __future__ import annotations

import time
from collections.abc import Sequence
from dataclasses import dataclass
from math import ceil

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.functions.money import PARTS, average_of, merged_parts, money_parts, total_of
from quarry.operators.sales import category_region_sales

PARTITION_COUNTS = (2, 4, 8, 16, 32)
PIECES = 4  # of a mean partition, that a hot key is dealt in

# Reuse strategies for a frame read several times. "cache" is Spark's default
# level (memory and disk, deserialized); "memory_and_disk" is the explicit
# serialized level; "none" re-reads the source each time.
STRATEGIES = ("none", "cache", "memory_and_disk")


def hot_keys(df: DataFrame, columns: Sequence[str], partitions: int) -> DataFrame:
    """``__key`` (hash of ``columns``) and ``__pieces`` of the keys with more than half a mean partition of rows.

    One pass with a frequent-items sketch, aggregated partially in every task;
    its error is below a quarter of a mean partition, and only the few keys
    found (fewer than twice the partitions) reach the driver.
    """
    tracked = min(1_000_000, max(1024, 1 << (16 * partitions).bit_length()))
    hashed = df.select(F.xxhash64(*columns).alias("__key"))
    sketch = F.expr(f"approx_top_k(__key, {min(2 * partitions, tracked, 100_000)}, {tracked})")
    found = hashed.agg(sketch.alias("top"), F.count(F.lit(1)).alias("rows")).first()
    mean = found["rows"] / partitions
    hot = [(r["item"], ceil(r["count"] / mean * PIECES)) for r in found["top"] or [] if r["count"] > mean / 2]
    return df.sparkSession.createDataFrame(hot, "__key long, __pieces long")


def repartition_by(
    df: DataFrame,
    *columns: str,
    partitions: int | None = None,
    rebalance: bool = False,
    split_hot: bool = True,
) -> DataFrame:
    """Hash-partition on ``columns`` (a full shuffle) into ``partitions`` (default: the session's shuffle partitions).

    A key with more rows than half a mean partition is dealt over several
    partitions in pieces of a quarter of the mean (:func:`hot_keys`, one more
    pass over ``columns``), so that no task holds much more than its share; all
    other keys stay whole. ``split_hot=False`` is plain hash partitioning, which
    keeps every key in one task whatever its size. With ``rebalance=True`` the
    REBALANCE hint is used instead: AQE splits oversized partitions and merges
    tiny ones by their bytes.
    """
    if rebalance:
        return df.hint("rebalance", *columns)
    if not split_hot:
        return df.repartition(*([partitions] if partitions is not None else []), *columns)
    n = partitions if partitions is not None else int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    keyed = df.withColumn("__key", F.xxhash64(*columns)).join(F.broadcast(hot_keys(df, columns, n)), "__key", "left")
    piece = F.coalesce(F.pmod(F.monotonically_increasing_id(), F.least("__pieces", F.lit(n))), F.lit(0))
    place = F.pmod(F.pmod("__key", F.lit(n)) + piece, F.lit(n)).cast("int")  # a hot key's pieces lie side by side
    return keyed.withColumn("__place", place).repartitionById(n, "__place").select(*df.columns)


def repartition_evenly(df: DataFrame, partitions: int) -> DataFrame:
    """Round-robin into exactly ``partitions`` partitions (AQE does not override an explicit count)."""
    if partitions <= 0:
        raise ValueError("partition count must be greater than zero")
    return df.repartition(partitions)


def partition_count(df: DataFrame) -> int:
    """Number of partitions the frame's plan produces."""
    return df.rdd.getNumPartitions()


def partition_profile(df: DataFrame) -> DataFrame:
    """partition_id, rows: the row count of every non-empty partition."""
    return (
        df.select(F.spark_partition_id().alias("partition_id"))
        .groupBy("partition_id")
        .agg(F.count(F.lit(1)).alias("rows"))
    )


def partition_sweep(
    df: DataFrame,
    counts: Sequence[int] = PARTITION_COUNTS,
    move: str = "partials",
) -> DataFrame:
    """Category x region totals computed with ``n`` partitions for each count, tagged ``partition_count``.

    ``move="partials"`` (default): every input partition first pre-aggregates
    its rows to one row per (category, region); only these partial rows
    (#input partitions x #groups, however large the table) are round-robin
    repartitioned into ``n`` partitions and merged. The scan and the partial
    aggregation are the same subplan in every branch, so Spark runs them once
    and reuses the exchange for all counts.

    ``move="rows"``: the raw rows are round-robin repartitioned into ``n``
    partitions before aggregating, the layout a partition-count timing study
    measures. It pushes the whole table through ``n`` tasks, so keep it to
    study-sized inputs.
    """
    if not counts:
        raise ValueError("at least one partition count is required")
    if move == "rows":
        branches = [
            category_region_sales(repartition_evenly(df, n), sort=False).withColumn("partition_count", F.lit(n))
            for n in counts
        ]
    elif move == "partials":
        partials = df.groupBy(F.spark_partition_id().alias("__source"), "category", "region").agg(
            *[part.alias(f"__{name}") for name, part in money_parts("amount").items()],
            F.sum("quantity").alias("__quantity"),
            F.count(F.lit(1)).alias("__count"),
        )
        merged = total_of(merged_parts({name: F.col(f"__{name}") for name in PARTS}))
        branches = [
            repartition_evenly(partials, n)
            .groupBy("category", "region")
            .agg(
                merged.alias("total_sales"),
                F.sum("__quantity").alias("total_quantity"),
                F.sum("__count").alias("transaction_count"),
            )
            .withColumn("partition_count", F.lit(n))
            for n in counts
        ]
    else:
        raise ValueError(f"unknown move {move!r}; expected 'partials' or 'rows'")
    swept = branches[0]
    for branch in branches[1:]:
        swept = swept.unionByName(branch)
    return swept


def persist_with(df: DataFrame, strategy: str) -> DataFrame:
    """``df`` under a reuse strategy, keeping its partitioning (one cached block per partition)."""
    if strategy == "none":
        return df
    if strategy == "cache":
        return df.cache()
    if strategy == "memory_and_disk":
        return df.persist(StorageLevel.MEMORY_AND_DISK)
    raise ValueError(f"unknown reuse strategy {strategy!r}; expected one of {STRATEGIES}")


def workload_results(df: DataFrame, iteration: int) -> DataFrame:
    """Category and region metrics of one iteration as one long table.

    One pass: the rows add up by category and region, and both sets of metrics
    come from those few sums (exact, so they equal the sums over the rows).
    """
    sums = df.groupBy("category", "region").agg(
        *[part.alias(f"__{name}") for name, part in money_parts("amount").items()],
        F.sum("quantity").alias("__quantity"),
        F.count(F.lit(1)).alias("__count"),
    )
    parts = merged_parts({name: F.col(f"__{name}") for name in PARTS})
    categories = sums.groupBy("category").agg(
        average_of(parts).alias("average_amount"), total_of(parts).alias("total_amount"), F.sum("__count").alias("transaction_count")
    )
    regions = sums.groupBy("region").agg(
        F.sum("__quantity").alias("total_quantity"), average_of(parts).alias("average_amount"), F.sum("__count").alias("transaction_count")
    )
    categories = categories.select(
        F.lit(iteration).alias("iteration"),
        F.lit("category").alias("metric_set"),
        F.col("category").alias("key"),
        "average_amount",
        "total_amount",
        F.lit(None).cast("bigint").alias("total_quantity"),
        "transaction_count",
    )
    regions = regions.select(
        F.lit(iteration).alias("iteration"),
        F.lit("region").alias("metric_set"),
        F.col("region").alias("key"),
        "average_amount",
        F.lit(None).cast("double").alias("total_amount"),
        "total_quantity",
        "transaction_count",
    )
    return categories.unionByName(regions)


@dataclass(frozen=True)
class ReuseRun:
    strategy: str
    iterations: int
    result_rows: int
    materialise_seconds: float
    elapsed_seconds: float
    result_path: str


def run_reuse_workload(df: DataFrame, iterations: int, strategy: str, result_path: str) -> ReuseRun:
    """Run the category/region workload ``iterations`` times under one reuse strategy.

    Each iteration is its own action (results appended to ``result_path`` in
    the shared folder), so a persisted frame is read ``iterations`` times,
    while "none" re-reads the source every time. The persisted frame is
    released before returning; results stay available at ``result_path``.
    """
    if iterations <= 0:
        raise ValueError("iterations must be greater than zero")
    started = time.perf_counter()
    data = persist_with(df.select("category", "region", "amount", "quantity"), strategy)  # what the workload reads
    materialise = 0.0
    try:
        if strategy != "none":
            t0 = time.perf_counter()
            data.count()
            materialise = time.perf_counter() - t0
        for iteration in range(1, iterations + 1):
            workload_results(data, iteration).write.mode("append").parquet(result_path)
    finally:
        if strategy != "none":
            data.unpersist(blocking=True)
    elapsed = time.perf_counter() - started
    result_rows = df.sparkSession.read.parquet(result_path).count()
    return ReuseRun(strategy, iterations, result_rows, materialise, elapsed, result_path)
