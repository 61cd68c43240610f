"""Keep CPU-heavy per-row work spread over the cluster's cores."""

from __future__ import annotations

from pyspark.sql import DataFrame


def spread(df: DataFrame, min_partitions: int | None = None) -> DataFrame:
    """Round-robin ``df`` into ``min_partitions`` partitions only if its scan yields fewer.

    A scan yields fewer partitions than the cluster has cores only when the
    input is smaller than cores x split size (or stored as a few huge row
    groups), so this extra shuffle is small whenever it happens; on a large
    input it is a no-op and no shuffle is added.

    Apply it to a scan-like frame: finding the partition count of a frame
    whose adaptive plan holds shuffles runs those shuffles first.
    """
    target = min_partitions or df.sparkSession.sparkContext.defaultParallelism
    if df.rdd.getNumPartitions() < target:
        return df.repartition(target)
    return df
