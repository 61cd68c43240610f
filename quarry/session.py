"""Session construction for tests, the bench and command-line jobs.

Operators never create, stop or reconfigure a session; only entry points
(tests, ``bench.py``, scripts) call :func:`build_session`.
"""

from __future__ import annotations

import os

from pyspark.sql import SparkSession
from pyspark.sql import functions as F


def scale_conf(input_bytes: int, cores: int) -> dict[str, str]:
    """Shuffle and scan sizing for a job reading ``input_bytes`` on ``cores`` task slots.

    Targets ~128 MiB per scan split and ~200 MiB of shuffle input per reduce
    task (before AQE coalescing), never fewer than two waves of tasks. At
    100 TB this gives ~500k shuffle partitions; AQE then merges small ones and
    splits skewed ones.
    """
    per_task = 200 * 1024 * 1024
    parts = max(2 * cores, input_bytes // per_task + 1)
    return {
        "spark.sql.shuffle.partitions": str(parts),
        "spark.sql.files.maxPartitionBytes": str(128 * 1024 * 1024),
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(128 * 1024 * 1024),
    }


def input_bytes(spark: SparkSession, path: str) -> int:
    """Total size of the files under ``path`` on any Hadoop file system.

    A distributed file listing: the ``binaryFile`` source with only its
    ``length`` column selected never reads file contents.
    """
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    return int(files.agg(F.coalesce(F.sum("length"), F.lit(0))).first()[0])


def size_for_input(spark: SparkSession, path: str) -> dict[str, str]:
    """Apply :func:`scale_conf` for the input at ``path`` (runtime SQL settings; returns them)."""
    conf = scale_conf(input_bytes(spark, path), spark.sparkContext.defaultParallelism)
    for key, value in conf.items():
        spark.conf.set(key, value)
    return conf


def build_session(
    master: str | None = None,
    app_name: str = "quarry",
    shuffle_partitions: int | None = None,
    extra: dict[str, str] | None = None,
) -> SparkSession:
    """Local or cluster session with AQE on and the UI off.

    ``master`` defaults to ``local[$BENCH_CPUS]`` (or ``local[*]``) when no
    master is configured by ``spark-submit``.
    """
    cpus = os.environ.get("BENCH_CPUS")
    builder = SparkSession.builder.appName(app_name)
    if master is None and "spark.master" not in os.environ.get("PYSPARK_SUBMIT_ARGS", ""):
        master = f"local[{cpus}]" if cpus else "local[*]"
    if master:
        builder = builder.master(master)
    cores = int(cpus) if cpus else (os.cpu_count() or 8)
    conf = {
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.shuffle.partitions": str(shuffle_partitions or cores),
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.driver.memory": os.environ.get("QUARRY_DRIVER_MEMORY", "8g"),
    }
    conf.update(extra or {})
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark
