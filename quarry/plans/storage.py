"""Shared-folder locations for written tables and lineage cuts.

On a cluster every intermediate table must live in storage that all
executors and the driver see (HDFS, S3, ...). The cluster names that folder in
``spark.checkpoint.dir``; we read it from the session and raise where it is
unset. Entry points of single-process runs (tests, the bench, the driver's
queries) name a folder themselves through :func:`use_local_folder`.
"""

from __future__ import annotations

import tempfile
import threading
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """Root folder shared by the cluster: ``spark.checkpoint.dir`` or the context's dir."""
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    current = spark.sparkContext.getCheckpointDir()
    if current:
        return current.rstrip("/")
    raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach (HDFS, S3, ...)")


def use_local_folder(spark: SparkSession) -> None:
    """For entry points only: a folder of this machine where none is set and the master runs in one process."""
    master = spark.sparkContext.master
    unset = not spark.conf.get("spark.checkpoint.dir", None) and not spark.sparkContext.getCheckpointDir()
    if unset and (master == "local" or master.startswith("local[")):
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="quarry-shared-"))


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Make ``DataFrame.checkpoint()`` usable: point it at the shared folder if unset."""
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(shared_dir(spark))


def saved_table(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to a new folder below the shared root and read it back with the same schema."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new, unique folder below the shared root for one written table; the innermost open :class:`Scratch` owns it."""
    path = f"{shared_dir(spark)}/quarry/{name}-{uuid.uuid4().hex}"
    if _scopes():
        _scopes()[-1].paths.append(path)
    return path


_threads = threading.local()  # queries that run side by side own their tables apart


def _scopes() -> list[Scratch]:
    """The open scopes of this thread, the innermost last."""
    if not hasattr(_threads, "scopes"):
        _threads.scopes = []
    return _threads.scopes


class Scratch:
    """Owner of the tables written while it is open; on leaving, those that no kept frame reads are deleted.

    ``with Scratch(spark) as scope: ...; scope.keep(result)``. Scopes nest: what
    an inner one keeps belongs to the outer one from then on. If the block
    raises, everything it wrote is deleted.
    """

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.paths: list[str] = []
        self._kept: list[DataFrame] = []

    def __enter__(self) -> Scratch:
        _scopes().append(self)
        return self

    def keep(self, df: DataFrame) -> DataFrame:
        """Keep what ``df`` reads, its subqueries included, beyond the scope."""
        self._kept.append(df)
        return df

    def __exit__(self, kind, *_) -> None:
        _scopes().remove(self)
        kept: set[str] = set()
        if kind is None:
            for df in self._kept:
                kept |= folders_read(df)
        for path in self.paths:
            own = _plain(self.spark, path)
            if not any(read == own or read.startswith(f"{own}/") for read in kept):
                _delete(self.spark, path)
            elif _scopes():
                _scopes()[-1].paths.append(path)


def _path(spark: SparkSession, path: str):
    return spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)


def _plain(spark: SparkSession, path: str) -> str:
    """The path without scheme and host, by which folders are compared."""
    return _path(spark, path).toUri().getPath().rstrip("/")


def _delete(spark: SparkSession, path: str) -> None:
    where = _path(spark, path)
    where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)


def folders_read(df: DataFrame) -> set[str]:
    """Folders and files that ``df``'s plan reads, subqueries and cached frames included (paths without scheme)."""
    found: set[str] = set()
    todo = [df._jdf.queryExecution().analyzed()]
    while todo:
        plan = todo.pop()
        subqueries = plan.subqueriesAll()
        todo += [subqueries.apply(i) for i in range(subqueries.size())]
        leaves = plan.collectLeaves()
        for i in range(leaves.size()):
            leaf = leaves.apply(i)
            kind = leaf.getClass().getSimpleName()
            if kind == "LogicalRelation" and leaf.relation().getClass().getSimpleName() == "HadoopFsRelation":
                roots = leaf.relation().location().rootPaths()
                found |= {roots.apply(j).toUri().getPath().rstrip("/") for j in range(roots.size())}
            elif kind == "InMemoryRelation":
                todo.append(leaf.cacheBuilder().logicalPlan())
    return found


def saved_buckets(df: DataFrame, name: str, key: str, buckets: int) -> DataFrame:
    """Write ``df`` hash-bucketed and sorted by ``key`` below the shared root and read it back.

    Joins and aggregations by ``key`` then read the table where it lies; only
    their other side is shuffled, into ``buckets`` partitions. The catalog entry
    that carries the bucketing is removed again at once, the files stay.
    """
    spark = df.sparkSession
    entry = f"quarry_{name}_{uuid.uuid4().hex}".replace("-", "_")
    writer = df.write.bucketBy(buckets, key).sortBy(key).format("parquet")
    writer.option("path", scratch_path(spark, name)).saveAsTable(entry)
    table = spark.table(entry)
    spark.sql(f"DROP TABLE {entry}")
    return table


def release(*frames: DataFrame) -> None:
    """Delete the written tables that ``frames`` read, if they lie below the shared scratch root (any file system)."""
    for df in frames:
        root = _plain(df.sparkSession, shared_dir(df.sparkSession)) + "/quarry/"
        scheme = _path(df.sparkSession, shared_dir(df.sparkSession))
        for folder in folders_read(df):
            if folder.startswith(root):
                # the shared root's file system, whatever the frame's path is called there
                below = f"{scheme.toString().rstrip('/')}/quarry/{folder[len(root):]}"
                _delete(df.sparkSession, below)
