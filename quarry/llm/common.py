"""Small helpers shared by the operators: table access, row keys, UTF-8 words, shared-folder tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.plans.storage import saved_table

# ASCII white space and the A-Z lower-casing of the contracts, as byte tables.
LOWER_AZ = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
WORD_PATTERN = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given tables."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def byte_words(text: str | None, lower: bool = False) -> list[bytes]:
    """UTF-8 words ``[^\\x20\\x09-\\x0D]+``; ``bytes.split`` splits on exactly those six bytes."""
    if not text:
        return []
    raw = text.encode("utf-8", "surrogatepass")
    return (raw.translate(LOWER_AZ) if lower else raw).split()


def lower_az(col: Column) -> Column:
    """Lower-case A-Z only."""
    return F.translate(col, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def held_out(id_col: Column, folds: int, fold: int) -> Column:
    """crc32 of the id as text, modulo ``folds``, equals ``fold`` (a null id is never held out)."""
    return F.coalesce(F.crc32(id_col.cast("string").cast("binary")) % F.lit(folds) == F.lit(fold), F.lit(False))


def saved(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to a new folder below the cluster's shared folder and read it back.

    Cuts lineage: a lost executor then re-reads files and recomputes nothing
    upstream. The schema is the written one, so nothing is inferred.
    """
    return saved_table(df, name)


def spread_small(df: DataFrame) -> DataFrame:
    """Round-robin a frame whose scan has fewer partitions than there are cores.

    For heavy per-row work over few files; a large input is left as it is.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


def numbered(docs: DataFrame, id_col: str, text_col: str, *others: str) -> DataFrame:
    """``row``, ``id``, ``text`` and ``others``: ``row`` is the id where ids prove unique, integral and not null, else a written row number."""
    typed = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), *others)
    if typed.schema["id"].dataType.simpleString() in ("bigint", "int", "smallint", "tinyint"):
        repeated = typed.groupBy("id").agg(F.count("*").alias("n")).where((F.col("n") > 1) | F.col("id").isNull())
        if repeated.isEmpty():
            return typed.select(F.col("id").cast("long").alias("row"), "id", "text", *others)
    return saved(typed.select(F.monotonically_increasing_id().alias("row"), "id", "text", *others), "numbered")
