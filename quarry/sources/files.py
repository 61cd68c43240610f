"""File sources (CSV, JSON lines, Parquet, text) and sinks.

Sources take an explicit schema by default: inference costs a full extra
pass over the input before the query even starts.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from quarry.plans.joins import join_bounded
from quarry.sources.schemas import TEXT_LINES


def read_csv(
    spark: SparkSession,
    path: str,
    schema: StructType | None = None,
    header: bool = True,
    infer_schema: bool = False,
) -> DataFrame:
    """CSV with header. With no schema and no inference every column is a string."""
    reader = spark.read.option("header", header)
    if schema is not None:
        reader = reader.schema(schema)
    elif infer_schema:
        reader = reader.option("inferSchema", True)
    return reader.csv(path)


def read_json_lines(spark: SparkSession, path: str, schema: StructType | None = None) -> DataFrame:
    """Newline-delimited JSON (PERMISSIVE: malformed lines become all-null rows).

    Without a schema Spark infers one (an extra pass) and returns columns in
    alphabetical order, so callers should select by name.
    """
    reader = spark.read
    if schema is not None:
        reader = reader.schema(schema)
    return reader.json(path)


def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def read_text_lines(spark: SparkSession, path: str) -> DataFrame:
    """One row per physical line (blank lines kept) in column ``value``."""
    return spark.read.text(path)


def lines_frame(spark: SparkSession, lines: Iterable[str], partitions: int = 2) -> DataFrame:
    """Small in-memory text (``text`` column) spread over ``partitions`` partitions."""
    return spark.createDataFrame([(line,) for line in lines], TEXT_LINES).repartition(partitions)


def dealt_lines(lines: DataFrame, partitions: int) -> DataFrame:
    """A table's lines dealt round over ``partitions`` partitions, as :func:`lines_frame` deals lines in memory."""
    if partitions <= 0:
        raise ValueError("partition count must be greater than zero")
    return lines.repartition(partitions)


def _single(df: DataFrame, single_file: bool) -> DataFrame:
    # coalesce(1) keeps the order of a sorted result but runs the last stage
    # in one task: only for small, already-aggregated outputs.
    return df.coalesce(1) if single_file else df


def write_csv(df: DataFrame, path: str, single_file: bool = False, mode: str = "overwrite") -> str:
    _single(df, single_file).write.mode(mode).option("header", True).csv(path)
    return path


def write_parquet(df: DataFrame, path: str, mode: str = "overwrite") -> str:
    df.write.mode(mode).parquet(path)
    return path


def write_json(df: DataFrame, path: str, single_file: bool = False, mode: str = "overwrite") -> str:
    """JSON lines; null fields are omitted from each object."""
    _single(df, single_file).write.mode(mode).json(path)
    return path


MANIFEST = StructType([StructField("position", LongType()), StructField("file", StringType()), StructField("rows", LongType())])


def write_ordered(df: DataFrame, path: str, file_format: str = "csv", mode: str = "overwrite") -> str:
    """Write a sorted result as many files that keep its order, and a manifest of them beside it.

    A sort leaves range partitions and Spark numbers their files in that order,
    so nothing is funnelled through one task. The manifest (``path`` + ".manifest",
    JSON lines: position, file, rows) names every file that holds rows.
    """
    writer = df.write.mode(mode).format(file_format)
    (writer.option("header", True) if file_format == "csv" else writer).save(path)
    written = _ordered_scan(df.sparkSession, path, df.schema, file_format)
    counts = written.groupBy(F.col("_metadata.file_name").alias("file")).agg(F.count(F.lit(1)).alias("rows"))
    number = F.regexp_extract("file", r"^part-(\d+)", 1).cast("long")  # of the range partition
    counts.select(number.alias("position"), "file", "rows").write.mode(mode).json(f"{path}.manifest")
    return path


def _ordered_scan(spark: SparkSession, path: str, schema: StructType, file_format: str) -> DataFrame:
    reader = spark.read.schema(schema).format(file_format)
    return (reader.option("header", True) if file_format == "csv" else reader).load(path)


def read_ordered(spark: SparkSession, path: str, schema: StructType, file_format: str = "csv") -> DataFrame:
    """The rows of :func:`write_ordered` in the order they were written in.

    Rows are sorted by their file's position, the split of the file they lie in
    and their place in it. A file that the manifest does not name, or that holds
    another number of rows than it says, fails the query.
    """
    files = spark.read.schema(MANIFEST).json(f"{path}.manifest")
    scan = _ordered_scan(spark, path, schema, file_format)
    at = F.monotonically_increasing_id()  # grows along a split, whatever other splits its task reads
    rows = scan.select("*", F.col("_metadata.file_name").alias("__file"), F.col("_metadata.file_block_start").alias("__split"), at.alias("__at"))
    found = rows.groupBy("__file").agg(F.count(F.lit(1)).alias("__found"))
    checked = files.join(found, F.col("file") == F.col("__file"), "full_outer")
    fault = F.concat(F.lit("the manifest and the files differ: "), F.coalesce("file", "__file"))
    position = F.when(F.col("rows").eqNullSafe(F.col("__found")), F.col("position")).otherwise(F.raise_error(fault)).alias("__position")
    known = checked.select(F.coalesce("__file", "file").alias("__name"), position)
    placed = join_bounded(rows, known, F.col("__file") == F.col("__name"))
    return placed.orderBy("__position", "__split", "__at").select(*[f.name for f in schema.fields])


def write_text(df: DataFrame, column: str, path: str, mode: str = "overwrite") -> str:
    df.select(column).write.mode(mode).text(path)
    return path
