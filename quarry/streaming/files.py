"""Structured Streaming over folders that receive CSV or JSON-lines files.

The batch operators are plain DataFrame transformations, so they apply to a
streaming DataFrame unchanged (pass ``sort=False``: a stream can only be
sorted after a complete-mode aggregation). State and progress live in the
checkpoint folder that the caller names; a query restarted with the same folder
resumes where it stopped. Without one, each start takes a new folder under the
cluster's shared ``spark.checkpoint.dir`` and begins anew.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from quarry.plans.storage import scratch_path


def stream_csv(spark: SparkSession, folder: str, schema: StructType, max_files_per_trigger: int | None = None) -> DataFrame:
    """New CSV files (with header) in ``folder`` as a stream; streaming file sources always need a schema."""
    reader = spark.readStream.schema(schema).option("header", True)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.csv(folder)


def stream_json_lines(
    spark: SparkSession, folder: str, schema: StructType, max_files_per_trigger: int | None = None
) -> DataFrame:
    """New JSON-lines files in ``folder`` as a stream (PERMISSIVE: malformed lines become null rows)."""
    reader = spark.readStream.schema(schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.json(folder)


def write_snapshots(
    aggregated: DataFrame,
    out_path: str,
    checkpoint: str | None = None,
    available_now: bool = True,
) -> StreamingQuery:
    """Keep ``out_path`` holding the latest full result of a streaming aggregation.

    Each micro-batch emits the complete aggregate (complete output mode) and
    ``foreachBatch`` overwrites the Parquet table with it. With
    ``available_now`` the query processes what has arrived and stops.
    """
    spark = aggregated.sparkSession
    location = checkpoint or scratch_path(spark, "stream-checkpoint")

    def overwrite(batch: DataFrame, _batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(out_path)

    writer = aggregated.writeStream.outputMode("complete").option("checkpointLocation", location).foreachBatch(overwrite)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")
    return writer.start()
