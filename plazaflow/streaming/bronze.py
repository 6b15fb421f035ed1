"""Landing of drops as a stream that stops when it has caught up."""

from __future__ import annotations

from pyspark.sql import SparkSession, functions as F, types as T
from pyspark.sql.streaming import StreamingQuery

from plazaflow.sources.drops import CSV_OPTIONS, landed_text
from plazaflow.sources.registry import with_drop_month


def text_schema(columns: list[str]) -> T.StructType:
    return T.StructType([T.StructField(c, T.StringType()) for c in columns])


def stream_bronze(
    spark: SparkSession, path: str, schema: T.StructType, target: str, checkpoint: str, max_files: int = 1000,
    multi_line: bool = False,
) -> StreamingQuery:
    """New files only, each exactly once. A file whose content changed under its old name is
    not seen by a file stream; the registry load handles those. A header that does not fit
    the schema is an error rather than silently misplaced columns."""
    drops = (
        spark.readStream.schema(schema).options(**CSV_OPTIONS).option("enforceSchema", False)
        .option("multiLine", multi_line).option("maxFilesPerTrigger", max_files).csv(path)
    )
    landed = with_drop_month(landed_text(drops)).withColumn("_loaded_at", F.current_timestamp())
    return (
        landed.writeStream.format("parquet").outputMode("append").partitionBy("_drop_month")
        .option("checkpointLocation", checkpoint).option("path", target).trigger(availableNow=True).start()
    )
