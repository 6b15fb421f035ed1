"""Small driver-side tables (configuration) as DataFrames."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

ARROW_TYPES = {
    "string": pa.string(),
    "int": pa.int32(),
    "bigint": pa.int64(),
    "double": pa.float64(),
    "date": pa.date32(),
    "boolean": pa.bool_(),
}


def literal_frame(spark: SparkSession, rows: list[tuple], schema: dict[str, str]) -> DataFrame:
    """Rows that are already on the driver as a local relation.

    Going through Arrow gives Catalyst the exact size, so it can decide on a
    broadcast by itself.
    """
    columns = {
        name: pa.array([row[i] for row in rows], type=ARROW_TYPES[kind])
        for i, (name, kind) in enumerate(schema.items())
    }
    return spark.createDataFrame(pa.table(columns))
