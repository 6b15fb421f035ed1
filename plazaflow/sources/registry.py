"""Which files to load, and what the registry says about the loaded ones."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

REGISTRY_SCHEMA = (
    "source_name string, file_name string, file_path string, load_date date, row_count bigint, "
    "checksum string, status string, processed_at timestamp"
)


def files_to_load(files: DataFrame, registry: DataFrame) -> DataFrame:
    """files: source_name, file_name, checksum, ... New, changed or unfinished files, with
    `is_changed` for those registered before."""
    seen = registry.select(
        "source_name", "file_name", F.col("checksum").alias("_checksum"), F.col("status").alias("_status"),
        F.lit(True).alias("_known"),
    )
    joined = files.join(seen, ["source_name", "file_name"], "left")
    settled = F.coalesce((F.col("_checksum") == F.col("checksum")) & (F.col("_status") == "processed"), F.lit(False))
    todo = joined.filter(~settled).withColumn("is_changed", F.coalesce("_known", F.lit(False)))
    return todo.drop("_checksum", "_status", "_known")


def file_row_counts(df: DataFrame) -> DataFrame:
    return df.groupBy("_source_file").agg(F.count(F.lit(1)).alias("row_count"))


def loaded_entries(files: DataFrame, counts: DataFrame) -> DataFrame:
    """Registry rows of loaded files; an empty file counts zero rows."""
    named = counts.withColumnRenamed("_source_file", "file_name")
    return files.join(named, "file_name", "left").select(
        "source_name", "file_name", F.col("path").alias("file_path"), F.current_date().alias("load_date"),
        F.coalesce("row_count", F.lit(0)).cast("bigint").alias("row_count"), "checksum",
        F.lit("processed").alias("status"), F.current_timestamp().alias("processed_at"),
    )


def upsert_registry(registry: DataFrame, loaded: DataFrame) -> DataFrame:
    """Loaded entries replace theirs by (source, file); the first load date stays."""
    first = registry.select("source_name", "file_name", F.col("load_date").alias("_first_load"))
    fresh = loaded.join(first, ["source_name", "file_name"], "left").withColumn(
        "load_date", F.coalesce("_first_load", "load_date")
    ).drop("_first_load")
    return registry.join(loaded, ["source_name", "file_name"], "left_anti").unionByName(fresh)


def with_drop_month(df: DataFrame) -> DataFrame:
    """Partition of a landed row: the month in its file name. One partition per file would
    leave thousands of tiny ones."""
    month = F.regexp_extract("_source_file", r"(\d{4})-?(\d{2})(-?\d{2})?(_restated)?\.csv$", 1)
    part = F.regexp_extract("_source_file", r"(\d{4})-?(\d{2})(-?\d{2})?(_restated)?\.csv$", 2)
    return df.withColumn("_drop_month", F.when(month != "", F.concat(month, part)).otherwise("static"))


def touched_months(todo: DataFrame) -> list[str]:
    """The partitions that files belong to: a few months, so the list is small however many files there are."""
    names = todo.select(F.col("file_name").alias("_source_file"))
    return sorted(r[0] for r in with_drop_month(names).select("_drop_month").distinct().collect())


def only_months(df: DataFrame, months: list[str]) -> DataFrame:
    """Literal partitions, so that a scan opens no other folder."""
    return df.filter(F.col("_drop_month").isin(months))


def merge_files(target: DataFrame, new: DataFrame, todo: DataFrame, months: list[str] | None = None) -> DataFrame:
    """Rows of the touched partitions after the load: the old rows of every loaded file leave,
    all new rows come in. Leaving out also the rows of files not yet registered makes a load
    that died before its registry entry safe to repeat. Only partitions that receive rows are
    read and written back; `months` names them where they are known already."""
    names = todo.select(F.col("file_name").alias("_source_file"))
    kept = only_months(target, touched_months(todo) if months is None else months).join(names, "_source_file", "left_anti")
    return kept.unionByName(new, allowMissingColumns=True)
