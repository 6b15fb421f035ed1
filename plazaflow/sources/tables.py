"""Layer tables as Parquet folders."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

# Month-clustered facts: views that ask for a range prune partitions.
MONTH_OF = {
    "fact_pos_sales": "date_key",
    "fact_footfall": "date_key",
    "fact_bookings": "date_key",
    "fact_lesson_slots": "date_key",
    "fact_membership_months": "month_date_key",
}
# Keys that hardly repeat in a file: their dictionaries would be built, found too large and dropped, for each file kept open.
NO_DICTIONARY = {
    "contracts": ["contract_id"],
    "lesson_slots": ["lesson_id"],
    "web_bookings": ["booking_id"],
    "fact_bookings": ["booking_id"],
    "fact_lesson_slots": ["lesson_id"],
    "fact_membership_months": ["contract_id", "member_key"],
}
OPEN_MONTHS = 128  # files a writing task keeps open; with more months than that Spark sorts the rest of its rows by month
OPEN_FILES = "spark.sql.maxConcurrentOutputFileWriters"


def path_exists(spark: SparkSession, path: str) -> bool:
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()).exists(where)


class Warehouse:
    """Paths under one folder that every executor can reach."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def path(self, layer: str, name: str) -> str:
        return f"{self.root}/{layer}/{name}"

    def exists(self, layer: str, name: str) -> bool:
        self._recover(self.path(layer, name))
        return path_exists(self.spark, self.path(layer, name))

    def read_table(self, layer: str, name: str) -> DataFrame:
        self._recover(self.path(layer, name))
        return self.spark.read.parquet(self.path(layer, name))

    # A refresh is written beside the table and takes its place by renames. A job that dies while
    # writing leaves the table as it was; one that dies between the renames leaves the old table
    # under its second name, from where the next use brings it back.

    def _move(self, source: str, target: str | None) -> None:
        """Renames a folder, or deletes it."""
        where = self.spark._jvm.org.apache.hadoop.fs.Path(source)
        fs = where.getFileSystem(self.spark._jsc.hadoopConfiguration())
        if target is None:
            fs.delete(where, True)
        elif not fs.rename(where, self.spark._jvm.org.apache.hadoop.fs.Path(target)):
            raise OSError(f"{source} could not be renamed to {target}")

    def _recover(self, where: str) -> None:
        if path_exists(self.spark, f"{where}__old"):
            if path_exists(self.spark, where):
                self._move(f"{where}__old", None)
            else:
                self._move(f"{where}__old", where)

    def _switch(self, where: str) -> None:
        self._recover(where)
        if path_exists(self.spark, where):
            self._move(where, f"{where}__old")
        self._move(f"{where}__staged", where)
        self._recover(where)

    def read_bronze(self, name: str) -> DataFrame:
        """A landed table with its partition column as text, as it was written; inferred, months would become numbers
        and a filter on their text would reach no partition."""
        path = self.path("bronze", name)
        plain = self.spark.read.parquet(path).schema
        fields = [T.StructField(f.name, T.StringType() if f.name == "_drop_month" else f.dataType) for f in plain]
        return self.spark.read.schema(T.StructType(fields)).parquet(path)

    @contextmanager
    def months_open(self) -> Iterator[None]:
        """While this holds, a task keeps a file of each month open instead of sorting its rows by month first."""
        kept = self.spark.conf.get(OPEN_FILES)
        self.spark.conf.set(OPEN_FILES, OPEN_MONTHS)
        try:
            yield
        finally:
            self.spark.conf.set(OPEN_FILES, kept)

    def replace_table(self, layer: str, name: str, df: DataFrame) -> DataFrame:
        """Full refresh. Facts are laid out by month: each task writes a file for every month it has rows of, so the
        layout moves no rows; a hot month has rows in many tasks and with them many files."""
        where = self.path(layer, name)
        plain = {f"parquet.enable.dictionary#{c}": "false" for c in NO_DICTIONARY.get(name, [])}
        if name in MONTH_OF:
            month = F.floor(F.col(MONTH_OF[name]) / 100).cast("int")
            df.withColumn("_month", month).write.mode("overwrite").option("partitionOverwriteMode", "static").options(
                compression="zstd", **plain).partitionBy("_month").parquet(f"{where}__staged")
        else:
            df.write.mode("overwrite").options(compression="zstd", **plain).parquet(f"{where}__staged")
        self._switch(where)
        return self.read_table(layer, name).drop("_month")

    def append_results(self, name: str, df: DataFrame) -> None:
        df.write.mode("append").parquet(self.path("dq", name))

    def replace_partitions(self, layer: str, name: str, df: DataFrame) -> None:
        """Replaces only the months present in df; df may read the same table, since the new
        files are staged and swapped in when the job commits."""
        (
            df.hint("rebalance", "_drop_month").write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
            .partitionBy("_drop_month").parquet(self.path(layer, name))
        )

    def replace_self(self, layer: str, name: str, df: DataFrame) -> DataFrame:
        """Overwrite of a table that df reads: a refresh is written beside the table in any case."""
        return self.replace_table(layer, name, df)


def write_daily(df: DataFrame, date_col: str, path: str) -> None:
    """CSV per day. The rebalance hint gives a day one file, and a very large day several."""
    keyed = df.withColumn("_date_key", F.date_format(F.col(date_col).cast("date"), "yyyyMMdd"))
    laid = keyed.hint("rebalance", "_date_key")
    laid.write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy("_date_key").option(
        "header", True).csv(path)


def read_daily(spark: SparkSession, path: str, columns: list[str]) -> DataFrame:
    schema = ", ".join(f"`{c}` string" for c in [*columns, "_date_key"])
    return spark.read.schema(schema).option("header", True).csv(path)
