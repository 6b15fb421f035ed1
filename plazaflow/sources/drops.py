"""CSV drops read as text, by header name, with the file they came from."""

from __future__ import annotations

import csv
import hashlib
from collections import defaultdict
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

# Texts that count as missing in a drop.
MISSING = ["", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN", "<NA>",
           "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null"]

# Name of a tenant's filing.
FILING_PATTERN = r"tenant_sales_([a-z0-9]+)_(\d{4}-\d{2})(_restated)?\.csv$"

# File pattern of each source folder.
SOURCES = {
    "pos_sales": "d365_salesline_*.csv",
    "footfall": "footfall_*.csv",
    "web_sessions": "web_sessions_*.csv",
    "web_bookings": "web_bookings_*.csv",
    "weather": "weather_*.csv",
    "lessons": "lessons_*.csv",
    "events": "events.csv",
    "contracts": "contracts_*.csv",
    "tenant_sales": "tenant_sales_*.csv",
}
MASTER_FILES = ["venues", "gates", "products", "tenants", "stables", "instructors", "horses"]

# Columns of each landed source.
COLUMNS = {
    "pos_sales": "invoiceid salesid invoicedate itemid itemname qty salesprice lineamount currencycode inventsiteid "
                 "inventlocationid custaccount paymentmode createddatetime",
    "footfall": "sensor_id gate_name date hour count_in count_out",
    "web_sessions": "date channel device sessions engaged_sessions users",
    "web_bookings": "booking_id booking_datetime product_code qty amount_kwd channel customer_id",
    "weather": "date temp_max_c temp_min_c dust_storm_flag rain_mm",
    "lessons": "lesson_id lesson_date start_time instructor_id level capacity booked attended horse_ids",
    "events": "event_id event_name event_type start_date end_date expected_attendance",
    "contracts": "contract_id member_id contract_type venue_id start_date end_date monthly_amount_kwd status "
                 "cancellation_date stable_id phone_number",
    "tenant_sales": "date gross_sales net_sales",
}

FILE_SCHEMA = "path string, file_name string, checksum string, header string"
CHUNK = 8 << 20


def list_files(spark: SparkSession, pattern: str) -> DataFrame:
    """Paths only; file contents are not read."""
    return spark.read.format("binaryFile").load(pattern).select("path", "length")


def _opener():
    """Opens a path as a byte stream inside a task. Returned as an inner function, like the task
    functions below, so that it travels with the job and workers need not have this package."""

    def open_stream(path: str):
        from pyarrow import fs

        if path.startswith("file:"):
            return fs.LocalFileSystem().open_input_stream("/" + path[5:].lstrip("/"))
        if "://" not in path:
            return fs.LocalFileSystem().open_input_stream(path)
        system, inner = fs.FileSystem.from_uri(path.replace("s3a://", "s3://", 1))
        return system.open_input_stream(inner)

    return open_stream


def file_fingerprints(spark: SparkSession, pattern: str) -> DataFrame:
    """path, file_name, md5 checksum and header line per file; tasks stream the files."""
    open_stream, chunk_size = _opener(), CHUNK

    def fingerprint(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for path in batch["path"]:
                digest, head, complete = hashlib.md5(), b"", False
                with open_stream(path) as stream:
                    while chunk := stream.read(chunk_size):
                        if not complete:
                            line, newline, _ = chunk.partition(b"\n")
                            head, complete = head + line, bool(newline)
                        digest.update(chunk)
                rows.append((path, path.rsplit("/", 1)[-1], digest.hexdigest(), head.decode("utf-8-sig").strip()))
            yield pd.DataFrame(rows, columns=["path", "file_name", "checksum", "header"])

    width = max(1, spark.sparkContext.defaultParallelism)
    return list_files(spark, pattern).repartition(width).mapInPandas(fingerprint, FILE_SCHEMA)


def file_headers(spark: SparkSession, pattern: str) -> DataFrame:
    """path and header line per file; tasks read up to the first line break only."""
    open_stream = _opener()

    def head(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            lines = []
            for path in batch["path"]:
                line = b""
                with open_stream(path) as stream:
                    while chunk := stream.read(4096):
                        part, newline, _ = chunk.partition(b"\n")
                        line += part
                        if newline:
                            break
                lines.append(line.decode("utf-8-sig").strip())
            yield pd.DataFrame({"path": batch["path"], "header": lines})

    width = max(1, spark.sparkContext.defaultParallelism)
    return list_files(spark, pattern).repartition(width).mapInPandas(head, "path string, header string")


def _text(name: str) -> Column:
    return F.when(~F.col(name).isin(MISSING), F.col(name)).alias(name)


# A quote inside a quoted cell is doubled; a backslash is an ordinary character.
CSV_OPTIONS = {"header": "true", "quote": '"', "escape": '"', "encoding": "UTF-8"}


def landed_text(df: DataFrame) -> DataFrame:
    """What lands of a read drop, in batch and stream alike: texts, missing ones as null, and the file."""
    names = df.columns
    return df.select(*[_text(n) for n in names], F.col("_metadata.file_name").alias("_source_file"))


def header_names(header: str) -> list[str]:
    """Lower-case column names of a header line, which may be quoted."""
    return [h.strip().lower() for h in next(csv.reader([header.strip()]), [])]


def read_by_header(
    spark: SparkSession, files: list[tuple[str, str]], columns: list[str] | None = None, multi_line: bool = False
) -> DataFrame:
    """files: (path, header line). One read per distinct header, so a file whose columns are in
    another order, or lack some, still lands by name. The list is file metadata, which the
    driver holds for any file scan; rows stay distributed.

    multi_line lets quoted cells hold line breaks. Such a file cannot be split, so it is read by
    one task; it is meant for sources that are known to have such cells."""
    groups: dict[tuple[str, ...], list[str]] = defaultdict(list)
    for path, header in files:
        groups[tuple(header_names(header))].append(path)
    parts = []
    for names, paths in groups.items():
        schema = T.StructType([T.StructField(n, T.StringType()) for n in names])
        df = spark.read.schema(schema).options(**CSV_OPTIONS).option("enforceSchema", True).option("multiLine", multi_line)
        parts.append(landed_text(df.csv(paths)))
    if not parts:
        names = [*(columns or []), "_source_file"]
        return spark.createDataFrame([], T.StructType([T.StructField(n, T.StringType()) for n in names]))
    out = parts[0]
    for df in parts[1:]:
        out = out.unionByName(df, allowMissingColumns=True)
    if columns is None:
        return out
    have = set(out.columns)
    picked = [F.col(c) if c in have else F.lit(None).cast("string").alias(c) for c in columns]
    return out.select(*picked, "_source_file")


def read_drop(
    spark: SparkSession, path: str, pattern: str, columns: list[str] | None = None, multi_line: bool = False
) -> DataFrame:
    """All files of a drop folder as text, lower-case columns, `_source_file` added."""
    found = file_headers(spark, f"{path.rstrip('/')}/{pattern}").collect()
    return read_by_header(spark, [(r["path"], r["header"]) for r in found], columns, multi_line)


def with_filing_name(raw: DataFrame) -> DataFrame:
    """tenant, month and restatement from the file name; columns under their landed names."""
    name = F.col("_source_file")
    return raw.select(
        F.upper(F.regexp_extract(name, FILING_PATTERN, 1)).alias("tenant_id"),
        F.regexp_extract(name, FILING_PATTERN, 2).alias("sales_month"),
        (F.regexp_extract(name, FILING_PATTERN, 3) != "").alias("is_restatement"),
        F.col("date").alias("date_raw"),
        F.col("gross_sales").alias("gross_sales_raw"),
        F.col("net_sales").alias("net_sales_raw"),
        "_source_file",
    )


MANIFEST = "_submission_manifest.csv"
MANIFEST_SCHEMA = "filename string, submitted_date string"


def read_manifest(spark: SparkSession, folder: str) -> DataFrame:
    """The submission manifest of a tenant folder. Spark skips file names with a leading
    underscore, so one task streams it; it has a line per filing, no sales rows."""
    path = f"{folder.rstrip('/')}/{MANIFEST}"

    open_stream = _opener()

    def stream(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyarrow import csv, string

        names = ["filename", "submitted_date"]
        as_text = csv.ConvertOptions(
            column_types={n: string() for n in names}, include_columns=names, strings_can_be_null=True
        )
        for batch in batches:
            for one in batch["path"]:
                with open_stream(one) as raw, csv.open_csv(raw, convert_options=as_text) as reader:
                    for part in reader:
                        yield part.to_pandas()

    return spark.createDataFrame([(path,)], "path string").mapInPandas(stream, MANIFEST_SCHEMA)


def attach_manifest(df: DataFrame, manifest: DataFrame) -> DataFrame:
    """submitted_date by file name; null for a file the manifest does not list."""
    dates = manifest.select(F.col("filename").alias("_source_file"), "submitted_date")
    return df.join(dates, "_source_file", "left")


def read_tenant_files(spark: SparkSession, path: str, manifest: DataFrame | None = None) -> DataFrame:
    raw = with_filing_name(read_drop(spark, path, SOURCES["tenant_sales"], COLUMNS["tenant_sales"].split()))
    if manifest is None:
        return raw.withColumn("submitted_date", F.lit(None).cast("string"))
    return attach_manifest(raw, manifest)
