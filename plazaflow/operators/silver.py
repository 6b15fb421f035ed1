"""Typed, flagged tables from all-text drops. Nothing is dropped here."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window, functions as F

from plazaflow.functions.columns import (
    MONEY, QUANTITY, count_where, flags, hashed, lookup_known, parse_mixed_dates, try_number,
)

POS_DUPLICATE_KEY = [
    "invoice_id", "sales_id", "invoice_date", "item_id", "qty", "sales_price_kwd",
    "line_amount_kwd", "created_datetime", "payment_mode", "cust_account",
]
POS_ORDER = ["_source_file", "item_name", "venue_id"]


# ---- till sales

def pos_conform(raw: DataFrame) -> DataFrame:
    return raw.select(
        F.col("invoiceid").alias("invoice_id"),
        F.col("salesid").alias("sales_id"),
        F.col("invoicedate").cast("date").alias("invoice_date"),
        F.col("itemid").alias("item_id"),
        F.col("itemname").alias("item_name"),
        F.col("qty").cast(QUANTITY).alias("qty"),
        F.col("salesprice").cast(MONEY).alias("sales_price_kwd"),
        F.col("lineamount").cast(MONEY).alias("line_amount_kwd"),
        F.col("inventlocationid").alias("venue_id"),
        F.col("custaccount").alias("cust_account"),
        F.col("paymentmode").alias("payment_mode"),
        F.col("createddatetime").cast("timestamp_ntz").alias("created_datetime"),
        "_source_file",
    )


def with_refund(df: DataFrame) -> DataFrame:
    return df.withColumn("is_refund", F.col("qty") < 0)


def beaten_in_batch(n_keys: int) -> Callable[..., pa.Array]:
    """Of arrays of keys and then of order columns: which rows have a copy before them in the batch (nulls first, as in Spark)."""
    def beaten(*columns: pa.Array) -> pa.Array:
        n = len(columns[0])
        names = [str(i) for i in range(len(columns))]
        rows = pa.table([*columns, pa.array(np.arange(n))], names=[*names, "row"])
        groups = rows.group_by(names[:n_keys], use_threads=False)
        if len(counts := groups.aggregate([("row", "count")])) == n:
            return pa.array(np.zeros(n, dtype=bool))
        lists = groups.aggregate([("row", "list")])["row_list"].filter(pc.greater(counts["row_count"], 1)).combine_chunks()
        copies = rows.select(names[n_keys:]).take(lists.flatten()).append_column("row", lists.flatten()).append_column(
            "group", pc.list_parent_indices(lists))
        by = [(c, "ascending") for c in ["group", *names[n_keys:]]]
        place = pc.sort_indices(copies, sort_keys=by, null_placement="at_start")
        group, row = (copies[c].take(place).to_numpy() for c in ("group", "row"))
        out = np.zeros(n, dtype=bool)
        out[row[1:][group[1:] == group[:-1]]] = True
        return pa.array(out)

    return beaten


MARKS = 1 << 20  # words of 64 marks: 64 million, in a broadcast of at most about 50 MB however large the table is


def _repeated(df: DataFrame, keys: list[str]) -> DataFrame:
    """Adds `_repeated`: false only where no other row has the key.

    A key's hash marks one of 64 million places when it is counted twice; the words that hold marks are broadcast. A
    row whose place was marked by another key is taken for repeated, which costs its way through the shuffle only.
    """
    row = F.xxhash64(*[c for c, kind in df.dtypes if not kind.startswith("map")])
    lines = df.withColumn("_print", hashed(keys, 1))
    # the look at the whole row holds for every row; with it this pass reads the columns that the others read, and shares their shuffles
    seen = lines.groupBy("_print").agg(F.count(F.lit(1)).alias("_n"), F.bool_or(row == 0).alias("_row"))
    word, place = F.shiftrightunsigned("_print", 6).bitwiseAND(F.lit(MARKS - 1)), F.col("_print").bitwiseAND(F.lit(63)).cast("int")
    marks = seen.filter((F.col("_n") > 1) & F.col("_row").isNotNull()).groupBy(word.alias("_word")).agg(
        F.bit_or(F.call_function("shiftleft", F.lit(1).cast("bigint"), place)).alias("_marks"))
    marked = lines.withColumn("_word", word).join(F.broadcast(marks), "_word", "left")
    hit = F.coalesce(F.getbit("_marks", place) == 1, F.lit(False))
    return marked.withColumn("_repeated", hit).select(*df.columns, "_repeated")


def with_duplicate_flag(
    df: DataFrame, keys: list[str] = POS_DUPLICATE_KEY, order: list[str] = POS_ORDER, lanes: int | None = None
) -> DataFrame:
    """Flags the second and later copy of a key (null equals null); the first is kept.

    Rows whose key comes once are told by counting hashes of keys and stay where they are; only the others are ranked.
    Copies are first ranked within their Arrow batch, which moves no rows; then only the batch winners of a key meet,
    in the one shuffle of whole rows. The other copies are spread over as many lanes as shuffle partitions, so a key
    that makes up a large part of the table sends one row a batch to its task however large it is, and no copy is
    lost. Batches see 128 bits of hash for a key. Every other column breaks ties, so all uses of the flag shuffle the
    same columns and a plan with several of them shuffles once.
    """
    lanes = lanes or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    lane = F.pmod(F.spark_partition_id(), F.lit(lanes))
    marked = _repeated(df, keys)
    single = marked.filter(~F.col("_repeated")).drop("_repeated").withColumn("is_duplicate", F.lit(False))
    beaten = F.arrow_udf(beaten_in_batch(2), "boolean").asNondeterministic()  # depends on the batch a row is in
    local = marked.filter("_repeated").drop("_repeated").withColumn("_beaten", beaten(hashed(keys, 1), hashed(keys, 2), *order))
    ties = [c for c, kind in df.dtypes if c not in keys and c not in order and not kind.startswith("map")]
    # a look at the row before, not its number: a filter on row numbers would sort every line before the shuffle too
    # (the seat tells beaten copies apart already; named in the partition, a filter on the flag drops them before the shuffle)
    later = F.lag(F.lit(True), 1, False).over(Window.partitionBy(*keys, "_beaten", "_seat").orderBy(*order, *ties))
    ranked = local.withColumn("_seat", F.when(F.col("_beaten"), lane).otherwise(F.lit(-1))).withColumn("_later", later)
    flagged = ranked.withColumn("is_duplicate", F.col("_beaten") | F.col("_later")).drop("_beaten", "_seat", "_later")
    return single.unionByName(flagged)


def pos_silver(raw: DataFrame) -> DataFrame:
    return with_duplicate_flag(with_refund(pos_conform(raw)))


# ---- tenant filings

def collapse_submissions(raw: DataFrame) -> DataFrame:
    """Rows of a filing to one row per tenant, month and version; sum of all-null stays null."""
    parsed = parse_mixed_dates("date_raw")
    return raw.groupBy("tenant_id", "sales_month", "is_restatement").agg(
        F.sum(try_number("gross_sales_raw", MONEY)).cast(MONEY).alias("gross_sales_kwd"),
        F.sum(try_number("net_sales_raw", MONEY)).cast(MONEY).alias("net_sales_kwd"),
        F.min(F.col("submitted_date").cast("date")).alias("submitted_date"),
        F.min("_source_file").alias("_source_file"),
        count_where(parsed.isNull()).alias("unparsed_dates"),
    )


def with_days_late(df: DataFrame) -> DataFrame:
    month = F.to_date(F.col("sales_month"), "yyyy-MM")
    return df.withColumn("sales_month", month).withColumn(
        "days_late", F.datediff("submitted_date", F.last_day("sales_month"))
    )


def with_submission_flags(df: DataFrame) -> DataFrame:
    silent = F.col("gross_sales_kwd").isNull() & F.col("net_sales_kwd").isNull()
    return df.select(
        "tenant_id", "sales_month", "gross_sales_kwd", "net_sales_kwd", "submitted_date",
        F.when(F.col("is_restatement"), 2).otherwise(1).alias("submission_version"),
        "days_late",
        F.col("is_restatement").alias("is_restated"),
        "_source_file",
        flags(unparsed_date=F.col("unparsed_dates") > 0, no_sales_reported=silent).alias("_dq_flags"),
    )


def tenant_sales_silver(raw: DataFrame) -> DataFrame:
    return with_submission_flags(with_days_late(collapse_submissions(raw)))


# ---- contracts

def latest_snapshot(df: DataFrame, key: str = "contract_id", order: str = "_source_file") -> DataFrame:
    """The row of each key in the last file it appears in.

    An aggregate rather than a ranking: repeated exports of one contract are
    reduced before the shuffle.
    """
    rest = [c for c in df.columns if c not in (key, order)]
    best = df.groupBy(key).agg(F.max(F.struct(order, *rest)).alias("_row"))
    return best.select(key, *[F.col(f"_row.{c}").alias(c) for c in df.columns if c != key])


def contracts_conform(latest: DataFrame) -> DataFrame:
    return latest.select(
        "contract_id", "member_id", "contract_type", "venue_id",
        F.col("start_date").cast("date").alias("start_date"),
        F.col("end_date").cast("date").alias("end_date"),
        F.col("monthly_amount_kwd").cast(MONEY).alias("monthly_amount_kwd"),
        "status",
        F.col("cancellation_date").cast("date").alias("cancellation_date"),
        "stable_id", "phone_number", "_source_file",
    )


def flag_cancel_before_start(df: DataFrame) -> DataFrame:
    early = F.coalesce(F.col("cancellation_date") < F.col("start_date"), F.lit(False))
    return df.withColumn("cancellation_before_start", early)


def phone_owners(df: DataFrame) -> DataFrame:
    """Per known phone, the lowest and highest member id that use it."""
    known = df.filter(F.col("phone_number").isNotNull())
    return known.groupBy("phone_number").agg(
        F.min("member_id").alias("_low_member"), F.max("member_id").alias("_high_member")
    )


def flag_shared_phone(df: DataFrame) -> DataFrame:
    shared = phone_owners(df).filter("_low_member <> _high_member").select(
        "phone_number", F.lit(True).alias("_shared")
    )
    joined = lookup_known(df, shared, "phone_number")
    return joined.withColumn("shared_phone_across_members", F.coalesce("_shared", F.lit(False))).drop("_shared")


def contracts_silver(raw: DataFrame) -> DataFrame:
    df = flag_shared_phone(flag_cancel_before_start(contracts_conform(latest_snapshot(raw))))
    marks = flags(
        cancellation_before_start=F.col("cancellation_before_start"),
        shared_phone_across_members=F.col("shared_phone_across_members"),
    )
    return df.withColumn("_dq_flags", marks).drop("cancellation_before_start", "shared_phone_across_members")


# ---- lessons, events, weather, web

def lessons_silver(raw: DataFrame) -> DataFrame:
    capacity, booked = F.col("capacity").cast("int"), F.col("booked").cast("int")
    return raw.select(
        "lesson_id",
        F.col("lesson_date").cast("date").alias("lesson_date"),
        "start_time", "instructor_id", "level",
        capacity.alias("capacity"),
        booked.alias("booked"),
        try_number("attended", "double").cast("int").alias("attended"),
        F.split("horse_ids", ",").alias("horse_ids"),
        (booked > capacity).alias("is_overbooked"),
        "_source_file",
    )


def events_silver(raw: DataFrame) -> DataFrame:
    typed = raw.select(
        "event_id", "event_name", "event_type",
        F.col("start_date").cast("date").alias("start_date"),
        F.col("end_date").cast("date").alias("end_date"),
        F.col("expected_attendance").cast("int").alias("expected_attendance"),
        "_source_file",
    )
    return typed.withColumn("_dq_flags", flags(end_before_start=F.col("end_date") < F.col("start_date")))


def weather_silver(raw: DataFrame) -> DataFrame:
    return raw.select(
        F.col("date").cast("date").alias("weather_date"),
        F.col("temp_max_c").cast("decimal(5,1)").alias("temp_max_c"),
        F.col("temp_min_c").cast("decimal(5,1)").alias("temp_min_c"),
        F.coalesce(F.col("dust_storm_flag") == "True", F.lit(False)).alias("dust_storm_flag"),
        F.col("rain_mm").cast("decimal(6,2)").alias("rain_mm"),
        "_source_file",
    )


def web_sessions_silver(raw: DataFrame) -> DataFrame:
    counts = [F.col(c).cast("int").alias(c) for c in ("sessions", "engaged_sessions", "users")]
    return raw.select(F.col("date").cast("date").alias("session_date"), "channel", "device", *counts, "_source_file")


def web_bookings_silver(raw: DataFrame) -> DataFrame:
    amount = F.col("amount_kwd").cast(MONEY)
    return raw.select(
        "booking_id",
        F.col("booking_datetime").cast("timestamp_ntz").alias("booking_datetime"),
        "product_code",
        F.col("qty").cast(QUANTITY).alias("qty"),
        amount.alias("amount_kwd"),
        "channel", "customer_id",
        (amount < 0).alias("is_cancelled"),
        "_source_file",
        flags(channel_missing=F.col("channel").isNull()).alias("_dq_flags"),
    )


# ---- master data

MASTER_SCHEMAS: dict[str, dict[str, str]] = {
    "venues": {"venue_id": "string", "venue_name": "string", "venue_type": "string", "opened_date": "date",
               "description": "string"},
    "gates": {"gate_id": "string", "gate_name": "string", "description": "string"},
    "products": {"product_id": "string", "product_code": "string", "product_name": "string",
                 "venue_id": "string", "category": "string", "unit_price_kwd": MONEY},
    "tenants": {"tenant_id": "string", "tenant_name": "string", "category": "string", "unit_no": "string",
                "unit_sqm": "decimal(8,2)", "lease_start": "date", "lease_end": "date",
                "base_rent_kwd": MONEY, "turnover_rent_pct": "decimal(5,2)",
                "turnover_threshold_kwd": MONEY, "status": "string",
                "effective_start_date": "date", "effective_end_date": "date"},
    "stables": {"stable_id": "string", "box_no": "string", "size_category": "string", "status": "string"},
    "instructors": {"instructor_id": "string", "instructor_name": "string", "specialty_level": "string",
                    "hire_date": "date", "status": "string"},
    "horses": {"horse_id": "string", "horse_name": "string", "breed": "string",
               "level_suitability": "string", "stable_id": "string"},
}


def cast_table(raw: DataFrame, schema: dict[str, str]) -> DataFrame:
    """Lenient cast of a text table: a value that does not read as its type becomes null."""
    def typed(name: str, kind: str) -> Column:
        return F.col(name) if kind == "string" else try_number(name, kind)

    return raw.select(*[typed(n, k).alias(n) for n, k in schema.items()], "_source_file")
