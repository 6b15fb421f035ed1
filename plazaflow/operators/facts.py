"""Facts: key lookups, point-in-time join, contract months, reject counts."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from plazaflow.functions.columns import lookup, lookup_known, month_start
from plazaflow.functions.frames import literal_frame
from plazaflow.operators.calendar import union_all
from plazaflow.operators.dims import resolve_member

Tables = dict[str, DataFrame]


def _dates(dims: Tables) -> DataFrame:
    # one row per calendar day: a few thousand rows however large the facts are
    return F.broadcast(dims["dim_date"].select("date_key", "full_date"))


def _keys(dims: Tables, table: str, key: str, natural: str) -> DataFrame:
    return dims[table].select(key, natural)


def _unique_sales(silver: Tables) -> DataFrame:
    return silver["pos_sales_lines"].filter(~F.col("is_duplicate"))


def fact_pos_sales(
    silver: Tables, dims: Tables, named: Callable[[DataFrame], DataFrame] | None = None
) -> DataFrame:
    """Lines dated outside the calendar are left out here and counted by `rejects`.

    What `named` adds to the product keys reaches the lines in the same lookup.
    """
    df = _unique_sales(silver).join(_dates(dims), F.col("invoice_date") == F.col("full_date"))
    df = lookup(df, _keys(dims, "dim_venue", "venue_key", "venue_id"), "venue_id")
    product = dims["dim_product"].select("product_key", F.col("product_id").alias("_item"))
    product = named(product) if named else product
    df = lookup(df, product, F.col("item_id") == F.col("_item"))
    return df.select(
        "invoice_id", "date_key", "venue_key", "product_key", "qty", "sales_price_kwd",
        "line_amount_kwd", "payment_mode", "is_refund", *[c for c in product.columns if c not in ("product_key", "_item")],
    )


def fact_footfall(silver: Tables, dims: Tables) -> DataFrame:
    df = lookup(silver["footfall_hourly"], _dates(dims), F.col("footfall_date") == F.col("full_date"))
    df = lookup(df, _keys(dims, "dim_gate", "gate_key", "gate_id"), "gate_id")
    return df.select(
        "date_key", "gate_key", "hour", "count_in", "count_out", "is_imputed", "is_outlier_corrected"
    )


def join_version_asof(
    facts: DataFrame, versions: DataFrame, key: str = "tenant_id", on: str = "sales_month", how: str = "inner"
) -> DataFrame:
    """Each fact meets the version valid on its date; none valid, no row."""
    f, v = facts.alias("f"), versions.alias("v")
    when = F.col(f"f.{on}")
    valid = (F.col("v.valid_from") <= when) & (F.col("v.valid_to").isNull() | (when <= F.col("v.valid_to")))
    extra = [c for c in versions.columns if c not in facts.columns]
    joined = f.join(v, (F.col(f"f.{key}") == F.col(f"v.{key}")) & valid, how)
    if how in ("left_anti", "left_semi"):
        return joined
    return joined.select("f.*", *[F.col(f"v.{c}") for c in extra])


def with_current_version(
    df: DataFrame, keys: list[str] = ["tenant_id", "sales_month"], version: str = "submission_version"
) -> DataFrame:
    """Versions of one key were already reduced to one row each, so groups are tiny."""
    newest = F.max(version).over(Window.partitionBy(*keys))
    return df.withColumn("is_current_version", F.col(version) == newest)


def fact_tenant_sales(silver: Tables, dims: Tables) -> DataFrame:
    versions = dims["dim_tenant"].select("tenant_key", "tenant_id", "valid_from", "valid_to")
    df = join_version_asof(silver["tenant_sales_monthly"], versions)
    df = with_current_version(lookup(df, _dates(dims), F.col("sales_month") == F.col("full_date")))
    return df.select(
        "tenant_key", F.col("date_key").alias("month_date_key"), "submission_version", "gross_sales_kwd",
        "net_sales_kwd", "submitted_date", "days_late", "is_restated", "is_current_version",
    )


def crosswalk_frame(spark: SparkSession, cfg: dict) -> DataFrame:
    rows = list(cfg["booking_product_family"].items())
    return literal_frame(spark, rows, {"family_code": "string", "sku_code": "string"})


def fact_bookings(silver: Tables, dims: Tables, crosswalk: DataFrame) -> DataFrame:
    df = silver["web_bookings"].withColumn("booking_date", F.to_date("booking_datetime"))
    df = df.join(_dates(dims), F.col("booking_date") == F.col("full_date"))
    df = lookup(df, crosswalk, F.col("product_code") == F.col("family_code")).drop("product_code")
    product = _keys(dims, "dim_product", "product_key", "product_code")
    df = lookup(df, product, F.col("sku_code") == F.col("product_code"))
    df = lookup_known(df, _keys(dims, "dim_channel", "channel_key", "channel_name"), "channel", "channel_name")
    df = lookup_known(df, _keys(dims, "dim_customer", "customer_key", "customer_id"), "customer_id")
    return df.select(
        "booking_id", "date_key", "product_key", "channel_key", "customer_key", "qty", "amount_kwd", "is_cancelled"
    )


def fact_web_sessions(silver: Tables, dims: Tables) -> DataFrame:
    df = lookup(silver["web_sessions"], _dates(dims), F.col("session_date") == F.col("full_date"))
    df = lookup(df, _keys(dims, "dim_channel", "channel_key", "channel_name"), F.col("channel") == F.col("channel_name"))
    return df.select("date_key", "channel_key", "device", "sessions", "engaged_sessions", "users")


def _as_month(value: Column | str) -> Column:
    return month_start((F.lit(value) if isinstance(value, str) else value).cast("date"))


def explode_contract_months(contracts: DataFrame, min_month: Column | str, max_month: Column | str) -> DataFrame:
    """One row per month a contract is active inside the window; no shuffle.

    min_month and max_month are dates or columns holding them.
    """
    low, high = _as_month(min_month), _as_month(max_month)
    df = contracts.withColumns({
        "start_month": month_start("start_date"),
        "true_end_month": month_start("end_date"),
        "_low": low,
        "_high": high,
    })
    first = F.greatest("start_month", "_low")
    last = F.least(F.coalesce("true_end_month", "_high"), F.col("_high"))
    df = df.withColumn("capped_end_month", last)
    months = F.when(first <= last, F.sequence(first, last, F.expr("interval 1 month")))
    return df.withColumn("month_date", F.explode(months))


def with_contract_flags(exploded: DataFrame) -> DataFrame:
    is_new = (F.col("month_date") == F.col("start_month")) & (F.col("start_month") >= F.col("_low"))
    ended = F.coalesce(F.col("true_end_month") <= F.col("_high"), F.lit(False))
    churned = (F.col("month_date") == F.col("capped_end_month")) & ended & F.coalesce(
        F.col("status").isin("cancelled", "expired"), F.lit(False)
    )
    out = exploded.withColumns({"is_new": is_new, "is_churned": churned})
    out = out.withColumn("month_status", F.when(F.col("is_churned"), F.col("status")).otherwise("active"))
    return out.drop("_low", "_high")


def fact_membership_months(
    contracts: DataFrame, dims: Tables, named: Callable[[DataFrame], DataFrame] | None = None
) -> DataFrame:
    """Full monthly amount in every month, no proration.

    Keys are looked up per contract, before the explosion multiplies the rows. So is what `named`
    adds to the contracts with their keys; each month carries the added columns.
    """
    span = dims["dim_date"].agg(F.min("full_date").alias("_from"), F.max("full_date").alias("_to"))
    df = resolve_member(contracts)
    member = dims["dim_member"].select("member_key", F.col("member_id").alias("canonical_member_id"))
    df = lookup(df, member, "canonical_member_id")
    df = lookup(df, _keys(dims, "dim_venue", "venue_key", "venue_id"), "venue_id")
    df = lookup_known(df, _keys(dims, "dim_stable", "stable_key", "stable_id"), "stable_id")
    keyed = df.drop("member_id", "canonical_member_id", "venue_id", "stable_id")
    df = named(keyed) if named else keyed
    added = [c for c in df.columns if c not in keyed.columns]
    df = df.crossJoin(F.broadcast(span))  # one row
    df = with_contract_flags(explode_contract_months(df, F.col("_from"), F.col("_to")))
    df = lookup(df, _dates(dims), F.col("month_date") == F.col("full_date"))
    return df.select(
        "contract_id", "member_key", "venue_key", F.col("date_key").alias("month_date_key"), "contract_type",
        "stable_key", F.col("monthly_amount_kwd").alias("mrr_kwd"), F.col("month_status").alias("status"),
        "is_new", "is_churned", *added,
    )


def fact_lesson_slots(silver: Tables, dims: Tables) -> DataFrame:
    df = lookup(silver["lesson_slots"], _dates(dims), F.col("lesson_date") == F.col("full_date"))
    df = lookup(df, _keys(dims, "dim_instructor", "instructor_key", "instructor_id"), "instructor_id")
    return df.select(
        "lesson_id", "date_key", "instructor_key", "level", "capacity", "booked", "attended", "is_overbooked"
    )


def build_facts(spark: SparkSession, silver: Tables, dims: Tables, cfg: dict) -> Tables:
    return {
        "fact_pos_sales": fact_pos_sales(silver, dims),
        "fact_footfall": fact_footfall(silver, dims),
        "fact_tenant_sales": fact_tenant_sales(silver, dims),
        "fact_bookings": fact_bookings(silver, dims, crosswalk_frame(spark, cfg)),
        "fact_web_sessions": fact_web_sessions(silver, dims),
        "fact_membership_months": fact_membership_months(silver["contracts"], dims),
        "fact_lesson_slots": fact_lesson_slots(silver, dims),
    }


def rejects(silver: Tables, dims: Tables, crosswalk: DataFrame) -> DataFrame:
    """What the fact builds leave out or cannot resolve: source, reason, value, row_count."""
    dates = _dates(dims)

    def report(df: DataFrame, source: str, reason: str, value: Column, rows: Column = F.lit(1)) -> DataFrame:
        return df.groupBy(F.lit(source).alias("source"), F.lit(reason).alias("reason"),
                          value.cast("string").alias("value")).agg(F.sum(rows).cast("bigint").alias("row_count"))

    sales = _unique_sales(silver).select("invoice_date")
    late_sales = sales.join(dates, F.col("invoice_date") == F.col("full_date"), "left_anti")
    # an unknown gate is judged on its count, not on every row
    counts = silver["footfall_hourly"].groupBy("gate_id").agg(F.count(F.lit(1)).alias("_rows"))
    no_gate = counts.join(dims["dim_gate"].select("gate_id"), "gate_id", "left_anti")
    filings = silver["tenant_sales_monthly"]
    no_version = join_version_asof(
        filings, dims["dim_tenant"].select("tenant_id", "valid_from", "valid_to"), how="left_anti"
    )
    bookings = silver["web_bookings"].groupBy(F.to_date("booking_datetime").alias("booking_date"), "product_code").agg(
        F.count(F.lit(1)).alias("_rows"))
    late_bookings = bookings.join(dates, F.col("booking_date") == F.col("full_date"), "left_anti")
    no_family = bookings.join(crosswalk, F.col("product_code") == F.col("family_code"), "left_anti")
    return union_all([
        report(late_sales, "pos_sales_lines", "date outside calendar", F.lit(None)),
        report(no_gate, "footfall_hourly", "unknown gate", F.col("gate_id"), F.col("_rows")),
        report(no_version, "tenant_sales_monthly", "no tenant version", F.lit(None)),
        report(no_family, "web_bookings", "product code without family", F.col("product_code"), F.col("_rows")),
        report(late_bookings, "web_bookings", "date outside calendar", F.lit(None), F.col("_rows")),
    ])
