"""Second-level findings on online against till, and on channel conversion over time."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from plazaflow.functions.columns import count_where, mean, ratio
from plazaflow.operators.calendar import DateRange, filter_month_key

THIN_MONTH_SESSIONS = 1000
TREND_MONTHS = 3
DECAY_PCT = -33


def channel_mix_groups(mix: DataFrame) -> DataFrame:
    """SKUs rolled up to venue and category, where the two channels are comparable."""
    selling_online = count_where(F.col("online_qty") > 0)
    selling_till = count_where(F.col("walk_in_qty") > 0)
    sums = mix.groupBy("venue_name", "category").agg(
        F.sum("online_qty").alias("online_qty"), F.sum("walk_in_qty").alias("walk_in_qty"),
        F.sum("online_amount_kwd").alias("online_amount_kwd"), F.sum("walk_in_amount_kwd").alias("walk_in_amount_kwd"),
        F.count(F.lit(1)).alias("product_count"),
        ((selling_online > 0) & (selling_till > selling_online)).alias("crosswalked"),
    )
    total = F.col("online_qty") + F.col("walk_in_qty")
    return sums.withColumns({
        "total_qty": total,
        "online_share_pct": F.when(total > 0, ratio("online_qty", total) * 100),
    }).orderBy(F.desc("total_qty"))


def channel_series(
    monthly: DataFrame, rng: DateRange = None, thin: int = THIN_MONTH_SESSIONS, k: int = TREND_MONTHS
) -> DataFrame:
    """Per channel: totals, overall rate, mean rate of the first and last k months that are
    not thin, and the change between them. The rows are months, so the windows are short."""
    rows = filter_month_key(monthly, rng)
    totals = rows.groupBy("channel_name").agg(
        F.coalesce(F.sum("sessions"), F.lit(0)).alias("total_sessions"), F.sum("booking_count").alias("total_bookings")
    ).filter("total_sessions > 0")
    solid = rows.filter((F.coalesce("sessions", F.lit(0)) >= thin) & F.col("conversion_rate_pct").isNotNull())
    by_month = Window.partitionBy("channel_name").orderBy("month_key")
    ends = solid.withColumns({
        "_from_start": F.row_number().over(by_month),
        "_from_end": F.row_number().over(Window.partitionBy("channel_name").orderBy(F.desc("month_key"))),
    }).groupBy("channel_name").agg(
        mean("conversion_rate_pct", F.col("_from_start") <= k).alias("first_pct"),
        mean("conversion_rate_pct", F.col("_from_end") <= k).alias("last_pct"),
    )
    out = totals.join(ends, "channel_name", "left")
    return out.select(
        "channel_name", "total_sessions", "total_bookings",
        (ratio("total_bookings", "total_sessions") * 100).alias("overall_pct"), "first_pct", "last_pct",
        (ratio(F.col("last_pct") - F.col("first_pct"), "first_pct") * 100).alias("change_pct"),
    ).orderBy(F.desc("total_sessions"))


def channel_points(monthly: DataFrame, rng: DateRange = None, thin: int = THIN_MONTH_SESSIONS) -> DataFrame:
    """The months behind each series; thin months stay, marked."""
    return filter_month_key(monthly, rng).select(
        "channel_name", "month_key", "month_start", "sessions", F.col("booking_count").alias("bookings"),
        F.col("conversion_rate_pct").alias("conversion_pct"),
        (F.coalesce("sessions", F.lit(0)) < thin).alias("thin"),
    )


def flag_decay(series: DataFrame, pct: float = DECAY_PCT) -> DataFrame:
    return series.withColumn("decaying", F.coalesce(F.col("change_pct") <= pct, F.lit(False)))


def attribution_loss(conv: DataFrame) -> DataFrame:
    lost = F.col("channel_key").isNull() | F.coalesce(F.col("sessions") == 0, F.lit(True))
    sums = conv.agg(
        F.coalesce(F.sum(F.when(lost, F.col("booking_count"))), F.lit(0)).alias("bookings"),
        F.coalesce(F.sum(F.when(lost, F.col("booking_amount_kwd"))), F.lit(0)).alias("amount"),
        F.sum("booking_count").alias("_total"),
    )
    share = F.when(F.col("_total") > 0, ratio("bookings", "_total") * 100)
    return sums.select("bookings", "amount", share.alias("share_pct"))


def online_totals(groups: DataFrame, series: DataFrame) -> DataFrame:
    sums = groups.agg(
        F.sum("online_qty").alias("online_units"), F.sum("total_qty").alias("all_units"),
        F.sum("online_amount_kwd").alias("online_value"),
    )
    # highest rate first; the busier channel on ties
    rank = F.struct(F.coalesce("overall_pct", F.lit(0.0)), F.col("total_sessions"), F.col("channel_name"))
    best = series.agg(F.max_by("channel_name", rank).alias("best_channel"), F.max("overall_pct").alias("best_pct"))
    return sums.crossJoin(best)  # one row each
