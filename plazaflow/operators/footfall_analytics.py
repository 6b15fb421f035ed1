"""Second-level findings on footfall, venue conversion and events."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from plazaflow.functions.columns import count_where, ratio, sum_where
from plazaflow.operators.calendar import DateRange, filter_dates, overlaps


def footfall_summary(daily: DataFrame, rng: DateRange = None) -> DataFrame:
    """Like-for-like year on year: both sides only over days that have a year-ago figure."""
    has_past = F.col("footfall_year_ago").isNotNull()
    rank = F.struct(F.col("footfall"), -F.unix_date("full_date"))  # earliest day wins a tie
    sums = filter_dates(daily, rng).agg(
        F.count(F.lit(1)).alias("days"),
        F.coalesce(F.sum("footfall"), F.lit(0)).alias("total"),
        F.max_by("full_date", rank).alias("busiest_date"),
        F.max("footfall").alias("busiest_footfall"),
        sum_where("footfall", has_past).alias("_now"),
        F.sum("footfall_year_ago").alias("total_year_ago"),
        count_where(F.col("has_imputed_hours") | F.col("has_corrected_hours")).alias("flagged_days"),
        count_where(F.col("dust_storm_flag")).alias("dust_storm_days"),
    )
    change = F.when(
        F.col("total_year_ago") > 0, ratio(F.col("_now") - F.col("total_year_ago"), "total_year_ago") * 100
    )
    return sums.select(
        "days", "total", F.coalesce(ratio("total", "days"), F.lit(0.0)).alias("mean_per_day"), "busiest_date",
        "busiest_footfall", "total_year_ago", change.alias("year_on_year_pct"), "flagged_days", "dust_storm_days",
    )


def venue_conversion_summary(conv: DataFrame, rng: DateRange = None) -> DataFrame:
    """Revenue over footfall, each summed first and divided once."""
    sums = filter_dates(conv, rng).groupBy("venue_id", "venue_name", "zone", "gate_proximity").agg(
        F.sum("revenue_kwd").alias("revenue_kwd"),
        F.sum("footfall").alias("_site"),
        F.sum("entrance_footfall").alias("_entrance"),
    )

    def per(den: str):
        return F.when(F.col(den) > 0, ratio("revenue_kwd", den))

    return sums.select(
        "venue_id", "venue_name", "zone", "gate_proximity", "revenue_kwd",
        per("_site").alias("revenue_per_site_visitor"), per("_entrance").alias("revenue_per_entrance_visitor"),
    ).orderBy(F.desc("revenue_kwd"))


def events_in_range(roi: DataFrame, rng: DateRange = None) -> DataFrame:
    """Measured events by uplift, then the unmeasurable ones by start date."""
    inside = roi.filter(overlaps(F.col("start_date"), F.col("end_date"), rng))
    return inside.orderBy(F.desc_nulls_last("footfall_uplift_per_day"), "start_date")


def flag_crowded_unprofitable(roi: DataFrame) -> DataFrame:
    crowded = (F.col("footfall_uplift_per_day") > 0) & (F.col("sales_uplift_per_day_kwd") < 0)
    return roi.withColumn("crowded_but_unprofitable", F.coalesce(crowded, F.lit(False)))


def entrance_share(zones: DataFrame, rng: DateRange = None) -> DataFrame:
    per_label = filter_dates(zones, rng).groupBy("gate_label").agg(F.sum("footfall").alias("footfall"))
    grand = per_label.agg(F.sum("footfall").alias("_grand"))
    share = F.when(F.col("_grand") > 0, ratio("footfall", "_grand") * 100).otherwise(0.0)
    out = per_label.crossJoin(F.broadcast(grand))  # one row
    return out.select("gate_label", "footfall", share.alias("share_pct")).orderBy(F.desc("footfall"))
