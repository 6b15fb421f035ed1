"""Second-level findings on memberships, lessons and recurring revenue."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from plazaflow.functions.columns import ratio, sum_where
from plazaflow.operators.calendar import DateRange, filter_months

# Levels in order of progression.
LEVEL_ORDER = ["beginner", "intermediate", "advanced"]


def membership_series(churn: DataFrame, rng: DateRange = None) -> DataFrame:
    """Churn weighted by the base it applied to: leavers from the second month on over the
    previous month's members. Rows are months per contract type."""
    before = F.lag("active_count").over(Window.partitionBy("contract_type").orderBy("month_date_key"))
    rows = filter_months(churn, rng).withColumn("_before", before)
    sums = rows.groupBy("contract_type").agg(
        F.max_by("active_count", "month_date_key").alias("latest_active"),
        F.max_by("active_mrr_kwd", "month_date_key").alias("latest_mrr"),
        F.min_by("active_count", "month_date_key").alias("_first_active"),
        sum_where("churned_count", F.col("_before").isNotNull()).alias("_churned"),
        F.sum("_before").alias("_exposed"),
    )
    return sums.select(
        "contract_type", "latest_active", "latest_mrr",
        F.when(F.col("_exposed") > 0, ratio("_churned", "_exposed") * 100).alias("churn_pct"),
        (F.col("latest_active") - F.col("_first_active")).alias("net_change"),
    ).orderBy(F.desc("latest_active"))


def recurring_totals(series: DataFrame) -> DataFrame:
    return series.agg(
        F.coalesce(F.sum("latest_mrr"), F.lit(0)).alias("total_mrr"),
        F.coalesce(F.sum("latest_active"), F.lit(0)).alias("total_active"),
    )


def level_months(lessons: DataFrame, rng: DateRange = None) -> DataFrame:
    sums = filter_months(lessons, rng).groupBy("level", "month_key").agg(
        F.sum("total_capacity").alias("capacity"), F.sum("total_booked").alias("booked")
    )
    rate = F.when(F.col("capacity") > 0, ratio("booked", "capacity") * 100)
    return sums.withColumn("utilization_pct", rate)


def _level_rank():
    spot = F.lit(99)
    for i, level in enumerate(LEVEL_ORDER):
        spot = F.when(F.col("level") == level, i).otherwise(spot)
    return spot


def level_series(lessons: DataFrame, rng: DateRange = None) -> DataFrame:
    """Utilisation per level over instructors. Instructor-months without any attendance mark
    leave the no-show rate, marked ones count whole."""
    rows = filter_months(lessons, rng)
    marked = F.col("total_attended").isNotNull()
    sums = rows.groupBy("level").agg(
        F.sum("total_capacity").alias("total_capacity"), F.sum("total_booked").alias("total_booked"),
        sum_where("total_booked", marked).alias("_marked_booked"), F.sum("total_attended").alias("_attended"),
        F.sum("overbooked_count").alias("overbooked_count"),
        F.sum("missing_attendance_count").alias("missing_attendance"),
        F.array_sort(F.collect_set("instructor_name")).alias("instructors"),
    )
    peaks = level_months(lessons, rng).groupBy("level").agg(
        F.max("utilization_pct").alias("peak_pct"), F.min("utilization_pct").alias("trough_pct")
    )
    absent = F.col("_marked_booked") - F.col("_attended")
    return sums.join(peaks, "level").select(
        "level", "total_capacity", "total_booked",
        F.when(F.col("total_capacity") > 0, ratio("total_booked", "total_capacity") * 100).alias("overall_pct"),
        "peak_pct", "trough_pct",
        F.when(F.col("_marked_booked") > 0, ratio(absent, "_marked_booked") * 100).alias("no_show_pct"),
        "overbooked_count", "missing_attendance", "instructors",
    ).orderBy(_level_rank(), "level")


def capacity_squeeze(lessons: DataFrame, rng: DateRange = None, full: float = 95, slack: float = 75) -> DataFrame:
    """The fullest level against the emptiest one in the fullest one's peak months; no row
    when there is nothing to reallocate."""
    months = level_months(lessons, rng)
    peaks = months.groupBy("level").agg(F.max("utilization_pct").alias("peak")).filter("peak is not null")
    early = F.struct(-_level_rank(), F.col("level"))
    ends = peaks.agg(
        F.max_by("level", F.struct(F.col("peak"), early)).alias("full_level"),
        F.max("peak").alias("full_peak_pct"),
        F.max_by("level", F.struct(-F.col("peak"), early)).alias("empty_level"),
    ).filter((F.col("full_level") != F.col("empty_level")) & (F.col("full_peak_pct") >= full))
    pair = F.broadcast(ends)  # one row at most
    at_ceiling = months.join(pair, F.col("level") == F.col("full_level"), "left_semi").filter(
        F.col("utilization_pct") >= full
    ).select("month_key")
    quiet = months.join(pair, F.col("level") == F.col("empty_level")).join(at_ceiling, "month_key", "left_semi")
    sums = quiet.groupBy("full_level", "empty_level", "full_peak_pct").agg(
        F.sum("capacity").alias("_capacity"), F.sum("booked").alias("_booked")
    )
    out = sums.withColumn("empty_at_full_peak_pct", ratio("_booked", "_capacity") * 100)
    return out.drop("_capacity", "_booked").filter(F.col("empty_at_full_peak_pct") <= slack)


def recurring_share(revenue: DataFrame, partial_months: DataFrame, rng: DateRange = None) -> DataFrame:
    """Membership share of revenue, and the weakest and strongest own-venue month, on whole
    months only: a cut-off month holds a full snapshot against a few days of tills."""
    whole = filter_months(revenue, rng).join(partial_months.select("month_start"), "month_start", "left_anti")
    early = -F.unix_date("month_start")  # the earliest month wins a tie
    sums = whole.agg(
        F.count(F.lit(1)).alias("whole_months"),
        F.sum("membership_mrr_kwd").alias("membership_mrr"),
        F.sum("total_revenue_kwd").alias("total_revenue"),
        F.max_by("month_start", F.struct(-F.col("own_venue_revenue_kwd"), early)).alias("_worst"),
        F.max_by("month_start", F.struct(F.col("own_venue_revenue_kwd"), early)).alias("_best"),
    )
    spread = F.col("_worst") != F.col("_best")
    return sums.select(
        "whole_months", "membership_mrr", "total_revenue",
        F.when(F.col("total_revenue") > 0, ratio("membership_mrr", "total_revenue") * 100).alias("recurring_share_pct"),
        F.when(spread, F.col("_worst")).alias("worst_month"), F.when(spread, F.col("_best")).alias("best_month"),
    )
