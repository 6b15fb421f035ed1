"""Second-level findings on rent, sales density and filing discipline."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from plazaflow.functions.columns import count_where, mean, month_start, ratio
from plazaflow.functions.ordering import with_rank
from plazaflow.operators.calendar import DateRange, filter_months

UNDER_REPORTING_PCT = -30


def rent_summary(rent: DataFrame, rng: DateRange = None) -> DataFrame:
    sums = filter_months(rent, rng).agg(
        F.count(F.lit(1)).alias("tenant_months"),
        F.coalesce(F.sum("base_rent_kwd"), F.lit(0)).alias("base_rent"),
        F.coalesce(F.sum("turnover_rent_kwd"), F.lit(0)).alias("turnover_rent"),
        count_where(F.col("turnover_rent_kwd") > 0).alias("months_triggered"),
        count_where(F.col("is_restated")).alias("restated_count"),
        mean("days_late").alias("avg_days_late"),
    )
    owed = F.col("base_rent") + F.col("turnover_rent")
    return sums.select(
        "tenant_months", "base_rent", "turnover_rent", owed.alias("total_owed"),
        F.when(owed > 0, ratio("turnover_rent", owed) * 100).alias("turnover_share_pct"),
        "months_triggered", "restated_count", "avg_days_late",
    )


def rent_by_month(rent: DataFrame, rng: DateRange = None) -> DataFrame:
    return filter_months(rent, rng).groupBy("month_start").agg(
        F.sum("base_rent_kwd").alias("base_rent"),
        F.sum("turnover_rent_kwd").alias("turnover_rent"),
        F.sum("total_rent_owed_kwd").alias("total_owed"),
        F.count(F.lit(1)).alias("tenant_count"),
    ).orderBy("month_start")


def footfall_by_month(daily: DataFrame) -> DataFrame:
    return daily.groupBy(month_start("full_date").alias("month_start")).agg(F.sum("footfall").alias("footfall"))


SQM_KEYS = ["tenant_key", "tenant_id", "tenant_name", "category", "unit_sqm"]


def sqm_base(per_sqm: DataFrame, rng: DateRange = None) -> DataFrame:
    """Sales per square metre and month of each tenant version: total over months over area."""
    sums = filter_months(per_sqm, rng).filter(F.col("unit_sqm") > 0).groupBy(*SQM_KEYS).agg(
        F.count(F.lit(1)).alias("month_count"), F.coalesce(F.sum("sales_kwd"), F.lit(0)).alias("total_sales")
    )
    average = ratio("total_sales", "month_count")
    return sums.withColumns({"avg_monthly_sales": average, "sales_per_sqm": average / F.col("unit_sqm").cast("double")})


def with_footfall_corr(per_sqm: DataFrame, monthly_footfall: DataFrame) -> DataFrame:
    """Pearson of a tenant version's monthly sales with site footfall over the months that
    have both; null below three pairs or when either side is flat."""
    site = monthly_footfall.select("month_start", F.col("footfall").cast("double").alias("_x"))
    y = F.coalesce(F.col("sales_kwd").cast("double"), F.lit(0.0))
    paired = per_sqm.filter(F.col("unit_sqm") > 0).join(site, "month_start").withColumn("_y", y)
    spread = F.stddev_pop("_x") * F.stddev_pop("_y")
    usable = (F.count(F.lit(1)) >= 3) & (spread != 0)
    return paired.groupBy("tenant_key").agg(
        F.when(usable, F.covar_pop("_x", "_y") / F.nullif(spread, F.lit(0.0))).alias("footfall_correlation")
    )


def _middle(ranked: DataFrame, keys: list[str], value: str, name: str) -> DataFrame:
    """Exact median per key: the mean of the middle one or two positions."""
    low, high = F.floor((F.col("_n") - 1) / 2), F.floor(F.col("_n") / 2)
    picked = ranked.filter((F.col("_rank") == low) | (F.col("_rank") == high))
    return picked.groupBy(*keys).agg(((F.min(value) + F.max(value)) / 2).alias(name))


def sqm_median(sqm: DataFrame) -> DataFrame:
    return _middle(with_rank(sqm.select("sales_per_sqm", "tenant_key"), [], ["sales_per_sqm"]), [], "sales_per_sqm",
                   "all_median")


def _gap(value: str, reference: str) -> Column:
    return (F.col(value) / F.col(reference) - 1) * 100


def with_median_gap(sqm: DataFrame) -> DataFrame:
    out = sqm.crossJoin(F.broadcast(sqm_median(sqm)))  # one row
    gap = F.when(F.col("all_median") > 0, _gap("sales_per_sqm", "all_median")).otherwise(0.0)
    return out.withColumn("vs_median_pct", gap)


def with_peer_gap(sqm: DataFrame) -> DataFrame:
    """Gap to the median of the category without the tenant's own value (equal values leave too).

    In the sorted category a value occupies positions [first, first + ties). The median of
    the rest sits at known positions of that same order, so each tenant looks up two
    positions instead of meeting every peer.
    """
    ranked = with_rank(sqm.select("category", "sales_per_sqm", "tenant_key"), ["category"], ["sales_per_sqm"])
    values = ranked.groupBy("category", "sales_per_sqm").agg(
        F.min("_rank").alias("_first"), F.count(F.lit(1)).alias("_ties"), F.max("_n").alias("_n")
    ).withColumn("peer_count", F.col("_n") - F.col("_ties"))

    def position(p: Column) -> Column:
        return F.when(p < F.col("_first"), p).otherwise(p + F.col("_ties"))

    wanted = values.filter("peer_count > 0").withColumn("_at", F.explode(F.array(
        position(F.floor((F.col("peer_count") - 1) / 2)), position(F.floor(F.col("peer_count") / 2))
    )))
    at = ranked.select("category", F.col("_rank").alias("_at"), F.col("sales_per_sqm").alias("_value"))
    medians = wanted.join(at, ["category", "_at"]).groupBy("category", "sales_per_sqm").agg(
        ((F.min("_value") + F.max("_value")) / 2).alias("_category_median")
    )
    peers = values.select("category", "sales_per_sqm", "peer_count")
    out = sqm.join(peers, ["category", "sales_per_sqm"], "left").join(medians, ["category", "sales_per_sqm"], "left")
    gap = F.when(F.col("_category_median") > 0, _gap("sales_per_sqm", "_category_median"))
    return out.withColumn("vs_category_pct", gap).drop("_category_median")


def flag_under_reporting(sqm: DataFrame, pct: float = UNDER_REPORTING_PCT) -> DataFrame:
    return sqm.withColumn("under_reporting", F.col("vs_median_pct") <= pct)


def summarise_per_sqm(per_sqm: DataFrame, daily: DataFrame, rng: DateRange = None) -> DataFrame:
    """The whole finding, weakest first."""
    scoped = filter_months(per_sqm, rng)
    base = with_peer_gap(with_median_gap(sqm_base(scoped)))
    corr = with_footfall_corr(scoped, footfall_by_month(daily))
    return flag_under_reporting(base.join(corr, "tenant_key", "left")).orderBy("sales_per_sqm")


def peer_correlation(sqm: DataFrame) -> DataFrame:
    """Mean correlation of the tenants that are not flagged."""
    return sqm.filter(~F.col("under_reporting")).agg(mean("footfall_correlation").alias("peer_correlation"))


def merge_compliance(compliance: DataFrame) -> DataFrame:
    """Versions of a tenant together: submission-weighted lateness, category of the larger version."""
    has_late = F.col("avg_days_late").isNotNull()
    weight = F.when(has_late, F.col("submission_count"))
    size = F.struct("submission_count", "category")
    merged = compliance.groupBy("tenant_id").agg(
        F.max_by("tenant_name", size).alias("tenant_name"),
        F.max_by("category", size).alias("category"),
        F.sum("submission_count").alias("submission_count"),
        F.sum("restated_count").alias("restated_count"),
        F.max("max_days_late").alias("_late"),
        F.count(F.lit(1)).alias("version_count"),
        F.sum(F.col("avg_days_late") * weight).alias("_late_total"),
        F.sum(weight).alias("_late_count"),
    )
    # merging starts from zero days late; a single version keeps its own figure
    late = F.when(F.col("version_count") > 1, F.greatest(F.col("_late"), F.lit(0))).otherwise(F.col("_late"))
    return merged.select(
        "tenant_id", "tenant_name", "category", "submission_count", "restated_count",
        late.alias("max_days_late"), "version_count", (F.col("version_count") > 1).alias("merged"),
        ratio("_late_total", "_late_count").alias("avg_days_late"),
        (ratio("restated_count", "submission_count") * 100).alias("restated_pct"),
    ).orderBy(F.desc(F.coalesce("avg_days_late", F.lit(-1.0))))
