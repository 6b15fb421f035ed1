"""The nineteen reporting views. Facts are reduced before they are joined."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from plazaflow.functions.columns import count_where, date_key, mean, month_start, pct, ratio, sum_where


def _small(df: DataFrame) -> DataFrame:
    """Calendar-grained side: bounded by the days of the calendar."""
    return F.broadcast(df)


def _flags_or() -> list:
    return [
        F.bool_or("is_imputed").alias("has_imputed_hours"),
        F.bool_or("is_outlier_corrected").alias("has_corrected_hours"),
    ]


DAY_COLS = ["date_key", "full_date", "season", "is_weekend", "is_ramadan"]


# ---- footfall and sales

def footfall_daily(footfall: DataFrame, date: DataFrame, weather: DataFrame) -> DataFrame:
    """Week and year ago come by date, not by row offset: a missing day must not shift them.

    Each day hands its count to the days that look back at it, so the fact is read and
    reduced once instead of once per self-join. A day looks back at the same month-day;
    29 February looks back at the 28th, and nothing looks back at a 29 February.
    """
    per_day = footfall.groupBy("date_key").agg(F.sum("count_in").alias("footfall"), *_flags_or())
    daily = per_day.join(_small(date.select(*DAY_COLS)), "date_key")
    day, later = F.col("full_date"), F.add_months("full_date", 12)
    leap_day = (F.date_format(day, "MMdd") == "0228") & (F.dayofmonth(F.last_day(later)) == 29)

    def seen_from(at, lag: str):
        return F.struct(at.alias("at"), F.lit(lag).alias("lag"))

    spread = daily.withColumn("_seen", F.explode(F.array(
        seen_from(day, "now"),
        seen_from(F.date_add(day, 7), "week"),
        seen_from(F.when(F.dayofmonth(later) == F.dayofmonth(day), later), "year"),
        seen_from(F.when(leap_day, F.date_add(later, 1)), "year"),
    ))).filter("_seen.at is not null")

    def of(lag: str, column: str):
        return F.max(F.when(F.col("_seen.lag") == lag, F.col(column)))

    own = [*[c for c in DAY_COLS if c != "full_date"], "footfall", "has_imputed_hours", "has_corrected_hours"]
    out = spread.groupBy(F.col("_seen.at").alias("full_date")).agg(
        *[of("now", c).alias(c) for c in own],
        of("week", "footfall").alias("footfall_week_ago"), of("year", "footfall").alias("footfall_year_ago"),
    ).filter("date_key is not null").join(weather, "date_key", "left")
    return out.select(
        *DAY_COLS, "footfall", "has_imputed_hours", "has_corrected_hours", "footfall_week_ago",
        "footfall_year_ago", "temp_max_c", "temp_min_c", "dust_storm_flag", "rain_mm",
    )


def footfall_by_zone(footfall: DataFrame, gate: DataFrame, date: DataFrame) -> DataFrame:
    per_gate = footfall.groupBy("date_key", "gate_key").agg(
        F.sum("count_in").alias("count_in"), F.bool_or("is_imputed").alias("is_imputed"),
        F.bool_or("is_outlier_corrected").alias("is_outlier_corrected"),
    )
    place = gate.select("gate_key", "zone", "gate_label", "primary_venue_served")
    per_zone = per_gate.join(place, "gate_key").groupBy("date_key", "zone", "gate_label", "primary_venue_served").agg(
        F.sum("count_in").alias("footfall"), *_flags_or()
    )
    out = per_zone.join(_small(date.select(*DAY_COLS)), "date_key")
    return out.select(
        *DAY_COLS, "zone", "gate_label", "primary_venue_served", "footfall", "has_imputed_hours", "has_corrected_hours"
    )


def footfall_sales_conversion(
    footfall: DataFrame, pos: DataFrame, gate: DataFrame, venue: DataFrame, date: DataFrame
) -> DataFrame:
    per_gate = footfall.groupBy("date_key", "gate_key").agg(F.sum("count_in").alias("count_in"))
    site = per_gate.groupBy("date_key").agg(F.sum("count_in").alias("footfall"))
    entrance = (
        per_gate.join(gate.select("gate_key", "gate_label"), "gate_key")
        .groupBy("date_key", "gate_label").agg(F.sum("count_in").alias("entrance_footfall"))
    )
    sales = pos.groupBy("date_key", "venue_key").agg(
        F.sum("line_amount_kwd").alias("revenue_kwd"), count_where(~F.col("is_refund")).alias("line_count")
    )
    out = sales.join(
        venue.select("venue_key", "venue_id", "venue_name", "venue_type", "zone", "gate_proximity"), "venue_key"
    ).join(site, "date_key")
    out = out.join(
        entrance.withColumnRenamed("gate_label", "gate_proximity"), ["date_key", "gate_proximity"], "left"
    ).join(_small(date.select("date_key", "full_date")), "date_key")

    def per(num: str, den: str):
        return F.when(F.col(den) > 0, ratio(num, den))

    return out.select(
        "date_key", "full_date", "venue_id", "venue_name", "venue_type", "footfall", "revenue_kwd", "line_count",
        per("revenue_kwd", "footfall").alias("revenue_per_visitor_kwd"),
        per("line_count", "footfall").alias("conversion_rate"),
        "zone", "gate_proximity", "entrance_footfall",
        per("revenue_kwd", "entrance_footfall").alias("revenue_per_entrance_visitor_kwd"),
        per("line_count", "entrance_footfall").alias("entrance_conversion_rate"),
    )


def event_days(event: DataFrame, date: DataFrame) -> DataFrame:
    """event_key, full_date. Days are generated per event and met by equality, so no
    nested loop over events and calendar; a reversed event has no days."""
    span = date.agg(F.min("full_date").alias("_low"), F.max("full_date").alias("_high"))
    clipped = event.crossJoin(F.broadcast(span)).select(
        "event_key",
        F.greatest("start_date", "_low").alias("_from"),
        F.least(F.coalesce("end_date", "start_date"), F.col("_high")).alias("_to"),
    )
    days = F.when(F.col("_from") <= F.col("_to"), F.sequence("_from", "_to"))
    spread = clipped.select("event_key", F.explode(days).alias("full_date"))
    return spread.join(_small(date.select("full_date")), "full_date", "left_semi")


def event_roi(event: DataFrame, date: DataFrame, footfall: DataFrame, pos: DataFrame) -> DataFrame:
    visits = footfall.groupBy("date_key").agg(F.sum("count_in").alias("footfall"))
    sales = pos.filter(~F.col("is_refund")).groupBy("date_key").agg(F.sum("line_amount_kwd").alias("sales_kwd"))
    by_day = date.select("date_key", "full_date").join(visits, "date_key", "left").join(sales, "date_key", "left")
    by_day = by_day.select("full_date", "footfall", "sales_kwd")

    days = event_days(event, date)
    totals = days.join(_small(by_day), "full_date").groupBy("event_key").agg(
        F.count(F.lit(1)).alias("event_day_count"),
        F.sum("footfall").alias("total_footfall"),
        F.sum("sales_kwd").alias("total_sales_kwd"),
    )
    covered = days.select("full_date").distinct()
    before = event.select(
        "event_key",
        F.explode(F.sequence(F.date_sub("start_date", 14), F.date_sub("start_date", 1))).alias("full_date"),
    )
    baseline = (
        before.join(_small(by_day), "full_date").join(_small(covered), "full_date", "left_anti")
        .groupBy("event_key").agg(
            mean("footfall").alias("baseline_avg_footfall"), mean("sales_kwd").alias("baseline_avg_sales_kwd")
        )
    )
    out = event.join(totals, "event_key", "left").join(baseline, "event_key", "left")
    return out.select(
        "event_key", "event_id", "event_name", "event_type", "start_date", "end_date", "expected_attendance",
        "event_day_count", "total_footfall", "total_sales_kwd", "baseline_avg_footfall", "baseline_avg_sales_kwd",
        (ratio("total_footfall", "event_day_count") - F.col("baseline_avg_footfall")).alias("footfall_uplift_per_day"),
        (ratio("total_sales_kwd", "event_day_count") - F.col("baseline_avg_sales_kwd"))
        .alias("sales_uplift_per_day_kwd"),
    )


def avg_transaction_value(pos: DataFrame, venue: DataFrame) -> DataFrame:
    invoices = pos.groupBy("invoice_id", "venue_key").agg(F.sum("line_amount_kwd").alias("amount"))
    sale = F.col("amount") > 0
    per_venue = invoices.groupBy("venue_key").agg(
        count_where(sale).alias("sale_invoice_count"),
        count_where(F.col("amount") < 0).alias("refund_invoice_count"),
        mean("amount", sale).alias("avg_transaction_value_kwd"),
        F.sum("amount").alias("net_revenue_kwd"),
    )
    out = per_venue.join(venue.select("venue_key", "venue_id", "venue_name", "venue_type"), "venue_key")
    return out.select(
        "venue_key", "venue_id", "venue_name", "venue_type", "sale_invoice_count", "refund_invoice_count",
        "avg_transaction_value_kwd", "net_revenue_kwd",
    )


# ---- tenants

def _reported():
    return F.coalesce("gross_sales_kwd", "net_sales_kwd")


def _turnover_rent():
    # greatest() skips a null, so a silent month owes no turnover rent
    over = F.greatest(_reported() - F.col("turnover_threshold_kwd"), F.lit(0).cast("decimal(13,3)"))
    return (over * F.col("turnover_rent_pct") / 100).cast("decimal(18,6)")


def _current_filings(tenant_sales: DataFrame, tenant: DataFrame, date: DataFrame) -> DataFrame:
    month = date.select(F.col("date_key").alias("month_date_key"), F.col("full_date").alias("month_start"))
    current = tenant_sales.filter("is_current_version")
    return current.join(tenant, "tenant_key").join(_small(month), "month_date_key")


def turnover_rent(tenant_sales: DataFrame, tenant: DataFrame, date: DataFrame) -> DataFrame:
    return _current_filings(tenant_sales, tenant, date).select(
        "tenant_key", "tenant_id", "tenant_name", "category", "month_date_key", "month_start", "base_rent_kwd",
        _reported().alias("reported_sales_kwd"), "turnover_threshold_kwd", "turnover_rent_pct",
        _turnover_rent().alias("turnover_rent_kwd"),
        (F.col("base_rent_kwd") + _turnover_rent()).alias("total_rent_owed_kwd"),
        "days_late", "is_restated",
    )


def sales_per_sqm(tenant_sales: DataFrame, tenant: DataFrame, date: DataFrame) -> DataFrame:
    return _current_filings(tenant_sales, tenant, date).select(
        "tenant_key", "tenant_id", "tenant_name", "category", "unit_sqm", "month_date_key", "month_start",
        _reported().alias("sales_kwd"), ratio(_reported(), "unit_sqm").alias("sales_per_sqm_kwd"),
    )


def tenant_compliance(tenant_sales: DataFrame, tenant: DataFrame) -> DataFrame:
    per_version = tenant_sales.filter("is_current_version").groupBy("tenant_key").agg(
        F.count(F.lit(1)).alias("submission_count"),
        mean("days_late").alias("avg_days_late"),
        F.max("days_late").alias("max_days_late"),
        count_where(F.col("is_restated")).alias("restated_count"),
    )
    out = per_version.join(tenant.select("tenant_key", "tenant_id", "tenant_name", "category"), "tenant_key")
    return out.select(
        "tenant_key", "tenant_id", "tenant_name", "category", "submission_count", "avg_days_late", "max_days_late",
        "restated_count", pct("restated_count", "submission_count", 1).alias("restated_pct"),
    )


def tenant_site_metrics(tenant_sales: DataFrame, tenant: DataFrame, date: DataFrame) -> DataFrame:
    return _current_filings(tenant_sales, tenant, date).select(
        "tenant_key", "tenant_id", "tenant_name", "category", "unit_no", "unit_sqm", "status", "month_date_key",
        "month_start", _reported().alias("sales_kwd"), ratio(_reported(), "unit_sqm").alias("sales_per_sqm_kwd"),
        "base_rent_kwd", _turnover_rent().alias("turnover_rent_kwd"),
        (F.col("base_rent_kwd") + _turnover_rent()).alias("total_rent_owed_kwd"), "days_late", "is_restated",
    )


# ---- bookings and web

def ticket_channel_mix(bookings: DataFrame, pos: DataFrame, product: DataFrame, venue: DataFrame) -> DataFrame:
    """Online against till per SKU. Both sides are summed to product grain before they meet.

    Rows without a product are one sum a side, which the lookup of the product drops. Dropped earlier, as a filter
    on the lines' item, they would give this view a duplicate flag and a shuffle of all lines of its own.
    """
    def per_product(df: DataFrame, amount: str, prefix: str) -> DataFrame:
        return df.groupBy("product_key").agg(
            F.sum("qty").alias(f"{prefix}_qty"), F.sum(amount).alias(f"{prefix}_amount_kwd")
        )

    online = per_product(bookings.filter(~F.col("is_cancelled")), "amount_kwd", "online")
    till = per_product(pos.filter(~F.col("is_refund")), "line_amount_kwd", "walk_in")
    both = online.join(till, "product_key", "full")
    out = both.join(product, "product_key").join(venue.select("venue_key", "venue_name"), "venue_key", "left")
    qty = {c: F.coalesce(c, F.lit(0)) for c in ("online_qty", "online_amount_kwd", "walk_in_qty", "walk_in_amount_kwd")}
    return out.select(
        "product_key", "product_code", "product_name", "category", *[v.alias(k) for k, v in qty.items()],
        pct(qty["online_qty"], qty["online_qty"] + qty["walk_in_qty"], 1).alias("online_share_pct"),
        "venue_key", F.coalesce("venue_name", F.lit("Site-wide")).alias("venue_name"),
    )


UNATTRIBUTED = "unknown (attribution loss)"


def _session_sums() -> list:
    return [F.sum(c).alias(c) for c in ("sessions", "engaged_sessions", "users")]


def _booking_sums() -> list:
    kept = ~F.col("is_cancelled")
    return [
        count_where(kept).alias("booking_count"),
        sum_where("amount_kwd", kept).alias("booking_amount_kwd"),
    ]


def _conversion_cols() -> list:
    count = F.coalesce("booking_count", F.lit(0))
    return [
        F.coalesce("channel_name", F.lit(UNATTRIBUTED)).alias("channel_name"),
        "sessions", "engaged_sessions", "users",
        count.alias("booking_count"),
        F.coalesce("booking_amount_kwd", F.lit(0)).alias("booking_amount_kwd"),
        pct(count, "sessions", 2).alias("conversion_rate_pct"),
    ]


def web_channel_conversion(sessions: DataFrame, bookings: DataFrame, channel: DataFrame) -> DataFrame:
    """Bookings without a channel never match and keep their own row."""
    visits = sessions.groupBy("channel_key").agg(*_session_sums()).join(channel, "channel_key")
    booked = bookings.groupBy("channel_key").agg(*_booking_sums())
    return visits.join(booked, "channel_key", "full").select("channel_key", *_conversion_cols())


def web_channel_conversion_monthly(
    sessions: DataFrame, bookings: DataFrame, channel: DataFrame, date: DataFrame
) -> DataFrame:
    day = _small(date.select("date_key", "full_date", (F.col("year") * 100 + F.col("month")).alias("month_key")))
    visits = (
        sessions.join(day, "date_key").groupBy("month_key", "channel_key")
        .agg(F.min("full_date").alias("month_start"), *_session_sums()).join(channel, "channel_key")
    )
    booked = bookings.join(day, "date_key").groupBy("month_key", "channel_key").agg(*_booking_sums())
    return visits.join(booked, ["month_key", "channel_key"], "full").select(
        "month_key", "month_start", "channel_key", *_conversion_cols()
    )


# ---- membership, revenue, lessons, stables

def membership_active_churn(membership: DataFrame, date: DataFrame) -> DataFrame:
    active = F.col("status") == "active"
    monthly = membership.groupBy("month_date_key", "contract_type").agg(
        count_where(active).alias("active_count"),
        count_where(F.col("is_new")).alias("new_count"),
        count_where(F.col("is_churned")).alias("churned_count"),
        sum_where("mrr_kwd", active).alias("active_mrr_kwd"),
    )
    month = date.select(F.col("date_key").alias("month_date_key"), F.col("full_date").alias("month_start"))
    monthly = monthly.join(_small(month), "month_date_key")
    # months per contract type: a few hundred rows at most
    before = F.lag("active_count").over(Window.partitionBy("contract_type").orderBy("month_start"))
    return monthly.withColumn("_before", before).select(
        "month_date_key", "month_start", "contract_type", "active_count", "new_count", "churned_count",
        "active_mrr_kwd", pct("churned_count", "_before", 2).alias("churn_rate_pct"),
    )


def revenue_summary(
    pos: DataFrame, tenant_sales: DataFrame, tenant: DataFrame, membership: DataFrame, date: DataFrame
) -> DataFrame:
    """Three streams that do not overlap, on the months whose first day is in the calendar."""
    day = date.select("date_key", month_start("full_date").alias("_month"))
    first = date.select(F.col("date_key").alias("month_date_key"), F.col("full_date").alias("month_start"))
    till = (
        pos.filter(~F.col("is_refund")).groupBy("date_key").agg(F.sum("line_amount_kwd").alias("amount"))
        .join(_small(day), "date_key").groupBy(date_key("_month").alias("month_date_key"))
        .agg(F.sum("amount").alias("own_venue_revenue_kwd"))
    )
    rent = (
        tenant_sales.filter("is_current_version").join(tenant, "tenant_key").groupBy("month_date_key")
        .agg(F.sum(F.col("base_rent_kwd") + _turnover_rent()).alias("rental_revenue_kwd"))
    )
    dues = membership.groupBy("month_date_key").agg(
        sum_where("mrr_kwd", F.col("status") == "active").alias("membership_mrr_kwd")
    )
    # a stream has one row per month; stacked, each is computed once
    stacked = till.unionByName(rent, allowMissingColumns=True).unionByName(dues, allowMissingColumns=True)
    sums = ("own_venue_revenue_kwd", "rental_revenue_kwd", "membership_mrr_kwd")
    out = first.join(stacked.groupBy("month_date_key").agg(*[F.max(c).alias(c) for c in sums]), "month_date_key")
    parts = {c: F.coalesce(c, F.lit(0)) for c in sums}
    return out.select(
        "month_date_key", "month_start", *[v.alias(k) for k, v in parts.items()],
        sum(parts.values(), F.lit(0).cast("decimal(22,6)")).alias("total_revenue_kwd"),
    )


def _slot_sums() -> list:
    marked = F.col("attended").isNotNull()
    return [
        F.count(F.lit(1)).alias("lesson_count"),
        F.sum("capacity").alias("total_capacity"),
        F.sum("booked").alias("total_booked"),
        F.sum("attended").alias("total_attended"),
        count_where(~marked).alias("missing_attendance_count"),
        count_where(F.col("is_overbooked")).alias("overbooked_count"),
        sum_where("booked", marked).alias("_marked_booked"),
    ]


SLOT_COLS = ["lesson_count", "total_capacity", "total_booked", "total_attended", "missing_attendance_count",
             "overbooked_count"]


def lesson_utilization(slots: DataFrame, instructor: DataFrame) -> DataFrame:
    """No-shows against everything booked, unmarked slots included."""
    sums = slots.groupBy("level", "instructor_key").agg(*_slot_sums())
    out = sums.join(instructor.select("instructor_key", "instructor_name"), "instructor_key", "left")
    absent = F.col("total_booked") - F.col("total_attended")
    return out.select(
        "level", "instructor_key", "instructor_name", *SLOT_COLS,
        pct("total_booked", "total_capacity", 1).alias("utilization_pct"),
        pct(absent, "total_booked", 1).alias("no_show_rate_pct"),
    )


def lesson_utilization_monthly(slots: DataFrame, instructor: DataFrame, date: DataFrame) -> DataFrame:
    """No-shows against marked slots only, unlike the view above."""
    day = _small(date.select("date_key", "full_date", (F.col("year") * 100 + F.col("month")).alias("month_key")))
    sums = slots.join(day, "date_key").groupBy("month_key", "level", "instructor_key").agg(
        F.min("full_date").alias("month_start"), *_slot_sums()
    )
    out = sums.join(instructor.select("instructor_key", "instructor_name"), "instructor_key", "left")
    absent = F.col("_marked_booked") - F.col("total_attended")
    return out.select(
        "month_key", "month_start", "level", "instructor_key", "instructor_name", *SLOT_COLS,
        pct("total_booked", "total_capacity", 1).alias("utilization_pct"),
        pct(absent, "_marked_booked", 1).alias("no_show_rate_pct"),
    )


def instructor_coverage(instructor: DataFrame, slots: DataFrame) -> DataFrame:
    """From the roster outward, so an instructor without lessons shows."""
    sums = slots.groupBy("instructor_key").agg(
        F.count(F.lit(1)).alias("lesson_count"), F.sum("capacity").alias("total_capacity"),
        F.sum("booked").alias("total_booked"),
    )
    out = instructor.join(sums, "instructor_key", "left")
    return out.select(
        "instructor_key", "instructor_id", "instructor_name", "specialty_level", "status", "hire_date",
        *[F.coalesce(c, F.lit(0)).alias(c) for c in ("lesson_count", "total_capacity", "total_booked")],
    )


def stable_occupancy(membership: DataFrame, stable: DataFrame, date: DataFrame) -> DataFrame:
    boarding = membership.filter((F.col("contract_type") == "horse_boarding") & (F.col("status") == "active"))
    per_box = boarding.groupBy("month_date_key", "stable_key").agg(F.sum("mrr_kwd").alias("mrr_kwd"))
    per_month = per_box.groupBy("month_date_key").agg(
        F.count("stable_key").alias("occupied_boxes"), F.sum("mrr_kwd").alias("boarding_revenue_kwd")
    )
    boxes = stable.agg(F.count(F.lit(1)).alias("total_boxes"))
    month = date.select(F.col("date_key").alias("month_date_key"), F.col("full_date").alias("month_start"))
    out = per_month.join(_small(month), "month_date_key").crossJoin(F.broadcast(boxes))  # one row
    return out.select(
        "month_date_key", "month_start", "occupied_boxes", "total_boxes",
        pct("occupied_boxes", "total_boxes", 1).alias("occupancy_pct"), "boarding_revenue_kwd",
    )


def footfall_gate_hour_monthly(footfall: DataFrame, gate: DataFrame, date: DataFrame) -> DataFrame:
    day = _small(date.select("date_key", month_start("full_date").alias("month_start")))
    first = _small(date.select(F.col("date_key").alias("month_date_key"), F.col("full_date").alias("month_start")))
    # day grain first: the distinct days of a cell become a plain count
    per_day = footfall.groupBy("gate_key", "hour", "date_key").agg(
        F.sum("count_in").alias("total"), F.count("count_in").alias("n"),
        F.bool_or("is_imputed").alias("is_imputed"), F.bool_or("is_outlier_corrected").alias("is_corrected"),
    )
    cells = per_day.join(day, "date_key").groupBy("gate_key", "month_start", "hour").agg(
        F.sum("total").alias("total_count_in"), F.sum("n").alias("_n"), F.count(F.lit(1)).alias("day_count"),
        F.bool_or("is_imputed").alias("has_imputed"), F.bool_or("is_corrected").alias("has_corrected"),
    )
    out = cells.join(first, "month_start").join(gate.select("gate_key", "gate_id", "gate_name"), "gate_key")
    average = F.col("total_count_in").cast("decimal(20,0)") / F.when(F.col("_n") > 0, F.col("_n")).cast("decimal(20,0)")
    return out.select(
        "gate_key", "gate_id", "gate_name", "month_date_key", "month_start", "hour",
        F.round(average, 1).alias("avg_count_in"), "total_count_in", "day_count", "has_imputed", "has_corrected",
    )


def build_views(dims: dict[str, DataFrame], facts: dict[str, DataFrame]) -> dict[str, DataFrame]:
    date, gate, venue, tenant = (dims[f"dim_{n}"] for n in ("date", "gate", "venue", "tenant"))
    instructor, channel = dims["dim_instructor"], dims["dim_channel"]
    foot, pos, rent = facts["fact_footfall"], facts["fact_pos_sales"], facts["fact_tenant_sales"]
    book, web = facts["fact_bookings"], facts["fact_web_sessions"]
    members, slots = facts["fact_membership_months"], facts["fact_lesson_slots"]
    return {
        "vw_footfall_daily": footfall_daily(foot, date, dims["dim_date_weather"]),
        "vw_footfall_by_zone": footfall_by_zone(foot, gate, date),
        "vw_footfall_sales_conversion": footfall_sales_conversion(foot, pos, gate, venue, date),
        "vw_event_roi": event_roi(dims["dim_event"], date, foot, pos),
        "vw_avg_transaction_value": avg_transaction_value(pos, venue),
        "vw_tenant_turnover_rent": turnover_rent(rent, tenant, date),
        "vw_tenant_sales_per_sqm": sales_per_sqm(rent, tenant, date),
        "vw_tenant_compliance": tenant_compliance(rent, tenant),
        "vw_ticket_channel_mix": ticket_channel_mix(book, pos, dims["dim_product"], venue),
        "vw_web_channel_conversion": web_channel_conversion(web, book, channel),
        "vw_web_channel_conversion_monthly": web_channel_conversion_monthly(web, book, channel, date),
        "vw_membership_active_churn": membership_active_churn(members, date),
        "vw_revenue_summary": revenue_summary(pos, rent, tenant, members, date),
        "vw_lesson_utilization": lesson_utilization(slots, instructor),
        "vw_lesson_utilization_monthly": lesson_utilization_monthly(slots, instructor, date),
        "vw_instructor_coverage": instructor_coverage(instructor, slots),
        "vw_stable_occupancy": stable_occupancy(members, dims["dim_stable"], date),
        "vw_tenant_site_metrics": tenant_site_metrics(rent, tenant, date),
        "vw_footfall_gate_hour_monthly": footfall_gate_hour_monthly(foot, gate, date),
    }
