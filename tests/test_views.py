import datetime as dt

import pytest
from pyspark.sql import functions as F

from plazaflow.functions.frames import literal_frame
from plazaflow.operators import calendar as cal, views

D = dt.date.fromisoformat


@pytest.fixture(scope="module")
def date(spark, cfg):
    return cal.dim_date(spark, {**cfg, "date_range": {"start": "2023-02-01", "end": "2024-03-31"}}).cache()


def key(day):
    return int(day.replace("-", ""))


def footfall(spark, per_day, gate=1):
    rows = [(key(d), gate, 10, n, False, False) for d, n in per_day.items()]
    return literal_frame(spark, rows, {"date_key": "int", "gate_key": "bigint", "hour": "int", "count_in": "int",
                                       "is_imputed": "boolean", "is_outlier_corrected": "boolean"})


def sales(spark, rows):
    return literal_frame(spark, rows, {"invoice_id": "string", "date_key": "int", "venue_key": "bigint", "product_key": "bigint",
                                       "qty": "double", "line_amount_kwd": "double", "is_refund": "boolean"})


def test_week_and_year_ago_go_by_date_over_gaps_and_leap_days(spark, date):
    foot = footfall(spark, {"2023-02-28": 5, "2024-02-21": 7, "2024-02-22": 8, "2024-02-28": 9, "2024-02-29": 10, "2024-03-08": 1})
    weather = literal_frame(spark, [], {"date_key": "int", "temp_max_c": "double", "temp_min_c": "double",
                                        "dust_storm_flag": "boolean", "rain_mm": "double"})
    got = {str(r["full_date"]): (r["footfall_week_ago"], r["footfall_year_ago"]) for r in views.footfall_daily(foot, date, weather).collect()}
    assert got == {"2023-02-28": (None, None), "2024-02-21": (None, None), "2024-02-22": (None, None),
                   "2024-02-28": (7, 5), "2024-02-29": (8, 5), "2024-03-08": (None, None)}


def test_event_baseline_skips_days_inside_any_event(spark, date):
    events = literal_frame(spark, [
        (1, "E1", "A", "x", D("2024-01-20"), D("2024-01-21"), 1), (2, "E2", "B", "x", D("2024-01-10"), None, 1),
        (3, "E3", "R", "x", D("2024-02-10"), D("2024-02-09"), 1), (4, "E4", "C", "x", D("2024-03-20"), D("2024-03-21"), 1),
        (5, "E5", "Cover", "x", D("2024-03-01"), D("2024-03-19"), 1),
    ], {"event_key": "bigint", "event_id": "string", "event_name": "string", "event_type": "string", "start_date": "date",
        "end_date": "date", "expected_attendance": "int"})
    foot = footfall(spark, {"2024-01-10": 1000, "2024-01-11": 10, "2024-01-12": 20, "2024-01-20": 50, "2024-01-21": 70,
                            "2024-02-01": 4, "2024-03-20": 6})
    pos = sales(spark, [("I", key("2024-01-20"), 1, 1, 1.0, 30.0, False), ("I", key("2024-01-20"), 1, 1, -1.0, -9.0, True)])
    got = {r["event_id"]: r for r in views.event_roi(events, date, foot, pos).collect()}
    assert got["E1"]["event_day_count"] == 2 and got["E1"]["total_footfall"] == 120 and got["E1"]["total_sales_kwd"] == 30
    assert got["E1"]["baseline_avg_footfall"] == 15 and got["E1"]["footfall_uplift_per_day"] == 45
    assert got["E1"]["baseline_avg_sales_kwd"] is None and got["E1"]["sales_uplift_per_day_kwd"] is None
    assert got["E3"]["event_day_count"] is None and got["E3"]["baseline_avg_footfall"] == 4
    assert got["E4"]["baseline_avg_footfall"] is None and got["E4"]["event_day_count"] == 2


def test_average_transaction_counts_refunds_apart(spark):
    pos = sales(spark, [("a", 1, 1, 1, 1.0, 10.0, False), ("a", 1, 1, 1, 1.0, 20.0, False), ("b", 1, 1, 1, -1.0, -5.0, True),
                        ("c", 1, 1, 1, 1.0, 0.0, False)])
    venue = literal_frame(spark, [(1, "V01", "V", "own")], {"venue_key": "bigint", "venue_id": "string", "venue_name": "string", "venue_type": "string"})
    (row,) = views.avg_transaction_value(pos, venue).collect()
    assert (row["sale_invoice_count"], row["refund_invoice_count"], row["avg_transaction_value_kwd"], row["net_revenue_kwd"]) == (1, 1, 30, 25)


def test_bookings_without_channel_keep_a_row_without_rate(spark):
    channel = literal_frame(spark, [(1, "organic"), (2, "partner")], {"channel_key": "bigint", "channel_name": "string"})
    web = literal_frame(spark, [(1, 200, 90, 150)], {"channel_key": "bigint", "sessions": "int", "engaged_sessions": "int", "users": "int"})
    book = literal_frame(spark, [(1, 5.0, False), (1, -5.0, True), (None, 7.0, False), (2, 9.0, False)], {
        "channel_key": "bigint", "amount_kwd": "double", "is_cancelled": "boolean"})
    got = {r["channel_key"]: r for r in views.web_channel_conversion(web, book, channel).collect()}
    assert (got[1]["booking_count"], float(got[1]["conversion_rate_pct"])) == (1, 0.5)
    assert got[None]["channel_name"] == views.UNATTRIBUTED and got[None]["conversion_rate_pct"] is None
    assert got[2]["channel_name"] == views.UNATTRIBUTED and got[2]["sessions"] is None


def test_no_show_denominators_differ_on_purpose(spark, date):
    slots = literal_frame(spark, [("L1", key("2024-01-05"), 1, "beginner", 6, 6, 3, False), ("L2", key("2024-01-06"), 1, "beginner", 6, 4, None, False)], {
        "lesson_id": "string", "date_key": "int", "instructor_key": "bigint", "level": "string", "capacity": "int", "booked": "int",
        "attended": "int", "is_overbooked": "boolean"})
    coach = literal_frame(spark, [(1, "I1", "Ann"), (2, "I2", "Ben")], {"instructor_key": "bigint", "instructor_id": "string", "instructor_name": "string"})
    (whole,) = views.lesson_utilization(slots, coach).collect()
    (monthly,) = views.lesson_utilization_monthly(slots, coach, date).collect()
    assert float(whole["no_show_rate_pct"]) == 70.0 and float(monthly["no_show_rate_pct"]) == 50.0
    extra = coach.withColumns({c: F.lit("x") for c in ("specialty_level", "status", "hire_date")})
    assert {r["instructor_id"]: r["lesson_count"] for r in views.instructor_coverage(extra, slots).collect()} == {"I1": 2, "I2": 0}


def test_churn_is_over_the_month_before(spark, date):
    rows = [("A", key("2024-01-01"), "gym", "active", False, False, 5.0), ("B", key("2024-01-01"), "gym", "active", True, False, 5.0),
            ("A", key("2024-02-01"), "gym", "cancelled", False, True, 5.0), ("B", key("2024-02-01"), "gym", "active", False, False, 5.0)]
    fact = literal_frame(spark, rows, {"contract_id": "string", "month_date_key": "int", "contract_type": "string", "status": "string",
                                       "is_new": "boolean", "is_churned": "boolean", "mrr_kwd": "double"})
    got = sorted(views.membership_active_churn(fact, date).collect(), key=lambda r: r["month_start"])
    assert [(r["active_count"], r["churned_count"], r["churn_rate_pct"] and float(r["churn_rate_pct"]), r["active_mrr_kwd"]) for r in got] == [
        (2, 0, None, 10.0), (1, 1, 50.0, 5.0)]


def counted(spark, n, name, *cols):
    return spark.range(n).withColumnRenamed("id", name).select(*cols)


def test_revenue_reads_each_fact_once_and_keeps_months_of_one_stream(spark, date):
    day = lambda c: F.element_at(F.array(*[F.lit(key(d)) for d in ("2024-01-01", "2024-02-01", "2024-03-01", "2024-04-01")]), c.cast("int") + 1)
    pos = counted(spark, 2, "pos_row", day(F.col("pos_row")).alias("date_key"), F.lit(5).cast("decimal(12,3)").alias("line_amount_kwd"),
                  F.lit(False).alias("is_refund"))
    rent = counted(spark, 1, "rent_row", (F.col("rent_row") + 1).alias("tenant_key"), day(F.col("rent_row") + 2).alias("month_date_key"),
                   F.lit(True).alias("is_current_version"), F.lit(0).cast("decimal(12,3)").alias("gross_sales_kwd"),
                   F.lit(0).cast("decimal(12,3)").alias("net_sales_kwd"))
    money = lambda v: F.lit(v).cast("decimal(12,3)")
    tenant = spark.range(1).select((F.col("id") + 1).alias("tenant_key"), money(7).alias("base_rent_kwd"),
                                   money(100).alias("turnover_threshold_kwd"), F.lit(5).cast("decimal(5,2)").alias("turnover_rent_pct"))
    dues = counted(spark, 2, "dues_row", F.when(F.col("dues_row") == 0, day(F.col("dues_row") + 1)).alias("month_date_key"),
                   money(3).alias("mrr_kwd"), F.lit("active").alias("status"))
    out = views.revenue_summary(pos, rent, tenant, dues, date)
    got = {r.month_date_key: (float(r.own_venue_revenue_kwd), float(r.rental_revenue_kwd), float(r.membership_mrr_kwd), float(r.total_revenue_kwd))
           for r in out.collect()}
    assert got == {key("2024-01-01"): (5, 0, 0, 5), key("2024-02-01"): (5, 0, 3, 8), key("2024-03-01"): (0, 7, 0, 7)}
    plan = out._jdf.queryExecution().sparkPlan().toString()
    assert plan.count("Range (0, 2") == 2 and plan.count("Range (0, 1") == 2  # till and dues; rent and tenant


def test_till_lines_without_a_product_are_left_out_without_a_filter_on_the_lines(spark):
    """A filter on the product reached the lines as one on their item, so this view could not share their shuffles."""
    from plazaflow.plans.bindings import Site

    book = literal_frame(spark, [(3.0, None, 9.0, False), (4.0, 2, 8.0, False)], {
        "qty": "double", "product_key": "bigint", "amount_kwd": "double", "is_cancelled": "boolean"})
    pos = sales(spark, [("i", 20240101, 7, 1, 1.0, 5.0, False), ("j", 20240101, 7, None, 2.0, 7.0, False)])
    product = literal_frame(spark, [(1, "a", "A", "t", None), (2, "b", "B", "t", None)], {
        "product_key": "bigint", "product_code": "string", "product_name": "string", "category": "string", "venue_key": "bigint"})
    venue = literal_frame(spark, [(7, "V")], {"venue_key": "bigint", "venue_name": "string"})
    rows = views.ticket_channel_mix(book, pos, product, venue).collect()
    assert sorted((r.product_key, int(r.online_qty), int(r.walk_in_qty)) for r in rows) == [(1, 0, 1), (2, 4, 0)]
    plan = Site(spark, "/root/testdata/sf0.001").views["vw_ticket_channel_mix"]._jdf.queryExecution().optimizedPlan().toString()
    assert "Window [lag" in plan and "isnotnull(item_id" not in plan
