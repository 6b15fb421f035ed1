import datetime as dt
import statistics

import numpy as np
import pytest

from plazaflow.functions.frames import literal_frame
from plazaflow.operators import leasing_analytics as la, online_analytics as oa, quality as dq, recurring_analytics as ra
from plazaflow.operators import site_analytics as sa

D = dt.date.fromisoformat
SQM = {"tenant_key": "bigint", "category": "string", "sales_per_sqm": "double"}


def test_peer_gap_leaves_out_equal_values_and_sole_tenants(spark):
    rng = np.random.default_rng(1)
    rows = [(i, f"c{i % 3}", float(rng.integers(1, 12))) for i in range(80)] + [(90, "alone", 5.0), (91, "twins", 4.0), (92, "twins", 4.0)]
    rows += [(100 + i, "hot", 7.0) for i in range(60)] + [(170, "hot", 9.0)]
    got = {r["tenant_key"]: r for r in la.with_peer_gap(literal_frame(spark, rows, SQM)).collect()}
    assert len(got) == len(rows)
    for key, category, value in rows:
        peers = [v for _, c, v in rows if c == category and v != value]
        assert got[key]["peer_count"] == len(peers), key
        want = (value / statistics.median(peers) - 1) * 100 if peers else None
        assert got[key]["vs_category_pct"] == (pytest.approx(want) if peers else None), key


@pytest.mark.parametrize("values", [[3.0], [1.0, 5.0], [2.0, 2.0, 9.0, 4.0], list(np.arange(31.0))])
def test_overall_median(spark, values):
    df = literal_frame(spark, [(i, "c", v) for i, v in enumerate(values)], SQM)
    (row,) = la.sqm_median(df).collect()
    assert row["all_median"] == statistics.median(values)


def test_rank_buckets_split_seven_into_five(spark):
    df = literal_frame(spark, [(f"U{i}", float(i)) for i in range(7)] + [("none", None)], {"unit_no": "string", "value": "double"})
    got = {r["unit_no"]: r["bucket"] for r in sa.rank_buckets(df).collect()}
    assert got == {f"U{i}": min(4, i * 5 // 7) + 1 for i in range(7)}


def test_correlation_needs_three_pairs_and_spread(spark):
    months = [D(f"2025-0{m}-01") for m in range(1, 6)]
    foot = literal_frame(spark, [(m, 100 * i) for i, m in enumerate(months[:4])], {"month_start": "date", "footfall": "bigint"})
    rows = [(1, 10.0, m, float(i * 3)) for i, m in enumerate(months)] + [(2, 10.0, m, 5.0) for m in months]
    rows += [(3, 10.0, months[0], 1.0), (3, 10.0, months[1], 2.0), (4, 0.0, months[0], 1.0)]
    df = literal_frame(spark, rows, {"tenant_key": "bigint", "unit_sqm": "double", "month_start": "date", "sales_kwd": "double"})
    got = {r["tenant_key"]: r["footfall_correlation"] for r in la.with_footfall_corr(df, foot).collect()}
    assert got == {1: pytest.approx(1.0), 2: None, 3: None}


def test_compliance_merges_versions_by_weight(spark):
    df = literal_frame(spark, [(1, "T9", "Nine", "old", 11, 10.0, 20, 1), (2, "T9", "Nine", "new", 13, 20.0, 30, 2), (3, "T1", "One", "x", 4, -3.0, -1, 0)], {
        "tenant_key": "bigint", "tenant_id": "string", "tenant_name": "string", "category": "string", "submission_count": "bigint",
        "avg_days_late": "double", "max_days_late": "int", "restated_count": "bigint"})
    got = {r["tenant_id"]: r for r in la.merge_compliance(df).collect()}
    assert got["T9"]["category"] == "new" and got["T9"]["merged"] and got["T9"]["max_days_late"] == 30
    assert got["T9"]["avg_days_late"] == pytest.approx((110 + 260) / 24) and got["T9"]["restated_pct"] == 12.5
    assert got["T1"]["max_days_late"] == -1 and not got["T1"]["merged"]


def test_channel_trend_ignores_thin_months(spark):
    rows = [(202500 + m, None, "paid", 2000, 10, float(rate)) for m, rate in enumerate([6, 5, 4, 3, 2, 1], 1)]
    rows += [(202507, None, "paid", 10, 5, 50.0), (202501, None, "lost", None, 9, None)]
    df = literal_frame(spark, rows, {"month_key": "bigint", "month_start": "date", "channel_name": "string", "sessions": "int",
                                     "booking_count": "bigint", "conversion_rate_pct": "double"})
    (row,) = oa.flag_decay(oa.channel_series(df)).collect()
    assert (row["channel_name"], row["first_pct"], row["last_pct"], row["decaying"]) == ("paid", 5.0, 2.0, True)
    assert row["change_pct"] == pytest.approx(-60.0)


LESSON = {"month_key": "int", "month_start": "date", "level": "string", "total_capacity": "bigint", "total_booked": "bigint"}


def test_squeeze_measures_the_empty_level_in_the_full_ones_peak(spark):
    rows = [(202501, D("2025-01-01"), "beginner", 100, 98), (202502, D("2025-02-01"), "beginner", 100, 50),
            (202501, D("2025-01-01"), "advanced", 100, 40), (202502, D("2025-02-01"), "advanced", 100, 90)]
    (row,) = ra.capacity_squeeze(literal_frame(spark, rows, LESSON)).collect()
    assert (row["full_level"], row["empty_level"], row["full_peak_pct"], row["empty_at_full_peak_pct"]) == ("beginner", "advanced", 98.0, 40.0)
    assert ra.capacity_squeeze(literal_frame(spark, rows[1:], LESSON)).count() == 0


def test_membership_churn_is_weighted_by_exposure(spark):
    rows = [(20250101, D("2025-01-01"), "gym", 600, 9, 1.0), (20250201, D("2025-02-01"), "gym", 300, 30, 2.0), (20250301, D("2025-03-01"), "gym", 310, 3, 3.0)]
    df = literal_frame(spark, rows, {"month_date_key": "int", "month_start": "date", "contract_type": "string", "active_count": "bigint",
                                     "churned_count": "bigint", "active_mrr_kwd": "double"})
    (row,) = ra.membership_series(df).collect()
    assert row["churn_pct"] == pytest.approx(33 / 900 * 100) and (row["latest_active"], row["latest_mrr"], row["net_change"]) == (310, 3.0, -290)


def test_layout_runs_along_the_terrace_and_fails_on_unknown_units(spark, cfg):
    tenants = literal_frame(spark, [("U-1", "T1", "A", "c", "active", 100.0, True), ("U-2", "T2", "B", "c", "active", 50.0, True)], {
        "unit_no": "string", "tenant_id": "string", "tenant_name": "string", "category": "string", "status": "string",
        "unit_sqm": "double", "is_current": "boolean"})
    plan = [{"id": "t", "label": "T", "origin": [10, 20], "direction": "south", "units": ["U-1", "U-2"]}]
    got = {r["unit_no"]: r for r in sa.unit_layout(tenants, sa.terrace_frame(spark, plan), 30, 60).collect()}
    assert (got["U-1"]["x"], got["U-1"]["y"], got["U-1"]["width"], got["U-1"]["height"]) == (10, 20, 60, 50)
    assert (got["U-2"]["y"], got["U-2"]["height"]) == (70, 25)
    broken = sa.terrace_frame(spark, [{**plan[0], "units": ["U-1", "U-9"]}])
    with pytest.raises(Exception, match="unknown unit U-9"):
        sa.unit_layout(tenants, broken, 30, 60).collect()


def test_freshness_and_severity(spark):
    df = literal_frame(spark, [(D("2025-01-01"),)], {"d": "date"})
    checks = dq.check_freshness("old", df, "d", "2025-01-09").unionByName(dq.check_freshness("ok", df, "d", "2025-01-08")).unionByName(
        dq.check_freshness("empty", df.filter("false"), "d", "2025-01-08")).unionByName(dq.check_freshness("ahead", df, "d", "2024-01-01"))
    rows = {r["check_name"]: r for r in dq.stamp(checks, "r").collect()}
    assert {k: r["status"] for k, r in rows.items()} == {"old": "fail", "ok": "pass", "empty": "fail", "ahead": "pass"}
    assert {r["severity"] for r in rows.values()} == {"warning"}


def test_foreign_key_check_ignores_nulls_and_counts_rows(spark):
    fact = literal_frame(spark, [(1,), (1,), (2,), (2,), (None,)], {"k": "bigint"})
    dim = literal_frame(spark, [(1,)], {"k": "bigint"})
    (row,) = dq.check_fk("fk", fact, "k", dim, "k").collect()
    assert (row["status"], row["actual_value"]) == ("fail", "2")
