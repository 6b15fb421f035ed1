import datetime as dt

import pytest

from plazaflow.functions.frames import literal_frame
from plazaflow.operators import facts as ft
from plazaflow.sources import exports

D = dt.date.fromisoformat
CONTRACT = {"contract_id": "string", "start_date": "date", "end_date": "date", "status": "string", "monthly_amount_kwd": "double"}


def explode(spark, start, end, status, amount=40.0):
    df = literal_frame(spark, [("C1", D(start), D(end) if end else None, status, amount)], CONTRACT)
    out = ft.with_contract_flags(ft.explode_contract_months(df, "2024-07-01", "2026-07-01"))
    return sorted(out.collect(), key=lambda r: r["month_date"])


def test_open_ended_runs_to_the_window_end(spark):
    rows = explode(spark, "2025-01-15", None, "active")
    assert (rows[0]["month_date"], rows[-1]["month_date"], len(rows)) == (D("2025-01-01"), D("2026-07-01"), 19)
    assert [r["is_new"] for r in rows] == [True] + [False] * 18 and not any(r["is_churned"] for r in rows)
    assert {r["monthly_amount_kwd"] for r in rows} == {40.0}


def test_cancelled_churns_once_at_its_end(spark):
    rows = explode(spark, "2025-01-15", "2025-04-20", "cancelled")
    churned = [r for r in rows if r["is_churned"]]
    assert rows[-1]["month_date"] == D("2025-04-01") and len(churned) == 1
    assert churned[0]["month_date"] == D("2025-04-01") and churned[0]["month_status"] == "cancelled"


def test_member_from_before_the_window_is_not_new(spark):
    (row,) = explode(spark, "2023-07-17", "2024-07-16", "expired")
    assert row["month_date"] == D("2024-07-01") and not row["is_new"] and row["is_churned"]


def test_same_month_is_new_and_churned(spark):
    (row,) = explode(spark, "2025-03-05", "2025-03-20", "cancelled")
    assert row["is_new"] and row["is_churned"]


def test_future_end_is_capped_without_churn(spark):
    rows = explode(spark, "2026-01-01", "2027-01-01", "active")
    assert rows[-1]["month_date"] == D("2026-07-01") and not any(r["is_churned"] for r in rows)


@pytest.mark.parametrize("start,end", [("2020-01-01", "2021-01-01"), ("2027-01-01", None), ("2025-05-01", "2025-03-01")])
def test_outside_the_window_or_reversed_gives_no_rows(spark, start, end):
    assert explode(spark, start, end, "active") == []


VERSION = {"tenant_key": "bigint", "tenant_id": "string", "valid_from": "date", "valid_to": "date"}


@pytest.mark.parametrize("tenant,month,keys", [
    ("T09", "2025-05-01", [108]), ("T09", "2025-06-01", [109]), ("T09", "2025-12-01", [109]), ("T09", "2026-06-01", [109]),
    ("T01", "2024-09-01", [201]), ("T01", "2020-01-01", []), ("T77", "2025-01-01", []),
])
def test_version_in_force_on_the_month(spark, tenant, month, keys):
    versions = literal_frame(spark, [
        (108, "T09", D("2023-08-01"), D("2025-05-31")), (109, "T09", D("2025-06-01"), None), (201, "T01", D("2023-08-01"), None),
    ], VERSION)
    sales = literal_frame(spark, [(tenant, D(month))], {"tenant_id": "string", "sales_month": "date"})
    assert [r["tenant_key"] for r in ft.join_version_asof(sales, versions).collect()] == keys


def test_snapshot_hides_an_end_that_lies_ahead(spark):
    contracts = literal_frame(spark, [("C1", D("2025-01-10"), D("2025-03-05"), "cancelled", D("2025-03-05"))], {
        "contract_id": "string", "start_date": "date", "end_date": "date", "status": "string", "cancellation_date": "date"})
    months = literal_frame(spark, [(D(f"2025-0{m}-01"),) for m in range(1, 6)], {"month_start": "date"})
    got = {str(r["month_start"]): (r["status"], r["end_date"]) for r in exports.snapshot_asof(contracts, months).collect()}
    assert got == {"2025-01-01": ("active", None), "2025-02-01": ("active", None), "2025-03-01": ("cancelled", D("2025-03-05"))}


@pytest.mark.parametrize("name,above,below", [
    ("ft9_membership_months", "Generate explode(", "Exchange hashpartitioning("),
    ("ft1_pos_sales", "Exchange hashpartitioning(item_id", "Exchange hashpartitioning(product_key"),
])
def test_names_are_resolved_before_the_rows_are_many(spark, name, above, below):
    from plazaflow.plans.bindings import Site
    from plazaflow.plans.catalog import QUERIES

    kept = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        plan = QUERIES[name](Site(spark, "/root/testdata/sf0.001"))._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", kept)
    assert plan.index(above) < plan.index(below)
