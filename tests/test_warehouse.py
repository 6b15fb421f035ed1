import datetime as dt
import json

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from plazaflow.operators import quality
from plazaflow.operators.silver import POS_DUPLICATE_KEY
from plazaflow.plans import warehouse
from plazaflow.sources import drops, exports, registry as reg
from plazaflow.sources.tables import Warehouse, read_daily, write_daily
from plazaflow.streaming import bronze

DAYS = [dt.date(2025, 1, 1) + dt.timedelta(days=i) for i in range(40)]


def put(root, source, name, lines):
    folder = root / source
    folder.mkdir(parents=True, exist_ok=True)
    (folder / name).write_text("\n".join(lines) + "\n")


def sale(i, day, qty="2", amount="9.0", item="P01"):
    return f"INV{i},SO{i},{day},{item},Ticket,{qty},4.5,{amount},KWD,SITE,V01,,cash,{day} 10:00:00"


POS_HEADER = "INVOICEID,SALESID,INVOICEDATE,ITEMID,ITEMNAME,QTY,SALESPRICE,LINEAMOUNT,CURRENCYCODE,INVENTSITEID,INVENTLOCATIONID,CUSTACCOUNT,PAYMENTMODE,CREATEDDATETIME"


def write_drops(root):
    for i, day in enumerate(DAYS):
        stamp = day.strftime("%Y%m%d")
        put(root, "pos_sales", f"d365_salesline_{stamp}.csv", [POS_HEADER, sale(i, day), sale(i, day)]
            + ([sale(1000 + i, day, "-1", "-4.5")] if i % 10 == 0 else []))
        gates = [f"G0{g},{'Main Gate' if g == 1 else f'GATE_{g}'},{day},10,{50 + i % 7},{40 + i % 5}" for g in range(1, 5)]
        if i == 20:
            gates[2] = f"G03,G3,{day},10,,"
        put(root, "footfall", f"footfall_{stamp}.csv", ["sensor_id,gate_name,date,hour,count_in,count_out", *gates])
        header, row = "date,channel,device,sessions,engaged_sessions,users", f"{day},organic,mobile,100,60,90"
        if i % 2:  # same columns, other order
            header, row = "channel,date,device,users,sessions,engaged_sessions", f"organic,{day},mobile,90,100,60"
        put(root, "web_sessions", f"web_sessions_{stamp}.csv", [header, row])
        put(root, "web_bookings", f"web_bookings_{stamp}.csv", [
            "booking_id,booking_datetime,product_code,qty,amount_kwd,channel,customer_id",
            f"B{i},{day} 12:00:00,playground_ticket,2,9.0,{'organic' if i % 4 else ''},C{i % 5}"])
        put(root, "weather", f"weather_{stamp}.csv", ["date,temp_max_c,temp_min_c,dust_storm_flag,rain_mm",
                                                      f"{day},20.5,9.0,{i % 9 == 0},0.0"])
        put(root, "lessons", f"lessons_{stamp}.csv", [
            "lesson_id,lesson_date,start_time,instructor_id,level,capacity,booked,attended,horse_ids",
            f'L{i},{day},08:00,I01,beginner,6,{6 + i % 2},{5 if i % 5 else ""},"H01,H02"'])
    put(root, "events", "events.csv", ["event_id,event_name,event_type,start_date,end_date,expected_attendance",
                                       "E1,Bazaar,bazaar,2025-01-20,2025-01-21,500", "E2,Broken,kids,2025-02-02,2025-02-01,100"])
    head = "contract_id,member_id,contract_type,venue_id,start_date,end_date,monthly_amount_kwd,status,cancellation_date,stable_id,phone_number"
    put(root, "contracts", "contracts_202501.csv", [head, "K1,M1,gym_monthly,V01,2025-01-05,,25,active,,,555",
                                                    "K2,M2,horse_boarding,V04,2025-01-05,,180,active,,S01,555"])
    put(root, "contracts", "contracts_202502.csv", [head, "K1,M1,gym_monthly,V01,2025-01-05,2025-02-03,25,cancelled,2025-02-03,,555"])
    put(root, "tenant_sales", "tenant_sales_t01_2025-01.csv", ["date,gross_sales", "2025-01-31,15000"])
    put(root, "tenant_sales", "tenant_sales_t01_2025-01_restated.csv", ["gross_sales,date", "16000,2025-01-31"])
    put(root, "tenant_sales", "tenant_sales_t02_2025-01.csv", ["date,net_sales", "10/01/2025,100", "17/01/2025,NA"])
    put(root, "tenant_sales", "_submission_manifest.csv", ["filename,tenant_id,month,submitted_date,is_restatement",
                                                           "tenant_sales_t01_2025-01.csv,T01,2025-01,2025-02-10,False",
                                                           "tenant_sales_t01_2025-01_restated.csv,T01,2025-01,2025-02-20,True"])
    master = {
        "venues": ["venue_id,venue_name,venue_type,opened_date,description"] + [f"V0{i},Venue {i},own,2023-08-01,x" for i in range(1, 5)],
        "gates": ["gate_id,gate_name,description"] + [f"G0{i},Gate {i},x" for i in range(1, 5)],
        "products": ["product_id,product_code,product_name,venue_id,category,unit_price_kwd",
                     "P01,playground_ticket_adult,Adult,V01,ticket,4.5", "P02,playground_ticket_child,Child,V01,ticket,none"],
        "tenants": ["tenant_id,tenant_name,category,unit_no,unit_sqm,lease_start,lease_end,base_rent_kwd,turnover_rent_pct,"
                    "turnover_threshold_kwd,status,effective_start_date,effective_end_date",
                    "T01,Grill,F&B,U-101,100,2023-08-01,,1800,8,12000,active,2023-08-01,",
                    "T02,Coffee,F&B,U-105,50,2023-08-01,,950,10,6000,active,2023-08-01,"],
        "stables": ["stable_id,box_no,size_category,status", "S01,B-01,standard,active", "S02,B-02,standard,active"],
        "instructors": ["instructor_id,instructor_name,specialty_level,hire_date,status", "I01,Ann,all,2023-09-01,active",
                        "I02,Ben,all,2023-09-01,active"],
    }
    for name, lines in master.items():  # horses.csv is missing on purpose
        put(root, "master_data", f"{name}.csv", lines)


@pytest.fixture(scope="module")
def built(spark, cfg, tmp_path_factory):
    root = tmp_path_factory.mktemp("site")
    config = {**cfg, "date_range": {"start": "2025-01-01", "end": "2025-02-09"}}
    config["site_plan"] = {**cfg["site_plan"], "terraces": [
        {"id": "t", "label": "T", "origin": [0, 0], "direction": "south", "units": ["U-101", "U-105"]}]}
    config["spatial"] = cfg["spatial"]
    write_drops(root / "drops")
    ok = warehouse.run(spark, config, str(root / "drops"), str(root / "wh"), "run-1")
    return Warehouse(spark, str(root / "wh")), root, config, ok


def test_both_gates_pass_and_all_checks_are_recorded(built):
    wh, _, _, ok = built
    checks = wh.read_table("dq", "check_results")
    failed = {r["check_name"] for r in checks.filter("status = 'fail'").collect()}
    assert ok and failed == set()
    assert checks.filter("check_name not like 'dim%key_unique'").count() == 31


def test_silver_keeps_everything_and_gold_leaves_duplicates_out(built):
    wh, *_ = built
    lines = wh.read_table("silver", "pos_sales_lines")
    assert lines.count() == 84 and lines.filter("is_duplicate").count() == 40
    assert wh.read_table("gold", "fact_pos_sales").count() == 44
    sessions = wh.read_table("silver", "web_sessions")
    assert sessions.filter("channel = 'organic' and sessions = 100 and users = 90").count() == 40
    gap = wh.read_table("silver", "footfall_hourly").filter("is_imputed").collect()
    assert [(r["gate_id"], r["count_in"] is not None) for r in gap] == [("G03", True)]


def test_filings_and_members(built):
    wh, *_ = built
    rows = {(r["tenant_id"], r["submission_version"]): r for r in wh.read_table("silver", "tenant_sales_monthly").collect()}
    assert rows["T01", 1]["days_late"] == 10 and rows["T01", 2]["is_restated"]
    assert rows["T02", 1]["net_sales_kwd"] == 100 and rows["T02", 1]["submitted_date"] is None
    current = wh.read_table("gold", "fact_tenant_sales").filter("is_current_version").collect()
    assert sorted(float(r["gross_sales_kwd"] or 0) for r in current) == [0.0, 16000.0]
    members = wh.read_table("gold", "dim_member").collect()
    assert [(m["member_id"], m["phone"]) for m in members] == [("M1", "555")]
    months = wh.read_table("gold", "fact_membership_months").groupBy("contract_id").count().collect()
    assert {m["contract_id"]: m["count"] for m in months} == {"K1": 2, "K2": 2}


def test_views_and_export(built):
    wh, root, config, _ = built
    views = warehouse.register_views(wh)
    rent = {r["tenant_id"]: r for r in views["vw_tenant_turnover_rent"].collect()}
    assert float(rent["T01"]["total_rent_owed_kwd"]) == 1800 + 4000 * 0.08 and float(rent["T02"]["turnover_rent_kwd"]) == 0
    roi = {r["event_id"]: r for r in wh.spark.sql("select * from vw_event_roi").collect()}
    assert roi["E1"]["event_day_count"] == 2 and roi["E1"]["baseline_avg_footfall"] is not None
    assert roi["E2"]["event_day_count"] is None and roi["E2"]["footfall_uplift_per_day"] is None
    manifest = {r["view"]: r["row_count"] for r in warehouse.export(wh, config, str(root / "out")).collect()}
    assert manifest["vw_footfall_daily"] == 40 and manifest["site_plan_units"] == 2 and manifest["dq_summary"] == 41
    lines = [json.loads(x) for f in (root / "out" / "vw_footfall_daily").glob("*.json") for x in f.read_text().splitlines()]
    assert len(lines) == 40 and all(r["footfall_year_ago"] is None and isinstance(r["full_date"], str) for r in lines)


def test_unchanged_files_are_skipped_and_a_changed_file_replaces_its_rows(built):
    wh, root, *_ = built
    before = wh.read_table("bronze", "pos_sales_raw").count()
    assert sum(warehouse.load_bronze(wh, str(root / "drops")).values()) == 0
    stamp = DAYS[3].strftime("%Y%m%d")
    put(root / "drops", "pos_sales", f"d365_salesline_{stamp}.csv", [POS_HEADER, sale(3, DAYS[3]), sale(77, DAYS[3]), sale(78, DAYS[3])])
    put(root / "drops", "pos_sales", "d365_salesline_20250301.csv", [POS_HEADER, sale(99, "2025-03-01")])
    assert warehouse.load_bronze(wh, str(root / "drops"))["pos_sales"] == 2
    raw = wh.read_table("bronze", "pos_sales_raw")
    assert raw.count() == before - 2 + 3 + 1
    assert raw.filter(F.col("_source_file").contains(stamp)).count() == 3
    entry = wh.read_table("bronze", "file_registry").filter(
        (F.col("source_name") == "pos_sales") & F.col("file_name").contains(stamp)).collect()
    assert len(entry) == 1 and entry[0]["row_count"] == 3


def test_silver_gate_stops_the_build(spark, built):
    wh, *_ = built
    lines = wh.read_table("silver", "pos_sales_lines").withColumn("is_duplicate", F.lit(False))
    checks = quality.stamp(quality.check_unique("dedup", lines, POS_DUPLICATE_KEY, ~F.col("is_duplicate"), "silver", "x"), "r")
    assert quality.has_critical_failures(checks)
    assert not quality.has_critical_failures(checks.filter("status = 'pass'"))


def test_metric_registry_rejects_unknown_metrics(cfg):
    views, off = exports.resolve_metrics({"metrics": {"enabled": ["event_roi"]}})
    assert views[0] == "vw_event_roi" and len(views) == 8 and len(off) == 11
    with pytest.raises(KeyError):
        exports.resolve_metrics({"metrics": {"enabled": ["nope"]}})
    assert len(exports.resolve_metrics(cfg)[0]) == 19


def test_daily_files_round_trip(spark, tmp_path):
    df = spark.createDataFrame([("a", "2025-01-01"), ("b", "2025-01-02"), (None, "2025-01-02")], "k string, d string")
    write_daily(df, "d", str(tmp_path / "daily"))
    assert {p.name for p in (tmp_path / "daily").iterdir() if p.is_dir()} == {"_date_key=20250101", "_date_key=20250102"}
    assert read_daily(spark, str(tmp_path / "daily"), ["k", "d"]).count() == 3


def test_registry_upsert_keeps_the_first_load_date(spark):
    base = ("s", "a.csv", "/a", dt.date(2020, 1, 1), 5, "x", "processed", dt.datetime(2020, 1, 1))
    known = spark.createDataFrame([base, ("s", "b.csv", "/b", dt.date(2020, 1, 1), 5, "x", "failed", dt.datetime(2020, 1, 1))],
                                  reg.REGISTRY_SCHEMA)
    files = spark.createDataFrame([("s", "a.csv", "/a", "x"), ("s", "b.csv", "/b", "x"), ("s", "c.csv", "/c", "z")],
                                  "source_name string, file_name string, path string, checksum string")
    todo = reg.files_to_load(files, known)
    assert {r["file_name"]: r["is_changed"] for r in todo.collect()} == {"b.csv": True, "c.csv": False}
    counts = spark.createDataFrame([("b.csv", 9)], "_source_file string, row_count bigint")
    got = {r["file_name"]: r for r in reg.upsert_registry(known, reg.loaded_entries(todo, counts)).collect()}
    assert got["b.csv"]["load_date"] == dt.date(2020, 1, 1) and got["b.csv"]["row_count"] == 9
    assert got["c.csv"]["row_count"] == 0 and got["a.csv"]["row_count"] == 5


def test_stream_lands_each_file_once(spark, tmp_path):
    put(tmp_path, "in", "weather_20250101.csv", ["date,temp_max_c", "2025-01-01,20"])
    schema = bronze.text_schema(["date", "temp_max_c"])

    def run():
        bronze.stream_bronze(spark, str(tmp_path / "in"), schema, str(tmp_path / "out"), str(tmp_path / "ck")).awaitTermination()
        return spark.read.parquet(str(tmp_path / "out"))

    assert run().count() == 1
    put(tmp_path, "in", "weather_20250202.csv", ["date,temp_max_c", "2025-02-02,21"])
    out = run()
    assert out.count() == 2
    assert {str(r["_drop_month"]) for r in out.select("_drop_month").collect()} == {"202501", "202502"}


def test_missing_texts_are_null(spark, tmp_path):
    put(tmp_path, "d", "x_20250101.csv", ["A,B", "NA,1", '"",n/a', "ok,null"])
    rows = drops.read_drop(spark, str(tmp_path / "d"), "x_*.csv").collect()
    assert sorted((r["a"] or "-", r["b"] or "-") for r in rows) == [("-", "-"), ("-", "1"), ("ok", "-")]
    assert {r["_source_file"] for r in rows} == {"x_20250101.csv"}


def test_keys_that_hardly_repeat_get_no_dictionary(spark, tmp_path):
    wh = Warehouse(spark, str(tmp_path))
    df = spark.sql("SELECT concat('K', id % 9) AS contract_id, id AS member_key, 20250101 AS month_date_key, 'gym' AS contract_type FROM range(2000)")
    stored = wh.replace_table("gold", "fact_membership_months", df)
    assert sorted(stored.collect()) == sorted(df.collect())
    for file in (tmp_path / "gold" / "fact_membership_months").rglob("*.parquet"):
        group = pq.ParquetFile(file).metadata.row_group(0)
        coded = {group.column(i).path_in_schema: any("DICTIONARY" in e for e in group.column(i).encodings) for i in range(group.num_columns)}
        assert coded == {"contract_id": False, "member_key": False, "month_date_key": True, "contract_type": True}
