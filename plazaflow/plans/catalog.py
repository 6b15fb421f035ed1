"""Every operator as a query over the supplied tables, with the SQL that must agree.

Results carry natural keys: surrogate keys are resolved back through their dimension,
which also proves the lookup. Values come out as plain types (see `plain`).
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F

from plazaflow.functions.columns import parse_mixed_dates, try_number
from plazaflow.operators import views as view_ops
from plazaflow.operators import (
    calendar as cal, dims as dm, facts as ft, footfall_analytics as fa, footfall_cleaning as fc,
    leasing_analytics as la, online_analytics as oa, quality as dq, recurring_analytics as ra, silver as sv,
    site_analytics as sa,
)
from plazaflow.plans import warehouse
from plazaflow.plans.bindings import CONFIG, END, START, Site
from plazaflow.plans.oracle import compose, pct
from plazaflow.session import shared_dir
from plazaflow.sources import drops, exports, registry as reg, tables
from plazaflow.streaming import bronze

RANGE = ("1996-03-01", "1999-09-30")
IN_RANGE = "BETWEEN DATE '1996-03-01' AND DATE '1999-09-30'"
SURROGATES = {"tenant_key", "venue_key", "product_key", "gate_key", "member_key", "stable_key", "event_key",
              "channel_key", "customer_key", "instructor_key"}

QUERIES: dict[str, Callable[[Site], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(build: Callable[[Site], DataFrame]):
        QUERIES[name] = build
        if sql is not None:
            ORACLE[name] = compose(sql)
        return build

    return register


def plain(df: DataFrame) -> DataFrame:
    """Decimals as double, whole numbers as bigint, dates and times as text, arrays joined."""
    def one(name: str, kind: str) -> Column:
        c = F.col(f"`{name}`")
        if kind.startswith("decimal") or kind == "float":
            c = c.cast("double")
        elif kind in ("int", "smallint", "tinyint"):
            c = c.cast("bigint")
        elif kind == "date" or kind.startswith("timestamp"):
            c = c.cast("string")
        elif kind.startswith("array"):
            c = F.array_join(c, ",")
        return c.alias(name)

    return df.select(*[one(n, k) for n, k in df.dtypes if n not in SURROGATES])


def text(*cols: str) -> str:
    return ", ".join(f"CAST({c} AS VARCHAR) AS {c}" for c in cols)


def num(*cols: str) -> str:
    return ", ".join(f"CAST({c} AS DOUBLE) AS {c}" for c in cols)


def natural(df: DataFrame, dim: DataFrame, key: str, *cols: str) -> DataFrame:
    return df.join(dim.select(key, *cols), key, "left")


def order_days(site: Site) -> DataFrame:
    return site.table("orders").groupBy(F.col("o_orderdate").cast("date").alias("full_date")).agg(
        F.count(F.lit(1)).alias("orders"),
        F.sum(F.col("o_totalprice").cast("decimal(12,2)")).alias("revenue"),
    )


ORDER_DAYS = """(SELECT CAST(o_orderdate AS DATE) AS full_date, count(*) AS orders,
    CAST(sum(CAST(o_totalprice AS DECIMAL(12,2))) AS DOUBLE) AS revenue FROM orders GROUP BY 1)"""


# ---- calendar

@query("c1_date_spine", f"""SELECT {text('full_date')}, coalesce(orders, 0) AS orders
    FROM cal LEFT JOIN {ORDER_DAYS} USING (full_date)""")
def _(s):
    spine = cal.date_spine(s.spark, START, END)
    return spine.join(order_days(s), "full_date", "left").select("full_date", F.coalesce("orders", F.lit(0)).alias("orders"))


@query("c2_calendar_columns", f"""SELECT CAST(strftime(full_date, '%Y%m%d') AS BIGINT) AS date_key, {text('full_date')},
    year(full_date) AS year, quarter(full_date) AS quarter, month(full_date) AS month, monthname(full_date) AS month_name,
    day(full_date) AS day, isodow(full_date) AS day_of_week, dayname(full_date) AS day_name, orders FROM {ORDER_DAYS}""")
def _(s):
    return cal.calendar_columns(order_days(s).drop("revenue"))


@query("c3_weekend", f"""SELECT {text('full_date')}, revenue, dayname(full_date) IN ('Friday', 'Saturday') AS is_weekend
    FROM {ORDER_DAYS}""")
def _(s):
    return cal.with_weekend(order_days(s).drop("orders"), "full_date", ["FRI", "SATURDAY"])


@query("c4_period_flag", f"""SELECT {text('d.full_date')}, revenue, is_ramadan FROM {ORDER_DAYS} d
    JOIN cal ON cal.full_date = d.full_date""".replace("CAST(d.full_date AS VARCHAR) AS d.full_date",
                                                       "CAST(d.full_date AS VARCHAR) AS full_date"))
def _(s):
    ranges = [(p["start"], p["end"]) for p in CONFIG["calendar"]["ramadan_periods"]]
    return cal.with_period_flag(order_days(s).drop("orders"), "full_date", ranges, "is_ramadan")


@query("c5_holidays", f"""SELECT CAST(d.full_date AS VARCHAR) AS full_date, revenue, holiday_name,
    holiday_name IS NOT NULL AS is_public_holiday FROM {ORDER_DAYS} d JOIN cal ON cal.full_date = d.full_date""")
def _(s):
    return cal.with_holidays(order_days(s).drop("orders"), cal.holiday_frame(s.spark, CONFIG))


@query("c6_season", f"""SELECT CAST(d.full_date AS VARCHAR) AS full_date, revenue, season FROM {ORDER_DAYS} d
    JOIN cal ON cal.full_date = d.full_date""")
def _(s):
    return cal.with_season(order_days(s).drop("orders"), "full_date", CONFIG["calendar"]["season_boundaries"])


@query("c7_seasonality_factor", f"""WITH a(x, y) AS (VALUES (0/365.0, 1.35), (89/365.0, 1.30), (104/365.0, 0.85),
      (134/365.0, 0.55), (151/365.0, 0.35), (242/365.0, 0.35), (257/365.0, 0.55), (273/365.0, 0.90), (287/365.0, 1.35),
      (1.0, 1.35)),
    seg AS (SELECT CAST(x AS DOUBLE) AS x0, CAST(y AS DOUBLE) AS y0, CAST(lead(x) OVER (ORDER BY x) AS DOUBLE) AS x1,
      CAST(lead(y) OVER (ORDER BY x) AS DOUBLE) AS y1 FROM a),
    d AS (SELECT *, (dayofyear(full_date) - 1) / CAST(dayofyear(make_date(year(full_date), 12, 31)) AS DOUBLE) AS f
      FROM {ORDER_DAYS})
    SELECT CAST(full_date AS VARCHAR) AS full_date, round((y1 - y0) / (x1 - x0) * (f - x0) + y0, 6) AS seasonality_factor,
      round(revenue / ((y1 - y0) / (x1 - x0) * (f - x0) + y0), 2) AS deseasonalised
    FROM d JOIN seg ON f >= x0 AND f < x1""")
def _(s):
    anchors = cal.anchor_frame(s.spark, CONFIG["seasonality"]["park"])
    out = cal.seasonality_factor(order_days(s), "full_date", anchors)
    return out.select(
        "full_date", F.round("seasonality_factor", 6).alias("seasonality_factor"),
        F.round(F.col("revenue").cast("double") / F.col("seasonality_factor"), 2).alias("deseasonalised"),
    )


@query("c8_normalised_shares", """WITH h AS (SELECT event_type, hour(ts) AS hour, count(*) AS n FROM events GROUP BY 1, 2)
    SELECT event_type, hour, n, CAST(n AS DOUBLE) / CAST(sum(n) OVER (PARTITION BY event_type) AS DOUBLE) AS share FROM h""")
def _(s):
    hours = s.table("events").groupBy("event_type", F.hour("ts").alias("hour")).agg(F.count(F.lit(1)).alias("n"))
    return cal.normalised_shares(hours, ["event_type"], "n")


@query("c9_date_weather", """SELECT date_key, temp_max_c, temp_min_c, dust_storm_flag, rain_mm FROM cal
    JOIN s_weather ON weather_date = full_date""")
def _(s):
    return s.dims["dim_date_weather"]


def ship_days(s: Site) -> DataFrame:
    """Calendar days of every order that is on the books."""
    days = order_days(s).select("full_date")
    return cal.with_season(days, "full_date", CONFIG["calendar"]["season_boundaries"])


CELLS = f"""(WITH d AS (SELECT c.full_date, c.month_start, c.season FROM cal c JOIN {ORDER_DAYS} o ON o.full_date = c.full_date),
    p AS (SELECT month_start, season, count(*) AS n, min(full_date) AS f, max(full_date) AS l FROM d GROUP BY 1, 2)
    SELECT month_start, max(l) AS month_end, arg_max(season, n * 100000 - (f - DATE '1970-01-01')) AS season,
      CAST(sum(n) AS BIGINT) AS day_count FROM p GROUP BY 1)"""


@query("c10_month_cells", f"SELECT {text('month_start', 'month_end')}, season, day_count FROM {CELLS} c, (SELECT 1 FROM cal LIMIT 1)")
def _(s):
    return cal.month_cells(ship_days(s))


@query("c11_partial_months", f"""SELECT {text('month_start')}, day_count, day_count < day(last_day(month_start)) AS is_partial
    FROM {CELLS} c, (SELECT 1 FROM cal LIMIT 1)""")
def _(s):
    return cal.with_partial_flag(cal.month_cells(ship_days(s))).select("month_start", "day_count", "is_partial")


@query("c12_months_to_range", f"""SELECT CAST(min(month_start) AS VARCHAR) AS start, CAST(max(month_end) AS VARCHAR) AS "end"
    FROM {CELLS} c, (SELECT 1 FROM cal LIMIT 1)""")
def _(s):
    return cal.months_to_range(cal.month_cells(ship_days(s)))


@query("c13_filter_dates", f"SELECT {text('full_date')}, orders, revenue FROM {ORDER_DAYS} WHERE full_date {IN_RANGE}")
def _(s):
    return cal.filter_dates(order_days(s), RANGE)


@query("c14_filter_months", f"SELECT {text('month_start')}, total_revenue_kwd FROM w13 WHERE month_start {IN_RANGE}")
def _(s):
    return cal.filter_months(s.views["vw_revenue_summary"], RANGE).select("month_start", "total_revenue_kwd")


@query("c15_filter_month_key", """SELECT month_key, channel_name, booking_count FROM w11
    WHERE month_key BETWEEN 199903 AND 200006""")
def _(s):
    rows = cal.filter_month_key(s.views["vw_web_channel_conversion_monthly"], ("1999-03-01", "2000-06-30"))
    return rows.select("month_key", "channel_name", "booking_count")


@query("c16_months_overlapping", f"""SELECT {text('month_start')} FROM {CELLS} c, (SELECT 1 FROM cal LIMIT 1)
    WHERE month_start <= DATE '1999-09-10' AND month_end >= DATE '1996-03-15'""")
def _(s):
    return cal.months_overlapping(cal.month_cells(ship_days(s)), ("1996-03-15", "1999-09-10"))


# ---- landing

def scratch(s: Site, name: str) -> str:
    return f"{shared_dir(s.spark)}/{name}-{uuid.uuid4().hex}"


BOOKING_COLS = drops.COLUMNS["web_bookings"].split()
BOOKING_SQL = """SELECT booking_id, CAST(booking_date AS VARCHAR) || ' ' || booking_time AS booking_datetime, product_code,
    CAST(qty AS DOUBLE) AS qty, CAST(amount_kwd AS DOUBLE) AS amount_kwd, channel, customer_id FROM s_booking"""


@query("s1_read_drop", BOOKING_SQL)
def _(s):
    folder = scratch(s, "drop")
    s.landed["web_bookings"].select(*[F.col(c).alias(c.upper()) for c in BOOKING_COLS]).write.option("header", True).csv(folder)
    read = drops.read_drop(s.spark, folder, "*.csv", BOOKING_COLS)
    return read.withColumns({"qty": F.col("qty").cast("double"), "amount_kwd": F.col("amount_kwd").cast("double")}).drop(
        "_source_file")


@query("s2_master_read", f"SELECT product_id, product_code, product_name, venue_id, category, {num('unit_price_kwd')} FROM d_product")
def _(s):
    folder, columns = scratch(s, "master"), list(sv.MASTER_SCHEMAS["products"])
    s.landed["master_products"].select(*columns).write.option("header", True).csv(folder)
    return sv.cast_table(drops.read_drop(s.spark, folder, "*.csv", columns), sv.MASTER_SCHEMAS["products"]).drop("_source_file")


@query("s11_append_results", """SELECT run_id, CASE WHEN run_id = 'run-1' THEN count(*) FILTER (WHERE booked > capacity)
    ELSE count(*) FILTER (WHERE attended > booked) END AS violations FROM s_lesson, (VALUES ('run-1'), ('run-2')) r(run_id) GROUP BY 1""")
def _(s):
    wh, slots = tables.Warehouse(s.spark, scratch(s, "audit")), s.silver["lesson_slots"]
    for run, violation in (("run-1", F.col("booked") > F.col("capacity")), ("run-2", F.col("attended") > F.col("booked"))):
        wh.append_results("check_results", dq.stamp(dq.check_range("range", slots, violation, "lesson_slots"), run))
    kept = wh.read_table("dq", "check_results")
    return kept.select("run_id", F.col("actual_value").cast("bigint").alias("violations"))


@query("s12_write_daily", "SELECT strftime(ts, '%Y%m%d') AS day, count(*) AS n, count(DISTINCT user_id) AS users FROM events GROUP BY 1")
def _(s):
    folder = scratch(s, "daily")
    tables.write_daily(s.table("events").select("event_id", "user_id", "ts"), "ts", folder)
    back = tables.read_daily(s.spark, folder, ["event_id", "user_id", "ts"])
    return back.groupBy(F.col("_date_key").alias("day")).agg(
        F.count(F.lit(1)).alias("n"), F.count_distinct("user_id").alias("users"))


def filings_as_read(s: Site) -> DataFrame:
    return s.landed["tenant_sales"].select(
        F.col("date_raw").alias("date"), F.col("gross_sales_raw").alias("gross_sales"),
        F.col("net_sales_raw").alias("net_sales"), "_source_file")


@query("s3_tenant_files", """SELECT tenant_id, strftime(sales_month, '%Y-%m') AS sales_month, v = 2 AS is_restatement,
    count(*) AS n, CAST(sum(gross_sales) AS DOUBLE) AS gross FROM r_filing GROUP BY 1, 2, 3""")
def _(s):
    named = drops.with_filing_name(filings_as_read(s))
    return named.groupBy("tenant_id", "sales_month", "is_restatement").agg(
        F.count(F.lit(1)).alias("n"), F.sum(try_number("gross_sales_raw", "decimal(12,2)")).alias("gross"))


@query("s4_attach_manifest", f"""SELECT tenant_id, strftime(sales_month, '%Y-%m') AS sales_month, v = 2 AS is_restatement,
    {text('submitted_date')}, count(*) AS n FROM r_filing GROUP BY tenant_id, r_filing.sales_month, v, r_filing.submitted_date""")
def _(s):
    landed = s.landed["tenant_sales"]
    manifest = landed.select(F.col("_source_file").alias("filename"), "submitted_date").distinct()
    named = drops.attach_manifest(landed.drop("submitted_date"), manifest)
    return named.groupBy("tenant_id", "sales_month", "is_restatement", "submitted_date").agg(F.count(F.lit(1)).alias("n"))


TEXT_CELLS = """SELECT doc_id, text, replace(coalesce(source, ''), 'src', 'a \\"b\\" ') AS note FROM documents""".replace("\\", "")


def _landed_sql(name: str) -> str:
    """A cell as a drop lands it: null when its text counts as missing."""
    listed = ", ".join("'" + m.replace("'", "''") + "'" for m in drops.MISSING)
    return f"CASE WHEN {name} IN ({listed}) THEN NULL ELSE {name} END"


@query("s3_quoted_cells", f"""SELECT CAST(doc_id AS VARCHAR) AS doc_id, length(t) AS n_chars, md5(t) AS digest, n AS note
    FROM (SELECT doc_id, {_landed_sql('text')} AS t, {_landed_sql('note')} AS n FROM ({TEXT_CELLS}))""")
def _(s):
    """Whole document texts as cells, null and empty ones too: quotes, line breaks, commas and backslashes come back as
    they went; a null, empty or missing-marker cell lands as null (n_chars and digest null)."""
    folder, columns = scratch(s, "quoted"), ["doc_id", "text", "note"]
    note = F.replace(F.coalesce("source", F.lit("")), F.lit("src"), F.lit('a "b" '))
    cells = s.table("documents").select(F.col("doc_id").cast("string").alias("doc_id"), "text", note.alias("note"))
    cells.write.options(**drops.CSV_OPTIONS).option("quoteAll", True).option("ignoreLeadingWhiteSpace", False).option(
        "ignoreTrailingWhiteSpace", False).csv(folder)
    read = drops.read_drop(s.spark, folder, "*.csv", columns, multi_line=True)
    return read.select("doc_id", F.length("text").cast("bigint").alias("n_chars"), F.md5(F.col("text").cast("binary")).alias("digest"), "note")


FILES = "SELECT doc_id, source AS source_name, 'doc_' || doc_id || '.csv' AS file_name, md5(text) AS checksum FROM documents"


def document_files(s: Site) -> DataFrame:
    return s.table("documents").select(
        "doc_id", F.col("source").alias("source_name"),
        F.concat(F.lit("doc_"), F.col("doc_id").cast("string"), F.lit(".csv")).alias("file_name"),
        F.md5(F.col("text").cast("binary")).alias("checksum"), F.lit("-").alias("path"))


def known_files(s: Site) -> DataFrame:
    """A registry that knows two thirds of the files: half with an older content, some unfinished."""
    d = F.col("doc_id")
    return document_files(s).filter(d % 3 != 0).select(
        "source_name", "file_name", F.col("path").alias("file_path"), F.lit("2024-01-01").cast("date").alias("load_date"),
        F.lit(5).cast("bigint").alias("row_count"), F.when(d % 3 == 1, F.col("checksum")).otherwise("old").alias("checksum"),
        F.when(d % 7 == 0, "failed").otherwise("processed").alias("status"),
        F.lit("2024-01-01 00:00:00").cast("timestamp").alias("processed_at"))


@query("s5_files_to_load", f"""SELECT source_name, file_name, checksum, doc_id % 3 <> 0 AS is_changed FROM ({FILES})
    WHERE NOT (doc_id % 3 = 1 AND doc_id % 7 <> 0)""")
def _(s):
    return reg.files_to_load(document_files(s), known_files(s)).select("source_name", "file_name", "checksum", "is_changed")


def dated(df: DataFrame) -> DataFrame:
    return reg.with_drop_month(df)


@query("s6_merge_files", """WITH t AS (SELECT *, o_orderkey % 5 = 0 AS arrives, strftime(o_orderdate, '%Y%m') AS m FROM orders),
    touched AS (SELECT DISTINCT m FROM t WHERE day(o_orderdate) = 3), r AS (
      SELECT 'old' AS version, m, CAST(o_orderdate AS DATE) AS d FROM t
        WHERE m IN (SELECT m FROM touched) AND day(o_orderdate) <> 3
      UNION ALL SELECT 'new', m, CAST(o_orderdate AS DATE) FROM t WHERE day(o_orderdate) = 3 AND arrives)
    SELECT m AS drop_month, version, count(*) AS n, count(DISTINCT d) AS days FROM r GROUP BY 1, 2""")
def _(s):
    day = F.date_format("o_orderdate", "yyyyMMdd")
    rows = s.table("orders").select(
        "o_orderkey", F.concat(F.lit("orders_"), day, F.lit(".csv")).alias("_source_file"), F.dayofmonth("o_orderdate").alias("dom"))
    target = dated(rows).withColumn("version", F.lit("old"))
    third = rows.filter("dom = 3")
    new = dated(third.filter("o_orderkey % 5 = 0")).withColumn("version", F.lit("new"))
    todo = third.select(F.col("_source_file").alias("file_name"), F.lit(True).alias("is_changed")).distinct()
    merged = reg.merge_files(target, new, todo)
    return merged.groupBy(F.col("_drop_month").alias("drop_month"), "version").agg(
        F.count(F.lit(1)).alias("n"), F.count_distinct("_source_file").alias("days"))


@query("s7_upsert_registry", f"""SELECT source_name, file_name, CASE WHEN doc_id % 3 = 1 AND doc_id % 7 <> 0 THEN 5 ELSE 9 END AS row_count,
    checksum, 'processed' AS status FROM ({FILES})""")
def _(s):
    todo = reg.files_to_load(document_files(s), known_files(s))
    counts = todo.select(F.col("file_name").alias("_source_file"), F.lit(9).alias("row_count"))
    loaded = reg.loaded_entries(todo, counts)
    return reg.upsert_registry(known_files(s), loaded).select("source_name", "file_name", "row_count", "checksum", "status")


@query("s8_file_row_counts", "SELECT source_file AS _source_file, count(*) AS row_count FROM s_pos GROUP BY 1")
def _(s):
    return reg.file_row_counts(s.landed["pos_sales"])


@query("s9_full_scan", """SELECT l_returnflag, l_linestatus, count(*) AS n, count(DISTINCT l_orderkey) AS orders, max(l_partkey) AS part,
    max(l_suppkey) AS supp, max(l_linenumber) AS line, CAST(max(l_shipdate) AS DATE)::VARCHAR AS shipped, CAST(sum(CAST(l_quantity AS DECIMAL(12,2))) AS DOUBLE) AS quantity,
    CAST(sum(CAST(l_extendedprice AS DECIMAL(12,2))) AS DOUBLE) AS amount, CAST(sum(CAST(l_discount + l_tax AS DECIMAL(12,2))) AS DOUBLE) AS rates
    FROM lineitem GROUP BY 1, 2""")
def _(s):
    """Every column of the table, read through the warehouse."""
    lines = tables.Warehouse(s.spark, s.sf_dir).read_table(".", "lineitem.parquet")
    total = lambda c: F.sum(c.cast("decimal(12,2)"))
    return lines.groupBy("l_returnflag", "l_linestatus").agg(
        F.count(F.lit(1)).alias("n"), F.count_distinct("l_orderkey").alias("orders"), F.max("l_partkey").alias("part"), F.max("l_suppkey").alias("supp"),
        F.max("l_linenumber").alias("line"), F.max(F.col("l_shipdate").cast("date")).alias("shipped"), total(F.col("l_quantity")).alias("quantity"),
        total(F.col("l_extendedprice")).alias("amount"), total(F.col("l_discount") + F.col("l_tax")).alias("rates"))


@query("s10_replace_table", "SELECT count(*) AS n, CAST(sum(line_amount_kwd) AS DOUBLE) AS amount FROM f_pos")
def _(s):
    wh = tables.Warehouse(s.spark, scratch(s, "warehouse"))
    stored = wh.replace_table("gold", "fact_pos_sales", s.facts["fact_pos_sales"])
    return stored.agg(F.count(F.lit(1)).alias("n"), F.sum("line_amount_kwd").alias("amount"))


@query("s13_json_records", f"SELECT {text('month_start')}, month_date_key, own_venue_revenue_kwd, rental_revenue_kwd, membership_mrr_kwd, total_revenue_kwd FROM w13")
def _(s):
    return exports.json_ready(s.views["vw_revenue_summary"])


@query("s16_latest_run", """SELECT 'run-' || turn AS run_id, role AS check_name, count(*) AS n FROM conversations
    WHERE turn = (SELECT max(turn) FROM conversations) GROUP BY 1, 2""")
def _(s):
    runs = s.table("conversations").select(
        F.concat(F.lit("run-"), F.col("turn").cast("string")).alias("run_id"), F.col("turn").alias("checked_at"),
        F.col("role").alias("check_name"), F.lit("error").alias("severity"), F.lit("pass").alias("status"))
    return exports.latest_run(runs).groupBy("run_id", "check_name").agg(F.count(F.lit(1)).alias("n"))


@query("s17_snapshot_asof", """WITH m AS (SELECT full_date AS month_start FROM cal WHERE day(full_date) = 1),
    x AS (SELECT c.*, month_start, end_date IS NULL OR end_date > last_day(month_start) AS open_still FROM s_contract c
      JOIN m ON start_date <= last_day(month_start) AND (end_date IS NULL OR end_date >= month_start))
    SELECT CAST(month_start AS VARCHAR) AS month_start, CASE WHEN open_still THEN 'active' ELSE status END AS status,
      count(*) AS n, count(CASE WHEN NOT open_still THEN end_date END) AS ended,
      count(CASE WHEN NOT open_still THEN cancellation_date END) AS cancelled FROM x GROUP BY 1, 2""")
def _(s):
    months = s.dims["dim_date"].filter("day = 1").select(F.col("full_date").alias("month_start"))
    return exports.snapshot_asof(s.silver["contracts"], months).groupBy("month_start", "status").agg(
        F.count(F.lit(1)).alias("n"), F.count("end_date").alias("ended"), F.count("cancellation_date").alias("cancelled"))


@query("st1_stream_bronze", "SELECT strftime(booking_date, '%Y%m') AS month, count(*) AS n, CAST(sum(amount_kwd) AS DOUBLE) AS amount FROM s_booking GROUP BY 1")
def _(s):
    folder, target = scratch(s, "stream-in"), scratch(s, "stream-out")
    s.landed["web_bookings"].select(*BOOKING_COLS).write.option("header", True).csv(folder)
    bronze.stream_bronze(
        s.spark, folder, bronze.text_schema(BOOKING_COLS), target, scratch(s, "stream-checkpoint")).awaitTermination()
    landed = s.spark.read.parquet(target)
    return landed.groupBy(F.date_format(F.col("booking_datetime").cast("timestamp"), "yyyyMM").alias("month")).agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.col("amount_kwd").cast("decimal(12,3)")).alias("amount"))


# ---- silver

POS_SQL = f"invoice_id, sales_id, {text('invoice_date')}, item_id, item_name, {num('qty', 'sales_price_kwd', 'line_amount_kwd')}, venue_id, cust_account, payment_mode, source_file AS _source_file"


@query("v1_pos_conform", f"SELECT {POS_SQL} FROM s_pos")
def _(s):
    return sv.pos_conform(s.landed["pos_sales"]).drop("created_datetime")


@query("v2_refund", "SELECT is_refund, count(*) AS n, CAST(sum(line_amount_kwd) AS DOUBLE) AS amount FROM s_pos GROUP BY 1")
def _(s):
    rows = sv.with_refund(sv.pos_conform(s.landed["pos_sales"]))
    return rows.groupBy("is_refund").agg(F.count(F.lit(1)).alias("n"), F.sum("line_amount_kwd").alias("amount"))


@query("v3_duplicate_flag", f"SELECT {POS_SQL}, is_refund, is_duplicate FROM s_pos")
def _(s):
    return s.silver["pos_sales_lines"].drop("created_datetime")


@query("v4_footfall_conform", f"""SELECT gate_id, {text('footfall_date')}, CAST(hour AS BIGINT) AS hour, {num('raw_in', 'raw_out')}, is_weekend
    FROM s_foot0""")
def _(s):
    rows = fc.footfall_conform(s.landed["footfall"], CONFIG["weekend"])
    return rows.select("gate_id", "footfall_date", "hour", F.col("count_in").alias("raw_in"), F.col("count_out").alias("raw_out"), "is_weekend")


@query("v5_conform_alias", f"""SELECT gate_id, {text('footfall_date')}, CAST(hour AS BIGINT) AS hour,
    CASE WHEN e % 31 = 7 THEN 'unrecognized_gate_name' WHEN e % 37 = 5 AND gate_id <> 'G01' THEN 'gate_name_conform_mismatch' ELSE '' END
      AS dq_flags FROM s_foot0""")
def _(s):
    rows = fc.conform_alias(fc.footfall_conform(s.landed["footfall"], CONFIG["weekend"]), fc.alias_frame(s.spark, CONFIG))
    return rows.select("gate_id", "footfall_date", "hour", F.col("_dq_flags").alias("dq_flags"))


@query("v6_impute_series", f"""SELECT gate_id, {text('footfall_date')}, CAST(hour AS BIGINT) AS hour, {num('fill_in', 'fill_out')}, is_imputed
    FROM s_foot1""")
def _(s):
    rows = fc.impute_series(fc.footfall_conform(s.landed["footfall"], CONFIG["weekend"]))
    return rows.select("gate_id", "footfall_date", "hour", F.col("count_in").alias("fill_in"), F.col("count_out").alias("fill_out"), "is_imputed")


@query("v7_correct_outliers", f"""SELECT gate_id, {text('footfall_date')}, CAST(hour AS BIGINT) AS hour, {num('count_in', 'count_out')},
    is_outlier_corrected FROM s_foot""")
def _(s):
    rows = fc.correct_outliers(fc.impute_series(fc.footfall_conform(s.landed["footfall"], CONFIG["weekend"])))
    return rows.select("gate_id", "footfall_date", "hour", "count_in", "count_out", "is_outlier_corrected")


@query("v8_footfall_counts", f"""SELECT gate_id, {text('footfall_date')}, CAST(hour AS BIGINT) AS hour, count_in, count_out, is_imputed,
    is_outlier_corrected FROM s_foot""")
def _(s):
    return s.silver["footfall_hourly"].select(
        "gate_id", "footfall_date", "hour", "count_in", "count_out", "is_imputed", "is_outlier_corrected")


@query("v9_parse_mixed_dates", f"SELECT {text('parsed_date')}, count(*) AS n FROM r_filing GROUP BY 1")
def _(s):
    return s.landed["tenant_sales"].groupBy(parse_mixed_dates("date_raw").alias("parsed_date")).agg(F.count(F.lit(1)).alias("n"))


@query("v10_try_number", """SELECT tenant_id, count(gross_sales) AS gross_n, count(net_sales) AS net_n, CAST(sum(gross_sales) AS DOUBLE) AS gross,
    CAST(sum(net_sales) AS DOUBLE) AS net FROM r_filing GROUP BY 1""")
def _(s):
    gross, net = try_number("gross_sales_raw", "decimal(12,3)"), try_number("net_sales_raw", "decimal(12,3)")
    return s.landed["tenant_sales"].groupBy("tenant_id").agg(
        F.count(gross).alias("gross_n"), F.count(net).alias("net_n"), F.sum(gross).alias("gross"), F.sum(net).alias("net"))


@query("v11_collapse_submissions", f"""SELECT tenant_id, strftime(sales_month, '%Y-%m') AS sales_month, v = 2 AS is_restatement,
    CAST(sum(gross_sales) AS DOUBLE) AS gross_sales_kwd, CAST(sum(net_sales) AS DOUBLE) AS net_sales_kwd,
    CAST(min(submitted_date) AS VARCHAR) AS submitted_date, count(*) FILTER (WHERE parsed_date IS NULL) AS unparsed_dates
    FROM r_filing GROUP BY 1, 2, 3""")
def _(s):
    return sv.collapse_submissions(s.landed["tenant_sales"]).drop("_source_file")


@query("v12_days_late", f"SELECT tenant_id, {text('sales_month', 'submitted_date')}, submission_version, days_late FROM s_filing")
def _(s):
    rows = sv.with_days_late(sv.collapse_submissions(s.landed["tenant_sales"]))
    version = F.when(F.col("is_restatement"), 2).otherwise(1)
    return rows.select("tenant_id", "sales_month", "submitted_date", version.alias("submission_version"), "days_late")


@query("v13_submission_flags", f"""SELECT tenant_id, {text('sales_month', 'submitted_date')}, {num('gross_sales_kwd', 'net_sales_kwd')},
    submission_version, days_late, is_restated, dq_flags FROM s_filing""")
def _(s):
    return s.silver["tenant_sales_monthly"].drop("_source_file").withColumnRenamed("_dq_flags", "dq_flags")


CONTRACT_SQL = f"contract_id, member_id, contract_type, venue_id, {text('start_date', 'end_date')}, {num('monthly_amount_kwd')}, status, {text('cancellation_date')}, stable_id, phone_number"


@query("v14_latest_snapshot", f"""SELECT {CONTRACT_SQL} FROM s_contract""")
def _(s):
    return sv.contracts_conform(sv.latest_snapshot(s.landed["contracts"])).drop("_source_file")


EARLY = "coalesce(cancellation_date < start_date, false)"
SHARED = """(phone_number IS NOT NULL AND min(member_id) OVER (PARTITION BY phone_number)
    <> max(member_id) OVER (PARTITION BY phone_number))"""


@query("v15_cancel_before_start", f"SELECT contract_id, {EARLY} AS cancellation_before_start FROM s_contract")
def _(s):
    rows = sv.flag_cancel_before_start(sv.contracts_conform(sv.latest_snapshot(s.landed["contracts"])))
    return rows.select("contract_id", "cancellation_before_start")


@query("v16_shared_phone", f"""SELECT contract_id, concat_ws(',', CASE WHEN {EARLY} THEN 'cancellation_before_start' END,
    CASE WHEN {SHARED} THEN 'shared_phone_across_members' END) AS dq_flags FROM s_contract""")
def _(s):
    return s.silver["contracts"].select("contract_id", F.col("_dq_flags").alias("dq_flags"))


@query("v17_lessons", f"""SELECT lesson_id, {text('lesson_date')}, start_time, instructor_id, level, capacity, booked, attended, horse_ids,
    is_overbooked FROM s_lesson""")
def _(s):
    return s.silver["lesson_slots"].drop("_source_file")


@query("v18_events", f"""SELECT event_id, event_name, event_type, {text('start_date', 'end_date')}, expected_attendance,
    CASE WHEN end_date < start_date THEN 'end_before_start' ELSE '' END AS dq_flags FROM d_event""")
def _(s):
    return s.silver["events"].drop("_source_file").withColumnRenamed("_dq_flags", "dq_flags")


@query("v19_weather", f"SELECT {text('weather_date')}, temp_max_c, temp_min_c, dust_storm_flag, rain_mm FROM s_weather")
def _(s):
    return s.silver["weather_daily"].drop("_source_file")


@query("v20_web_sessions", f"SELECT {text('session_date')}, channel, device, sessions, engaged_sessions, users FROM s_session")
def _(s):
    return s.silver["web_sessions"].drop("_source_file")


@query("v21_web_bookings", """SELECT booking_id, CAST(booking_date AS VARCHAR) || ' ' || booking_time AS booking_datetime, product_code,
    CAST(qty AS DOUBLE) AS qty, CAST(amount_kwd AS DOUBLE) AS amount_kwd, channel, customer_id, is_cancelled,
    CASE WHEN channel IS NULL THEN 'channel_missing' ELSE '' END AS dq_flags FROM s_booking""")
def _(s):
    return s.silver["web_bookings"].drop("_source_file").withColumnRenamed("_dq_flags", "dq_flags")


@query("v22_cast_tenants", f"""SELECT tenant_id, tenant_name, category, unit_no, {num('unit_sqm', 'base_rent_kwd', 'turnover_rent_pct', 'turnover_threshold_kwd')},
    '1994-01-01' AS lease_start, CAST(NULL AS VARCHAR) AS lease_end, status, CAST(valid_from AS VARCHAR) AS effective_start_date,
    CAST(valid_to AS VARCHAR) AS effective_end_date FROM d_tenant""")
def _(s):
    return s.silver["tenants"].drop("_source_file")


@query("v22_cast_products", f"SELECT product_id, product_code, product_name, venue_id, category, {num('unit_price_kwd')} FROM d_product")
def _(s):
    return s.silver["products"].drop("_source_file")


# ---- dimensions

@query("dm1_type1_event", f"SELECT event_id, event_name, event_type, {text('start_date', 'end_date')}, expected_attendance FROM d_event")
def _(s):
    return s.dims["dim_event"]


@query("dm2_product", f"""SELECT product_id, product_code, product_name, category, {num('unit_price_kwd')}, v.venue_id
    FROM d_product p LEFT JOIN d_venue v ON v.venue_id = p.venue_id""")
def _(s):
    return natural(s.dims["dim_product"], s.dims["dim_venue"], "venue_key", "venue_id")


@query("dm3_channel", """SELECT channel AS channel_name FROM s_session WHERE channel IS NOT NULL UNION
    SELECT channel FROM s_booking WHERE channel IS NOT NULL""")
def _(s):
    return s.dims["dim_channel"]


@query("dm4_customer", "SELECT customer_id, CAST(min(booking_date) AS VARCHAR) AS first_seen_date FROM s_booking GROUP BY 1")
def _(s):
    return s.dims["dim_customer"]


@query("dm5_resolve_member", "SELECT contract_id, member_id, canonical_member_id FROM s_member")
def _(s):
    return dm.resolve_member(s.silver["contracts"]).select("contract_id", "member_id", "canonical_member_id")


@query("dm6_member", """SELECT canonical_member_id AS member_id, arg_min(phone_number, contract_id) FILTER (WHERE phone_number IS NOT NULL) AS phone,
    CAST(min(start_date) AS VARCHAR) AS first_contract_start_date FROM s_member GROUP BY 1""")
def _(s):
    return s.dims["dim_member"]


TENANT_ZONE = "CASE WHEN CAST(substr(tenant_id, 2) AS BIGINT) < 10 THEN '{}' END"


@query("dm7_tenant_versions", f"""SELECT tenant_id, category, {num('unit_sqm')}, {text('valid_from', 'valid_to')}, valid_to IS NULL AS is_current
    FROM d_tenant""")
def _(s):
    return s.dims["dim_tenant"].select("tenant_id", "category", "unit_sqm", "valid_from", "valid_to", "is_current")


# one tenant in three gets a change inside its history, one on the day a version begins, one before all versions
LATE = """late AS (SELECT tenant_id, CASE CAST(substr(tenant_id, 2) AS BIGINT) % 3 WHEN 0 THEN DATE '1997-03-01' WHEN 1 THEN max(valid_from)
      ELSE DATE '1900-01-01' END AS day, min(valid_from) AS first FROM d_tenant GROUP BY 1)"""


def late_changes(s: Site) -> DataFrame:
    versions = s.dims["dim_tenant"].groupBy("tenant_id").agg(F.max("valid_from").alias("last"))
    kind = F.substring("tenant_id", 2, 18).cast("bigint") % 3
    day = F.when(kind == 0, F.lit("1997-03-01").cast("date")).when(kind == 1, F.col("last")).otherwise(F.lit("1900-01-01").cast("date"))
    return versions.select("tenant_id", day.alias("effective_from"), F.lit("late").alias("category"))


@query("dm8_rebuild_scd2", f"""WITH {LATE}, b AS (
      SELECT tenant_id, CASE WHEN day = valid_from THEN 'late' ELSE category END AS category, valid_from FROM d_tenant JOIN late USING (tenant_id)
      UNION ALL SELECT tenant_id, 'late', day FROM late WHERE day > first AND (tenant_id, day) NOT IN (SELECT (tenant_id, valid_from) FROM d_tenant))
    SELECT tenant_id, category, CAST(valid_from AS VARCHAR) AS valid_from,
      CAST(CAST(lead(valid_from) OVER w - INTERVAL 1 DAY AS DATE) AS VARCHAR) AS valid_to,
      lead(valid_from) OVER w IS NULL AS is_current FROM b WINDOW w AS (PARTITION BY tenant_id ORDER BY valid_from)""")
def _(s):
    rebuilt = dm.rebuild_scd2(s.dims["dim_tenant"], late_changes(s))
    return rebuilt.select("tenant_id", "category", "valid_from", "valid_to", "is_current")


@query("dm8_placed_changes", f"""WITH {LATE} SELECT tenant_id, CAST(day AS VARCHAR) AS effective_from, CASE WHEN day < first THEN 'rejected'
    WHEN (tenant_id, day) IN (SELECT (tenant_id, valid_from) FROM d_tenant) THEN 'corrected' ELSE 'split' END AS outcome FROM late""")
def _(s):
    return dm.place_changes(s.dims["dim_tenant"], late_changes(s)).select("tenant_id", "effective_from", "outcome")


@query("dm9_date", f"""SELECT date_key, {text('full_date')}, is_weekend, is_ramadan, holiday_name IS NOT NULL AS is_public_holiday, holiday_name,
    season, coalesce(orders, 0) AS orders FROM cal LEFT JOIN {ORDER_DAYS} USING (full_date)""")
def _(s):
    rows = s.dims["dim_date"].join(order_days(s).drop("revenue"), "full_date", "left")
    return rows.select("date_key", "full_date", "is_weekend", "is_ramadan", "is_public_holiday", "holiday_name", "season",
                       F.coalesce("orders", F.lit(0)).alias("orders"))


@query("dm10_spatial", f"""SELECT tenant_id, {text('valid_from')}, {TENANT_ZONE.format('west_strip')} AS zone,
    {TENANT_ZONE.format('Main Gate')} AS gate_proximity FROM d_tenant""")
def _(s):
    return s.dims["dim_tenant"].select("tenant_id", "valid_from", "zone", "gate_proximity")


@query("dm11_build_dims", """SELECT 'dim_product' AS dim, count(*) AS n FROM d_product UNION ALL SELECT 'dim_tenant', count(*) FROM d_tenant
    UNION ALL SELECT 'dim_event', count(*) FROM d_event UNION ALL SELECT 'dim_customer', count(DISTINCT customer_id) FROM s_booking
    UNION ALL SELECT 'dim_member', count(DISTINCT canonical_member_id) FROM s_member UNION ALL SELECT 'dim_venue', count(*) FROM d_venue
    UNION ALL SELECT 'dim_gate', count(*) FROM d_gate UNION ALL SELECT 'dim_instructor', count(*) FROM d_instructor
    UNION ALL SELECT 'dim_stable', count(*) FROM nation UNION ALL SELECT 'dim_date', count(*) FROM cal
    UNION ALL SELECT 'dim_date_weather', count(*) FROM cal JOIN s_weather ON weather_date = full_date UNION ALL SELECT 'dim_channel', count(DISTINCT channel) FROM
      (SELECT channel FROM s_booking UNION ALL SELECT channel FROM s_session)""")
def _(s):
    return exports.row_manifest(s.dims).withColumnsRenamed({"view": "dim", "row_count": "n"})


@query("dm12_surrogate", "SELECT product_code, row_number() OVER (ORDER BY product_code) AS product_no FROM d_product")
def _(s):
    return dm.with_surrogate(s.silver["products"].select("product_code"), ["product_code"], "product_no", hashed=False)


# ---- facts

@query("ft1_pos_sales", f"""SELECT invoice_id, date_key, venue_id, item_id AS product_id, {num('qty', 'sales_price_kwd', 'line_amount_kwd')},
    payment_mode, is_refund FROM f_pos""")
def _(s):
    # products are resolved back per product, so that the lines meet them once
    product = s.dims["dim_product"]
    rows = ft.fact_pos_sales(s.silver, s.dims, lambda keys: natural(keys, product, "product_key", "product_id"))
    rows = natural(rows, s.dims["dim_venue"], "venue_key", "venue_id")
    return rows.select(*[c for c in rows.columns if c != "product_id"], "product_id")


@query("ft2_footfall", "SELECT date_key, gate_id, CAST(hour AS BIGINT) AS hour, count_in, count_out, is_imputed, is_outlier_corrected FROM f_foot")
def _(s):
    return natural(s.facts["fact_footfall"], s.dims["dim_gate"], "gate_key", "gate_id")


@query("ft3_version_asof", f"""SELECT tenant_id, {text('sales_month')}, submission_version, {text('valid_from')}, category FROM f_tenant""")
def _(s):
    versions = s.dims["dim_tenant"].select("tenant_id", "valid_from", "valid_to", "category")
    rows = ft.join_version_asof(s.silver["tenant_sales_monthly"], versions)
    return rows.select("tenant_id", "sales_month", "submission_version", "valid_from", "category")


@query("ft4_current_version", f"""SELECT tenant_id, {text('valid_from')}, month_date_key, submission_version, {num('gross_sales_kwd', 'net_sales_kwd')},
    days_late, is_restated, is_current_version FROM f_tenant""")
def _(s):
    return natural(s.facts["fact_tenant_sales"], s.dims["dim_tenant"], "tenant_key", "tenant_id", "valid_from").drop("submitted_date")


@query("ft5_bookings", f"""SELECT booking_id, date_key, sku_code AS product_code, channel AS channel_name, customer_id,
    {num('qty', 'amount_kwd')}, is_cancelled FROM f_booking""")
def _(s):
    rows = natural(s.facts["fact_bookings"], s.dims["dim_product"], "product_key", "product_code")
    rows = natural(rows, s.dims["dim_channel"], "channel_key", "channel_name")
    return natural(rows, s.dims["dim_customer"], "customer_key", "customer_id")


@query("ft6_web_sessions", "SELECT date_key, channel AS channel_name, device, sessions, engaged_sessions, users FROM f_session")
def _(s):
    return natural(s.facts["fact_web_sessions"], s.dims["dim_channel"], "channel_key", "channel_name")


@query("ft7_contract_months", f"""SELECT contract_id, count(*) AS months, CAST(min(month_date) AS VARCHAR) AS first_month,
    CAST(max(month_date) AS VARCHAR) AS last_month FROM f_member GROUP BY 1""")
def _(s):
    rows = ft.explode_contract_months(s.silver["contracts"], START, END)
    return rows.groupBy("contract_id").agg(
        F.count(F.lit(1)).alias("months"), F.min("month_date").alias("first_month"), F.max("month_date").alias("last_month"))


@query("ft8_contract_flags", """SELECT CAST(month_date AS VARCHAR) AS month_date, month_status, is_new, is_churned, count(*) AS n FROM f_member
    GROUP BY 1, 2, 3, 4""")
def _(s):
    rows = ft.with_contract_flags(ft.explode_contract_months(s.silver["contracts"], START, END))
    return rows.groupBy("month_date", "month_status", "is_new", "is_churned").agg(F.count(F.lit(1)).alias("n"))


@query("ft9_membership_months", f"""SELECT contract_id, canonical_member_id AS member_id, venue_id, month_date_key, contract_type, stable_id,
    CAST(monthly_amount_kwd AS DOUBLE) AS mrr_kwd, month_status AS status, is_new, is_churned FROM f_member""")
def _(s):
    def named(contracts: DataFrame) -> DataFrame:
        # resolved back per contract: the months of a contract share its keys
        rows = natural(contracts, s.dims["dim_member"], "member_key", "member_id")
        rows = natural(rows, s.dims["dim_venue"], "venue_key", "venue_id")
        return natural(rows, s.dims["dim_stable"], "stable_key", "stable_id")

    return ft.fact_membership_months(s.silver["contracts"], s.dims, named)


@query("ft10_lesson_slots", "SELECT lesson_id, date_key, instructor_id, level, capacity, booked, attended, is_overbooked FROM f_lesson")
def _(s):
    return natural(s.facts["fact_lesson_slots"], s.dims["dim_instructor"], "instructor_key", "instructor_id")


@query("ft11_rejects", """SELECT 'pos_sales_lines' AS source, 'date outside calendar' AS reason, CAST(NULL AS VARCHAR) AS value, count(*) AS row_count
      FROM s_pos WHERE NOT is_duplicate AND invoice_date NOT IN (SELECT full_date FROM cal) GROUP BY 1, 2, 3
    UNION ALL SELECT 'tenant_sales_monthly', 'no tenant version', NULL, count(*) FROM s_filing s WHERE NOT EXISTS (SELECT 1 FROM d_tenant t
      WHERE t.tenant_id = s.tenant_id AND valid_from <= sales_month AND (valid_to IS NULL OR sales_month <= valid_to)) GROUP BY 1, 2, 3
    UNION ALL SELECT 'web_bookings', 'product code without family', product_code, count(*) FROM s_booking
      WHERE product_code NOT IN (SELECT family_code FROM crosswalk) GROUP BY 1, 2, 3
    UNION ALL SELECT 'web_bookings', 'date outside calendar', NULL, count(*) FROM s_booking
      WHERE booking_date NOT IN (SELECT full_date FROM cal) GROUP BY 1, 2, 3""")
def _(s):
    # cleaning changes counts, not gates, so the conformed drop says as much about them
    counts = fc.footfall_conform(s.landed["footfall"], s.cfg["weekend"])
    return ft.rejects({**s.silver, "footfall_hourly": counts}, s.dims, s.crosswalk)


# ---- views

def view(name: str, *extra: tuple[str, str]):
    """A view with the natural columns of the given dimensions added for its surrogate key."""
    def build(s: Site) -> DataFrame:
        df = s.views[name]
        for dim, key in extra:
            cols = {"tenant_key": ["valid_from"], "channel_key": ["channel"], "instructor_key": ["instructor_id"]}[key]
            side = s.dims[dim].withColumnRenamed("channel_name", "channel") if key == "channel_key" else s.dims[dim]
            df = natural(df, side, key, *cols)
        return df

    return build


DAYS = f"date_key, {text('full_date')}, season, is_weekend, is_ramadan"
TENANT = ("dim_tenant", "tenant_key")

query("w1_footfall_daily", f"""SELECT {DAYS}, footfall, has_imputed_hours, has_corrected_hours, footfall_week_ago, footfall_year_ago,
    temp_max_c, temp_min_c, dust_storm_flag, rain_mm FROM w1""")(view("vw_footfall_daily"))
query("w2_footfall_by_zone", f"SELECT * REPLACE (CAST(full_date AS VARCHAR) AS full_date) FROM w2")(view("vw_footfall_by_zone"))
query("w3_footfall_sales_conversion", "SELECT * REPLACE (CAST(full_date AS VARCHAR) AS full_date, CAST(footfall AS BIGINT) AS footfall) FROM w3")(
    view("vw_footfall_sales_conversion"))
query("w4_event_roi", f"SELECT * REPLACE ({text('start_date')}, {text('end_date')}) FROM w4")(view("vw_event_roi"))
query("w5_avg_transaction_value", "SELECT * FROM w5")(view("vw_avg_transaction_value"))
RENT = f"tenant_id, tenant_name, category, {text('valid_from')}, month_date_key, {text('month_start')}, {num('base_rent_kwd')}"
OWED = "CAST(turnover_rent_kwd AS DOUBLE) AS turnover_rent_kwd, CAST(base_rent_kwd + turnover_rent_kwd AS DOUBLE) AS total_rent_owed_kwd, days_late, is_restated"
query("w6_turnover_rent", f"""SELECT {RENT}, CAST(sales_kwd AS DOUBLE) AS reported_sales_kwd, {num('turnover_threshold_kwd', 'turnover_rent_pct')},
    {OWED} FROM v_rent""")(view("vw_tenant_turnover_rent", TENANT))
query("w7_sales_per_sqm", f"SELECT * EXCLUDE (unit_no) REPLACE ({text('month_start')}, {text('valid_from')}) FROM w7")(
    view("vw_tenant_sales_per_sqm", TENANT))
query("w8_tenant_compliance", f"SELECT * REPLACE ({text('valid_from')}) FROM w8")(view("vw_tenant_compliance", TENANT))
query("w9_ticket_channel_mix", "SELECT * FROM w9")(view("vw_ticket_channel_mix"))
query("w10_web_channel_conversion", "SELECT * FROM w10")(view("vw_web_channel_conversion", ("dim_channel", "channel_key")))
query("w11_web_channel_conversion_monthly", f"SELECT * REPLACE ({text('month_start')}) FROM w11")(
    view("vw_web_channel_conversion_monthly", ("dim_channel", "channel_key")))
query("w12_membership_active_churn", f"SELECT * REPLACE ({text('month_start')}) FROM w12")(view("vw_membership_active_churn"))
query("w13_revenue_summary", f"SELECT * REPLACE ({text('month_start')}) FROM w13")(view("vw_revenue_summary"))
query("w14_lesson_utilization", "SELECT * FROM w14")(view("vw_lesson_utilization", ("dim_instructor", "instructor_key")))
query("w15_lesson_utilization_monthly", f"SELECT * REPLACE ({text('month_start')}) FROM w15")(
    view("vw_lesson_utilization_monthly", ("dim_instructor", "instructor_key")))
query("w16_instructor_coverage", """SELECT i.instructor_id, i.instructor_name, 'all_levels' AS specialty_level, 'active' AS status, '1994-01-01' AS hire_date,
    count(lesson_id) AS lesson_count, CAST(coalesce(sum(capacity), 0) AS BIGINT) AS total_capacity,
    CAST(coalesce(sum(booked), 0) AS BIGINT) AS total_booked
    FROM d_instructor i LEFT JOIN f_lesson l ON l.instructor_id = i.instructor_id GROUP BY 1, 2""")(view("vw_instructor_coverage"))
query("w17_stable_occupancy", f"""WITH t AS (SELECT count(*) AS boxes FROM nation)
    SELECT month_date_key, CAST(month_date AS VARCHAR) AS month_start, count(DISTINCT stable_id) AS occupied_boxes, boxes AS total_boxes,
      {pct("count(DISTINCT stable_id)", "boxes", 1)} AS occupancy_pct, CAST(sum(monthly_amount_kwd) AS DOUBLE) AS boarding_revenue_kwd
    FROM f_member, t WHERE contract_type = 'horse_boarding' AND month_status = 'active' GROUP BY month_date_key, month_date, boxes""")(
    view("vw_stable_occupancy"))
query("w18_tenant_site_metrics", f"""SELECT {RENT}, unit_no, {num('unit_sqm')}, status, CAST(sales_kwd AS DOUBLE) AS sales_kwd,
    CAST(sales_kwd AS DOUBLE) / nullif(CAST(unit_sqm AS DOUBLE), 0) AS sales_per_sqm_kwd, {OWED} FROM v_rent""")(
    view("vw_tenant_site_metrics", TENANT))
query("w19_footfall_gate_hour_monthly", f"SELECT * REPLACE ({text('month_start')}) FROM w19")(view("vw_footfall_gate_hour_monthly"))


# ---- quality

def result_sql(name: str, kind: str, schema: str, table: str, ok: str, expected: str, actual: str, details: str = "CAST(NULL AS VARCHAR)") -> str:
    return (f"SELECT '{name}' AS check_name, '{kind}' AS check_type, '{schema}' AS schema_name, '{table}' AS table_name, "
            f"CASE WHEN {ok} THEN 'pass' ELSE 'fail' END AS status, {expected} AS expected_value, "
            f"CAST({actual} AS VARCHAR) AS actual_value, {details} AS details")


def count_sql(name: str, kind: str, schema: str, table: str, source: str, details: str | None = None) -> str:
    note = "CAST(NULL AS VARCHAR)" if details is None else f"'{details}'"
    return result_sql(name, kind, schema, table, "n = 0", "'0'", "n", note) + f" FROM ({source})"


@query("q1_row_count", result_sql("fact_pos_sales_vs_silver", "row_count", "gold", "fact_pos_sales", "g >= 0.99 * s",
                                  "'>= 99% of silver (' || s || ')'", "g", "'ratio=' || printf('%.4f', g / s)")
       + " FROM (SELECT count(*) AS s FROM s_pos WHERE NOT is_duplicate), (SELECT count(*) AS g FROM f_pos)")
def _(s):
    kept = s.silver["pos_sales_lines"].filter("not is_duplicate")
    return dq.check_row_count("fact_pos_sales_vs_silver", kept, s.facts["fact_pos_sales"], 0.99, "fact_pos_sales")


UNIQUE_SQL = count_sql("pos_sales_lines_dedup_correct", "uniqueness", "silver", "pos_sales_lines",
    """SELECT count(*) AS n FROM (SELECT 1 FROM s_pos WHERE NOT is_duplicate GROUP BY invoice_id, sales_id, invoice_date, item_id, qty,
    sales_price_kwd, line_amount_kwd, minute, payment_mode, cust_account HAVING count(*) > 1)""")
LESSON_UNIQUE_SQL = count_sql("lesson_unique", "uniqueness", "gold", "fact_lesson_slots",
    "SELECT count(*) AS n FROM (SELECT lesson_id FROM f_lesson GROUP BY 1 HAVING count(*) > 1)")


@query("q2_unique", f"{UNIQUE_SQL} UNION ALL {LESSON_UNIQUE_SQL}")
def _(s):
    kept = dq.check_unique("pos_sales_lines_dedup_correct", s.silver["pos_sales_lines"], sv.POS_DUPLICATE_KEY, ~F.col("is_duplicate"),
                           "silver", "pos_sales_lines")
    return kept.unionByName(dq.check_unique("lesson_unique", s.facts["fact_lesson_slots"], ["lesson_id"], table="fact_lesson_slots"))


@query("q3_foreign_key", count_sql("fact_pos_sales_product_key_valid", "referential_integrity", "gold", "fact_pos_sales",
       "SELECT count(*) AS n FROM f_pos WHERE item_id NOT IN (SELECT product_id FROM d_product)",
       "product_key -> gold.dim_product.product_key") + " UNION ALL " + count_sql(
       "pos_item_is_ticket", "referential_integrity", "gold", "pos_sales_lines",
       "SELECT count(*) AS n FROM s_pos WHERE item_id NOT IN (SELECT product_id FROM d_product WHERE category = 'ticket')",
       "item_id -> tickets.product_id"))
def _(s):
    valid = dq.check_fk("fact_pos_sales_product_key_valid", s.facts["fact_pos_sales"], "product_key", s.dims["dim_product"],
                        "product_key", "fact_pos_sales", "gold.dim_product")
    tickets = s.silver["products"].filter("category = 'ticket'")
    return valid.unionByName(dq.check_fk(
        "pos_item_is_ticket", s.silver["pos_sales_lines"], "item_id", tickets, "product_id", "pos_sales_lines", "tickets"))


@query("q4_iff", count_sql("stable_iff_boarding", "referential_integrity", "gold", "fact_membership_months",
       "SELECT count(*) AS n FROM f_member WHERE (contract_type = 'horse_boarding') <> (stable_id IS NOT NULL)"))
def _(s):
    return dq.check_iff("stable_iff_boarding", s.facts["fact_membership_months"], F.col("contract_type") == "horse_boarding",
                        F.col("stable_key").isNotNull(), "fact_membership_months")


@query("q5_natural_foreign_key", count_sql("product_venue_valid", "referential_integrity", "gold", "products",
       "SELECT count(*) AS n FROM d_product WHERE venue_id IS NOT NULL AND venue_id NOT IN (SELECT venue_id FROM d_venue WHERE zone IS NOT NULL)",
       "venue_id -> zoned.venue_id"))
def _(s):
    zoned = s.dims["dim_venue"].filter("zone is not null")
    return dq.check_fk("product_venue_valid", s.silver["products"], "venue_id", zoned, "venue_id", "products", "zoned")


@query("q6_populated", count_sql("dim_tenant_spatial_metadata_populated", "referential_integrity", "gold", "dim_tenant",
       "SELECT count(*) AS n FROM d_tenant WHERE CAST(substr(tenant_id, 2) AS BIGINT) >= 10"))
def _(s):
    return dq.check_populated("dim_tenant_spatial_metadata_populated", s.dims["dim_tenant"], ["zone", "gate_proximity"], "dim_tenant")


@query("q7_value_range", count_sql("attended_not_above_booked", "value_range", "gold", "lesson_slots",
       "SELECT count(*) AS n FROM s_lesson WHERE attended > booked") + " UNION ALL " + count_sql(
       "booked_within_capacity", "value_range", "gold", "lesson_slots", "SELECT count(*) AS n FROM s_lesson WHERE booked > capacity"))
def _(s):
    return dq.check_predicates(s.silver["lesson_slots"], [
        ("attended_not_above_booked", "value_range", F.col("attended") > F.col("booked"), None),
        ("booked_within_capacity", "value_range", F.col("booked") > F.col("capacity"), None),
    ], "gold", "lesson_slots")


def fresh_sql(name: str, table: str, source: str) -> str:
    return result_sql(name, "freshness", "silver", table, f"DATE '{END}' - m <= 7", f"'max date within 7d of {END}'", "m",
                      f"'staleness_days=' || (DATE '{END}' - m)") + f" FROM ({source})"


FRESH_POS = fresh_sql("pos_sales_lines_freshness", "pos_sales_lines", "SELECT max(invoice_date) AS m FROM s_pos")
FRESH_WEB = fresh_sql("web_sessions_freshness", "web_sessions", "SELECT max(session_date) AS m FROM s_session")


@query("q8_freshness", f"{FRESH_POS} UNION ALL {FRESH_WEB}")
def _(s):
    a = dq.check_freshness("pos_sales_lines_freshness", s.silver["pos_sales_lines"], "invoice_date", END, table="pos_sales_lines")
    return a.unionByName(dq.check_freshness("web_sessions_freshness", s.silver["web_sessions"], "session_date", END, table="web_sessions"))


def small_results(s: Site) -> DataFrame:
    return dq.stamp(QUERIES["q2_unique"](s).unionByName(QUERIES["q7_value_range"](s)).unionByName(QUERIES["q8_freshness"](s)), "run-1")


SMALL = f"""(SELECT 'run-1' AS run_id, *, CASE WHEN check_type IN ('uniqueness', 'referential_integrity') THEN 'error' ELSE 'warning' END
    AS severity FROM ({UNIQUE_SQL} UNION ALL {LESSON_UNIQUE_SQL} UNION ALL {count_sql("attended_not_above_booked", "value_range", "gold",
    "lesson_slots", "SELECT count(*) AS n FROM s_lesson WHERE attended > booked")} UNION ALL {count_sql("booked_within_capacity",
    "value_range", "gold", "lesson_slots", "SELECT count(*) AS n FROM s_lesson WHERE booked > capacity")}
    UNION ALL {FRESH_POS} UNION ALL {FRESH_WEB}))"""


@query("q9_stamp", f"SELECT * FROM {SMALL}")
def _(s):
    return small_results(s)


@query("q10_gate", f"SELECT bool_or(status = 'fail' AND severity = 'error') AS critical FROM {SMALL}")
def _(s):
    # the gate itself, on the results of each check table and of all
    return small_results(s).agg(dq.any_critical().alias("critical"))


@query("q11_summary", f"""WITH r AS (SELECT * FROM {SMALL}), t AS (SELECT count(*) AS checks_run, count(*) FILTER (WHERE status = 'fail') AS checks_failed,
      count(*) FILTER (WHERE status = 'fail' AND severity = 'error') AS checks_critical FROM r)
    SELECT t.*, severity, check_name, expected_value, actual_value FROM t, r WHERE status = 'fail'""")
def _(s):
    return dq.summarise(small_results(s))


FRESH_FOOT = fresh_sql("footfall_freshness", "footfall_hourly", "SELECT max(footfall_date) AS m FROM s_foot0")
FRESH_BOOK = fresh_sql("web_bookings_freshness", "web_bookings", "SELECT max(booking_date) AS m FROM s_booking")


def stored_layers(s: Site) -> tuple[dict[str, DataFrame], dict[str, DataFrame], dict[str, DataFrame]]:
    """Silver, dimensions and facts written and read back, as a warehouse run leaves them for its gates."""
    return warehouse.build_layers(tables.Warehouse(s.spark, scratch(s, "warehouse")), s.silver, s.cfg)


@query("q12_silver_suite", f"{UNIQUE_SQL} UNION ALL {FRESH_POS} UNION ALL {FRESH_FOOT} UNION ALL {FRESH_BOOK} UNION ALL {FRESH_WEB}")
def _(s):
    return dq.silver_suite(s.silver, END)


def rows_sql(name: str, table: str, silver: str, gold: str, share: float) -> str:
    return result_sql(name, "row_count", "gold", table, f"g >= {share} * s", f"'>= {share:.0%} of silver (' || s || ')'", "g",
                      "'ratio=' || printf('%.4f', g / s)") + f" FROM (SELECT count(*) AS s FROM {silver}), (SELECT count(*) AS g FROM {gold})"


def repeats_sql(name: str, table: str, source: str, keys: str) -> str:
    return count_sql(name, "uniqueness", "gold", table, f"SELECT count(*) AS n FROM (SELECT 1 FROM {source} GROUP BY {keys} HAVING count(*) > 1)")


def missing_sql(name: str, table: str, key: str, dim: str, source: str, match: str, details: str | None = None) -> str:
    return count_sql(name, "referential_integrity", "gold", table,
                     f"SELECT count(*) AS n FROM {source} f WHERE NOT EXISTS (SELECT 1 FROM {match})", details or f"{key} -> gold.{dim}.{key}")


GOLD_SQL = [
    rows_sql("fact_pos_sales_vs_silver", "fact_pos_sales", "s_pos WHERE NOT is_duplicate", "f_pos", 0.99),
    rows_sql("fact_footfall_vs_silver", "fact_footfall", "s_foot0", "f_foot", 1.0),
    rows_sql("fact_tenant_sales_vs_silver", "fact_tenant_sales", "s_filing", "f_tenant", 1.0),
    rows_sql("fact_bookings_vs_silver", "fact_bookings", "s_booking", "f_booking", 0.99),
    rows_sql("fact_web_sessions_vs_silver", "fact_web_sessions", "s_session", "f_session", 1.0),
    rows_sql("fact_lesson_slots_vs_silver", "fact_lesson_slots", "s_lesson", "f_lesson", 1.0),
    repeats_sql("dim_tenant_one_current_per_tenant", "dim_tenant", "d_tenant WHERE valid_to IS NULL", "tenant_id"),
    repeats_sql("fact_footfall_gate_date_hour_unique", "fact_footfall", "f_foot", "gate_id, date_key, hour"),
    repeats_sql("fact_tenant_sales_version_unique", "fact_tenant_sales", "f_tenant", "tenant_id, valid_from, month_date_key, submission_version"),
    repeats_sql("fact_membership_months_contract_month_unique", "fact_membership_months", "f_member", "contract_id, month_date_key"),
    missing_sql("fact_pos_sales_date_key_valid", "fact_pos_sales", "date_key", "dim_date", "f_pos", "cal d WHERE d.date_key = f.date_key"),
    missing_sql("fact_pos_sales_product_key_valid", "fact_pos_sales", "product_key", "dim_product", "f_pos", "d_product d WHERE d.product_id = f.item_id"),
    missing_sql("fact_bookings_customer_key_valid", "fact_bookings", "customer_key", "dim_customer", "f_booking",
                "s_booking d WHERE d.customer_id = f.customer_id"),
    missing_sql("fact_bookings_product_key_valid", "fact_bookings", "product_key", "dim_product",
                "(SELECT * FROM f_booking WHERE sku_code IS NOT NULL)", "d_product d WHERE d.product_code = f.sku_code"),
    missing_sql("fact_membership_months_member_key_valid", "fact_membership_months", "member_key", "dim_member", "f_member",
                "s_member d WHERE d.canonical_member_id = f.canonical_member_id"),
    missing_sql("fact_lesson_slots_instructor_key_valid", "fact_lesson_slots", "instructor_key", "dim_instructor", "f_lesson",
                "d_instructor d WHERE d.instructor_id = f.instructor_id"),
    missing_sql("fact_tenant_sales_tenant_key_valid", "fact_tenant_sales", "tenant_key", "dim_tenant", "f_tenant",
                "d_tenant d WHERE d.tenant_id = f.tenant_id"),
    count_sql("membership_months_stable_key_matches_boarding_type", "referential_integrity", "gold", "fact_membership_months",
              "SELECT count(*) AS n FROM f_member WHERE (contract_type = 'horse_boarding') <> (stable_id IS NOT NULL)",
              "boarding contracts have a stable, others have none"),
    missing_sql("dim_gate_primary_venue_served_valid", "dim_gate", "", "", "(SELECT * FROM d_gate WHERE primary_venue_served IS NOT NULL)",
                "d_venue d WHERE d.venue_id = f.primary_venue_served", "primary_venue_served -> gold.dim_venue.venue_id"),
    count_sql("dim_gate_spatial_metadata_populated", "referential_integrity", "gold", "dim_gate",
              "SELECT count(*) AS n FROM d_gate WHERE gate_label IS NULL OR zone IS NULL", "gate_label, zone configured for every row"),
    count_sql("dim_venue_spatial_metadata_populated", "referential_integrity", "gold", "dim_venue",
              "SELECT count(*) AS n FROM d_venue WHERE zone IS NULL OR gate_proximity IS NULL", "zone, gate_proximity configured for every row"),
    count_sql("dim_tenant_spatial_metadata_populated", "referential_integrity", "gold", "dim_tenant",
              "SELECT count(*) AS n FROM d_tenant WHERE CAST(substr(tenant_id, 2) AS BIGINT) >= 10", "zone, gate_proximity configured for every row"),
    count_sql("pos_sales_refund_has_negative_amount", "value_range", "gold", "fact_pos_sales",
              "SELECT count(*) AS n FROM f_pos WHERE is_refund AND line_amount_kwd >= 0", "refunded lines carry negative amounts"),
    count_sql("footfall_counts_non_negative", "value_range", "gold", "fact_footfall",
              "SELECT count(*) AS n FROM f_foot WHERE count_in < 0 OR count_out < 0"),
    count_sql("lesson_slots_attended_not_above_booked", "value_range", "gold", "fact_lesson_slots",
              "SELECT count(*) AS n FROM f_lesson WHERE attended > booked"),
    count_sql("tenant_sales_net_not_above_gross", "value_range", "gold", "fact_tenant_sales",
              "SELECT count(*) AS n FROM f_tenant WHERE net_sales_kwd > gross_sales_kwd"),
]


@query("q12_gold_suite", " UNION ALL ".join(GOLD_SQL))
def _(s):
    return dq.gold_suite(*stored_layers(s))


@query("q13_group_checks", f"""SELECT check_type, count(*) FILTER (WHERE status = 'pass') AS passed, count(*) FILTER (WHERE status = 'fail') AS failed,
    string_agg(check_name, ',' ORDER BY check_name) AS checks, CASE check_type WHEN 'uniqueness' THEN 'Uniqueness' WHEN 'value_range'
    THEN 'Plausibility' ELSE 'Freshness' END AS label FROM {SMALL} GROUP BY 1""")
def _(s):
    return dq.group_checks(small_results(s))


@query("q14_census", """SELECT * FROM (
    SELECT 'sensor-outage' AS id, count(*) FILTER (WHERE has_imputed_hours) AS count FROM w1 UNION ALL
    SELECT 'sensor-doublecount', count(*) FILTER (WHERE has_corrected_hours) FROM w1 UNION ALL
    SELECT 'tenant-restated', count(*) FILTER (WHERE is_restated) FROM v_rent UNION ALL
    SELECT 'tenant-late', count(*) FILTER (WHERE days_late > 30) FROM v_rent UNION ALL
    SELECT 'tenant-scd', count(*) - count(DISTINCT tenant_id) FROM w8 UNION ALL
    SELECT 'refunds', CAST(sum(refund_invoice_count) AS BIGINT) FROM w5 UNION ALL
    SELECT 'overbooked', CAST(sum(overbooked_count) AS BIGINT) FROM w15 UNION ALL
    SELECT 'attendance', CAST(sum(missing_attendance_count) AS BIGINT) FROM w15 UNION ALL
    SELECT 'instructor-roster', count(*) FROM d_instructor WHERE instructor_id NOT IN (SELECT instructor_id FROM f_lesson) UNION ALL
    SELECT 'event-dates', count(*) FILTER (WHERE footfall_uplift_per_day IS NULL) FROM w4 UNION ALL
    SELECT 'attribution', CAST(sum(booking_count) FILTER (WHERE coalesce(sessions, 0) = 0) AS BIGINT) FROM w10 UNION ALL
    SELECT 'sku-crosswalk', count(DISTINCT venue_name) FROM w9 WHERE online_qty = 0 AND walk_in_qty > 0 AND category = 'ticket' UNION ALL
    SELECT 'gate-names', 4 UNION ALL SELECT 'member-identity', 1) WHERE count > 0""")
def _(s):
    return dq.census(s.views).drop("unit")


# ---- second-level analytics

@query("a1_footfall_summary", f"""SELECT count(*) AS days, CAST(sum(footfall) AS BIGINT) AS total, CAST(sum(footfall) AS DOUBLE) / count(*) AS mean_per_day,
    CAST(arg_max(full_date, footfall * 100000 - (full_date - DATE '1970-01-01')) AS VARCHAR) AS busiest_date, max(footfall) AS busiest_footfall,
    CAST(sum(footfall_year_ago) AS BIGINT) AS total_year_ago,
    CAST(sum(footfall) FILTER (WHERE footfall_year_ago IS NOT NULL) - sum(footfall_year_ago) AS DOUBLE) / CAST(sum(footfall_year_ago) AS DOUBLE) * 100
      AS year_on_year_pct,
    count(*) FILTER (WHERE has_imputed_hours OR has_corrected_hours) AS flagged_days, count(*) FILTER (WHERE dust_storm_flag) AS dust_storm_days
    FROM w1 WHERE full_date {IN_RANGE}""")
def _(s):
    return fa.footfall_summary(s.views["vw_footfall_daily"], RANGE)


@query("a2_venue_conversion", f"""WITH c AS (SELECT venue_id, venue_name, zone, gate_proximity, sum(CAST(revenue_kwd AS DECIMAL(18,3))) AS r, sum(footfall) AS f,
      sum(entrance_footfall) AS e FROM w3 WHERE full_date {IN_RANGE} GROUP BY 1, 2, 3, 4)
    SELECT venue_id, venue_name, zone, gate_proximity, CAST(r AS DOUBLE) AS revenue_kwd,
      CASE WHEN f > 0 THEN CAST(r AS DOUBLE) / CAST(f AS DOUBLE) END AS revenue_per_site_visitor,
      CASE WHEN e > 0 THEN CAST(r AS DOUBLE) / CAST(e AS DOUBLE) END AS revenue_per_entrance_visitor FROM c""")
def _(s):
    return fa.venue_conversion_summary(s.views["vw_footfall_sales_conversion"], RANGE)


@query("a3_events_in_range", f"""SELECT event_id, {text('start_date', 'end_date')}, footfall_uplift_per_day FROM w4
    WHERE least(start_date, coalesce(end_date, start_date)) <= DATE '1999-09-30' AND greatest(start_date, coalesce(end_date, start_date)) >= DATE '1996-03-01'""")
def _(s):
    return fa.events_in_range(s.views["vw_event_roi"], RANGE).select("event_id", "start_date", "end_date", "footfall_uplift_per_day")


@query("a4_crowded_unprofitable", """SELECT event_id, coalesce(footfall_uplift_per_day > 0 AND sales_uplift_per_day_kwd < 0, false)
    AS crowded_but_unprofitable FROM w4""")
def _(s):
    return fa.flag_crowded_unprofitable(s.views["vw_event_roi"]).select("event_id", "crowded_but_unprofitable")


@query("a5_entrance_share", f"""WITH t AS (SELECT gate_label, CAST(sum(footfall) AS BIGINT) AS footfall FROM w2 WHERE full_date {IN_RANGE} GROUP BY 1)
    SELECT gate_label, footfall, CAST(footfall AS DOUBLE) / CAST(sum(footfall) OVER () AS DOUBLE) * 100 AS share_pct FROM t""")
def _(s):
    return fa.entrance_share(s.views["vw_footfall_by_zone"], RANGE)


@query("a6_rent_summary", f"""WITH t AS (SELECT count(*) AS n, sum(base_rent_kwd) AS b, sum(turnover_rent_kwd) AS t, count(*) FILTER (WHERE turnover_rent_kwd > 0) AS trig,
      count(*) FILTER (WHERE is_restated) AS re, CAST(sum(days_late) AS DOUBLE) / count(days_late) AS late FROM v_rent WHERE month_start {IN_RANGE})
    SELECT n AS tenant_months, CAST(b AS DOUBLE) AS base_rent, CAST(t AS DOUBLE) AS turnover_rent, CAST(b + t AS DOUBLE) AS total_owed,
      CAST(t AS DOUBLE) / CAST(b + t AS DOUBLE) * 100 AS turnover_share_pct, trig AS months_triggered, re AS restated_count, late AS avg_days_late FROM t""")
def _(s):
    return la.rent_summary(s.views["vw_tenant_turnover_rent"], RANGE)


@query("a7_rent_by_month", f"""SELECT {text('month_start')}, CAST(sum(base_rent_kwd) AS DOUBLE) AS base_rent, CAST(sum(turnover_rent_kwd) AS DOUBLE) AS turnover_rent,
    CAST(sum(base_rent_kwd + turnover_rent_kwd) AS DOUBLE) AS total_owed, count(*) AS tenant_count FROM v_rent WHERE month_start {IN_RANGE} GROUP BY v_rent.month_start""")
def _(s):
    return la.rent_by_month(s.views["vw_tenant_turnover_rent"], RANGE)


MONTH_FOOT = "(SELECT CAST(date_trunc('month', full_date) AS DATE) AS month_start, CAST(sum(footfall) AS BIGINT) AS footfall FROM w1 GROUP BY 1)"


@query("a8_footfall_by_month", f"SELECT {text('month_start')}, footfall FROM {MONTH_FOOT}")
def _(s):
    return la.footfall_by_month(s.views["vw_footfall_daily"])


def sqm(s: Site) -> DataFrame:
    return la.sqm_base(s.views["vw_tenant_sales_per_sqm"])


def versioned(s: Site, df: DataFrame, *cols: str) -> DataFrame:
    named = natural(df.drop("tenant_id"), s.dims["dim_tenant"], "tenant_key", "tenant_id", "valid_from")
    return named.select("tenant_id", "valid_from", *cols)


@query("a9_sales_per_sqm", f"SELECT tenant_id, {text('valid_from')}, month_count, total_sales, sales_per_sqm FROM sqm")
def _(s):
    return versioned(s, sqm(s), "month_count", "total_sales", "sales_per_sqm")


CORR = f"""(SELECT tenant_id, valid_from, CASE WHEN count(*) >= 3 AND stddev_pop(f.footfall) * stddev_pop(coalesce(sales_kwd, 0)) <> 0
    THEN corr(coalesce(sales_kwd, 0), f.footfall) END AS c FROM w7 JOIN {MONTH_FOOT} f USING (month_start) WHERE unit_sqm > 0 GROUP BY 1, 2)"""


@query("a10_footfall_correlation", f"SELECT tenant_id, {text('valid_from')}, round(c, 6) AS footfall_correlation FROM {CORR}")
def _(s):
    out = la.with_footfall_corr(s.views["vw_tenant_sales_per_sqm"], la.footfall_by_month(s.views["vw_footfall_daily"]))
    return versioned(s, out, "footfall_correlation").withColumn("footfall_correlation", F.round("footfall_correlation", 6))


GAP = "(sales_per_sqm / (SELECT median(sales_per_sqm) FROM sqm) - 1) * 100"


@query("a11_median_gap", f"SELECT tenant_id, {text('valid_from')}, {GAP} AS vs_median_pct FROM sqm")
def _(s):
    return versioned(s, la.with_median_gap(sqm(s)), "vs_median_pct")


@query("a12_peer_gap", f"""WITH p AS (SELECT a.tenant_id, a.valid_from, a.sales_per_sqm, median(b.sales_per_sqm) AS m, count(b.tenant_id) AS n FROM sqm a
      LEFT JOIN sqm b ON b.category = a.category AND b.sales_per_sqm <> a.sales_per_sqm GROUP BY 1, 2, 3)
    SELECT tenant_id, {text('valid_from')}, n AS peer_count, CASE WHEN m > 0 THEN (sales_per_sqm / m - 1) * 100 END AS vs_category_pct FROM p""")
def _(s):
    return versioned(s, la.with_peer_gap(sqm(s)), "peer_count", "vs_category_pct")


@query("a13_under_reporting", f"SELECT tenant_id, {text('valid_from')}, {GAP} <= -30 AS under_reporting FROM sqm")
def _(s):
    return versioned(s, la.flag_under_reporting(la.with_median_gap(sqm(s))), "under_reporting")


@query("a14_peer_correlation", f"""SELECT round(avg(c), 6) AS peer_correlation FROM sqm JOIN {CORR} USING (tenant_id, valid_from) WHERE NOT ({GAP} <= -30)""")
def _(s):
    full = la.summarise_per_sqm(s.views["vw_tenant_sales_per_sqm"], s.views["vw_footfall_daily"])
    return la.peer_correlation(full).select(F.round("peer_correlation", 6).alias("peer_correlation"))


@query("a15_merge_compliance", """WITH m AS (SELECT tenant_id, max(tenant_name) AS tenant_name, arg_max(category, submission_count * 1000 + CAST(substr(category, 5) AS BIGINT)) AS category,
      CAST(sum(submission_count) AS BIGINT) AS submission_count, CAST(sum(restated_count) AS BIGINT) AS restated_count, max(max_days_late) AS ml, count(*) AS version_count,
      sum(avg_days_late * submission_count) AS lt, sum(submission_count) FILTER (WHERE avg_days_late IS NOT NULL) AS lc FROM w8 GROUP BY 1)
    SELECT tenant_id, tenant_name, category, submission_count, restated_count, CASE WHEN version_count > 1 THEN greatest(ml, 0) ELSE ml END AS max_days_late,
      version_count, version_count > 1 AS merged, round(lt / lc, 6) AS avg_days_late,
      CAST(restated_count AS DOUBLE) / CAST(submission_count AS DOUBLE) * 100 AS restated_pct FROM m""")
def _(s):
    return la.merge_compliance(s.views["vw_tenant_compliance"]).withColumn("avg_days_late", F.round("avg_days_late", 6))


MIX = """(SELECT venue_name, category, sum(CAST(online_qty AS DECIMAL(18,2))) AS oq, sum(CAST(walk_in_qty AS DECIMAL(18,2))) AS wq,
    sum(CAST(online_amount_kwd AS DECIMAL(18,3))) AS oa, sum(CAST(walk_in_amount_kwd AS DECIMAL(18,3))) AS wa, count(*) AS n,
    count(*) FILTER (WHERE online_qty > 0) > 0 AND count(*) FILTER (WHERE walk_in_qty > 0) > count(*) FILTER (WHERE online_qty > 0) AS x FROM w9 GROUP BY 1, 2)"""


@query("a16_channel_mix_groups", f"""SELECT venue_name, category, CAST(oq AS DOUBLE) AS online_qty, CAST(wq AS DOUBLE) AS walk_in_qty, CAST(oa AS DOUBLE) AS online_amount_kwd,
    CAST(wa AS DOUBLE) AS walk_in_amount_kwd, n AS product_count, x AS crosswalked, CAST(oq + wq AS DOUBLE) AS total_qty,
    CASE WHEN oq + wq > 0 THEN CAST(oq AS DOUBLE) / CAST(oq + wq AS DOUBLE) * 100 END AS online_share_pct FROM {MIX}""")
def _(s):
    return oa.channel_mix_groups(s.views["vw_ticket_channel_mix"])


SERIES = """(WITH r AS (SELECT * FROM w11 WHERE month_key BETWEEN 199903 AND 200012),
    t AS (SELECT channel_name, CAST(coalesce(sum(sessions), 0) AS BIGINT) AS total_sessions, CAST(sum(booking_count) AS BIGINT) AS total_bookings FROM r GROUP BY 1),
    s AS (SELECT channel_name, conversion_rate_pct AS p, row_number() OVER (PARTITION BY channel_name ORDER BY month_key) AS a,
      row_number() OVER (PARTITION BY channel_name ORDER BY month_key DESC) AS z FROM r WHERE coalesce(sessions, 0) >= 30 AND conversion_rate_pct IS NOT NULL),
    e AS (SELECT channel_name, avg(p) FILTER (WHERE a <= 3) AS first_pct, avg(p) FILTER (WHERE z <= 3) AS last_pct FROM s GROUP BY 1)
    SELECT channel_name, total_sessions, total_bookings, CAST(total_bookings AS DOUBLE) / CAST(total_sessions AS DOUBLE) * 100 AS overall_pct,
      first_pct, last_pct, (last_pct - first_pct) / nullif(first_pct, 0) * 100 AS change_pct FROM t LEFT JOIN e USING (channel_name) WHERE total_sessions > 0)"""
SPAN = ("1999-03-01", "2000-12-31")


def series(s: Site) -> DataFrame:
    return oa.channel_series(s.views["vw_web_channel_conversion_monthly"], SPAN, thin=30)


ROUNDED = ["first_pct", "last_pct", "change_pct"]


@query("a17_channel_series", f"SELECT * REPLACE ({', '.join(f'round({c}, 6) AS {c}' for c in ROUNDED)}) FROM {SERIES}, (SELECT 1 AS one FROM w11 LIMIT 1)".replace(
    "SELECT * REPLACE", "SELECT * EXCLUDE (one) REPLACE"))
def _(s):
    return series(s).withColumns({c: F.round(c, 6) for c in ROUNDED})


@query("a18_decay", f"SELECT channel_name, coalesce(change_pct <= -10, false) AS decaying FROM {SERIES}, (SELECT 1 AS one FROM w11 LIMIT 1)")
def _(s):
    return oa.flag_decay(series(s), -10).select("channel_name", "decaying")


@query("a19_attribution_loss", """SELECT CAST(coalesce(sum(booking_count) FILTER (WHERE lost), 0) AS BIGINT) AS bookings,
    CAST(coalesce(sum(CAST(booking_amount_kwd AS DECIMAL(18,3))) FILTER (WHERE lost), 0) AS DOUBLE) AS amount,
    CAST(sum(booking_count) FILTER (WHERE lost) AS DOUBLE) / CAST(sum(booking_count) AS DOUBLE) * 100 AS share_pct
    FROM (SELECT *, channel IS NULL OR coalesce(sessions, 0) = 0 AS lost FROM w10)""")
def _(s):
    return oa.attribution_loss(s.views["vw_web_channel_conversion"])


@query("a20_online_totals", f"""SELECT CAST(sum(oq) AS DOUBLE) AS online_units, CAST(sum(oq + wq) AS DOUBLE) AS all_units, CAST(sum(oa) AS DOUBLE) AS online_value,
    (SELECT arg_max(channel_name, overall_pct) FROM {SERIES}) AS best_channel, (SELECT max(overall_pct) FROM {SERIES}) AS best_pct
    FROM {MIX}, (SELECT 1 FROM w11 LIMIT 1)""")
def _(s):
    return oa.online_totals(oa.channel_mix_groups(s.views["vw_ticket_channel_mix"]), series(s))


MEMBERS = f"""(WITH r AS (SELECT *, lag(active_count) OVER (PARTITION BY contract_type ORDER BY month_date_key) AS prev FROM w12 WHERE month_start {IN_RANGE})
    SELECT contract_type, arg_max(active_count, month_date_key) AS latest_active, arg_max(active_mrr_kwd, month_date_key) AS latest_mrr,
      CAST(sum(churned_count) FILTER (WHERE prev IS NOT NULL) AS DOUBLE) / CAST(sum(prev) AS DOUBLE) * 100 AS churn_pct,
      arg_max(active_count, month_date_key) - arg_min(active_count, month_date_key) AS net_change FROM r GROUP BY 1)"""


@query("a21_membership_series", f"SELECT m.* FROM {MEMBERS} m, (SELECT 1 FROM w12 LIMIT 1)")
def _(s):
    return ra.membership_series(s.views["vw_membership_active_churn"], RANGE)


LEVELS = f"""(WITH r AS (SELECT * FROM w15 WHERE month_start {IN_RANGE}),
    p AS (SELECT level, month_key, CAST(sum(total_booked) AS DOUBLE) / CAST(sum(total_capacity) AS DOUBLE) * 100 AS u, sum(total_booked) AS b,
      sum(total_capacity) AS c FROM r GROUP BY 1, 2) SELECT * FROM p)"""


@query("a22_level_series", f"""WITH pk AS (SELECT level, max(u) AS peak_pct, min(u) AS trough_pct FROM {LEVELS} GROUP BY 1),
    t AS (SELECT level, CAST(sum(total_capacity) AS BIGINT) AS total_capacity, CAST(sum(total_booked) AS BIGINT) AS total_booked,
      sum(total_booked) FILTER (WHERE total_attended IS NOT NULL) AS ab, sum(total_attended) AS came, CAST(sum(overbooked_count) AS BIGINT) AS overbooked_count,
      CAST(sum(missing_attendance_count) AS BIGINT) AS missing_attendance, string_agg(DISTINCT instructor_name, ',' ORDER BY instructor_name) AS instructors
      FROM w15 WHERE month_start {IN_RANGE} GROUP BY 1)
    SELECT level, total_capacity, total_booked, CAST(total_booked AS DOUBLE) / CAST(total_capacity AS DOUBLE) * 100 AS overall_pct, peak_pct, trough_pct,
      CAST(ab - came AS DOUBLE) / CAST(ab AS DOUBLE) * 100 AS no_show_pct, overbooked_count, missing_attendance, instructors FROM t JOIN pk USING (level)""")
def _(s):
    return ra.level_series(s.views["vw_lesson_utilization_monthly"], RANGE)


@query("a23_capacity_squeeze", f"""WITH p AS (SELECT level, max(u) AS peak FROM {LEVELS} GROUP BY 1), f AS (SELECT level, peak FROM p ORDER BY peak DESC LIMIT 1),
    g AS (SELECT level FROM p ORDER BY peak LIMIT 1), hot AS (SELECT month_key FROM {LEVELS} WHERE level = (SELECT level FROM f) AND u >= 95)
    SELECT f.level AS full_level, g.level AS empty_level, f.peak AS full_peak_pct, (SELECT CAST(sum(b) AS DOUBLE) / CAST(sum(c) AS DOUBLE) * 100 FROM {LEVELS}
      WHERE level = (SELECT level FROM g) AND month_key IN (SELECT month_key FROM hot)) AS empty_at_full_peak_pct FROM f, g, (SELECT 1 FROM w15 LIMIT 1)""")
def _(s):
    return ra.capacity_squeeze(s.views["vw_lesson_utilization_monthly"], RANGE, full=95, slack=150)


@query("a24_recurring_share", f"""WITH w AS (SELECT * FROM w13 WHERE month_start NOT IN (SELECT c.month_start FROM {CELLS} c WHERE day_count < day(last_day(c.month_start))))
    SELECT count(*) AS whole_months, CAST(sum(CAST(membership_mrr_kwd AS DECIMAL(18,3))) AS DOUBLE) AS membership_mrr,
      CAST(sum(CAST(total_revenue_kwd AS DECIMAL(24,6))) AS DOUBLE) AS total_revenue,
      CAST(sum(CAST(membership_mrr_kwd AS DECIMAL(18,3))) AS DOUBLE) / CAST(sum(CAST(total_revenue_kwd AS DECIMAL(24,6))) AS DOUBLE) * 100 AS recurring_share_pct,
      CAST(arg_min(month_start, own_venue_revenue_kwd) AS VARCHAR) AS worst_month, CAST(arg_max(month_start, own_venue_revenue_kwd) AS VARCHAR) AS best_month
    FROM w, (SELECT 1 FROM cal LIMIT 1)""")
def _(s):
    partial = cal.with_partial_flag(cal.month_cells(ship_days(s))).filter("is_partial")
    return ra.recurring_share(s.views["vw_revenue_summary"], partial)


def chosen_months(s: Site) -> DataFrame:
    return cal.filter_months(s.dims["dim_date"].filter("day = 1").select(F.col("full_date").alias("month_start")), RANGE)


@query("a25_unit_values", f"""SELECT unit_no, CAST(sum(CAST(base_rent_kwd + turnover_rent_kwd AS DECIMAL(24,6))) AS DOUBLE) AS value, count(*) AS month_count,
    count(*) FILTER (WHERE is_restated) AS restated_count, CAST(sum(days_late) AS DOUBLE) / nullif(count(days_late), 0) AS days_late
    FROM v_rent WHERE month_start {IN_RANGE} GROUP BY 1""")
def _(s):
    rows, months = s.views["vw_tenant_site_metrics"], chosen_months(s)
    late = sa.unit_values(rows, months, "days_late").select("unit_no", F.col("value").alias("days_late"))
    return sa.unit_values(rows, months, "rent").join(late, "unit_no")


@query("a26_rank_buckets", f"""WITH v AS (SELECT unit_no, CAST(sum(CAST(sales_kwd AS DECIMAL(18,3))) AS DOUBLE) AS value FROM v_rent WHERE month_start {IN_RANGE} GROUP BY 1),
    r AS (SELECT *, row_number() OVER (ORDER BY value, unit_no) - 1 AS i, count(*) OVER () AS n FROM v WHERE value IS NOT NULL)
    SELECT unit_no, value, least(4, (i * 5) // n) + 1 AS bucket FROM r""")
def _(s):
    return sa.rank_buckets(sa.unit_values(s.views["vw_tenant_site_metrics"], chosen_months(s), "sales"))


@query("a27_gate_peak_hours", f"""WITH h AS (SELECT gate_id, hour, sum(CAST(avg_count_in AS DECIMAL(18,1))) AS v FROM w19 WHERE month_start {IN_RANGE} GROUP BY 1, 2)
    SELECT gate_id, arg_max(hour, v * 100 - hour) AS peak_hour FROM h GROUP BY 1""")
def _(s):
    return sa.gate_peak_hours(s.views["vw_footfall_gate_hour_monthly"], chosen_months(s))


@query("a28_gate_volumes", f"""SELECT gate_id, CAST(sum(CAST(avg_count_in AS DECIMAL(18,1))) AS DOUBLE) / count(DISTINCT month_start) AS value, bool_or(has_imputed) AS imputed
    FROM w19 WHERE month_start {IN_RANGE} GROUP BY 1""")
def _(s):
    return sa.gate_volumes(s.views["vw_footfall_gate_hour_monthly"], chosen_months(s))


def terraces(s: Site) -> DataFrame:
    """One terrace per nation, units in order of their number."""
    units = s.table("supplier").select(
        F.concat(F.lit("terrace-"), F.col("s_nationkey").cast("string")).alias("terrace_id"),
        F.lit("Units").alias("terrace_label"), F.when(F.col("s_nationkey") % 2 == 0, "east").otherwise("south").alias("direction"),
        F.lit(55.0).alias("origin_x"), F.lit(110.0).alias("origin_y"), F.col("s_suppkey").alias("position"),
        F.concat(F.lit("U-"), F.col("s_suppkey").cast("string")).alias("unit_no"))
    return units


@query("a29_unit_layout", """WITH u AS (SELECT 'U-' || s_suppkey AS unit_no, 'terrace-' || s_nationkey AS terrace_id, s_nationkey % 2 = 0 AS east,
      CAST(CASE WHEN s_suppkey % 33 = 32 THEN 0 ELSE 40 + s_suppkey % 160 END AS DOUBLE) AS sqm_area, s_suppkey, s_nationkey FROM supplier),
    o AS (SELECT *, sqm_area * 30 / 60 AS frontage, coalesce(sum(sqm_area * 30 / 60) OVER (PARTITION BY s_nationkey ORDER BY s_suppkey
      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS ahead FROM u)
    SELECT unit_no, terrace_id, CASE WHEN east THEN 'horizontal' ELSE 'vertical' END AS orientation, sqm_area AS unit_sqm,
      round(CASE WHEN east THEN 55 + ahead ELSE 55 END, 2) AS x, round(CASE WHEN east THEN 110 ELSE 110 + ahead END, 2) AS y,
      round(CASE WHEN east THEN frontage ELSE 60 END, 2) AS width, round(CASE WHEN east THEN 60 ELSE frontage END, 2) AS height FROM o""")
def _(s):
    out = sa.unit_layout(s.dims["dim_tenant"], terraces(s), 30, 60)
    return out.select("unit_no", "terrace_id", "orientation", "unit_sqm", "x", "y", "width", "height")


@query("a30_recurring_totals", f"""SELECT CAST(sum(CAST(latest_mrr AS DECIMAL(18,3))) AS DOUBLE) AS total_mrr, CAST(sum(latest_active) AS BIGINT) AS total_active
    FROM {MEMBERS}, (SELECT 1 FROM w12 LIMIT 1)""")
def _(s):
    return ra.recurring_totals(ra.membership_series(s.views["vw_membership_active_churn"], RANGE))


# ---- export: every view, each computed once

VIEW_QUERIES = {
    "vw_footfall_daily": "w1", "vw_footfall_by_zone": "w2", "vw_footfall_sales_conversion": "w3", "vw_event_roi": "w4",
    "vw_avg_transaction_value": "w5", "vw_tenant_turnover_rent": "w6", "vw_tenant_sales_per_sqm": "w7", "vw_tenant_compliance": "w8",
    "vw_ticket_channel_mix": "w9", "vw_web_channel_conversion": "w10", "vw_web_channel_conversion_monthly": "w11",
    "vw_membership_active_churn": "w12", "vw_revenue_summary": "w13", "vw_lesson_utilization": "w14", "vw_lesson_utilization_monthly": "w15",
    "vw_instructor_coverage": "w16", "vw_stable_occupancy": "w17", "vw_tenant_site_metrics": "w18", "vw_footfall_gate_hour_monthly": "w19",
}
COUNTS = {view: next(f"SELECT count(*) AS row_count FROM ({sql})" for name, sql in ORACLE.items() if name.startswith(f"{w}_"))
          for view, w in VIEW_QUERIES.items()}


def exported(s: Site) -> DataFrame:
    """All views written as JSON from stored facts, and counted from what was written."""
    _, dims, facts = stored_layers(s)
    return exports.export_views(view_ops.build_views(dims, facts), scratch(s, "export"))


@query("s15_row_manifest")
def _(s):
    return exported(s)


ORACLE["s15_row_manifest"] = " UNION ALL ".join(f"SELECT '{view}' AS view, row_count FROM ({sql})" for view, sql in COUNTS.items())


@query("s14_metric_register")
def _(s):
    """Which metric is on, the view behind it, and what that view holds."""
    return exports.register_frame(s.spark, s.cfg | {"metrics": {"enabled": ["event_roi", "footfall_vs_ly_weather"]}}).join(exported(s), "view", "left")


ORACLE["s14_metric_register"] = " UNION ALL ".join(
    f"SELECT '{metric}' AS metric, '{view}' AS view, {metric in ('event_roi', 'footfall_vs_ly_weather')} AS enabled, row_count FROM ({COUNTS[view]})"
    for metric, view in exports.METRIC_VIEWS.items())
