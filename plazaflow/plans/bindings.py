"""The supplied tables seen as landed drops.

Every frame has the all-text shape of a landed source, so queries go through the
same conforming, dimension and fact code as real drops. The planted faults (re-exports,
dead sensors, double counting, restatements, reversed dates) are functions of the
rows themselves, so the same tables can be derived in SQL.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from plazaflow.functions.columns import month_start
from plazaflow.operators import dims as dim_ops, facts as fact_ops, views as view_ops
from plazaflow.plans.warehouse import silver_frames

START, END = "1995-01-01", "2001-08-01"
VISIT_SHIFT_DAYS = 8400  # web events of 2024 moved into the calendar

CONFIG = {
    "date_range": {"start": START, "end": END},
    "weekend": ["FRI", "SAT"],
    "calendar": {
        "ramadan_periods": [
            {"start": "1995-01-31", "end": "1995-03-01"}, {"start": "1996-01-21", "end": "1996-02-19"},
            {"start": "1997-01-10", "end": "1997-02-07"}, {"start": "1997-12-30", "end": "1998-01-28"},
            {"start": "1998-12-19", "end": "1999-01-17"}, {"start": "1999-12-09", "end": "2000-01-06"},
            {"start": "2000-11-27", "end": "2000-12-26"},
        ],
        "public_holidays": [
            {"date": f"{year}-02-{day}", "name": name}
            for year in range(1995, 2002) for day, name in ((25, "National Day"), (26, "Liberation Day"))
        ],
        "season_boundaries": {
            "winter_peak": {"start": "10-15", "end": "03-31"},
            "summer_trough": {"start": "06-01", "end": "08-31"},
        },
    },
    "gate_aliases": {
        "G01": ["Main Gate", "GATE_1", "G1"], "G02": ["North Gate", "GATE_2", "G2"],
        "G03": ["Equestrian Gate", "GATE_3", "G3"], "G04": ["East Gate", "GATE_4", "G4"],
    },
    "booking_product_family": {f"family_{i}": f"sku_{i}" for i in range(7)},  # family_7 is not mapped
    "spatial": {
        "gates": {
            "G01": {"gate_label": "Main Gate", "zone": "west_strip"},
            "G02": {"gate_label": "Main Gate", "zone": "west_strip"},
            "G03": {"gate_label": "Equestrian Gate", "zone": "north_east", "primary_venue_served": "V04"},
            "G04": {"gate_label": "Equestrian Gate", "zone": "north_east", "primary_venue_served": "V04"},
        },
        "venues": {
            "V01": {"zone": "south_east", "gate_proximity": "Main Gate"},
            "V02": {"zone": "west_strip_south", "gate_proximity": "Main Gate"},
            "V03": {"zone": "north_centre", "gate_proximity": "Main Gate"},
            "V04": {"zone": "north_east", "gate_proximity": "Equestrian Gate"},
        },
        "tenants": {f"T{i}": {"zone": "west_strip", "gate_proximity": "Main Gate"} for i in range(10)},
    },
    "seasonality": {"park": [
        {"date": "01-01", "factor": 1.35}, {"date": "03-31", "factor": 1.30}, {"date": "04-15", "factor": 0.85},
        {"date": "05-15", "factor": 0.55}, {"date": "06-01", "factor": 0.35}, {"date": "08-31", "factor": 0.35},
        {"date": "09-15", "factor": 0.55}, {"date": "10-01", "factor": 0.90}, {"date": "10-15", "factor": 1.35},
    ]},
}

CHANNELS = ["organic", "paid_social", "direct", "referral"]
LEVELS = ["beginner", "intermediate", "advanced"]
CONTRACT_TYPES = ["gym_monthly", "gym_annual", "equestrian_club", "horse_boarding", "day_member"]


def text(c: Column) -> Column:
    return c.cast("string")


def ymd(c: Column) -> Column:
    return F.date_format(c, "yyyyMMdd")


def pick(values: list[str], index: Column) -> Column:
    return F.element_at(F.array(*[F.lit(v) for v in values]), (index + 1).cast("int"))


def visit_date() -> Column:
    moved = F.date_sub(F.col("ts").cast("date"), VISIT_SHIFT_DAYS)
    return F.add_months(moved, (-(F.col("user_id") % 24)).cast("int"))


class Site:
    """Landed, silver, gold and view frames over one folder of the supplied tables."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir, self.cfg = spark, sf_dir, CONFIG

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")

    @cached_property
    def landed(self) -> dict[str, DataFrame]:
        frames = {
            "pos_sales": self._pos(), "footfall": self._footfall(), "tenant_sales": self._filings(),
            "contracts": self._contracts(), "lessons": self._lessons(), "events": self._events(),
            "weather": self._weather(), "web_sessions": self._sessions(), "web_bookings": self._bookings(),
        }
        return frames | self._master()

    @cached_property
    def silver(self) -> dict[str, DataFrame]:
        return silver_frames(lambda source: self.landed[source], self.cfg, self.spark)

    @cached_property
    def dims(self) -> dict[str, DataFrame]:
        return dim_ops.build_dims(self.spark, self.silver, self.cfg)

    @cached_property
    def facts(self) -> dict[str, DataFrame]:
        return fact_ops.build_facts(self.spark, self.silver, self.dims, self.cfg)

    @cached_property
    def views(self) -> dict[str, DataFrame]:
        return view_ops.build_views(self.dims, self.facts)

    @cached_property
    def crosswalk(self) -> DataFrame:
        return fact_ops.crosswalk_frame(self.spark, self.cfg)

    # ---- landed sources

    def _pos(self) -> DataFrame:
        refund = F.col("l_returnflag") == "R"
        date = F.when(refund, F.col("l_shipdate")).otherwise(F.col("o_orderdate")).cast("date")
        sign = F.when(refund, -1).otherwise(1)
        order = F.col("l_orderkey")
        lines = self.table("lineitem").join(
            self.table("orders").select("o_orderkey", "o_custkey", "o_orderdate"), F.col("l_orderkey") == F.col("o_orderkey")
        )
        once = lines.select(
            F.concat(F.when(refund, "RF").otherwise("INV"), text(order)).alias("invoiceid"),
            F.concat(F.lit("S"), text(order)).alias("salesid"),
            text(date).alias("invoicedate"),
            F.concat(F.lit("P"), text(F.col("l_partkey"))).alias("itemid"),
            F.concat(F.lit("Item "), text(F.col("l_partkey"))).alias("itemname"),
            text((sign * F.col("l_quantity")).cast("decimal(10,2)")).alias("qty"),
            text(F.col("l_extendedprice").cast("decimal(12,3)")).alias("salesprice"),
            text((sign * F.col("l_extendedprice")).cast("decimal(12,3)")).alias("lineamount"),
            F.concat(F.lit("V0"), text(1 + F.col("l_suppkey") % 4)).alias("inventlocationid"),
            F.when(F.col("l_linenumber") % 2 == 1, F.concat(F.lit("C"), text(F.col("o_custkey")))).alias("custaccount"),
            F.when(F.col("l_linestatus") == "O", "card").otherwise("cash").alias("paymentmode"),
            F.concat(text(date), F.lit(" 10:0"), text(F.col("l_linenumber")), F.lit(":00")).alias("createddatetime"),
            F.concat(F.lit("d365_salesline_"), ymd(date)).alias("_file"),
            (order % 50 == 0).alias("_exported_twice"),
        )
        # an export overlap: some invoices land a second time in a later file
        copies = F.when(F.col("_exported_twice"), F.array(F.lit(""), F.lit("_again"))).otherwise(F.array(F.lit("")))
        landed = once.withColumn("_copy", F.explode(copies))
        return landed.withColumn("_source_file", F.concat("_file", "_copy", F.lit(".csv"))).drop(
            "_copy", "_exported_twice", "_file")

    def _footfall(self) -> DataFrame:
        day = F.unix_date("d")
        # grouped on numbers, named afterwards: strings per counted cell, not per line
        counts = self.table("lineitem").groupBy(
            (1 + F.col("l_suppkey") % 4).alias("gate"), F.col("l_shipdate").cast("date").alias("d"),
            (9 + F.col("l_partkey") % 4 * 3).alias("hour"),
        ).agg(F.sum("l_quantity").cast("bigint").alias("n"), F.count(F.lit(1)).alias("k"))
        counts = counts.withColumn("sensor_id", F.concat(F.lit("G0"), text(F.col("gate"))))
        twice = (F.col("sensor_id") == "G04") & F.col("d").between(F.lit("1998-06-01"), F.lit("1998-06-14"))
        factor = F.when(twice, 2).otherwise(1)
        number = text(F.col("gate"))
        canonical = pick(["Main Gate", "North Gate", "Equestrian Gate", "East Gate"], F.col("gate") - 1)
        label = (
            F.when(day % 31 == 7, "Gate ?").when(day % 37 == 5, "G1")
            .when(day % 4 == 1, F.concat(F.lit("GATE_"), number)).when(day % 4 == 2, F.concat(F.lit("G"), number))
            .when(day % 4 == 3, F.concat(F.lit(" "), canonical, F.lit(" "))).otherwise(canonical)
        )
        return counts.select(
            "sensor_id", label.alias("gate_name"), text(F.col("d")).alias("date"), text(F.col("hour")).alias("hour"),
            text(F.when(day % 97 != 13, F.col("n") * factor)).alias("count_in"),
            text(F.when(day % 97 != 41, (F.col("n") - F.col("k")) * factor)).alias("count_out"),
            F.concat(F.lit("footfall_"), ymd(F.col("d")), F.lit(".csv")).alias("_source_file"),
        )

    def _filings(self) -> DataFrame:
        s, m = F.col("s"), F.col("m")
        index = F.year(m) * 12 + F.month(m)
        sales = self.table("lineitem").groupBy(
            F.col("l_suppkey").alias("s"), month_start(F.col("l_shipdate").cast("date")).alias("m"),
            F.when(F.dayofmonth("l_shipdate") <= 15, 1).otherwise(2).alias("half"),
        ).agg(F.sum(F.col("l_extendedprice").cast("decimal(12,2)")).cast("decimal(12,2)").alias("gross"))
        versions = F.when((s + index) % 10 == 0, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
        sales = sales.withColumns({"i": index, "v": F.explode(versions)})
        gross = F.when(F.col("v") == 2, F.col("gross") * F.lit("1.05").cast("decimal(3,2)")).otherwise(
            F.col("gross").cast("decimal(16,4)")).cast("decimal(12,2)")
        net = (gross * F.lit("0.9").cast("decimal(2,1)")).cast("decimal(12,2)")
        day = F.date_add(m, 14 * (F.col("half") - 1))
        shown = F.when((s + F.col("i")) % 29 == 0, "pending").otherwise(
            F.when(s % 3 == 0, text(day)).when(s % 3 == 1, F.date_format(day, "dd/MM/yyyy"))
            .otherwise(F.date_format(day, "MMMM yyyy")))
        late = (5 + (s * 7 + F.col("i")) % 36 + 20 * (F.col("v") - 1)).cast("int")
        restated = F.col("v") == 2
        return sales.select(
            F.concat(F.lit("T"), text(s)).alias("tenant_id"), F.date_format(m, "yyyy-MM").alias("sales_month"),
            restated.alias("is_restatement"), shown.alias("date_raw"),
            F.when(s % 3 != 1, F.when((s + F.col("i")) % 23 == 0, "n/a").otherwise(text(gross))).alias("gross_sales_raw"),
            F.when(s % 3 != 0, text(net)).alias("net_sales_raw"),
            text(F.when((s + F.col("i")) % 41 != 0, F.date_add(F.last_day(m), late))).alias("submitted_date"),
            F.concat(F.lit("tenant_sales_t"), text(s), F.lit("_"), F.date_format(m, "yyyy-MM"),
                     F.when(restated, "_restated").otherwise(""), F.lit(".csv")).alias("_source_file"),
        )

    def _contracts(self) -> DataFrame:
        k, cust, status = F.col("o_orderkey"), F.col("o_custkey"), F.col("o_orderstatus")
        start = F.col("o_orderdate").cast("date")
        kind = pick(CONTRACT_TYPES, F.substring("o_orderpriority", 1, 1).cast("int") - 1)
        end = F.when(status != "O", F.date_add(start, (k % 900).cast("int")))
        cancelled = F.when(status == "P", F.when(k % 50 == 1, F.date_sub(start, 5)).otherwise(end))
        final = self.table("orders").select(
            F.concat(F.lit("K"), text(k)).alias("contract_id"), F.concat(F.lit("M"), text(cust)).alias("member_id"),
            kind.alias("contract_type"), F.concat(F.lit("V0"), text(1 + cust % 4)).alias("venue_id"),
            text(start).alias("start_date"), text(end).alias("end_date"),
            text((10 + k % 40).cast("decimal(12,3)")).alias("monthly_amount_kwd"),
            F.when(status == "P", "cancelled").when(status == "F", "expired").otherwise("active").alias("status"),
            text(cancelled).alias("cancellation_date"),
            F.when(kind == "horse_boarding", F.concat(F.lit("S"), text(k % 20))).alias("stable_id"),
            F.when(cust % 13 != 0, F.concat(F.lit("ph"), text(F.floor(cust / 3)))).alias("phone_number"),
            F.lit("contracts_200112.csv").alias("_source_file"),
        )
        # the export of the first month shows the contract as still open
        snapshots = F.explode(F.array(F.lit("first"), F.lit("last")))
        both = final.withColumn("_export", snapshots)
        early = F.col("_export") == "first"
        return both.withColumns({
            "end_date": F.when(~early, F.col("end_date")),
            "cancellation_date": F.when(~early, F.col("cancellation_date")),
            "status": F.when(early, "active").otherwise(F.col("status")),
            "_source_file": F.when(early, F.concat(F.lit("contracts_"), F.date_format(
                F.col("start_date").cast("date"), "yyyyMM"), F.lit(".csv"))).otherwise(F.col("_source_file")),
        }).drop("_export")

    def _lessons(self) -> DataFrame:
        part = self.table("part").select("p_partkey", "p_size", "p_type")
        rows = self.table("lineitem").join(part, F.col("l_partkey") == F.col("p_partkey"))
        came = F.greatest(F.col("l_quantity").cast("int") - (F.col("l_orderkey") % 3).cast("int"), F.lit(0))
        day = F.col("l_shipdate").cast("date")
        return rows.select(
            F.concat(F.lit("L"), text(F.col("l_orderkey")), F.lit("-"), text(F.col("l_linenumber"))).alias("lesson_id"),
            text(day).alias("lesson_date"),
            F.concat(F.lit("1"), text(F.col("l_linenumber")), F.lit(":00")).alias("start_time"),
            F.concat(F.lit("I"), text(F.col("l_suppkey") % 23)).alias("instructor_id"),
            pick(LEVELS, F.col("l_partkey") % 3).alias("level"),
            text(F.col("p_size")).alias("capacity"), text(F.col("l_quantity").cast("int")).alias("booked"),
            F.when(F.col("l_returnflag") == "A", "not marked").otherwise(text(came)).alias("attended"),
            F.concat(F.lit("H"), text(F.col("l_linenumber")), F.lit(",H"), text(F.col("l_suppkey") % 8)).alias("horse_ids"),
            F.concat(F.lit("lessons_"), ymd(day), F.lit(".csv")).alias("_source_file"),
        )

    def _events(self) -> DataFrame:
        """A launch event per supplier: some reversed, some without an end, many overlapping."""
        s = F.col("s_suppkey")
        start = F.date_add(F.lit("1995-02-01").cast("date"), (s * 37 % 2200).cast("int"))
        end = F.when(s % 17 == 5, F.date_sub(start, 1)).when(s % 11 == 3, F.lit(None).cast("date")).otherwise(
            F.date_add(start, (s % 4).cast("int")))
        return self.table("supplier").select(
            F.concat(F.lit("EVT"), text(s)).alias("event_id"), F.concat(F.lit("Launch "), F.col("s_name")).alias("event_name"),
            F.when(s % 2 == 0, "bazaar").otherwise("kids").alias("event_type"), text(start).alias("start_date"),
            text(end).alias("end_date"), text(500 + s % 9 * 100).alias("expected_attendance"),
            F.lit("events.csv").alias("_source_file"),
        )

    def _weather(self) -> DataFrame:
        days = self.table("orders").groupBy(F.col("o_orderdate").cast("date").alias("d")).agg(F.count(F.lit(1)).alias("n"))
        n = F.col("n")
        return days.select(
            text(F.col("d")).alias("date"), text(20 + n % 15).alias("temp_max_c"), text(10 + n % 7).alias("temp_min_c"),
            F.when(n % 7 == 0, "True").otherwise("False").alias("dust_storm_flag"),
            text((n % 10 * 5).cast("decimal(6,1)") / 10).alias("rain_mm"),
            F.concat(F.lit("weather_"), ymd(F.col("d")), F.lit(".csv")).alias("_source_file"),
        )

    def _sessions(self) -> DataFrame:
        kind = F.col("event_type")
        seen = self.table("events").filter(kind.isin("view", "click"))
        sums = seen.groupBy(
            visit_date().alias("d"), (F.col("user_id") % 4).alias("c"), (F.col("event_id") % 2).alias("dev")
        ).agg(
            F.count(F.lit(1)).alias("sessions"), F.count(F.when(kind == "click", 1)).alias("engaged"),
            F.count_distinct("user_id").alias("users"),
        )
        return sums.select(
            text(F.col("d")).alias("date"), pick(CHANNELS, F.col("c")).alias("channel"),
            F.when(F.col("dev") == 0, "mobile").otherwise("desktop").alias("device"), text(F.col("sessions")).alias("sessions"),
            text(F.col("engaged")).alias("engaged_sessions"), text(F.col("users")).alias("users"),
            F.concat(F.lit("web_sessions_"), ymd(F.col("d")), F.lit(".csv")).alias("_source_file"),
        )

    def _bookings(self) -> DataFrame:
        e, u = F.col("event_id"), F.col("user_id")
        day = F.date_add(visit_date(), F.when(e % 97 == 0, 300).otherwise(0))
        channel = F.when(u % 20 != 0, F.when(u % 20 == 1, "partner").otherwise(pick(CHANNELS, u % 4)))
        amount = F.when(e % 25 == 0, -F.col("value")).otherwise(F.col("value")).cast("decimal(12,3)")
        return self.table("events").filter(F.col("event_type") == "purchase").select(
            F.concat(F.lit("B"), text(e)).alias("booking_id"),
            F.concat(text(day), F.lit(" "), F.date_format("ts", "HH:mm:ss")).alias("booking_datetime"),
            F.concat(F.lit("family_"), text(u % 8)).alias("product_code"), text(1 + e % 4).alias("qty"),
            text(amount).alias("amount_kwd"), channel.alias("channel"), F.concat(F.lit("C"), text(u)).alias("customer_id"),
            F.concat(F.lit("web_bookings_"), ymd(day), F.lit(".csv")).alias("_source_file"),
        )

    # ---- master data

    def _master(self) -> dict[str, DataFrame]:
        region, nation, part, supplier = (self.table(t) for t in ("region", "nation", "part", "supplier"))
        number = text(F.col("r_regionkey") + 1)
        p, n, s = F.col("p_partkey"), F.col("n_nationkey"), F.col("s_suppkey")
        split = s % 10 == 0
        versions = supplier.withColumn("v", F.explode(
            F.when(split, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))))
        begin = F.when(F.col("v") == 2, "1998-06-01").when(s % 25 == 7, "1996-01-01").otherwise("1994-01-01")

        def named(df: DataFrame, name: str) -> DataFrame:
            return df.withColumn("_source_file", F.lit(f"{name}.csv"))

        return {
            "master_venues": named(region.select(
                F.concat(F.lit("V0"), number).alias("venue_id"), F.col("r_name").alias("venue_name"),
                F.lit("own").alias("venue_type"), F.lit("1994-01-01").alias("opened_date"),
                F.lit(None).cast("string").alias("description")), "venues"),
            "master_gates": named(region.select(
                F.concat(F.lit("G0"), number).alias("gate_id"), F.concat(F.lit("Gate "), number).alias("gate_name"),
                F.col("r_name").alias("description")), "gates"),
            "master_products": named(part.select(
                F.concat(F.lit("P"), text(p)).alias("product_id"), F.concat(F.lit("sku_"), text(p)).alias("product_code"),
                F.concat("p_name", F.lit(" "), text(p)).alias("product_name"),
                F.when(p % 10 != 9, F.concat(F.lit("V0"), text(1 + p % 5))).alias("venue_id"),
                F.when(p % 4 == 0, "ticket").otherwise(F.lower("p_type")).alias("category"),
                text(F.col("p_retailprice").cast("decimal(12,3)")).alias("unit_price_kwd")), "products"),
            "master_tenants": named(versions.select(
                F.concat(F.lit("T"), text(s)).alias("tenant_id"), F.col("s_name").alias("tenant_name"),
                F.concat(F.lit("cat_"), text((F.col("s_nationkey") + F.col("v") - 1) % 5)).alias("category"),
                F.concat(F.lit("U-"), text(s)).alias("unit_no"),
                text(F.when(s % 33 == 32, 0).otherwise(40 + s % 160)).alias("unit_sqm"),
                F.lit("1994-01-01").alias("lease_start"), F.lit("open").alias("lease_end"),
                text(500 + s % 20 * 50).alias("base_rent_kwd"), text(5 + s % 6).alias("turnover_rent_pct"),
                text(300000 + s % 10 * 20000).alias("turnover_threshold_kwd"), F.lit("active").alias("status"),
                begin.alias("effective_start_date"),
                F.when(split & (F.col("v") == 1), "1998-05-31").alias("effective_end_date")), "tenants"),
            "master_stables": named(nation.select(
                F.concat(F.lit("S"), text(n)).alias("stable_id"), F.concat(F.lit("B-"), text(n)).alias("box_no"),
                F.lit("standard").alias("size_category"), F.lit("active").alias("status")), "stables"),
            "master_instructors": named(nation.select(
                F.concat(F.lit("I"), text(n)).alias("instructor_id"), F.col("n_name").alias("instructor_name"),
                F.lit("all_levels").alias("specialty_level"), F.lit("1994-01-01").alias("hire_date"),
                F.lit("active").alias("status")), "instructors"),
            "master_horses": named(nation.select(
                F.concat(F.lit("H"), text(n)).alias("horse_id"), F.col("n_name").alias("horse_name"),
                F.lit("Arabian").alias("breed"), F.lit("beginner").alias("level_suitability"),
                F.concat(F.lit("S"), text(n)).alias("stable_id")), "horses"),
        }
