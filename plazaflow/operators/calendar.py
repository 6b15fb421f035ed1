"""Calendar spine, calendar attributes, seasons, month cells and date filters."""

from __future__ import annotations

import datetime as dt
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from plazaflow.functions.columns import any_of, date_key, lookup, month_start
from plazaflow.functions.frames import literal_frame

DateRange = tuple[str, str] | None


def date_spine(spark: SparkSession, start: str, end: str) -> DataFrame:
    """One row per day, both ends included."""
    days = (dt.date.fromisoformat(end) - dt.date.fromisoformat(start)).days + 1
    offset = F.col("id").cast("int")
    return spark.range(days).select(F.date_add(F.lit(start).cast("date"), offset).alias("full_date"))


def calendar_columns(spine: DataFrame) -> DataFrame:
    d = F.col("full_date")
    return spine.select(
        date_key(d).alias("date_key"),
        "full_date",
        F.year(d).alias("year"),
        F.quarter(d).alias("quarter"),
        F.month(d).alias("month"),
        F.date_format(d, "MMMM").alias("month_name"),
        F.dayofmonth(d).alias("day"),
        (F.weekday(d) + 1).alias("day_of_week"),
        F.date_format(d, "EEEE").alias("day_name"),
        *[c for c in spine.columns if c != "full_date"],
    )


def is_weekend(date: Column, codes: list[str]) -> Column:
    short = F.upper(F.substring(F.date_format(date, "EEEE"), 1, 3))
    return short.isin([c[:3].upper() for c in codes])


def with_weekend(df: DataFrame, date_col: str, codes: list[str]) -> DataFrame:
    return df.withColumn("is_weekend", is_weekend(F.col(date_col), codes))


def with_period_flag(df: DataFrame, date_col: str, ranges: list[tuple[str, str]], name: str) -> DataFrame:
    """True inside any of the inclusive ranges."""
    d = F.col(date_col)
    tests = [d.between(F.lit(s).cast("date"), F.lit(e).cast("date")) for s, e in ranges]
    return df.withColumn(name, any_of(tests) if tests else F.lit(False))


def with_holidays(df: DataFrame, holidays: DataFrame, date_col: str = "full_date") -> DataFrame:
    """holidays: holiday_date, holiday_name."""
    joined = lookup(df, holidays, F.col(date_col) == F.col("holiday_date")).drop("holiday_date")
    return joined.withColumn("is_public_holiday", F.col("holiday_name").isNotNull())


def _month_day(text: str) -> int:
    month, day = text.split("-")
    return int(month) * 100 + int(day)


def with_season(df: DataFrame, date_col: str, boundaries: dict[str, dict[str, str]]) -> DataFrame:
    """Label of the first window that holds the month-day; a window may wrap the year end."""
    md = F.month(date_col) * 100 + F.dayofmonth(date_col)
    label = F.lit("shoulder")
    for season in reversed(list(boundaries)):
        start, end = (_month_day(boundaries[season][k]) for k in ("start", "end"))
        inside = md.between(start, end) if start <= end else (md >= start) | (md <= end)
        label = F.when(inside, F.lit(season)).otherwise(label)
    return df.withColumn("season", label)


def dim_date(spark: SparkSession, cfg: dict) -> DataFrame:
    span, cal = cfg["date_range"], cfg["calendar"]
    base = calendar_columns(date_spine(spark, span["start"], span["end"]))
    base = with_weekend(base, "full_date", cfg["weekend"])
    periods = [(p["start"], p["end"]) for p in cal["ramadan_periods"]]
    base = with_period_flag(base, "full_date", periods, "is_ramadan")
    base = with_holidays(base, holiday_frame(spark, cfg))
    base = with_season(base, "full_date", cal["season_boundaries"])
    return base.select(
        "date_key", "full_date", "year", "quarter", "month", "month_name", "day", "day_of_week",
        "day_name", "is_weekend", "is_ramadan", "is_public_holiday", "holiday_name", "season",
    )


def holiday_frame(spark: SparkSession, cfg: dict) -> DataFrame:
    rows = [(dt.date.fromisoformat(h["date"]), h["name"]) for h in cfg["calendar"]["public_holidays"]]
    return literal_frame(spark, rows, {"holiday_date": "date", "holiday_name": "string"})


def anchor_frame(spark: SparkSession, anchors: list[dict]) -> DataFrame:
    rows = [(a["date"], float(a["factor"])) for a in anchors]
    return literal_frame(spark, rows, {"month_day": "string", "factor": "double"})


def year_fraction(date: Column) -> Column:
    year = F.year(date)
    leap = (year % 4 == 0) & ((year % 100 != 0) | (year % 400 == 0))
    return (F.dayofyear(date) - 1).cast("double") / F.when(leap, 366.0).otherwise(365.0)


def seasonality_factor(df: DataFrame, date_col: str, anchors: DataFrame) -> DataFrame:
    """Adds `seasonality_factor`: linear between anchors, wrapping at the year end.

    anchors: month_day "MM-DD", factor. They are a handful of configuration rows,
    so their window is tiny. The curve is tabulated once per (day of year, year
    length), 731 rows, and the data is joined to it by equality.
    """
    point = anchors.select(
        ((F.dayofyear(F.to_date(F.concat(F.lit("2001-"), "month_day"))) - 1) / F.lit(365.0)).alias("x0"),
        F.col("factor").alias("y0"),
    )
    every = Window.orderBy("x0")
    whole = Window.partitionBy()
    step = point.select(
        "x0", "y0",
        F.coalesce(F.lead("x0").over(every), F.min("x0").over(whole) + 1).alias("x1"),
        F.coalesce(F.lead("y0").over(every), F.min_by("y0", "x0").over(whole)).alias("y1"),
        F.row_number().over(Window.orderBy(F.desc("x0"))).alias("from_end"),
    )
    # the closing segment also serves the days before the first anchor
    before = step.filter("from_end = 1").withColumn("x0", F.col("x0") - 1).withColumn("x1", F.col("x1") - 1)
    segments = step.unionByName(before)
    spark = df.sparkSession
    days = spark.range(731).select(
        F.when(F.col("id") < 365, 365).otherwise(366).alias("_year_days"),
        (F.when(F.col("id") < 365, F.col("id")).otherwise(F.col("id") - 365) + 1).cast("int").alias("_doy"),
    )
    x = (F.col("_doy") - 1) / F.col("_year_days").cast("double")
    curve = days.join(F.broadcast(segments), (x >= F.col("x0")) & (x < F.col("x1"))).select(
        "_year_days", "_doy",
        ((F.col("y1") - F.col("y0")) / (F.col("x1") - F.col("x0")) * (x - F.col("x0")) + F.col("y0"))
        .alias("seasonality_factor"),
    )
    year = F.year(date_col)
    leap = (year % 4 == 0) & ((year % 100 != 0) | (year % 400 == 0))
    keyed = df.withColumn("_doy", F.dayofyear(date_col)).withColumn(
        "_year_days", F.when(leap, 366).otherwise(365)
    )
    return keyed.join(F.broadcast(curve), ["_doy", "_year_days"], "left").drop("_doy", "_year_days")


def normalised_shares(weights: DataFrame, by: list[str], value: str) -> DataFrame:
    """Adds `share`, the value over the sum of its group."""
    total = weights.groupBy(*by).agg(F.sum(value).alias("_total"))
    share = F.col(value).cast("double") / F.when(F.col("_total") != 0, F.col("_total")).cast("double")
    return weights.join(total, by, "left").withColumn("share", share).drop("_total")


def date_weather(dates: DataFrame, weather: DataFrame) -> DataFrame:
    joined = dates.select("date_key", "full_date").join(weather, F.col("full_date") == F.col("weather_date"))
    return joined.select("date_key", "temp_max_c", "temp_min_c", "dust_storm_flag", "rain_mm")


def month_cells(daily: DataFrame) -> DataFrame:
    """Month, last date present, season of most days (earliest seen on ties), days present."""
    per_season = daily.groupBy(month_start("full_date").alias("month_start"), "season").agg(
        F.count(F.lit(1)).alias("_days"), F.min("full_date").alias("_first"), F.max("full_date").alias("_last")
    )
    strength = F.struct(F.col("_days"), -F.unix_date("_first"))
    return per_season.groupBy("month_start").agg(
        F.max("_last").alias("month_end"),
        F.max_by("season", strength).alias("season"),
        F.sum("_days").alias("day_count"),
    )


def with_partial_flag(cells: DataFrame) -> DataFrame:
    return cells.withColumn("is_partial", F.col("day_count") < F.dayofmonth(F.last_day("month_start")))


def months_to_range(cells: DataFrame) -> DataFrame:
    return cells.agg(F.min("month_start").alias("start"), F.max("month_end").alias("end"))


def _between(col: Column, rng: DateRange) -> Column:
    return col.between(F.lit(rng[0]).cast("date"), F.lit(rng[1]).cast("date"))


def filter_dates(df: DataFrame, rng: DateRange, col: str = "full_date") -> DataFrame:
    return df if rng is None else df.filter(_between(F.col(col), rng))


def filter_months(df: DataFrame, rng: DateRange, col: str = "month_start") -> DataFrame:
    """A month counts when its first day is in range."""
    return filter_dates(df, rng, col)


def filter_month_key(df: DataFrame, rng: DateRange, col: str = "month_key") -> DataFrame:
    """For rows whose month_start may be null."""
    if rng is None:
        return df
    low, high = (int(d[:4]) * 100 + int(d[5:7]) for d in rng)
    return df.filter(F.col(col).between(low, high))


def months_overlapping(cells: DataFrame, rng: DateRange) -> DataFrame:
    if rng is None:
        return cells.select("month_start")
    start, end = (F.lit(d).cast("date") for d in rng)
    return cells.filter((F.col("month_start") <= end) & (F.col("month_end") >= start)).select("month_start")


def overlaps(start: Column, end: Column, rng: DateRange) -> Column:
    """Overlap test that also accepts a reversed pair."""
    if rng is None:
        return F.lit(True)
    last = F.coalesce(end, start)
    low, high = F.least(start, last), F.greatest(start, last)
    return (low <= F.lit(rng[1]).cast("date")) & (high >= F.lit(rng[0]).cast("date"))


def union_all(frames: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)
