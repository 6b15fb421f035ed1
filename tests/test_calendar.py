import datetime as dt

import pytest
from pyspark.sql import functions as F

from plazaflow.functions.frames import literal_frame
from plazaflow.operators import calendar as cal


@pytest.fixture(scope="module")
def days(spark, cfg):
    return {r["full_date"]: r for r in cal.dim_date(spark, cfg).collect()}


def test_spine_has_every_day_once(days):
    assert len(days) == 731
    assert len({r["date_key"] for r in days.values()}) == 731
    assert min(days) == dt.date(2024, 7, 1) and max(days) == dt.date(2026, 7, 1)


def test_weekend_is_the_configured_one(days):
    assert {r["day_name"] for r in days.values() if r["is_weekend"]} == {"Friday", "Saturday"}
    assert not any(r["is_weekend"] for r in days.values() if r["day_name"] not in ("Friday", "Saturday"))


@pytest.mark.parametrize("start,end", [("2025-03-01", "2025-03-29"), ("2026-02-18", "2026-03-19")])
def test_period_flag_edges(days, start, end):
    first, last, day = dt.date.fromisoformat(start), dt.date.fromisoformat(end), dt.timedelta(days=1)
    assert days[first]["is_ramadan"] and days[last]["is_ramadan"]
    assert not days[first - day]["is_ramadan"] and not days[last + day]["is_ramadan"]


def test_holidays_and_seasons(days):
    assert days[dt.date(2025, 2, 25)]["holiday_name"] == "National Day"
    assert days[dt.date(2025, 2, 26)]["is_public_holiday"]
    assert days[dt.date(2025, 2, 27)]["holiday_name"] is None
    seasons = {d: days[dt.date.fromisoformat(d)]["season"] for d in ("2025-01-15", "2025-07-15", "2025-05-01")}
    assert seasons == {"2025-01-15": "winter_peak", "2025-07-15": "summer_trough", "2025-05-01": "shoulder"}


def factors(spark, cfg, profile, dates):
    df = literal_frame(spark, [(dt.date.fromisoformat(d),) for d in dates], {"d": "date"})
    out = cal.seasonality_factor(df, "d", cal.anchor_frame(spark, cfg["seasonality"]["profiles"][profile]))
    return {str(r["d"]): r["seasonality_factor"] for r in out.collect()}


def test_seasonality_shapes(spark, cfg):
    dates = ["2025-01-15", "2025-04-15", "2025-07-15", "2025-10-15", "2024-12-31", "2025-01-05", "2025-06-15"]
    park = factors(spark, cfg, "park", dates)
    assert len(park) == len(dates)
    assert park["2025-01-15"] > 1.2 and park["2025-07-15"] < 0.5
    boarding = factors(spark, cfg, "equestrian_boarding", dates)
    assert max(boarding.values()) - min(boarding.values()) < 0.01
    gym = factors(spark, cfg, "gym", dates)
    assert gym["2025-01-05"] > 1.1 and gym["2025-01-05"] > gym["2025-06-15"]
    lessons = factors(spark, cfg, "equestrian_lessons", dates)
    assert lessons["2025-07-15"] / lessons["2025-01-15"] > park["2025-07-15"] / park["2025-01-15"]


def test_hour_weights_sum_to_one_and_shift(spark, cfg):
    rows = [(shape, int(h), float(w)) for shape, ws in cfg["seasonality"]["hourly_weights"].items() for h, w in ws.items()]
    df = literal_frame(spark, rows, {"shape": "string", "hour": "int", "weight": "double"})
    out = cal.normalised_shares(df, ["shape"], "weight").groupBy("shape").agg(
        F.sum("share").alias("total"), F.max_by("hour", "share").alias("peak"))
    got = {r["shape"]: r for r in out.collect()}
    assert all(r["total"] == pytest.approx(1.0) for r in got.values())
    assert got["ramadan"]["peak"] > got["normal"]["peak"]


def test_month_cells_pick_the_season_of_most_days_and_first_on_ties(spark):
    rows = [(dt.date(2025, 10, d), "shoulder" if d < 15 else "winter_peak") for d in range(1, 32)]
    rows += [(dt.date(2025, 11, 1), "b"), (dt.date(2025, 11, 2), "a")]
    cells = cal.with_partial_flag(cal.month_cells(literal_frame(spark, rows, {"full_date": "date", "season": "string"})))
    got = {str(r["month_start"]): (r["season"], r["day_count"], r["is_partial"]) for r in cells.collect()}
    assert got == {"2025-10-01": ("winter_peak", 31, False), "2025-11-01": ("b", 2, True)}
