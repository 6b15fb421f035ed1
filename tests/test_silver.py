import datetime as dt
from decimal import Decimal

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from plazaflow.functions.columns import parse_mixed_dates, pct
from plazaflow.functions.frames import literal_frame
from plazaflow.operators import dims, footfall_cleaning as fc, silver as sv

D = dt.date.fromisoformat


def test_mixed_dates_each_row_on_its_own(spark):
    texts = ["2024-07-31", "10/07/2024", "July 2024", "not a date"]
    df = literal_frame(spark, [(t,) for t in texts], {"t": "string"})
    got = {r["t"]: r["d"] for r in df.select("t", parse_mixed_dates("t").alias("d")).collect()}
    assert got == dict(zip(texts, [D("2024-07-31"), D("2024-07-10"), D("2024-07-01"), None]))


def test_pct_rounds_half_up(spark):
    df = literal_frame(spark, [(1, 16), (1, 3), (5, 0)], {"a": "bigint", "b": "bigint"})
    assert [r[0] for r in df.select(pct("a", "b", 1)).collect()] == [Decimal("6.3"), Decimal("33.3"), None]


def test_duplicates_keep_one_copy_even_when_one_key_is_most_of_the_table(spark):
    rows = [("hot", None, f"f{i % 7}") for i in range(3000)] + [(f"k{i}", "x", "f1") for i in range(500)] + [("k1", "x", "f0")]
    df = spark.createDataFrame(rows, "key string, other string, file string").repartition(9)
    out = sv.with_duplicate_flag(df, ["key", "other"], ["file"])
    kept = out.filter("not is_duplicate").groupBy("key").agg(F.count("*").alias("n"), F.min("file").alias("f")).collect()
    assert out.count() == len(rows) and len(kept) == 501
    assert all(r["n"] == 1 for r in kept)
    assert {r["key"]: r["f"] for r in kept if r["key"] in ("hot", "k1")} == {"hot": "f0", "k1": "f0"}


def test_duplicate_flag_shuffles_each_row_once_and_gives_the_order_of_one_sort(spark):
    from pyspark.sql import Window

    rows = [(None if i % 4 == 0 else f"k{i % 37}", None if i % 3 == 0 else i % 5, None if i % 7 == 0 else f"f{i % 11}", f"{i}") for i in range(2000)]
    df = spark.createDataFrame(rows, "key string, other int, file string, id string").repartition(5)
    out = sv.with_duplicate_flag(df, ["key", "other"], ["file", "id"])
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning(key") == 1
    first = F.row_number().over(Window.partitionBy("key", "other").orderBy("file", "id"))
    want = df.withColumn("is_duplicate", first > 1)
    assert out.exceptAll(want).count() == want.exceptAll(out).count() == 0


def test_unique_lines_are_not_sorted_before_their_shuffle_and_leave_beaten_copies_behind(spark):
    """A filter on row numbers made Spark sort every line by the whole key on both sides of the shuffle."""
    rows = [(None if i % 5 == 0 else f"k{i % 7}", Decimal(i % 3), f"f{i % 4}", i % 2 == 0) for i in range(400)]
    df = literal_frame(spark, [(k, str(q), f, r) for k, q, f, r in rows], {"key": "string", "qty": "string", "file": "string", "refund": "boolean"})
    out = sv.with_duplicate_flag(df.withColumn("qty", F.col("qty").cast("decimal(10,2)")), ["key", "qty"], ["file"])
    kept = out.filter("not is_duplicate")
    assert sorted((str(r.key), int(r.qty), r.file) for r in kept.collect()) == sorted(
        (str(k), q, min(f for a, b, f, _ in rows if (a, b) == (k, q))) for k, q in {(r[0], r[1]) for r in rows})
    assert out.count() == len(rows)
    plan = kept._jdf.queryExecution().sparkPlan().toString()
    assert "WindowGroupLimit" not in plan and "xxhash64" in plan
    window = plan.index("Window [lag")
    assert "NOT _beaten" in plan[window:]  # below the window and its shuffle


def test_rows_whose_key_comes_once_do_not_go_through_the_shuffle(spark, monkeypatch):
    rows = [(None if i % 10 == 0 else f"k{i}", i % 2, f"f{i % 4}") for i in range(600)] + [("k7", 1, "f0"), ("k9", 1, None)]
    df = spark.createDataFrame(rows, "key string, other int, file string").repartition(6)
    sent = sv._repeated(df, ["key", "other"]).filter("_repeated")
    assert sent.count() == 64 and sent.filter("key is null").count() == 60
    plan = sv.with_duplicate_flag(df, ["key", "other"], ["file"])._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("Union") < plan.index("Window [lag") < plan.rindex("getbit(_marks")

    want = sorted((str(k), o, str(f), n > 0) for k, o in {r[:2] for r in rows}
                  for n, f in enumerate(sorted((r[2] or "" for r in rows if r[:2] == (k, o)))))
    for places in (sv.MARKS, 1):  # with 64 places nearly every key shares its place with another
        monkeypatch.setattr(sv, "MARKS", places)
        out = sv.with_duplicate_flag(df, ["key", "other"], ["file"]).collect()
        assert sorted((str(r.key), r.other, str(r.file or ""), r.is_duplicate) for r in out) == want


def test_wide_keys_are_counted_by_their_hash(spark):
    from plazaflow.operators import quality as dq

    rows = [("ab", None, "c", 1, 2), ("ab", "c", None, 1, 2), ("a", "bc", None, 1, 2), (None, None, None, 1, 2), (None, None, None, 1, 2), ("x", "y", "z", 3, 4)]
    df = spark.createDataFrame(rows, "a string, b string, c string, d int, e int")
    check = dq.check_unique("u", df, ["a", "b", "c", "d", "e"])
    assert check.first()["actual_value"] == "1" and dq.check_unique("u", df.dropDuplicates(), list("abcde")).first()["status"] == "pass"
    assert "Exchange hashpartitioning(a#" not in check._jdf.queryExecution().executedPlan().toString()


def test_filing_rows_collapse_and_silence_is_not_zero(spark):
    cols = {"tenant_id": "string", "sales_month": "string", "is_restatement": "boolean", "date_raw": "string",
            "gross_sales_raw": "string", "net_sales_raw": "string", "submitted_date": "string", "_source_file": "string"}
    rows = [("T03", "2025-02", False, f"0{i}/02/2025", None, "10.5", "2025-03-10", "f") for i in range(1, 5)]
    rows += [("T04", "2025-02", True, "soon", "n/a", None, None, "g")]
    out = {r["tenant_id"]: r for r in sv.tenant_sales_silver(literal_frame(spark, rows, cols)).collect()}
    assert out["T03"]["net_sales_kwd"] == Decimal("42.000") and out["T03"]["gross_sales_kwd"] is None
    assert out["T03"]["days_late"] == 10 and out["T03"]["submission_version"] == 1 and out["T03"]["_dq_flags"] == []
    assert out["T04"]["submission_version"] == 2 and out["T04"]["days_late"] is None
    assert out["T04"]["_dq_flags"] == ["unparsed_date", "no_sales_reported"]


def test_members_resolve_on_phone_in_a_single_hop(spark):
    rows = [("K1", "M2", "p1"), ("K2", "M1", "p1"), ("K3", "M2", "p2"), ("K4", "M9", None), ("K5", "M9", None)]
    df = literal_frame(spark, [(*r, D("2025-01-01")) for r in rows], {
        "contract_id": "string", "member_id": "string", "phone_number": "string", "start_date": "date"})
    got = {r["contract_id"]: r["canonical_member_id"] for r in dims.resolve_member(df).collect()}
    assert got == {"K1": "M1", "K2": "M1", "K3": "M2", "K4": "M9", "K5": "M9"}
    assert {r["member_id"]: r["phone"] for r in dims.dim_member(df).collect()} == {"M1": "p1", "M2": "p2", "M9": None}
    shared = {r["contract_id"] for r in sv.flag_shared_phone(df).filter("shared_phone_across_members").collect()}
    assert shared == {"K1", "K2"}


# ---- footfall cleaning against a plain loop

def fill_by_loop(values, half=7):
    values = np.array([np.nan if v is None else v for v in values], dtype=float)
    for i in np.flatnonzero(np.isnan(values)):
        window = values[max(0, i - half): i + half + 1]
        window = window[~np.isnan(window)]
        if len(window):
            values[i] = np.round(window.mean())
    return [None if np.isnan(v) else v for v in values]


def series_frame(spark, series):
    start = D("2024-01-01")
    rows = [(g, h, start + dt.timedelta(days=i), i % 7 > 4, a, b) for (g, h), pairs in series.items() for i, (a, b) in enumerate(pairs)]
    return literal_frame(spark, rows, {"gate_id": "string", "hour": "int", "footfall_date": "date", "is_weekend": "boolean",
                                       "count_in": "double", "count_out": "double"})


def by_series(rows, *cols):
    out = {}
    for r in sorted(rows, key=lambda r: r["footfall_date"]):
        out.setdefault((r["gate_id"], r["hour"]), []).append(tuple(r[c] for c in cols))
    return out


@pytest.mark.parametrize("block_rows", [16, 8192])
def test_fills_feed_later_fills(spark, block_rows):
    rng = np.random.default_rng(5)
    series = {}
    for k, rate in enumerate((0.05, 0.3, 0.6, 1.0, 0.95)):
        a = [None if rng.random() < rate else float(rng.integers(0, 90)) for _ in range(150)]
        b = [None if rng.random() < rate / 2 else float(rng.integers(0, 90)) for _ in range(150)]
        series[("G01", k)] = list(zip(a, b))
    outage = [None if 40 <= i < 80 else float(i % 11) for i in range(120)]
    series[("G02", 0)] = list(zip(outage, outage))
    got = by_series(fc.impute_series(series_frame(spark, series), block_rows=block_rows).collect(), "count_in", "count_out", "is_imputed")
    for key, pairs in series.items():
        a, b = ([p[i] for p in pairs] for i in (0, 1))
        want = list(zip(fill_by_loop(a), fill_by_loop(b), [x is None or y is None for x, y in pairs]))
        assert got[key] == want, key


@pytest.mark.parametrize("block_rows", [64, 8192])
def test_outliers_against_the_rolling_median(spark, block_rows):
    rng = np.random.default_rng(6)
    series = {("G01", h): [(float(rng.integers(0, 60)), float(rng.integers(50, 60) * (2 if 90 < i < 105 else 1)))
                           for i in range(300)] for h in range(3)}
    series[("G02", 0)] = [(float(v), float(v)) for v in rng.integers(1, 99, 14)]
    series[("G02", 1)] = [(0.0, 0.0)] * 70 + [(9.0, 9.0)]
    df = series_frame(spark, series)
    got = by_series(fc.correct_outliers(df, block_rows=block_rows).collect(), "count_in", "count_out", "is_outlier_corrected")
    for key, pairs in series.items():
        pdf = pd.DataFrame(pairs, columns=["a", "b"])
        pdf["w"] = [i % 7 > 4 for i in range(len(pairs))]
        flag = np.zeros(len(pdf), dtype=bool)
        for _, g in pdf.groupby("w"):
            for c in ("a", "b"):
                med = g[c].rolling(61, center=True, min_periods=15).median()
                high = (g[c] / med.replace(0, np.nan) > 1.5).fillna(False)
                pdf.loc[high[high].index, c] = med[high].round()
                flag[high[high].index] = True
        assert got[key] == list(zip(pdf["a"], pdf["b"], flag.tolist())), key
