"""Drops as ordinary exporters write them, in batch and as a stream; loads that touch only their months."""

import datetime as dt

import pandas as pd
from pyspark.sql import functions as F, types as T

from plazaflow.operators import dims as dm, footfall_cleaning as fc, silver as sv
from plazaflow.sources import drops, registry as reg
from plazaflow.sources.tables import Warehouse
from plazaflow.streaming import bronze

CELLS = [("say \"hi\" now", "2"), ("C:\\", "5"), ("two\nlines, and a comma", "n/a"), ("", " x "), ("é \\\" q", "NULL")]


def write_csv(path, rows, header):
    pd.DataFrame(rows, columns=header).to_csv(path, index=False, quoting=1)



def key(rows):
    return sorted(rows, key=lambda r: tuple("" if v is None else v for v in r))


def test_cells_land_as_pandas_reads_them(spark, tmp_path):
    write_csv(tmp_path / "web_1.csv", CELLS, ["Text", "N"])
    want, _ = [tuple(None if pd.isna(v) else v for v in r) for r in pd.read_csv(
        tmp_path / "web_1.csv", dtype=str, na_values=drops.MISSING).itertuples(index=False)], None
    got = drops.read_drop(spark, str(tmp_path), "web_*.csv", ["text", "n"], multi_line=True).select("text", "n").collect()
    assert key(map(tuple, got)) == key(want)


def test_stream_lands_what_a_batch_lands(spark, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    write_csv(folder / "web_2025-01-03.csv", CELLS, ["text", "n"])
    schema = T.StructType([T.StructField("text", T.StringType()), T.StructField("n", T.StringType())])
    bronze.stream_bronze(spark, str(folder), schema, str(tmp_path / "out"), str(tmp_path / "ck"), multi_line=True).awaitTermination()
    stream = spark.read.parquet(str(tmp_path / "out")).select("text", "n", "_source_file").collect()
    batch = drops.read_drop(spark, str(folder), "*.csv", ["text", "n"], multi_line=True).collect()
    assert key(map(tuple, stream)) == key(map(tuple, batch)) and len(stream) == len(CELLS)


def test_quoted_headers_and_other_orders(spark, tmp_path):
    (tmp_path / "a_1.csv").write_text('"A","B, c"\n1,2\n')
    (tmp_path / "a_2.csv").write_text('"B, c",A\n4,3\n')
    got = drops.read_drop(spark, str(tmp_path), "a_*.csv", ["a", "b, c", "missing"]).select("a", "`b, c`", "missing").collect()
    assert key(map(tuple, got)) == [("1", "2", None), ("3", "4", None)]


def test_a_load_reads_only_its_months(spark, tmp_path):
    wh = Warehouse(spark, str(tmp_path))
    files = [f"web_2025-{m:02d}-03.csv" for m in range(1, 13)]
    landed = reg.with_drop_month(spark.createDataFrame([(f, i) for i, f in enumerate(files)], "_source_file string, n int"))
    wh.replace_partitions("bronze", "web_raw", landed)
    todo = spark.createDataFrame([(files[2], True)], "file_name string, is_changed boolean")
    months = reg.touched_months(todo)
    assert months == ["202503"]
    merged = reg.merge_files(wh.read_bronze("web_raw"), landed.where("n < 0"), todo, months)
    for plan in (merged, reg.only_months(wh.read_bronze("web_raw"), months)):
        assert "PartitionFilters: [isnotnull(_drop_month" in (text := plan._jdf.queryExecution().toString()) and "= 202503)" in text
    assert merged.collect() == []


def test_counts_without_a_gate_belong_to_no_series(spark):
    days = [dt.date(2025, 1, 1) + dt.timedelta(days=i) for i in range(90)]
    rows = [(gate, 10, d, 10.0 if i < 60 else 100.0, None if i == 50 else 5.0, False) for gate in ("G1", None) for i, d in enumerate(days)]
    df = spark.createDataFrame(rows, "gate_id string, hour int, footfall_date date, count_in double, count_out double, is_weekend boolean")
    out = fc.correct_outliers(fc.impute_series(df))
    assert out.count() == 180
    bare = out.where("gate_id is null")
    assert bare.where("is_imputed or is_outlier_corrected").count() == 0 and bare.where("count_out is null").count() == 1
    assert out.where("gate_id = 'G1' and is_imputed").count() == 1


def test_late_changes_split_correct_or_are_rejected(spark):
    d = dt.date
    versions = dm.dim_tenant(spark.createDataFrame(
        [("T", d(2024, 1, 1), d(2024, 12, 31), "a"), ("T", d(2025, 1, 1), None, "b"), ("U", d(2024, 1, 1), None, "u")],
        "tenant_id string, effective_start_date date, effective_end_date date, category string").withColumns(
        {c: F.lit(None).cast("string") for c in ("tenant_name", "unit_no", "unit_sqm", "lease_start", "lease_end", "base_rent_kwd",
                                                 "turnover_rent_pct", "turnover_threshold_kwd", "status")}))
    changes = spark.createDataFrame([("T", d(2024, 1, 1), "x"), ("T", d(2023, 5, 5), "early"), ("T", d(2024, 7, 1), "mid"), ("U", d(2024, 3, 1), "p"),
                                     ("U", d(2024, 3, 1), "q"), ("Z", d(2024, 3, 1), "no")], "tenant_id string, effective_from date, category string")
    placed = {(r.tenant_id, r.category): r.outcome for r in dm.place_changes(versions, changes).collect()}
    assert placed == {("T", "x"): "corrected", ("T", "early"): "rejected", ("T", "mid"): "split", ("U", "p"): "split", ("U", "q"): "rejected",
                      ("Z", "no"): "rejected"}
    got = dm.rebuild_scd2(versions, changes).select("tenant_id", "valid_from", "valid_to", "category", "is_current").collect()
    assert sorted((r[0], str(r[1]), str(r[2]), r[3], r[4]) for r in got) == [
        ("T", "2024-01-01", "2024-06-30", "x", False), ("T", "2024-07-01", "2024-12-31", "mid", False), ("T", "2025-01-01", "None", "b", True),
        ("U", "2024-01-01", "2024-02-29", "u", False), ("U", "2024-03-01", "None", "p", True)]


def test_missing_phones_do_not_gather(spark):
    rows = [(f"K{i}", f"M{i}", None if i % 10 else f"p{i % 3}") for i in range(4000)]
    df = spark.createDataFrame(rows, "contract_id string, member_id string, phone_number string")
    joined = sv.flag_shared_phone(df)
    assert joined.count() == 4000 and joined.where("shared_phone_across_members").count() == 400
    spread = sv.lookup_known(df, sv.phone_owners(df), "phone_number")
    assert spread.count() == 4000 and spread.where("phone_number is null and _low_member is not null").count() == 0
    assert dm.resolve_member(df).where("phone_number is null and canonical_member_id <> member_id").count() == 0


def test_one_key_in_a_third_of_all_rows_is_flagged_whole(spark):
    rows = [("hot" if i % 3 == 0 else f"k{i}", f"f{i % 5}", "x", "v") for i in range(3000)]
    df = spark.createDataFrame(rows, "invoice_id string, _source_file string, item_name string, venue_id string").repartition(7)
    out = sv.with_duplicate_flag(df, keys=["invoice_id"])
    assert out.where("invoice_id = 'hot' and not is_duplicate").count() == 1 and out.where("is_duplicate").count() == 999


def test_positions_are_those_of_one_sort(spark):
    from plazaflow.functions.ordering import with_sequence

    rows = [(None if i % 11 == 0 else i * 7 % 53, f"t{i % 3}", dt.date(2025, 1, 1 + i % 28), i) for i in range(700)] + [(5, "same", None, 0)] * 300
    df = spark.createDataFrame(rows, "a int, b string, c date, d int").repartition(5)
    got = with_sequence(df, ["a", "b"]).collect()
    order = sorted(rows, key=lambda r: tuple((v is not None, 0 if v is None else v) for v in r))
    assert [tuple(r)[:4] for r in sorted(got, key=lambda r: r._seq)] == order
    assert with_sequence(df.where("false"), ["a"]).collect() == []


def test_a_refresh_that_dies_leaves_the_old_table(spark, tmp_path, monkeypatch):
    import pytest

    wh = Warehouse(spark, str(tmp_path))
    wh.replace_table("gold", "dim_gate", spark.range(3))
    with pytest.raises(Exception):  # while writing
        wh.replace_table("gold", "dim_gate", spark.range(5).select(F.raise_error(F.lit("lost")).alias("id")))
    assert wh.read_table("gold", "dim_gate").count() == 3
    real, calls = Warehouse._move, []

    def second_fails(self, source, target):
        calls.append(source)
        if len(calls) == 2:
            raise OSError("the driver dies here")
        real(self, source, target)

    monkeypatch.setattr(Warehouse, "_move", second_fails)  # between the renames
    with pytest.raises(OSError):
        wh.replace_table("gold", "dim_gate", spark.range(7))
    monkeypatch.setattr(Warehouse, "_move", real)
    again = Warehouse(spark, str(tmp_path))
    assert again.exists("gold", "dim_gate") and again.read_table("gold", "dim_gate").count() == 3
    assert again.replace_table("gold", "dim_gate", spark.range(7)).count() == 7
    assert again.replace_self("gold", "dim_gate", again.read_table("gold", "dim_gate").where("id < 2")).count() == 2


def test_months_are_laid_out_without_moving_rows(spark, tmp_path):
    from plazaflow.plans import warehouse

    wh = Warehouse(spark, str(tmp_path))
    kept = spark.conf.get("spark.sql.maxConcurrentOutputFileWriters")
    rows = spark.range(0, 900, 1, 3).select("id", F.when(F.col("id") % 3 > 0, (20250001 + F.col("id") % 3 * 100).cast("int")).alias("date_key"))
    stored = warehouse._store(wh, "gold", {"fact_bookings": rows})["fact_bookings"]
    assert stored.count() == 900 and {r.id: r.date_key for r in stored.collect()} == {r.id: r.date_key for r in rows.collect()}
    files = [f.name for f in (tmp_path / "gold" / "fact_bookings").rglob("*.parquet")]
    assert len(files) == 9 and all(".zstd." in f for f in files)  # three tasks, three months (one of rows without a date)
    assert spark.conf.get("spark.sql.maxConcurrentOutputFileWriters") == kept
