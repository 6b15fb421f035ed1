"""Cells of every kind go through a CSV drop and land as the SQL of s3_quoted_cells says."""

import uuid

import duckdb

from plazaflow.plans.catalog import _landed_sql
from plazaflow.sources import drops
from plazaflow.session import shared_dir


def test_null_empty_and_awkward_cells_land_as_sql_says(spark):
    texts = [None, "", "NA", "null", 'a "b"\n,\\', "  spaced  ", "x"]
    rows = [(str(i), t, t) for i, t in enumerate(texts)]
    folder = f"{shared_dir(spark)}/quoted-test-{uuid.uuid4().hex}"
    spark.createDataFrame(rows, "doc_id string, text string, note string").write.mode("overwrite").options(
        **drops.CSV_OPTIONS).option("quoteAll", True).option("ignoreLeadingWhiteSpace", False).option(
        "ignoreTrailingWhiteSpace", False).csv(folder)
    got = sorted((r.doc_id, r.text, r.note) for r in drops.read_drop(spark, folder, "*.csv", ["doc_id", "text", "note"], multi_line=True).collect())
    con = duckdb.connect()
    con.execute("CREATE TABLE cells (doc_id VARCHAR, text VARCHAR, note VARCHAR)")
    con.executemany("INSERT INTO cells VALUES (?, ?, ?)", rows)
    want = sorted(con.execute(f"SELECT doc_id, {_landed_sql('text')}, {_landed_sql('note')} FROM cells").fetchall())
    assert got == want
    assert got[0][1] is None and got[1][1] is None and got[4][1] == 'a "b"\n,\\' and got[5][1] == "  spaced  "
