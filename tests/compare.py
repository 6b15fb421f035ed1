"""Runs registered queries against their SQL: python tests/compare.py [sf] [name prefix ...]"""

from __future__ import annotations

import math
import sys
import time
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))
import __spark_entry__ as entry  # noqa: E402
from plazaflow.session import get_session  # noqa: E402

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def connect(sf_dir: str):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def canonical(value):
    if value is None:
        return ""
    if isinstance(value, bool):
        return str(value)
    if isinstance(value, float):
        if math.isnan(value):
            return "nan"
        return repr(float(f"{value:.12g}")) if value != int(value) else str(int(value))
    if hasattr(value, "as_tuple"):
        return canonical(float(value))
    return str(value)


def normal(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted(tuple(canonical(r[i]) for i in order) for r in rows)


def check(spark, con, name: str, sf_dir: str) -> tuple[bool, str]:
    start = time.time()
    df = entry.queries()[name](spark, sf_dir)
    rows = [tuple(r) for r in df.collect()]
    took = time.time() - start
    sql = entry.oracle_sql().get(name)
    if sql is None:
        return True, f"{len(rows)} rows, no SQL, {took:.1f}s"
    cur = con.execute(sql)
    want_cols, want = normal([d[0] for d in cur.description], cur.fetchall())
    got_cols, got = normal(df.columns, rows)
    if got_cols != want_cols:
        return False, f"columns {got_cols} <> {want_cols}"
    if got != want:
        a, b = set(got), set(want)
        return False, f"rows {len(got)} vs {len(want)}; only spark {sorted(a - b)[:3]}; only sql {sorted(b - a)[:3]}"
    return True, f"{len(rows)} rows, {took:.1f}s"


def main() -> int:
    sf = sys.argv[1] if len(sys.argv) > 1 else "sf0.01"
    sf_dir, prefixes = f"/root/testdata/{sf}", tuple(sys.argv[2:])
    spark = get_session("compare", "local[8]", **{"spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false",
                                                  "spark.driver.memory": "8g", "spark.ui.showConsoleProgress": "false"})
    spark.sparkContext.setLogLevel("ERROR")
    con, bad = connect(sf_dir), 0
    for name in entry.queries():
        if prefixes and not any(name == p or name.startswith(p + "_") for p in prefixes):
            continue
        try:
            ok, note = check(spark, con, name, sf_dir)
        except Exception as error:  # report and go on with the rest
            ok, note = False, f"{type(error).__name__}: {str(error)[:700]}"
        bad += not ok
        print("ok  " if ok else "FAIL", name, note, flush=True)
    print("failures:", bad)
    return bad


if __name__ == "__main__":
    sys.exit(main() > 0)
