"""Vector codes against a brute-force version that measures every entry."""

from __future__ import annotations

import hashlib
import math
import random

import numpy as np
import pyarrow.parquet as pq
import pytest

from plazaflow.llm import vector_codes as vc

SCHEMA = "vec_id long, embedding array<float>, label int, q string, code int"


def brute(rows):
    kept = [(i, v, lab) for i, v, lab in rows if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    if not kept:
        return {}
    kept.sort(key=lambda r: (r[0], [math.floor(np.float32(x) * 256.0) for x in r[1]]))
    q = {k: np.array([math.floor(float(np.float32(x)) * 256) for x in v], np.int64) for k, (i, v, lab) in enumerate(kept)}
    m = len(q[0]) // 16
    kept = [(k, r) for k, r in enumerate(kept) if len(q[k]) == 16 * m]
    book = np.stack([q[k] for k, _ in kept[:64]]).reshape(-1, 16, m)

    def assign(vec):
        parts = vec.reshape(16, m)
        d = ((book - parts[None]) ** 2).sum(2)  # (E, 16)
        return d.argmin(0), d.min(0)

    for _ in range(2):
        sums, counts = np.zeros_like(book), np.zeros(book.shape[:2], np.int64)
        for k, _ in kept:
            codes, _ = assign(q[k])
            for p, c in enumerate(codes):
                sums[c, p] += q[k].reshape(16, m)[p]
                counts[c, p] += 1
        for c in range(book.shape[0]):
            for p in range(16):
                if counts[c, p]:
                    book[c, p] = sums[c, p] // counts[c, p]
    out, by_label = {}, {}
    for k, r in kept:
        codes, d = assign(q[k])
        out.setdefault(r[0], []).append((r[2], "".join(f"{c:02x}" for c in codes), int(d.sum())))
        by_label[r[2]] = by_label.get(r[2], 0) + int(d.sum())
    digest = hashlib.sha256(",".join(str(v) for v in book.transpose(1, 0, 2).reshape(-1)).encode()).hexdigest()
    return {i: sorted(((lab, code, err, by_label[lab], digest) for lab, code, err in v), key=repr) for i, v in out.items()}


def run(spark, rows):
    df = spark.createDataFrame([(i, v, lab, "x", 1) for i, v, lab in rows], SCHEMA).repartition(3)
    out, _ = vc.compress(df)
    got = {}
    for r in out.collect():
        got.setdefault(r.vec_id, []).append((r.label, r.code, r.error, r.label_error, r.codebooks_sha256))
    return {k: sorted(v, key=repr) for k, v in got.items()}


def fixture(n, seed=4, dim=64):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        v = [rng.gauss(0, 0.2) for _ in range(dim)]
        kind = rng.random()
        if kind < 0.03:
            v = None
        elif kind < 0.06:
            v[rng.randrange(dim)] = rng.choice([float("nan"), float("inf"), None])
        elif kind < 0.1 and rows:
            v = rows[-1][1]
        rows.append((rng.choice([i, i, 5]), v, rng.choice([1, 2, None, 3])))
    return rows


@pytest.mark.parametrize("n", [1, 40, 300])
def test_against_brute(spark, n):
    rows = fixture(n)
    want = {k: sorted(v, key=repr) for k, v in brute(rows).items()}
    assert run(spark, rows) == want


def test_supplied_embeddings(spark):
    t = pq.read_table("/root/testdata/sf0.01/embeddings.parquet").to_pylist()
    rows = [(r["vec_id"], r["embedding"], r["label"]) for r in t]
    want = {k: sorted(v, key=repr) for k, v in brute(rows).items()}
    assert run(spark, rows) == want


def test_empty(spark):
    out, _ = vc.compress(spark.createDataFrame([], SCHEMA))
    assert out.count() == 0
