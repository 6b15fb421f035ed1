"""Vector code compression: product codes whose nearest entries are found by slice-and-intersect bitmasks.

Fixed values of the contract: components become floor(256 * x); vectors are cut into PARTS equal consecutive
parts; each part position's codebook starts as that part of the ENTRIES smallest kept vec_ids; ROUNDS rounds
of assignment (squared distance, ties to the lower index) and update (componentwise floor(sum / count),
unused entries stay), then a last assignment.

The search: per part position and dimension the codebook's coordinates are sorted, and each sorted place
carries the uint64 mask of the entries up to it (one bit per entry, ENTRIES <= 64). A part's initial radius
is its distance to the entry nearest in the first dimension; the entries within that radius in every
dimension are the masks of the ranges, ANDed; the nearest entry lies among them, so distances are taken for
these candidates only and the result is exact.

Tasks hold one Arrow batch and the codebook (PARTS * ENTRIES * dimension / PARTS integers); an update
sends per batch and entry one sum per component, which Spark adds up, so no group of vectors meets one task
however many share an entry.

Defined results: rows with a null vector, a null or non-finite component, or a length other than that of
the first codebook vector are dropped; fewer than ENTRIES kept rows give as many entries; repeated vec_ids
are ordered by their vector; null labels form one label; an empty table gives no rows; other columns are
ignored.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

PARTS, ENTRIES, ROUNDS = 16, 64, 2
#: Labels up to this many go to every task for label_error; more are joined by a shuffle.
BROADCAST_LABELS = 100_000


def quantised(df: DataFrame) -> DataFrame:
    vec = F.col("`embedding`")
    finite = F.forall(vec, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    kept = df.where(vec.isNotNull() & finite)
    return kept.select(F.col("`vec_id`").alias("vec_id"), F.col("`label`").alias("label"),
                       F.transform(vec, lambda x: F.floor(x.cast("double") * 256)).alias("q"))


class Searcher:
    """Slice-and-intersect search over one codebook: entries (E, PARTS, m) of integers."""

    def __init__(self, book: np.ndarray):
        self.book = book
        e, parts, m = book.shape
        bits = np.uint64(1) << np.arange(e, dtype=np.uint64)
        self.order = np.argsort(book, axis=0, kind="stable")  # (E, PARTS, m)
        self.values = np.take_along_axis(book, self.order, 0)
        prefix = np.zeros((e + 1, parts, m), np.uint64)
        prefix[1:] = np.bitwise_or.accumulate(bits[self.order], axis=0)
        self.prefix = prefix

    def nearest(self, q: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Entry and squared distance of every part of the vectors q (B, PARTS, m)."""
        book, (e, parts, m) = self.book, self.book.shape
        codes = np.zeros((len(q), parts), np.int64)
        dist = np.zeros((len(q), parts), np.int64)
        for p in range(parts):
            qp, cp = q[:, p, :], book[:, p, :]
            at = np.clip(np.searchsorted(self.values[:, p, 0], qp[:, 0]), 0, e - 1)
            below = np.clip(at - 1, 0, e - 1)
            pick = np.where(np.abs(self.values[at, p, 0] - qp[:, 0]) <= np.abs(self.values[below, p, 0] - qp[:, 0]), at, below)
            first = self.order[pick, p, 0]
            r2 = ((qp - cp[first]) ** 2).sum(1)
            r = np.floor(np.sqrt(r2.astype(np.float64))).astype(np.int64) + 1
            mask = np.full(len(q), np.uint64(2**64 - 1) if e == 64 else np.uint64((1 << e) - 1), np.uint64)
            for j in range(m):
                lo = np.searchsorted(self.values[:, p, j], qp[:, j] - r, "left")
                hi = np.searchsorted(self.values[:, p, j], qp[:, j] + r, "right")
                mask &= self.prefix[hi, p, j] & ~self.prefix[lo, p, j]
            rows, cols = np.nonzero((mask[:, None] >> np.arange(e, dtype=np.uint64)) & np.uint64(1))
            d = ((qp[rows] - cp[cols]) ** 2).sum(1)
            best = np.lexsort((cols, d, rows))
            first_of_row = np.ones(len(best), bool)
            first_of_row[1:] = rows[best][1:] != rows[best][:-1]
            chosen = best[first_of_row]
            codes[rows[chosen], p], dist[rows[chosen], p] = cols[chosen], d[chosen]
        return codes, dist


def _vectors(frame: pd.DataFrame, m: int) -> tuple[np.ndarray, np.ndarray]:
    ok = frame["q"].map(len).to_numpy() == PARTS * m
    q = np.stack(frame["q"][ok].to_numpy()).astype(np.int64).reshape(-1, PARTS, m) if ok.any() else np.zeros((0, PARTS, m), np.int64)
    return ok, q


def _update(vectors: DataFrame, book: np.ndarray) -> np.ndarray:
    e, parts, m = book.shape
    sent = vectors.sparkSession.sparkContext.broadcast(book)

    def sums(frames):
        searcher = None
        for frame in frames:
            searcher = searcher or Searcher(sent.value)
            _, q = _vectors(frame, m)
            codes, _ = searcher.nearest(q)
            for p in range(parts):
                total = np.zeros((e, m), np.int64)
                np.add.at(total, codes[:, p], q[:, p, :])
                count = np.bincount(codes[:, p], minlength=e)
                used = np.flatnonzero(count)
                if len(used):
                    yield pd.DataFrame({"part": p, "entry": used, "n": count[used], "s": list(total[used])})

    got = vectors.select("q").mapInPandas(sums, "part int, entry long, n long, s array<long>")
    got = got.select("part", "entry", "n", F.posexplode("s")).groupBy("part", "entry", "pos").agg(F.sum("n").alias("n"), F.sum("col").alias("s"))
    new = book.copy()
    for row in got.collect():  # at most PARTS * ENTRIES * m rows
        new[row.entry, row.part, row.pos] = row.s // row.n
    sent.destroy()
    return new


def compress(embeddings: DataFrame) -> tuple[DataFrame, np.ndarray]:
    """Per kept vector: vec_id, label, code, error, label_error, codebooks_sha256; and the final codebook."""
    vectors = quantised(embeddings)
    first = vectors.orderBy("vec_id", "q").limit(ENTRIES).collect()  # ENTRIES rows
    spark = embeddings.sparkSession
    schema = "vec_id long, label int, code string, error long"
    if not first:
        return spark.createDataFrame([], schema + ", label_error long, codebooks_sha256 string"), np.zeros((0, PARTS, 0), np.int64)
    m = len(first[0].q) // PARTS
    vectors = vectors.where(F.size("q") == PARTS * m)
    book = np.array([r.q for r in first if len(r.q) == PARTS * m], np.int64).reshape(-1, PARTS, m)
    for _ in range(ROUNDS):
        book = _update(vectors, book)
    sent = spark.sparkContext.broadcast(book)

    def assign(frames):
        searcher = None
        for frame in frames:
            searcher = searcher or Searcher(sent.value)
            _, q = _vectors(frame, m)
            codes, dist = searcher.nearest(q)
            yield pd.DataFrame({"vec_id": frame["vec_id"], "label": frame["label"], "code": ["".join(f"{c:02x}" for c in row) for row in codes],
                                "error": dist.sum(1)})

    coded = vectors.mapInPandas(assign, schema)
    digest = hashlib.sha256(",".join(str(v) for v in book.transpose(1, 0, 2).reshape(-1)).encode()).hexdigest()
    totals = coded.groupBy("label").agg(F.sum("error").alias("label_error"))
    if vectors.select("label").distinct().count() <= BROADCAST_LABELS:
        totals = F.broadcast(totals)
    out = coded.alias("c").join(totals.alias("t"), F.col("c.label").eqNullSafe(F.col("t.label"))).select(
        "c.*", "t.label_error").withColumn("codebooks_sha256", F.lit(digest))
    return out, book
