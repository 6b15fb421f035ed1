"""Toxicity as an ordered grade: cumulative-link regression on the words of a text.

P(grade > k) = sigmoid(w.x - theta_k): one weight per hashed word, shared by all thresholds
theta_1 <= theta_2 <= ... The expected grade is the sum of these probabilities.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from plazaflow.llm.common import discard, packed, unpacked, written

SAMPLE = 8192  # labelled documents to fit on, those with the smallest hash of their id
DIMENSIONS = 2**22  # of the hashed features
LIMIT = 0.35  # of the expected grade, from which a text is rejected
PREFIXES = (4, 5, 6)  # beginnings of words that are features too, since inflected languages have few whole words in common
LEAST_DOCS = 4  # labelled documents a feature must stand in to be used
LEAST_Z = 3.0  # standard errors its mean residual must stand from 0
KNOWN = 300_000  # words whose features a task remembers
_WORD = re.compile(r"[^\W\d_]+")


def words(text: str | None) -> set[str]:
    return set(_WORD.findall(text.lower())) if text else set()


class _Features(dict):
    """Word to its features, or to those of them in `only`; forgets all when it has grown large."""

    def __init__(self, only: set[int] | None = None):
        self.only = only

    def __missing__(self, word: str) -> tuple[int, ...]:
        if len(self) > KNOWN:
            self.clear()
        parts = [word, *(f"{word[:k]}-" for k in PREFIXES if len(word) > k)]
        ids = [xxhash.xxh64_intdigest(p) % DIMENSIONS for p in parts]
        # most words have no feature in use: they share one empty tuple
        self[word] = ids = tuple(i for i in ids if self.only is None or i in self.only) or ()
        return ids

    def of(self, text: str | None) -> np.ndarray:
        """The different features of a text, rising."""
        return np.array(sorted({i for w in words(text) for i in self[w]}), np.int64)


@dataclass
class OrdinalModel:
    weights: np.ndarray  # float32, DIMENSIONS
    thresholds: np.ndarray  # rising

    def severity(self, score: np.ndarray) -> np.ndarray:
        return _sigmoid(score[:, None] - self.thresholds[None, :]).sum(axis=1)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


def _loss(x: np.ndarray, col: np.ndarray, of: np.ndarray, grades: np.ndarray, words_: int, l2: float) -> tuple[float, np.ndarray]:
    """Mean negative log-likelihood with an L2 pull, and its gradient; x holds weights, the first threshold and log steps."""
    n, i, w, steps = len(grades), np.arange(len(grades)), x[:words_], np.exp(x[words_ + 1:])
    theta = x[words_] + np.concatenate([[0.0], np.cumsum(steps)])
    above = _sigmoid(np.bincount(of, w[col], n)[:, None] - theta[None, :])
    edge = np.zeros((n, 1))
    bounds, slope = np.hstack([edge + 1, above, edge]), np.hstack([edge, above * (1 - above), edge])
    p = np.maximum(bounds[i, grades] - bounds[i, grades + 1], 1e-12)
    up, down = slope[i, grades] / p, slope[i, grades + 1] / p
    by_theta = (np.bincount(grades, up, len(theta) + 2) - np.bincount(grades + 1, down, len(theta) + 2))[1:-1] / n
    by_step = np.cumsum(by_theta[::-1])[::-1][1:] * steps
    g = np.concatenate([np.bincount(col, (down - up)[of], words_) / n + l2 * w, [by_theta.sum()], by_step])
    return float(-np.log(p).mean() + l2 / 2 * w @ w), g


def _minimized(f, x: np.ndarray, rounds: int = 200, memory: int = 10) -> np.ndarray:
    """Limited-memory BFGS with backtracking."""
    (value, g), pairs = f(x), []
    for _ in range(rounds):
        if np.abs(g).max() < 1e-6:
            break
        q, past = g.copy(), []
        for s, y in reversed(pairs):
            a = s @ q / (s @ y)
            q -= a * y
            past.append(a)
        if pairs:
            q *= pairs[-1][0] @ pairs[-1][1] / (pairs[-1][1] @ pairs[-1][1])
        for (s, y), a in zip(pairs, reversed(past)):
            q += (a - y @ q / (s @ y)) * s
        step = 1.0 if pairs else 1 / max(np.abs(g).max(), 1e-6)
        while step > 1e-10:
            new = x - step * q
            found, h = f(new)
            if found <= value - 1e-4 * step * (q @ g):
                break
            step /= 2
        else:
            break
        if (new - x) @ (h - g) > 1e-12:
            pairs = [*pairs, (new - x, h - g)][-memory:]
        x, value, g = new, found, h
    return x


def _without_words(grades: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The model without words: thresholds at the (smoothed) shares of the grades above, and the residual of each grade."""
    n, top = len(grades), max(int(grades.max()), 1) if len(grades) else 1
    above = np.array([((grades > k).sum() + 0.5) / (n + 1) for k in range(top)])
    above = np.minimum(above, above[0] * 0.98 ** np.arange(top))
    share = np.concatenate([[1.0], above, [0.0]])
    slope = np.concatenate([[0.0], above * (1 - above), [0.0]])
    return np.log((1 - above) / above), (slope[:-1] - slope[1:]) / np.maximum(share[:-1] - share[1:], 1e-12)


def fit(rows: list[np.ndarray], grades: np.ndarray, least_z: float = LEAST_Z, least_docs: int = LEAST_DOCS, l2: float = 1e-4) -> OrdinalModel:
    """The ordered model on the words that tell grades apart.

    rows are arrays of feature ids. A word is used when it stands in `least_docs` rows and their
    mean residual under the model without words is `least_z` standard errors from 0.
    """
    n = len(rows)
    flat = np.concatenate(rows) if rows else np.zeros(0, np.int32)
    of = np.repeat(np.arange(n, dtype=np.int32), [len(r) for r in rows])
    theta, by_grade = _without_words(grades)
    residual = by_grade[grades]
    used, inverse, count = np.unique(flat, return_inverse=True, return_counts=True)
    z = np.bincount(inverse, residual[of], len(used)) / np.sqrt(count * max(residual.var(), 1e-12)) if n else np.zeros(0)
    keep = (count >= least_docs) & (np.abs(z) >= least_z)
    seat, here = np.cumsum(keep) - 1, keep[inverse] if len(flat) else np.zeros(0, bool)
    col, k = seat[inverse[here]] if len(flat) else flat, int(keep.sum())
    start = np.concatenate([np.zeros(k), theta[:1], np.log(np.maximum(np.diff(theta), 1e-2))])
    x = _minimized(lambda v: _loss(v, col, of[here], grades, k, l2), start) if n else start
    weights = np.zeros(DIMENSIONS, np.float32)
    weights[used[keep]] = x[:k]
    return OrdinalModel(weights, x[k] + np.concatenate([[0.0], np.cumsum(np.exp(x[k + 1:]))]))


def severity_grade() -> Column:
    """0 not toxic, 1 toxic, 2 toxic and of low quality (from the columns of labels)."""
    return F.when(F.col("toxic") == 1, F.when(F.col("quality") == 0, 2).otherwise(1)).when(F.col("toxic").isNotNull(), 0)


def _featured(only=None):
    """Batches of (grade, text) to (grade, features): all different features of each whole text, or those in `only`."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        features = _Features(None if only is None else only.value)
        for batch in batches:
            feats = [features.of(t.as_py()).astype(np.int32) for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(feats, pa.list_(pa.int32()))], names=["grade", "features"])

    return run


def train(docs: DataFrame, labels: DataFrame, grade: Column | None = None, sample: int = SAMPLE) -> OrdinalModel:
    """Fits on at most `sample` labelled documents, each by all features of its whole text.

    Spark counts every feature of the sample and keeps those that `fit` would choose (least_docs, least_z); only these
    come back per document, so the driver holds the grades of the sample, at most DIMENSIONS kept ids, and the kept
    features of each sampled document, which are what the fit needs.

    labels: doc_id and the columns of `grade`, an integer from 0 up; rows without id or grade are
    passed over, as are labels of missing documents. Several labels of a document: the largest holds.
    """
    known = labels.withColumn("_grade", (severity_grade() if grade is None else grade).cast("int")).where("_grade >= 0 AND doc_id is not null")
    known = known.groupBy("doc_id").agg(F.max("_grade").alias("grade"))
    # ids of all labelled documents that exist, so that the sample is full; texts only for the sample
    there = docs.select("doc_id").where("doc_id is not null").distinct()
    chosen = known.join(there, "doc_id").orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)
    rows = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").groupBy("doc_id").agg(F.max("text").alias("text"), F.max("grade").alias("grade"))
    rows = written(rows.select("grade", "text"), "toxicity_sample")
    grades = np.array([r.grade for r in rows.select("grade").collect()], np.int64)  # at most `sample`
    _, by_grade = _without_words(grades)
    spread = max(by_grade[grades].var(), 1e-12) if len(grades) else 1e-12
    residual = F.element_at(F.array(*[F.lit(float(v)) for v in by_grade]), F.col("grade") + 1)
    every = rows.mapInArrow(_featured(), "grade int, features array<int>")
    stats = every.select(F.explode("features").alias("feature"), residual.alias("residual")).groupBy("feature").agg(
        F.count(F.lit(1)).alias("n"), F.sum("residual").alias("total"))
    kept = stats.where((F.col("n") >= LEAST_DOCS) & (F.abs(F.col("total") / F.sqrt(F.col("n") * F.lit(spread))) >= LEAST_Z))
    only = docs.sparkSession.sparkContext.broadcast({r.feature for r in kept.select("feature").collect()})  # at most DIMENSIONS
    got = rows.mapInArrow(_featured(only), "grade int, features array<int>").toArrow()
    discard(rows)
    grades, lists = got.column("grade").to_numpy(), got.column("features").combine_chunks()
    ends, flat = lists.offsets.to_numpy(), lists.flatten().to_numpy()
    table = [flat[a - ends[0]: b - ends[0]] for a, b in zip(ends, ends[1:])]
    order = sorted(range(len(table)), key=lambda i: (grades[i], table[i].tobytes()))  # the fit does not hang on how rows arrive
    return fit([table[i] for i in order], grades[order].astype(np.int64))


def grade_texts(docs: DataFrame, model: OrdinalModel, limit: float = LIMIT) -> DataFrame:
    """Adds severity (expected grade), grade (most thresholds more likely passed than not) and toxic (severity >= limit).

    Returns row (the input row without its text), text, severity, grade, toxic. A null or empty text has no words, so its
    score is 0. Each row is judged by itself, by all its words.
    """
    spark = docs.sparkSession
    used = np.flatnonzero(model.weights)
    sent = spark.sparkContext.broadcast((used.astype(np.int32), model.weights[used], model.thresholds))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, values, thresholds = sent.value
        local = OrdinalModel(np.zeros(DIMENSIONS, np.float32), thresholds)
        local.weights[at] = values
        features = _Features(set(at.tolist()))
        for batch in batches:
            scores = np.array([float(local.weights[features.of(t.as_py())].sum()) for t in batch.column(1)], np.float64)
            severity = local.severity(scores) if len(scores) else scores
            grade = (scores[:, None] > thresholds[None, :]).sum(axis=1) if len(scores) else np.zeros(0)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(np.round(severity, 6)), pa.array(grade.astype(np.int32))],
                names=["row", "text", "severity", "grade"])

    rows = packed(docs, without="text", text=F.col("text"))
    kind = rows.schema["row"].dataType.simpleString()
    return rows.mapInArrow(score, f"row {kind}, text string, severity double, grade int").withColumn("toxic", F.col("severity") >= limit)


def without_toxic(docs: DataFrame, labels: DataFrame, limit: float = LIMIT) -> DataFrame:
    """The documents that the model, trained on the labels, does not reject; their columns as they are."""
    graded = grade_texts(docs, train(docs, labels), limit)
    return unpacked(graded.where(~F.col("toxic")), docs.columns, text=F.col("text"))
