import numpy as np
from helpers import docs_frame
from pyspark.sql import functions as F

from plazaflow.llm import toxicity as tx


def test_thresholds_rise_and_grades_are_ordered():
    rng = np.random.default_rng(1)
    rows, grades = [], []
    for _ in range(1500):
        n = rng.integers(0, 4)
        rows.append(np.unique(np.concatenate([rng.integers(100, 2000, 30), np.arange(n)])))
        grades.append(min(int(n), 2) if rng.random() > 0.05 else int(rng.integers(0, 3)))
    model = tx.fit(rows, np.array(grades))
    assert (np.diff(model.thresholds) > 0).all()
    means = [model.severity(np.array([model.weights[np.arange(n)].sum()]))[0] for n in range(4)]
    assert means[0] < means[1] < means[2] and abs(means[3] - means[2]) < 0.1  # two such words are the highest grade
    assert means[0] < 0.4 < 0.7 < means[1] < 1.4 < 1.6 < means[2]


def test_held_out_documents(spark):
    """Fitted on one half of the labels, judged on the other."""
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    half = F.pmod(F.xxhash64("doc_id", F.lit(3)), F.lit(2)) == 0
    model = tx.train(docs, labels.where(half))
    rows = [(r[0], r[1]) for r in tx.grade_texts(docs, model).select(F.col("row.doc_id").alias("doc_id"), F.col("toxic").alias("said")).join(
        labels.where(~half).select("doc_id", F.col("toxic").alias("truth")), "doc_id").select("truth", "said").collect()]
    hit = sum(t == 1 and s for t, s in rows)
    assert hit / sum(t for t, _ in rows) > 0.7  # fitted on 200 toxic documents in four languages; some labels are noise
    assert sum(t == 0 and s for t, s in rows) / len(rows) < 0.01


def test_awkward_tables(spark):
    docs = docs_frame(spark, ["you idiot", "you idiot", None, "", "fine words", "fine words"], [1, 1, None, 3, 4, 4])
    labels = spark.createDataFrame([(1, 1, 1), (1, 0, 1), (3, 1, 0), (4, 1, 0), (None, 1, 1), (9, 0, 1), (4, None, None)],
                                   "doc_id long, quality int, toxic int")
    rows = tx.grade_texts(docs, tx.train(docs, labels)).collect()
    assert len(rows) == 6 and all(r.severity >= 0 for r in rows)
    kept = tx.without_toxic(docs, labels.where("false"))
    assert kept.columns == docs.columns and kept.count() <= 6
    assert tx.without_toxic(docs.where("false"), labels).collect() == []


def test_whole_texts_are_fitted(spark):
    """The features chosen on Spark are those `fit` chooses from all features of the whole texts: a marker word after
    some 20,000 filler words of one long text still counts."""
    rng = np.random.default_rng(5)
    filler = " ".join(f"filler{chr(97 + i % 26)}{chr(97 + i // 26 % 26)}{chr(97 + i // 676 % 26)}" for i in range(20000))
    texts, grades = [], []
    for i in range(60):
        toxic = i % 3 == 0
        words = " ".join(rng.choice(["plain", "words", "here", "today", "table"], 8))
        texts.append((filler + " " if i == 0 else "") + words + (" zonkmark" if toxic else ""))
        grades.append(int(toxic))
    ids = list(range(1, 61))
    docs = docs_frame(spark, texts, ids)
    labels = spark.createDataFrame([(d, 1, g) for d, g in zip(ids, grades)], "doc_id long, quality int, toxic int")
    model = tx.train(docs, labels)
    features = tx._Features()
    order = sorted(range(60), key=lambda i: (grades[i], features.of(texts[i]).astype(np.int32).tobytes()))
    plain = tx.fit([features.of(texts[i]).astype(np.int32) for i in order], np.array(grades)[order])
    assert np.flatnonzero(model.weights).tolist() == np.flatnonzero(plain.weights).tolist()
    assert np.allclose(model.weights, plain.weights, atol=1e-6) and np.allclose(model.thresholds, plain.thresholds)
    assert model.weights[features.of("zonkmark")].sum() > 0
