import numpy as np
import pyarrow as pa
import pytest
from helpers import awkward_texts, docs_frame, sha
from pyspark.sql import functions as F

from plazaflow.llm import common, line_dedup as ld


def brute(rows):
    """rows: (doc_id, text) -> sorted (doc_id or -1, n_lines, n_dropped, sha)."""
    keyed, out = {}, []
    lower = {c: c + 32 for c in range(65, 91)}
    key = lambda line: line.strip(" \t\n\x0b\x0c\r").translate(lower)
    for doc_id, text in rows:
        for line in (text or "").split("\n"):
            if len(key(line)) >= 20:
                keyed.setdefault(key(line), set()).add(ld.NO_ID if doc_id is None else doc_id)
    for doc_id, text in rows:
        lines = (text or "").split("\n")
        me = ld.NO_ID if doc_id is None else doc_id
        kept = [x for x in lines if len(keyed.get(key(x), ())) < 3 or max(keyed[key(x)]) == me]
        out.append((-1 if doc_id is None else doc_id, len(lines), len(lines) - len(kept), sha("\n".join(kept))))
    return sorted(out)


def run(docs):
    got = ld.dedup_lines(docs).select("row.doc_id", "n_lines", "n_dropped", "kept_sha256").collect()
    return sorted((-1 if r[0] is None else r[0], *r[1:]) for r in got)


@pytest.mark.parametrize("shard_keys", [8192, 3])
def test_agrees_with_brute_force(spark, monkeypatch, shard_keys):
    # three keys to a shard make many shards, and shards that are repeated for their probes
    monkeypatch.setattr(ld, "SHARD_KEYS", shard_keys)
    texts = awkward_texts() + ["the same very common line\nown %d" % i for i in range(40)]
    assert run(docs_frame(spark, texts)) == brute(list(enumerate(texts)))


def test_repeated_and_missing_ids(spark):
    texts = ["a line that is long enough to count"] * 6 + [None, ""]
    ids = [1, 1, 2, None, None, 3, None, 3]
    assert run(docs_frame(spark, texts, ids)) == brute(list(zip(ids, texts)))


def test_empty_table(spark):
    assert run(docs_frame(spark, ["x"]).where("false")) == []


def test_hash_is_minimal_and_perfect():
    rng = np.random.default_rng(1)
    for n in (0, 1, 2, 5000):
        keys = rng.integers(0, 2**64, n, np.uint64)
        mph = ld.MinimalPerfectHash.load(ld.MinimalPerfectHash.build(keys).dump())
        assert sorted(mph.index(keys)) == list(range(n))


def test_index_knows_its_keys_and_few_others():
    rng = np.random.default_rng(2)
    h = rng.integers(0, 2**64, (4, 4000), np.uint64)
    index = ld.LineIndex.load(ld.LineIndex.build(h[0], h[1], np.full(4000, 3), np.arange(4000), 3).dump())
    assert not index.dropped(h[0], h[1], np.arange(4000)).any()
    assert index.dropped(h[0], h[1], np.full(4000, -5)).all()
    assert index.dropped(h[2], h[3], np.full(4000, -5)).sum() <= 1


def test_hashes_come_in_slices_of_a_batch():
    texts = [b"a line of document %d, long enough\n" % i * 12_000 for i in range(7)]  # 400 KB each
    texts = [*texts[:4], None, b"", *texts[4:6], texts[6] * 4]
    batch = pa.RecordBatch.from_arrays([pa.array(range(9)), pa.array(range(9)), pa.array(texts, pa.binary())], names=["doc", "copy", "text"])
    got = list(ld._line_hashes(iter([batch]), 20))
    assert len(got) > 3
    assert [i for b in got for i in b.column("doc").to_pylist()] == [0, 1, 2, 3, 6, 7, 8]


def test_texts_do_not_pass_through_arrow_to_be_cut(spark):
    """Batches of whole texts there and back were what filled an executor: only probes go by Arrow once lines are hashed."""
    plan = ld.dedup_lines(docs_frame(spark, awkward_texts()))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("MapInArrow") == 1 and "MapInArrow _probe" in plan


@pytest.mark.parametrize("own", [None, "32m"])
def test_written_bounds_the_batches_and_puts_the_setting_back(spark, own):
    if own:
        spark.conf.set(common.BATCH_BYTES, own)
    try:
        before = spark.conf.get(common.BATCH_BYTES)
        wide = spark.range(64).coalesce(1).select(F.repeat(F.lit("x"), 100_000).alias("text"))
        sizes = lambda batches: (pa.RecordBatch.from_arrays([pa.array([b.num_rows])], names=["n"]) for b in batches)
        got = [r.n for r in common.written(wide.mapInArrow(sizes, "n long"), "sizes", 2**20).collect()]
        assert sum(got) == 64 and max(got) <= 12
        assert spark.conf.get(common.BATCH_BYTES) == before
    finally:
        spark.conf.unset(common.BATCH_BYTES)
