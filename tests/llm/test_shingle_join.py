import random

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pytest
from helpers import awkward_texts, docs_frame, prose, words

from plazaflow.llm import shingle_join as sj


def shingles(text, size):
    w = words(text)
    if len(w) < size:
        return {tuple(w)} if w else set()
    return {tuple(w[i:i + size]) for i in range(len(w) - size + 1)}


def brute(texts, ids, percent=90, size=3):
    sets, label = [shingles(t, size) for t in texts], list(range(len(texts)))
    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and b and 100 * len(a & b) >= percent * len(a | b) and label[i] != label[j]:
                old, new = label[i], label[j]
                label = [new if x == old else x for x in label]
    best = {}
    for x, d in zip(label, ids):
        if d is not None:
            best[x] = min(best.get(x, d), d)
    return sorted(((-1 if d is None else d), len(s), -1 if best.get(x) is None else best[x]) for d, s, x in zip(ids, sets, label))


def edited(rng, text, n):
    w = text.split()
    for _ in range(n):
        w[rng.randrange(len(w))] = rng.choice(["zz", "yy", "qq"])
    return " ".join(w)


def run(docs, **kw):
    rows = sj.near_components(docs, **kw).select("doc_id", "n_shingles", "component_id").collect()
    return sorted(tuple(-1 if v is None else v for v in r) for r in rows)


def family_texts(seed, n=60):
    rng = random.Random(seed)
    bases = [prose(rng, k, [f"t{i}" for i in range(500)]) for k in (12, 30, 80, 200, 200, 500)]
    return [edited(rng, b := rng.choice(bases), rng.randrange(0, max(2, len(b.split()) // 20))) for _ in range(n)]


@pytest.mark.parametrize("percent,size", [(90, 3), (80, 5), (100, 2)])
def test_agrees_with_brute_force(spark, percent, size):
    texts = awkward_texts() + family_texts(1)
    assert run(docs_frame(spark, texts), percent=percent, size=size) == brute(texts, range(len(texts)), percent, size)


def test_large_family_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(sj, "BLOCK_SHINGLES", 1500)
    texts = family_texts(2, 90)
    assert run(docs_frame(spark, texts)) == brute(texts, range(len(texts)))


def test_repeated_and_missing_ids(spark):
    texts, ids = ["a b c d"] * 3 + [None, "", "x y z w"], [None, 7, 7, None, 4, None]
    assert run(docs_frame(spark, texts, ids)) == brute(texts, ids)


def test_empty_table(spark):
    assert run(docs_frame(spark, ["x"]).where("false")) == []


def test_one_of_each_stays(spark):
    texts = ["a b c d e f"] * 3 + [None, None, "", "", "other text that is alone", "a b c d e f"]
    ids = [3, 3, None, 5, 5, 6, None, 8, 9]
    docs = docs_frame(spark, texts, ids)
    kept = sj.one_of_each(docs)
    assert kept.columns == docs.columns
    assert sorted((-1 if r.doc_id is None else r.doc_id, r.text or "") for r in kept.collect()) == [
        (-1, ""), (3, "a b c d e f"), (5, ""), (5, ""), (6, ""), (8, "other text that is alone")]


def test_linked_sets_have_an_equal_part():
    rng = np.random.default_rng(3)
    for percent in (60, 80, 90, 95):
        scheme = sj.Scheme(percent)
        for n in (1, 2, 5, 9, 10, 11, 19, 20, 47, 300, 2000):
            for _ in range(20):
                a = np.unique(rng.integers(0, 2**64, n, np.uint64))
                cut, more = rng.integers(0, n // 8 + 2, 2)
                b = np.unique(np.concatenate([a[rng.permutation(len(a))[: max(len(a) - cut, 1)]], rng.integers(0, 2**64, more, np.uint64)]))
                if sj.linked(a, b, percent):
                    x, y = sj.part_keys([a, b], scheme)
                    assert set(x) & set(y), (percent, n, len(a), len(b))


def test_tree_finds_all_links():
    rng = random.Random(4)
    for _ in range(15):
        texts = family_texts(rng.random(), rng.randrange(1, 150))
        sets = [np.unique(np.array([hash(s) & (2**64 - 1) for s in shingles(t, 3)], np.uint64)) for t in texts]
        got, want = sj.join_self(sets, 90), brute(texts, range(len(texts)))
        first = {}
        for i, x in enumerate(got):
            first.setdefault(x, i)
        assert sorted((i, len(s), first[x]) for i, (s, x) in enumerate(zip(sets, got))) == want


def test_places_that_come_twice():
    rng, places = np.random.default_rng(3), sj.Places(300_000)
    flushes = [rng.integers(0, 2**places.bits, 2000) for _ in range(3)]
    flushes[1][:50], flushes[2][:50] = flushes[0][:50], flushes[0][:50]  # of several tasks
    flushes[2][60:90] = flushes[2][90]  # of one
    flushes.append(np.array([0, 2**places.bits - 1, 0]))
    seen, counts = np.unique(np.concatenate(flushes), return_counts=True)
    rows = pa.Table.from_batches([places.packed(f) for f in flushes])
    groups = [rows.filter(pc.equal(rows.column("bucket"), b)) for b in pc.unique(rows.column("bucket"))]
    assert len(groups) > 2 and sorted(p for g in groups for p in places.repeated(g).column("place").to_pylist()) == seen[counts > 1].tolist()
    assert sum(len(m) for m in rows.column("marks").to_pylist()) < 4 * sum(map(len, flushes))


def test_parts_of_one_class_stay_where_they_are(spark):
    rng = random.Random(8)
    near = prose(rng, 400, [f"n{i}" for i in range(300)])
    texts = [prose(rng, 400, [f"t{k}-{i}" for i in range(300)]) for k in range(20)] + [near, edited(rng, near, 4)]
    sets = sj.shingle_sets([t.encode() for t in texts], 5, sj.WordHasher(~sj._SPACES))
    parts = sj.part_keys(sets, sj.Scheme(80))
    places = sj.Places(sum(map(len, parts)))
    keys, counts = np.unique(np.concatenate(parts), return_counts=True)
    frame = lambda values: spark.createDataFrame([(int(v),) for v in values], "v long")
    first, shared = sj.Bloom(frame(range(len(texts))), len(texts)), sj.Bloom(frame(places.of(keys[counts > 1])), int((counts > 1).sum()))
    batch = pa.RecordBatch.from_arrays([pa.array([t.encode() for t in texts]), pa.array(range(len(texts)))], names=["text", "h"])
    sent = pa.Table.from_batches(list(sj._keys(iter([batch]), 5, 80, first, places, shared))).filter(pc.field("other").is_null())
    held = set(sent.column("key").to_pylist())
    assert set(keys[counts > 1].view(np.int64).tolist()) <= held and len(held) < len(keys) // 10


def test_a_class_is_cut_once_and_sends_one_text(spark):
    rng = random.Random(9)
    near = prose(rng, 60, [f"n{i}" for i in range(300)])
    texts = [near] * 40 + [edited(rng, near, 1)] * 40 + [None, ""]
    assert run(docs_frame(spark, texts).repartition(8)) == brute(texts, range(len(texts)))
    docs = docs_frame(spark, texts)
    lead = sj.Bloom(docs.where("doc_id IN (0, 40)").select("doc_id"), 2)
    batch = pa.RecordBatch.from_arrays([pa.array([None if t is None else t.encode() for t in texts]), pa.array(range(len(texts)))], names=["text", "h"])
    assert sum(map(len, sj._first_texts(iter([batch]), lead))) < 10


@pytest.mark.parametrize("n", range(7))
def test_chunks_of_few_words(n):
    sets = sj.shingle_sets([b"", b" ".join([b"w%d" % i for i in range(n)])], 5, sj.WordHasher(~sj._SPACES))
    assert [len(s) for s in sets] == [0, max(n - 4, min(n, 1))]
