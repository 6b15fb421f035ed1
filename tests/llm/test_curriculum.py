import math

import pytest
from helpers import awkward_texts, docs_frame, prose, words
from pyspark.sql import functions as F
import random

from plazaflow.llm import curriculum as cu


def brute_targets(sizes, weights=cu.WEIGHTS, most=3):
    """Fills step by step: what is above the cap goes to the others by weight, until none is."""
    order = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + ([None] if None in sizes else [])
    w = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    total, capped = sum(sizes.values()), {}
    while True:
        left = total - sum(capped.values())
        free = sum(w[s] for s in order if s not in capped)
        over = [s for s in order if s not in capped and left * w[s] / free > most * sizes[s]]
        if not over:
            return {s: capped.get(s, left * w[s] / free if s not in capped else 0) for s in order}
        capped |= {s: most * sizes[s] for s in over}


def sized_docs(spark, seed=1, n=200):
    rng = random.Random(seed)
    sources = [rng.choice(["a", "a", "a", "b", "c", "d", "Z", "é", None]) for _ in range(n)]
    texts = [prose(rng, rng.randint(0, 50)) for _ in range(n)] + awkward_texts()[:15]
    sources += ["a"] * 14 + ["tiny"]
    return texts, sources, docs_frame(spark, texts, sources=sources)


def test_targets_and_words_taken(spark):
    texts, sources, docs = sized_docs(spark)
    got = {r.row.doc_id: r for r in cu.mix(docs).collect()}
    sizes = {}
    for t, s in zip(texts, sources):
        sizes[s] = sizes.get(s, 0) + len(words(t))
    want, took = brute_targets(sizes), {}
    for i, (t, s) in enumerate(zip(texts, sources)):
        r = got[i]
        assert r["size"] == len(words(t)) and r["source_size"] == sizes[s] and math.isclose(r["target"], want[s], abs_tol=1e-9)
        assert r["taken"] == sum(x["words"] for x in r["takes"]) <= 3 * r["size"]
        took[s] = took.get(s, 0) + r["taken"]
    assert all(abs(took[s] - want[s]) <= 0.5 for s in sizes)
    again = {r.row.doc_id: r.takes for r in cu.mix(docs.repartition(7)).collect()}
    assert all(again[i] == got[i].takes for i in got)


def test_positions_follow_the_schedule(spark):
    _, _, docs = sized_docs(spark, 2)
    order = cu.in_training_order(cu.mix(docs)).collect()
    assert [r.position for r in order] == sorted(r.position for r in order)
    # by any time, each source has given what its integrated schedule demands, up to one document
    rank = {s: i for i, s in enumerate(sorted({r.row.source for r in order} - {None}, key=str.encode))}
    for source in rank:
        own = [r for r in order if r.row.source == source]
        total, so_far, knots = sum(r.words for r in own), 0, cu.RAMPS[rank[source] % 3]
        for r in own:
            at, share = r.position, 0
            for (t0, w0), (t1, w1) in zip(knots, knots[1:]):
                t = min(max(at, t0), t1)
                share += (t - t0) * (w0 + w0 + (w1 - w0) * (t - t0) / (t1 - t0)) / 2
            whole = sum((b[0] - a[0]) * (a[1] + b[1]) / 2 for a, b in zip(knots, knots[1:]))
            assert abs(share / whole * total - so_far) < 1e-3 * total + 1
            so_far += r.words


def test_places_are_those_of_the_training_order(spark):
    texts, _, docs = sized_docs(spark, 3)
    mixed = cu.mix(docs)
    first = {}
    for place, r in enumerate(cu.in_training_order(mixed).collect()):
        first.setdefault(r.row.doc_id, (r.position, place))
    took = {r.row.doc_id: r.taken for r in mixed.collect()}
    for frame in (mixed, cu.mix(docs.repartition(7))):
        got = cu.with_places(frame).collect()
        assert len(got) == len(texts) and all(r.taken == took[r.row.doc_id] for r in got)
        assert all((r.position, r.place) == first.get(r.row.doc_id, (None, None)) for r in got)
    assert cu.with_places(cu.mix(docs.where("false"))).collect() == []


def test_repeated_rows_missing_ids_and_empty_table(spark):
    docs = docs_frame(spark, ["a b c"] * 6 + [None], [1, 1, None, None, 2, 2, None], ["x"] * 7)
    rows = cu.mix(docs).collect()
    assert sum(r["taken"] for r in rows) == 18 and [r["taken"] for r in rows if r["size"] == 0] == [0]
    assert cu.mix(docs.where("false")).collect() == []
    assert cu.mix(docs.where("text is null")).first()["taken"] == 0


def test_bad_schedules_are_refused():
    for knots in ([(0, 1)], [(0, 1), (0.5, 1)], [(0, -1), (1, 1)], [(0, 0), (1, 0)], [(0, 1), (0.5, 1), (0.5, 2), (1, 1)]):
        with pytest.raises(ValueError):
            cu.integrated(knots)


def test_weight_zero_at_the_start(spark):
    one = spark.range(5).select(cu.when_due(F.col("id") / 4, [(0.0, 0.0), (1.0, 2.0)]).alias("t")).collect()
    assert all(abs(r.t - (i / 4) ** 0.5) < 1e-9 for i, r in enumerate(one))
