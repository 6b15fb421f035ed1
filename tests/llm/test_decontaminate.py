import random

import numpy as np
import pytest
from helpers import awkward_texts, docs_frame, prose, sha

from plazaflow.llm import decontaminate as dc


def brute(text, items, window=10):
    w, hit, names = dc.word_list((text or "").encode()), set(), set()
    for name, item in items:
        x = dc.word_list((item or "").encode())
        k = min(window, len(x))
        own = {tuple(x[i:i + k]) for i in range(len(x) - k + 1)} if k else set()
        for i in range(len(w) - k + 1) if k else ():
            if tuple(w[i:i + k]) in own:
                hit.update(range(i, i + k))
                names.add("" if name is None else str(name))
    return len(w), len(hit), len(names), sha(",".join(sorted(names))), bool(hit)


@pytest.mark.parametrize("phrase_words", [dc.PHRASE_WORDS, 20])
def test_agrees_with_brute_force(spark, phrase_words):
    rng = random.Random(3)
    vocab = ["a", "b", "c", "Dé", "9"]
    items = [(i % 9, prose(rng, rng.randint(0, 25), vocab)) for i in range(12)] + [(20, None), (21, ""), (22, "!!"), (None, "lone words here"), (23, "solo")]
    texts = awkward_texts() + [prose(rng, rng.randint(0, 300), vocab + ["z"] * (i % 3)) for i in range(30)]
    texts += [f"x {t}, y" for _, t in items if t] + ["Solo", "LONE-words_here", "a " * 5000]
    bench = spark.createDataFrame(items, "item_id long, text string")
    found = dc.find_phrases(docs_frame(spark, texts), bench, phrase_words=phrase_words).collect()
    assert len(found) == len(texts)
    for r in found:
        n, hit, n_items, names, _ = brute(texts[r.row.doc_id], items)
        own = sum(b - a for a, b in zip(r.spans[::2], r.spans[1::2]))
        assert (r.n_words, own, len(r["items"]), sha(",".join(sorted(r["items"])))) == (n, hit, n_items, names), texts[r.row.doc_id]
    digest = {r.doc_id: tuple(r)[1:] for r in dc.contamination(docs_frame(spark, texts), bench).collect()}
    assert all(digest[i] == brute(t, items) for i, t in enumerate(texts))


def test_passages_are_cut_and_the_rest_stays(spark):
    passage = "one two three four five six seven eight nine ten eleven"
    texts = [f"before, {passage.upper()}! after", "clean text", None, passage, "one two three four five six seven eight nine"]
    docs = docs_frame(spark, texts)
    out = dc.without_benchmark(docs, spark.createDataFrame([(1, passage)], "item_id long, text string"))
    assert out.columns == docs.columns
    assert {r.doc_id: (r.text, r.n_chars) for r in out.collect()} == {
        0: ("before, ! after", 15), 1: ("clean text", 10), 2: (None, 0), 3: ("", 0), 4: (texts[4], len(texts[4]))}


def test_empty_tables(spark):
    docs, none = docs_frame(spark, ["a b"]), spark.createDataFrame([], "item_id long, text string")
    assert [tuple(r) for r in dc.contamination(docs, none).collect()] == [(0, 2, 0, 0, sha(""), False)]
    assert dc.contamination(docs.where("false"), none).collect() == []


def test_suffixes_and_ranks():
    rng = np.random.default_rng(1)
    for _ in range(200):
        vocab = int(rng.integers(1, 6))
        text = np.concatenate([rng.integers(0, vocab + 1, rng.integers(0, 60)), [0]])
        # sentinels are all different and below the symbols
        keys = [[(0, i + j) if x == 0 else (1, x) for j, x in enumerate(text[i:])] for i in range(len(text))]
        want = [i for i in sorted(range(len(text)), key=keys.__getitem__) if text[i] > 0]
        assert dc.suffix_order(text, vocab.bit_length()).tolist() == want
        index = dc.FmIndex(text, vocab)
        assert index.locate(np.arange(len(text))[len(text) - len(want):]).tolist() == want
        values = rng.integers(0, 8, 150)
        matrix = dc.WaveletMatrix(values, 3)
        at, symbols = rng.integers(0, 150, 40), rng.integers(0, 8, 40)
        assert matrix.rank(symbols, at).tolist() == [(values[:i] == s).sum() for i, s in zip(at, symbols)]
        got, before = matrix.access(at)
        assert got.tolist() == values[at].tolist() and before.tolist() == [(values[:i] == values[i]).sum() for i in at]
