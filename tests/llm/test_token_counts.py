import random

import pytest
from helpers import awkward_texts, docs_frame

from plazaflow.llm import token_counts as tc

PIECES = ["a", "b", " ", "  ", "\n", "'", "'s", "'ll", "1", "22", "é", "!", "...", "\t", "the ", " x", "l", "\n\n", "'r", "e", "𝒳"]


@pytest.fixture(scope="module")
def counter():
    with open(tc.RANKS, "rb") as f:
        return tc.Counter(f.read())


def test_edits_count_as_a_whole_new_text_does(counter):
    rng = random.Random(1)
    for trial in range(1500):
        long = trial % 10 == 0
        text = "".join(rng.choice(PIECES) for _ in range(rng.randint(0, 3000 if trial % 100 == 0 else 400 if long else 30)))
        tree = tc.PieceTree(text, counter)
        for _ in range(6):
            start, n = rng.randint(-1, len(text) + 3), rng.randint(0, rng.choice([3, 8, 600]))
            insert = "".join(rng.choice(PIECES) for _ in range(rng.choice([0, 1, 2, 5, 900 if long else 3])))
            tree.edit(start, n, insert)
            start = min(max(start, 0), len(text))
            text = text[:start] + insert + text[start + n:]
            assert tree.text == text and tree.n_tokens == len(counter.bpe.encode_ordinary(text))
            assert [n for leaf in tree.leaves for n in leaf[0]] == list(map(len, counter.pattern.findall(text)))


def test_only_the_touched_region_is_encoded_again(counter):
    tree = tc.PieceTree("some words and more " * 20_000, counter)
    tree.edit(123_456, 3, "other")
    assert tree.touched < 20


def test_table(spark, counter):
    texts = awkward_texts()
    docs = docs_frame(spark, texts).withColumn("edits", tc.revision_edits())
    got = {r.row.doc_id: r for r in tc.count_with_edits(docs).collect()}
    for i, text in enumerate(texts):
        t, n = text or "", len(text or "")
        want = len(counter.bpe.encode_ordinary(t))
        for start, cut, insert in ((n // 2, 0, t.split("\n")[0]), (n // 4, 10, ""), (max(n - 5, 0), 5, f"s{i % 3}")):
            start = min(start, len(t))
            t = t[:start] + insert + t[start + cut:]
        assert (got[i].n_tokens, got[i].n_tokens_edited, got[i].n_edits) == (want, len(counter.bpe.encode_ordinary(t)), 3)


def test_edits_from_a_table(spark, counter):
    docs = docs_frame(spark, ["abc def", None, "same", "same"], [1, 2, 3, 3])
    edits = spark.createDataFrame([(1, 2, 0, 1, "X"), (1, 1, 3, 4, None), (2, 1, None, None, "new"), (9, 1, 0, 0, "x")],
                                  "doc_id long, seq int, start int, n_delete int, insert string")
    rows = tc.count_with_edits(tc.with_edits(docs, edits)).collect()
    n = lambda s: len(counter.bpe.encode_ordinary(s))
    assert sorted((r.row.doc_id, r.n_tokens, r.n_tokens_edited, r.n_edits) for r in rows) == [
        (1, n("abc def"), n("Xbc"), 2), (2, 0, n("new"), 1), (3, n("same"), n("same"), 0), (3, n("same"), n("same"), 0)]
    assert tc.count_with_edits(docs.where("false")).collect() == []


def test_a_vocabulary_must_be_of_bounded_size(spark, monkeypatch):
    monkeypatch.setattr(tc, "MAX_RANKS", 100)
    with pytest.raises(ValueError):
        tc.read_ranks(spark)
    with pytest.raises(ValueError):
        tc.read_ranks(spark, "file://" + tc.RANKS)
