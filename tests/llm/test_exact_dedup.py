import pytest
from helpers import awkward_texts, docs_frame, sha
from pyspark.sql import functions as F

from plazaflow.llm import exact_dedup as ed


def brute(rows):
    groups = {}
    for doc_id, text in rows:
        groups.setdefault(text or "", []).append(-1 if doc_id is None else doc_id)
    return sorted((-1 if d is None else d, max(groups[t or ""]), len(groups[t or ""]), sha(t or "")) for d, t in rows)


def run(docs, **kw):
    got = ed.equal_texts(docs, **kw).select("doc_id", "keep_id", "group_size", "text_sha256", "kept").collect()
    none = lambda x: -1 if x is None else x
    return sorted((none(r[0]), none(r[1]), r[2], r[3]) for r in got), got


@pytest.mark.parametrize("block", [4096, 5])
def test_agrees_with_brute_force(spark, block):
    texts = awkward_texts()[:20] + ["abcdefghij", "abcdefghi", "abcdeabcde", "abcde", "éééé", "ééé"] * 2
    ids = [None if i % 9 == 4 else i // 2 for i in range(len(texts))]
    found, rows = run(docs_frame(spark, texts, ids), block_bytes=block)
    assert found == brute(list(zip(ids, texts)))
    kept = [r for r in rows if r[4]]
    assert len(kept) == len({t or "" for t in texts}) == len({r[3] for r in kept})
    assert all(r[0] == r[1] for r in kept)


def test_another_print_is_taken_when_one_cannot_tell_blocks_apart(spark):
    def prints(block, salt):
        return F.struct(F.lit(7).cast("long").alias("f1"), F.lit(7).cast("long").alias("f2")) if salt == 0 else ed.block_print(block, salt)

    texts = ["one", "two", "one", "three"]
    assert run(docs_frame(spark, texts), prints=prints)[0] == brute(list(enumerate(texts)))


def test_empty_table(spark):
    assert run(docs_frame(spark, ["x"]).where("false"))[0] == []


def test_no_python_in_the_plan(spark):
    plan = ed.equal_texts(docs_frame(spark, ["a", "b"]))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
