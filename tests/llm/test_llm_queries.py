"""Every corpus query against its SQL, and the pipeline's stages against plain Python."""

import random

import pytest
from compare import check, connect
from helpers import docs_frame, words

import corpus_pipeline
from plazaflow.llm import decontaminate, queries
from test_decontaminate import brute as hits
from test_shingle_join import brute as components

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(queries.QUERIES))
def test_query(spark, name):
    ok, note = check(spark, connect(SF), name, SF)
    assert ok, note


def test_stages_do_what_they_say(spark):
    """Each stage on what the one before kept, whole tables, against brute force."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, before = docs.columns, {r.doc_id: r for r in docs.collect()}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = spark.createDataFrame(stage(spark, docs, SF).toPandas(), docs.schema)
        assert docs.columns == columns
        rows = {r.doc_id: r for r in docs.collect()}
        assert rows.keys() <= before.keys()
        if name == "toxicity":
            labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
            gone = [labels[i] for i in before.keys() - rows.keys() if i in labels]
            assert len(rows) > 0.8 * len(before) and sum(gone) >= len(gone) / 2
            assert all(rows[i] == before[i] for i in rows)
        if name == "line_dedup":
            keys = {}
            key = lambda x: x.strip(" \t\n\x0b\x0c\r").translate({c: c + 32 for c in range(65, 91)})
            for i, r in before.items():
                for line in (r.text or "").split("\n"):
                    keys.setdefault(key(line), set()).add(i)
            for i, r in before.items():
                want = "\n".join(x for x in (r.text or "").split("\n") if len(key(x)) < 20 or len(keys[key(x)]) < 3 or max(keys[key(x)]) == i)
                assert (rows[i].text or "") == want and rows[i].n_chars == len(want)
        if name == "shingle_join":
            ids = sorted(before)
            label = {i: c for i, _, c in components([before[i].text for i in ids], ids, 80, 5)}
            assert set(rows) == {i for i in ids if label[i] == i}
            assert all(rows[i] == before[i] for i in rows)
        if name == "decontamination":
            items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
            for i, r in before.items():
                _, n_hit, *_ = hits(r.text, items)
                if n_hit:
                    assert len(decontaminate.word_list((rows[i].text or "").encode())) == hits(r.text, items)[0] - n_hit
                else:
                    assert rows[i] == r
        before = rows
    mixed = corpus_pipeline.STAGES[-1][1](spark, docs, SF).collect()
    assert [r.position for r in mixed] == sorted(r.position for r in mixed)
    assert abs(sum(r.words for r in mixed) - sum(len(words(r.text)) for r in before.values())) <= 20
    assert all(r.text == before[r.doc_id].text and r.words <= len(words(r.text)) for r in mixed)


def test_stages_take_any_columns_and_empty_tables(spark):
    rng = random.Random(1)
    docs = docs_frame(spark, [None, "", "you idiot", "a b c"] + ["some words of a line that is long\n" + rng.choice("xyz")] * 5)
    docs = docs.withColumnRenamed("size", "position")
    for table in (docs, docs.where("false")):
        for _, stage in corpus_pipeline.STAGES[:-1]:
            assert stage(spark, table, SF).columns == docs.columns
            stage(spark, table, SF).collect()
        last = corpus_pipeline.STAGES[-1][1](spark, table, SF)
        assert last.columns[:len(docs.columns)] == docs.columns and len(set(last.columns)) == len(last.columns)
        last.collect()
