"""The Merkle manifest against a plain version of the contract."""

from __future__ import annotations

import hashlib
import zlib

import pytest

from plazaflow.llm import merkle

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, leaf string, g int, idx string"


def H(s: str) -> str:
    return hashlib.sha256(s.encode()).hexdigest()


def field(v) -> str:
    if v is None:
        return "-"
    s = str(v)
    return f"{len(s.encode())}:{s}"


def plain_leaf(r, text) -> str:
    return H("".join(field(v) for v in (r["doc_id"], r["source"], r["lang"], r["n_chars"], text)))


def plain(rows):
    """Levels of runs of 8 built naively; proofs by walking up."""
    def build(digests):
        levels = [digests]
        while len(levels[-1]) > 1:
            cur = levels[-1]
            levels.append([H("".join(cur[i:i + 8])) for i in range(0, len(cur), 8)])
        return levels

    def proof(levels, i):
        out = []
        for lev in levels[:-1]:
            s = i // 8 * 8
            out.append(("".join(lev[s:i]), "".join(lev[i + 1:s + 8])))
            i //= 8
        return out

    langs = sorted({r["lang"] for r in rows}, key=lambda x: (x is not None, (x or "").encode()))
    trees, order = {}, {}
    for lang in langs:
        mine = sorted([r for r in rows if r["lang"] == lang], key=lambda r: (r["doc_id"] is None, r["doc_id"] or 0, plain_leaf(r, r["text"])))
        order[lang] = mine
        trees[lang] = build([plain_leaf(r, r["text"]) for r in mine])
    top = build([trees[lang][-1][0] for lang in langs])
    out = {}
    for li, lang in enumerate(langs):
        for i, r in enumerate(order[lang]):
            pr = proof(trees[lang], i) + proof(top, li)
            text = r["text"]
            if r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 3 == 0 and text is not None:
                text = text.translate({c: c + 32 for c in range(65, 91)})
            acc = plain_leaf(r, text)
            for left, right in pr:
                acc = H(left + acc + right)
            out.setdefault(r["doc_id"], []).append((plain_leaf(r, r["text"]), trees[lang][-1][0], top[-1][0],
                                                    H("".join(a + b for a, b in pr)), acc, acc == top[-1][0]))
    return out


def rows_of(n, langs=("en", "fr", None, "de"), seed=3):
    import random

    rng = random.Random(seed)
    rows = []
    for i in range(n):
        text = rng.choice([None, "", "Hello World", "ÉTÉ Été", "x" * 5000, f"Doc {i} ABC"])
        rows.append({"doc_id": rng.choice([i, i, i, None, 7]), "text": text, "lang": rng.choice(langs), "source": rng.choice(["s", None, "ü"]),
                     "n_chars": rng.choice([None, len(text or "")])})
    return rows


def run(spark, rows):
    df = spark.createDataFrame([(r["doc_id"], r["text"], r["lang"], r["source"], r["n_chars"], "x", 1, "y") for r in rows], SCHEMA)
    got = {}
    for r in merkle.manifest(df.repartition(3)).collect():
        got.setdefault(r.doc_id, []).append((r.leaf, r.subroot, r.root, r.proof_sha256, r.folded_root, r.verified))
    return {k: sorted(v) for k, v in got.items()}


@pytest.mark.parametrize("n,langs", [(1, ("en",)), (8, ("en",)), (9, ("en",)), (70, ("en",)), (600, ("en", "fr", None, "de")), (30, tuple(f"l{i}" for i in range(20)))])
def test_against_plain(spark, n, langs):
    rows = rows_of(n, langs)
    want = {k: sorted(v) for k, v in plain(rows).items()}
    assert run(spark, rows) == want


def test_empty(spark):
    df = spark.createDataFrame([], SCHEMA)
    assert merkle.manifest(df).count() == 0


def test_lone_leaf_is_root(spark):
    rows = [{"doc_id": 1, "text": "abc", "lang": "en", "source": None, "n_chars": 3}]
    (leaf, sub, root, proof, folded, ok), = run(spark, rows)[1]
    assert leaf == sub == root == folded and proof == merkle.EMPTY and ok
