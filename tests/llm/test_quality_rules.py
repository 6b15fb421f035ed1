"""Quality rules against a plain version: base measures, exact binomial tails, cutoffs and verdicts."""

from __future__ import annotations

import math
import random
import re
from fractions import Fraction

import pytest

from plazaflow.llm import quality_rules as q

SCHEMA = "doc_id long, text string, lang string, stratum string, n_words int, kept string"


def plain_base(text):
    t = text or ""
    words = re.findall("[^\x20\x09-\x0d]+", t)
    n = len(words)
    lines = [line for line in t.split("\n") if re.search("[^\x20\x09-\x0d]", line)]
    seen, dup = set(), 0
    for line in lines:
        dup += line in seen
        seen.add(line)
    grams = {}
    for i in range(n - 2):
        grams.setdefault(tuple(words[i:i + 3]), []).append(i)
    marked = {i + d for starts in grams.values() if len(starts) > 1 for i in starts for d in range(3)}
    return {"n_words": n, "word_chars": sum(len(w) for w in words), "n_symbols": len(re.findall("[#*$%&|<>]", t)), "n_dup_lines": dup,
            "n_repeat_words": len(marked), "_n_lines": len(lines)}


def plain_cdf(k, n, p):
    p = Fraction(p)
    return float(sum(math.comb(n, i) * p**i * (1 - p) ** (n - i) for i in range(k + 1)))


def plain_safe(n, p, bound):
    """Exact cumulative binomial sums until they pass the bound."""
    p, cum, best = Fraction(p), Fraction(0), -1
    for k in range(n):
        cum += math.comb(n, k) * p**k * (1 - p) ** (n - k)
        if cum > Fraction(bound):
            break
        best = k
    return best


def plain_judge(rows, labels):
    base = {i: plain_base(r[1]) for i, r in enumerate(rows)}
    for b in base.values():
        b["base_failed"] = b["n_words"] < 50 or 100 * b["n_repeat_words"] > 50 * b["n_words"]
        w = max(b["n_words"], 1)
        b["symbol_ratio"], b["repeat_ratio"] = b["n_symbols"] / w, b["n_repeat_words"] / w
        b["dup_line_ratio"] = b["n_dup_lines"] / max(b["_n_lines"], 1)
    qual = {}
    for doc, quality in labels:
        if doc is not None and quality is not None:
            qual.setdefault(doc, []).append(quality)
    good = {d for d, v in qual.items() if min(v) == 1}
    strata = {}
    for i, r in enumerate(rows):
        if not base[i]["base_failed"] and r[0] in good:
            strata.setdefault(r[2], []).append(i)
    bound = q.DELTA / (max(len(strata), 1) * len(q.RULES))
    cut = {}
    for s, members in strata.items():
        k = plain_safe(len(members), q.ALPHA / len(q.RULES), bound)
        if k >= 0:
            cut[s] = {rule: sorted((base[i][rule] for i in members), reverse=True)[k] for rule in q.RULES}
    out = []
    for i, r in enumerate(rows):
        b = base[i]
        over = [rule for rule in q.RULES if r[2] in cut and b[rule] > cut[r[2]][rule]]
        out.append((r[0], b["n_words"], b["word_chars"], b["n_symbols"], b["n_dup_lines"], b["n_repeat_words"], b["base_failed"],
                    ",".join(over), not b["base_failed"] and not over))
    return sorted(out, key=repr)


def run(spark, rows, labels):
    docs = spark.createDataFrame([(r[0], r[1], r[2], "clash", 1, "x") for r in rows], SCHEMA).repartition(3)
    lab = spark.createDataFrame(labels, "doc_id long, quality int")
    got = q.judge(docs, lab).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
                                    "rejected_by", "kept").collect()
    return sorted((tuple(r) for r in got), key=repr)


def data(spark, n, k):
    """n and k as data, as in the operator, where Spark computes them per row rather than folding them while planning."""
    return spark.range(n).groupBy().count().select(q.F.col("count").alias("n"), q.F.lit(k).cast("long").alias("k"))


@pytest.mark.parametrize("k,n,p", [(0, 1, 0.3), (3, 40, 0.0167), (10, 200, 0.0167), (0, 300, 0.0167), (199, 200, 0.5), (25, 60, 0.4)])
def test_binomial_cdf(spark, k, n, p):
    got = data(spark, n, k).select(q.binomial_cdf(q.F.col("k"), q.F.col("n"), p).alias("c")).first().c
    assert got == pytest.approx(plain_cdf(k, n, p), rel=1e-9, abs=1e-300)


@pytest.mark.parametrize("n", [1, 50, 181, 400, 1000])
def test_largest_safe(spark, n):
    p, bound = q.ALPHA / 3, 0.05 / 6
    got = data(spark, n, 0).select(q.largest_safe(q.F.col("n"), p, q.F.lit(bound)).alias("k")).first().k
    assert got == plain_safe(n, p, bound)


def make_rows(n, seed=1):
    rng = random.Random(seed)
    vocab = [f"w{i}" for i in range(300)] + ["#", "$$", "<b>", "é", "Ünï"]
    rows = []
    for i in range(n):
        kind = rng.random()
        if kind < 0.05:
            text = rng.choice([None, "", " \n ", "a b c a b c"])
        elif kind < 0.15:
            text = " ".join(["spam ham eggs"] * rng.randint(20, 40))
        elif kind < 0.25:
            text = "\n".join(["same line here"] * 30 + [" ".join(rng.choice(vocab) for _ in range(40))])
        else:
            text = "\n".join(" ".join(rng.choice(vocab) for _ in range(rng.randint(5, 20))) for _ in range(rng.randint(4, 12)))
            if rng.random() < 0.2:
                text += " " + "#*$%&|<>" * rng.randint(1, 30)
        rows.append((rng.choice([i, i, i, 3]), text, rng.choice(["en", "en", "en", "fr", None])))
    return rows


@pytest.mark.parametrize("n,seed", [(700, 1), (250, 2)])
def test_against_plain(spark, n, seed):
    rows = make_rows(n, seed)
    rng = random.Random(seed)
    labels = [(r[0], rng.choice([1, 1, 1, 1, 0, None])) for r in rows if rng.random() < 0.7] + [(None, 1), (10**9, 0)]
    assert run(spark, rows, labels) == plain_judge(rows, labels)


def test_very_long_and_repeats(spark):
    long = " ".join(f"w{i % 997}" for i in range(200_000))
    rows = [(1, long, "en"), (1, long, "en"), (2, "x " * 60, "en"), (3, None, None), (4, "", "en")]
    assert run(spark, rows, []) == plain_judge(rows, [])


def test_empty(spark):
    assert q.judge(spark.createDataFrame([], SCHEMA), spark.createDataFrame([], "doc_id long, quality int")).count() == 0


def test_the_search_for_the_safe_count_is_a_small_expression(spark):
    # the driver plans it; written out with every repeat it had 90,000 characters
    assert len(q.largest_safe(q.F.col("n"), 0.01, q.F.lit(0.001))._jc.toString()) < 10_000
