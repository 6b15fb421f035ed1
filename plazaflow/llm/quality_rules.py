"""Quality rules with risk-controlled thresholds, in DataFrame functions only.

Base rules (fixed by the contract): words are runs of `[^\\x20\\x09-\\x0D]`; word_chars counts their code
points; n_symbols the characters of `[#*$%&|<>]`; n_dup_lines the \\n-split lines holding a word that equal
an earlier line; n_repeat_words the word positions inside 3-word windows that occur twice or more in the
text, first occurrence included. A document fails the base when n_words < 50 or 100 * n_repeat_words >
50 * n_words.

The method then rejects a document that passes the base when one of RULES' ratios lies above its stratum's
cutoff. Cutoffs come from the labelled holdout (every `labels` row; a document is good when all its non-null
quality labels are 1): among the n good holdout documents of a stratum that pass the base, the cutoff is
the (k+1)-th largest ratio, where k is the largest count with P(Binomial(n, ALPHA / |RULES|) <= k) <=
DELTA / (strata * |RULES|). By the exact binomial law of order statistics the share of good documents that
a rule rejects then exceeds ALPHA / |RULES| with probability at most that bound; Bonferroni over rules and
strata keeps the chance that any stratum rejects more than ALPHA of its good documents below DELTA. A
stratum with too few good holdout documents for the bound gets no cutoff and rejects nothing by the method.

The binomial tail is the regularised incomplete beta function (Lanczos log-gamma, continued fraction
evaluated as a fold of fixed length that grows with sqrt(n)); k is found by bisection in
log2(n) + 1 steps.

Defined results: null text has no words and fails the base; empty and very long texts are measured whole;
null strata form one stratum; repeated rows are judged alike and each counts in the holdout; labels of
unknown documents are ignored; an empty table gives no rows; other columns of `docs` are ignored.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, functions as F

from plazaflow.llm.common import numbered, written

WORD = "[^\\x20\\x09-\\x0D]+"
SYMBOLS = "[#*$%&|<>]"
#: Ratios of the method, larger is worse.
RULES = ("symbol_ratio", "dup_line_ratio", "repeat_ratio")
ALPHA, DELTA = 0.05, 0.05
#: Strata with at most this many cutoffs go to every task; more are joined by a shuffle.
BROADCAST_CUTOFFS = 100_000
LANCZOS = (0.99999999999980993, 676.5203681218851, -1259.1392167224028, 771.32342877765313, -176.61502916214059, 12.507343278686905,
           -0.13857109526572012, 9.9843695780195716e-6, 1.5056327351493116e-7)


def _let(body, **values: Column) -> Column:
    """body of the values, each computed once and referred to by name (keeps the expression small)."""
    bound = F.array(F.struct(*[v.alias(k) for k, v in values.items()]))
    return F.transform(bound, lambda v: body(*[v[k] for k in values]))[0]


def base_measures(text: Column) -> Column:
    """The base measures of a text as a struct; every array is built once per row and referred to by name."""
    def measure(t, words):
        n = F.size(words)
        grams = F.transform(F.sequence(F.lit(0), F.greatest(n - 3, F.lit(0))),
                            lambda i: F.struct(F.concat_ws(" ", F.slice(words, i + 1, 3)).alias("g"), i.alias("i")))
        grams = F.when(n >= 3, F.array_sort(grams)).otherwise(F.array().cast("array<struct<g:string,i:int>>"))

        def repeated(grams):
            twice = F.filter(grams, lambda x, j: (F.get(grams, j - 1)["g"] == x["g"]) | (F.get(grams, j + 1)["g"] == x["g"]))
            return F.size(F.array_distinct(F.flatten(F.transform(twice, lambda x: F.sequence(x["i"], x["i"] + 2)))))

        return F.struct(
            n.cast("long").alias("n_words"),
            F.aggregate(words, F.lit(0).cast("long"), lambda acc, w: acc + F.length(w)).alias("word_chars"),
            (F.length(t) - F.length(F.regexp_replace(t, SYMBOLS, ""))).cast("long").alias("n_symbols"),
            _let(lambda lines: (F.size(lines) - F.size(F.array_distinct(lines))).cast("long"), lines=F.filter(F.split(t, "\n", -1), lambda x: x.rlike(WORD)))
            .alias("n_dup_lines"),
            _let(repeated, grams=grams).cast("long").alias("n_repeat_words"),
            F.size(F.filter(F.split(t, "\n", -1), lambda x: x.rlike(WORD))).cast("long").alias("_n_lines"))

    t = F.coalesce(text, F.lit(""))
    return _let(measure, t=t, words=F.regexp_extract_all(t, F.lit(WORD), 0))


def ratios() -> dict[str, Column]:
    words = F.greatest(F.col("n_words"), F.lit(1)).cast("double")
    return {"symbol_ratio": F.col("n_symbols") / words, "dup_line_ratio": F.col("n_dup_lines") / F.greatest(F.col("_n_lines"), F.lit(1)),
            "repeat_ratio": F.col("n_repeat_words") / words}


def _lgamma(x: Column) -> Column:
    """log Gamma(x) for x >= 1 (Lanczos, g = 7)."""
    return _let(_lgamma1, z=x - 1)


def _lgamma1(z: Column) -> Column:
    s = F.lit(LANCZOS[0])
    for i, c in enumerate(LANCZOS[1:], 1):
        s = s + F.lit(c) / (z + i)
    t = z + 7.5
    return F.lit(0.5 * math.log(2 * math.pi)) + (z + 0.5) * F.log(t) - t + F.log(s)


def _fraction(a: Column, b: Column, x: Column) -> Column:
    """The continued fraction of the incomplete beta function, folded over a length that grows with sqrt(a + b)."""
    tiny = 1e-300

    def guard(v):
        return F.when(F.abs(v) < tiny, F.lit(tiny)).otherwise(v)

    steps = F.sequence(F.lit(1), (F.lit(200) + F.sqrt(a + b) * 8).cast("int"))
    d0 = F.lit(1.0) / guard(F.lit(1.0) - (a + b) * x / (a + 1))
    start = F.struct(F.lit(1.0).alias("c"), d0.alias("d"), d0.alias("h"))

    def step(acc, m):
        m = m.cast("double")
        even = m * (b - m) * x / ((a - 1 + 2 * m) * (a + 2 * m))
        odd = -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 1 + 2 * m))

        def second(odd, d1, c1):
            return _let(lambda d2, c2: F.struct(c2.alias("c"), d2.alias("d"), (acc["h"] * d1 * c1 * d2 * c2).alias("h")),
                        d2=F.lit(1.0) / guard(1 + odd * d1), c2=guard(1 + odd / c1))

        return _let(lambda even, odd: _let(lambda d1, c1: second(odd, d1, c1), d1=F.lit(1.0) / guard(1 + even * acc["d"]), c1=guard(1 + even / acc["c"])),
                    even=even, odd=odd)

    return F.aggregate(steps, start, step)["h"]


def _beta(a: Column, b: Column, x: Column) -> Column:
    """The regularised incomplete beta function I_x(a, b) for a, b >= 1 and 0 < x < 1."""
    def body(a, b, x, low):
        front = _let(lambda ga, gb, gab: F.exp(gab - ga - gb + a * F.log(x) + b * F.log(1 - x)), ga=_lgamma(a), gb=_lgamma(b), gab=_lgamma(a + b))
        h = _let(_fraction, a=F.when(low, a).otherwise(b), b=F.when(low, b).otherwise(a), x=F.when(low, x).otherwise(1 - x))
        return _let(lambda front, h: F.when(low, front * h / a).otherwise(1 - front * h / b), front=front, h=h)

    return _let(lambda a, b, x: _let(lambda low: body(a, b, x, low), low=x < (a + 1) / (a + b + 2)), a=a, b=b, x=x)


def binomial_cdf(k: Column, n: Column, p: float) -> Column:
    """P(Binomial(n, p) <= k) for 0 <= k < n."""
    return _beta((n - k).cast("double"), (k + 1).cast("double"), F.lit(1.0 - p))


def largest_safe(n: Column, p: float, bound: Column) -> Column:
    """The largest k in [0, n) with P(Binomial(n, p) <= k) <= bound, or -1; n >= 1."""
    def search(n, bound):
        def step(acc, _):
            def halve(mid, open):
                return _let(lambda safe: F.struct(F.when(safe, mid).otherwise(acc["lo"]).alias("lo"), F.when(open & ~safe, mid).otherwise(acc["hi"]).alias("hi")),
                            safe=open & (binomial_cdf(mid, n, p) <= bound))

            return _let(halve, mid=F.greatest(F.floor((acc["lo"] + acc["hi"]) / 2), F.lit(0)).cast("long"), open=acc["hi"] - acc["lo"] > 1)

        start = F.struct(F.lit(-1).cast("long").alias("lo"), n.alias("hi"))
        steps = F.sequence(F.lit(1), (F.ceil(F.log2(n.cast("double") + 1)) + 1).cast("int"))
        return F.aggregate(steps, start, step)["lo"]

    return _let(search, n=n.cast("long"), bound=bound.cast("double"))


def judge(docs: DataFrame, labels: DataFrame, strata: str = "lang") -> DataFrame:
    """Per row of docs: doc_id, stratum, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
    the RULES ratios, rejected_by (rule names, comma-joined) and kept."""
    measured = docs.select(F.col("`doc_id`").alias("doc_id"), F.col(f"`{strata}`").alias("stratum"),
                           base_measures(F.col("`text`")).alias("b")).select("doc_id", "stratum", "b.*")
    measured = measured.withColumn("base_failed", (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words")))
    measured = written(measured.select("*", *[c.alias(k) for k, c in ratios().items()]), "quality-measured")
    good = labels.where(F.col("doc_id").isNotNull() & F.col("quality").isNotNull()).groupBy("doc_id").agg(
        (F.min("quality") == 1).alias("good"))
    holdout = measured.where(~F.col("base_failed")).join(good.where("good"), "doc_id", "left_semi")
    sizes = holdout.groupBy("stratum").agg(F.count(F.lit(1)).alias("n"))
    n_strata = max(sizes.count(), 1)
    bound = DELTA / (n_strata * len(RULES))
    safe = sizes.select("stratum", largest_safe(F.col("n"), ALPHA / len(RULES), F.lit(bound)).alias("k")).where("k >= 0")
    values = holdout.select("stratum", F.explode(F.array(*[F.struct(F.lit(r).alias("rule"), F.col(r).alias("v")) for r in RULES])).alias("x"))
    values = numbered(values.select("stratum", "x.rule", "x.v"), ["stratum", "rule"], [F.col("v").desc()])
    cutoffs = values.join(safe, values["stratum"].eqNullSafe(safe["stratum"]) & (values["idx"] == safe["k"])).select(
        values["stratum"], "rule", F.col("v").alias("cutoff"))
    cutoffs = cutoffs.groupBy("stratum").agg(F.map_from_entries(F.collect_list(F.struct("rule", "cutoff"))).alias("cutoffs"))
    if n_strata <= BROADCAST_CUTOFFS:
        cutoffs = F.broadcast(cutoffs)
    judged = measured.alias("m").join(cutoffs.alias("c"), F.col("m.stratum").eqNullSafe(F.col("c.stratum")), "left")
    over = F.array_compact(F.array(*[F.when(F.col(r) > F.col("c.cutoffs")[r], F.lit(r)) for r in RULES]))
    return judged.select("m.*", F.concat_ws(",", over).alias("rejected_by")).withColumn(
        "kept", ~F.col("base_failed") & (F.col("rejected_by") == "")).drop("_n_lines")
