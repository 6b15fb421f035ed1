"""Merkle manifest of a dataset by time-forward processing.

Every document is a leaf. Nodes are labelled (group, level, index); a node's parent is (group, level + 1,
index div FANOUT). Time-forward processing sends each node's digest forward to its parent's label: on Spark
the shuffle keyed and sorted by the parent's label is the external priority queue, and a level is one
pass over it, so every node is met once with its at most FANOUT children and no group of any size is held
by one task. The runs met on the way up are kept; a reversed sweep from the root then delivers proof
suffixes downwards: a node's suffix is its run's siblings followed by its parent's suffix.

Fixed values of the contract: a leaf is H of the fields doc_id, source, lang, n_chars, text, each written
`-` if null, else as its UTF-8 byte count, `:`, its value (integers in decimal); H is the lowercase hex
SHA-256 of the concatenated inputs, digests entering as hex text; runs are of 8.

Defined results for awkward input: null lang is a group of its own and sorts first; a null doc_id sorts
after all others within its lang and is never tampered; repeated doc_ids are ordered by their leaf (equal
leaves are interchangeable); a group or table of one leaf has that leaf as subroot (or root) and an empty
proof, whose digest is H of nothing; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F

from plazaflow.llm.common import numbered, written

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
FANOUT = 8
EMPTY = "e3b0c44298fc1c149afbf4c8996fb92427ae41e4649b934ca495991b7852b855"


def _field(value: Column) -> Column:
    text = value.cast("string")
    return F.when(text.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def leaf(doc_id: Column, source: Column, lang: Column, n_chars: Column, text: Column) -> Column:
    return F.sha2(F.concat(*[_field(c) for c in (doc_id, source, lang, n_chars, text)]), 256)


def tampered(doc_id: Column) -> Column:
    """Rows whose text the check lower-cases: 3 divides the unsigned CRC-32 of the decimal doc_id."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 0, F.lit(False))


def _runs(level: DataFrame) -> DataFrame:
    """Nodes (g, idx, digest) gathered at their parents' labels; a run of one node with index 0 is its group's top."""
    runs = level.groupBy("g", F.expr(f"idx div {FANOUT}").alias("idx")).agg(
        F.sort_array(F.collect_list(F.struct(F.expr(f"pmod(idx, {FANOUT})").alias("pos"), F.col("digest")))).alias("kids"))
    return runs.withColumn("done", (F.col("idx") == 0) & (F.size("kids") == 1))


def _tree(nodes: DataFrame, above: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """Proof suffix, subroot and root of every node (g, idx, digest); `above` gives (g, suffix, root) from (g, digest) of the tops."""
    levels, level = [], nodes.select("g", "idx", "digest")
    while True:
        runs = written(_runs(level), "merkle-runs")
        levels.append(runs)
        level = runs.where(~F.col("done")).select("g", "idx", F.sha2(F.concat_ws("", F.col("kids.digest")), 256).alias("digest"))
        if runs.where(~F.col("done")).isEmpty():
            break
    tops = None
    for runs in levels:
        top = runs.where("done").select("g", F.col("kids")[0]["digest"].alias("digest"))
        tops = top if tops is None else tops.unionByName(top)
    seeds = written(above(tops), "merkle-seeds")
    down = None
    for runs in reversed(levels):
        here = (runs.where("done").alias("r").join(seeds.alias("s"), F.col("r.g").eqNullSafe(F.col("s.g")))
                .select(F.col("r.g"), F.lit(0).cast("long").alias("idx"), F.col("s.suffix"), F.col("r.kids")[0]["digest"].alias("subroot"),
                        F.col("s.root")))
        if down is not None:
            kids = runs.where(~F.col("done")).select("g", F.col("idx").alias("parent"), F.col("kids.digest").alias("d"), F.posexplode("kids"))
            sibs = kids.select("g", "parent", (F.col("parent") * FANOUT + F.col("col.pos")).alias("idx"), F.struct(
                F.concat_ws("", F.slice("d", F.lit(1), F.col("pos"))).alias("left"),
                F.concat_ws("", F.slice("d", F.col("pos") + 2, F.size("d") - F.col("pos") - 1)).alias("right")).alias("sib"))
            inner = sibs.alias("k").join(down.alias("p"), F.col("k.g").eqNullSafe(F.col("p.g")) & (F.col("k.parent") == F.col("p.idx"))).select(
                F.col("k.g"), F.col("k.idx"), F.concat(F.array("k.sib"), F.col("p.suffix")).alias("suffix"), F.col("p.subroot"), F.col("p.root"))
            here = here.unionByName(inner)
        down = written(here, "merkle-down")
    return down


def manifest(docs: DataFrame) -> DataFrame:
    """Per document: doc_id, lang, leaf, subroot, root, proof_sha256, folded_root, verified.

    folded_root is the root recomputed from the leaf of the tampered row (or the original leaf) and the
    original proof; verified says whether it equals root.
    """
    c = {f: F.col(f"`{f}`") for f in FIELDS}
    low = F.translate(c["text"], "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    leaves = docs.select(*[c[f].alias(f) for f in ("doc_id", "lang")], leaf(*c.values()).alias("digest"),
                         F.when(tampered(c["doc_id"]), leaf(c["doc_id"], c["source"], c["lang"], c["n_chars"], low))
                         .otherwise(leaf(*c.values())).alias("changed"))
    leaves = numbered(leaves.withColumn("g", F.col("lang")), ["g"], [F.col("doc_id").asc_nulls_last(), F.col("digest")])

    def under_root(tops: DataFrame) -> DataFrame:
        top_leaves = numbered(tops, [], [F.col("g").asc_nulls_first()], "at").select(
            F.col("g").alias("lang"), F.lit(0).alias("g"), F.col("at").alias("idx"), "digest")
        over = _tree(top_leaves, lambda t: t.select("g", F.array().cast("array<struct<left:string,right:string>>").alias("suffix"),
                                                    F.col("digest").alias("root")))
        return top_leaves.join(over, ["g", "idx"]).select(F.col("lang").alias("g"), "suffix", "root")

    proofs = _tree(leaves, under_root)
    both = leaves.alias("l").join(proofs.alias("p"), F.col("l.g").eqNullSafe(F.col("p.g")) & (F.col("l.idx") == F.col("p.idx")))
    fold = F.aggregate("p.suffix", F.col("l.changed"), lambda acc, x: F.sha2(F.concat(x["left"], acc, x["right"]), 256))
    return both.select(
        F.col("l.doc_id").alias("doc_id"), F.col("l.lang").alias("lang"), F.col("l.digest").alias("leaf"), F.col("p.subroot").alias("subroot"),
        F.col("p.root").alias("root"),
        F.sha2(F.concat_ws("", F.transform("p.suffix", lambda x: F.concat(x["left"], x["right"]))), 256).alias("proof_sha256"),
        fold.alias("folded_root")).withColumn("verified", F.col("folded_root") == F.col("root"))
