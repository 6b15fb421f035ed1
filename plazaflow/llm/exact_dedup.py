"""Groups of equal texts by naming blocks, then pairs of names, until a text is one integer.

Texts are cut into blocks of fixed size. The different blocks are sorted and numbered; then
adjacent numbers of a text are paired and the different pairs are sorted and numbered, level
by level. Two texts of as many blocks are equal exactly when their last numbers are. Only
built-in functions are used. Block contents are shuffled once, to find the different ones;
afterwards a block is known by a 128-bit print that is proven to tell all blocks apart, else
another print is taken.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F

from plazaflow.llm.common import written

BLOCK_BYTES = 4096


def block_print(block: Column, salt: int) -> Column:
    return F.struct(F.xxhash64(block, F.lit(2 * salt)).alias("f1"), F.xxhash64(block, F.lit(2 * salt + 1)).alias("f2"))


def _numbered(different: DataFrame, name: str) -> DataFrame:
    """Numbers from 1 in the order of each partition; written, so that they stay as they are."""
    order = different.columns
    return written(different.sortWithinPartitions(*order).withColumn(name, F.monotonically_increasing_id() + 1), "names")


def _block_names(text: DataFrame, prints: Callable[[Column, int], Column], salt: int) -> DataFrame:
    blocks = text.select(F.explode("blocks").alias("block")).distinct().sortWithinPartitions("block")
    named = blocks.select(prints(F.col("block"), salt).alias("p"), (F.monotonically_increasing_id() + 1).alias("name"))
    return written(named.select("p.f1", "p.f2", "name"), "block-names")


def equal_texts(docs: DataFrame, block_bytes: int = BLOCK_BYTES, prints: Callable[[Column, int], Column] = block_print) -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, text_sha256, and n_blocks with name, its identity.

    Of equal texts the row with the largest doc_id stays; a missing id counts as smallest, and
    of rows that repeat id and text exactly one stays. A null text equals an empty one (a single
    empty block). Other columns are ignored. An empty table gives an empty result.
    """
    size = F.lit(block_bytes)
    raw = F.coalesce(F.col("text").cast("binary"), F.lit(b"").cast("binary"))
    n_blocks = F.greatest(F.lit(1), F.ceil(F.octet_length("raw") / size)).cast("int")
    text = docs.select("doc_id", raw.alias("raw")).withColumn("n_blocks", n_blocks).withColumn(
        "blocks", F.transform(F.sequence(F.lit(0), F.col("n_blocks") - 1), lambda i: F.substring("raw", i * size + 1, size)))
    salt = 0
    while True:
        names = _block_names(text, prints, salt)
        if names.groupBy("f1", "f2").count().where("count > 1").isEmpty():
            break
        salt += 1
    rows = written(text.select(
        F.monotonically_increasing_id().alias("rid"), "doc_id", F.sha2("raw", 256).alias("text_sha256"), "n_blocks",
        F.transform("blocks", lambda b: prints(b, salt)).alias("prints")), "texts")
    cells = rows.select("rid", "n_blocks", F.posexplode("prints").alias("pos", "p")).select("rid", "n_blocks", "pos", "p.f1", "p.f2")
    level = cells.join(names, ["f1", "f2"]).select("rid", "n_blocks", F.col("n_blocks").alias("m"), "pos", "name")
    level = written(level, "level")
    longest = rows.agg(F.max("n_blocks")).first()[0] or 1
    done = [level.where("m = 1")]
    while longest > 1:
        even = F.col("pos") % 2 == 0
        pairs = level.where("m > 1").groupBy("rid", "n_blocks", "m", F.expr("pos div 2").cast("int").alias("half")).agg(
            F.max(F.when(even, F.col("name"))).alias("a"), F.coalesce(F.max(F.when(~even, F.col("name"))), F.lit(0)).alias("b"))
        pairs = written(pairs, "pairs")
        names = _numbered(pairs.select("a", "b").distinct(), "name")
        level = written(pairs.join(names, ["a", "b"]).select(
            "rid", "n_blocks", F.ceil(F.col("m") / 2).cast("int").alias("m"), F.col("half").alias("pos"), "name"), "level")
        done.append(level.where("m = 1"))
        longest = -(-longest // 2)
    named = done[0]
    for more in done[1:]:
        named = named.union(more)
    named = rows.drop("prints", "n_blocks").join(named.select("rid", "n_blocks", "name"), "rid")
    groups = named.groupBy("n_blocks", "name").agg(
        F.max(F.struct("doc_id", "rid")).alias("keeper"), F.count(F.lit(1)).alias("group_size"))
    return named.join(groups, ["n_blocks", "name"]).select(
        "doc_id", F.col("keeper.doc_id").alias("keep_id"), "group_size", (F.col("rid") == F.col("keeper.rid")).alias("kept"),
        "text_sha256", "n_blocks", "name")
