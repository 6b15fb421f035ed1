"""What the corpus operators share: tables in the shared folder, row packing, hashing."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from plazaflow.session import shared_dir

#: Text handled at a time inside a task; a longer document is handled alone.
CHUNK_BYTES = 2**20
BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"
#: Shuffle files go as soon as the query that made them has ended, not when the driver happens to collect garbage.
FREES_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
#: Stands for a missing doc_id where ids are compared: smaller than any real one.
NO_ID = -(2**63)
#: The white space that separates words and is stripped from lines: space and tab to return.
SPACE = " \t\n\x0b\x0c\r"

def scratch(spark: SparkSession, name: str) -> str:
    """A new path in the folder that the cluster shares."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str, batch_bytes: int | None = None) -> DataFrame:
    """The frame as a table in the shared folder: cuts the lineage and outlives executors.

    batch_bytes: while it is written, Spark hands Python no larger Arrow batches than this (or one row).
    """
    conf, path = df.sparkSession.conf, scratch(df.sparkSession, name)
    wanted = {FREES_SHUFFLES: "true"} | ({BATCH_BYTES: batch_bytes} if batch_bytes else {})
    kept = {key: conf.get(key, None) for key in wanted}
    try:
        for key, value in wanted.items():
            conf.set(key, value)
        df.write.parquet(path)
    finally:
        for key, value in kept.items():
            conf.set(key, value) if value else conf.unset(key)
    table = df.sparkSession.read.schema(df.schema).parquet(path)
    table.table_path = path
    return table


def discard(*tables: DataFrame) -> None:
    """Deletes tables of written() that nothing will read again."""
    for table in tables:
        path = table.sparkSession._jvm.org.apache.hadoop.fs.Path(table.table_path)
        path.getFileSystem(table.sparkSession._jsc.hadoopConfiguration()).delete(path, True)


class Bloom:
    """A filter over 64-bit hashes: what it lets pass may be in the set, what it stops is not.

    Its size follows the number of hashes up to MOST_BITS (64 MB), so it may be broadcast; beyond
    that it only stops less.
    """

    MOST_BITS, PROBES = 2**29, 4

    def __init__(self, hashes: DataFrame, count: int):
        """hashes: a frame of one long column."""
        self.bits = min(max(1 << (16 * count).bit_length(), 2**13), self.MOST_BITS)
        h = F.col(hashes.columns[0])
        low, high = h.bitwiseAND(F.lit(2**32 - 1)), F.shiftrightunsigned(h, 32).bitwiseOR(F.lit(1))
        at = F.explode(F.array(*[F.pmod(low + high * i, F.lit(self.bits)) for i in range(self.PROBES)]))
        words = hashes.select(at.alias("at")).select(F.shiftright("at", 6).alias("word"), F.expr("shiftleft(1L, CAST(at & 63 AS INT))").alias("mask"))
        got = words.groupBy("word").agg(F.bit_or("mask").alias("mask")).toArrow()  # at most MOST_BITS / 64 rows
        table = np.zeros(self.bits // 64, np.uint64)
        table[got.column("word").to_numpy()] = got.column("mask").to_numpy().view(np.uint64)
        self.sent = hashes.sparkSession.sparkContext.broadcast(table)

    def passes(self, hashes: np.ndarray) -> np.ndarray:
        h, table = hashes.astype(np.int64).view(np.uint64), self.sent.value
        low, high = h & np.uint64(2**32 - 1), (h >> np.uint64(32)) | np.uint64(1)
        out = np.ones(len(h), bool)
        for i in range(self.PROBES):
            at = (low + high * np.uint64(i)) % np.uint64(self.bits)
            out &= (table[(at >> np.uint64(6)).astype(np.int64)] >> (at & np.uint64(63))) & np.uint64(1) == 1
        return out


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def packed(docs: DataFrame, without: str | None = None, **extra: Column) -> DataFrame:
    """The input row as one struct, so that no other name can clash with its columns; `without` a column that travels beside it."""
    columns = [F.col(f"`{c}`") for c in docs.columns if c != without]
    return docs.select((F.struct(*columns) if columns else F.struct(F.lit(0).alias("_"))).alias("row"), *[c.alias(n) for n, c in extra.items()])


def unpacked(df: DataFrame, columns: list[str], **replace: Column) -> DataFrame:
    """The columns of the packed row again, some replaced."""
    return df.select(*[(replace[c] if c in replace else F.col("row")[c]).alias(c) for c in columns])


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit mixer over uint64."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


class WordHasher:
    """64-bit hashes of the words in a buffer: the sum of one random number for each (place, byte).

    Two different words meet with probability 2**-64, whatever they are. A-Z count as a-z.
    """

    PLACES = 64

    def __init__(self, is_word: np.ndarray, seed: int = 11):
        self.is_word = is_word
        self.lower = np.arange(256, dtype=np.uint8)
        self.lower[65:91] += 32
        self.table = np.random.default_rng(seed).integers(0, 2**64, (self.PLACES, 256), np.uint64)

    def hashes(self, data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Where each word of the bytes starts, and its hash."""
        inside = self.is_word[data]
        edge = np.diff(inside.view(np.int8), prepend=np.int8(0), append=np.int8(0))
        starts, ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
        if not len(starts):
            return starts, np.zeros(0, np.uint64)
        sizes = ends - starts
        first = np.cumsum(sizes) - sizes
        place = np.arange(sizes.sum()) - np.repeat(first, sizes)
        value = self.table[place % self.PLACES, self.lower[data[inside]]]
        if sizes.max() > self.PLACES:
            with np.errstate(over="ignore"):
                value = value * (place // self.PLACES * 2 + 1).astype(np.uint64)
        return starts, np.add.reduceat(value, first)

    def of_texts(self, texts: list[bytes], gap: bytes) -> tuple[np.ndarray, np.ndarray]:
        """The hashes of all words of the texts in turn, and the number of words of each; `gap` is no word."""
        starts, hashes = self.hashes(np.frombuffer(gap.join(texts), np.uint8))
        bounds = np.cumsum([0, *(len(t) + 1 for t in texts)])
        return hashes, np.diff(np.searchsorted(starts, bounds))


def _chunk_bounds(column: pa.Array, most: int) -> Iterator[tuple[int, int]]:
    """Ranges of rows of at most `most` bytes together, or of one row."""
    sizes = pc.binary_length(column).fill_null(0).to_numpy(zero_copy_only=False)
    lo = total = 0
    for i, size in enumerate(sizes):
        if i > lo and total + size > most:
            yield lo, i
            lo, total = i, 0
        total += size
    if lo < len(sizes):
        yield lo, len(sizes)


def text_chunks(column: pa.Array, most: int = CHUNK_BYTES) -> Iterator[list[bytes]]:
    """The texts of a binary column in turn, as lists of at most `most` bytes together, or of one text; null is empty.

    Only one list at a time is taken out of the Arrow buffer.
    """
    for lo, hi in _chunk_bounds(column, most):
        yield [t or b"" for t in column.slice(lo, hi - lo).to_pylist()]


def small_batches(batches: Iterator[pa.RecordBatch], text: int, most: int = CHUNK_BYTES) -> Iterator[pa.RecordBatch]:
    """All rows in turn, in slices of at most `most` bytes of the text in column number `text`, or of one row.

    A function that gives its texts back slice by slice holds no second copy of a whole batch, and the executor
    reads its answers into small buffers. Nothing is copied here.
    """
    for batch in batches:
        for lo, hi in _chunk_bounds(batch.column(text), most):
            yield batch.slice(lo, hi - lo)


def numbered(df: DataFrame, keys: list[str], order: list[Column], name: str = "idx") -> DataFrame:
    """`df` written with `name`: each row's 0-based place in its group of `keys` (nulls form a group) by `order`.

    Spark's range exchange spreads even a group of a third of all rows over many tasks; a row's place is the
    rows of its group in earlier partitions (a table of at most partitions + groups rows) plus its place in
    its own sorted partition. The numbers are stored, so a lost executor cannot renumber them.
    """
    spark = df.sparkSession
    by = [F.col(k) for k in keys] + order
    ranged = (df.repartitionByRange(partitions(spark), *by).sortWithinPartitions(*by)
              .withColumn("_pid", F.spark_partition_id()).withColumn("_mono", F.monotonically_increasing_id()))
    table = written(ranged, "numbered")
    from pyspark.sql import Window

    starts = table.groupBy("_pid", *keys).agg(F.min("_mono").alias("_first"), F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy(*keys).orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    starts = starts.withColumn("_before", F.coalesce(F.sum("_n").over(before), F.lit(0)))
    on = [table["_pid"] == starts["_pid"]] + [table[k].eqNullSafe(starts[k]) for k in keys]
    out = table.join(starts, on).select(table["*"], (starts["_before"] + table["_mono"] - starts["_first"]).alias(name))
    return out.drop("_pid", "_mono")
