"""Positions in a total order without a single-task window.

A window without (or with a hot) partition key runs in one task. Here the order
is a range-partitioned sort and the position is counted per partition, so no key
needs to fit anywhere.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, Window, functions as F

from plazaflow.session import shared_dir

SAMPLED = 64  # different keys looked at for each bound
FINE = 32  # bounds under one coarse bound


def _written(df: DataFrame) -> DataFrame:
    """The frame as a table in the shared folder, so that its bounds and its rows come from the same data."""
    path = f"{shared_dir(df.sparkSession)}/sequence-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _bounds(df: DataFrame, keys: list[str]) -> list[tuple]:
    """At most as many keys as shuffle partitions, evenly spread over the different keys; a bounded sample is sorted."""
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows, most = df.count(), parts * SAMPLED
    every = F.pmod(F.xxhash64(*keys), F.lit(max(1, rows // most))) == 0
    sample = [tuple(r) for r in df.where(every).select(*keys).distinct().orderBy(*keys).limit(2 * most).collect()]
    step = max(1, -(-len(sample) // parts))
    return sample[step::step]


def _bucket(df: DataFrame, keys: list[str], bounds: list[tuple]) -> Column:
    """How many bounds are at or below a row's key, found under the last coarse bound at or below it."""
    kinds = dict(df.dtypes)
    key = F.struct(*[F.col(k).alias(f"k{i}") for i, k in enumerate(keys)])
    lit = lambda row: F.struct(*[F.lit(v).cast(kinds[k]).alias(f"k{i}") for i, (k, v) in enumerate(zip(keys, row))])
    below = lambda array: F.size(F.filter(array, lambda b: b <= key))
    if not bounds:
        return F.lit(0)
    groups = [bounds[i:i + FINE] for i in range(0, len(bounds), FINE)]
    if len(groups) == 1:
        return below(F.array(*[lit(b) for b in bounds]))
    coarse = F.greatest(below(F.array(*[lit(g[0]) for g in groups])), F.lit(1))
    fine = F.element_at(F.array(*[F.array(*[lit(b) for b in g]) for g in groups]), coarse)
    return (coarse - 1) * FINE + below(fine)


def with_sequence(df: DataFrame, order: list[str], name: str = "_seq") -> DataFrame:
    """Adds the 0-based position in the order of `order` over the whole frame.

    Rows fall into ranges of the key by literal bounds; they are numbered within their range and
    shifted by the counts of the ranges before. The remaining sortable columns break ties, so
    the numbering is the same whenever the plan is evaluated; rows equal in all of them are
    interchangeable. Nothing is cached on executors.
    """
    kinds = dict(df.dtypes)
    keys = [*order, *[c for c in df.columns if c not in order and not kinds[c].startswith("map")]]
    rows = _written(df)
    rows = rows.withColumn("_range", _bucket(rows, keys, _bounds(rows, keys)))
    inside = F.row_number().over(Window.partitionBy("_range").orderBy(*keys)) - 1
    counts = rows.groupBy("_range").agg(F.count(F.lit(1)).alias("_n"))
    before = F.sum("_n").over(Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1))
    starts = counts.select("_range", F.coalesce(before, F.lit(0)).alias("_start"))  # a row per range, no more than shuffle partitions
    numbered = rows.withColumn("_inside", inside).join(F.broadcast(starts), "_range")
    return numbered.select(*df.columns, (F.col("_start") + F.col("_inside")).cast("bigint").alias(name))


def with_rank(df: DataFrame, keys: list[str], order: list[str], name: str = "_rank") -> DataFrame:
    """0-based position within each key, plus `_n`, the size of the key's group.

    Same as row_number() - 1 over (partition by keys order by order), but a key
    holding most of the rows is still spread over the range partitions.
    """
    seq = with_sequence(df, [*keys, *order])
    if not keys:
        size = seq.agg(F.count(F.lit(1)).alias("_n"))
        return seq.withColumnRenamed("_seq", name).crossJoin(F.broadcast(size))
    size = seq.groupBy(*keys).agg(F.min("_seq").alias("_first"), F.count(F.lit(1)).alias("_n"))
    size = size.select(*[F.col(k).alias(f"_k_{k}") for k in keys], "_first", "_n")
    match = [F.col(k).eqNullSafe(F.col(f"_k_{k}")) for k in keys]
    return (
        seq.join(size, match, "left")
        .withColumn(name, F.col("_seq") - F.col("_first"))
        .drop("_seq", "_first", *[f"_k_{k}" for k in keys])
    )


def with_series_index(df: DataFrame, keys: list[str], order: str, name: str = "_seq") -> DataFrame:
    """Adds the 0-based position within each series, ordered by the date column `order`.

    Rows are numbered inside (series, month) and shifted by the rows of earlier months,
    so a long series is spread over its months. Only the month counts of a series meet
    in one window. The remaining sortable columns break ties.
    """
    kinds = dict(df.dtypes)
    rest = [c for c in df.columns if c != order and c not in keys and not kinds[c].startswith("map")]
    rows = df.withColumn("_month", F.trunc(order, "MM"))
    counts = rows.groupBy(*keys, "_month").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy(*keys).orderBy("_month").rowsBetween(Window.unboundedPreceding, -1)
    base = counts.select(*keys, "_month", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_base"))
    inside = F.row_number().over(Window.partitionBy(*keys, "_month").orderBy(order, *rest)) - 1
    numbered = rows.withColumn("_inside", inside).join(base, [*keys, "_month"], "left")
    # a row without a complete key belongs to no series; it stays, numbered within its own month
    return numbered.withColumn(name, F.coalesce("_base", F.lit(0)) + F.col("_inside")).drop("_month", "_inside", "_base")


def halo_blocks(df: DataFrame, seq: str, halo: int, size: int = 8192) -> DataFrame:
    """Cuts a series (or sequence) into blocks and repeats the `halo` rows on each side.

    A frame of at most `halo` rows each way over (keys, _block) then sees the same
    rows as over the whole series, while a task holds size + 2*halo rows at most.
    Keep only `_core` rows after the window; each row is core in one block.
    """
    own = F.floor(F.col(seq) / size)
    before, after = F.floor((F.col(seq) - halo) / size), F.floor((F.col(seq) + halo) / size)
    blocks = F.array_distinct(F.array(own, F.greatest(before, F.lit(0)), after))
    return df.withColumn("_block", F.explode(blocks)).withColumn("_core", F.col("_block") == own)
