"""Gate counts: conform labels, fill dead sensors, correct double counting.

Both cleaning steps look at neighbouring rows of one gate-hour series. The series
is numbered month by month and cut into blocks with a halo, so no series has to fit
in one task.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from operator import or_

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F

from plazaflow.functions.columns import flags
from plazaflow.functions.frames import literal_frame
from plazaflow.functions.ordering import halo_blocks, with_series_index
from plazaflow.operators.calendar import is_weekend

COUNTS = ["count_in", "count_out"]
SERIES = ["gate_id", "hour"]


def footfall_conform(raw: DataFrame, weekend_codes: list[str]) -> DataFrame:
    date = F.col("date").cast("date")
    return raw.select(
        "sensor_id",
        F.col("sensor_id").alias("gate_id"),
        "gate_name",
        date.alias("footfall_date"),
        F.col("hour").cast("int").alias("hour"),
        F.col("count_in").cast("double").alias("count_in"),
        F.col("count_out").cast("double").alias("count_out"),
        is_weekend(date, weekend_codes).alias("is_weekend"),
        "_source_file",
    )


def alias_frame(spark, cfg: dict) -> DataFrame:
    rows = [(label, gate) for gate, labels in cfg["gate_aliases"].items() for label in labels]
    return literal_frame(spark, rows, {"alias": "string", "alias_gate_id": "string"})


def conform_alias(df: DataFrame, aliases: DataFrame) -> DataFrame:
    """The label only raises flags; the sensor id stays the authority."""
    joined = df.join(aliases, F.trim("gate_name") == F.col("alias"), "left")
    known = F.col("alias_gate_id")
    marks = flags(
        unrecognized_gate_name=known.isNull(),
        gate_name_conform_mismatch=known.isNotNull() & (known != F.col("gate_id")),
    )
    return joined.withColumn("_dq_flags", marks).drop("alias", "alias_gate_id")


def split_keyless(df: DataFrame, keys: list[str]) -> tuple[DataFrame, DataFrame]:
    """Rows of a series, and rows that lack a part of the key: these belong to no series and are never cleaned."""
    whole = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])
    return df.filter(whole), df.filter(~whole)


def _fill_gaps(keys: list[str], cols: list[str], half: int):
    """Streams over gaps in series order. Only the last fills are remembered, so a
    long outage costs no memory; a new chain starts with nothing remembered."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        chain = None
        filled: dict[str, dict[int, float]] = {}
        for batch in batches:
            fills: dict[str, list[float | None]] = {c: [] for c in cols}
            chains = zip(*[batch[k] for k in [*keys, "_chain"]])
            for of, at, near in zip(chains, batch["_seq"], batch["_near"]):
                if of != chain:
                    chain, filled = of, {c: {} for c in cols}
                for c in cols:
                    seen = [r[c] if r[c] is not None else filled[c].get(r["_seq"]) for r in near]
                    seen = [v for v in seen if v is not None]
                    missing = any(r["_seq"] == at and r[c] is None for r in near)
                    fills[c].append(float(np.round(np.mean(seen))) if missing and seen else None)
                    if fills[c][-1] is not None:
                        filled[c] = {s: v for s, v in filled[c].items() if s >= at - half}
                        filled[c][at] = fills[c][-1]
            yield pd.DataFrame({**{k: batch[k] for k in [*keys, "_seq"]}, **{f"_fill_{c}": fills[c] for c in cols}})

    return run


def impute_series(df: DataFrame, keys: list[str] = SERIES, **options) -> DataFrame:
    """`impute_keyed` for the rows of a series; rows that lack a part of the key stay as they are, unflagged."""
    keyed, keyless = split_keyless(df, keys)
    return impute_keyed(keyed, keys, **options).unionByName(keyless.withColumn("is_imputed", F.lit(False)))


def impute_keyed(
    df: DataFrame, keys: list[str] = SERIES, cols: list[str] = COUNTS,
    order: str = "footfall_date", half: int = 7, block_rows: int = 8192,
) -> DataFrame:
    """Null counts become the half-even mean of the non-null values up to `half` rows
    each way in their series, where an earlier fill counts for a later one.

    Only the gaps, each with its neighbourhood, go through Python. Gaps more than
    `half` rows apart cannot influence each other, so chains of nearer gaps are the
    unit that must stay in order.
    """
    rows = with_series_index(df, keys, order)
    gap = reduce(or_, [F.col(c).isNull() for c in cols])
    block = Window.partitionBy(*keys, "_block").orderBy("_seq")
    slim = halo_blocks(rows.select(*keys, "_seq", *cols, gap.alias("_gap")), "_seq", half, block_rows)
    around = block.rowsBetween(-half, half)
    gaps = (
        slim.withColumn("_touched", F.max("_gap").over(around))
        .filter("_touched")  # keeps every row within reach of a gap, so frames of gaps are intact
        .withColumn("_near", F.collect_list(F.struct("_seq", *cols)).over(around))
        .filter("_core and _gap")
    )
    earlier_gap = F.exists(
        "_near", lambda r: (r["_seq"] < F.col("_seq")) & reduce(or_, [r[c].isNull() for c in cols])
    )
    # a chain is named by the gap that opens it: the last opening so far in the block, or else
    # the last one of an earlier block, so that no window spans a whole series
    opened = gaps.withColumn("_open", F.when(~earlier_gap, F.col("_seq")))
    so_far = F.max("_open").over(block.rowsBetween(Window.unboundedPreceding, 0))
    per_block = opened.groupBy(*keys, "_block").agg(F.max("_open").alias("_last"))
    earlier = Window.partitionBy(*keys).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    carried = per_block.select(*keys, "_block", F.max("_last").over(earlier).alias("_carried"))
    chained = opened.withColumn("_so_far", so_far).join(carried, [*keys, "_block"]).select(
        *keys, F.coalesce("_so_far", "_carried").alias("_chain"), "_seq", "_near"
    )
    kinds = dict(rows.dtypes)
    schema = ", ".join([f"{k} {kinds[k]}" for k in [*keys, "_seq"]] + [f"_fill_{c} double" for c in cols])
    laid = chained.repartition(*keys, "_chain").sortWithinPartitions(*keys, "_chain", "_seq")
    fills = laid.mapInPandas(_fill_gaps(keys, cols, half), schema)
    joined = rows.withColumn("is_imputed", gap).join(fills, [*keys, "_seq"], "left")
    for c in cols:
        joined = joined.withColumn(c, F.coalesce(c, f"_fill_{c}"))
    return joined.drop("_seq", *[f"_fill_{c}" for c in cols])


def correct_outliers(df: DataFrame, keys: list[str] = [*SERIES, "is_weekend"], **options) -> DataFrame:
    """`correct_keyed` for the rows of a series; rows that lack a part of the key stay as they are, unflagged."""
    keyed, keyless = split_keyless(df, keys)
    return correct_keyed(keyed, keys, **options).unionByName(keyless.withColumn("is_outlier_corrected", F.lit(False)))


def correct_keyed(
    df: DataFrame, keys: list[str] = [*SERIES, "is_weekend"], cols: list[str] = COUNTS,
    order: str = "footfall_date", rows: int = 61, min_rows: int = 15, ratio: float = 1.5,
    block_rows: int = 8192,
) -> DataFrame:
    """A count above `ratio` times the centred rolling median becomes that median, half-even."""
    half = rows // 2
    blocks = halo_blocks(with_series_index(df, keys, order), "_seq", half, block_rows)
    frame = Window.partitionBy(*keys, "_block").orderBy("_seq").rowsBetween(-half, half)
    # sorting the frame's values is several times cheaper here than percentile(), which
    # rebuilds a map of boxed values for every row
    blocks = blocks.withColumns({f"_values_{c}": F.collect_list(c).over(frame) for c in cols})

    def middle(c: str) -> Column:
        values = F.sort_array(f"_values_{c}")
        size = F.size(values)
        low, high = (F.get(values, F.floor(n / 2).cast("int")) for n in (size - 1, size))
        return F.when(size >= min_rows, (low + high) / 2)

    blocks = blocks.filter("_core").withColumns({f"_med_{c}": middle(c) for c in cols})
    out = blocks.drop(*[f"_values_{c}" for c in cols])
    high = {
        c: F.coalesce(F.col(c) / F.when(F.col(f"_med_{c}") != 0, F.col(f"_med_{c}")) > ratio, F.lit(False))
        for c in cols
    }
    out = out.withColumn("is_outlier_corrected", reduce(or_, high.values()))
    fixed = {c: F.when(high[c], F.bround(f"_med_{c}")).otherwise(F.col(c)) for c in cols}
    return out.withColumns(fixed).drop("_seq", "_block", "_core", *[f"_med_{c}" for c in cols])


def to_counts(df: DataFrame, cols: list[str] = COUNTS) -> DataFrame:
    return df.withColumns({c: F.bround(c).cast("int") for c in cols})


def footfall_silver(raw: DataFrame, aliases: DataFrame, weekend_codes: list[str]) -> DataFrame:
    # keyless rows part once, before both steps
    df, keyless = split_keyless(conform_alias(footfall_conform(raw, weekend_codes), aliases), SERIES)
    df = correct_keyed(impute_keyed(df))
    df = to_counts(df.unionByName(keyless.withColumns({"is_imputed": F.lit(False), "is_outlier_corrected": F.lit(False)})))
    return df.select(
        "sensor_id", "gate_id", "footfall_date", "hour", "count_in", "count_out",
        "is_imputed", "is_outlier_corrected", "_source_file", "_dq_flags",
    )
