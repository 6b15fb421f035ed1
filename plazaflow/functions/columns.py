"""Column helpers shared by the operators."""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, functions as F

MONEY = "decimal(12,3)"
QUANTITY = "decimal(10,2)"

# The three date styles found in tenant filings, in the order they are tried.
FILING_DATE_FORMATS = ("yyyy-MM-dd", "dd/MM/yyyy", "MMMM yyyy")


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def try_number(col: Column | str, kind: str) -> Column:
    """Number, or null where the text is not one."""
    return F.trim(_col(col)).try_cast(kind)


def parse_mixed_dates(col: Column | str, formats: tuple[str, ...] = FILING_DATE_FORMATS) -> Column:
    """First format that reads the text; null when none does."""
    text = _col(col)
    return F.coalesce(*[F.try_to_timestamp(text, F.lit(f)).cast("date") for f in formats])


def ratio(num: Column | str, den: Column | str) -> Column:
    """num / den as double, null where den is zero or null."""
    d = _col(den).cast("double")
    return _col(num).cast("double") / F.when(d != 0, d)


def mean(col: Column | str, where: Column | None = None) -> Column:
    """Average from an exact sum and a count, so the order of rows cannot matter."""
    c = _col(col)
    if where is not None:
        c = F.when(where, c)
    return ratio(F.sum(c), F.count(c))


def pct(num: Column | str, den: Column | str, scale: int) -> Column:
    """100 * num / den, rounded half up in decimal arithmetic; null on a zero denominator."""
    n = _col(num).cast("decimal(20,3)")
    d = _col(den).cast("decimal(20,3)")
    return F.round(F.lit(100) * n / F.when(d != 0, d), scale)


def count_where(cond: Column) -> Column:
    return F.count(F.when(cond, F.lit(1)))


def sum_where(col: Column | str, cond: Column) -> Column:
    return F.sum(F.when(cond, _col(col)))


def flags(**conditions: Column) -> Column:
    """Array of the names whose condition holds; empty array when none does."""
    named = [F.when(cond, F.lit(name)) for name, cond in conditions.items()]
    return F.array_compact(F.array(*named)).cast("array<string>")


def date_key(col: Column | str) -> Column:
    d = _col(col)
    return F.year(d) * 10000 + F.month(d) * 100 + F.dayofmonth(d)


def month_start(col: Column | str) -> Column:
    return F.trunc(_col(col), "MM")


def hashed(cols: list[str], seed: int) -> Column:
    """64 bits of the columns, another value for each seed; a null counts as a value of its own."""
    return F.xxhash64(F.lit(seed), *[x for c in cols for x in (F.col(c).isNull(), F.col(c))])


def any_of(conditions: list[Column]) -> Column:
    return reduce(or_, conditions)


def lookup(facts: DataFrame, dim: DataFrame, on: Column | str | list[str], how: str = "left") -> DataFrame:
    """Key lookup. No broadcast hint: dimensions grow with the business, so
    Catalyst and AQE choose from the measured size, and AQE splits hot keys."""
    return facts.join(dim, on, how)


def lookup_known(facts: DataFrame, dim: DataFrame, key: str, dim_key: str | None = None) -> DataFrame:
    """Left lookup by a text key that many rows may lack.

    Rows without the key are spread over keys that no dimension row has, so they never
    gather in the one partition of the null key."""
    spread = F.concat(F.lit("\0"), F.xxhash64(*[c for c, kind in facts.dtypes if not kind.startswith("map")]).cast("string"))
    keyed = facts.withColumn("_lookup", F.coalesce(F.col(key), spread))
    return keyed.join(dim.withColumnRenamed(dim_key or key, "_lookup"), "_lookup", "left").drop("_lookup")
