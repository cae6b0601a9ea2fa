"""A layout that prunes by several columns at once (A7, B6): rows in Z-order, with bloom
filters for lookups by id.

A table sorted by one column answers a question about another from all of its files.  Here
each column's value becomes the number of its quantile (so skewed ids spread evenly) and the
bits of these numbers are interleaved; files hold neighbouring rows of that order, so every
file spans a small range of every column and its statistics exclude it for most ids.  A value
that a third of the rows hold fills many files, which the other columns then tell apart.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, TimestampNTZType, TimestampType

BITS = 8             # quantiles of a column: 2 ** BITS
ERROR = 1e-3         # of a quantile's rank
Z = "adspark_z"


def _number(df: DataFrame, column: str) -> Column:
    """The column as a number in the same order."""
    kind = df.schema[column].dataType
    c = F.col(column)
    if isinstance(kind, TimestampNTZType):
        return F.timestamp_diff("SECOND", F.expr("TIMESTAMP_NTZ'1970-01-01 00:00:00'"), c).cast("double")
    if isinstance(kind, TimestampType):
        return F.unix_seconds(c).cast("double")
    if isinstance(kind, DateType):
        return F.unix_date(c).cast("double")
    return c.cast("double")


def _quantile_number(x: Column, bounds: list[float], bits: int) -> Column:
    """How many of the sorted ``bounds`` lie below ``x``, by binary search; null is 0."""
    known = F.array(*[F.lit(float(b)) for b in bounds])
    return F.aggregate(F.lit(list(range(bits - 1, -1, -1))), F.lit(0), lambda at, k: F.when(
        x > F.get(known, at + F.call_function("shiftleft", F.lit(1), k) - 1),
        at + F.call_function("shiftleft", F.lit(1), k)).otherwise(at))


def with_z(df: DataFrame, columns: list[str], bits: int = BITS) -> DataFrame:
    """``df`` with its place ``Z`` in the order over ``columns`` (numbers, dates, times)."""
    numbers = df.select(*[_number(df, c).alias(c) for c in columns])
    share = [i / (1 << bits) for i in range(1, 1 << bits)]
    bounds = numbers.approxQuantile(columns, share, ERROR)  # (2 ** bits - 1) numbers a column
    z = F.lit(0).cast("bigint")
    for n, (c, known) in enumerate(zip(columns, bounds)):
        at = _quantile_number(_number(df, c), known, bits) if known else F.lit(0)
        df = df.withColumn(f"{Z}_{n}", at)
        for bit in range(bits):
            z = z + F.shiftleft(F.shiftright(f"{Z}_{n}", bit).bitwiseAND(F.lit(1)).cast("bigint"), bit * len(columns) + n)
    return df.withColumn(Z, z).drop(*[f"{Z}_{n}" for n in range(len(columns))])


def ordered(df: DataFrame, columns: list[str], files: int | None = None, bits: int = BITS) -> DataFrame:
    """``df`` range-partitioned and sorted in Z-order; ``files`` partitions or, without it, as
    many as the session's shuffles have."""
    placed = with_z(df, columns, bits)
    by = [Z, *columns]
    ranged = placed.repartitionByRange(files, *by) if files else placed.repartitionByRange(*by)
    return ranged.sortWithinPartitions(*by).drop(Z)


def bloom_options(columns: list[str], distinct: int = 100_000) -> dict[str, str]:
    """Parquet writer options for a bloom filter on each of ``columns``, sized for that many
    distinct values in a row group."""
    out = {}
    for c in columns:
        out[f"parquet.bloom.filter.enabled#{c}"] = "true"
        out[f"parquet.bloom.filter.expected.ndv#{c}"] = str(distinct)
    return out


def write_ordered(df: DataFrame, path: str, columns: list[str], files: int | None = None,
                  bloom: list[str] | None = None, mode: str = "errorifexists") -> None:
    """Write ``df`` in Z-order over ``columns`` with bloom filters on ``bloom``."""
    ordered(df, columns, files).write.mode(mode).options(**bloom_options(bloom or [])).parquet(path)
