"""Keys and lookups: dense surrogate ids (D4, D5), unique lookups (D6, D7) and a
broadcast that is taken only behind a size check.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, MapType, StringType, StructType

from adspark.session import materialize

DEFAULT_BROADCAST_ROWS = 50_000       # every broadcast passes through the driver: a load has some dozens
DEFAULT_BROADCAST_BYTES = 4 << 10     # compressed: a thousandfold of it in memory is still the bound below
DEFAULT_BROADCAST_MEMORY = 8 << 20    # bytes of the rows themselves
MEASURED_BYTES = 64 << 20             # beyond this estimate no job is run to find out
_LOW_BITS = (1 << 33) - 1  # monotonically_increasing_id keeps the row index in the low 33 bits


def estimated_bytes(df: DataFrame) -> int | None:
    """The optimizer's size estimate of ``df`` (no job).  For file scans it comes from the
    size of the (compressed) files; ``None`` where the estimate cannot be read."""
    try:
        return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    except Exception:  # e.g. a Spark Connect session
        return None


def row_bytes(df: DataFrame) -> Column:
    """About the bytes of a row in memory: the text or bytes of wide columns, 8 for others."""
    width = F.lit(8)
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, (ArrayType, MapType, StructType)):
            c = c.cast("string")
        if isinstance(f.dataType, (StringType, BinaryType, ArrayType, MapType, StructType)):
            width = width + F.coalesce(F.octet_length(c), F.lit(0))
        width = width + 8
    return width.cast("bigint")


def broadcastable(df: DataFrame, max_rows: int = DEFAULT_BROADCAST_ROWS, max_bytes: int = DEFAULT_BROADCAST_BYTES,
                  max_memory: int = DEFAULT_BROADCAST_MEMORY) -> bool:
    """True when ``df`` is proven small: the optimizer's estimate (no job) is at most
    ``max_bytes``, or else its exact count is at most ``max_rows`` and its rows take at
    most ``max_memory``.  With an estimate above ``MEASURED_BYTES`` it is not, unmeasured."""
    est = estimated_bytes(df)
    if est is not None and est <= max_bytes:
        return True
    if est is not None and est > MEASURED_BYTES:
        return False
    n, size = df.agg(F.count(F.lit(1)), F.sum(row_bytes(df))).first()
    return n <= max_rows and (size or 0) <= max_memory


def sized_broadcast(df: DataFrame, max_rows: int = DEFAULT_BROADCAST_ROWS, max_bytes: int = DEFAULT_BROADCAST_BYTES,
                    max_memory: int = DEFAULT_BROADCAST_MEMORY) -> DataFrame:
    """Hint a broadcast only when ``df`` is proven small (``broadcastable``).  Above the
    bounds the plain DataFrame is returned and the join stays a shuffle join (AQE may still
    turn it into a broadcast at run time from real shuffle sizes).
    """
    return F.broadcast(df) if broadcastable(df, max_rows, max_bytes, max_memory) else df


def lookup_side(df: DataFrame, max_rows: int = DEFAULT_BROADCAST_ROWS) -> DataFrame:
    """``df`` as the side of a join that is looked up: broadcast when proven small, else hinted
    to shuffle.  Spark's own choice goes by compressed sizes, so without the hint it would still
    send tables through the driver that are many times as large there."""
    return F.broadcast(df) if broadcastable(df, max_rows) else df.hint("merge")


def dense_ids(df: DataFrame, order_by: list, id_col: str, start: int = 1) -> DataFrame:
    """Add a dense 1-based id in ``order_by`` order without a global window.

    Range-partition and sort by the keys, number rows inside each partition (the low
    bits of ``monotonically_increasing_id``), then add each partition's offset, a
    running total over per-partition counts (one row per partition, broadcast).  The
    numbered input is checkpointed first because it is read twice and must not be
    recomputed differently.  ``order_by`` must be a total order for stable ids.
    """
    cols = [F.col(c) if isinstance(c, str) else c for c in order_by]
    numbered = materialize(
        df.repartitionByRange(*cols).sortWithinPartitions(*cols)
          .withColumn("_mono", F.monotonically_increasing_id()))
    pid = F.shiftright(F.col("_mono"), 33)
    counts = numbered.groupBy(pid.alias("_pid")).agg(F.count(F.lit(1)).alias("_n"))
    offsets = counts.select(
        "_pid",
        F.coalesce(F.sum("_n").over(Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)),
                   F.lit(0)).alias("_off"))  # one row per partition
    out = (numbered.join(F.broadcast(offsets), pid == F.col("_pid"))
           .withColumn(id_col, (F.col("_off") + F.col("_mono").bitwiseAND(F.lit(_LOW_BITS)) + F.lit(start))
                       .cast("bigint"))
           .drop("_mono", "_pid", "_off"))
    return out


def keep_one(df: DataFrame, keys: list, order: list, last: bool = False) -> DataFrame:
    """One row per key: the first (or last) by ``order`` (a total order).

    Written as an aggregate of ``min`` / ``max`` over a struct of the order columns and
    the rest of the row, so the reduction runs map-side before the shuffle and a key
    repeated in a third of the input never lands whole in one task.
    """
    key_cols = list(keys)
    rest = [c for c in df.columns if c not in key_cols and c not in order]
    packed = F.struct(*[F.col(c) for c in order], *[F.col(c) for c in rest]).alias("_row")
    pick = F.max if last else F.min
    out = df.groupBy(*key_cols).agg(pick(packed).alias("_row"))
    return out.select(*[F.col(k) for k in key_cols], *[F.col("_row." + c).alias(c) for c in order + rest]) \
        .select(*df.columns)


def lookup_join(fact: DataFrame, dim: DataFrame, on: Column | str | list, how: str = "left",
                max_rows: int = DEFAULT_BROADCAST_ROWS) -> DataFrame:
    """Dimension lookup: broadcast hash join when the dimension is small enough."""
    return fact.join(lookup_side(dim, max_rows), on, how)
