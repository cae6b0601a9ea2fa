"""Data-quality checks from the reference's DDL constraints and document validators
(E1-E9), plus delete propagation (E6, E7).

Each check returns the violating rows with a ``rule`` column; nothing aborts unless
the caller (``sources.sinks.publish_tables``) is told to.  All are filters, anti
joins or aggregates with partial aggregation: no check collects anything.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from adspark.operators.keys import lookup_side


def _tag(df: DataFrame, rule: str) -> DataFrame:
    return df.withColumn("rule", F.lit(rule))


def _hits(df: DataFrame, key: list[str], rules: list[tuple[F.Column, F.Column, str]], with_value: bool) -> DataFrame:
    """One pass over ``df``: each (condition, value, rule) that holds gives one output
    row, via an array of hits and ``explode`` (no union that re-reads the input)."""
    hits = F.array(*[F.when(cond, F.struct(val.cast("string").alias("value"), F.lit(rule).alias("rule")))
                     for cond, val, rule in rules])
    out = df.select(*key, F.explode(F.filter(hits, lambda h: h.isNotNull())).alias("_h"))
    cols = [*key, F.col("_h.value").alias("value")] if with_value else list(key)
    return out.select(*cols, F.col("_h.rule").alias("rule"))


def check_not_null(df: DataFrame, columns: list[str], key: list[str]) -> DataFrame:
    """Rows with a NULL in any required column (one row per column broken)."""
    return _hits(df, key, [(F.col(c).isNull(), F.lit(None), f"not_null:{c}") for c in columns], with_value=False)


def check_unique(df: DataFrame, key: list[str], collation: str | None = None) -> DataFrame:
    """Keys that occur more than once, with their count.  ``collation`` (e.g.
    ``'UNICODE_CI'``) compares string keys the way a case-insensitive index does."""
    cols = [F.collate(F.col(k), collation).alias(k) if collation else F.col(k) for k in key]
    return df.groupBy(*cols).agg(F.count(F.lit(1)).alias("copies")).where(F.col("copies") > 1) \
        .withColumn("rule", F.lit("unique:" + ",".join(key)))


def check_range(df: DataFrame, column: str, key: list[str], lo=None, hi=None) -> DataFrame:
    """Values outside [lo, hi] (NULLs pass; E1 covers them)."""
    c = F.col(column)
    bad = F.lit(False)
    if lo is not None:
        bad = bad | (c < F.lit(lo))
    if hi is not None:
        bad = bad | (c > F.lit(hi))
    return df.where(bad).select(*key, c.cast("string").alias("value"), F.lit(f"range:{column}").alias("rule"))


def check_enum(df: DataFrame, column: str, allowed: list[str], key: list[str]) -> DataFrame:
    """Values outside the enum."""
    c = F.col(column)
    return df.where(c.isNotNull() & ~c.isin(list(allowed))) \
        .select(*key, c.alias("value"), F.lit(f"enum:{column}").alias("rule"))


def check_fk(child: DataFrame, fk: str, parent: DataFrame, pk: str, key: list[str],
             nullable: bool = True) -> DataFrame:
    """E5: child rows whose foreign key has no parent (NULL passes when nullable)."""
    c = child.where(F.col(fk).isNotNull()) if nullable else child
    parents = parent.select(F.col(pk).alias(fk))  # an anti join needs no distinct
    return c.join(lookup_side(parents), fk, "left_anti") \
        .select(*key, F.col(fk).cast("string").alias("value"), F.lit(f"fk:{fk}").alias("rule"))


def check_fit(raw: DataFrame, key: str, types: dict, max_lengths: dict[str, int] | None = None) -> DataFrame:
    """Text that does not fit its target type (present, but NULL after the lenient
    cast to ``types[column]``) or is longer than its VARCHAR(n).  One pass over the raw
    rows: the casts are evaluated in place, no join back to a typed copy."""
    rules = [(F.col(c).isNotNull() & F.col(c).try_cast(t).isNull(), F.col(c), f"type:{c}") for c, t in types.items()]
    rules += [(F.length(c) > n, F.col(c), f"length:{c}") for c, n in (max_lengths or {}).items()]
    return _hits(raw, [key], rules, with_value=True)


def check_array_elements(docs: DataFrame, array_col: str, required: list[str], key: list[str]) -> DataFrame:
    """Documents with an array element missing a required field."""
    ok = F.forall(array_col, lambda x: reduce(lambda a, b: a & b, [x[f].isNotNull() for f in required]))
    return docs.where(~ok).select(*key, F.lit(f"elements:{array_col}").alias("rule"))


def cascade_delete(parent_ids: DataFrame, chain: list[tuple[DataFrame, str, str]]) -> list[DataFrame]:
    """ON DELETE CASCADE.  ``chain`` is ``[(child, fk, child_pk), ...]`` from the
    parent down; each level drops the rows whose fk is deleted and passes its own
    deleted keys on.  Returns the surviving child tables in chain order."""
    survivors = []
    deleted = parent_ids
    for child, fk, child_pk in chain:
        gone = deleted.select(F.col(deleted.columns[0]).alias(fk)).distinct()
        hit = child.join(gone, fk, "left_semi")
        survivors.append(child.join(gone, fk, "left_anti"))
        deleted = hit.select(child_pk)
    return survivors


def set_null_delete(child: DataFrame, fk: str, deleted_ids: DataFrame) -> DataFrame:
    """ON DELETE SET NULL."""
    gone = deleted_ids.select(F.col(deleted_ids.columns[0]).alias("_gone")).distinct()
    j = child.join(lookup_side(gone), F.col(fk) == F.col("_gone"), "left")
    return j.withColumn(fk, F.when(F.col("_gone").isNull(), F.col(fk))).drop("_gone")
