"""Keyed writes of the wide-column loads: last-write-wins upsert (B4) and idempotent
counter increments (B5)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from adspark.operators.keys import keep_one


def upsert_latest(existing: DataFrame, batch: DataFrame, key: list[str], seq_col: str = "load_seq",
                  existing_seq: int = 0, batch_seq: int = 1) -> DataFrame:
    """``existing`` then ``batch``; per key the row of the highest load sequence
    wins.  An aggregate, so a hot key is reduced map-side (never one task)."""
    a = existing.withColumn(seq_col, F.lit(existing_seq)) if seq_col not in existing.columns else existing
    b = batch.withColumn(seq_col, F.lit(batch_seq)) if seq_col not in batch.columns else batch
    return keep_one(a.unionByName(b), key, [seq_col], last=True).drop(seq_col)


def counter_merge(delta_log: DataFrame, key: list[str], counters: list[str], batch_col: str = "batch_id") -> DataFrame:
    """counters = sum over the delta log, each (batch, key) counted once, so that
    replaying a batch is a no-op (T12)."""
    once = delta_log.dropDuplicates([batch_col, *key])
    return once.groupBy(*key).agg(*[F.sum(c).cast("bigint").alias(c) for c in counters])


def tag_batch(delta: DataFrame, batch_id: int, batch_col: str = "batch_id") -> DataFrame:
    return delta.withColumn(batch_col, F.lit(batch_id))
