"""Sharding by jump consistent hashing (operator 9).

The shard of a row is a function of its key and the shard count only: no ring, no table.
Appending a shard moves just the rows that land in the new one.  Slots inside a shard are
numbered without gathering a shard in one task: rows are range-sorted by (shard, key, ...)
over many tasks and numbered densely; a shard's first number is then taken off.

Cases: a null key hashes like any other value (all nulls go to one shard).  Null text
counts no bytes.  Repeated rows are rows of their own: same shard, different slots.  An
empty table gives no rows.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from adspark.llm.common import materialize
from adspark.operators.keys import dense_ids


def jump_hash(keys: np.ndarray, shards: int) -> np.ndarray:
    """Shards of unsigned 64-bit ``keys``: a pseudo-random walk of growing jumps, the last
    landing below ``shards`` being the answer.  All keys step together."""
    key = keys.astype(np.uint64)
    at = np.full(key.shape, -1, dtype=np.int64)
    ahead = np.zeros(key.shape, dtype=np.int64)
    moving = ahead < shards
    with np.errstate(over="ignore"):
        while moving.any():
            at = np.where(moving, ahead, at)
            key = np.where(moving, key * np.uint64(2862933555777941757) + np.uint64(1), key)
            spread = (key >> np.uint64(33)).astype(np.float64) + 1.0
            ahead = np.where(moving, ((at + 1) * (float(1 << 31) / spread)).astype(np.int64), ahead)
            moving = moving & (ahead < shards)
    return at


def jump_shard(key: Column, shards: int) -> Column:
    """Shard (0 .. shards-1) of a key column, by the jump hash of its 64-bit hash."""
    if shards < 1:
        raise ValueError("at least one shard")

    @F.pandas_udf("int")
    def shard(h: pd.Series) -> pd.Series:
        return pd.Series(jump_hash(h.to_numpy(dtype=np.int64).view(np.uint64), shards).astype(np.int32))

    return shard(F.xxhash64(key))


def assign_shards(df: DataFrame, key: str, shards: int, name: str = "shard") -> DataFrame:
    """``df`` with its rows' shard."""
    return df.withColumn(name, jump_shard(F.col(key), shards))


def number_slots(df: DataFrame, shard: str, order: list[str], name: str = "slot") -> DataFrame:
    """``df`` with gapless numbers from 0 inside each shard, in ``order``; a fixed random
    number breaks ties, so that many equal rows are spread over tasks too."""
    tied = df.withColumn("_tie", F.rand(17))
    numbered = materialize(dense_ids(tied, [shard, *order, "_tie"], "_at", start=0).drop("_tie"))
    first = numbered.groupBy(F.col(shard).alias("_shard")).agg(F.min("_at").alias("_first"))  # one row per shard
    return (numbered.join(F.broadcast(first), F.col(shard) == F.col("_shard"))
            .withColumn(name, F.col("_at") - F.col("_first")).drop("_at", "_shard", "_first"))


def write_shards(df: DataFrame, key: str, shards: int, path: str) -> None:
    """Write whole rows under ``shard=N`` folders.  A shard is written by many tasks (the
    salt), so it need not fit in one."""
    sharded = assign_shards(df, key, shards)
    (sharded.repartition("shard", F.floor(F.rand(17) * 64)).write.mode("overwrite").partitionBy("shard")
     .parquet(path))


def shard_documents(docs: DataFrame, shards: int = 8) -> DataFrame:
    """``key`` law over documents: shard, slot and the shard with one more shard."""
    light = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"),
                        (F.coalesce(F.octet_length("text"), F.lit(0)) + 1).cast("bigint").alias("size"),
                        F.crc32(F.coalesce(F.col("text"), F.lit("")).cast("binary")).alias("text_crc32"),
                        F.lit("key").alias("law"))
    both = light.withColumn("shard", jump_shard(F.col("doc_id"), shards)) \
        .withColumn("grown_shard", jump_shard(F.col("doc_id"), shards + 1))
    return number_slots(both, "shard", ["doc_id", "text_crc32"]).select(
        "doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard")
