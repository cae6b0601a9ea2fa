"""Stored keyed tables: last-write-wins upserts (B4) and exactly-once counters.

A table is a set of slices, one for each value of its partition column, each in a folder of
its own; a manifest (``sources.versions``) points at the folder of every slice.  A write
reads and rewrites only the slices that it touches, into fresh folders, and commits all of
them with one manifest; whatever dies before leaves the table as it was, and the manifest
carries the batches that are in, so a batch that is sent again is recognised.

A key that a batch moves to another slice has to leave its old one.  A locator, key -> slice,
is kept beside the data in ``BUCKETS`` folders by a hash of the key, so only the buckets of
the batch's keys are read to find where these lie now, never the table.

Slices are named by the hexadecimal form of the value's text, so null, the empty string and
any character are values like others; the column itself stays in the files, with its type.
Slices are written range-partitioned by partition column and key, so a slice that holds a
third of all rows is written by many tasks.  Names of slices and buckets pass through the
driver (one short string for each partition value that a batch touches), rows never do.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from adspark.operators.keys import keep_one, sized_broadcast
from adspark.session import materialize
from adspark.sources import versions

BUCKETS = 64
SLICE, BUCKET = "adspark_slice", "adspark_bucket"


def slice_name(partition_col: str) -> Column:
    """The folder of a partition value: letters and digits only."""
    return F.coalesce(F.concat(F.lit("x"), F.hex(F.col(partition_col).cast("string"))), F.lit("none"))


def bucket_of(key: list[str], buckets: int) -> Column:
    return F.format_string("b%05d", F.pmod(F.xxhash64(*key), F.lit(buckets)))


def same_rows(left: DataFrame, right: DataFrame, on: list[str], how: str) -> DataFrame:
    """A semi or anti join on columns in which null equals null."""
    other = right.select(*[F.col(c).alias(f"__{c}") for c in on])
    return left.join(other, [F.col(c).eqNullSafe(F.col(f"__{c}")) for c in on], how)


def _names(df: DataFrame, column: str) -> list[str]:
    return sorted(r[0] for r in df.select(column).distinct().collect())  # one short string each


def _open(spark: SparkSession, root: str, folders: dict[str, str], schema: StructType,
          only: list[str] | None = None) -> DataFrame:
    """The rows of some folders of a manifest."""
    paths = [versions.join(root, folders[n]) for n in sorted(folders) if only is None or n in set(only)]
    return spark.read.schema(schema).parquet(*paths) if paths else spark.createDataFrame([], schema)


def _write(spark: SparkSession, root: str, kind: str, rows: DataFrame, by: str, order: list) -> dict[str, str]:
    """Write ``rows`` into a fresh folder, one folder below for each value of ``by``."""
    folder = versions.fresh_folder(kind)
    path = versions.join(root, folder)
    (rows.repartitionByRange(by, *order).sortWithinPartitions(by, *order)
     .write.mode("errorifexists").partitionBy(by).parquet(path))
    return {n.split("=", 1)[1]: f"{folder}/{n}" for n in versions.list_names(spark, path) if n.startswith(f"{by}=")}


def _replaced(old: dict[str, str], new: dict[str, str], touched: list[str]) -> dict[str, str]:
    return {n: p for n, p in old.items() if n not in set(touched)} | new


def _schema(content: dict, batch: DataFrame) -> StructType:
    """The stored schema; a batch must have the same columns and types, in any order."""
    if not content:
        return batch.schema
    stored = StructType.fromJson(content["schema"])
    kinds = lambda s: {f.name: f.dataType for f in s.fields}
    if kinds(stored) != kinds(batch.schema):
        raise ValueError(f"the batch has {batch.schema.simpleString()}, the table {stored.simpleString()}")
    return stored


def upsert(spark: SparkSession, root: str, batch: DataFrame, key: list[str], partition_col: str,
           seq_col: str | None = None, batch_id: str | None = None, buckets: int = BUCKETS) -> bool:
    """Merge ``batch`` into the table at ``root``; per key the last load wins and, inside
    a batch, the row with the largest ``seq_col`` (which is not stored).  Without ``seq_col``
    a batch must not repeat a key.  With a ``batch_id`` that is in already nothing happens
    and the result is false."""
    number, content = versions.newest(spark, root)
    if batch_id is not None and batch_id in content.get("batches", []):
        return False
    if seq_col:
        batch = keep_one(batch, key, [seq_col], last=True).drop(seq_col)
    elif not batch.groupBy(*key).count().where("count > 1").isEmpty():
        raise ValueError(f"the batch repeats a key of {key} and has no order to decide by")
    schema = _schema(content, batch)
    buckets = content.get("buckets", buckets)
    batch = materialize(batch.select(*schema.names).withColumn(SLICE, slice_name(partition_col))
                        .withColumn(BUCKET, bucket_of(key, buckets)))
    slices, places = content.get("slices", {}), content.get("locator", {})
    place_schema = batch.select(*key, SLICE).schema
    touched_buckets = _names(batch, BUCKET)
    near = _open(spark, root, places, place_schema, touched_buckets)  # the batch's keys, and others of their buckets
    touched = sorted({*_names(batch, SLICE), *_names(same_rows(near, batch, key, "left_semi"), SLICE)})
    stay = same_rows(_open(spark, root, slices, schema, touched), batch, key, "left_anti") \
        .withColumn(SLICE, slice_name(partition_col))
    merged = stay.unionByName(batch.drop(BUCKET))
    located = (same_rows(near, batch, key, "left_anti").unionByName(batch.select(*key, SLICE))
               .withColumn(BUCKET, bucket_of(key, buckets)))
    rest = [c for c in key if c != partition_col]
    versions.commit(spark, root, {
        "schema": json.loads(schema.json()), "buckets": buckets, "key": key, "partition": partition_col,
        "slices": _replaced(slices, _write(spark, root, "data", merged, SLICE, rest), touched),
        "locator": _replaced(places, _write(spark, root, "locator", located, BUCKET, key), touched_buckets),
        "batches": content.get("batches", []) + ([batch_id] if batch_id is not None else [])}, number)
    return True


def add_counts(spark: SparkSession, root: str, batch_id: str, delta: DataFrame, key: list[str], counters: list[str],
               partition_col: str) -> bool:
    """Add a batch's counts to the stored counters, exactly once: the batch's id is
    committed with the counts.  A batch that is in already changes nothing (false).
    ``partition_col`` is one of the key's columns; a batch may repeat keys, null ones
    included."""
    if partition_col not in key:
        raise ValueError(f"{partition_col} is not one of {key}")
    number, content = versions.newest(spark, root)
    if batch_id in content.get("batches", []):
        return False
    summed = delta.groupBy(*key).agg(*[F.sum(c).cast("bigint").alias(c) for c in counters])
    schema = _schema(content, summed)
    summed = materialize(summed.select(*schema.names).withColumn(SLICE, slice_name(partition_col)))
    touched = _names(summed, SLICE)
    slices = content.get("slices", {})
    before = _open(spark, root, slices, schema, touched).withColumn(SLICE, slice_name(partition_col))
    merged = before.unionByName(summed).groupBy(*key, SLICE).agg(*[F.sum(c).alias(c) for c in counters])
    rest = [c for c in key if c != partition_col]
    versions.commit(spark, root, {
        "schema": json.loads(schema.json()), "key": key, "partition": partition_col,
        "slices": _replaced(slices, _write(spark, root, "data", merged.select(*schema.names, SLICE), SLICE, rest), touched),
        "batches": content.get("batches", []) + [batch_id]}, number)
    return True


def read(spark: SparkSession, root: str, where: DataFrame | None = None) -> DataFrame:
    """The table as last committed; with ``where`` (a column of partition values) only the
    slices of these values, found without a listing of the table."""
    _, content = versions.newest(spark, root)
    if not content:
        raise FileNotFoundError(f"no table has been committed at {root}")
    only = None if where is None else _names(where.select(slice_name(where.columns[0]).alias(SLICE)), SLICE)
    return _open(spark, root, content["slices"], StructType.fromJson(content["schema"]), only)


def find(spark: SparkSession, root: str, keys: DataFrame) -> DataFrame:
    """The rows of some keys: only the locator's buckets of these keys and the slices that
    they name are read."""
    _, content = versions.newest(spark, root)
    schema, key = StructType.fromJson(content["schema"]), content["key"]
    wanted = materialize(keys.select(*key).distinct().withColumn(BUCKET, bucket_of(key, content["buckets"])))
    place_schema = StructType([*[f for f in schema.fields if f.name in key], *StructType.fromDDL(f"{SLICE} string").fields])
    near = _open(spark, root, content["locator"], place_schema, _names(wanted, BUCKET))
    touched = _names(same_rows(near, sized_broadcast(wanted), key, "left_semi"), SLICE)
    return same_rows(_open(spark, root, content["slices"], schema, touched), sized_broadcast(wanted), key, "left_semi")


def batches(spark: SparkSession, root: str) -> list[str]:
    """The ledger: ids of the batches that are in, in the order of their commits."""
    return versions.newest(spark, root)[1].get("batches", [])
