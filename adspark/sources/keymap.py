"""Ids that stay over loads (D4, D5): a stored map from keys to numbers.

Each load numbers only the keys that are not in the map yet, after the largest number given
so far, in their order; what has been given never changes.  The new part goes to a folder of
its own and the manifest that names it carries the high-water mark, so a load that dies has
given nothing.  Numbering is distributed (``keys.dense_ids``).
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from adspark.operators.keys import dense_ids, sized_broadcast
from adspark.sources import versions

MOST_PARTS = 50  # folders of a map before they are merged into one


def read(spark: SparkSession, root: str) -> DataFrame:
    """The whole map as last committed."""
    _, content = versions.newest(spark, root)
    if not content:
        raise FileNotFoundError(f"no map has been committed at {root}")
    return _open(spark, root, content)


def _open(spark: SparkSession, root: str, content: dict) -> DataFrame:
    schema = StructType.fromJson(content["schema"])
    return spark.read.schema(schema).parquet(*[versions.join(root, p) for p in content["parts"]])


def extend(spark: SparkSession, root: str, rows: DataFrame, key: list[str], id_col: str,
           order_by: list[str] | None = None) -> DataFrame:
    """Number the keys of ``rows`` that the map at ``root`` lacks, and return the whole map.

    New keys are numbered in the order of ``order_by`` (default: the key), which must be a
    total order of theirs; columns of ``rows`` besides the key stay with it.  Keys with a null
    column get no number.  Of rows with the same new key the first by all columns counts."""
    number, content = versions.newest(spark, root)
    fresh = rows.dropna(subset=key).dropDuplicates() if set(rows.columns) == set(key) else \
        rows.dropna(subset=key).groupBy(*key).agg(F.min(F.struct(*[c for c in rows.columns if c not in key])).alias("__rest")) \
        .select(*key, "__rest.*")
    if content:
        fresh = fresh.join(sized_broadcast(_open(spark, root, content).select(*key)), key, "left_anti")
    high = content.get("high", 0)
    numbered = dense_ids(fresh, order_by or key, id_col, start=high + 1)
    folder = versions.fresh_folder("parts")
    numbered.write.mode("errorifexists").parquet(versions.join(root, folder))
    added = spark.read.schema(numbered.schema).parquet(versions.join(root, folder)).count()
    parts = content.get("parts", []) + [folder]
    content = {"schema": json.loads(numbered.schema.json()), "parts": parts, "high": high + added}
    if len(parts) > MOST_PARTS:
        folder = versions.fresh_folder("parts")
        _open(spark, root, content).repartitionByRange(*key).write.mode("errorifexists").parquet(versions.join(root, folder))
        content["parts"] = [folder]
    versions.commit(spark, root, content, number)
    return _open(spark, root, content)
