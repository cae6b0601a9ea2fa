"""Sinks (B1-B3, B6-B8): CSV / Parquet tables, report sections, clustered layouts,
staged multi-table publish and flattening of documents for text output."""

from __future__ import annotations

import logging
import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StructType

from adspark.sources import versions
from adspark.sources.keyed import same_rows
from adspark.sources.layout import write_ordered


def write_table(df: DataFrame, path: str, fmt: str = "parquet", mode: str = "overwrite",
                partition_by: list[str] | None = None) -> None:
    """One table; CSV gets a header row, ``mode='append'`` appends documents,
    ``mode='ignore'`` skips a table that already exists (A5)."""
    w = df.write.mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    if fmt == "csv":
        w = w.option("header", True).option("escape", '"')  # a quote in a value is doubled
    w.format(fmt).save(path)


def write_clustered(df: DataFrame, path: str, partition_by: list[str], cluster_by: list,
                    mode: str = "overwrite") -> None:
    """Partition-key directories, rows sorted by the clustering order inside files.

    ``repartitionByRange`` on the partition key keeps one key's rows in few files
    without routing a hot key to a single task (a range split may cut inside a key)."""
    keyed = df.repartitionByRange(*[F.col(c) for c in partition_by], *cluster_by)
    keyed.sortWithinPartitions(*[F.col(c) for c in partition_by], *cluster_by) \
        .write.mode(mode).partitionBy(*partition_by).parquet(path)


def flatten_for_text(df: DataFrame, sep: str = ", ") -> DataFrame:
    """Nested documents -> rectangular text columns: arrays joined with ``sep``,
    structs as JSON, missing values as empty strings."""
    cols = []
    for f in df.schema.fields:
        c = F.col(f.name)
        if isinstance(f.dataType, ArrayType) and not isinstance(f.dataType.elementType, StructType):
            c = F.array_join(c.cast("array<string>"), sep)
        elif isinstance(f.dataType, (ArrayType, StructType)):
            c = F.to_json(c)
        else:
            c = c.cast("string")
        cols.append(F.coalesce(c, F.lit("")).alias(f.name))
    return df.select(*cols)


def write_report(sections: dict[str, DataFrame], out_dir: str) -> dict[str, str]:
    """B2: one CSV directory per titled section.  Sections keep their own partitioning
    (a per-campaign or per-user section can be large, so nothing is forced into one
    task); AQE already merges the small partitions of aggregates and top-k results."""
    paths = {}
    for title, df in sections.items():
        safe = "".join(ch if ch.isalnum() else "_" for ch in title).strip("_").lower()
        path = f"{out_dir.rstrip('/')}/{safe}"
        write_table(flatten_for_text(df), path, fmt="csv")
        paths[title] = path
    return paths


def publish_tables(spark: SparkSession, tables: dict[str, DataFrame], root: str,
                   checks: dict | None = None,
                   layouts: dict[str, dict] | None = None, count_rows: bool = True,
                   views: set[str] | frozenset = frozenset(), inputs: str | None = None) -> dict[str, str]:
    """All-or-nothing multi-table load.

    Tables are written in order; a callable value is a later stage, called with the
    tables written so far (read back from Parquet), so no stage recomputes the lineage
    of an earlier one; a check is such a callable too, over the files written.  Names in
    ``views`` are handed to later stages as plans over written tables and not stored.
    Every table goes under a fresh version folder; the checks must all be empty; only then
    is the version's manifest (table -> path, rows) created (``count_rows=False``: rows
    NULL, no count job).  Readers take the newest manifest, so a failed load leaves the
    published version untouched; its own folder is deleted.  ``inputs`` (a fingerprint of
    what the tables were made from, ``versions.fingerprint``) is kept with the version.
    """
    before, _ = versions.newest(spark, root)
    folder = versions.fresh_folder("tables")
    version = versions.join(root, folder)
    layouts = layouts or {}
    rows = {}
    written: dict[str, DataFrame] = {}
    log = logging.getLogger("adspark.publish")
    try:
        for name, df in tables.items():
            t0 = time.time()
            if callable(df):  # a later stage, built from the tables already written
                df = df(written)
            if name in views:  # a plan over written tables, used by later stages but not stored
                written[name] = df
                continue
            lay = layouts.get(name, {})
            out = df
            if lay.get("range_by"):
                out = out.repartitionByRange(*[F.col(c) for c in lay["range_by"]])
            if lay.get("sort_by"):  # "-name" sorts descending
                out = out.sortWithinPartitions(*[F.desc(c[1:]) if c.startswith("-") else F.col(c)
                                                 for c in lay["sort_by"]])
            if lay.get("z_order"):
                write_ordered(out, f"{version}/{name}", lay["z_order"], bloom=lay.get("bloom"))
            else:
                write_table(out, f"{version}/{name}", partition_by=lay.get("partition_by"))
            written[name] = spark.read.parquet(f"{version}/{name}")
            rows[name] = {"path": f"{folder}/{name}", "rows": written[name].count() if count_rows else None}
            log.info("published %s (%s rows) in %.1fs", name, rows[name]["rows"], time.time() - t0)
        resolved = {k: (v(written) if callable(v) else v) for k, v in (checks or {}).items()}
        failed = {k: v for k, v in resolved.items() if not v.isEmpty()}
        if failed:
            raise ValueError(f"load rejected, violated checks: {sorted(failed)}")
        versions.commit(spark, root, {"tables": rows, "inputs": inputs}, before)
    except BaseException:
        versions.delete(spark, version)  # a failed load leaves nothing behind
        raise
    return {n: versions.join(root, r["path"]) for n, r in rows.items()}


def read_published(spark: SparkSession, root: str) -> dict[str, DataFrame]:
    """The tables of the last published version (B7 reader side)."""
    _, content = versions.newest(spark, root)
    if not content:
        raise FileNotFoundError(f"nothing has been published at {root}")
    return {n: spark.read.parquet(versions.join(root, r["path"])) for n, r in content["tables"].items()}


def manifest_counts(spark: SparkSession, root: str) -> DataFrame:
    """``table, rows`` of the last published version."""
    _, content = versions.newest(spark, root)
    return spark.createDataFrame([(n, r["rows"]) for n, r in content["tables"].items()], "table string, rows bigint")


def upsert_partitions(spark: SparkSession, path: str, batch: DataFrame, key: list[str], partition_col: str,
                      seq_col: str = "load_seq") -> None:
    """B4 on a plain partitioned Parquet folder: merge ``batch`` into it, last write wins
    per ``key``, rewriting only the partitions the batch touches (dynamic partition
    overwrite).  ``sources.keyed.upsert`` is the form for a large table: it finds moved keys
    by a locator, keeps any partition value and commits all partitions at once; here the key
    column of the whole folder is read, and partitions that a batch empties go after the
    others are written.

    Inside a batch the row with the largest ``seq_col`` wins; a batch without that column
    must not repeat a key.  A stored key that the batch moves to another partition leaves
    its old one, which is rewritten too.  Only an absent path counts as a first load: any
    failure to read an existing table rises and leaves it as it was.  Null is a partition
    and a key value like any other; an empty string as a partition value is null, as folder
    names cannot tell them apart.  Values are read with the batch's types, never inferred
    from folder names.  The merged rows are checkpointed before the overwrite, since the job
    reads the partitions it replaces."""
    from adspark.operators.keys import keep_one, sized_broadcast
    from adspark.operators.merge import upsert_latest
    from adspark.session import materialize

    if dict(batch.dtypes)[partition_col] == "string":
        batch = batch.withColumn(partition_col, F.when(F.col(partition_col) != "", F.col(partition_col)))
    if seq_col in batch.columns:
        batch = keep_one(batch, key, [seq_col], last=True).drop(seq_col)
    elif not batch.groupBy(*key).count().where("count > 1").isEmpty():
        raise ValueError(f"the batch repeats a key of {key} and has no {seq_col} to decide by")
    if not versions.path_exists(spark, path):
        batch.write.mode("errorifexists").partitionBy(partition_col).parquet(path)
        return
    missing = set(batch.columns) ^ set(spark.read.parquet(path).columns)
    if missing:
        raise ValueError(f"the batch and the table differ in {sorted(missing)}")
    existing = spark.read.schema(batch.schema).parquet(path)
    batch = materialize(batch)
    touched = batch.select(partition_col)
    if partition_col not in key:  # partitions that hold a key of the batch now
        touched = touched.union(same_rows(existing, batch, key, "left_semi").select(partition_col))
    touched = materialize(touched.distinct())  # one row per touched partition
    folder = F.regexp_replace("_metadata.file_path", "/[^/]*$", "").alias("folder")
    current = same_rows(existing.select(*batch.columns, folder), sized_broadcast(touched), [partition_col], "left_semi")
    folders = materialize(current.select(partition_col, "folder").distinct())
    merged = materialize(upsert_latest(current.drop("folder"), batch, key, seq_col))
    left = merged.select(partition_col).distinct()
    emptied = same_rows(folders, sized_broadcast(left), [partition_col], "left_anti").collect()  # a path each
    merged.write.mode("overwrite").option("partitionOverwriteMode", "dynamic") \
        .partitionBy(partition_col).parquet(path)
    for row in emptied:  # every key of the partition moved away: nothing was written over it
        # a file's path is a URI, its escapes those of a URI over those of the folder's name
        p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(spark.sparkContext._jvm.java.net.URI(row["folder"]))
        p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)
