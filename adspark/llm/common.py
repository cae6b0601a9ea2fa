"""Helpers shared by the operators: Arrow row maps, materialised steps, checked
broadcasts, sorted-run streaming and connected components."""

from __future__ import annotations

import gc
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType, _parse_datatype_string

from adspark.session import materialize, scratch_path

WS = " \t\n\x0b\x0c\r"  # what separates words in every operator: \x20 and \x09-\x0D
BROADCAST_ROWS = 100_000
BROADCAST_BYTES = 16 << 20
ARROW_ROWS = 1024  # of whole texts in a batch sent to a worker

__all__ = ["WS", "documents", "embeddings", "pages", "map_rows", "sorted_runs", "materialize", "fresh_path",
           "small_enough", "connected_components", "release", "sql_lit", "arrow_rows"]


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")


def embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/embeddings.parquet")


def pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/pages.parquet")


def fresh_path(spark: SparkSession, name: str) -> str:
    """A new folder under the shared checkpoint folder."""
    return scratch_path(spark, f"{name}-{uuid.uuid4().hex[:12]}")


def map_rows(df: DataFrame, fn: Callable[[dict[str, list]], dict[str, list]], schema: str,
             batch_rows: int = 512) -> DataFrame:
    """``mapInArrow`` over column lists: ``fn`` gets a batch as ``{column: values}`` and
    returns the output columns.  Batches are cut to ``batch_rows`` rows, so long texts do
    not pile up in a worker; a batch is the only state."""
    target = to_arrow_schema(_parse_datatype_string(schema))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, batch_rows):
                part = batch.slice(at, batch_rows)
                yield pa.RecordBatch.from_pydict(fn(part.to_pydict()), schema=target)

    return df.mapInArrow(run, schema)


def sorted_runs(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[list[dict]]:
    """Runs of rows with equal ``keys`` from batches that are sorted by them.  Only one
    run is held at a time; runs must be bounded by the caller's choice of key."""
    run: list[dict] = []
    last = None
    for batch in batches:
        for row in batch.to_pylist():
            key = tuple(row[k] for k in keys)
            if run and key != last:
                yield run
                run = []
            last = key
            run.append(row)
    if run:
        yield run


def arrow_schema(schema: str | StructType) -> pa.Schema:
    return to_arrow_schema(_parse_datatype_string(schema) if isinstance(schema, str) else schema)


def small_enough(df: DataFrame, width: Column, max_rows: int = BROADCAST_ROWS, max_bytes: int = BROADCAST_BYTES) -> bool:
    """True when a materialised ``df`` has at most ``max_rows`` rows and ``max_bytes``
    bytes (``width``: bytes of a row).  One aggregate over the stored rows."""
    n, size = df.agg(F.count(F.lit(1)), F.sum(width.cast("bigint"))).first()
    return n <= max_rows and (size or 0) <= max_bytes


@contextmanager
def arrow_rows(spark: SparkSession, rows: int = ARROW_ROWS) -> Iterator[None]:
    """Steps that run inside send at most ``rows`` rows at a time to the workers.  The default
    of 10,000 whole texts takes tens of MB outside the heap, twice while a batch grows."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    spark.conf.set(key, str(rows if int(before) <= 0 else min(rows, int(before))))
    try:
        yield
    finally:
        spark.conf.set(key, before)


def release(spark: SparkSession) -> None:
    """Lets Spark's cleaner remove the shuffle files and checkpoints that nothing refers to
    any more.  It acts when the driver collects garbage, which an idle driver may not do
    for half an hour; an iterative job would keep the files of every past round."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def sql_lit(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def connected_components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """``(node, root)`` for every node of ``edges (a, b)``; root = the component's
    smallest node.

    Alternating large-star and small-star steps: each round links every node to the
    smallest node it sees.  The per-node minimum is an aggregate with map-side combine, so
    a node with very many neighbours is not gathered anywhere; the join back on that node
    is an ordinary shuffle join, which AQE splits when it is skewed.  Each round is
    materialised in the shared folder and the files of the one before are released; the
    loop ends when a round changes no edge.
    """
    def one_round(e: DataFrame) -> DataFrame:
        both = e.union(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = (both.filter("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
                 .filter("a <> b"))
        down = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(down, "a").select("a", "b", "m")
        return materialize(small.filter("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
                           .union(down.select("a", F.col("m").alias("b"))).distinct())

    e = materialize(edges.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
                    .distinct())
    seen = None
    for _ in range(max_rounds):
        e = one_round(e)
        release(e.sparkSession)
        now = e.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if seen == tuple(now):
            break
        seen = tuple(now)
    else:
        raise RuntimeError("connected components did not settle")
    roots = e.select(F.col("b").alias("node")).distinct()
    return (e.select(F.col("a").alias("node"), F.col("b").alias("root"))
            .union(roots.select("node", F.col("node").alias("root"))).distinct())
