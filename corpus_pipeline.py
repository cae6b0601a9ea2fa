"""The corpus pipeline: documents -> language ID -> line dedup -> near duplicates -> secrets
-> packed sequences.

Every stage takes ``(spark, docs, sf_dir)``; its result is written as Parquet in the shared
checkpoint folder and read again as the next stage's ``docs``, so a lost executor costs the
stage at hand only.  All but the last return the columns of ``docs``.

Cases: see the operators.  Documents without a letter (null and empty texts among them) go
in the first stage, as their language is unknown; an empty table stays empty.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from adspark.llm import langid, linededup, neardup, packing, secrets
from adspark.llm.common import documents, fresh_path
from adspark.llm.queries import BYTE_VOCAB

ORACLE_SQL = None  # classifier, hashing models and tokenizer have no SQL form; tests compare with brute force


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language the classifier accepts."""
    return langid.accepted(docs, langid.fit(docs))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Boilerplate lines of a site leave its documents; ``n_chars`` follows."""
    return linededup.drop_site_lines(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of copies and near copies stays."""
    return neardup.keep_one_of_each(docs)


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are replaced by a mark; ``n_chars`` follows."""
    return secrets.redact(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The packed pieces of what is left."""
    return packing.best_fit_packing(docs, BYTE_VOCAB)


STAGES = [("language_id", language_id), ("line_dedup", line_dedup), ("near_duplicates", near_duplicates),
          ("secret_scan", secret_scan), ("packing", pack)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``."""
    docs = documents(spark, sf_dir)
    for name, stage in STAGES:
        path = fresh_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
