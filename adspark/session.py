"""Session settings and lineage cutting.

The reference treats naive timestamps as UTC, so the session time zone is UTC.  ANSI
mode stays on: every lenient parse in ``functions.parsing`` uses ``try_*`` forms.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import DataFrame, SparkSession

DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",  # a checkpoint goes with its last reader
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app_name: str = "adspark", extra: dict | None = None) -> SparkSession:
    """Build (or reuse) a session with the settings the library relies on."""
    b = SparkSession.builder.appName(app_name)
    if master:
        b = b.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder for checkpoints and intermediate tables.

    Taken from ``spark.checkpoint.dir`` (or the context's checkpoint dir).  Only a
    local-mode session without one gets a private temporary folder, as in tests; on a
    cluster the setting is required, since a machine-local folder would be lost with
    its executor.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if not configured:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a shared folder (HDFS / object store)")
        configured = tempfile.mkdtemp(prefix="adspark-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def scratch_path(spark: SparkSession, name: str) -> str:
    """A path under the shared checkpoint folder for a written intermediate table."""
    root = checkpoint_root(spark)
    return os.path.join(root, "tables", name) if "://" not in root else root.rstrip("/") + "/tables/" + name


def materialize(df: DataFrame) -> DataFrame:
    """Cut lineage with a reliable checkpoint in the shared folder.

    Used where a plan is read twice and must give the same rows both times (dense ids)
    and for small dimensions that many later joins reuse.  A reliable checkpoint
    survives executor loss; ``localCheckpoint`` would not.
    """
    checkpoint_root(df.sparkSession)
    return df.checkpoint(eager=True)
