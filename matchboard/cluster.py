"""Shared storage and size checks: the few places that look at the running cluster."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def shared_root(spark: SparkSession) -> str:
    """Folder every executor can reach, as named by ``spark.checkpoint.dir``.

    Only a local session may leave it open; it gets a private folder. On a cluster that would be a folder
    of one machine, so it is an error there.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        root = spark.sparkContext.getCheckpointDir()
    if not root:
        master = spark.conf.get("spark.master", "local")
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        root = tempfile.mkdtemp(prefix="matchboard-")
        spark.sparkContext.setCheckpointDir(root)
    return root


def new_folder(spark: SparkSession, label: str) -> str:
    """A folder name below the shared root that nobody used before."""
    return f"{shared_root(spark).rstrip('/')}/matchboard/{label}-{uuid.uuid4().hex}"


def cut_lineage(df: DataFrame) -> DataFrame:
    """Write ``df`` to the checkpoint folder and go on from there; survives lost executors."""
    spark = df.sparkSession
    root = shared_root(spark)
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(root)
    return df.checkpoint(eager=True)


def fits(df: DataFrame, max_rows: int) -> bool:
    """True when ``df`` has at most ``max_rows`` rows.

    Spark looks for a row past the first ``max_rows`` partition by partition and stops when it has one,
    so a large table costs no more than its first few files.
    """
    return not df.select(F.lit(1)).offset(max_rows).head(1)


def broadcast_if_small(df: DataFrame, max_rows: int = 200_000) -> DataFrame:
    """Broadcast hint behind a row check; a larger frame is returned without a hint."""
    return F.broadcast(df) if fits(df, max_rows) else df
