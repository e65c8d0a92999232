"""The shared folder for intermediate tables, and lineage cuts that survive lost executors."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def root(spark: SparkSession) -> str:
    """Folder named by ``spark.checkpoint.dir``; in local mode one is made when it is unset."""
    context = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if named is None:
        if not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        named = tempfile.mkdtemp(prefix="claimloom-")
        context.setCheckpointDir(named)
    return named.rstrip("/")


def fresh(spark: SparkSession, label: str) -> str:
    """A new, unused path below the shared folder."""
    return f"{root(spark)}/{label}-{uuid.uuid4().hex[:12]}"


def written(df: DataFrame, label: str) -> DataFrame:
    """``df`` written once as a parquet table and read back. For a frame that several branches of a
    query use: each branch then scans the columns it needs instead of repeating the joins."""
    path = fresh(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def cut(df: DataFrame) -> DataFrame:
    """Write ``df`` to the checkpoint folder once and go on from the files."""
    spark = df.sparkSession
    folder = root(spark)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(folder)
    return df.checkpoint(eager=True)
