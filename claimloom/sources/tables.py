"""Parquet tables: appends, partition overwrites, and versions switched by a pointer."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def append(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    df.write.mode("append").partitionBy(*partition_by).parquet(path)


def read_merged(spark: SparkSession, path: str) -> DataFrame:
    """Table whose files may have different columns."""
    return spark.read.option("mergeSchema", True).parquet(path)


def overwrite_partitions(df: DataFrame, path: str, partition_by: Sequence[str], files_per_partition: int = 1) -> None:
    """Replace exactly the partitions that ``df`` has rows for; a re-run gives the same table.

    Rows are brought together by partition; a partition that is larger than the advisory size of adaptive execution is
    written by several tasks. ``files_per_partition`` spreads rows over that many hash groups instead.
    """
    if files_per_partition > 1:
        spread = F.pmod(F.xxhash64(*df.columns), F.lit(files_per_partition))
        df = df.repartition(*[F.col(c) for c in partition_by], spread)
    else:
        df = df.hint("rebalance", *partition_by)
    (
        df.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*partition_by)
        .parquet(path)
    )


def publish_version(df: DataFrame, path: str, version: int, partition_by: Sequence[str] = ()) -> None:
    """Write a whole new version beside the old one, then point to it. Readers of the old version
    are not disturbed, and a write that fails midway leaves the pointer as it was."""
    df.write.mode("overwrite").partitionBy(*partition_by).parquet(f"{path}/v={version:08d}")
    pointer = df.sparkSession.range(1).select(F.lit(version).cast("long").alias("version"))
    pointer.coalesce(1).write.mode("overwrite").parquet(f"{path}/current/{version:08d}")


def read_version(spark: SparkSession, path: str, version: int | None = None) -> DataFrame:
    """The version last pointed to, or the given one."""
    if version is None:
        row = spark.read.parquet(f"{path}/current/*").agg(F.max("version")).first()
        version = row[0]
    return spark.read.parquet(f"{path}/v={version:08d}")


def above_mark(df: DataFrame, column: str, mark) -> DataFrame:
    """Rows past the last high-water mark; a null mark means a first load. The literal comparison
    reaches the parquet scan."""
    return df if mark is None else df.filter(F.col(column) > F.lit(mark))


def high_water_mark(marks: DataFrame, table: str):
    """Last mark that the audit table holds for a table: one value."""
    return marks.filter(F.col("table_name") == table).agg(F.max("high_water_mark")).first()[0]
