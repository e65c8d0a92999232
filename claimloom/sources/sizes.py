"""Size checks before a broadcast."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

_UNITS = {"": 1, "b": 1, "k": 1 << 10, "kb": 1 << 10, "m": 1 << 20, "mb": 1 << 20, "g": 1 << 30, "gb": 1 << 30}


def broadcast_limit(spark: SparkSession) -> int:
    """The session's own limit in bytes; zero when broadcasting is switched off."""
    text = spark.conf.get("spark.sql.autoBroadcastJoinThreshold", "10485760").strip().lower()
    number, unit = re.fullmatch(r"(-?\d+)\s*([a-z]*)", text).groups()
    return max(0, int(number) * _UNITS[unit])


def estimated_bytes(df: DataFrame) -> int:
    """Optimizer's size of a frame; for a file scan that is the size of the files."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def fits_broadcast(df: DataFrame) -> bool:
    return estimated_bytes(df) <= broadcast_limit(df.sparkSession)
