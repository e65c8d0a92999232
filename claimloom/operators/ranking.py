"""Ranks and running totals over groups that do not fit one task.

A window sorts each of its groups in a single task, which fails once a group (or the whole table)
is large. Here the rows are range-sorted over all tasks, and written once with their slice number and the
running totals within the slice. What the group has in earlier slices comes from a small second table with one row per
slice and group, which is written too, so that Spark joins it by its real size. All ranks that follow the same
order share the sort, whatever their groups.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from claimloom.sources.scratch import written

_SLICE = "__slice"
_BEFORE = "__before"
_GROUP = "__group"


def with_row_numbers(df: DataFrame, ranks: Mapping[str, Sequence[str]], order: Sequence[Column]) -> DataFrame:
    """``row_number`` per group for each name in ``ranks``: one sort for all. ``order`` must end in a unique column.

    The sort follows ``order`` alone, so a slice holds rows of many groups and the counts have a row for each group of a
    slice: right for few large groups. ``with_row_number`` is for groups of any number and size."""
    return _running(df, {name: (by, F.lit(1)) for name, by in ranks.items()}, order)


def with_row_number(df: DataFrame, name: str, by: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """``row_number`` per group. Rows are sorted by group first, so that a group lies in as few slices as it can."""
    return _running(df, {name: (by, F.lit(1))}, order, lead=[F.col(c) for c in by])


def _group(by: Sequence[str]) -> Column:
    # A struct compares null keys as equal, so groups with null keys need no special join.
    return F.struct(*[F.col(c) for c in by]) if by else F.struct(F.lit(0).alias("all"))


def _running(
    df: DataFrame, totals: Mapping[str, tuple[Sequence[str], Column]], order: Sequence[Column], lead: Sequence[Column] = ()
) -> DataFrame:
    """For each name the sum of its amount over the row and those before it in its group."""
    rows = df.orderBy(*lead, *order).withColumn(_SLICE, F.spark_partition_id())
    # Every window below asks for the rows of a slice together: one exchange for all, a slice a task.
    rows = rows.repartitionById(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), F.col(_SLICE))
    for name, (by, amount) in totals.items():
        inside = Window.partitionBy(_SLICE, *by).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
        rows = rows.withColumn(name, F.sum(amount.cast("long")).over(inside))
    # The slice number is written with the rows: reading it again after a lost executor gives the same slices.
    rows = written(rows, "sorted")
    parts = None
    for name, (by, _) in totals.items():
        group = F.to_json(_group(by), {"ignoreNullFields": "false"})
        part = rows.groupBy(_SLICE, group.alias(_GROUP)).agg(F.max(name).alias("__n")).withColumn("__name", F.lit(name))
        parts = part if parts is None else parts.unionByName(part)
    earlier = Window.partitionBy("__name", _GROUP).orderBy(_SLICE).rowsBetween(Window.unboundedPreceding, -1)
    before = parts.withColumn(_BEFORE, F.sum("__n").over(earlier)).filter(F.col(_BEFORE) > 0)
    before = written(before.select("__name", _SLICE, _GROUP, _BEFORE), "earlier")
    for name, (by, _) in totals.items():
        mine = before.filter(F.col("__name") == name).drop("__name")
        rows = rows.withColumn(_GROUP, F.to_json(_group(by), {"ignoreNullFields": "false"})).join(mine, [_SLICE, _GROUP], "left")
        rows = rows.withColumn(name, F.col(name) + F.coalesce(_BEFORE, F.lit(0))).drop(_GROUP, _BEFORE)
    return rows.drop(_SLICE)


def value_ranks(df: DataFrame, value: str, *, descending: bool) -> DataFrame:
    """One row per distinct ``value`` over the whole table: ``dense_rank``, ``rank`` and how many
    rows hold the value. Ties are folded before the sort, so a value that a third of all rows share
    is one row here."""
    folded = df.groupBy(value).agg(F.count("*").alias("ties"))
    order = F.col(value).desc() if descending else F.col(value).asc()
    ranked = _running(folded, {"dense_rank": ([], F.lit(1)), "rank": ([], F.col("ties"))}, [order])
    return ranked.withColumn("rank", F.col("rank") - F.col("ties") + 1)


def percentiles(df: DataFrame, value: str, points: Sequence[float]) -> DataFrame:
    """Exact interpolated percentiles of a whole column, one row per point. Works from ranks of the
    distinct values instead of gathering the column in one aggregation buffer."""
    present = df.filter(F.col(value).isNotNull())
    ranked = value_ranks(present, value, descending=False)
    total = ranked.agg(F.sum("ties")).first()[0] or 0  # one number
    hits = []
    for point in points:
        place = point * (total - 1)
        low, high = math.floor(place), math.ceil(place)
        hits.append(
            F.struct(
                F.lit(float(point)).alias("percentile"),
                F.lit(place - low).alias("fraction"),
                _covers(low).alias("is_low"),
                _covers(high).alias("is_high"),
            )
        )
    spread = ranked.select(value, F.explode(F.filter(F.array(*hits), lambda h: h.is_low | h.is_high)).alias("h"))
    low_value = F.max(F.when(F.col("h.is_low"), F.col(value)))
    high_value = F.max(F.when(F.col("h.is_high"), F.col(value)))
    fraction = F.max("h.fraction")
    return spread.groupBy(F.col("h.percentile").alias("percentile")).agg(
        (low_value + (high_value - low_value) * fraction).alias("amount")
    )


def _covers(position: int) -> Column:
    first = F.col("rank") - 1
    return (first <= position) & (F.lit(position) < first + F.col("ties"))
