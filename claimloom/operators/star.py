"""Left lookups against keyed dimensions, joined only where a requested column needs them.

A left join on a unique key keeps every row, so leaving one out changes no other column. Catalyst
cannot drop such joins by itself because it does not know that the key is unique.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from claimloom.sources.sizes import fits_broadcast


@dataclass(frozen=True)
class Lookup:
    """``gives`` maps output names to columns of the dimension.

    ``source`` is the table whose rows the dimension has at most. Spark estimates a dimension that
    is itself a join at the product of its inputs; the size of the source decides instead whether
    the dimension is broadcast.
    """

    name: str
    on: str
    key: str
    gives: Mapping[str, str]
    frame: Callable[[], DataFrame]
    bounded: bool = False  # row count limited by construction, so broadcasting is safe
    source: Callable[[], DataFrame] | None = None


@dataclass(frozen=True)
class Derived:
    """A column computed from others."""

    needs: tuple[str, ...]
    value: Callable[[], Column]


def required(columns: Iterable[str], lookups: Sequence[Lookup], derived: Mapping[str, Derived]) -> set[str]:
    """All columns needed along the way to ``columns``."""
    found: set[str] = set()
    todo = list(columns)
    while todo:
        name = todo.pop()
        if name in found:
            continue
        found.add(name)
        if name in derived:
            todo.extend(derived[name].needs)
        todo.extend(lk.on for lk in lookups if name in lk.gives)
    return found


def star(
    base: DataFrame,
    lookups: Sequence[Lookup],
    derived: Mapping[str, Derived],
    columns: Sequence[str],
) -> DataFrame:
    """``columns`` of ``base`` widened by its lookups and derived columns.

    Joins are plain equi-joins: a side is broadcast when its size is known to be small, and
    sort-merged otherwise, where adaptive execution splits hot keys.
    """
    need = required(columns, lookups, derived)
    out = base
    for lk in lookups:
        wanted = [name for name in lk.gives if name in need]
        if not wanted:
            continue
        right_key = f"__{lk.name}"
        right = lk.frame().select(
            F.col(lk.key).alias(right_key), *[F.col(lk.gives[name]).alias(name) for name in wanted]
        )
        if lk.bounded or (lk.source is not None and fits_broadcast(lk.source())):
            right = F.broadcast(right)
        out = out.join(right, out[lk.on] == right[right_key], "left").drop(right_key)
    for name, column in derived.items():
        if name in need:
            out = out.withColumn(name, column.value())
    return out.select(*columns)
