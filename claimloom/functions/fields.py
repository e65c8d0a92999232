"""Scalar expressions: cleaning, ages, labels, flags and dates."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from claimloom.config import OTHER

OPEN_END = "9999-12-31"
NULL_MARK = "\u0000"


def ladder(steps: Iterable[tuple[Column, str]], otherwise: Column | None = None) -> Column:
    """First label whose condition holds."""
    steps = list(steps)
    chain = F.when(steps[0][0], F.lit(steps[0][1]))
    for condition, label in steps[1:]:
        chain = chain.when(condition, F.lit(label))
    return chain if otherwise is None else chain.otherwise(otherwise)


# -- cleaning ---------------------------------------------------------------------------------
def code(name: str) -> Column:
    return F.upper(F.trim(F.col(name))).alias(name)


def as_date(c: Column, pattern: str = "yyyy-MM-dd") -> Column:
    """Date of a text; text that is no date becomes null, also under ANSI."""
    return F.to_date(F.try_to_timestamp(c, F.lit(pattern)))


def matches(c: Column, pattern: str) -> Column:
    """Format check on non-null values; null passes."""
    return F.coalesce(c.cast("string").rlike(pattern), F.lit(True))


def _part(c: Column) -> Column:
    """A text whose separators are escaped, so that joined parts cannot be confused."""
    return F.replace(F.replace(c.cast("string"), F.lit("\\"), F.lit("\\\\")), F.lit("|"), F.lit("\\|"))


def record_hash(columns: Sequence[Column]) -> Column:
    """md5 over all columns; nulls keep their place."""
    parts = [F.coalesce(_part(c), F.lit(NULL_MARK)) for c in columns]
    return F.md5(F.concat_ws("|", *parts))


def surrogate_key(*parts: Column) -> Column:
    """Stable 64-bit key of the business key: the first half of its md5, signed."""
    digest = F.md5(F.concat_ws("|", *[_part(p) for p in parts]))
    key = F.conv(F.substring(digest, 1, 16), 16, -10).cast("long")
    return F.when(reduce(lambda a, b: a & b, [p.isNotNull() for p in parts]), key)


def reasons(labelled: Iterable[tuple[Column, str]]) -> Column:
    """Comma-joined labels of the conditions that hold."""
    return F.concat_ws(", ", *[F.when(condition, F.lit(label)) for condition, label in labelled])


# -- people and providers ----------------------------------------------------------------------
def years_between(start: Column, as_of: Column) -> Column:
    return F.floor(F.months_between(as_of, start) / 12).cast("int")


def age_group(age: Column) -> Column:
    return ladder(
        [
            (age < 18, "Minor"),
            (age < 35, "Adult 18-34"),
            (age < 50, "Adult 35-49"),
            (age < 65, "Adult 50-64"),
            (age >= 65, "Senior 65+"),
        ]
    )


def full_name(first: Column, last: Column) -> Column:
    return F.concat_ws(" ", first, last)


def eligible(start: Column, end: Column, as_of: Column) -> Column:
    return F.coalesce((start <= as_of) & (end.isNull() | (end >= as_of)), F.lit(False))


def validity(start: Column, fallback: Column, end: Column) -> tuple[Column, Column]:
    return F.coalesce(start, fallback), F.coalesce(end, F.lit(OPEN_END).cast("date"))


def region(state: Column, mapping) -> Column:
    return ladder(((state.isin(list(states)), name) for name, states in mapping), F.lit(OTHER))


def specialty_category(specialty: Column, mapping) -> Column:
    return ladder(((specialty.rlike(p), name) for name, p in mapping), F.lit(OTHER))


def active(end: Column, as_of: Column) -> Column:
    return end.isNull() | (end > as_of)


# -- bands -------------------------------------------------------------------------------------
# The band limits and labels below are part of the published marts.
def volume_band(total: Column) -> Column:
    return ladder(
        [(total >= 1_000_000, "High Volume"), (total >= 100_000, "Medium Volume")],
        F.lit("Low Volume"),
    )


def denial_band(rate: Column) -> Column:
    return ladder(
        [(rate <= 0.05, "Excellent"), (rate <= 0.10, "Good"), (rate <= 0.20, "Average")],
        F.lit("Poor"),
    )


def value_band(avg: Column) -> Column:
    return ladder([(avg >= 500, "High Value"), (avg >= 200, "Medium Value")], F.lit("Low Value"))


def denial_volume_band(count: Column) -> Column:
    return ladder(
        [(count >= 100, "High Volume Denials"), (count >= 50, "Medium Volume Denials")],
        F.lit("Low Volume Denials"),
    )


def denial_rate_band(rate: Column) -> Column:
    return ladder(
        [(rate >= 0.20, "High Denial Rate"), (rate >= 0.10, "Medium Denial Rate")],
        F.lit("Low Denial Rate"),
    )


def denial_value_band(avg: Column) -> Column:
    return ladder(
        [(avg >= 1000, "High Value Denials"), (avg >= 500, "Medium Value Denials")],
        F.lit("Low Value Denials"),
    )


def trend_band(growth: Column) -> Column:
    return ladder(
        [
            (growth >= 0.10, "Growing Fast"),
            (growth >= 0.05, "Growing Moderate"),
            (growth <= -0.10, "Declining Fast"),
            (growth <= -0.05, "Declining Moderate"),
        ],
        F.lit("Stable"),
    )


def traffic_light(denial_pct: Column) -> Column:
    return ladder([(denial_pct > 15, "red"), (denial_pct >= 10, "yellow")], F.lit("green"))


# -- dates -------------------------------------------------------------------------------------
def month_start(year: Column, month: Column) -> Column:
    return F.make_date(year, month, F.lit(1))


def since_months(date: Column, as_of: Column, months: int) -> Column:
    """Rows of the last ``months`` months. ``as_of`` is a literal, so the bound folds to a constant."""
    return date >= F.add_months(as_of, -months)


def season(month: Column) -> Column:
    return ladder(
        [
            (month.isin(12, 1, 2), "Winter"),
            (month.isin(3, 4, 5), "Spring"),
            (month.isin(6, 7, 8), "Summer"),
        ],
        F.lit("Fall"),
    )


def delay_days(service: Column, submission: Column) -> Column:
    return F.datediff(submission, service)


def seconds_between(start: Column, end: Column) -> Column:
    return F.unix_timestamp(end) - F.unix_timestamp(start)
