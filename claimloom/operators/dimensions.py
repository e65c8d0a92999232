"""Dimension tables: dates, members, reference data, and providers with history."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from claimloom.config import Settings
from claimloom.functions import fields as x

MAX_DAYS = 400 * 366


def date_dim(spark: SparkSession, start: str = "2020-01-01", end: str = "2030-12-31") -> DataFrame:
    """One row per day. The range is limited, which is what allows broadcasting it."""
    days = (date.fromisoformat(end) - date.fromisoformat(start)).days + 1
    if not 0 < days <= MAX_DAYS:
        raise ValueError(f"date range of {days} days")
    first = F.lit(start).cast("date")
    day = spark.range(days).select(F.date_add(first, F.col("id").cast("int")).alias("date"))
    d = F.col("date")
    y, m = F.year(d), F.month(d)
    autumn = (m >= 10).cast("int")
    in_month = F.dayofmonth(F.last_day(d))
    return day.select(
        F.date_format(d, "yyyyMMdd").cast("int").alias("date_key"),
        d,
        y.alias("year"),
        F.quarter(d).alias("quarter"),
        m.alias("month"),
        F.date_format(d, "MMMM").alias("month_name"),
        F.dayofmonth(d).alias("day"),
        (F.weekday(d) + 1).alias("day_of_week"),
        F.date_format(d, "EEEE").alias("day_name"),
        (F.weekday(d) >= 5).alias("is_weekend"),
        F.lit(False).alias("is_holiday"),
        F.weekofyear(d).alias("week_of_year"),
        (y + autumn).alias("fiscal_year"),
        F.floor((m + 2) % 12 / 3 + 1).cast("int").alias("fiscal_quarter"),
        ((m + 2) % 12 + 1).alias("fiscal_month"),
        (y - y % 10).alias("decade"),
        F.floor(y / 100 + 1).cast("int").alias("century"),
        ((y % 4 == 0) & (y % 100 != 0) | (y % 400 == 0)).alias("is_leap_year"),
        in_month.alias("days_in_month"),
        (in_month - F.dayofmonth(d)).alias("days_remaining_in_month"),
        F.date_format(d, "yyyy-MM-dd").alias("date_format_iso"),
        F.date_format(d, "MM/dd/yyyy").alias("date_format_us"),
        F.date_format(d, "dd/MM/yyyy").alias("date_format_eu"),
        x.season(m).alias("season"),
    )


def month_dim(dates: DataFrame) -> DataFrame:
    """Month-grain attributes of the date dimension, one row per month."""
    return dates.select(
        "year",
        "quarter",
        "month",
        F.concat(F.lit("Q"), F.col("quarter")).alias("quarter_name"),
        "month_name",
        "season",
        "fiscal_year",
        "fiscal_quarter",
    ).distinct()


def member_dim(members: DataFrame, as_of: Column) -> DataFrame:
    age = x.years_between(F.col("dob"), as_of)
    start, end = x.validity(F.col("eligibility_start_date"), F.col("dob"), F.col("eligibility_end_date"))
    return members.select(
        x.surrogate_key(F.col("member_id"), start).alias("member_sk"),
        "*",
        x.full_name(F.col("member_first_name"), F.col("member_last_name")).alias("member_full_name"),
        age.alias("member_age"),
        x.age_group(age).alias("member_age_group"),
        x.eligible(F.col("eligibility_start_date"), F.col("eligibility_end_date"), as_of).alias("is_eligible"),
        start.alias("effective_start_date"),
        end.alias("effective_end_date"),
        F.lit(True).alias("is_current"),
    )


def one_per_key(df: DataFrame, key: str) -> DataFrame:
    """One deterministic row per key (the smallest by its other columns), folded before the shuffle."""
    rest = [c for c in df.columns if c != key]
    return df.groupBy(key).agg(F.min(F.struct(*rest)).alias("r")).select(key, "r.*")


def reference_dim(df: DataFrame, key: str, sk: str) -> DataFrame:
    unique = one_per_key(df.filter(F.col(key).isNotNull()), key)
    return unique.select(x.surrogate_key(F.col(key)).alias(sk), "*")


# -- providers -----------------------------------------------------------------------------------
TRACKED = ("provider_name", "specialty", "facility_name", "city", "state", "zip_code", "network_status")


def _version(df: DataFrame, key: str, tracked: Sequence[str], start: Column, end: Column) -> DataFrame:
    return df.withColumns({"effective_start_date": start, "effective_end_date": end}).withColumns(
        {
            "is_current": F.lit(True),
            "gold_row_hash": x.record_hash([F.col(c) for c in tracked]),
            "provider_sk": x.surrogate_key(F.col(key), F.col("effective_start_date")),
        }
    )


def first_load(incoming: DataFrame, as_of: Column, key: str = "provider_id", tracked=TRACKED) -> DataFrame:
    start = F.coalesce(F.col("effective_date"), as_of)
    end = F.coalesce(F.col("termination_date"), F.lit(x.OPEN_END).cast("date"))
    return _version(incoming, key, tracked, start, end)


def scd2(
    dim: DataFrame | None,
    incoming: DataFrame,
    as_of: Column,
    key: str = "provider_id",
    tracked: Sequence[str] = TRACKED,
) -> DataFrame:
    """Next state of a dimension with history: unchanged and vanished ids keep their current
    version, changed ids have it closed at ``as_of`` and get a new one, new ids get a first one.

    A change whose current version started on or after ``as_of`` would have an empty interval: the
    version is then replaced on the spot, so intervals never overlap when a day is run twice.
    """
    if dim is None:
        return first_load(incoming, as_of, key, tracked)
    old = dim.filter(~F.col("is_current"))
    cur = dim.filter("is_current")
    new = _version(incoming, key, tracked, as_of, F.lit(x.OPEN_END).cast("date")).select(*dim.columns)
    pair = cur.select(F.col(key).alias("__key"), F.struct(*dim.columns).alias("__cur")).join(
        new.select(F.col(key).alias("__new_key"), F.struct(*dim.columns).alias("__new")),
        F.col("__key") == F.col("__new_key"),
        "full",
    )
    has_cur, has_new = F.col("__cur").isNotNull(), F.col("__new").isNotNull()
    is_changed = has_cur & has_new & ~F.col("__cur.gold_row_hash").eqNullSafe(F.col("__new.gold_row_hash"))
    same_day = is_changed & (F.col("__cur.effective_start_date") >= as_of)
    closed = F.col("__cur").withField("is_current", F.lit(False)).withField("effective_end_date", as_of)
    fresh = F.when(
        same_day,
        F.col("__new")
        .withField("effective_start_date", F.col("__cur.effective_start_date"))
        .withField("provider_sk", F.col("__cur.provider_sk")),
    ).otherwise(F.col("__new"))
    first = F.coalesce(F.col("__new.effective_date"), as_of)
    opened = (
        F.col("__new")
        .withField("effective_start_date", first)
        .withField("provider_sk", x.surrogate_key(F.col("__new_key"), first))
    )
    versions = (
        F.when(same_day, F.array(fresh))
        .when(is_changed, F.array(closed, fresh))
        .when(has_cur, F.array(F.col("__cur")))
        .otherwise(F.array(opened))
    )
    return old.unionByName(pair.select(F.inline(versions)))


def provider_attributes(dim: DataFrame, cfg: Settings) -> DataFrame:
    return dim.withColumns(
        {
            "provider_region": x.region(F.col("state"), cfg.regions),
            "specialty_category": x.specialty_category(F.col("specialty"), cfg.specialties),
        }
    )
