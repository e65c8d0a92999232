from datetime import date

import pytest
from pyspark.sql import functions as F

from claimloom import schemas
from claimloom.config import PLACES_OF_SERVICE, Settings
from claimloom.functions import exact
from claimloom.functions import fields as x
from claimloom.operators import dimensions


def values(df, column):
    return [r[column] for r in df.collect()]


def test_age_bands(spark):
    ages = [17, 18, 34, 35, 49, 50, 64, 65, None]
    df = spark.createDataFrame([(a,) for a in ages], "age int").select(x.age_group(F.col("age")).alias("g"))
    expected = ["Minor", "Adult 18-34", "Adult 18-34", "Adult 35-49", "Adult 35-49"]
    assert values(df, "g") == expected + ["Adult 50-64", "Adult 50-64", "Senior 65+", None]


def test_age_counts_whole_years(spark):
    rows = [(date(1985, 4, 15),), (date(1985, 4, 16),), (date(2000, 2, 29),), (None,)]
    as_of = F.lit("2026-04-15").cast("date")
    df = spark.createDataFrame(rows, "dob date").select(x.years_between(F.col("dob"), as_of).alias("a"))
    assert values(df, "a") == [41, 40, 26, None]


def test_code_formats(spark):
    cfg = Settings()
    rows = [("J44.9", True), ("I10", True), ("J45.909", True), ("J4", False), ("j44.9", False), ("J44.", False), (None, True)]
    df = spark.createDataFrame(rows, "code string, ok boolean")
    assert df.filter(x.matches(F.col("code"), cfg.icd_pattern) != F.col("ok")).count() == 0
    rows = [("99213", True), ("9921", False), ("992133", False)]
    df = spark.createDataFrame(rows, "code string, ok boolean")
    assert df.filter(x.matches(F.col("code"), cfg.cpt_pattern) != F.col("ok")).count() == 0


def test_places_of_service():
    assert len(PLACES_OF_SERVICE) == 65
    assert "99" in PLACES_OF_SERVICE and "00" not in PLACES_OF_SERVICE


def test_hash_keeps_the_place_of_nulls(spark):
    df = spark.createDataFrame([("a", None, "b"), ("a", "b", None), ("a", "", "b")], "p string, q string, r string")
    hashed = df.select(x.record_hash([F.col(c) for c in "pqr"]).alias("h"))
    assert len(set(values(hashed, "h"))) == 3


def test_surrogate_keys_are_stable_and_unique(spark):
    df = spark.range(20_000).select(x.surrogate_key(F.col("id")).alias("k"))
    assert df.distinct().count() == 20_000
    again = spark.range(20_000).repartition(5).select(x.surrogate_key(F.col("id")).alias("k"))
    assert again.join(df, "k", "left_anti").count() == 0
    none = spark.range(1).select(x.surrogate_key(F.lit(None).cast("string")).alias("k"))
    assert values(none, "k") == [None]


def test_bad_dates_become_null(spark):
    df = spark.createDataFrame([("2026-02-28",), ("2026-02-30",), ("soon",), (None,)], "d string")
    assert values(df.select(x.as_date(F.col("d")).alias("d")), "d") == [date(2026, 2, 28), None, None, None]


def test_ratios_do_not_divide_by_zero(spark):
    df = spark.createDataFrame([(1, 0), (0, 0), (1, 4), (None, 2)], "a int, b int")
    assert values(df.select(exact.ratio("a", "b").alias("r")), "r") == [None, None, 0.25, None]


def test_money_sum_is_exact(spark):
    df = spark.range(1000).select(F.lit(0.1).alias("m"))
    assert df.agg(exact.money_sum("m").alias("s")).first()["s"] == 100.0


def test_stddev_of_one_row_is_null(spark):
    assert spark.range(1).agg(exact.count_stddev("id").alias("s")).first()["s"] is None
    assert spark.createDataFrame([(2,), (4,)], "n long").agg(exact.count_stddev("n").alias("s")).first()["s"] == 2**0.5


def test_region_and_specialty_take_the_first_match(spark):
    cfg = Settings()
    df = spark.createDataFrame([("AZ", "General Surgery"), ("FL", "Heart surgery"), ("TX", None)], "s string, t string")
    got = df.select(x.region(F.col("s"), cfg.regions), x.specialty_category(F.col("t"), cfg.specialties)).collect()
    assert [tuple(r) for r in got] == [("West", "Primary Care"), ("Other", "Cardiology"), ("Central", "Other")]


def test_date_dimension(spark):
    df = dimensions.date_dim(spark)
    assert df.count() == 4018 and df.select("date_key").distinct().count() == 4018
    rows = {r["date"]: r for r in df.filter("date IN ('2024-10-01', '2025-01-01', '2024-12-30', '2024-02-29')").collect()}
    october, january = rows[date(2024, 10, 1)], rows[date(2025, 1, 1)]
    assert (october.fiscal_year, october.fiscal_quarter, october.fiscal_month) == (2025, 1, 1)
    assert (january.fiscal_year, january.fiscal_quarter, january.fiscal_month) == (2025, 2, 4)
    assert rows[date(2024, 12, 30)].week_of_year == 1 and rows[date(2024, 12, 30)].day_of_week == 1
    leap = rows[date(2024, 2, 29)]
    assert leap.is_leap_year and leap.days_in_month == 29 and leap.days_remaining_in_month == 0
    assert leap.date_format_eu == "29/02/2024" and leap.century == 21 and leap.season == "Winter"
    with pytest.raises(ValueError):
        dimensions.date_dim(spark, "0001-01-01", "2030-12-31")


def test_unknown_schema():
    with pytest.raises(KeyError):
        schemas.schema("visits")


def test_event_schema(spark):
    assert "additional_data" in schemas.schema("claim_status_events", streaming=True).names
    assert "additional_data" not in schemas.schema("claim_status_events").names


def test_separators_do_not_mix_up_keys(spark):
    rows = spark.createDataFrame([("a|b", "c"), ("a", "b|c"), ("a\\", "|b"), ("a", "\\|b"), ("a\\|", "b")], "x string, y string")
    both = [F.col("x"), F.col("y")]
    keys = rows.select(x.surrogate_key(*both).alias("k"), x.record_hash(both).alias("h")).collect()
    assert len({r.k for r in keys}) == 5 and len({r.h for r in keys}) == 5
