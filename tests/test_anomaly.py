import random
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from claimloom.config import Settings
from claimloom.operators import anomaly

SCHEMA = """claim_id string, provider_id string, member_id string, diagnosis_code string, procedure_code string,
    claim_amount double, claim_status string, service_date date"""
START = date(2026, 1, 1)


def claim(number, *, provider="P", member="M", day=0, amount=10.0, status="PAID"):
    at = None if day is None else START + timedelta(days=day)
    return (f"C{number}", provider, member, "D", "X", amount, status, at)


def frame(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def flagged(df, flag):
    return sorted(r.claim_id for r in df.filter(flag).collect())


def test_duplicates_look_forward(spark):
    df = frame(spark, [claim(0, day=0), claim(1, day=1), claim(3, day=3)])
    keys = Settings().duplicate_keys
    assert flagged(anomaly.duplicates(df, keys, 1), "duplicate_flag") == ["C0"]
    assert flagged(anomaly.duplicates(df, keys, 1, both=True), "duplicate_flag") == ["C0", "C1"]


def test_claims_without_date_are_kept(spark):
    df = frame(spark, [claim(0, day=None), claim(1, day=None)])
    got = anomaly.detect(df, Settings())
    assert got.count() == 2 and flagged(got, "duplicate_flag") == []


def test_outliers(spark):
    rows = [claim(i, amount=20.0) for i in range(10)] + [claim(10, amount=100.0)]
    assert flagged(anomaly.outliers(frame(spark, rows), 3.0), "amount_outlier_flag") == ["C10"]


@pytest.mark.parametrize("denied, expected", [(3, 0), (4, 10)])
def test_high_denial(spark, denied, expected):
    rows = [claim(i, status="DENIED" if i < denied else "PAID") for i in range(10)]
    got = anomaly.high_denial(frame(spark, rows + [claim(99, provider=None)]), 0.3)
    assert len(flagged(got, "high_denial_provider_flag")) == expected and got.count() == 11


@pytest.mark.parametrize("count, expected", [(4, ["C0"]), (3, [])])
def test_frequent_procedures(spark, count, expected):
    rows = [claim(i, day=2 * i) for i in range(count)]
    got = anomaly.frequent(frame(spark, rows), ("member_id", "procedure_code"), 7, 3)
    assert flagged(got, "frequent_procedure_flag") == expected


def test_hot_key_matches_brute_force(spark):
    """A third of the claims share one key; flags equal a direct count."""
    rnd = random.Random(7)
    rows = [
        claim(i, provider="HOT" if i % 3 == 0 else f"P{rnd.randrange(8)}", member=f"M{rnd.randrange(3)}", day=rnd.randrange(200))
        for i in range(600)
    ]
    got = anomaly.duplicates(frame(spark, rows), ("provider_id", "member_id"), 5)
    expected = sorted(
        a[0]
        for a in rows
        if sum(1 for b in rows if a[1:3] == b[1:3] and 0 <= (b[7] - a[7]).days <= 5) > 1
    )
    assert flagged(got, "duplicate_flag") == expected and got.count() == 600


def test_scores_and_levels(spark):
    cfg = Settings()
    df = spark.createDataFrame([(50,), (49,), (25,), (24,)], "points int")
    levels = [r[0] for r in df.select(anomaly.risk_level(F.col("points"), cfg)).collect()]
    assert levels == ["HIGH", "MEDIUM", "MEDIUM", "LOW"]
    row = spark.createDataFrame(
        [(True, True, False, False, 6000.0)],
        "duplicate_flag boolean, amount_outlier_flag boolean, high_denial_provider_flag boolean, "
        "frequent_procedure_flag boolean, claim_amount double",
    )
    assert row.select(anomaly.score(cfg)).first()[0] == 65
