from datetime import date

import pytest
from pyspark.sql import functions as F

from claimloom.config import Settings
from claimloom.operators import quality

CFG = Settings()
DAY = date(2026, 3, 20)
AS_OF = DAY.isoformat()
SCHEMA = """claim_id string, claim_line_id string, member_id string, provider_id string, diagnosis_code string,
    procedure_code string, claim_amount double, claim_status string, place_of_service string,
    service_date date, submission_date date"""
GOOD = dict(
    claim_id="C1", claim_line_id="L1", member_id="M1", provider_id="P1", diagnosis_code="J44.9", procedure_code="99213",
    claim_amount=100.0, claim_status="PAID", place_of_service="11", service_date=date(2026, 3, 1),
    submission_date=date(2026, 3, 2),
)


def claims(spark, *changes):
    rows = [tuple({**GOOD, **c}[n.split()[0]] for n in SCHEMA.replace("\n", " ").split(", ")) for c in changes]
    return spark.createDataFrame(rows, SCHEMA)


def rules():
    return quality.claim_rules(CFG, F.lit(AS_OF).cast("date"))


@pytest.mark.parametrize(
    "change, reason",
    [
        ({}, ""),
        ({"claim_id": None}, "Missing claim_id"),
        ({"claim_amount": -1.0}, "Amount below minimum"),
        ({"claim_amount": 100_000.01}, "Amount above maximum"),
        ({"claim_amount": 0.0}, ""),
        ({"claim_amount": 100_000.0}, ""),
        ({"claim_status": None}, ""),
        ({"claim_status": "VOID"}, "Invalid status"),
        ({"place_of_service": "00"}, "Invalid place of service"),
        ({"service_date": date(2026, 3, 21), "submission_date": date(2026, 3, 22)}, "Future service date"),
        ({"service_date": date(2026, 3, 3)}, "Invalid date order"),
        ({"diagnosis_code": "J44."}, "Invalid diagnosis code"),
        ({"procedure_code": "9921"}, "Invalid procedure code"),
        ({"claim_amount": 200_000.0, "claim_status": "VOID"}, "Amount above maximum, Invalid status"),
    ],
)
def test_claim_reasons(spark, change, reason):
    flagged = quality.flag(claims(spark, change), rules())
    assert flagged.first()[quality.REASONS] == reason


def test_split_is_complete_and_disjoint(spark):
    df = claims(spark, {}, {"claim_id": None}, {"claim_status": None}, {"claim_status": "VOID"}, {"service_date": None})
    clean, bad = quality.split(quality.flag(df, rules()))
    assert (clean.count(), bad.count()) == (3, 2)


def test_failure_counts_and_result(spark):
    df = claims(spark, {}, {"claim_amount": -1.0}, {"claim_amount": 200_000.0, "claim_id": None})
    counts = {r.rule_name: r.failed_count for r in quality.failure_counts(df, rules(), "t").collect()}
    assert counts["invalid_amounts"] == 2 and counts["null_claim_id"] == 1 and counts["invalid_statuses"] == 0
    row = quality.result_row(quality.flag(df, rules()), "t", "r", "run", F.lit(AS_OF)).first()
    assert (row.failed_count, row.total_count, round(row.pass_rate, 4)) == (2, 3, 33.3333)


def test_empty_input_is_refused(spark):
    with pytest.raises(ValueError):
        quality.require_rows(claims(spark, {}).filter("FALSE"), "claims")


def test_integrity_verdicts(spark):
    fact = spark.createDataFrame(
        [(1, 1, 20260301, 5.0, 5.0), (None, 1, 20260301, 5.0, 6.0)],
        "member_sk long, provider_sk long, service_date_key int, claim_amount double, paid_amount double",
    )
    members = spark.createDataFrame([("M1", 5), ("M2", 130)], "member_id string, member_age int")
    providers = spark.createDataFrame([("P1", True), ("P1", False)], "provider_id string, is_current boolean")
    got = {r.table_name: (r.faults, r.validation_status) for r in quality.integrity(fact, members, providers).collect()}
    assert got == {"fact_claims": (2, "FAIL"), "dim_member": (1, "FAIL"), "dim_provider": (0, "PASS")}
    twice = spark.createDataFrame([("P1", True), ("P1", True)], "provider_id string, is_current boolean")
    rows = quality.integrity(fact, members, twice).filter("table_name = 'dim_provider'").first()
    assert rows.validation_status == "FAIL"


def test_a_missing_table_gives_an_error_row(spark, tmp_path):
    gone = str(tmp_path / "gone")
    row = quality.integrity_or_error(spark, "fact_claims", lambda: spark.read.parquet(gone)).first()
    assert (row.table_name, row.validation_status) == ("fact_claims", "ERROR")
