import json
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from claimloom.config import Settings
from claimloom.operators import audit, kpis, marts
from claimloom.plans import catalog

CFG = Settings()


def now():
    return F.lit("2026-03-20 12:00:00").cast("timestamp")


def test_a_failing_step_is_recorded_and_raised(spark, tmp_path):
    path = str(tmp_path / "runs")
    with audit.recorded(spark, path, "r1", "load", "a", "b") as run:
        run.source_rows = 3
    with pytest.raises(ValueError):
        with audit.recorded(spark, path, "r2", "load", "a", "b"):
            raise ValueError("no rows")
    rows = {r.pipeline_run_id: r for r in spark.read.parquet(path).collect()}
    assert rows["r1"].status == "SUCCESS" and rows["r1"].source_row_count == 3
    assert rows["r2"].status == "FAILED" and "no rows" in rows["r2"].error_message
    assert rows["r2"].end_time >= rows["r2"].start_time


def test_health_without_data(spark):
    runs = spark.createDataFrame([], "success_rate double")
    quality = spark.createDataFrame([], "avg_pass_rate double")
    volume = spark.createDataFrame([], "data_volatility string")
    integrity = spark.createDataFrame([], "validation_status string")
    row = audit.health(runs, quality, volume, integrity).first()
    assert row.overall_health_score == pytest.approx(50.0) and row.health_grade == "F"


def test_volume_of_a_single_day_is_calm(spark):
    day = datetime(2026, 3, 20).date()
    counts = spark.createDataFrame([("t", day, 5)], "table_name string, run_date date, record_count long")
    row = audit.volume_metrics(counts, F.to_date(now())).first()
    assert row.stddev_records is None and row.data_volatility == "LOW"


def test_zero_rows_raise_an_alert(spark):
    days = [datetime(2026, 3, d).date() for d in (17, 18, 19)]
    counts = spark.createDataFrame(
        [("t", days[0], 100), ("t", days[1], 140), ("t", days[2], 0)], "table_name string, run_date date, record_count long"
    )
    got = {r.run_date: r.is_alert for r in audit.count_deviation(counts, CFG).collect()}
    assert [got[d] for d in days] == [False, False, True]


def test_report_is_json_with_advice(spark):
    row = catalog.queries()["o06_audit_report"](spark, "/root/testdata/sf0.001").first()
    report = json.loads(row.report)
    assert len(report["recommendations"]) == row.advice_count > 0
    assert report["figures"]["tables_validated"] == 3.0


def test_growth_skips_gaps_and_zero(spark):
    rows = [("g", "s", 2025, 1, 10, 1.0), ("g", "s", 2025, 2, 15, 2.0), ("g", "s", 2025, 4, 30, 3.0)]
    df = spark.createDataFrame(
        rows, "payer_type string, provider_specialty_category string, service_year int, service_quarter int, "
        "denied_claims_count long, denied_amount double",
    )
    got = {r.service_quarter: r for r in marts.denial_growth(df).collect()}
    assert got[1].qoq_denial_count_growth is None and got[2].qoq_denial_count_growth == 0.5
    assert got[4].prev_quarter_denials is None and got[2].denial_trend_category == "Growing Fast"
    months = spark.createDataFrame(
        [(datetime(2025, m, 1).date(), n) for m, n in ((1, 0), (2, 5), (4, 10))], "month date, total_claims long"
    )
    change = {r.month.month: r.mom for r in kpis.change_over(months, "total_claims", {"mom": 1}).collect()}
    assert change == {1: None, 2: None, 3: None, 4: None}


def test_providers_without_an_amount_keep_their_row(spark):
    totals = spark.createDataFrame([(1, 5.0), (2, None), (3, 7.0)], "provider_id long, total_amount double")
    ranks = {r.provider_id: r.provider_rank for r in kpis.dense_provider_rank(totals).collect()}
    shares = {r.provider_id: r.provider_percentile for r in kpis.provider_percentile(totals).collect()}
    assert ranks == {1: 2, 2: None, 3: 1} and shares == {1: 0.0, 2: None, 3: 0.5}
