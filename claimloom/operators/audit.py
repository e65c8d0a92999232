"""Run records, health metrics, alerts and the audit report. Nothing is collected: every metric
stays a DataFrame, and single-row inputs meet through a union, not a cross join."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from claimloom.config import Settings
from claimloom.functions import fields as x
from claimloom.functions.exact import count_stddev, percent, rate_avg, ratio
from claimloom.operators.quality import grade
from claimloom.sources import tables

RUN_SCHEMA = """pipeline_run_id string, pipeline_name string, source_system string,
    target_table string, start_time timestamp, end_time timestamp, status string,
    source_row_count long, target_row_count long, validation_results string, error_message string"""


class Run:
    """Counts and checks that a step reports while it runs."""

    def __init__(self) -> None:
        self.source_rows: int | None = None
        self.target_rows: int | None = None
        self.validation: str | None = None


@contextmanager
def recorded(
    spark: SparkSession, path: str, run_id: str, name: str, source: str, target: str
) -> Iterator[Run]:
    """Appends one run row with start, end and outcome; a failing step is recorded and raised."""
    run, start, error = Run(), datetime.now(timezone.utc), None
    try:
        yield run
    except Exception as problem:
        error = f"{type(problem).__name__}: {problem}"
        raise
    finally:
        row = (
            run_id, name, source, target, start, datetime.now(timezone.utc),
            "FAILED" if error else "SUCCESS", run.source_rows, run.target_rows, run.validation, error,
        )
        tables.append(spark.createDataFrame([row], RUN_SCHEMA), path, ["pipeline_name"])


def _since(df: DataFrame, column: str, as_of: Column, interval: str) -> DataFrame:
    return df.filter((F.col(column) >= as_of - F.expr(f"INTERVAL {interval}")) & (F.col(column) <= as_of))


def _is(status: str) -> Column:
    return F.col("status") == status


def run_metrics(runs: DataFrame, as_of: Column, hours: int = 24) -> DataFrame:
    seconds = x.seconds_between(F.col("start_time"), F.col("end_time"))
    totals = (
        _since(runs, "start_time", as_of, f"{hours} HOURS")
        .groupBy("pipeline_name")
        .agg(
            F.count("*").alias("total_runs"),
            F.count_if(_is("SUCCESS")).alias("successful_runs"),
            F.count_if(_is("FAILED")).alias("failed_runs"),
            F.avg(F.when(_is("SUCCESS"), seconds)).alias("avg_success_duration_seconds"),
            F.max("start_time").alias("last_run_time"),
            F.min("start_time").alias("first_run_time"),
        )
    )
    return totals.withColumns(
        {
            "success_rate": percent("successful_runs", "total_runs"),
            "failure_rate": percent("failed_runs", "total_runs"),
        }
    )


def row_count(df: DataFrame, table: str, day: Column) -> DataFrame:
    """The row-count record of a table for one day."""
    return df.agg(F.count("*").alias("record_count")).select(
        F.lit(table).alias("table_name"), day.alias("run_date"), "record_count"
    )


def volume_metrics(row_counts: DataFrame, as_of: Column, days: int = 7) -> DataFrame:
    day = F.col("run_date")
    totals = (
        row_counts.filter((day >= F.date_sub(as_of, days)) & (day <= as_of))
        .groupBy("table_name")
        .agg(
            F.avg("record_count").alias("avg_daily_records"),
            F.max("record_count").alias("max_daily_records"),
            F.min("record_count").alias("min_daily_records"),
            count_stddev("record_count").alias("stddev_records"),
            F.count("*").alias("days_with_data"),
            F.sum("record_count").alias("total_records_7_days"),
        )
    )
    variation = F.col("coefficient_of_variation")
    return totals.withColumn(
        "coefficient_of_variation", ratio("stddev_records", "avg_daily_records")
    ).withColumn(
        "data_volatility", x.ladder([(variation > 0.5, "HIGH"), (variation > 0.2, "MEDIUM")], F.lit("LOW"))
    )


def count_deviation(row_counts: DataFrame, cfg: Settings) -> DataFrame:
    """Deviation of a day's rows from the average of the table's earlier days."""
    before = Window.partitionBy("table_name").orderBy("run_date").rowsBetween(Window.unboundedPreceding, -1)
    n = F.col("record_count")
    average = F.avg("record_count").over(before)
    out = row_counts.select("table_name", "run_date", "record_count", average.alias("avg_before"))
    deviation = ratio(F.abs(n - F.col("avg_before")) * 100, "avg_before")
    out = out.withColumn("deviation_pct", deviation)
    alert = (F.col("deviation_pct") > cfg.alert_deviation) | (n == 0)
    return out.withColumn("is_alert", F.coalesce(alert, F.lit(False)))


def quality_metrics(results: DataFrame, as_of: Column, hours: int = 24) -> DataFrame:
    totals = (
        _since(results, "run_timestamp", as_of, f"{hours} HOURS")
        .groupBy("table_name")
        .agg(
            F.count("*").alias("total_quality_checks"),
            F.count_if(_is("SUCCESS")).alias("successful_checks"),
            F.count_if(_is("FAILED")).alias("failed_checks"),
            rate_avg("pass_rate").alias("avg_pass_rate"),
            F.min("pass_rate").alias("min_pass_rate"),
            F.max("failed_count").alias("max_failures"),
            F.avg("failed_count").alias("avg_failures"),
            F.max("run_timestamp").alias("last_check_time"),
        )
    )
    return totals.withColumn("quality_grade", grade(F.col("avg_pass_rate")))


def quality_by_rule(results: DataFrame, as_of: Column, days: int = 7) -> DataFrame:
    return (
        _since(results, "run_timestamp", as_of, f"{days} DAYS")
        .groupBy("table_name", "rule_name")
        .agg(
            rate_avg("pass_rate").alias("avg_pass_rate"),
            F.sum("failed_count").alias("total_failures"),
            F.max("run_timestamp").alias("last_check_time"),
        )
    )


def quality_alerts(results: DataFrame, as_of: Column, cfg: Settings) -> DataFrame:
    per_table = (
        _since(results, "run_timestamp", as_of, f"{cfg.report_hours} HOURS")
        .groupBy("table_name")
        .agg(rate_avg("pass_rate").alias("avg_pass_rate"), F.sum("failed_count").alias("total_failures"))
    )
    return per_table.filter(
        (F.col("avg_pass_rate") < cfg.alert_pass_rate) | (F.col("total_failures") > cfg.alert_failures)
    )


def run_alerts(runs: DataFrame, as_of: Column, cfg: Settings) -> DataFrame:
    minutes = x.seconds_between(F.col("start_time"), F.col("end_time")) / 60
    per_pipeline = (
        _since(runs, "start_time", as_of, f"{cfg.report_hours} HOURS")
        .groupBy("pipeline_name")
        .agg(F.count_if(_is("FAILED")).alias("failed_runs"), rate_avg(minutes).alias("avg_duration_minutes"))
    )
    return per_pipeline.filter(
        (F.col("failed_runs") > 0) | (F.col("avg_duration_minutes") > cfg.alert_minutes)
    )


def stalled_streams(monitoring: DataFrame, as_of: Column, cfg: Settings) -> DataFrame:
    old = F.col("last_event_time") < as_of - F.expr(f"INTERVAL {cfg.stalled_minutes} MINUTES")
    return monitoring.filter(F.coalesce(old, F.lit(True)) | ~F.col("is_active"))


# -- health --------------------------------------------------------------------------------------
# Component weights, the score when a component has no data, and grade limits.
WEIGHTS = {
    "pipeline_health": 0.4,
    "data_quality_health": 0.3,
    "volume_stability_health": 0.2,
    "gold_integrity_health": 0.1,
}
NO_DATA = 0.5


def _component(name: str, df: DataFrame, value: Column) -> DataFrame:
    return df.agg(value.cast("double").alias("score")).select(F.lit(name).alias("component"), "score")


def health(runs: DataFrame, quality: DataFrame, volume: DataFrame, integrity: DataFrame) -> DataFrame:
    """Weighted score of four components, in percent, with a grade: one row."""
    unrest = x.ladder([(F.col("data_volatility") == "LOW", "0"), (F.col("data_volatility") == "MEDIUM", "0.5")],
                      F.lit("1")).cast("double")
    one = F.lit(1.0)

    def share(rate: str) -> Column:
        mean = rate_avg(rate) / 100
        return F.when(mean > 1, one).otherwise(mean)  # ``least`` would turn no data into 1

    parts = _component("pipeline_health", runs, share("success_rate"))
    parts = parts.unionByName(_component("data_quality_health", quality, share("avg_pass_rate")))
    parts = parts.unionByName(_component("volume_stability_health", volume, one - rate_avg(unrest)))
    passed = ratio(F.count_if(F.col("validation_status") == "PASS"), F.count("*"))
    parts = parts.unionByName(_component("gold_integrity_health", integrity, passed))
    scores = parts.agg(
        *[
            F.coalesce(F.max(F.when(F.col("component") == name, F.col("score"))), F.lit(NO_DATA)).alias(name)
            for name in WEIGHTS
        ]
    )
    overall = None
    for name, weight in WEIGHTS.items():
        term = F.col(name) * weight
        overall = term if overall is None else overall + term
    o = F.col("overall")
    letter = x.ladder([(o >= 0.9, "A"), (o >= 0.8, "B"), (o >= 0.7, "C"), (o >= 0.6, "D")], F.lit("F"))
    return scores.withColumn("overall", overall).select(
        (o * 100).alias("overall_health_score"),
        letter.alias("health_grade"),
        *[(F.col(name) * 100).alias(name) for name in WEIGHTS],
    )


def report_figures(
    health_row: DataFrame, runs: DataFrame, quality: DataFrame, volume: DataFrame, integrity: DataFrame
) -> DataFrame:
    """All figures of the audit report in one row."""
    sums = {
        "overall_score": (health_row, F.max("overall_health_score")),
        "pipeline_types": (runs, F.count("*")),
        "avg_success_rate": (runs, rate_avg("success_rate")),
        "failed_runs": (runs, F.sum("failed_runs")),
        "tables_monitored": (quality, F.count("*")),
        "avg_quality_score": (quality, rate_avg("avg_pass_rate")),
        "failed_checks": (quality, F.sum("failed_checks")),
        "tables_tracked": (volume, F.count("*")),
        "high_volatility_tables": (volume, F.count_if(F.col("data_volatility") == "HIGH")),
        "total_records_7_days": (volume, F.sum("total_records_7_days")),
        "tables_validated": (integrity, F.count("*")),
        "passed_validations": (integrity, F.count_if(F.col("validation_status") == "PASS")),
        "failed_validations": (integrity, F.count_if(F.col("validation_status") == "FAIL")),
    }
    by_source: dict[int, tuple[DataFrame, dict[str, Column]]] = {}
    for name, (df, value) in sums.items():
        by_source.setdefault(id(df), (df, {}))[1][name] = value
    rows = None
    for df, values in by_source.values():
        row = df.agg(*[v.cast("double").alias(n) for n, v in values.items()])
        rows = row if rows is None else rows.unionByName(row, allowMissingColumns=True)
    return rows.agg(*[F.coalesce(F.max(n), F.lit(0.0)).alias(n) for n in sums])


def audit_report(figures: DataFrame, run_id: str, as_of: Column) -> DataFrame:
    """The report as JSON text in one row, with the recommendations that apply."""

    def whole(name: str) -> Column:
        return F.col(name).cast("long").cast("string")

    advice = F.array_compact(
        F.array(
            F.when(F.col("overall_score") < 80, F.lit("Health score below 80: check failed runs and quality")),
            F.when(F.col("failed_runs") > 0, F.concat(whole("failed_runs"), F.lit(" pipeline failures to address"))),
            F.when(F.col("avg_quality_score") < 95, F.lit("Quality score below 95: review rules and sources")),
            F.when(
                F.col("high_volatility_tables") > 0,
                F.concat(whole("high_volatility_tables"), F.lit(" tables with high volatility")),
            ),
            F.when(F.col("failed_validations") > 0, F.lit("Gold validation failures: review integrity")),
        )
    )
    body = F.to_json(
        F.struct(
            F.lit(run_id).alias("audit_report_id"),
            as_of.cast("string").alias("audit_timestamp"),
            F.struct(*[F.col(c) for c in figures.columns]).alias("figures"),
            advice.alias("recommendations"),
        )
    )
    return figures.select(F.lit(run_id).alias("audit_report_id"), F.size(advice).alias("advice_count"), body.alias("report"))


# -- alerts --------------------------------------------------------------------------------------
def check_counts(quality: DataFrame, runs: DataFrame, streams: DataFrame, volumes: DataFrame) -> DataFrame:
    """Findings per check: one row each, zero when a check found nothing."""
    checks = {
        "data_quality": quality,
        "pipeline_execution": runs,
        "stream_health": streams,
        "data_volume": volumes,
    }
    rows = None
    for name, found in checks.items():
        row = found.agg(F.count("*").alias("findings")).select(F.lit(name).alias("check_name"), "findings")
        rows = row if rows is None else rows.unionByName(row)
    return rows


def alert_messages(counts: DataFrame) -> DataFrame:
    """A message row per check that fired."""
    serious = F.col("check_name").isin("pipeline_execution", "stream_health")
    return counts.filter("findings > 0").select(
        "check_name",
        "findings",
        F.when(serious, F.lit("HIGH")).otherwise(F.lit("MEDIUM")).alias("severity"),
        F.concat(F.col("findings").cast("string"), F.lit(" findings in "), F.col("check_name")).alias("message"),
    )


def dashboard_scores(counts: DataFrame) -> DataFrame:
    """Scores that the status board shows: a lower one where the check fired."""

    def found(check: str) -> Column:
        return F.coalesce(F.max(F.when(F.col("check_name") == check, F.col("findings"))), F.lit(0))

    def shown(check: str, low: int) -> Column:
        return F.when(found(check) > 0, F.lit(low)).otherwise(F.lit(100))

    # The scores below.
    return counts.agg(
        shown("data_quality", 85).alias("data_quality_score"),
        shown("pipeline_execution", 75).alias("pipeline_success_rate"),
        shown("stream_health", 50).alias("stream_health"),
        shown("data_volume", 80).alias("data_volume_health"),
        F.when(F.sum("findings") > 0, F.lit("WARNING")).otherwise(F.lit("HEALTHY")).alias("overall_health"),
    )


def metrics_by_day(runs: DataFrame) -> DataFrame:
    """Run metrics per pipeline and day."""
    seconds = x.seconds_between(F.col("start_time"), F.col("end_time"))
    return (
        runs.groupBy(F.to_date("start_time").alias("audit_date"), "pipeline_name")
        .agg(
            F.count("*").alias("total_runs"),
            F.count_if(_is("SUCCESS")).alias("successful_runs"),
            F.count_if(_is("FAILED")).alias("failed_runs"),
            F.avg(F.when(_is("SUCCESS"), seconds)).alias("avg_success_duration_seconds"),
        )
        .withColumn("success_rate", percent("successful_runs", "total_runs"))
    )


def trend(daily: DataFrame, as_of: Column, days: int = 7) -> DataFrame:
    day = F.col("audit_date")
    return daily.filter((day >= F.date_sub(as_of, days)) & (day <= as_of))


def freshness_alerts(fresh: DataFrame, quality: DataFrame, runs: DataFrame, cfg: Settings) -> DataFrame:
    """Late tables, tables with more than five percent failures, pipelines with a failure."""
    late = fresh.filter(F.col("hours_since_update") > cfg.fresh_hours).select(
        F.lit("freshness").alias("alert"), F.col("table_name").alias("subject")
    )
    poor = quality.filter(F.col("avg_pass_rate") < 95).select(
        F.lit("quality").alias("alert"), F.col("table_name").alias("subject")
    )
    broken = runs.filter(F.col("failed_runs") > 0).select(
        F.lit("pipeline").alias("alert"), F.col("pipeline_name").alias("subject")
    )
    return late.unionByName(poor).unionByName(broken)


def lineage(runs: DataFrame) -> DataFrame:
    return runs.select("source_system", "target_table").distinct()


def stream_alerts(metrics: DataFrame) -> DataFrame:
    """Alerts over batch metrics: one row per batch and limit that it breaks."""
    # Alert names and limits.
    limits = [
        ("latency", F.col("avg_processing_delay") > 120),
        ("error_rate", ratio("rejected_events", "event_count") > 0.01),
        ("backlog", F.col("backlog_events") > 10_000),
        ("slow", F.col("events_per_second") < 100),
        ("late_events", ratio("late_events", "event_count") > 0.05),
    ]
    fired = F.array_compact(F.array(*[F.when(broken, F.lit(name)) for name, broken in limits]))
    return metrics.select("batch_id", "stream_name", F.explode(fired).alias("alert"))
