"""Queries O: runs, health, alerts and the report."""

from pyspark.sql import functions as F

from claimloom.operators import audit, dashboards, quality
from claimloom.plans.boards import FRESH, fresh_tables
from claimloom.plans.checks import INTEGRITY, QUALITY_ALERTS, QUALITY_METRICS, since
from claimloom.plans.registry import query
from claimloom.plans.sqltext import EVENTS_AS_OF, n_if, pct, rate_avg, ratio, stddev
from claimloom.plans.streams import STALLED
from claimloom.sources import scratch

_SECONDS = "CAST(floor(epoch(end_time)) - floor(epoch(start_time)) AS BIGINT)"
_OK = "status = 'SUCCESS'"
_FAILED = "status = 'FAILED'"


@query(
    "o01_run_record",
    """SELECT 'load_claims' AS pipeline_name, 'lineitem' AS source_system, 'bronze_claims' AS target_table,
        'SUCCESS' AS status, COUNT(*) AS source_row_count, COUNT(*) AS target_row_count, TRUE AS has_end FROM lineitem
        UNION ALL SELECT 'load_void', 'lineitem', 'bronze_claims', 'FAILED', COUNT(*), NULL, TRUE FROM lineitem""",
)
def _(t):
    path = scratch.fresh(t.spark, "runs")
    with audit.recorded(t.spark, path, "run-1", "load_claims", "lineitem", "bronze_claims") as run:
        run.source_rows = run.target_rows = t.table("lineitem").count()
    try:
        with audit.recorded(t.spark, path, "run-2", "load_void", "lineitem", "bronze_claims") as run:
            run.source_rows = t.table("lineitem").count()
            quality.require_rows(t.table("lineitem").filter("l_orderkey < 0"), "claims")
    except ValueError:
        pass
    rows = t.spark.read.parquet(path).withColumn("has_end", F.col("end_time") >= F.col("start_time"))
    return rows.select(
        "pipeline_name", "source_system", "target_table", "status", "source_row_count", "target_row_count", "has_end"
    )


RUN_METRICS = f"""SELECT *, {pct('successful_runs', 'total_runs')} AS success_rate,
    {pct('failed_runs', 'total_runs')} AS failure_rate FROM (SELECT pipeline_name, COUNT(*) AS total_runs,
    {n_if(_OK)} AS successful_runs, {n_if(_FAILED)} AS failed_runs,
    avg(CASE WHEN {_OK} THEN {_SECONDS} END) AS avg_success_duration_seconds, max(start_time) AS last_run_time,
    min(start_time) AS first_run_time FROM runs WHERE {since('24 HOURS', 'start_time')} GROUP BY pipeline_name)"""
VOLUME = f"""SELECT *, CASE WHEN coefficient_of_variation > 0.5 THEN 'HIGH' WHEN coefficient_of_variation > 0.2
    THEN 'MEDIUM' ELSE 'LOW' END AS data_volatility FROM (SELECT *,
    {ratio('stddev_records', 'avg_daily_records')} AS coefficient_of_variation FROM (
    SELECT table_name, avg(record_count) AS avg_daily_records, max(record_count) AS max_daily_records,
    min(record_count) AS min_daily_records, {stddev('record_count')} AS stddev_records, COUNT(*) AS days_with_data,
    CAST(SUM(record_count) AS BIGINT) AS total_records_7_days FROM row_counts
    WHERE run_date >= CAST({EVENTS_AS_OF} AS DATE) - 7 AND run_date <= CAST({EVENTS_AS_OF} AS DATE) GROUP BY 1))"""


@query("o02_run_metrics", RUN_METRICS)
def _(t):
    return audit.run_metrics(t.runs(), t.events_as_of)


@query("o03_volume_metrics", VOLUME)
def _(t):
    return audit.volume_metrics(t.row_counts(), F.to_date(t.events_as_of))


DEVIATION = """SELECT *, coalesce(deviation_pct > 50, FALSE) OR record_count = 0 AS is_alert FROM (
    SELECT *, CAST(abs(record_count - avg_before) * 100 AS DOUBLE) / NULLIF(avg_before, 0) AS deviation_pct FROM (
    SELECT table_name, run_date, record_count, avg(record_count) OVER (PARTITION BY table_name ORDER BY run_date
    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS avg_before FROM row_counts))"""


@query("o04_count_deviation", DEVIATION)
def _(t):
    return audit.count_deviation(t.row_counts(), t.cfg)


HEALTH = f"""WITH r AS ({RUN_METRICS}), q AS ({QUALITY_METRICS}), v AS ({VOLUME}),
    i AS (SELECT * FROM ({INTEGRITY})), c AS (
    SELECT (SELECT least({rate_avg('success_rate')} / 100, 1) FROM r) AS p,
    (SELECT least({rate_avg('avg_pass_rate')} / 100, 1) FROM q) AS d,
    (SELECT 1 - {rate_avg("CASE data_volatility WHEN 'LOW' THEN 0 WHEN 'MEDIUM' THEN 0.5 ELSE 1 END")} FROM v) AS s,
    (SELECT {ratio(n_if("validation_status = 'PASS'"), 'COUNT(*)')} FROM i) AS g)
    SELECT o * 100 AS overall_health_score, CASE WHEN o >= 0.9 THEN 'A' WHEN o >= 0.8 THEN 'B' WHEN o >= 0.7 THEN 'C'
    WHEN o >= 0.6 THEN 'D' ELSE 'F' END AS health_grade, p * 100 AS pipeline_health, d * 100 AS data_quality_health,
    s * 100 AS volume_stability_health, g * 100 AS gold_integrity_health FROM (SELECT *,
    p * CAST(0.4 AS DOUBLE) + d * CAST(0.3 AS DOUBLE) + s * CAST(0.2 AS DOUBLE) + g * CAST(0.1 AS DOUBLE) AS o FROM c)"""


@query("o05_health_score", HEALTH)
def _(t):
    return audit.health(*t.health_inputs())


def _figures(t):
    runs, results, volume, integrity = t.health_inputs()
    return audit.report_figures(audit.health(runs, results, volume, integrity), runs, results, volume, integrity)


@query(
    "o06_report_figures",
    f"""WITH h AS ({HEALTH}), r AS ({RUN_METRICS}), q AS ({QUALITY_METRICS}), v AS ({VOLUME}), i AS (SELECT * FROM ({INTEGRITY}))
        SELECT (SELECT overall_health_score FROM h) AS overall_score,
        (SELECT CAST(COUNT(*) AS DOUBLE) FROM r) AS pipeline_types, (SELECT {rate_avg('success_rate')} FROM r) AS avg_success_rate,
        (SELECT CAST(SUM(failed_runs) AS DOUBLE) FROM r) AS failed_runs,
        (SELECT CAST(COUNT(*) AS DOUBLE) FROM q) AS tables_monitored,
        (SELECT {rate_avg('avg_pass_rate')} FROM q) AS avg_quality_score,
        (SELECT CAST(SUM(failed_checks) AS DOUBLE) FROM q) AS failed_checks,
        (SELECT CAST(COUNT(*) AS DOUBLE) FROM v) AS tables_tracked,
        (SELECT CAST({n_if("data_volatility = 'HIGH'")} AS DOUBLE) FROM v) AS high_volatility_tables,
        (SELECT CAST(SUM(total_records_7_days) AS DOUBLE) FROM v) AS total_records_7_days,
        (SELECT CAST(COUNT(*) AS DOUBLE) FROM i) AS tables_validated,
        (SELECT CAST({n_if("validation_status = 'PASS'")} AS DOUBLE) FROM i) AS passed_validations,
        (SELECT CAST({n_if("validation_status = 'FAIL'")} AS DOUBLE) FROM i) AS failed_validations""",
)
def _(t):
    return _figures(t)


@query("o06_audit_report")
def _(t):
    return audit.audit_report(_figures(t), "run-1", t.events_as_of)


RUN_ALERTS = f"""SELECT * FROM (SELECT pipeline_name, {n_if(_FAILED)} AS failed_runs,
    {rate_avg(f'{_SECONDS} / CAST(60 AS DOUBLE)')} AS avg_duration_minutes FROM runs
    WHERE {since('24 HOURS', 'start_time')} GROUP BY 1) WHERE failed_runs > 0 OR avg_duration_minutes > 120"""


@query("o07_run_alerts", RUN_ALERTS)
def _(t):
    return audit.run_alerts(t.runs(), t.events_as_of, t.cfg)


CHECKS = f"""SELECT 'data_quality' AS check_name, COUNT(*) AS findings FROM ({QUALITY_ALERTS})
    UNION ALL SELECT 'pipeline_execution', COUNT(*) FROM ({RUN_ALERTS})
    UNION ALL SELECT 'stream_health', COUNT(*) FROM ({STALLED})
    UNION ALL SELECT 'data_volume', COUNT(*) FROM ({DEVIATION}) WHERE is_alert"""


def _checks(t):
    return audit.check_counts(
        audit.quality_alerts(t.quality_results(), t.events_as_of, t.cfg),
        audit.run_alerts(t.runs(), t.events_as_of, t.cfg),
        audit.stalled_streams(t.stream_monitoring(), t.events_as_of, t.cfg),
        audit.count_deviation(t.row_counts(), t.cfg).filter("is_alert"),
    )


@query(
    "o08_alert_messages",
    f"""SELECT check_name, findings, CASE WHEN check_name IN ('pipeline_execution', 'stream_health') THEN 'HIGH'
        ELSE 'MEDIUM' END AS severity, findings || ' findings in ' || check_name AS message FROM ({CHECKS})
        WHERE findings > 0""",
)
def _(t):
    return audit.alert_messages(_checks(t))


def _score(check: str, low: int, name: str) -> str:
    return f"CASE WHEN max(CASE WHEN check_name = '{check}' THEN findings END) > 0 THEN {low} ELSE 100 END AS {name}"


@query(
    "o09_dashboard_scores",
    f"""SELECT {_score('data_quality', 85, 'data_quality_score')},
        {_score('pipeline_execution', 75, 'pipeline_success_rate')}, {_score('stream_health', 50, 'stream_health')},
        {_score('data_volume', 80, 'data_volume_health')},
        CASE WHEN SUM(findings) > 0 THEN 'WARNING' ELSE 'HEALTHY' END AS overall_health FROM ({CHECKS})""",
)
def _(t):
    return audit.dashboard_scores(_checks(t))


@query(
    "o10_run_trend",
    f"""SELECT *, {pct('successful_runs', 'total_runs')} AS success_rate FROM (
        SELECT CAST(start_time AS DATE) AS audit_date, pipeline_name, COUNT(*) AS total_runs,
        {n_if(_OK)} AS successful_runs, {n_if(_FAILED)} AS failed_runs,
        avg(CASE WHEN {_OK} THEN {_SECONDS} END) AS avg_success_duration_seconds FROM runs GROUP BY 1, 2)
        WHERE audit_date >= CAST({EVENTS_AS_OF} AS DATE) - 7 AND audit_date <= CAST({EVENTS_AS_OF} AS DATE)""",
)
def _(t):
    return audit.trend(audit.metrics_by_day(t.runs()), F.to_date(t.events_as_of))


@query(
    "o10_quality_dashboard",
    f"SELECT table_name, avg_pass_rate AS quality_score, quality_grade, failed_checks, total_quality_checks FROM ({QUALITY_METRICS})",
)
def _(t):
    rows = audit.quality_metrics(t.quality_results(), t.events_as_of)
    return rows.select(
        "table_name",
        F.col("avg_pass_rate").alias("quality_score"),
        "quality_grade",
        "failed_checks",
        "total_quality_checks",
    )


@query(
    "o11_freshness_alerts",
    f"""SELECT 'freshness' AS alert, table_name AS subject FROM ({FRESH}) WHERE hours_since_update > 2
        UNION ALL SELECT 'quality', table_name FROM ({QUALITY_METRICS}) WHERE avg_pass_rate < 95
        UNION ALL SELECT 'pipeline', pipeline_name FROM ({RUN_METRICS}) WHERE failed_runs > 0""",
)
def _(t):
    fresh = dashboards.freshness(fresh_tables(t), t.events_as_of)
    results = audit.quality_metrics(t.quality_results(), t.events_as_of)
    return audit.freshness_alerts(fresh, results, audit.run_metrics(t.runs(), t.events_as_of), t.cfg)


@query(
    "o12_row_count_writer",
    f"""SELECT 'claims' AS table_name, CAST({EVENTS_AS_OF} AS DATE) AS run_date, COUNT(*) AS record_count FROM lineitem
        UNION ALL SELECT 'members', CAST({EVENTS_AS_OF} AS DATE), COUNT(*) FROM customer""",
)
def _(t):
    path, day = scratch.fresh(t.spark, "row-counts"), F.to_date(t.events_as_of)
    for name, table in (("claims", "lineitem"), ("members", "customer")):
        audit.row_count(t.table(table), name, day).write.mode("append").parquet(path)
    return t.spark.read.parquet(path)


@query("o13_lineage", "SELECT DISTINCT source_system, target_table FROM runs")
def _(t):
    return audit.lineage(t.runs())
