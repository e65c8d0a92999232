"""Dashboard queries. Each takes the fact or a mart and the day it is asked for.

Period filters are on the service date with literal bounds, so they reach the claim scan instead of
being applied to finished groups. Every top-n list ends in a unique column.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from claimloom.config import Settings
from claimloom.functions import fields as x
from claimloom.functions.exact import money_avg, money_sum, percent, rate_avg, ratio


def recent(df: DataFrame, as_of: Column, months: int, column: str = "service_date") -> DataFrame:
    return df.filter(x.since_months(F.col(column), as_of, months))


def in_month(df: DataFrame, as_of: Column, column: str = "service_date") -> DataFrame:
    return df.filter(F.col(column).between(F.trunc(as_of, "MM"), F.last_day(as_of)))


def in_quarter(df: DataFrame, as_of: Column, column: str = "service_date") -> DataFrame:
    start = F.trunc(as_of, "quarter")
    return df.filter((F.col(column) >= start) & (F.col(column) < F.add_months(start, 3)))


def in_year(df: DataFrame, as_of: Column, column: str = "service_date") -> DataFrame:
    start = F.trunc(as_of, "year")
    return df.filter((F.col(column) >= start) & (F.col(column) < F.add_months(start, 12)))


def _is(status: str) -> Column:
    return F.col("claim_status") == status


def denial_pct() -> Column:
    return percent(F.count_if(_is("DENIED")), F.count("*"))


def _month() -> Column:
    return x.month_start(F.year("service_date"), F.month("service_date"))


def _claims() -> Column:
    return F.count_distinct("claim_id")


def top(df: DataFrame, n: int, *order: Column) -> DataFrame:
    return df.orderBy(*order).limit(n)


# -- executive overview ------------------------------------------------------------------------
EXECUTIVE_INPUT = """claim_id claim_status paid_amount claim_amount provider_id member_sk
    processing_delay_days is_high_value_claim service_date""".split()


def executive_kpis(fact: DataFrame, as_of: Column, cfg: Settings) -> DataFrame:
    return recent(fact, as_of, cfg.months_recent).agg(
        _claims().alias("total_claims"),
        F.count_distinct(F.when(_is("PENDING"), F.col("claim_id"))).alias("pending_claims"),
        money_sum("paid_amount").alias("total_paid_amount"),
        money_avg("claim_amount").alias("avg_claim_amount"),
        F.count_distinct("provider_id").alias("active_providers"),
        F.count_distinct("member_sk").alias("active_members"),
        denial_pct().alias("denial_rate"),
        F.avg("processing_delay_days").alias("avg_processing_delay"),
        F.count_if("is_high_value_claim").alias("high_value_claims"),
    )


TREND_INPUT = "claim_id claim_amount paid_amount claim_status service_date".split()


def monthly_trends(fact: DataFrame, as_of: Column, cfg: Settings) -> DataFrame:
    months = recent(fact, as_of, cfg.months_trend).groupBy(_month().alias("claim_month"))
    return months.agg(
        _claims().alias("total_claims"),
        money_sum("claim_amount").alias("total_amount"),
        money_sum("paid_amount").alias("paid_amount"),
        F.count_if(_is("DENIED")).alias("denied_claims"),
        F.count_if(_is("PENDING")).alias("pending_claims"),
    )


TOP_PROVIDER_INPUT = """claim_id claim_amount claim_status provider_id provider_specialty
    provider_specialty_category service_date""".split()


def top_providers(fact: DataFrame, as_of: Column, n: int = 10) -> DataFrame:
    totals = (
        in_month(fact, as_of)
        .groupBy("provider_id", "provider_specialty", "provider_specialty_category")
        .agg(
            _claims().alias("claim_count"),
            money_sum("claim_amount").alias("total_amount"),
            money_avg("claim_amount").alias("avg_amount"),
            denial_pct().alias("denial_rate"),
        )
    )
    return top(totals, n, F.col("total_amount").desc(), F.col("provider_id"))


PAYER_INPUT = "payer_type claim_id claim_amount claim_status service_date".split()


def by_payer_type(fact: DataFrame, as_of: Column, cfg: Settings) -> DataFrame:
    return (
        recent(fact, as_of, cfg.months_recent)
        .groupBy("payer_type")
        .agg(
            _claims().alias("claim_count"),
            money_sum("claim_amount").alias("total_amount"),
            money_avg("claim_amount").alias("avg_amount"),
            denial_pct().alias("denial_rate"),
        )
    )


STATE_INPUT = "member_state claim_id claim_amount member_sk provider_id service_date".split()


def by_member_state(fact: DataFrame, as_of: Column, cfg: Settings) -> DataFrame:
    return (
        recent(fact, as_of, cfg.months_recent)
        .groupBy("member_state")
        .agg(
            _claims().alias("claim_count"),
            money_sum("claim_amount").alias("total_amount"),
            F.count_distinct("member_sk").alias("unique_members"),
            F.count_distinct("provider_id").alias("unique_providers"),
        )
    )


# -- providers: ``mart`` holds the wanted period -----------------------------------------------
def provider_search(mart: DataFrame) -> DataFrame:
    keys = """provider_id provider_specialty provider_specialty_category provider_network_status
        provider_region""".split()
    return mart.groupBy(*keys).agg(
        F.sum("total_claims").alias("total_claims"),
        money_sum("total_claim_amount").alias("total_amount"),
        rate_avg("avg_claim_amount").alias("avg_claim_amount"),
        rate_avg("denial_rate").alias("denial_rate"),
        rate_avg("payment_rate").alias("payment_rate"),
        F.sum("unique_members").alias("unique_members"),
        rate_avg("avg_processing_delay_days").alias("avg_processing_delay"),
    )


def provider_trend(mart: DataFrame, provider_id) -> DataFrame:
    return mart.filter(F.col("provider_id") == provider_id).select(
        "provider_id",
        x.month_start(F.col("service_year"), F.col("service_month")).alias("performance_month"),
        "total_claims",
        "total_claim_amount",
        "denial_rate",
        "payment_rate",
        "unique_members",
    )


def specialty_comparison(mart: DataFrame) -> DataFrame:
    return mart.groupBy("provider_specialty_category").agg(
        F.count_distinct("provider_id").alias("provider_count"),
        F.sum("total_claims").alias("total_claims"),
        money_sum("total_claim_amount").alias("total_amount"),
        rate_avg("denial_rate").alias("avg_denial_rate"),
        rate_avg("payment_rate").alias("avg_payment_rate"),
    )


def provider_quality(mart: DataFrame, n: int = 20) -> DataFrame:
    """Quality figures of the top providers of the period. A provider has one row per month in the
    mart, so the top list and its figures are the same rows."""
    leaders = top(mart, n, F.col("total_claim_amount").desc(), F.col("provider_id"))
    return leaders.select(
        "provider_id",
        "denial_rate",
        "payment_rate",
        "avg_processing_delay_days",
        "out_of_network_rate",
        "high_value_rate",
    )


def in_top(df: DataFrame, key: str, leaders: DataFrame, n: int, *order: Column) -> DataFrame:
    """Rows whose key is among the first ``n`` of ``leaders``: a semi join with n rows."""
    return df.join(top(leaders, n, *order).select(key), key, "left_semi")


def provider_ranking(scorecard: DataFrame, n: int = 20) -> DataFrame:
    rows = scorecard.select(
        "provider_id",
        "provider_name",
        "provider_specialty_category",
        "service_month",
        "total_claims",
        "total_claim_amount",
        "denial_rate",
        "payment_rate",
        "unique_members",
        "specialty_rank_quarter",
        "volume_category",
        "denial_performance_category",
    )
    return top(rows, n, F.col("total_claim_amount").desc(), F.col("provider_id"), F.col("service_month"))


# -- denials -----------------------------------------------------------------------------------
def _denied() -> Column:
    return _is("DENIED")


DENIAL_SUMMARY_INPUT = "claim_status claim_amount denied_amount provider_id member_id service_date".split()


def denial_summary(fact: DataFrame, as_of: Column) -> DataFrame:
    return in_year(fact, as_of).agg(
        F.count_if(_denied()).alias("total_denied_claims"),
        money_sum("denied_amount").alias("total_denied_amount"),
        ratio(F.count_if(_denied()), F.count("*")).alias("denial_rate"),
        money_avg(F.when(_denied(), F.col("claim_amount"))).alias("avg_denial_amount"),
        F.count_distinct(F.when(_denied(), F.col("provider_id"))).alias("affected_providers"),
        F.count_distinct(F.when(_denied(), F.col("member_id"))).alias("affected_members"),
    )


DENIAL_GROUP_INPUT = "claim_status denied_amount provider_id service_date".split()


def _denials_by(df: DataFrame, key: Column | str) -> DataFrame:
    return df.groupBy(key).agg(
        F.count_if(_denied()).alias("denied_claims"),
        money_sum("denied_amount").alias("denied_amount"),
        ratio(F.count_if(_denied()), F.count("*")).alias("denial_rate"),
        F.count_distinct(F.when(_denied(), F.col("provider_id"))).alias("unique_providers"),
    )


def denial_trend(fact: DataFrame, as_of: Column, cfg: Settings) -> DataFrame:
    return _denials_by(recent(fact, as_of, cfg.months_trend), _month().alias("denial_month"))


def denial_reasons(fact: DataFrame, as_of: Column, cfg: Settings) -> DataFrame:
    rows = recent(fact, as_of, cfg.months_recent).filter(_denied() & F.col("denial_reason").isNotNull())
    return rows.groupBy("denial_reason").agg(
        F.count("*").alias("denial_count"),
        money_sum("denied_amount").alias("total_denied_amount"),
        money_avg("denied_amount").alias("avg_denied_amount"),
        F.count_distinct("provider_id").alias("affected_providers"),
    )


def denial_by_payer_type(fact: DataFrame, as_of: Column) -> DataFrame:
    return _denials_by(in_year(fact, as_of), "payer_type")


def denial_heat_map(fact: DataFrame, as_of: Column, cfg: Settings) -> DataFrame:
    rows = recent(fact, as_of, cfg.months_recent).filter(_denied())
    return rows.groupBy("provider_specialty_category", "denial_reason").agg(
        F.count("*").alias("denial_count"), money_sum("denied_amount").alias("total_denied_amount")
    )


def high_risk_providers(fact: DataFrame, as_of: Column, cfg: Settings) -> DataFrame:
    totals = (
        recent(fact, as_of, cfg.months_risk)
        .groupBy("provider_id", "provider_specialty_category")
        .agg(
            F.count("*").alias("total_claims"),
            F.count_if(_denied()).alias("denied_claims"),
            denial_pct().alias("denial_rate"),
            money_sum("denied_amount").alias("total_denied_amount"),
        )
    )
    return totals.filter(F.col("denial_rate") > cfg.risk_denial_pct)


# -- anomalies ---------------------------------------------------------------------------------
def _risk(level: str) -> Column:
    return F.count_if(F.col("anomaly_risk_level") == level)


def anomaly_summary(mart: DataFrame) -> DataFrame:
    return mart.agg(
        F.count("*").alias("total_anomalies"),
        _risk("HIGH").alias("high_risk_anomalies"),
        _risk("MEDIUM").alias("medium_risk_anomalies"),
        _risk("LOW").alias("low_risk_anomalies"),
        F.count_if("requires_investigation").alias("requires_investigation"),
        money_avg("claim_amount").alias("avg_anomaly_amount"),
        F.max("claim_amount").alias("max_anomaly_amount"),
    )


def anomaly_trend(mart: DataFrame, as_of: Column, cfg: Settings) -> DataFrame:
    return (
        recent(mart, as_of, cfg.months_recent)
        .groupBy(_month().alias("anomaly_month"))
        .agg(
            F.count("*").alias("total_anomalies"),
            _risk("HIGH").alias("high_risk_count"),
            F.count_if("requires_investigation").alias("investigation_count"),
        )
    )


def anomaly_types(mart: DataFrame) -> DataFrame:
    return mart.agg(
        F.count_if("duplicate_flag").alias("duplicate_claims"),
        F.count_if("amount_outlier_flag").alias("amount_outliers"),
        F.count_if("high_denial_provider_flag").alias("high_denial_provider"),
        F.count_if("frequent_procedure_flag").alias("frequent_procedures"),
    )


def risk_breakdown(mart: DataFrame) -> DataFrame:
    return mart.groupBy("anomaly_risk_level").agg(
        F.count("*").alias("anomaly_count"),
        money_sum("claim_amount").alias("total_amount"),
        money_avg("claim_amount").alias("avg_amount"),
        F.count_if("requires_investigation").alias("investigation_count"),
    )


def investigation_queue(mart: DataFrame, tie: Sequence[str], n: int = 50) -> DataFrame:
    rows = mart.filter(F.col("requires_investigation") & (F.col("anomaly_risk_level") == "HIGH"))
    order = [F.col("anomaly_score").desc(), F.col("service_date").desc(), *[F.col(c) for c in tie]]
    return top(rows, n, *order).select(
        "claim_line_key",
        "claim_id",
        "anomaly_score",
        "anomaly_risk_level",
        "anomaly_reasons",
        "claim_amount",
        "provider_specialty_category",
        "payer_type",
        "service_date",
        "requires_investigation",
    )


def anomaly_hotspots(mart: DataFrame, as_of: Column, cfg: Settings) -> DataFrame:
    states = (
        recent(mart, as_of, cfg.months_risk)
        .groupBy("member_state")
        .agg(
            F.count("*").alias("anomaly_count"),
            money_sum("claim_amount").alias("total_anomaly_amount"),
            F.avg("anomaly_score").alias("avg_risk_score"),
        )
    )
    return states.filter(F.col("anomaly_count") > cfg.hotspot_count)


# -- members -----------------------------------------------------------------------------------
UTILIZATION_INPUT = "member_sk claim_amount processing_delay_days service_date".split()


def utilization_summary(fact: DataFrame, as_of: Column, cfg: Settings) -> DataFrame:
    """``high_cost_claims`` counts claims, ``high_cost_members`` members by their total. Claims are
    folded to members first; the second step adds up one row per member."""
    per_member = (
        recent(fact, as_of, cfg.months_recent)
        .groupBy("member_sk")
        .agg(
            F.count("*").alias("n"),
            F.count("claim_amount").alias("with_amount"),
            money_sum("claim_amount").alias("amount"),
            F.count_if(F.col("claim_amount") > cfg.high_cost).alias("high"),
            F.sum("processing_delay_days").alias("delay"),
            F.count("processing_delay_days").alias("with_delay"),
        )
    )
    members = F.count("member_sk")
    return per_member.agg(
        members.alias("active_members"),
        F.sum("n").alias("total_claims"),
        money_sum("amount").alias("total_amount"),
        ratio(money_sum("amount"), F.sum("with_amount")).alias("avg_claim_amount"),
        ratio(F.sum("n"), members).alias("claims_per_member"),
        F.sum("high").alias("high_cost_claims"),
        F.count_if(F.col("amount") > cfg.high_cost).alias("high_cost_members"),
        ratio(F.sum("delay"), F.sum("with_delay")).alias("avg_processing_delay"),
    )


def _use(df: DataFrame, key: Column | str, members: str) -> DataFrame:
    return df.groupBy(key).agg(
        F.count_distinct("member_sk").alias(members),
        F.count("*").alias("total_claims"),
        money_sum("claim_amount").alias("total_amount"),
        money_avg("claim_amount").alias("avg_amount"),
        ratio(F.count("*"), F.count_distinct("member_sk")).alias("claims_per_member"),
    )


def utilization_trend(fact: DataFrame, as_of: Column, cfg: Settings) -> DataFrame:
    rows = recent(fact, as_of, cfg.months_trend)
    return _use(rows, _month().alias("utilization_month"), "active_members")


def by_age_group(fact: DataFrame, as_of: Column, cfg: Settings) -> DataFrame:
    return _use(recent(fact, as_of, cfg.months_recent), "member_age_group", "unique_members")


def by_gender(fact: DataFrame, as_of: Column, cfg: Settings) -> DataFrame:
    rows = recent(fact, as_of, cfg.months_recent).filter(F.col("member_gender").isNotNull())
    return _use(rows, "member_gender", "unique_members").drop("claims_per_member")


def high_cost_members(mart: DataFrame, n: int = 50) -> DataFrame:
    rows = mart.select(
        "member_id",
        "member_age_group",
        "member_gender",
        "member_state",
        "total_claims",
        "total_claim_amount",
        "avg_claim_amount",
        "denial_rate",
        "unique_providers",
        "is_high_utilization",
        "is_high_cost_member",
    )
    return top(rows, n, F.col("total_claim_amount").desc(), F.col("member_id"))


def service_patterns(fact: DataFrame, as_of: Column, cfg: Settings) -> DataFrame:
    return (
        recent(fact, as_of, cfg.months_recent)
        .groupBy("provider_specialty_category", "member_age_group")
        .agg(
            F.count("*").alias("claim_count"),
            money_sum("claim_amount").alias("total_amount"),
            money_avg("claim_amount").alias("avg_amount"),
        )
    )


# -- system health -----------------------------------------------------------------------------
def freshness(tables: dict[str, tuple[DataFrame, str]], as_of: Column) -> DataFrame:
    """Last update and whole hours since, one row per table."""
    rows = None
    for name, (df, column) in tables.items():
        row = df.agg(F.lit(name).alias("table_name"), F.max(column).alias("last_update"))
        rows = row if rows is None else rows.unionByName(row)
    hours = F.floor(x.seconds_between(F.col("last_update"), as_of) / 3600).cast("long")
    return rows.withColumn("hours_since_update", hours)


def pipeline_health(runs: DataFrame, as_of: Column, days: int = 7) -> DataFrame:
    minutes = F.floor(x.seconds_between(F.col("start_time"), F.col("end_time")) / 60)
    return (
        runs.filter(F.col("start_time") >= as_of - F.expr(f"INTERVAL {days} DAYS"))
        .groupBy("pipeline_name")
        .agg(
            F.count("*").alias("total_runs"),
            F.count_if(F.col("status") == "SUCCESS").alias("successful_runs"),
            F.count_if(F.col("status") == "FAILED").alias("failed_runs"),
            F.max("start_time").alias("last_run_time"),
            F.avg(minutes).alias("avg_duration_minutes"),
        )
    )
