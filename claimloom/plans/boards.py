"""Queries K: the dashboard set."""

from pyspark.sql import functions as F

from claimloom.operators import dashboards as d
from claimloom.operators import marts
from claimloom.plans.gold import (
    ANOMALY_MART,
    MEMBER_MART,
    PROVIDER_MART,
    SCORECARD,
    anomaly_mart,
    member_mart,
    provider_mart,
)
from claimloom.plans.model import SETTINGS as C
from claimloom.plans.registry import query
from claimloom.plans.sqltext import AS_OF, EVENTS_AS_OF, n_if, pct, rate_avg, ratio, usd, usd_avg

_D = "claim_status = 'DENIED'"
_YEAR = f"service_year = year({AS_OF})"
_MONTH = f"{_YEAR} AND service_month = month({AS_OF})"
_QUARTER = f"{_YEAR} AND service_quarter = quarter({AS_OF})"
DENIAL_PCT = pct(n_if(_D), "COUNT(*)")


def _since(months: int) -> str:
    return f"service_date >= {AS_OF} - INTERVAL {months} MONTH"


def _month_of(name: str) -> str:
    return f"CAST(date_trunc('month', service_date) AS DATE) AS {name}"


@query(
    "k01_executive_kpis",
    f"""SELECT COUNT(DISTINCT claim_id) AS total_claims,
        COUNT(DISTINCT CASE WHEN claim_status = 'PENDING' THEN claim_id END) AS pending_claims,
        {usd('paid_amount')} AS total_paid_amount, {usd_avg('claim_amount')} AS avg_claim_amount,
        COUNT(DISTINCT provider_id) AS active_providers, COUNT(DISTINCT member_sk) AS active_members,
        {DENIAL_PCT} AS denial_rate, avg(processing_delay_days) AS avg_processing_delay,
        {n_if('is_high_value_claim')} AS high_value_claims FROM fact WHERE {_since(12)}""",
)
def _(t):
    return d.executive_kpis(t.fact(d.EXECUTIVE_INPUT), t.as_of, t.cfg)


@query(
    "k02_monthly_trends",
    f"""SELECT {_month_of('claim_month')}, COUNT(DISTINCT claim_id) AS total_claims, {usd('claim_amount')} AS total_amount,
        {usd('paid_amount')} AS paid_amount, {n_if(_D)} AS denied_claims,
        {n_if("claim_status = 'PENDING'")} AS pending_claims FROM fact WHERE {_since(24)} GROUP BY 1""",
)
def _(t):
    return d.monthly_trends(t.fact(d.TREND_INPUT), t.as_of, t.cfg)


@query(
    "k03_top_providers",
    f"""SELECT provider_id, provider_specialty, provider_specialty_category, COUNT(DISTINCT claim_id) AS claim_count,
        {usd('claim_amount')} AS total_amount, {usd_avg('claim_amount')} AS avg_amount, {DENIAL_PCT} AS denial_rate
        FROM fact WHERE {_MONTH} GROUP BY 1, 2, 3 ORDER BY total_amount DESC, provider_id LIMIT 10""",
)
def _(t):
    return d.top_providers(t.fact(d.TOP_PROVIDER_INPUT), t.as_of)


@query(
    "k04_by_payer_type",
    f"""SELECT payer_type, COUNT(DISTINCT claim_id) AS claim_count, {usd('claim_amount')} AS total_amount,
        {usd_avg('claim_amount')} AS avg_amount, {DENIAL_PCT} AS denial_rate FROM fact WHERE {_since(12)} GROUP BY 1""",
)
def _(t):
    return d.by_payer_type(t.fact(d.PAYER_INPUT), t.as_of, t.cfg)


@query(
    "k05_by_member_state",
    f"""SELECT member_state, COUNT(DISTINCT claim_id) AS claim_count, {usd('claim_amount')} AS total_amount,
        COUNT(DISTINCT member_sk) AS unique_members, COUNT(DISTINCT provider_id) AS unique_providers
        FROM fact WHERE {_since(12)} GROUP BY 1""",
)
def _(t):
    return d.by_member_state(t.fact(d.STATE_INPUT), t.as_of, t.cfg)


@query(
    "k06_provider_search",
    f"""SELECT provider_id, provider_name, provider_specialty, provider_specialty_category, provider_network_status,
        provider_region, CAST(SUM(total_claims) AS BIGINT) AS total_claims, {usd('total_claim_amount')} AS total_amount,
        {rate_avg('avg_claim_amount')} AS avg_claim_amount, {rate_avg('denial_rate')} AS denial_rate,
        {rate_avg('payment_rate')} AS payment_rate, CAST(SUM(unique_members) AS BIGINT) AS unique_members,
        {rate_avg('avg_processing_delay_days')} AS avg_processing_delay
        FROM ({PROVIDER_MART}) m LEFT JOIN (SELECT provider_id, provider_name FROM dim_provider) USING (provider_id)
        WHERE {_MONTH} GROUP BY ALL""",
)
def _(t):
    found = d.provider_search(provider_mart(t, d.in_month))
    return found.join(t.dim_provider().select("provider_id", "provider_name"), "provider_id", "left")


_TREND = "provider_id, total_claims, total_claim_amount, denial_rate, payment_rate, unique_members"


@query(
    "k07_provider_trend",
    f"""SELECT {_TREND}, make_date(service_year, service_month, 1) AS performance_month FROM ({PROVIDER_MART})
        WHERE provider_id = 7 AND make_date(service_year, service_month, 1) >= DATE '2000-08-01'""",
)
def _(t):
    fact = t.fact(marts.PROVIDER_INPUT).filter("provider_id = 7")
    months = fact.filter(F.col("service_date") >= F.trunc(F.add_months(t.as_of, -11), "MM"))
    return d.provider_trend(marts.provider_performance(months, t.frames), 7)


@query(
    "k08_specialty_comparison",
    f"""SELECT provider_specialty_category, COUNT(DISTINCT provider_id) AS provider_count,
        CAST(SUM(total_claims) AS BIGINT) AS total_claims, {usd('total_claim_amount')} AS total_amount,
        {rate_avg('denial_rate')} AS avg_denial_rate, {rate_avg('payment_rate')} AS avg_payment_rate
        FROM ({PROVIDER_MART}) WHERE {_MONTH} GROUP BY 1""",
)
def _(t):
    return d.specialty_comparison(provider_mart(t, d.in_month))


@query(
    "k09_provider_quality",
    f"""SELECT provider_id, denial_rate, payment_rate, avg_processing_delay_days, out_of_network_rate, high_value_rate
        FROM ({PROVIDER_MART}) WHERE {_MONTH} ORDER BY total_claim_amount DESC, provider_id LIMIT 20""",
)
def _(t):
    return d.provider_quality(provider_mart(t, d.in_month))


@query(
    "k10_provider_ranking",
    f"""SELECT provider_id, provider_name, provider_specialty_category, service_month, total_claims, total_claim_amount,
        denial_rate, payment_rate, unique_members, specialty_rank_quarter, volume_category,
        denial_performance_category FROM ({SCORECARD}) WHERE {_QUARTER}
        ORDER BY total_claim_amount DESC, provider_id, service_month LIMIT 20""",
)
def _(t):
    card = marts.provider_scorecard(provider_mart(t, d.in_quarter), t.dim_provider(), ["specialty_rank_quarter"])
    return d.provider_ranking(card)


def _if_denied(column: str) -> str:
    return f"CASE WHEN {_D} THEN {column} END"


@query(
    "k11_denial_summary",
    f"""SELECT {n_if(_D)} AS total_denied_claims, {usd('denied_amount')} AS total_denied_amount,
        {ratio(n_if(_D), 'COUNT(*)')} AS denial_rate, {usd_avg(_if_denied('claim_amount'))} AS avg_denial_amount,
        COUNT(DISTINCT {_if_denied('provider_id')}) AS affected_providers,
        COUNT(DISTINCT {_if_denied('member_id')}) AS affected_members FROM fact WHERE {_YEAR}""",
)
def _(t):
    return d.denial_summary(t.fact(d.DENIAL_SUMMARY_INPUT), t.as_of)


_DENIALS = f"""{n_if(_D)} AS denied_claims, {usd('denied_amount')} AS denied_amount,
    {ratio(n_if(_D), 'COUNT(*)')} AS denial_rate, COUNT(DISTINCT {_if_denied('provider_id')}) AS unique_providers"""


@query("k12_denial_trend", f"SELECT {_month_of('denial_month')}, {_DENIALS} FROM fact WHERE {_since(24)} GROUP BY 1")
def _(t):
    return d.denial_trend(t.fact(d.DENIAL_GROUP_INPUT), t.as_of, t.cfg)


@query(
    "k13_denial_reasons",
    f"""SELECT denial_reason, COUNT(*) AS denial_count, {usd('denied_amount')} AS total_denied_amount,
        {usd_avg('denied_amount')} AS avg_denied_amount, COUNT(DISTINCT provider_id) AS affected_providers
        FROM fact WHERE {_D} AND denial_reason IS NOT NULL AND {_since(12)} GROUP BY 1""",
)
def _(t):
    return d.denial_reasons(t.fact([*d.DENIAL_GROUP_INPUT, "denial_reason"]), t.as_of, t.cfg)


@query("k14_denial_by_payer", f"SELECT payer_type, {_DENIALS} FROM fact WHERE {_YEAR} GROUP BY 1")
def _(t):
    return d.denial_by_payer_type(t.fact([*d.DENIAL_GROUP_INPUT, "payer_type"]), t.as_of)


@query(
    "k15_denial_heat_map",
    f"""SELECT provider_specialty_category, denial_reason, COUNT(*) AS denial_count,
        {usd('denied_amount')} AS total_denied_amount FROM fact WHERE {_D} AND {_since(12)} GROUP BY 1, 2""",
)
def _(t):
    columns = [*d.DENIAL_GROUP_INPUT, "provider_specialty_category", "denial_reason"]
    return d.denial_heat_map(t.fact(columns), t.as_of, t.cfg)


@query(
    "k16_high_risk_providers",
    f"""SELECT * FROM (SELECT provider_id, provider_specialty_category, COUNT(*) AS total_claims,
        {n_if(_D)} AS denied_claims, {DENIAL_PCT} AS denial_rate, {usd('denied_amount')} AS total_denied_amount
        FROM fact WHERE {_since(6)} GROUP BY 1, 2) WHERE denial_rate > 15""",
)
def _(t):
    columns = [*d.DENIAL_GROUP_INPUT, "provider_specialty_category"]
    return d.high_risk_providers(t.fact(columns), t.as_of, t.cfg)


def _risk(level: str) -> str:
    return n_if(f"anomaly_risk_level = '{level}'")


_INVESTIGATE = n_if("requires_investigation")


@query(
    "k17_anomaly_summary",
    f"""SELECT COUNT(*) AS total_anomalies, {_risk('HIGH')} AS high_risk_anomalies,
        {_risk('MEDIUM')} AS medium_risk_anomalies, {_risk('LOW')} AS low_risk_anomalies,
        {_INVESTIGATE} AS requires_investigation, {usd_avg('claim_amount')} AS avg_anomaly_amount,
        max(claim_amount) AS max_anomaly_amount FROM ({ANOMALY_MART})""",
)
def _(t):
    return d.anomaly_summary(anomaly_mart(t, []))


@query(
    "k18_anomaly_trend",
    f"""SELECT {_month_of('anomaly_month')}, COUNT(*) AS total_anomalies, {_risk('HIGH')} AS high_risk_count,
        {_INVESTIGATE} AS investigation_count FROM ({ANOMALY_MART}) WHERE {_since(12)} GROUP BY 1""",
)
def _(t):
    return d.anomaly_trend(anomaly_mart(t), t.as_of, t.cfg)


@query(
    "k19_anomaly_types",
    f"""SELECT {n_if('duplicate_flag')} AS duplicate_claims, {n_if('amount_outlier_flag')} AS amount_outliers,
        {n_if('high_denial_provider_flag')} AS high_denial_provider,
        {n_if('frequent_procedure_flag')} AS frequent_procedures FROM ({ANOMALY_MART})""",
)
def _(t):
    return d.anomaly_types(anomaly_mart(t))


@query(
    "k20_risk_breakdown",
    f"""SELECT anomaly_risk_level, COUNT(*) AS anomaly_count, {usd('claim_amount')} AS total_amount,
        {usd_avg('claim_amount')} AS avg_amount, {_INVESTIGATE} AS investigation_count
        FROM ({ANOMALY_MART}) GROUP BY 1""",
)
def _(t):
    return d.risk_breakdown(anomaly_mart(t, []))


_TIES = ["claim_line_key", "claim_amount", "provider_id", "procedure_code", "submission_date"]


@query(
    "k21_investigation_queue",
    f"""SELECT claim_line_key, claim_id, anomaly_score, anomaly_risk_level, anomaly_reasons, claim_amount,
        provider_specialty_category, payer_type, service_date, requires_investigation FROM ({ANOMALY_MART})
        WHERE requires_investigation AND anomaly_risk_level = 'HIGH'
        ORDER BY anomaly_score DESC, service_date DESC, {', '.join(_TIES)} LIMIT 50""",
)
def _(t):
    columns = ["claim_id", "provider_specialty_category", "payer_type", "service_date", *_TIES]
    return d.investigation_queue(anomaly_mart(t, columns), _TIES)


@query(
    "k22_anomaly_hotspots",
    f"""SELECT member_state, COUNT(*) AS anomaly_count, {usd('claim_amount')} AS total_anomaly_amount,
        avg(anomaly_score) AS avg_risk_score FROM ({ANOMALY_MART}) WHERE {_since(6)} GROUP BY 1 HAVING COUNT(*) > 10""",
)
def _(t):
    return d.anomaly_hotspots(anomaly_mart(t), t.as_of, t.cfg)


@query(
    "k23_utilization_summary",
    f"""WITH m AS (SELECT member_sk, {usd('claim_amount')} AS amount FROM fact WHERE {_since(12)} GROUP BY 1)
        SELECT COUNT(DISTINCT member_sk) AS active_members, COUNT(*) AS total_claims, {usd('claim_amount')} AS total_amount,
        {usd_avg('claim_amount')} AS avg_claim_amount, {ratio('COUNT(*)', 'COUNT(DISTINCT member_sk)')} AS claims_per_member,
        {n_if(f'claim_amount > {C.high_cost}')} AS high_cost_claims,
        (SELECT {n_if(f'amount > {C.high_cost}')} FROM m) AS high_cost_members,
        avg(processing_delay_days) AS avg_processing_delay FROM fact WHERE {_since(12)}""",
)
def _(t):
    return d.utilization_summary(t.fact(d.UTILIZATION_INPUT), t.as_of, t.cfg)


def _use(members: str) -> str:
    return f"""COUNT(DISTINCT member_sk) AS {members}, COUNT(*) AS total_claims, {usd('claim_amount')} AS total_amount,
        {usd_avg('claim_amount')} AS avg_amount, {ratio('COUNT(*)', 'COUNT(DISTINCT member_sk)')} AS claims_per_member"""


@query(
    "k24_utilization_trend",
    f"SELECT {_month_of('utilization_month')}, {_use('active_members')} FROM fact WHERE {_since(24)} GROUP BY 1",
)
def _(t):
    return d.utilization_trend(t.fact(d.UTILIZATION_INPUT), t.as_of, t.cfg)


@query("k25_by_age_group", f"SELECT member_age_group, {_use('unique_members')} FROM fact WHERE {_since(12)} GROUP BY 1")
def _(t):
    return d.by_age_group(t.fact([*d.UTILIZATION_INPUT, "member_age_group"]), t.as_of, t.cfg)


@query(
    "k26_by_gender",
    f"""SELECT * EXCLUDE (claims_per_member) FROM (SELECT member_gender, {_use('unique_members')} FROM fact
        WHERE {_since(12)} AND member_gender IS NOT NULL GROUP BY 1)""",
)
def _(t):
    return d.by_gender(t.fact([*d.UTILIZATION_INPUT, "member_gender"]), t.as_of, t.cfg)


@query(
    "k27_high_cost_members",
    f"""SELECT member_id, member_age_group, member_gender, member_state, total_claims, total_claim_amount,
        avg_claim_amount, denial_rate, unique_providers, is_high_utilization, is_high_cost_member
        FROM ({MEMBER_MART}) WHERE {_MONTH} ORDER BY total_claim_amount DESC, member_id LIMIT 50""",
)
def _(t):
    return d.high_cost_members(member_mart(t, d.in_month))


@query(
    "k28_service_patterns",
    f"""SELECT provider_specialty_category, member_age_group, COUNT(*) AS claim_count, {usd('claim_amount')} AS total_amount,
        {usd_avg('claim_amount')} AS avg_amount FROM fact WHERE {_since(12)} GROUP BY 1, 2""",
)
def _(t):
    columns = ["provider_specialty_category", "member_age_group", "claim_amount", "service_date"]
    return d.service_patterns(t.fact(columns), t.as_of, t.cfg)


FRESH = f"""SELECT *, CAST(floor((epoch({EVENTS_AS_OF}) - floor(epoch(last_update))) / 3600) AS BIGINT)
    AS hours_since_update FROM (
    SELECT 'Runs' AS table_name, max(end_time) AS last_update FROM runs UNION ALL
    SELECT 'Quality Results', max(run_timestamp) FROM quality_results UNION ALL
    SELECT 'Status Events', max(arrival) FROM status_source)"""


def fresh_tables(t):
    return {
        "Runs": (t.runs(), "end_time"),
        "Quality Results": (t.quality_results(), "run_timestamp"),
        "Status Events": (t.events(), "arrival"),
    }


@query("k29_data_freshness", FRESH)
def _(t):
    return d.freshness(fresh_tables(t), t.events_as_of)


@query(
    "k30_pipeline_health",
    f"""SELECT pipeline_name, COUNT(*) AS total_runs, {n_if("status = 'SUCCESS'")} AS successful_runs,
        {n_if("status = 'FAILED'")} AS failed_runs, max(start_time) AS last_run_time,
        avg(CAST(floor((floor(epoch(end_time)) - floor(epoch(start_time))) / 60) AS BIGINT)) AS avg_duration_minutes
        FROM runs WHERE start_time >= {EVENTS_AS_OF} - INTERVAL 7 DAYS GROUP BY 1""",
)
def _(t):
    return d.pipeline_health(t.runs(), t.events_as_of)
