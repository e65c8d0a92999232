"""Queries M: KPI formulas."""


from claimloom.operators import anomaly, kpis
from claimloom.operators.ranking import percentiles
from claimloom.plans.gold import DETECTED
from claimloom.plans.registry import query
from claimloom.plans.sqltext import AS_OF, n_if, rate_avg, ratio, stddev, usd, usd_avg
from claimloom.sources.scratch import written

_D = "claim_status = 'DENIED'"
_DENIAL = ratio(n_if(_D), "COUNT(*)")
_MONTH = "CAST(date_trunc('month', service_date) AS DATE)"
_MONTHLY = f"""SELECT {_MONTH} AS month, COUNT(*) AS total_claims, {usd('paid_amount')} AS paid_amount,
    {_DENIAL} AS denial_rate FROM fact GROUP BY 1"""
_KPI_INPUT = ["service_date", "claim_status", "paid_amount"]


def _change(value: str, lag: int) -> str:
    before = f"lag({value}, {lag}) OVER (ORDER BY month)"
    return f"CASE WHEN {before} > 0 THEN CAST(({value} - {before}) * 100 AS DOUBLE) / {before} END"


_CALENDAR = """SELECT CAST(unnest(generate_series(min(month), max(month), INTERVAL 1 MONTH)) AS DATE) AS month FROM k"""


@query(
    "m01_change_over_months",
    f"""WITH k AS ({_MONTHLY}), cal AS ({_CALENDAR}), dense AS (SELECT cal.month, total_claims FROM cal LEFT JOIN k USING (month))
        SELECT month, total_claims, {_change('total_claims', 1)} AS mom_change,
        {_change('total_claims', 12)} AS yoy_change FROM dense""",
)
def _(t):
    monthly = kpis.monthly_kpis(t.fact(_KPI_INPUT))
    return kpis.change_over(monthly, "total_claims", {"mom_change": 1, "yoy_change": 12})


@query(
    "m01_change_over_quarters",
    f"""WITH q AS (SELECT CAST(date_trunc('quarter', service_date) AS DATE) AS quarter_start,
        {usd('paid_amount')} AS paid_amount FROM fact GROUP BY 1)
        SELECT q.*, CASE WHEN p.paid_amount > 0 THEN (q.paid_amount - p.paid_amount) * 100 / p.paid_amount END AS qoq_change
        FROM q LEFT JOIN q p ON p.quarter_start = q.quarter_start - INTERVAL 3 MONTH""",
)
def _(t):
    return kpis.change_over_quarters(t.fact(["service_date", "paid_amount"]))


@query(
    "m02_denial_colour",
    f"""SELECT month, denial_pct, CASE WHEN denial_pct > 15 THEN 'red' WHEN denial_pct >= 10 THEN 'yellow'
        ELSE 'green' END AS colour FROM (SELECT month, denial_rate * 100 AS denial_pct FROM ({_MONTHLY}))""",
)
def _(t):
    return kpis.denial_colour(t.fact(_KPI_INPUT))


@query(
    "m03_utilization_rate",
    f"""SELECT COUNT(*) AS total_claims, COUNT(DISTINCT member_id) AS members,
        {ratio('COUNT(*)', 'COUNT(DISTINCT member_id)')} / 365 AS utilization_rate FROM claims
        WHERE service_date > {AS_OF} - 365""",
)
def _(t):
    return kpis.utilization_rate(t.fact(["service_date", "member_id"]), 365, t.as_of)


_TOTALS = f"""SELECT provider_id, COUNT(*) AS total_claims, {usd('claim_amount')} AS total_amount,
    {ratio(usd('paid_amount'), usd('claim_amount'))} AS payment_rate, {_DENIAL} AS denial_rate,
    {ratio(n_if("claim_status = 'ADJUSTED'"), 'COUNT(*)')} AS adjusted_rate FROM fact GROUP BY provider_id"""
_TOTAL_INPUT = ["provider_id", "claim_amount", "paid_amount", "claim_status"]


def _totals(t):
    return kpis.provider_totals(t.fact(_TOTAL_INPUT))


@query(
    "m04_provider_score",
    f"""SELECT *, payment_rate * CAST(0.4 AS DOUBLE) + (1 - denial_rate) * CAST(0.3 AS DOUBLE)
        + volume_score * CAST(0.2 AS DOUBLE) + quality_score * CAST(0.1 AS DOUBLE) AS performance_score FROM (
        SELECT provider_id, payment_rate, denial_rate, percent_rank() OVER (ORDER BY total_claims) AS volume_score,
        1 - adjusted_rate AS quality_score FROM ({_TOTALS}))""",
)
def _(t):
    return kpis.provider_score(_totals(t))


@query(
    "m05_year_to_date",
    f"""SELECT month, total_claims, CAST(SUM(total_claims) OVER (PARTITION BY year(month) ORDER BY month) AS BIGINT)
        AS ytd_claims FROM ({_MONTHLY})""",
)
def _(t):
    return kpis.year_to_date(kpis.monthly_kpis(t.fact(_KPI_INPUT)))


@query(
    "m06_same_period_growth",
    f"""WITH k AS ({_MONTHLY}) SELECT k.month, k.total_claims, p.total_claims AS prior_claims,
        CASE WHEN p.total_claims > 0 THEN CAST(k.total_claims - p.total_claims AS DOUBLE) / p.total_claims END AS yoy_growth
        FROM k LEFT JOIN k p ON p.month = k.month - INTERVAL 12 MONTH""",
)
def _(t):
    return kpis.same_period_growth(kpis.monthly_kpis(t.fact(_KPI_INPUT)))


@query(
    "m07_dense_provider_rank",
    f"""SELECT provider_id, total_amount, dense_rank() OVER (ORDER BY total_amount DESC) AS provider_rank
        FROM ({_TOTALS})""",
)
def _(t):
    return kpis.dense_provider_rank(_totals(t))


@query(
    "m08_provider_percentile",
    f"""SELECT provider_id, total_amount, CAST(dense_rank() OVER (ORDER BY total_amount) - 1 AS DOUBLE)
        / COUNT(*) OVER () AS provider_percentile FROM ({_TOTALS})""",
)
def _(t):
    return kpis.provider_percentile(_totals(t))


_THIS = f"date_trunc('quarter', {AS_OF})"
_IMPROVE = f"""SELECT provider_id, {ratio(n_if(f"{_D} AND service_date < {_THIS}"), n_if(f"service_date < {_THIS}"))}
    - {ratio(n_if(f"{_D} AND service_date >= {_THIS}"), n_if(f"service_date >= {_THIS}"))} AS improvement
    FROM claims WHERE service_date >= {_THIS} - INTERVAL 3 MONTH AND service_date < {_THIS} + INTERVAL 3 MONTH
    GROUP BY provider_id"""


def _ranking(name: str, source: str, value: str, order: str) -> str:
    return f"""SELECT '{name}' AS ranking, row_number() OVER (ORDER BY {value} {order}, provider_id) AS place,
        provider_id, CAST({value} AS DOUBLE) AS value FROM {source} WHERE {value} IS NOT NULL QUALIFY place <= 10"""


@query(
    "m09_provider_rankings",
    f"WITH tot AS ({_TOTALS}), imp AS ({_IMPROVE}) "
    + " UNION ALL ".join(
        f"SELECT * FROM ({_ranking(*r)})"
        for r in (
            ("claim_volume", "tot", "total_claims", "DESC"),
            ("claim_amount", "tot", "total_amount", "DESC"),
            ("highest_denial_rate", "tot", "denial_rate", "DESC"),
            ("best_payment_rate", "tot", "payment_rate", "DESC"),
            ("lowest_denial_rate", "tot", "denial_rate", "ASC"),
            ("most_improved", "imp", "improvement", "DESC"),
        )
    ),
)
def _(t):
    fact = t.fact([*_TOTAL_INPUT, "service_date"])
    totals = written(kpis.provider_totals(fact), "totals")  # five lists read it
    return kpis.provider_rankings(totals, kpis.denial_improvement(fact, t.as_of))


def _benchmark(group: str) -> str:
    return f"""SELECT provider_id, '{group}' AS benchmark, {group} AS group_value, denial_rate - gd AS denial_rate_gap,
        payment_rate - gp AS payment_rate_gap FROM b LEFT JOIN (SELECT {group}, {rate_avg('denial_rate')} AS gd,
        {rate_avg('payment_rate')} AS gp FROM b GROUP BY {group}) USING ({group})"""


@query(
    "m10_benchmarks",
    f"""WITH b AS (SELECT t.*, specialty_category, provider_region, network_status FROM ({_TOTALS}) t
        JOIN dim_provider USING (provider_id)) {_benchmark('specialty_category')} UNION ALL
        {_benchmark('provider_region')} UNION ALL {_benchmark('network_status')}""",
)
def _(t):
    attributes = t.dim_provider().select("provider_id", "specialty_category", "provider_region", "network_status")
    totals = _totals(t).join(attributes, "provider_id")
    by_specialty = kpis.benchmark(totals, "specialty_category", len(t.cfg.specialties) + 1)
    by_region = kpis.benchmark(totals, "provider_region", len(t.cfg.regions) + 1)
    return by_specialty.unionByName(by_region).unionByName(kpis.benchmark(totals, "network_status"))


def _anomaly_rate(key: str) -> str:
    return f"""SELECT {key}, COUNT(*) AS total_claims, {n_if('has_anomaly')} AS anomalies,
        {ratio(n_if('has_anomaly'), 'COUNT(*)')} AS anomaly_rate FROM ({DETECTED}) GROUP BY {key}"""


@query("m11_anomaly_rate_provider", _anomaly_rate("provider_id"))
def _(t):
    return kpis.anomaly_rate(anomaly.detect(t.claims(anomaly.DETECTION_INPUT), t.cfg), "provider_id")


@query("m11_anomaly_rate_member", _anomaly_rate("member_id"))
def _(t):
    return kpis.anomaly_rate(anomaly.detect(t.claims(anomaly.DETECTION_INPUT), t.cfg), "member_id")


@query(
    "m12_member_flow",
    f"""WITH a AS (SELECT DISTINCT member_id, {_MONTH} AS month FROM claims),
        f AS (SELECT member_id, min(month) AS month FROM a GROUP BY 1),
        n AS (SELECT month, COUNT(*) AS v FROM f GROUP BY 1),
        r AS (SELECT a.month, COUNT(*) AS v FROM a SEMI JOIN a p ON p.member_id = a.member_id
            AND p.month = a.month - INTERVAL 1 MONTH GROUP BY 1),
        c AS (SELECT CAST(p.month + INTERVAL 1 MONTH AS DATE) AS month, COUNT(*) AS v FROM a p ANTI JOIN a
            ON p.member_id = a.member_id AND a.month = p.month + INTERVAL 1 MONTH GROUP BY 1),
        m AS (SELECT month FROM a UNION SELECT month FROM c)
        SELECT m.month, coalesce(n.v, 0) AS new_members, coalesce(r.v, 0) AS retained_members,
        coalesce(c.v, 0) AS churned_members FROM m LEFT JOIN n USING (month) LEFT JOIN r USING (month)
        LEFT JOIN c USING (month)""",
)
def _(t):
    return kpis.member_flow(t.fact(["member_id", "service_date"]))


@query(
    "m13_cost_percentiles",
    f"""WITH m AS (SELECT {usd('claim_amount')} AS amount FROM claims GROUP BY member_id)
        SELECT p AS percentile, (SELECT a + (b - a) * f FROM (SELECT
            list_extract(list_sort(list(amount)), CAST(floor(p * (COUNT(*) - 1)) AS BIGINT) + 1) AS a,
            list_extract(list_sort(list(amount)), CAST(ceil(p * (COUNT(*) - 1)) AS BIGINT) + 1) AS b,
            p * (COUNT(*) - 1) - floor(p * (COUNT(*) - 1)) AS f FROM m)) AS amount
        FROM (SELECT CAST(unnest([0.25, 0.5, 0.75, 0.9, 0.99]) AS DOUBLE) AS p)""",
)
def _(t):
    from claimloom.functions.exact import money_sum

    cost = t.fact(["member_id", "claim_amount"]).groupBy("member_id").agg(money_sum("claim_amount").alias("amount"))
    return percentiles(cost, "amount", [0.25, 0.5, 0.75, 0.9, 0.99])


@query(
    "m13_seasonal_pattern",
    f"""SELECT service_season, COUNT(*) AS total_claims, {usd('claim_amount')} AS total_amount,
        {usd_avg('claim_amount')} AS avg_amount FROM fact GROUP BY 1""",
)
def _(t):
    return kpis.seasonal_pattern(t.fact(["service_season", "claim_amount"]))


@query(
    "m14_denial_alerts",
    f"""WITH g AS (SELECT provider_id, {_MONTH} AS month, COUNT(*) AS total_claims, {_DENIAL} AS denial_rate
        FROM claims GROUP BY 1, 2) SELECT g.*, p.denial_rate AS previous_rate FROM g JOIN g p
        ON p.provider_id = g.provider_id AND p.month = g.month - INTERVAL 1 MONTH
        WHERE g.denial_rate > 0.2 AND g.denial_rate > p.denial_rate""",
)
def _(t):
    return kpis.denial_alerts(t.fact(["provider_id", "service_date", "claim_status"]))


@query(
    "m15_claims_by_member_and_payer",
    "SELECT member_id, payer_type, COUNT(*) AS row_count FROM fact GROUP BY 1, 2",
)
def _(t):
    from claimloom.operators.marts import distribution

    return distribution(t.fact(["member_id", "payer_type"]), "member_id", "payer_type")


@query(
    "m15_top_diagnoses",
    """SELECT member_state, diagnosis_code, claim_count, place FROM (SELECT member_state, diagnosis_code,
        COUNT(*) AS claim_count, row_number() OVER (PARTITION BY member_state ORDER BY COUNT(*) DESC, diagnosis_code)
        AS place FROM fact GROUP BY 1, 2) WHERE place <= 3""",
)
def _(t):
    return kpis.top_per_group(t.fact(["member_state", "diagnosis_code"]), "member_state", "diagnosis_code")


@query("m15_diagnosis_frequency", "SELECT diagnosis_code, COUNT(*) AS row_count FROM claims GROUP BY 1")
def _(t):
    from claimloom.operators.marts import distribution

    return distribution(t.claims(["diagnosis_code"]), "diagnosis_code")


_DIMENSIONS = ["provider_specialty_category", "provider_region", "member_state", "procedure_code", "payer_type"]


@query(
    "m16_denials_by_dimension",
    " UNION ALL ".join(
        f"""SELECT '{c}' AS dimension, CAST({c} AS VARCHAR) AS value, {_MONTH} AS month, COUNT(*) AS total_claims,
        {n_if(_D)} AS denied_claims, {_DENIAL} AS denial_rate, {usd('denied_amount')} AS denied_amount
        FROM fact GROUP BY {c}, {_MONTH}"""
        for c in _DIMENSIONS
    ),
)
def _(t):
    return kpis.denials_by(t.fact([*_DIMENSIONS, "service_date", "claim_status", "denied_amount"]), _DIMENSIONS)


def _scatter(key: str) -> str:
    cents = "CAST(round(claim_amount * 100) AS BIGINT)"
    return f"""SELECT {key}, COUNT(*) AS claim_count, {usd_avg('claim_amount')} AS avg_amount,
        {stddev(cents)} / 100 AS stddev_amount FROM claims GROUP BY {key}"""


@query("m17_amount_vs_frequency_provider", _scatter("provider_id"))
def _(t):
    return kpis.amount_vs_frequency(t.fact(["provider_id", "claim_amount"]), "provider_id")


@query("m17_amount_vs_frequency_member", _scatter("member_id"))
def _(t):
    return kpis.amount_vs_frequency(t.fact(["member_id", "claim_amount"]), "member_id")


_FILTERED = "claim_id claim_line_id claim_amount service_date payer_type provider_specialty claim_status provider_region".split()


@query(
    "m18_dashboard_filter",
    f"""SELECT {', '.join(_FILTERED)} FROM fact WHERE service_date > {AS_OF} - 365 AND service_date <= {AS_OF}
        AND payer_type = 'Commercial' AND provider_specialty IN ('Cardiology', 'Pediatrics')
        AND claim_status IN ('PAID', 'DENIED') AND provider_region IN ('West', 'East')""",
)
def _(t):
    return kpis.dashboard_filter(
        t.fact(_FILTERED),
        t.as_of,
        days=365,
        payer_type=["Commercial"],
        provider_specialty=["Cardiology", "Pediatrics"],
        claim_status=["PAID", "DENIED"],
        provider_region=["West", "East"],
    )


def _utilization(key: str) -> str:
    return f"""SELECT {key}, COUNT(*) AS total_claims, COUNT(DISTINCT member_id) AS members, {usd('claim_amount')} AS total_amount,
        {ratio('COUNT(*)', 'COUNT(DISTINCT member_id)')} AS claims_per_member FROM fact GROUP BY 1"""


@query("m19_utilization_by_plan", _utilization("member_plan"))
def _(t):
    return kpis.utilization_by(t.fact(["member_plan", "member_id", "claim_amount"]), "member_plan")


@query("m19_utilization_by_eligibility", _utilization("member_is_eligible"))
def _(t):
    return kpis.utilization_by(t.fact(["member_is_eligible", "member_id", "claim_amount"]), "member_is_eligible")


def _mix(attribute: str) -> str:
    return f"""SELECT provider_id, '{attribute}' AS attribute, {attribute} AS value, COUNT(DISTINCT member_id) AS members,
        CAST(COUNT(DISTINCT member_id) AS DOUBLE) / SUM(COUNT(DISTINCT member_id)) OVER (PARTITION BY provider_id) AS share
        FROM fact GROUP BY provider_id, {attribute}"""


@query("m20_patient_mix", f"{_mix('member_age_group')} UNION ALL {_mix('member_state')}")
def _(t):
    attributes = ["member_age_group", "member_state"]
    members = t.dim_member().filter("is_current").withColumnRenamed("state", "member_state")
    return kpis.patient_mix(t.fact(["provider_id", "member_id"]), attributes, members=members)


_AGES = ["Minor", "Adult 18-34", "Adult 35-49", "Adult 50-64", "Senior 65+"]


@query(
    "m21_service_use",
    f"""SELECT procedure_category, COUNT(*) AS total_claims, {usd('claim_amount')} AS total_amount, """
    + ", ".join(f"""{n_if(f"member_age_group = '{a}'")} AS {kpis.label_column(a)}""" for a in _AGES)
    + " FROM fact GROUP BY 1",
)
def _(t):
    return kpis.service_use(t.fact(["procedure_category", "claim_amount", "member_age_group"]), _AGES)
