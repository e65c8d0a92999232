"""Queries A and W: marts, published summaries, ranks and growth."""

from pyspark.sql import functions as F

from claimloom.operators import anomaly, marts
from claimloom.operators.dimensions import month_dim
from claimloom.plans.model import SETTINGS as C
from claimloom.plans.registry import query
from claimloom.plans.sqltext import n_if, pct, rate_avg, ratio, usd, usd_avg
from claimloom.sources.scratch import written

STATUSES = ("paid", "denied", "pending", "adjusted")


def _on(prefix: str, names) -> str:
    return ", ".join(f"{prefix}{n}" for n in names)


# -- SQL of the marts --------------------------------------------------------------------------
PROVIDER_MART = f"""SELECT *, {ratio('denied_claims', 'total_claims')} AS denial_rate,
    {ratio('paid_claims', 'total_claims')} AS paid_rate, {ratio('pending_claims', 'total_claims')} AS pending_rate,
    {ratio('adjusted_claims', 'total_claims')} AS adjusted_rate,
    {ratio('out_of_network_claims', 'total_claims')} AS out_of_network_rate,
    {ratio('high_value_claims', 'total_claims')} AS high_value_rate,
    {ratio('total_paid_amount', 'total_claim_amount')} AS payment_rate,
    {ratio('total_claims', 'unique_members')} AS avg_claim_per_member FROM (
    SELECT {_on('', marts.PROVIDER_KEYS)}, COUNT(*) AS total_claims, {usd('claim_amount')} AS total_claim_amount,
    {usd_avg('claim_amount')} AS avg_claim_amount, max(claim_amount) AS max_claim_amount,
    min(claim_amount) AS min_claim_amount,
    {', '.join(f"{usd(f'{s}_amount')} AS total_{s}_amount, {n_if(f'is_{s}_claim')} AS {s}_claims" for s in STATUSES)},
    {n_if('is_out_of_network')} AS out_of_network_claims, {n_if('is_high_value_claim')} AS high_value_claims,
    COUNT(DISTINCT member_sk) AS unique_members, avg(processing_delay_days) AS avg_processing_delay_days,
    avg(member_age) AS avg_member_age FROM fact GROUP BY {_on('', marts.PROVIDER_KEYS)})"""
_D = "claim_status = 'DENIED'"
DENIAL_MART = f"""SELECT *, make_date(service_year, service_month, 1) AS denial_date,
    {ratio('denied_claims_count', 'total_claims_count')} AS denial_count_rate,
    {ratio('denied_amount', 'total_amount')} AS denial_amount_rate FROM (
    SELECT d.*, total_claims_count, total_amount FROM (SELECT {_on('', marts.DENIAL_KEYS)},
        COUNT(*) AS denied_claims_count, {usd('claim_amount')} AS denied_amount,
        {usd_avg('claim_amount')} AS avg_denied_amount, max(claim_amount) AS max_denied_amount,
        min(claim_amount) AS min_denied_amount, COUNT(DISTINCT provider_sk) AS unique_providers,
        COUNT(DISTINCT member_sk) AS unique_members, COUNT(DISTINCT claim_id) AS unique_claims_denied,
        avg(processing_delay_days) AS avg_processing_delay_days FROM fact WHERE {_D}
        GROUP BY {_on('', marts.DENIAL_KEYS)}) d
    JOIN (SELECT {_on('', marts.DENIAL_KEYS)}, COUNT(*) AS total_claims_count, {usd('claim_amount')} AS total_amount
        FROM fact GROUP BY {_on('', marts.DENIAL_KEYS)}) t USING ({_on('', marts.DENIAL_KEYS)}))"""
MEMBER_MART = f"""SELECT *, {ratio('denied_claims', 'total_claims')} AS denial_rate,
    {ratio('high_value_claims', 'total_claims')} AS high_value_rate,
    {ratio('total_paid_amount', 'total_claim_amount')} AS payment_rate,
    {ratio('total_claims', 'unique_providers')} AS avg_claims_per_provider,
    make_date(service_year, service_month, 1) AS utilization_date,
    total_claims > {C.high_utilization} AS is_high_utilization,
    total_claim_amount > {C.high_cost} AS is_high_cost_member FROM (
    SELECT {_on('', marts.MEMBER_KEYS)}, COUNT(*) AS total_claims, {usd('claim_amount')} AS total_claim_amount,
    {usd_avg('claim_amount')} AS avg_claim_amount, max(claim_amount) AS max_claim_amount,
    {usd('paid_amount')} AS total_paid_amount, {usd('denied_amount')} AS total_denied_amount,
    {n_if('is_paid_claim')} AS paid_claims, {n_if('is_denied_claim')} AS denied_claims,
    {n_if('is_high_value_claim')} AS high_value_claims, COUNT(DISTINCT provider_sk) AS unique_providers,
    COUNT(DISTINCT provider_specialty_category) AS unique_specialties, COUNT(DISTINCT payer_sk) AS unique_payers,
    COUNT(DISTINCT diagnosis_code) AS unique_diagnoses, COUNT(DISTINCT procedure_code) AS unique_procedures,
    avg(processing_delay_days) AS avg_processing_delay_days FROM fact GROUP BY {_on('', marts.MEMBER_KEYS)})"""


def _window(keys, days: int, more: int, flag: str) -> str:
    return f"""COUNT(*) OVER (PARTITION BY {_on('', keys)} ORDER BY service_date
        RANGE BETWEEN CURRENT ROW AND INTERVAL {days} DAY FOLLOWING) > {more} AS {flag}"""


DETECTED = f"""SELECT *, duplicate_flag OR amount_outlier_flag OR high_denial_provider_flag OR frequent_procedure_flag
    AS has_anomaly, concat_ws(', ', CASE WHEN duplicate_flag THEN 'Potential duplicate claim' END,
    CASE WHEN amount_outlier_flag THEN 'Unusually high claim amount' END,
    CASE WHEN high_denial_provider_flag THEN 'High denial rate provider' END,
    CASE WHEN frequent_procedure_flag THEN 'Frequent procedure for member' END) AS anomaly_reasons FROM (
    SELECT fact.*, {_window(C.duplicate_keys, C.duplicate_days, 1, 'duplicate_flag')},
    {_window(C.frequent_keys, C.frequent_days, C.frequent_count, 'frequent_procedure_flag')},
    claim_amount > av * {C.outlier_multiplier} AS amount_outlier_flag, dr > {C.denial_threshold} AS high_denial_provider_flag
    FROM fact JOIN (SELECT provider_id, {usd('claim_amount')} / COUNT(claim_amount) AS av,
        {ratio(n_if(_D), 'COUNT(*)')} AS dr FROM fact GROUP BY provider_id) USING (provider_id))"""
ANOMALY_COLUMNS = (
    *anomaly.MART_INPUT, "duplicate_flag", "amount_outlier_flag", "high_denial_provider_flag",
    "frequent_procedure_flag", "anomaly_reasons",
)
ANOMALY_MART = f"""SELECT *, CASE WHEN anomaly_score >= 50 THEN 'HIGH' WHEN anomaly_score >= 25 THEN 'MEDIUM'
    ELSE 'LOW' END AS anomaly_risk_level, anomaly_score >= 50 AS requires_investigation FROM (
    SELECT {_on('', ANOMALY_COLUMNS)}, CASE WHEN duplicate_flag THEN 30 ELSE 0 END
    + CASE WHEN amount_outlier_flag THEN 25 ELSE 0 END + CASE WHEN high_denial_provider_flag THEN 20 ELSE 0 END
    + CASE WHEN frequent_procedure_flag THEN 15 ELSE 0 END
    + CASE WHEN claim_amount > {C.score_amount} THEN 10 ELSE 0 END AS anomaly_score
    FROM ({DETECTED}) WHERE has_anomaly)"""
_ORDER = "total_claim_amount DESC, provider_id, service_month, provider_network_status, provider_sk"
SCORECARD = f"""SELECT m.*, p.provider_name, p.facility_name, p.city AS provider_city, p.state AS provider_state,
    {', '.join(f"row_number() OVER (PARTITION BY {_on('m.', by)} ORDER BY m.{_ORDER.replace(', ', ', m.')}) AS {name}"
               for name, by in marts.RANK_GROUPS.items())},
    CASE WHEN total_claim_amount >= 1000000 THEN 'High Volume' WHEN total_claim_amount >= 100000 THEN 'Medium Volume'
        ELSE 'Low Volume' END AS volume_category,
    CASE WHEN denial_rate <= 0.05 THEN 'Excellent' WHEN denial_rate <= 0.10 THEN 'Good'
        WHEN denial_rate <= 0.20 THEN 'Average' ELSE 'Poor' END AS denial_performance_category,
    CASE WHEN avg_claim_amount >= 500 THEN 'High Value' WHEN avg_claim_amount >= 200 THEN 'Medium Value'
        ELSE 'Low Value' END AS value_category
    FROM ({PROVIDER_MART}) m LEFT JOIN dim_provider p ON m.provider_sk = p.provider_sk"""
_LINE = "OVER (PARTITION BY payer_type, provider_specialty_category ORDER BY service_year, service_quarter)"
_PREV = f"CASE WHEN lag(service_year * 4 + service_quarter) {_LINE} = service_year * 4 + service_quarter - 1 THEN"
GROWTH = f"""SELECT *, CASE WHEN g >= 0.10 THEN 'Growing Fast' WHEN g >= 0.05 THEN 'Growing Moderate'
    WHEN g <= -0.10 THEN 'Declining Fast' WHEN g <= -0.05 THEN 'Declining Moderate' ELSE 'Stable' END
    AS denial_trend_category FROM (SELECT *, CASE WHEN prev_quarter_denials > 0 THEN
    CAST(denied_claims_count - prev_quarter_denials AS DOUBLE) / prev_quarter_denials END AS g,
    CASE WHEN prev_quarter_denied_amount > 0 THEN
    (denied_amount - prev_quarter_denied_amount) / prev_quarter_denied_amount END AS qoq_denial_amount_growth FROM (
    SELECT *, {_PREV} lag(denied_claims_count) {_LINE} END AS prev_quarter_denials,
    {_PREV} lag(denied_amount) {_LINE} END AS prev_quarter_denied_amount FROM (
    SELECT payer_type, provider_specialty_category, service_year, service_quarter,
    {n_if(_D)} AS denied_claims_count, {usd('denied_amount')} AS denied_amount FROM fact
    GROUP BY ALL HAVING {n_if(_D)} > 0)))"""
GROWTH = f"SELECT * EXCLUDE (g), g AS qoq_denial_count_growth FROM ({GROWTH})"


# -- marts ---------------------------------------------------------------------------------------
def provider_mart(t, period=None):
    fact = t.fact([*marts.PROVIDER_INPUT, *{"service_date"}.difference(marts.PROVIDER_INPUT)])
    return marts.provider_performance(fact if period is None else period(fact, t.as_of), t.frames)


def denial_mart(t):
    return marts.denial_trends(t.fact(marts.DENIAL_INPUT))


def denial_totals(t):
    """The mart without its distinct counts."""
    return marts.denial_trends(t.fact(marts.DENIAL_TOTALS_INPUT), distinct=False)


def member_mart(t, period=None):
    fact = t.fact(marts.MEMBER_INPUT)
    return marts.member_utilization(fact if period is None else period(fact, t.as_of), t.frames, t.cfg)


def anomaly_mart(t, columns=anomaly.MART_INPUT):
    """The mart, or some of its claim and dimension columns: dimensions that none of them comes from are not joined."""

    def widen(rows, columns):
        return t.fact(columns, t.with_payer(rows) if "payer_type" in columns else rows)

    return anomaly.claim_anomalies(t.claims(anomaly.CLAIM_INPUT), t.cfg, widen, columns)


@query("a01_provider_performance", PROVIDER_MART)
def _(t):
    return provider_mart(t)


@query("a01_provider_scorecard", SCORECARD)
def _(t):
    return marts.provider_scorecard(provider_mart(t), t.dim_provider())


@query("a02_denial_trends", DENIAL_MART)
def _(t):
    return denial_mart(t)


_MONTH_NAMES = """'Q' || CAST(ceil(m.service_month / 3.0) AS INTEGER) AS quarter_name,
    monthname(make_date(m.service_year, m.service_month, 1)) AS month_name,
    CASE WHEN m.service_month IN (12, 1, 2) THEN 'Winter' WHEN m.service_month < 6 THEN 'Spring'
        WHEN m.service_month < 9 THEN 'Summer' ELSE 'Fall' END AS season,
    m.service_year + CASE WHEN m.service_month >= 10 THEN 1 ELSE 0 END AS fiscal_year,
    (m.service_month + 2) % 12 // 3 + 1 AS fiscal_quarter"""


@query(
    "a02_denial_scorecard",
    f"""SELECT m.*, {_MONTH_NAMES}, prev_quarter_denials, prev_quarter_denied_amount, qoq_denial_count_growth,
        qoq_denial_amount_growth, denial_trend_category,
        CASE WHEN m.denied_claims_count >= 100 THEN 'High Volume Denials' WHEN m.denied_claims_count >= 50
            THEN 'Medium Volume Denials' ELSE 'Low Volume Denials' END AS denial_volume_category,
        CASE WHEN denial_count_rate >= 0.20 THEN 'High Denial Rate' WHEN denial_count_rate >= 0.10
            THEN 'Medium Denial Rate' ELSE 'Low Denial Rate' END AS denial_rate_category,
        CASE WHEN avg_denied_amount >= 1000 THEN 'High Value Denials' WHEN avg_denied_amount >= 500
            THEN 'Medium Value Denials' ELSE 'Low Value Denials' END AS denial_value_category
        FROM ({DENIAL_MART}) m LEFT JOIN ({GROWTH}) g ON m.payer_type IS NOT DISTINCT FROM g.payer_type
        AND m.provider_specialty_category IS NOT DISTINCT FROM g.provider_specialty_category
        AND m.service_year IS NOT DISTINCT FROM g.service_year AND m.service_quarter IS NOT DISTINCT FROM g.service_quarter""",
)
def _(t):
    mart = written(denial_mart(t), "denials")
    return marts.denial_scorecard(mart, marts.denial_growth(mart), month_dim(t.dim_date()))


@query("a03_member_utilization", MEMBER_MART)
def _(t):
    return member_mart(t)


@query("a04_claim_anomalies", ANOMALY_MART)
def _(t):
    return anomaly_mart(t)


@query(
    "a05_provider_monthly",
    f"""SELECT provider_id, provider_specialty_category, service_year, service_month,
        CAST(SUM(total_claims) AS BIGINT) AS total_claims, {usd('total_claim_amount')} AS total_amount,
        {usd_avg('total_claim_amount')} AS avg_amount, {usd('total_denied_amount')} AS total_denied,
        {rate_avg('denial_rate')} AS avg_denial_rate, CAST(SUM(unique_members) AS BIGINT) AS unique_members
        FROM ({PROVIDER_MART}) GROUP BY ALL""",
)
def _(t):
    return marts.provider_monthly(provider_mart(t))


_DENIAL_INPUT = """service_year service_month payer_type provider_specialty_category is_denied_claim denied_amount
    provider_id""".split()


@query(
    "a06_denial_monthly",
    f"""SELECT service_year, service_month, payer_type, provider_specialty_category,
        {n_if(_D)} AS total_denied_claims, {usd('denied_amount')} AS total_denied_amount,
        {ratio(n_if(_D), 'COUNT(*)')} AS denial_rate,
        COUNT(DISTINCT CASE WHEN {_D} THEN provider_id END) AS affected_providers
        FROM fact GROUP BY ALL HAVING {n_if(_D)} > 0""",
)
def _(t):
    return marts.denial_monthly(t.fact(_DENIAL_INPUT))


@query(
    "a07_provider_quarterly",
    f"""SELECT provider_id, provider_specialty_category, service_year, service_quarter,
        CAST(SUM(total_claims) AS BIGINT) AS total_claims, {usd('total_claim_amount')} AS total_amount,
        {rate_avg('denial_rate')} AS avg_denial_rate FROM ({PROVIDER_MART}) GROUP BY ALL""",
)
def _(t):
    return marts.provider_quarterly(provider_mart(t))


_SUMMARY = """provider_id, provider_name, provider_specialty_category, service_year, service_quarter, service_month,
    total_claims, total_claim_amount, avg_claim_amount, denial_rate, paid_rate, unique_members,
    specialty_rank_quarter, volume_category, denial_performance_category"""


@query(
    "a08_provider_summary",
    f"SELECT {_SUMMARY} FROM ({SCORECARD}) WHERE provider_id = 7 AND service_year = 2000 AND service_quarter = 3",
)
def _(t):
    quarter = lambda fact, _: fact.filter("service_date >= DATE '2000-07-01' AND service_date < DATE '2000-10-01'")
    card = marts.provider_scorecard(provider_mart(t, quarter), t.dim_provider(), ["specialty_rank_quarter"])
    return marts.provider_summary(card, 7, 2000, 3)


@query(
    "a09_denial_by_payer",
    f"""SELECT m.payer_type, m.provider_specialty_category, m.service_year, m.service_quarter, m.denied_claims_count,
        m.denied_amount, denial_count_rate, denial_amount_rate, qoq_denial_count_growth, denial_trend_category
        FROM ({DENIAL_MART}) m LEFT JOIN ({GROWTH}) g ON m.payer_type = g.payer_type AND
        m.provider_specialty_category = g.provider_specialty_category AND m.service_year = g.service_year
        AND m.service_quarter = g.service_quarter WHERE m.payer_type = 'Government'
        AND denial_date BETWEEN DATE '1999-01-01' AND DATE '1999-06-30'""",
)
def _(t):
    start, end = F.lit("1999-01-01").cast("date"), F.lit("1999-06-30").cast("date")
    return marts.denial_by_payer(t.fact(marts.PAYER_DENIAL_INPUT), "Government", start, end)


@query(
    "a10_executive_summary",
    f"""SELECT make_date(service_year, service_month, 1) AS report_month, COUNT(DISTINCT claim_id) AS total_claims,
        {usd('claim_amount')} AS total_amount, {usd('paid_amount')} AS paid_amount,
        {pct(n_if(_D), 'COUNT(*)')} AS denial_rate, COUNT(DISTINCT provider_id) AS active_providers,
        COUNT(DISTINCT member_sk) AS active_members, avg(processing_delay_days) AS avg_processing_delay
        FROM fact GROUP BY service_year, service_month""",
)
def _(t):
    columns = """service_year service_month claim_id claim_amount paid_amount claim_status provider_id member_sk
        processing_delay_days""".split()
    return marts.executive_summary(t.fact(columns))


@query(
    "a11_provider_monthly_view",
    f"""SELECT m.provider_id, p.provider_name, provider_specialty_category,
        make_date(service_year, service_month, 1) AS performance_month, total_claims, total_claim_amount, denial_rate,
        payment_rate, unique_members FROM ({PROVIDER_MART}) m LEFT JOIN dim_provider p ON m.provider_sk = p.provider_sk""",
)
def _(t):
    names = t.dim_provider().select("provider_sk", "provider_name")
    return marts.provider_monthly_view(provider_mart(t).join(names, "provider_sk", "left"))


@query(
    "a11_denial_monthly_view",
    f"""SELECT make_date(service_year, service_month, 1) AS denial_month, payer_type, provider_specialty_category,
        denied_claims_count, denied_amount, denial_count_rate FROM ({DENIAL_MART})""",
)
def _(t):
    return marts.denial_monthly_view(denial_totals(t))


@query(
    "a12_financial_summary",
    f"""SELECT {usd('claim_amount')} AS total_amount, {usd_avg('claim_amount')} AS avg_amount,
        min(claim_amount) AS min_amount, max(claim_amount) AS max_amount,
        {', '.join(f"{usd(f'{s}_amount')} AS total_{s}" for s in STATUSES)} FROM fact""",
)
def _(t):
    return marts.financial_summary(t.fact(["claim_amount", *[f"{s}_amount" for s in STATUSES]]))


@query("a12_status_distribution", "SELECT claim_status, COUNT(*) AS row_count FROM claims GROUP BY claim_status")
def _(t):
    return marts.distribution(t.claims(["claim_status"]), "claim_status")


@query(
    "a13_by_specialty",
    "SELECT provider_specialty_category, COUNT(*) AS row_count FROM fact GROUP BY provider_specialty_category",
)
def _(t):
    return marts.distribution(t.fact(["provider_specialty_category"]), "provider_specialty_category")


def _insight(key: str, mart: str, count: str, amount: str, rate: str | None) -> str:
    rated = f", {rate_avg(rate)} AS avg_rate" if rate else ""
    return f"""SELECT {key}, CAST(SUM({count}) AS BIGINT) AS total_claims, {usd(amount)} AS total_amount{rated}
        FROM ({mart}) GROUP BY {key}"""


@query(
    "a14_specialty_insight",
    _insight("provider_specialty", PROVIDER_MART, "total_claims", "total_claim_amount", "denial_rate"),
)
def _(t):
    return marts.insight(provider_mart(t), "provider_specialty", "total_claims", "total_claim_amount", "denial_rate")


@query(
    "a14_payer_insight",
    _insight("payer_type", DENIAL_MART, "denied_claims_count", "denied_amount", "denial_count_rate"),
)
def _(t):
    return marts.insight(denial_totals(t), "payer_type", "denied_claims_count", "denied_amount", "denial_count_rate")


@query(
    "a14_age_insight",
    _insight("member_age_group", MEMBER_MART, "total_claims", "total_claim_amount", None),
)
def _(t):
    return marts.insight(member_mart(t), "member_age_group", "total_claims", "total_claim_amount")


@query(
    "a14_risk_insight",
    f"""SELECT anomaly_risk_level, COUNT(*) AS row_count FROM ({ANOMALY_MART}) GROUP BY anomaly_risk_level""",
)
def _(t):
    return marts.distribution(anomaly_mart(t, []), "anomaly_risk_level")


@query(
    "a15_member_distributions",
    "SELECT gender, plan_id, COUNT(*) AS row_count FROM members GROUP BY ALL",
)
def _(t):
    return marts.distribution(t.members(), "gender", "plan_id")


@query(
    "a15_provider_distributions",
    "SELECT network_status, specialty, termination_date IS NULL AS is_open, COUNT(*) AS row_count FROM providers GROUP BY ALL",
)
def _(t):
    open_ended = t.providers().withColumn("is_open", F.col("termination_date").isNull())
    return marts.distribution(open_ended, "network_status", "specialty", "is_open")


@query(
    "a15_age_statistics",
    """SELECT COUNT(member_age) AS value_count, avg(member_age) AS mean,
        sqrt((CAST(SUM(member_age * member_age) AS DOUBLE) - CAST(SUM(member_age) AS DOUBLE) * CAST(SUM(member_age) AS DOUBLE)
        / COUNT(*)) / (COUNT(*) - 1)) AS stddev, CAST(min(member_age) AS INTEGER) AS min,
        CAST(max(member_age) AS INTEGER) AS max FROM dim_member""",
)
def _(t):
    return marts.describe_number(t.dim_member(), "member_age")


# -- windows -------------------------------------------------------------------------------------
@query(
    "w01_top_one_per_key",
    """SELECT member_id, claim_id, claim_line_id, claim_amount FROM unique_claims QUALIFY row_number() OVER
        (PARTITION BY member_id ORDER BY claim_amount DESC, claim_id, claim_line_id) = 1""",
)
def _(t):
    from claimloom.operators.changes import latest

    claims = t.unique_claims(["member_id", "claim_id", "claim_line_id", "claim_amount"])
    order = [F.col("claim_amount").desc(), F.col("claim_id"), F.col("claim_line_id")]
    return latest(claims, ["member_id"], order)


_RANKED = "provider_id service_year service_quarter service_month total_claim_amount".split()


@query(
    "w02_four_ranks",
    f"SELECT {', '.join(_RANKED)}, {', '.join(marts.RANK_GROUPS)} FROM ({SCORECARD})",
)
def _(t):
    return marts.with_four_ranks(provider_mart(t)).select(*_RANKED, *marts.RANK_GROUPS)


def _rollup(grain: str) -> str:
    return f"""SELECT *, row_number() OVER (PARTITION BY {grain}, provider_specialty_category
        ORDER BY total_claim_amount DESC, provider_id) AS true_rank FROM (SELECT provider_id, {grain},
        provider_specialty_category, {usd('claim_amount')} AS total_claim_amount FROM fact GROUP BY ALL)"""


@query("w03_quarter_rank", _rollup("service_year, service_quarter"))
def _(t):
    return marts.rollup_rank(provider_mart(t), ["service_year", "service_quarter"], "true_rank")


@query("w03_year_rank", _rollup("service_year"))
def _(t):
    return marts.rollup_rank(provider_mart(t), ["service_year"], "true_rank")


@query("w04_denial_growth", GROWTH)
def _(t):
    return marts.denial_growth(marts.quarterly_denials(t.fact([*marts.QUARTER_KEYS, "claim_status", "denied_amount"])))


_X = "claim_id, claim_line_id, claim_line_key, claim_amount"
_X_INPUT = [*_X.split(", "), "provider_id", "member_id", "diagnosis_code", "procedure_code", "service_date", "claim_status"]


def _x_sql(flag: str) -> str:
    return f"SELECT {_X}, {flag} FROM ({DETECTED})"


def _x_rows(df, flag):
    return df.select(*_X.split(", "), flag)


@query("x01_duplicate_claims", _x_sql("duplicate_flag"))
def _(t):
    found = anomaly.duplicates(t.fact(_X_INPUT), t.cfg.duplicate_keys, t.cfg.duplicate_days)
    return _x_rows(found, "duplicate_flag")


@query("x02_amount_outliers", _x_sql("amount_outlier_flag"))
def _(t):
    return _x_rows(anomaly.outliers(t.fact(_X_INPUT), t.cfg.outlier_multiplier), "amount_outlier_flag")


@query("x03_high_denial_providers", _x_sql("high_denial_provider_flag"))
def _(t):
    return _x_rows(anomaly.high_denial(t.fact(_X_INPUT), t.cfg.denial_threshold), "high_denial_provider_flag")


@query("x04_frequent_procedures", _x_sql("frequent_procedure_flag"))
def _(t):
    found = anomaly.frequent(t.fact(_X_INPUT), t.cfg.frequent_keys, t.cfg.frequent_days, t.cfg.frequent_count)
    return _x_rows(found, "frequent_procedure_flag")


@query("x05_combined", f"SELECT {_X}, anomaly_reasons, has_anomaly FROM ({DETECTED})")
def _(t):
    return anomaly.detect(t.fact(_X_INPUT), t.cfg).select(*_X.split(", "), "anomaly_reasons", "has_anomaly")
