"""Queries Q: data quality."""

from functools import reduce
from operator import or_

from pyspark.sql import functions as F

from claimloom.config import REQUIRED
from claimloom.operators import audit, quality
from claimloom.plans.model import SETTINGS
from claimloom.plans.registry import query
from claimloom.plans.sqltext import AGE, AS_OF, EVENTS_AS_OF, n_if, rate_avg

QUALITY_INPUT = """claim_id claim_line_id member_id provider_id claim_amount claim_status place_of_service
    service_date submission_date diagnosis_code procedure_code""".split()


def _missing(dataset: str) -> list[tuple[str, str, str]]:
    return [(f"null_{c}", f"Missing {c}", f"{c} IS NULL") for c in REQUIRED[dataset]]


# (rule, reason, condition) of the SQL side, in rule order.
CLAIM = _missing("claims") + [
    ("invalid_amounts", "Amount below minimum", "claim_amount < 0"),
    ("invalid_amounts", "Amount above maximum", f"claim_amount > {SETTINGS.amount_max}"),
    ("invalid_statuses", "Invalid status", "claim_status NOT IN ('PENDING', 'PAID', 'DENIED', 'ADJUSTED')"),
    ("invalid_place_of_service", "Invalid place of service", "place_of_service NOT IN ('1', '2', '3', '4')"),
    ("future_service_dates", "Future service date", f"service_date > {AS_OF}"),
    ("invalid_date_order", "Invalid date order", "service_date > submission_date"),
    ("invalid_diagnosis_codes", "Invalid diagnosis code", f"NOT regexp_matches(diagnosis_code, '{SETTINGS.icd_pattern}')"),
    (
        "invalid_procedure_codes",
        "Invalid procedure code",
        f"NOT regexp_matches(CAST(procedure_code AS VARCHAR), '{SETTINGS.cpt_pattern}')",
    ),
]
MEMBER = _missing("members") + [
    ("invalid_genders", "Invalid gender", "gender NOT IN ('M', 'F')"),
    ("invalid_age", "Invalid age", f"NOT ({AGE} BETWEEN 0 AND 120)"),
    ("future_dob", "Future date of birth", f"dob > {AS_OF}"),
    ("invalid_eligibility_dates", "Invalid eligibility dates", "eligibility_start_date > eligibility_end_date"),
]
PROVIDER = _missing("providers") + [
    ("invalid_network_status", "Invalid network status", "network_status NOT IN ('IN_NETWORK', 'OUT_OF_NETWORK')"),
    ("invalid_dates", "Invalid date range", "termination_date < effective_date"),
    ("invalid_zip_codes", "Invalid ZIP code", "NOT regexp_matches(zip_code, '^[0-9]{5}$')"),
]


def _reasons(rules) -> str:
    return "concat_ws(', ', " + ", ".join(f"CASE WHEN {c} THEN '{label}' END" for _, label, c in rules) + ")"


def _any(rules, name: str) -> str:
    return " OR ".join(f"coalesce({c}, FALSE)" for rule, _, c in rules if rule == name)


_CLAIM_REASONS = _reasons(CLAIM)


@query("q01_claim_rules", f"SELECT claim_id, claim_line_id, {_CLAIM_REASONS} AS quarantine_reasons FROM claims")
def _(t):
    flagged = quality.flag(t.claims(QUALITY_INPUT), quality.claim_rules(t.cfg, t.as_of))
    return flagged.select("claim_id", "claim_line_id", quality.REASONS)


@query("q02_member_rules", f"SELECT member_id, {_reasons(MEMBER)} AS quarantine_reasons FROM members")
def _(t):
    flagged = quality.flag(t.members(), quality.member_rules(t.cfg, t.as_of))
    return flagged.select("member_id", quality.REASONS)


@query("q03_provider_rules", f"SELECT provider_id, {_reasons(PROVIDER)} AS quarantine_reasons FROM providers")
def _(t):
    flagged = quality.flag(t.providers(), quality.provider_rules(t.cfg))
    return flagged.select("provider_id", quality.REASONS)


def _flagged(t):
    return quality.flag(t.claims(QUALITY_INPUT), quality.claim_rules(t.cfg, t.as_of))


@query("q04_clean", f"SELECT {', '.join(QUALITY_INPUT)} FROM claims WHERE {_CLAIM_REASONS} = ''")
def _(t):
    return quality.split(_flagged(t))[0]


@query(
    "q04_quarantine",
    f"""SELECT claim_id, claim_line_id, {_CLAIM_REASONS} AS quarantine_reasons, 'run-1' AS quarantine_run_id,
        {AS_OF} AS quarantine_timestamp FROM claims WHERE {_CLAIM_REASONS} <> ''""",
)
def _(t):
    rows = quality.quarantine(_flagged(t), "run-1", t.as_of)
    return rows.select(
        "claim_id", "claim_line_id", quality.REASONS, "quarantine_run_id", "quarantine_timestamp"
    )


def _counts(rules, source: str, table: str) -> str:
    names = list(dict.fromkeys(name for name, _, _ in rules))
    return " UNION ALL ".join(
        f"SELECT '{table}' AS table_name, '{n}' AS rule_name, {n_if(_any(rules, n))} AS failed_count, "
        f"COUNT(*) AS total_count FROM {source}"
        for n in names
    )


@query("q05_claim_failures", _counts(CLAIM, "claims", "silver_claims"))
def _(t):
    rules = quality.claim_rules(t.cfg, t.as_of)
    return quality.failure_counts(t.claims(QUALITY_INPUT), rules, "silver_claims")


@query("q05_member_failures", _counts(MEMBER, "members", "silver_members"))
def _(t):
    return quality.failure_counts(t.members(), quality.member_rules(t.cfg, t.as_of), "silver_members")


@query("q05_provider_failures", _counts(PROVIDER, "providers", "silver_providers"))
def _(t):
    return quality.failure_counts(t.providers(), quality.provider_rules(t.cfg), "silver_providers")


@query(
    "q06_result_row",
    f"""SELECT 'run-1' AS pipeline_run_id, 'silver_claims' AS table_name, 'claims_validation' AS rule_name,
        'SUCCESS' AS status, {n_if(f"{_CLAIM_REASONS} <> ''")} AS failed_count, COUNT(*) AS total_count,
        (COUNT(*) - {n_if(f"{_CLAIM_REASONS} <> ''")}) * CAST(100 AS DOUBLE) / COUNT(*) AS pass_rate,
        {AS_OF} AS run_timestamp FROM claims""",
)
def _(t):
    return quality.result_row(_flagged(t), "silver_claims", "claims_validation", "run-1", t.as_of)


@query(
    "q07_reason_histogram",
    f"""SELECT reason, COUNT(*) AS row_count FROM (SELECT {_CLAIM_REASONS} AS reason FROM claims)
        WHERE reason <> '' GROUP BY reason""",
)
def _(t):
    return quality.reason_histogram(quality.split(_flagged(t))[1])


@query(
    "q07_single_reasons",
    f"""SELECT reason, COUNT(*) AS row_count FROM (SELECT unnest(string_split({_CLAIM_REASONS}, ', ')) AS reason
        FROM claims WHERE {_CLAIM_REASONS} <> '') GROUP BY reason""",
)
def _(t):
    return quality.reason_histogram(quality.split(_flagged(t))[1], each=True)


_FACT_KEYS = quality.FACT_KEYS + quality.DATE_KEYS


@query(
    "q08_fact_checks",
    f"""SELECT {', '.join(f"{n_if(f'{c} IS NULL')} AS null_{c}" for c in _FACT_KEYS)},
        {n_if('claim_amount < 0')} AS negative_amounts, {n_if(f'service_date > {AS_OF}')} AS future_service_dates,
        {n_if('processing_delay_days < 0')} AS invalid_processing_delays FROM fact""",
)
def _(t):
    columns = [*_FACT_KEYS, "claim_amount", "service_date", "processing_delay_days"]
    return quality.fact_checks(t.fact(columns), t.as_of)


INTEGRITY = f"""WITH f AS (SELECT 'fact_claims' AS table_name, COUNT(*) AS total_records,
        {n_if('member_sk IS NULL')} + {n_if('provider_sk IS NULL')} + {n_if('service_date_key IS NULL')}
        + {n_if('claim_amount < 0')} + {n_if('paid_amount > claim_amount')} AS faults FROM fact
    UNION ALL SELECT 'dim_member', COUNT(*), COUNT(*) - COUNT(DISTINCT member_id)
        + {n_if('member_age < 0 OR member_age > 120')} FROM dim_member
    UNION ALL SELECT 'dim_provider', COUNT(*), 0 FROM dim_provider)
    SELECT *, CASE WHEN faults = 0 THEN 'PASS' ELSE 'FAIL' END AS validation_status FROM f"""


@query("q09_gold_integrity", INTEGRITY)
def _(t):
    return t.integrity()


@query(
    "q10_assertion_rows",
    """SELECT 'amount_above_100k' AS assertion, claim_id, claim_line_id FROM claims WHERE claim_amount > 100000
        UNION ALL SELECT 'null_denial_reason', claim_id, claim_line_id FROM claims
        WHERE claim_status = 'DENIED' AND denial_reason IS NULL
        UNION ALL SELECT 'missing_key_field', claim_id, claim_line_id FROM claims
        WHERE claim_id IS NULL OR claim_line_id IS NULL OR member_id IS NULL OR provider_id IS NULL
        UNION ALL SELECT 'negative_amount', claim_id, claim_line_id FROM claims WHERE NOT coalesce(claim_amount >= 0, FALSE)""",
)
def _(t):
    claims = t.claims("claim_id claim_line_id member_id provider_id claim_amount claim_status denial_reason".split())
    keys = ["claim_id", "claim_line_id"]
    absent = reduce(or_, [F.col(c).isNull() for c in ("claim_id", "claim_line_id", "member_id", "provider_id")])
    negative = ~F.coalesce(F.col("claim_amount") >= 0, F.lit(False))
    high = quality.offending(claims, F.col("claim_amount") > 100_000, "amount_above_100k", keys)
    unexplained = (F.col("claim_status") == "DENIED") & F.col("denial_reason").isNull()
    found = high.unionByName(quality.offending(claims, unexplained, "null_denial_reason", keys))
    found = found.unionByName(quality.offending(claims, absent, "missing_key_field", keys))
    return found.unionByName(quality.offending(claims, negative, "negative_amount", keys))


@query(
    "q10_unique_line",
    "SELECT claim_id, claim_line_id, COUNT(*) AS row_count FROM claims GROUP BY 1, 2 HAVING COUNT(*) > 1",
)
def _(t):
    return quality.duplicate_keys(t.claims(["claim_id", "claim_line_id"]), ["claim_id", "claim_line_id"])


@query(
    "q11_referential_integrity",
    """SELECT member_id AS missing_key, COUNT(*) AS row_count FROM claims WHERE member_id NOT IN
        (SELECT c_custkey FROM customer) GROUP BY member_id""",
)
def _(t):
    return quality.missing_in(t.claims(["member_id"]), t.members(), "member_id", "member_id")


_SINCE = "run_timestamp >= {t} - INTERVAL {i} AND run_timestamp <= {t}"


def since(interval: str, column: str = "run_timestamp") -> str:
    return f"{column} >= {EVENTS_AS_OF} - INTERVAL {interval} AND {column} <= {EVENTS_AS_OF}"


QUALITY_METRICS = f"""SELECT *, CASE WHEN avg_pass_rate >= 98 THEN 'A' WHEN avg_pass_rate >= 95 THEN 'B'
    WHEN avg_pass_rate >= 90 THEN 'C' WHEN avg_pass_rate >= 80 THEN 'D' ELSE 'F' END AS quality_grade FROM (
    SELECT table_name, COUNT(*) AS total_quality_checks, {n_if("status = 'SUCCESS'")} AS successful_checks,
    {n_if("status = 'FAILED'")} AS failed_checks, {rate_avg('pass_rate')} AS avg_pass_rate,
    min(pass_rate) AS min_pass_rate, max(failed_count) AS max_failures, avg(failed_count) AS avg_failures,
    max(run_timestamp) AS last_check_time FROM quality_results WHERE {since('24 HOURS')} GROUP BY table_name)"""


@query("q12_quality_summary", QUALITY_METRICS)
def _(t):
    return audit.quality_metrics(t.quality_results(), t.events_as_of)


@query(
    "q13_quality_by_rule",
    f"""SELECT table_name, rule_name, {rate_avg('pass_rate')} AS avg_pass_rate,
        CAST(SUM(failed_count) AS BIGINT) AS total_failures, max(run_timestamp) AS last_check_time
        FROM quality_results WHERE {since('7 DAYS')} GROUP BY ALL""",
)
def _(t):
    return audit.quality_by_rule(t.quality_results(), t.events_as_of)


QUALITY_ALERTS = f"""SELECT * FROM (SELECT table_name, {rate_avg('pass_rate')} AS avg_pass_rate,
    CAST(SUM(failed_count) AS BIGINT) AS total_failures FROM quality_results WHERE {since('24 HOURS')}
    GROUP BY table_name) WHERE avg_pass_rate < 95 OR total_failures > 100"""


@query("q14_quality_alerts", QUALITY_ALERTS)
def _(t):
    return audit.quality_alerts(t.quality_results(), t.events_as_of, t.cfg)
