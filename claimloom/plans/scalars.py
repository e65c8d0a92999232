"""Queries C: projections, predicates and scalar functions."""

from pyspark.sql import functions as F

from claimloom.functions import fields as x
from claimloom.functions.exact import ratio as spark_ratio
from claimloom.operators import publish
from claimloom.operators.dashboards import recent
from claimloom.plans.model import SETTINGS
from claimloom.plans.registry import query
from claimloom.plans.sqltext import AGE, AS_OF, CATEGORY, REGION, SEASON, age_group, n_if, ratio, usd
from claimloom.streaming import events as ev


@query(
    "c01_standardise",
    """SELECT upper(trim(' ' || claim_id || ' ')) AS claim_id, upper(claim_line_id) AS claim_line_id,
        upper(claim_status) AS claim_status, diagnosis_code, trim(place_of_service) AS place_of_service FROM claims""",
)
def _(t):
    raw = t.claims("claim_id claim_line_id claim_status diagnosis_code place_of_service".split())
    untidy = raw.withColumns(
        {
            "claim_id": F.concat(F.lit("  "), F.lower("claim_id"), F.lit(" ")),
            "claim_status": F.lower("claim_status"),
            "place_of_service": F.concat("place_of_service", F.lit("  ")),
        }
    )
    codes = ["claim_id", "claim_line_id", "claim_status", "diagnosis_code"]
    return untidy.select(*[x.code(c) for c in codes], F.trim("place_of_service").alias("place_of_service"))


@query(
    "c02_date_normalise",
    """SELECT claim_id, CASE WHEN l.l_linenumber = 7 THEN NULL ELSE CAST(l.l_shipdate AS DATE) END AS submission_date
        FROM (SELECT *, concat('C', l_orderkey) AS claim_id FROM lineitem) l""",
)
def _(t):
    text = F.when(F.col("l_linenumber") == 7, F.lit("not a date")).otherwise(
        F.date_format("l_shipdate", "yyyy-MM-dd")
    )
    return t.table("lineitem").select(
        F.concat(F.lit("C"), "l_orderkey").alias("claim_id"), x.as_date(text).alias("submission_date")
    )


@query("c03_age", f"SELECT member_id, dob, CAST({AGE} AS INTEGER) AS member_age FROM members")
def _(t):
    return t.members().select("member_id", "dob", x.years_between(F.col("dob"), t.as_of).alias("member_age"))


@query("c04_age_group", f"SELECT member_id, {age_group(AGE)} AS member_age_group FROM members")
def _(t):
    age = x.years_between(F.col("dob"), t.as_of)
    return t.members().select("member_id", x.age_group(age).alias("member_age_group"))


@query("c05_full_name", "SELECT member_id, member_first_name || ' ' || member_last_name AS full_name FROM members")
def _(t):
    name = x.full_name(F.col("member_first_name"), F.col("member_last_name"))
    return t.members().select("member_id", name.alias("full_name"))


@query("c06_eligibility", "SELECT member_id, is_eligible FROM dim_member")
def _(t):
    flag = x.eligible(F.col("eligibility_start_date"), F.col("eligibility_end_date"), t.as_of)
    return t.members().select("member_id", flag.alias("is_eligible"))


@query("c07_validity", "SELECT member_id, effective_start_date, effective_end_date FROM dim_member")
def _(t):
    start, end = x.validity(F.col("eligibility_start_date"), F.col("dob"), F.col("eligibility_end_date"))
    return t.members().select("member_id", start.alias("effective_start_date"), end.alias("effective_end_date"))


@query("c08_region", f"SELECT provider_id, state, {REGION} AS provider_region FROM providers")
def _(t):
    region = x.region(F.col("state"), t.cfg.regions)
    return t.providers().select("provider_id", "state", region.alias("provider_region"))


@query("c09_specialty_category", f"SELECT provider_id, specialty, {CATEGORY} AS specialty_category FROM providers")
def _(t):
    category = x.specialty_category(F.col("specialty"), t.cfg.specialties)
    return t.providers().select("provider_id", "specialty", category.alias("specialty_category"))


def _fact(name: str, columns: str, sql_columns: str | None = None) -> None:
    names = columns.split()

    @query(name, f"SELECT {sql_columns or ', '.join(names)} FROM fact")
    def _(t):
        return t.fact(names)


_fact("c10_processing_delay", "claim_id claim_line_id processing_delay_days")
_fact("c11_status_flags", "claim_id is_paid_claim is_denied_claim is_pending_claim is_adjusted_claim")
_fact("c12_status_amounts", "claim_id paid_amount denied_amount pending_amount adjusted_amount")
_fact("c13_claim_line_key", "claim_line_key claim_amount")
_fact("c14_value_and_network_flags", "claim_id is_high_value_claim is_out_of_network")


@query(
    "c15_month_start",
    "SELECT claim_id, CAST(date_trunc('month', service_date) AS DATE) AS month_start FROM claims",
)
def _(t):
    start = x.month_start(F.year("service_date"), F.month("service_date"))
    return t.claims(["claim_id", "service_date"]).select("claim_id", start.alias("month_start"))


@query(
    "c16_code_formats",
    f"""SELECT claim_id, regexp_matches(diagnosis_code, '{SETTINGS.icd_pattern}') AS diagnosis_ok,
        regexp_matches(CAST(procedure_code AS VARCHAR), '{SETTINGS.cpt_pattern}') AS procedure_ok FROM claims""",
)
def _(t):
    return t.claims(["claim_id", "diagnosis_code", "procedure_code"]).select(
        "claim_id",
        x.matches(F.col("diagnosis_code"), t.cfg.icd_pattern).alias("diagnosis_ok"),
        x.matches(F.col("procedure_code"), t.cfg.cpt_pattern).alias("procedure_ok"),
    )


@query(
    "c16_zip_formats",
    "SELECT provider_id, zip_code, regexp_matches(zip_code, '^[0-9]{5}$') AS zip_ok FROM providers",
)
def _(t):
    return t.providers().select("provider_id", "zip_code", x.matches(F.col("zip_code"), t.cfg.zip_pattern).alias("zip_ok"))


@query(
    "c17_reason_list",
    f"""SELECT claim_id, claim_line_id, concat_ws(', ',
        CASE WHEN claim_amount > {SETTINGS.amount_max} THEN 'Amount above maximum' END,
        CASE WHEN place_of_service NOT IN ('1', '2', '3', '4') THEN 'Invalid place of service' END,
        CASE WHEN service_date > submission_date THEN 'Invalid date order' END) AS reasons FROM claims""",
)
def _(t):
    claims = t.claims("claim_id claim_line_id claim_amount place_of_service service_date submission_date".split())
    labelled = [
        (F.col("claim_amount") > t.cfg.amount_max, "Amount above maximum"),
        (~F.col("place_of_service").isin(*t.cfg.places), "Invalid place of service"),
        (F.col("service_date") > F.col("submission_date"), "Invalid date order"),
    ]
    return claims.select("claim_id", "claim_line_id", x.reasons(labelled).alias("reasons"))


@query(
    "c18_safe_ratios",
    f"""SELECT provider_id, {ratio(n_if("claim_status = 'DENIED'"), 'COUNT(*)')} AS denial_rate,
        {ratio(usd("CASE WHEN claim_status = 'PAID' THEN claim_amount ELSE 0 END"), usd('claim_amount'))} AS payment_rate,
        {ratio('COUNT(*)', 'COUNT(DISTINCT member_id)')} AS claims_per_member,
        {ratio(n_if("claim_status = 'PAID'"), n_if("claim_status = 'VOID'"))} AS paid_per_void
        FROM claims GROUP BY provider_id""",
)
def _(t):
    from claimloom.functions.exact import money_sum

    claims = t.fact(["provider_id", "claim_status", "claim_amount", "paid_amount", "member_id"])
    status = F.col("claim_status")
    return claims.groupBy("provider_id").agg(
        spark_ratio(F.count_if(status == "DENIED"), F.count("*")).alias("denial_rate"),
        spark_ratio(money_sum("paid_amount"), money_sum("claim_amount")).alias("payment_rate"),
        spark_ratio(F.count("*"), F.count_distinct("member_id")).alias("claims_per_member"),
        spark_ratio(F.count_if(status == "PAID"), F.count_if(status == "VOID")).alias("paid_per_void"),
    )


@query(
    "c19_event_time_parts",
    f"""SELECT event_id, CAST(event_timestamp AS DATE) AS event_date, CAST(hour(event_timestamp) AS INTEGER) AS event_hour,
        CAST(epoch(date_trunc('second', arrival)) - epoch(date_trunc('second', event_timestamp)) AS BIGINT)
            AS processing_delay_seconds,
        epoch(date_trunc('second', arrival)) - epoch(date_trunc('second', event_timestamp)) > 300 AS is_late_event
        FROM status_events""",
)
def _(t):
    derived = ev.derive_events(t.status_events(), t.cfg, F.col("arrival"))
    return derived.select("event_id", "event_date", "event_hour", "processing_delay_seconds", "is_late_event")


_BANDS = """CASE WHEN total >= 1000000 THEN 'High Volume' WHEN total >= 100000 THEN 'Medium Volume' ELSE 'Low Volume' END"""


@query(
    "c20_provider_bands",
    f"""WITH g AS (SELECT provider_id, {usd('claim_amount')} AS total,
            {ratio(n_if("claim_status = 'DENIED'"), 'COUNT(*)')} AS rate, {usd('claim_amount')} / COUNT(*) / 100 AS av
            FROM claims GROUP BY provider_id, year(service_date))
        SELECT provider_id, total, {_BANDS} AS volume_category, CASE WHEN rate <= 0.05 THEN 'Excellent'
        WHEN rate <= 0.10 THEN 'Good' WHEN rate <= 0.20 THEN 'Average' ELSE 'Poor' END AS denial_performance_category,
        CASE WHEN av >= 500 THEN 'High Value' WHEN av >= 200 THEN 'Medium Value' ELSE 'Low Value' END AS value_category
        FROM g""",
)
def _(t):
    from claimloom.functions.exact import money_avg, money_sum

    claims = t.claims(["provider_id", "service_date", "claim_amount", "claim_status"])
    grouped = claims.groupBy("provider_id", F.year("service_date")).agg(
        money_sum("claim_amount").alias("total"),
        spark_ratio(F.count_if(F.col("claim_status") == "DENIED"), F.count("*")).alias("rate"),
        (money_avg("claim_amount") / 100).alias("av"),
    )
    return grouped.select(
        "provider_id",
        "total",
        x.volume_band(F.col("total")).alias("volume_category"),
        x.denial_band(F.col("rate")).alias("denial_performance_category"),
        x.value_band(F.col("av")).alias("value_category"),
    )


@query(
    "c21_denial_bands",
    f"""WITH g AS (SELECT procedure_code, {n_if("claim_status = 'DENIED'")} AS n,
            {ratio(n_if("claim_status = 'DENIED'"), 'COUNT(*)')} AS rate,
            {usd('claim_amount')} / COUNT(*) / 100 AS av FROM claims GROUP BY procedure_code)
        SELECT procedure_code, CASE WHEN n * 8 >= 100 THEN 'High Volume Denials' WHEN n * 8 >= 50
        THEN 'Medium Volume Denials' ELSE 'Low Volume Denials' END AS denial_volume_category,
        CASE WHEN rate >= 0.20 THEN 'High Denial Rate' WHEN rate >= 0.10 THEN 'Medium Denial Rate'
        ELSE 'Low Denial Rate' END AS denial_rate_category,
        CASE WHEN av >= 1000 THEN 'High Value Denials' WHEN av >= 500 THEN 'Medium Value Denials'
        ELSE 'Low Value Denials' END AS denial_value_category,
        CASE WHEN rate - 0.3 >= 0.10 THEN 'Growing Fast' WHEN rate - 0.3 >= 0.05 THEN 'Growing Moderate'
        WHEN rate - 0.3 <= -0.10 THEN 'Declining Fast' WHEN rate - 0.3 <= -0.05 THEN 'Declining Moderate'
        ELSE 'Stable' END AS denial_trend_category FROM g""",
)
def _(t):
    from claimloom.functions.exact import money_avg

    claims = t.claims(["procedure_code", "claim_amount", "claim_status"])
    denied = F.col("claim_status") == "DENIED"
    grouped = claims.groupBy("procedure_code").agg(
        F.count_if(denied).alias("n"),
        spark_ratio(F.count_if(denied), F.count("*")).alias("rate"),
        (money_avg("claim_amount") / 100).alias("av"),
    )
    return grouped.select(
        "procedure_code",
        x.denial_volume_band(F.col("n") * 8).alias("denial_volume_category"),
        x.denial_rate_band(F.col("rate")).alias("denial_rate_category"),
        x.denial_value_band(F.col("av")).alias("denial_value_category"),
        x.trend_band(F.col("rate") - 0.3).alias("denial_trend_category"),
    )


@query(
    "c22_date_attributes",
    f"""SELECT claim_id, CAST(quarter(service_date) AS INTEGER) AS service_quarter,
        CAST(week(service_date) AS INTEGER) AS service_week,
        CAST(year(service_date) + CASE WHEN month(service_date) >= 10 THEN 1 ELSE 0 END AS INTEGER) AS fiscal_year,
        {SEASON.format(d='service_date')} AS season, strftime(service_date, '%m/%d/%Y') AS us_date FROM claims""",
)
def _(t):
    day = F.col("service_date")
    return t.claims(["claim_id", "service_date"]).select(
        "claim_id",
        F.quarter(day).alias("service_quarter"),
        F.weekofyear(day).alias("service_week"),
        (F.year(day) + (F.month(day) >= 10).cast("int")).alias("fiscal_year"),
        x.season(F.month(day)).alias("season"),
        F.date_format(day, "MM/dd/yyyy").alias("us_date"),
    )


@query("c23_payload", "SELECT event_id, payment_amount, payment_date, processor_id FROM status_source")
def _(t):
    parsed = ev.payload(t.events())
    return parsed.select("event_id", "payment_amount", "payment_date", "processor_id")


@query(
    "c24_rolling_period",
    f"""SELECT claim_id, service_date FROM claims WHERE service_date >= {AS_OF} - INTERVAL 6 MONTH""",
)
def _(t):
    return recent(t.claims(["claim_id", "service_date"]), t.as_of, 6)


@query(
    "c25_masking",
    """SELECT sha256('salt|' || member_id) AS member_token, substr(member_first_name, 1, 1) || '***' AS member_first_name,
        substr(member_last_name, 1, 1) || '***' AS member_last_name, CAST(date_trunc('year', dob) AS DATE) AS birth_year,
        substr(zip_code, 1, 3) || '**' AS zip3, gender, state FROM members""",
)
def _(t):
    return publish.mask_members(t.members(), "salt")


@query(
    "c26_entitlement",
    """SELECT claim_id, claim_line_id, payer_id, claim_amount FROM claims
        WHERE payer_id IN (SELECT r_name FROM region WHERE r_regionkey % 2 = 0)""",
)
def _(t):
    granted = t.table("region").select(
        F.when(F.col("r_regionkey") % 2 == 0, F.lit("analyst")).otherwise(F.lit("other")).alias("user_name"),
        F.col("r_name").alias("value"),
    )
    claims = t.claims(["claim_id", "claim_line_id", "payer_id", "claim_amount"])
    return publish.entitled(claims, granted, "analyst", "payer_id")
