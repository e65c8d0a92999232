"""Queries J and L: joins, sorting, set operations."""

from pyspark.sql import functions as F

from claimloom.operators import anomaly, dashboards, fact, marts
from claimloom.operators.anomaly import flag_members
from claimloom.operators.changes import CLAIM_KEYS, latest_events
from claimloom.operators.dimensions import month_dim
from claimloom.plans.history import LATEST
from claimloom.plans.registry import query
from claimloom.plans.sqltext import usd

_CLAIM = "claim_id, claim_line_id, diagnosis_code, procedure_code, payer_id, claim_amount"


@query(
    "j01_reference_enrich",
    f"""SELECT {_CLAIM}, diagnosis_desc, diagnosis_category, procedure_desc, procedure_category, payer_name, payer_type
        FROM claims LEFT JOIN diagnosis USING (diagnosis_code)
        LEFT JOIN (SELECT procedure_code, procedure_desc, procedure_category FROM procedures) USING (procedure_code)
        LEFT JOIN (SELECT payer_id, payer_name, payer_type FROM payers) USING (payer_id)""",
)
def _(t):
    return fact.silver_enrich(t.claims(_CLAIM.split(", ")), t.frames)


@query("j02_star_join", f"SELECT {', '.join(fact.COLUMNS)} FROM fact")
def _(t):
    return t.fact()


@query(
    "j03_current_dimension_join",
    """SELECT claim_id, claim_line_id, provider_id, p.provider_sk AS current_provider_sk
        FROM claims LEFT JOIN (SELECT * FROM dim_provider WHERE is_current) p USING (provider_id)""",
)
def _(t):
    current = t.dim_provider().filter("is_current")
    claims = t.claims(["claim_id", "claim_line_id", "provider_id"])
    keyed = current.select("provider_id", F.col("provider_sk").alias("current_provider_sk"))
    return claims.join(keyed, "provider_id", "left")


@query(
    "j04_composite_inner_join",
    f"""SELECT l.event_id, claim_id, claim_line_id, c.claim_status, l.new_status
        FROM unique_claims c JOIN ({LATEST}) l USING (claim_id, claim_line_id)""",
)
def _(t):
    claims = t.unique_claims(["claim_id", "claim_line_id", "claim_status"])
    events = latest_events(t.status_events()).select("event_id", *CLAIM_KEYS, "new_status")
    return claims.join(events, list(CLAIM_KEYS), "inner")


@query(
    "j05_anti_join",
    f"""SELECT claim_id, claim_line_id, claim_amount FROM unique_claims c WHERE NOT EXISTS
        (SELECT 1 FROM status_events e WHERE e.claim_id = c.claim_id AND e.claim_line_id = c.claim_line_id)""",
)
def _(t):
    claims = t.unique_claims(["claim_id", "claim_line_id", "claim_amount"])
    touched = t.status_events().select(*CLAIM_KEYS).distinct()
    return claims.join(touched, list(CLAIM_KEYS), "left_anti")


@query(
    "j06_membership_flag",
    """SELECT claim_id, claim_line_id, member_id, member_id IN (SELECT member_id FROM claims
        GROUP BY member_id HAVING COUNT(*) > 40) AS is_frequent FROM claims""",
)
def _(t):
    claims = t.claims(["claim_id", "claim_line_id", "member_id"])
    frequent = claims.groupBy("member_id").agg(F.count("*").alias("n")).filter("n > 40").select("member_id")
    return flag_members(claims, frequent, ["member_id"], "is_frequent")


_TOP20 = f"""SELECT provider_id FROM claims WHERE year(service_date) = 2001 GROUP BY provider_id
    ORDER BY {usd('claim_amount')} DESC, provider_id LIMIT 20"""


@query(
    "j07_in_top_n",
    f"""SELECT provider_id, claim_status, COUNT(*) AS claim_count, {usd('claim_amount')} AS total_amount FROM claims
        WHERE year(service_date) = 2001 AND provider_id IN ({_TOP20}) GROUP BY provider_id, claim_status""",
)
def _(t):
    from claimloom.functions.exact import money_sum

    year = dashboards.in_year(t.claims(["provider_id", "claim_status", "claim_amount", "service_date"]), t.as_of)
    totals = year.groupBy("provider_id").agg(money_sum("claim_amount").alias("amount"))
    groups = year.groupBy("provider_id", "claim_status").agg(
        F.count("*").alias("claim_count"), money_sum("claim_amount").alias("total_amount")
    )
    return dashboards.in_top(groups, "provider_id", totals, 20, F.col("amount").desc(), F.col("provider_id"))


@query(
    "j08_aggregate_to_detail",
    f"""WITH p AS (SELECT provider_id, {usd('claim_amount')} / COUNT(claim_amount) AS provider_avg_amount
        FROM claims GROUP BY provider_id) SELECT claim_id, claim_line_id, claim_amount, provider_avg_amount
        FROM claims LEFT JOIN p USING (provider_id)""",
)
def _(t):
    claims = t.claims(["claim_id", "claim_line_id", "claim_amount", "provider_id", "claim_status"])
    profile = anomaly.provider_profile(claims).select("provider_id", "provider_avg_amount")
    return claims.join(profile, "provider_id", "left").select(
        "claim_id", "claim_line_id", "claim_amount", "provider_avg_amount"
    )


_MONTHS = f"""WITH g AS (SELECT service_year, service_month, payer_type, COUNT(*) AS total_claims FROM fact GROUP BY ALL)
    SELECT *, 'Q' || CAST(ceil(service_month / 3.0) AS INTEGER) AS quarter_name,
    monthname(make_date(service_year, service_month, 1)) AS month_name,
    CASE WHEN service_month IN (12, 1, 2) THEN 'Winter' WHEN service_month < 6 THEN 'Spring'
        WHEN service_month < 9 THEN 'Summer' ELSE 'Fall' END AS season,
    service_year + CASE WHEN service_month >= 10 THEN 1 ELSE 0 END AS fiscal_year,
    (service_month + 2) % 12 // 3 + 1 AS fiscal_quarter FROM g"""


@query("j09_month_attributes", _MONTHS)
def _(t):
    mart = t.fact(["service_year", "service_month", "payer_type"])
    grouped = mart.groupBy("service_year", "service_month", "payer_type").agg(F.count("*").alias("total_claims"))
    return marts.with_months(grouped, month_dim(t.dim_date()))


@query(
    "j10_three_way_enrich",
    """SELECT claim_id, claim_line_id, claim_amount, provider_name, provider_specialty, member_age, member_state
        FROM fact""",
)
def _(t):
    columns = """claim_id claim_line_id claim_amount provider_name provider_specialty member_age
        member_state""".split()
    return t.fact(columns)


@query(
    "l01_top_n",
    "SELECT claim_id, claim_line_id, claim_amount FROM unique_claims ORDER BY claim_amount DESC, claim_id, claim_line_id LIMIT 100",
)
def _(t):
    claims = t.unique_claims(["claim_id", "claim_line_id", "claim_amount"])
    return dashboards.top(claims, 100, F.col("claim_amount").desc(), F.col("claim_id"), F.col("claim_line_id"))


@query("l02_distinct", "SELECT DISTINCT provider_id, payer_id, claim_status FROM claims")
def _(t):
    return t.claims(["provider_id", "payer_id", "claim_status"]).distinct()


@query(
    "l02_distinct_count",
    "SELECT COUNT(DISTINCT provider_id) AS providers, COUNT(DISTINCT member_id) AS members FROM claims",
)
def _(t):
    return t.claims(["provider_id", "member_id"]).agg(
        F.count_distinct("provider_id").alias("providers"), F.count_distinct("member_id").alias("members")
    )


@query(
    "l03_union_all",
    """SELECT claim_id AS id, claim_status AS status, 'claim' AS kind FROM claims
        UNION ALL SELECT event_id, new_status, 'event' FROM status_events""",
)
def _(t):
    claims = t.claims(["claim_id", "claim_status"]).select(
        F.col("claim_id").alias("id"), F.col("claim_status").alias("status"), F.lit("claim").alias("kind")
    )
    events = t.status_events().select(
        F.lit("event").alias("kind"), F.col("event_id").alias("id"), F.col("new_status").alias("status")
    )
    return claims.unionByName(events)
