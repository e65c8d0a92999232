"""Text of the SQL counterparts: shared views and small expression helpers."""

from __future__ import annotations

from claimloom.plans import model as m


def usd(x: str) -> str:
    return f"CAST(SUM(CAST({x} AS DECIMAL(18,2))) AS DOUBLE)"


def usd_avg(x: str) -> str:
    return f"({usd(x)} / NULLIF(COUNT({x}), 0))"


def rate_avg(x: str) -> str:
    return f"(CAST(SUM(CAST(round_even(({x}) * 1e9, 0) AS BIGINT)) AS DOUBLE) / 1e9 / NULLIF(COUNT({x}), 0))"


def ratio(a: str, b: str) -> str:
    return f"(CAST({a} AS DOUBLE) / NULLIF(CAST({b} AS DOUBLE), 0))"


def pct(a: str, b: str) -> str:
    return f"({a} * CAST(100 AS DOUBLE) / NULLIF({b}, 0))"


def n_if(condition: str) -> str:
    return f"COUNT(*) FILTER (WHERE {condition})"


def stddev(x: str) -> str:
    s, n = f"CAST(SUM(CAST({x} AS HUGEINT)) AS DOUBLE)", f"COUNT({x})"
    q = f"CAST(SUM(CAST({x} AS HUGEINT) * CAST({x} AS HUGEINT)) AS DOUBLE)"
    return f"CASE WHEN {n} > 1 THEN sqrt(greatest(({q} - {s} * {s} / {n}) / ({n} - 1), 0)) END"


def key(*parts: str) -> str:
    text = " || '|' || ".join(f"CAST({p} AS VARCHAR)" for p in parts)
    u = f"CAST('0x' || substr(md5({text}), 1, 16) AS HUGEINT)"
    return f"CAST(CASE WHEN {u} >= 9223372036854775808 THEN {u} - 18446744073709551616 ELSE {u} END AS BIGINT)"


def cols(mapping: dict[str, str]) -> str:
    return ", ".join(f"{text} AS {name}" for name, text in mapping.items())


AS_OF = f"DATE '{m.AS_OF}'"
EVENTS_AS_OF = f"TIMESTAMP '{m.EVENTS_AS_OF}'"
AGE = (
    f"(year({AS_OF}) - year(dob) - CASE WHEN month(dob) * 100 + day(dob) > "
    f"month({AS_OF}) * 100 + day({AS_OF}) THEN 1 ELSE 0 END)"
)


def age_group(age: str) -> str:
    return (
        f"CASE WHEN {age} < 18 THEN 'Minor' WHEN {age} < 35 THEN 'Adult 18-34' WHEN {age} < 50 "
        f"THEN 'Adult 35-49' WHEN {age} < 65 THEN 'Adult 50-64' WHEN {age} >= 65 THEN 'Senior 65+' END"
    )


SEASON = (
    "CASE WHEN month({d}) IN (12, 1, 2) THEN 'Winter' WHEN month({d}) IN (3, 4, 5) THEN 'Spring' "
    "WHEN month({d}) IN (6, 7, 8) THEN 'Summer' ELSE 'Fall' END"
)
REGION = (
    "CASE WHEN state IN ('CA', 'WA', 'AZ') THEN 'West' WHEN state = 'UT' THEN 'Mountain' "
    "WHEN state = 'TX' THEN 'Central' WHEN state IN ('NY', 'OH') THEN 'East' ELSE 'Other' END"
)
CATEGORY = (
    "CASE specialty WHEN 'Internal Medicine' THEN 'Primary Care' WHEN 'Vascular Surgery' THEN 'Surgery' "
    "WHEN 'Dermatology' THEN 'Other' ELSE specialty END"
)
OPEN_END = "DATE '9999-12-31'"
PROVIDER_HASH = "md5(concat_ws('|', " + ", ".join(
    f"coalesce(CAST({c} AS VARCHAR), chr(0))"
    for c in "provider_name specialty facility_name city state zip_code network_status".split()
) + "))"

C = m.SETTINGS

VIEWS = {
    "claims": f"""SELECT {cols(m.CLAIM)}, p_type AS diagnosis_code, r_name AS payer_id, {cols(m.ORDER)},
        CASE WHEN l_returnflag = 'R' THEN o_orderpriority END AS denial_reason
        FROM lineitem LEFT JOIN orders ON l_orderkey = o_orderkey LEFT JOIN part ON l_partkey = p_partkey
        LEFT JOIN customer ON o_custkey = c_custkey LEFT JOIN nation ON c_nationkey = n_nationkey
        LEFT JOIN region ON n_regionkey = r_regionkey""",
    "unique_claims": """SELECT * FROM claims QUALIFY row_number() OVER (PARTITION BY claim_id, claim_line_id
        ORDER BY submission_date DESC, procedure_code DESC, provider_id DESC, claim_amount DESC) = 1""",
    "members": f"SELECT {cols(m.MEMBER)} FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey",
    "providers": f"SELECT {cols(m.PROVIDER)} FROM supplier",
    "dim_member": f"""SELECT {key('member_id', 'eligibility_start_date')} AS member_sk, *,
        member_first_name || ' ' || member_last_name AS member_full_name, CAST({AGE} AS INTEGER) AS member_age,
        {age_group(AGE)} AS member_age_group,
        (eligibility_start_date <= {AS_OF} AND (eligibility_end_date IS NULL OR eligibility_end_date >= {AS_OF}))
            AS is_eligible,
        eligibility_start_date AS effective_start_date,
        coalesce(eligibility_end_date, {OPEN_END}) AS effective_end_date, TRUE AS is_current FROM members""",
    "dim_provider": f"""SELECT *, effective_date AS effective_start_date,
        coalesce(termination_date, {OPEN_END}) AS effective_end_date, TRUE AS is_current,
        {PROVIDER_HASH} AS gold_row_hash, {key('provider_id', 'effective_date')} AS provider_sk,
        {REGION} AS provider_region, {CATEGORY} AS specialty_category FROM providers""",
    "diagnosis": f"""SELECT p_type AS diagnosis_code, {key('p_type')} AS diagnosis_sk,
        arg_min(p_name, (p_name, p_brand)) AS diagnosis_desc,
        arg_min(p_brand, (p_name, p_brand)) AS diagnosis_category FROM part GROUP BY p_type""",
    "procedures": f"""SELECT p_partkey AS procedure_code, {key('p_partkey')} AS procedure_sk,
        p_name AS procedure_desc, p_brand AS procedure_category FROM part""",
    "payers": f"""SELECT r_name AS payer_id, {key('r_name')} AS payer_sk, 'Payer ' || r_name AS payer_name,
        CASE WHEN r_name IN ('AFRICA', 'ASIA') THEN 'Government' ELSE 'Commercial' END AS payer_type
        FROM region""",
    "fact": f"""SELECT c.* EXCLUDE (order_priority), claim_id || '_' || claim_line_id AS claim_line_key,
        member_sk, provider_sk, diagnosis_sk, procedure_sk, payer_sk,
        CAST(strftime(service_date, '%Y%m%d') AS INTEGER) AS service_date_key,
        CAST(strftime(submission_date, '%Y%m%d') AS INTEGER) AS submission_date_key,
        member_age, member_age_group, m.gender AS member_gender, m.state AS member_state,
        m.plan_id AS member_plan, m.is_eligible AS member_is_eligible,
        specialty AS provider_specialty, specialty_category AS provider_specialty_category,
        network_status AS provider_network_status, provider_region, provider_name, payer_type,
        procedure_category, CAST(year(service_date) AS INTEGER) AS service_year,
        CAST(quarter(service_date) AS INTEGER) AS service_quarter,
        CAST(month(service_date) AS INTEGER) AS service_month,
        {SEASON.format(d='service_date')} AS service_season,
        CAST(year(submission_date) AS INTEGER) AS submission_year,
        CAST(quarter(submission_date) AS INTEGER) AS submission_quarter,
        claim_status = 'PAID' AS is_paid_claim, claim_status = 'DENIED' AS is_denied_claim,
        claim_status = 'PENDING' AS is_pending_claim, claim_status = 'ADJUSTED' AS is_adjusted_claim,
        CASE WHEN claim_status = 'PAID' THEN claim_amount ELSE 0 END AS paid_amount,
        CASE WHEN claim_status = 'DENIED' THEN claim_amount ELSE 0 END AS denied_amount,
        CASE WHEN claim_status = 'PENDING' THEN claim_amount ELSE 0 END AS pending_amount,
        CASE WHEN claim_status = 'ADJUSTED' THEN claim_amount ELSE 0 END AS adjusted_amount,
        CAST(submission_date - service_date AS INTEGER) AS processing_delay_days,
        claim_amount > {C.high_value} AS is_high_value_claim,
        network_status = 'OUT_OF_NETWORK' AS is_out_of_network
        FROM claims c LEFT JOIN dim_member m USING (member_id) LEFT JOIN dim_provider USING (provider_id)
        LEFT JOIN diagnosis USING (diagnosis_code) LEFT JOIN procedures USING (procedure_code)
        LEFT JOIN payers USING (payer_id)""",
    "status_source": f"""SELECT {cols(m.EVENT)}, value AS payment_amount, CAST(ts AS DATE) AS payment_date,
        'P' || json_extract_string(props, '$.k') AS processor_id,
        CAST(ts AS TIMESTAMP) + INTERVAL 1 MINUTE * CAST(event_id % 10 AS INT) AS arrival FROM events""",
    "status_events": """SELECT * FROM status_source WHERE event_type = 'STATUS_UPDATE' AND new_status IS NOT NULL""",
    "runs": f"SELECT {cols(m.RUN)} FROM events",
    "quality_results": f"""SELECT *, (total_count - failed_count) * CAST(100 AS DOUBLE) / total_count AS pass_rate
        FROM (SELECT {cols(m.RESULT)} FROM events)""",
    "row_counts": """SELECT event_type AS table_name, CAST(ts AS DATE) AS run_date, COUNT(*) AS record_count
        FROM events GROUP BY ALL""",
    "stream_monitoring": """SELECT 'stream_' || user_id AS stream_name, max(CAST(ts AS TIMESTAMP)) AS last_event_time,
        max(user_id) % 10 <> 0 AS is_active FROM events GROUP BY user_id""",
}


def full(text: str) -> str:
    """``text`` with the views it names, directly or through another view."""
    import re

    used: set[str] = set()
    todo = [text]
    while todo:
        words = set(re.findall(r"[a-z_]+", todo.pop()))
        for name in VIEWS:
            if name in words and name not in used:
                used.add(name)
                todo.append(VIEWS[name])
    views = ", ".join(f"{name} AS ({VIEWS[name]})" for name in VIEWS if name in used)
    text = text.strip()
    if not views:
        return text
    if text.upper().startswith("WITH "):
        return f"WITH {views}, {text[5:]}"
    return f"WITH {views} {text}"
