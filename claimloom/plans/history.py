"""Queries D: deduplication, change capture, dimensions."""

from pyspark.sql import functions as F

from claimloom.operators import changes, dimensions
from claimloom.functions import fields as x
from claimloom.plans.registry import query
from claimloom.sources import scratch
from claimloom.plans.sqltext import AS_OF, OPEN_END, PROVIDER_HASH, SEASON, key, n_if

KEYS = list(changes.CLAIM_KEYS)
CURRENT = "claim_id claim_line_id claim_amount claim_status service_date submission_date denial_reason".split()


@query("d01_one_per_key", f"SELECT {', '.join(CURRENT)} FROM unique_claims")
def _(t):
    return t.unique_claims(CURRENT)


def _delivered(t):
    """Current claims, read and deduplicated once, and a later delivery of some of them."""
    current = scratch.written(t.unique_claims(CURRENT), "current")
    return current, _incoming(current)


def _incoming(current):
    """Some claims again: some changed, some under a new key."""
    number = F.substring("claim_id", 2, 18).cast("long")
    picked = current.filter(number % 3 == 0)
    return picked.withColumns(
        {
            "claim_status": F.when(number % 2 == 0, F.lit("PAID")).otherwise(F.col("claim_status")),
            "denial_reason": F.when(number % 2 == 0, F.lit(None)).otherwise(F.col("denial_reason")),
            "claim_id": F.when(number % 15 == 0, F.concat(F.lit("N"), "claim_id")).otherwise(F.col("claim_id")),
        }
    )


_NUMBER = "CAST(substr(claim_id, 2) AS BIGINT)"
_INCOMING = f"""SELECT CASE WHEN {_NUMBER} % 15 = 0 THEN 'N' || claim_id ELSE claim_id END AS claim_id,
    claim_line_id, claim_amount, CASE WHEN {_NUMBER} % 2 = 0 THEN 'PAID' ELSE claim_status END AS claim_status,
    service_date, submission_date, CASE WHEN {_NUMBER} % 2 = 0 THEN NULL ELSE denial_reason END AS denial_reason
    FROM unique_claims WHERE {_NUMBER} % 3 = 0"""
_CHANGED = f"""n AS ({_INCOMING}), changed AS (SELECT n.* FROM n JOIN unique_claims c
    ON n.claim_id = c.claim_id AND n.claim_line_id = c.claim_line_id
    WHERE n.claim_status IS DISTINCT FROM c.claim_status OR n.claim_amount IS DISTINCT FROM c.claim_amount
    OR n.service_date IS DISTINCT FROM c.service_date)"""
_TRACKED = ["claim_status", "claim_amount", "service_date"]


@query("d02_changed_rows", f"WITH {_CHANGED} SELECT * FROM changed")
def _(t):
    return changes.classified(*_delivered(t), KEYS, _TRACKED).filter("change = 'changed'").select("new.*")


@query(
    "d03_superseded",
    f"""WITH {_CHANGED} SELECT {', '.join('c.' + c for c in CURRENT)}, {AS_OF} AS history_effective_end_date
        FROM unique_claims c JOIN changed n ON n.claim_id = c.claim_id AND n.claim_line_id = c.claim_line_id""",
)
def _(t):
    return changes.superseded_versions(changes.classified(*_delivered(t), KEYS, _TRACKED), t.as_of)


@query(
    "d04_snapshot_upsert",
    f"""WITH n AS ({_INCOMING}) SELECT * FROM n UNION ALL SELECT {', '.join('c.' + c for c in CURRENT)}
        FROM unique_claims c LEFT JOIN n ON n.claim_id = c.claim_id AND n.claim_line_id = c.claim_line_id
        WHERE n.claim_id IS NULL""",
)
def _(t):
    return changes.snapshot(changes.classified(*_delivered(t), KEYS, _TRACKED))


LATEST = """SELECT * FROM status_events QUALIFY row_number() OVER (PARTITION BY claim_id, claim_line_id
    ORDER BY event_timestamp DESC, event_id DESC) = 1"""
_EVENT = """event_id, claim_id, claim_line_id, event_type, old_status, new_status, denial_reason,
    event_timestamp, source_system"""
_MERGE = f"""l AS ({LATEST}), merged_rows AS (SELECT c.*, l.event_id, l.new_status, l.denial_reason AS event_reason,
    l.event_timestamp, l.event_id IS NOT NULL AND l.new_status <> c.claim_status AS applies
    FROM unique_claims c LEFT JOIN l ON l.claim_id = c.claim_id AND l.claim_line_id = c.claim_line_id)"""
_MERGED = """SELECT claim_id, claim_line_id, claim_amount,
    CASE WHEN applies THEN new_status ELSE claim_status END AS claim_status, service_date, submission_date,
    CASE WHEN applies THEN event_reason ELSE denial_reason END AS denial_reason,
    CASE WHEN applies THEN event_timestamp END AS status_update_timestamp FROM merged_rows"""


@query("d05_latest_event", f"SELECT {_EVENT} FROM ({LATEST})")
def _(t):
    return changes.latest_events(t.status_events()).drop("additional_data", "arrival")


def merged(t, **options):
    return changes.merge_status(t.unique_claims(CURRENT), t.status_events(), **options)


@query("d06_status_merge", f"WITH {_MERGE} {_MERGED}")
def _(t):
    return merged(t).current


@query(
    "d06_merge_replay",
    f"WITH {_MERGE} {_MERGED}",
)
def _(t):
    return changes.merge_status(merged(t).current, t.status_events()).current


@query(
    "d07_merge_insert",
    f"""WITH {_MERGE} {_MERGED} UNION ALL SELECT l.claim_id, l.claim_line_id, NULL, l.new_status, NULL, NULL,
        l.denial_reason, l.event_timestamp FROM l WHERE NOT EXISTS (SELECT 1 FROM unique_claims c
        WHERE c.claim_id = l.claim_id AND c.claim_line_id = l.claim_line_id)""",
)
def _(t):
    return merged(t, insert_unmatched=True).current


_DAYS = f"""SELECT CAST(d AS DATE) AS d FROM (SELECT unnest(generate_series(min(service_date), max(service_date),
    INTERVAL 1 DAY)) AS d FROM claims)"""


@query(
    "d08_date_dimension",
    f"""WITH days AS ({_DAYS}) SELECT CAST(strftime(d, '%Y%m%d') AS INTEGER) AS date_key, d AS "date",
        CAST(year(d) AS INTEGER) AS "year", CAST(quarter(d) AS INTEGER) AS "quarter",
        CAST(month(d) AS INTEGER) AS "month", monthname(d) AS month_name, CAST(day(d) AS INTEGER) AS "day",
        CAST(isodow(d) AS INTEGER) AS day_of_week, dayname(d) AS day_name, isodow(d) >= 6 AS is_weekend,
        FALSE AS is_holiday, CAST(week(d) AS INTEGER) AS week_of_year,
        CAST(year(d + INTERVAL 3 MONTH) AS INTEGER) AS fiscal_year,
        CAST(quarter(date_trunc('month', d) + INTERVAL 3 MONTH) AS INTEGER) AS fiscal_quarter,
        CAST(month(date_trunc('month', d) + INTERVAL 3 MONTH) AS INTEGER) AS fiscal_month,
        CAST(year(d) // 10 * 10 AS INTEGER) AS decade, CAST(year(d) // 100 + 1 AS INTEGER) AS century,
        day(last_day(make_date(year(d), 2, 1))) = 29 AS is_leap_year,
        CAST(day(last_day(d)) AS INTEGER) AS days_in_month,
        CAST(day(last_day(d)) - day(d) AS INTEGER) AS days_remaining_in_month,
        strftime(d, '%Y-%m-%d') AS date_format_iso, strftime(d, '%m/%d/%Y') AS date_format_us,
        strftime(d, '%d/%m/%Y') AS date_format_eu, {SEASON.format(d='d')} AS season FROM days""",
)
def _(t):
    first, last = t.claims(["service_date"]).agg(F.min("service_date"), F.max("service_date")).first()
    return dimensions.date_dim(t.spark, first.isoformat(), last.isoformat())


@query("d09_member_dimension", "SELECT * FROM dim_member")
def _(t):
    return t.dim_member()


@query("d10_provider_first_load", "SELECT * FROM dim_provider")
def _(t):
    return t.dim_provider()


def provider_deliveries(t):
    """First and second delivery of providers: later ones are new, some change their network."""
    all_ids = t.providers()
    edge = F.col("provider_id") % 10 == 9
    second = all_ids.filter(F.col("provider_id") % 8 != 0).withColumn(
        "network_status",
        F.when(F.col("provider_id") % 7 == 0, F.lit("OUT_OF_NETWORK")).otherwise(F.col("network_status")),
    )
    return all_ids.filter(~edge), second


_CHANGE_DAY = "DATE '2000-01-01'"
_SECOND = "CASE WHEN provider_id % 7 = 0 THEN 'OUT_OF_NETWORK' ELSE network_status END"
_ATTRIBUTES = """provider_id, provider_name, specialty, facility_name, city, state, zip_code, network_status,
    effective_date, termination_date"""
SCD2 = f"""WITH d1 AS (SELECT *, {PROVIDER_HASH} AS gold_row_hash FROM providers WHERE provider_id % 10 <> 9),
    s2 AS (SELECT * REPLACE ({_SECOND} AS network_status) FROM providers WHERE provider_id % 8 <> 0),
    d2 AS (SELECT *, {PROVIDER_HASH} AS gold_row_hash FROM s2),
    ch AS (SELECT d2.provider_id FROM d1 JOIN d2 USING (provider_id) WHERE d1.gold_row_hash <> d2.gold_row_hash),
    v AS (SELECT d1.*, effective_date AS effective_start_date,
        CASE WHEN provider_id IN (SELECT provider_id FROM ch) THEN {_CHANGE_DAY}
            ELSE coalesce(termination_date, {OPEN_END}) END AS effective_end_date,
        provider_id NOT IN (SELECT provider_id FROM ch) AS is_current FROM d1
    UNION ALL SELECT d2.*, {_CHANGE_DAY}, {OPEN_END}, TRUE FROM d2 WHERE provider_id IN (SELECT provider_id FROM ch)
    UNION ALL SELECT d2.*, effective_date, {OPEN_END}, TRUE FROM d2 WHERE provider_id % 10 = 9)
    SELECT *, {key('provider_id', 'effective_start_date')} AS provider_sk FROM v"""


def provider_history(t):
    first, second = provider_deliveries(t)
    dim = dimensions.first_load(first, t.as_of)
    return dimensions.scd2(dim, second, F.lit("2000-01-01").cast("date"))


@query("d11_provider_history", SCD2)
def _(t):
    return provider_history(t)


@query("d12_diagnosis_dimension", "SELECT * FROM diagnosis")
def _(t):
    return t.frames["diagnosis"]()


@query("d12_procedure_dimension", "SELECT * FROM procedures")
def _(t):
    return t.frames["procedure"]()


@query("d12_payer_dimension", "SELECT * FROM payers")
def _(t):
    return t.frames["payer"]()


@query("d13_surrogate_key", f"SELECT provider_id, {key('provider_id', 'effective_date')} AS provider_sk FROM providers")
def _(t):
    keyed = t.providers().select(
        "provider_id", x.surrogate_key(F.col("provider_id"), F.col("effective_date")).alias("provider_sk")
    )
    return keyed


@query(
    "d14_merge_audit",
    f"""WITH {_MERGE} SELECT {_EVENT}, 'run-1' AS merge_pipeline_run_id FROM l
        WHERE event_id IN (SELECT event_id FROM merged_rows WHERE applies)""",
)
def _(t):
    return changes.audit_trail(merged(t).applied, "run-1")


@query(
    "d15_change_summary",
    f"""SELECT old_status, new_status, denial_reason, COUNT(*) AS change_count,
        COUNT(DISTINCT claim_id) AS affected_claims FROM ({LATEST}) GROUP BY ALL""",
)
def _(t):
    return changes.change_summary(changes.latest_events(t.status_events()))


@query(
    "d15_change_claims",
    f"""SELECT old_status, new_status, denial_reason, claim_id, COUNT(*) AS change_count
        FROM ({LATEST}) GROUP BY ALL""",
)
def _(t):
    return changes.change_claims(changes.latest_events(t.status_events()))


_HISTORY = """SELECT claim_id, claim_line_id, claim_amount, claim_status, service_date, submission_date,
    denial_reason, CAST(NULL AS TIMESTAMP) AS status_update_timestamp, event_timestamp AS history_effective_end_date,
    'STATUS_UPDATE' AS history_reason, event_id AS history_event_id FROM merged_rows WHERE applies"""


@query("d03_status_history", f"WITH {_MERGE} {_HISTORY}")
def _(t):
    return merged(t).history


@query(
    "d16_recent_history",
    f"""WITH {_MERGE}, h AS ({_HISTORY}) SELECT * FROM h WHERE history_effective_end_date >=
        TIMESTAMP '2024-01-30 00:00:00' - INTERVAL 48 HOURS
        AND history_effective_end_date <= TIMESTAMP '2024-01-30 00:00:00'""",
)
def _(t):
    return changes.recent_history(merged(t).history, t.events_as_of, 48)


@query(
    "d17_status_change_fact",
    """SELECT event_id, claim_id, claim_line_id, old_status AS from_status, new_status AS to_status,
        event_timestamp AS changed_at, denial_reason AS change_reason, event_type FROM status_events""",
)
def _(t):
    return changes.status_history(t.status_events())


@query(
    "d18_transition_checks",
    """SELECT old_status, new_status, COUNT(*) AS event_count, old_status || '>' || new_status IN
        ('PENDING>PAID', 'PENDING>DENIED', 'DENIED>ADJUSTED', 'ADJUSTED>PAID') AS is_allowed
        FROM status_events GROUP BY old_status, new_status""",
)
def _(t):
    return changes.transition_checks(t.status_events())


@query(
    "d18_transition_matrix",
    "SELECT old_status, "
    + ", ".join(
        f"""{n_if(f"new_status = '{s}'")} AS to_{s.lower()}""" for s in ("PENDING", "PAID", "DENIED", "ADJUSTED")
    )
    + " FROM status_events GROUP BY old_status",
)
def _(t):
    return changes.transition_matrix(t.status_events(), t.cfg.statuses)


@query(
    "d19_state_at_time",
    f"SELECT * FROM ({SCD2}) WHERE effective_start_date <= DATE '1998-06-30' AND DATE '1998-06-30' < effective_end_date",
)
def _(t):
    versions = provider_history(t)
    current, past = versions.filter("is_current"), versions.filter("NOT is_current")
    at = F.lit("1998-06-30").cast("date")
    return changes.as_of_state(current, past, at, "effective_start_date", "effective_end_date")
