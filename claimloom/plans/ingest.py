"""Queries S: scans, sources, sinks and intake."""

from pyspark.sql import functions as F

from claimloom import schemas
from claimloom.operators import dimensions, publish, quality
from claimloom.plans.registry import query
from claimloom.plans.sqltext import AGE, AS_OF, n_if
from claimloom.functions import fields as x
from claimloom.plans import model
from claimloom.sources import files, scratch, tables

DATASET = [c for c in model.CLAIM_COLUMNS if c != "denial_reason"]
_TEXT_CLAIM = """SELECT claim_id, claim_line_id, CAST(member_id AS VARCHAR) AS member_id,
    CAST(provider_id AS VARCHAR) AS provider_id, diagnosis_code, CAST(procedure_code AS VARCHAR) AS procedure_code,
    payer_id, claim_amount, service_date, claim_status, place_of_service, submission_date FROM claims"""


@query("s01_csv_scan", _TEXT_CLAIM)
def _(t):
    path = scratch.fresh(t.spark, "claims")
    t.claims(DATASET).write.option("header", True).csv(path)
    return files.read_dataset(t.spark, "claims", path)


@query("s02_schema_registry", _TEXT_CLAIM)
def _(t):
    return schemas.conform(t.claims(DATASET), "claims")


def _landing(t) -> str:
    """Header-less CSV copies of six datasets, one folder each."""
    path = scratch.fresh(t.spark, "landing")
    sources = {
        "claims": t.table("lineitem").select("l_orderkey", "l_linenumber"),
        "members": t.table("customer").select("c_custkey"),
        "providers": t.table("supplier").select("s_suppkey"),
        "diagnosis": t.table("part").select("p_type"),
        "procedure": t.table("part").select("p_partkey"),
        "payer": t.table("region").select("r_name"),
    }
    for name, df in sources.items():
        df.write.csv(f"{path}/{name}_raw")
    return path


_LANDED = """SELECT 'claims' AS dataset, COUNT(*) AS line_count FROM lineitem
    UNION ALL SELECT 'members', COUNT(*) FROM customer UNION ALL SELECT 'providers', COUNT(*) FROM supplier
    UNION ALL SELECT 'diagnosis_ref', COUNT(*) FROM part UNION ALL SELECT 'procedure_ref', COUNT(*) FROM part
    UNION ALL SELECT 'payer_ref', COUNT(*) FROM region"""


def _lines(t, path: str):
    text = t.spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", "*.csv").text(path)
    return text.groupBy(F.col("_metadata.file_name").alias("file_name")).agg(F.count("*").alias("line_count"))


@query("s03_landing_discovery", _LANDED)
def _(t):
    path = _landing(t)
    found = files.list_landing(t.spark, path).filter("file_size > 0")
    return found.join(_lines(t, path), "file_name").groupBy("dataset").agg(F.sum("line_count").alias("line_count"))


@query(
    "s04_lineage_columns",
    f"""SELECT concat('C', l_orderkey) AS claim_id, {AS_OF} AS ingestion_timestamp,
        'lineitem.parquet' AS source_file_name, 'run-1' AS pipeline_run_id FROM lineitem""",
)
def _(t):
    stamped = files.with_lineage(t.table("lineitem"), "run-1", t.as_of)
    return stamped.select(
        F.concat(F.lit("C"), "l_orderkey").alias("claim_id"),
        "ingestion_timestamp",
        "source_file_name",
        "pipeline_run_id",
    )


@query(
    "s05_record_hash",
    """SELECT claim_id, claim_line_id, md5(concat_ws('|', claim_id, claim_line_id, CAST(member_id AS VARCHAR),
        claim_status, coalesce(denial_reason, chr(0)), CAST(service_date AS VARCHAR))) AS record_hash FROM claims""",
)
def _(t):
    hashed = "claim_id claim_line_id member_id claim_status denial_reason service_date".split()
    claims = t.claims(hashed)
    return claims.select(
        "claim_id", "claim_line_id", x.record_hash([F.col(c) for c in hashed]).alias("record_hash")
    )


@query("s05_record_hash64")
def _(t):
    return t.claims(["claim_id", "claim_line_id", "member_id", "claim_status"]).select(
        "claim_id", "claim_line_id", F.xxhash64("claim_id", "claim_line_id", "member_id", "claim_status").alias("h")
    )


def _nulls(columns: str) -> str:
    return ", ".join(f"{n_if(f'{c} IS NULL')} AS null_{c}" for c in columns.split())


@query(
    "s06_claims_profile",
    f"""SELECT COUNT(*) AS total_rows, {_nulls('claim_id claim_line_id member_id provider_id claim_amount')},
        {n_if('claim_amount < 0')} AS negative_amounts,
        COUNT(*) - COUNT(DISTINCT claim_id || '_' || claim_line_id) AS duplicate_keys FROM claims""",
)
def _(t):
    return quality.claims_profile(t.claims("claim_id claim_line_id member_id provider_id claim_amount".split()))


@query(
    "s07_members_profile",
    f"""SELECT COUNT(*) AS total_rows, {_nulls('member_id member_first_name member_last_name dob gender')},
        {n_if("gender NOT IN ('M', 'F')")} AS invalid_genders, {n_if(f'dob > {AS_OF}')} AS future_dob,
        COUNT(*) - COUNT(DISTINCT member_id) AS duplicate_keys FROM members""",
)
def _(t):
    return quality.members_profile(t.members(), t.cfg, t.as_of)


@query(
    "s08_providers_profile",
    f"""SELECT COUNT(*) AS total_rows, {_nulls('provider_id provider_name specialty network_status')},
        {n_if("network_status NOT IN ('IN_NETWORK', 'OUT_OF_NETWORK')")} AS invalid_network_status,
        {n_if('termination_date < effective_date')} AS invalid_dates,
        COUNT(*) - COUNT(DISTINCT provider_id) AS duplicate_keys FROM providers""",
)
def _(t):
    return quality.providers_profile(t.providers(), t.cfg)


@query(
    "s09_reference_intake",
    f"""SELECT p_type AS diagnosis_code, arg_min(p_name, (p_name, p_brand)) AS diagnosis_desc,
        arg_min(p_brand, (p_name, p_brand)) AS diagnosis_category FROM part GROUP BY p_type""",
)
def _(t):
    return dimensions.one_per_key(quality.require_rows(t.diagnosis_ref(), "diagnosis_ref"), "diagnosis_code")


@query(
    "s09_reference_duplicates",
    """SELECT 'diagnosis_ref' AS table_name, COUNT(*) AS total_rows, CAST(0 AS BIGINT) AS null_diagnosis_code,
        COUNT(*) - COUNT(DISTINCT p_type) AS duplicate_keys FROM part""",
)
def _(t):
    row = quality.profile(t.diagnosis_ref(), ["diagnosis_code"], ["diagnosis_code"])
    return row.select(F.lit("diagnosis_ref").alias("table_name"), "*")


_LINES = "CASE WHEN p_size % 3 = 0 THEN p_type ELSE p_type || ',' || p_name || CASE WHEN p_size % 2 = 0 THEN ', unspecified,' ELSE ',' END || p_brand END"


@query(
    "s09_reference_malformed",
    """SELECT p_type AS diagnosis_code, p_name || CASE WHEN p_size % 2 = 0 THEN ', unspecified' ELSE '' END
        AS diagnosis_desc, p_brand AS diagnosis_category, COUNT(*) AS line_count FROM part WHERE p_size % 3 <> 0
        GROUP BY ALL UNION ALL SELECT NULL, NULL, 'malformed', COUNT(*) FROM part WHERE p_size % 3 = 0""",
)
def _(t):
    lines = t.table("part").select(F.expr(_LINES).alias("value"))
    columns = ["diagnosis_code", "diagnosis_desc", "diagnosis_category"]
    good, bad = files.split_malformed(lines, columns)
    counted = good.groupBy(*columns).agg(F.count("*").alias("line_count"))
    rejected = bad.agg(F.count("*").alias("line_count")).withColumn("diagnosis_category", F.lit("malformed"))
    return counted.unionByName(rejected, allowMissingColumns=True)


@query("s10_empty_guard", "SELECT COUNT(*) AS row_count FROM lineitem")
def _(t):
    claims = quality.require_rows(t.claims(["claim_id"]), "claims")
    return claims.agg(F.count("*").alias("row_count"))


@query("s11_member_age", f"SELECT member_id, CAST({AGE} AS INTEGER) AS calculated_age FROM members")
def _(t):
    return t.members().select("member_id", x.years_between(F.col("dob"), t.as_of).alias("calculated_age"))


@query(
    "s11_provider_active",
    f"""SELECT provider_id, (termination_date IS NULL OR termination_date > {AS_OF}) AS is_active_provider
        FROM providers""",
)
def _(t):
    active = x.active(F.col("termination_date"), t.as_of)
    return t.providers().select("provider_id", active.alias("is_active_provider"))


@query(
    "s12_incremental_read",
    """SELECT claim_id, claim_line_id, submission_date FROM claims
        WHERE submission_date > (SELECT max(submission_date) - 60 FROM claims)""",
)
def _(t):
    claims = t.claims(["claim_id", "claim_line_id", "submission_date"])
    marks = claims.agg(F.date_sub(F.max("submission_date"), 60).alias("high_water_mark"))
    marks = marks.withColumn("table_name", F.lit("claims"))
    return tables.above_mark(claims, "submission_date", tables.high_water_mark(marks, "claims"))


@query(
    "s13_append_merge",
    """SELECT claim_id, claim_amount, CASE WHEN claim_status = 'DENIED' THEN denial_reason END AS denial_reason
        FROM claims WHERE claim_status IN ('PAID', 'DENIED')""",
)
def _(t):
    path = scratch.fresh(t.spark, "append")
    claims = t.claims(["claim_id", "claim_amount", "claim_status", "denial_reason"])
    tables.append(claims.filter("claim_status = 'PAID'").select("claim_id", "claim_amount"), path)
    denied = claims.filter("claim_status = 'DENIED'").select("claim_id", "claim_amount", "denial_reason")
    tables.append(denied, path)
    return tables.read_merged(t.spark, path)


@query(
    "s14_partition_overwrite",
    """SELECT claim_id, claim_line_id, claim_amount, claim_status FROM claims
        WHERE claim_status <> 'DENIED' OR place_of_service = '1'""",
)
def _(t):
    path = scratch.fresh(t.spark, "partitions")
    claims = t.claims(["claim_id", "claim_line_id", "claim_amount", "claim_status", "place_of_service"])
    tables.overwrite_partitions(claims, path, ["claim_status"], files_per_partition=8)
    again = claims.filter("claim_status = 'DENIED' AND place_of_service = '1'")
    tables.overwrite_partitions(again, path, ["claim_status"], files_per_partition=8)
    return t.spark.read.parquet(path).drop("place_of_service")


@query("s14_version_publish", "SELECT claim_id, claim_amount FROM claims WHERE claim_status = 'PAID'")
def _(t):
    path = scratch.fresh(t.spark, "versions")
    claims = t.claims(["claim_id", "claim_amount", "claim_status"])
    tables.publish_version(claims.select("claim_id", "claim_amount"), path, 1)
    tables.publish_version(claims.filter("claim_status = 'PAID'").select("claim_id", "claim_amount"), path, 2)
    return tables.read_version(t.spark, path)


_EVENT_COLUMNS = """event_id, claim_id, claim_line_id, event_type, old_status, new_status, denial_reason,
    event_timestamp, source_system"""


@query("s15_json_events", f"SELECT {_EVENT_COLUMNS} FROM status_source")
def _(t):
    path = scratch.fresh(t.spark, "events")
    stamp = F.date_format("event_timestamp", "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX")
    t.events().withColumn("event_timestamp", stamp).drop("arrival").write.json(path)
    return files.read_events(t.spark, path).drop("additional_data")


@query(
    "s16_publish_projection",
    f"""SELECT claim_id, claim_line_id, claim_status, service_date,
        CAST(CAST(claim_amount AS DECIMAL(18,2)) AS DOUBLE) AS claim_amount, {AS_OF} AS publish_timestamp,
        'run-1' AS publish_run_id FROM claims""",
)
def _(t):
    claims = t.claims(["claim_id", "claim_line_id", "claim_status", "service_date", "claim_amount"])
    wide = claims.withColumn("tags", F.array("claim_status")).withColumn("m", F.create_map(F.lit("a"), F.lit(1)))
    published = publish.publish_projection(wide, "run-1", t.as_of)
    return published.withColumn("claim_amount", F.col("claim_amount").cast("double"))


@query(
    "s17_publish_log",
    f"""SELECT table_name, source_path, record_count, {AS_OF} AS publish_timestamp, 'run-1' AS pipeline_run_id,
        'PREPARED_FOR_PUBLISH' AS status, 'analytics' AS target_schema FROM (
        SELECT 'fact_claims' AS table_name, 'gold/fact_claims' AS source_path, COUNT(*) AS record_count FROM claims
        UNION ALL SELECT 'dim_member', 'gold/dim_member', COUNT(*) FROM members
        UNION ALL SELECT 'dim_provider', 'gold/dim_provider', COUNT(*) FROM providers)""",
)
def _(t):
    published = {
        "fact_claims": (t.fact(["claim_id"]), "gold/fact_claims"),
        "dim_member": (t.dim_member(), "gold/dim_member"),
        "dim_provider": (t.dim_provider(), "gold/dim_provider"),
    }
    return publish.publish_log(published, "run-1", t.as_of)


@query(
    "s18_ingest_log",
    f"""SELECT dataset, line_count, 'run-1' AS pipeline_run_id, {AS_OF} AS ingested_at FROM ({_LANDED})""",
)
def _(t):
    path = _landing(t)
    log = files.ingest_log(files.list_landing(t.spark, path), "run-1", t.as_of)
    return (
        log.join(_lines(t, path), "file_name")
        .groupBy("dataset", "pipeline_run_id", "ingested_at")
        .agg(F.sum("line_count").alias("line_count"))
    )


@query(
    "s19_write_verification",
    """SELECT COUNT(*) AS total_rows, COUNT(DISTINCT claim_id) AS distinct_claim_id,
        COUNT(DISTINCT member_id) AS distinct_member_id, COUNT(DISTINCT provider_id) AS distinct_provider_id,
        COUNT(DISTINCT claim_id || '_' || claim_line_id) AS distinct_keys FROM claims""",
)
def _(t):
    claims = t.claims(["claim_id", "claim_line_id", "member_id", "provider_id"])
    return publish.verify(claims, ["claim_id", "member_id", "provider_id"], ["claim_id", "claim_line_id"])


@query("s20_staging_projection", f"SELECT {', '.join(publish.STAGING_COLUMNS)} FROM fact")
def _(t):
    return t.fact(publish.STAGING_COLUMNS)


@query("s21_member_projection", f"SELECT {', '.join(publish.MEMBER_COLUMNS)} FROM dim_member")
def _(t):
    return t.dim_member().select(*publish.MEMBER_COLUMNS)


@query("s21_provider_projection", f"SELECT {', '.join(publish.PROVIDER_COLUMNS)} FROM dim_provider")
def _(t):
    return t.dim_provider().select(*publish.PROVIDER_COLUMNS)
