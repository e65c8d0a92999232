"""What leaves the gold layer: projections, logs and verification rows."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Column order of the staged fact and of the conformed dimensions.
STAGING_COLUMNS = tuple(
    """claim_line_key claim_id claim_line_id member_sk provider_sk diagnosis_sk procedure_sk payer_sk
    service_date_key submission_date_key claim_amount paid_amount denied_amount pending_amount
    adjusted_amount is_paid_claim is_denied_claim is_pending_claim is_adjusted_claim
    is_high_value_claim is_out_of_network claim_status place_of_service diagnosis_code
    procedure_code payer_id member_age member_age_group member_gender member_state
    provider_specialty provider_specialty_category provider_network_status provider_region
    payer_type service_year service_quarter service_month service_season submission_year
    submission_quarter service_date submission_date processing_delay_days""".split()
)
MEMBER_COLUMNS = tuple(
    """member_sk member_id member_first_name member_last_name member_full_name dob gender city state
    zip_code plan_id eligibility_start_date eligibility_end_date member_age member_age_group
    is_eligible effective_start_date effective_end_date""".split()
)
PROVIDER_COLUMNS = tuple(
    """provider_sk provider_id provider_name specialty facility_name city state zip_code
    network_status effective_date termination_date is_current effective_start_date
    effective_end_date gold_row_hash provider_region specialty_category""".split()
)


def publish_projection(df: DataFrame, run_id: str, as_of: Column) -> DataFrame:
    """Columns a warehouse takes: no arrays or maps, timestamps as such, doubles as decimal(18,2)."""
    kept = []
    for field in df.schema.fields:
        column = F.col(field.name)
        if isinstance(field.dataType, (T.ArrayType, T.MapType)):
            continue
        if "timestamp" in field.name.lower():
            column = column.cast("timestamp")
        elif isinstance(field.dataType, (T.DoubleType, T.FloatType)):
            column = column.cast("decimal(18,2)")
        kept.append(column.alias(field.name))
    return df.select(*kept, as_of.alias("publish_timestamp"), F.lit(run_id).alias("publish_run_id"))


def publish_log(tables: Mapping[str, tuple[DataFrame, str]], run_id: str, as_of: Column) -> DataFrame:
    """One row per published table with its row count."""
    rows = None
    for name, (df, path) in tables.items():
        row = df.agg(F.count("*").alias("record_count")).select(
            F.lit(name).alias("table_name"),
            F.lit(path).alias("source_path"),
            "record_count",
            as_of.alias("publish_timestamp"),
            F.lit(run_id).alias("pipeline_run_id"),
            F.lit("PREPARED_FOR_PUBLISH").alias("status"),
            F.lit("analytics").alias("target_schema"),
        )
        rows = row if rows is None else rows.unionByName(row)
    return rows


def verify(df: DataFrame, ids: Sequence[str], key: Sequence[str]) -> DataFrame:
    """Total rows, distinct values per id column and distinct keys, from one aggregate."""
    return df.agg(
        F.count("*").alias("total_rows"),
        *[F.count_distinct(c).alias(f"distinct_{c}") for c in ids],
        F.count_distinct(F.struct(*[F.col(c) for c in key])).alias("distinct_keys"),
    )


def mask_members(members: DataFrame, salt: str) -> DataFrame:
    """Members without direct identifiers: hashed id, initials, birth year, three-digit ZIP."""

    def initial(name: str) -> Column:
        return F.regexp_replace(F.col(name), r"(?<=^.).*", "***").alias(name)

    return members.select(
        F.sha2(F.concat_ws("|", F.lit(salt), F.col("member_id").cast("string")), 256).alias("member_token"),
        initial("member_first_name"),
        initial("member_last_name"),
        F.trunc("dob", "year").alias("birth_year"),
        F.concat(F.substring("zip_code", 1, 3), F.lit("**")).alias("zip3"),
        "gender",
        "state",
    )


def entitled(df: DataFrame, entitlements: DataFrame, user: str, on: str) -> DataFrame:
    """Rows whose ``on`` value the user is entitled to."""
    mine = entitlements.filter(F.col("user_name") == user).select(F.col("value").alias(on))
    return df.join(mine, on, "left_semi")
