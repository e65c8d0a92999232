"""Declared schemas of the landing datasets; inference is never used."""

from __future__ import annotations

from pyspark.sql import types as T

# Column names and types of the landing files.
_DDL = {
    "claims": """claim_id string, claim_line_id string, member_id string, provider_id string,
        diagnosis_code string, procedure_code string, payer_id string, claim_amount double,
        service_date date, claim_status string, place_of_service string, submission_date date""",
    "members": """member_id string, member_first_name string, member_last_name string, dob date,
        gender string, city string, state string, zip_code string, plan_id string,
        eligibility_start_date date, eligibility_end_date date""",
    "providers": """provider_id string, provider_name string, specialty string,
        facility_name string, city string, state string, zip_code string,
        network_status string, effective_date date, termination_date date""",
    "diagnosis_ref": "diagnosis_code string, diagnosis_desc string, diagnosis_category string",
    "procedure_ref": "procedure_code string, procedure_desc string, procedure_category string",
    "payer_ref": "payer_id string, payer_name string, payer_type string",
    "claim_status_events": """event_id string, claim_id string, claim_line_id string,
        event_type string, old_status string, new_status string, denial_reason string,
        event_timestamp timestamp, source_system string""",
}
PAYLOAD = "payment_amount double, payment_date date, processor_id string"


def schema(name: str, *, streaming: bool = False) -> T.StructType:
    """Schema of a landing dataset; an unknown name raises ``KeyError``."""
    declared = T.StructType.fromDDL(_DDL[name])
    if streaming and name == "claim_status_events":
        declared = declared.add("additional_data", T.StringType())
    return declared


def names() -> list[str]:
    return list(_DDL)


def conform(df, name: str):
    """Declared columns of a dataset, cast to their declared types."""
    from pyspark.sql import functions as F

    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema(name)])
