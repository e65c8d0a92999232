"""The claims fact: one row per claim line with keys, attributes and measures."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from claimloom.config import Settings
from claimloom.functions import fields as x
from claimloom.operators.star import Derived, Lookup, required, star

# The published columns of the fact.
COLUMNS = tuple(
    """claim_id claim_line_id claim_line_key member_sk provider_sk diagnosis_sk procedure_sk payer_sk
    service_date_key submission_date_key claim_amount claim_status place_of_service diagnosis_code
    procedure_code payer_id member_age member_age_group member_gender member_state
    provider_specialty provider_specialty_category provider_network_status provider_region
    payer_type service_year service_quarter service_month service_season submission_year
    submission_quarter service_date submission_date is_paid_claim is_denied_claim
    is_pending_claim is_adjusted_claim paid_amount denied_amount pending_amount adjusted_amount
    processing_delay_days is_high_value_claim is_out_of_network member_id provider_id
    provider_name denial_reason""".split()
)


Frames = Mapping[str, Callable[[], DataFrame]]


def lookups(frames: Frames, sources: Frames | None = None) -> list[Lookup]:
    """Lookups in join order. ``frames`` maps a dimension name to a function that builds it;
    ``sources`` to the table that bounds its rows, where that is known."""
    date_frame, source = frames["date"], (sources or {}).get
    return [
        Lookup(
            "member",
            "member_id",
            "member_id",
            {
                "member_sk": "member_sk",
                "member_age": "member_age",
                "member_age_group": "member_age_group",
                "member_gender": "gender",
                "member_state": "state",
                "member_plan": "plan_id",
                "member_is_eligible": "is_eligible",
            },
            lambda: frames["member"]().filter("is_current"),
            source=source("member"),
        ),
        Lookup(
            "provider",
            "provider_id",
            "provider_id",
            {
                "provider_sk": "provider_sk",
                "provider_specialty": "specialty",
                "provider_specialty_category": "specialty_category",
                "provider_network_status": "network_status",
                "provider_region": "provider_region",
                "provider_name": "provider_name",
            },
            lambda: frames["provider"]().filter("is_current"),
            source=source("provider"),
        ),
        Lookup("diagnosis", "diagnosis_code", "diagnosis_code", {"diagnosis_sk": "diagnosis_sk"}, frames["diagnosis"]),
        Lookup(
            "procedure",
            "procedure_code",
            "procedure_code",
            {"procedure_sk": "procedure_sk", "procedure_category": "procedure_category"},
            frames["procedure"],
        ),
        Lookup(
            "payer",
            "payer_id",
            "payer_id",
            {"payer_sk": "payer_sk", "payer_type": "payer_type"},
            frames["payer"],
            source=source("payer"),
        ),
        Lookup(
            "service_day",
            "service_date",
            "date",
            {"service_date_key": "date_key"},
            date_frame,
            bounded=True,
        ),
        Lookup(
            "submission_day",
            "submission_date",
            "date",
            {"submission_date_key": "date_key"},
            date_frame,
            bounded=True,
        ),
    ]


def _status_columns(status: str) -> dict[str, Derived]:
    name = status.lower()
    is_status = F.col("claim_status") == status
    return {
        f"is_{name}_claim": Derived(("claim_status",), lambda: is_status),
        f"{name}_amount": Derived(
            ("claim_status", "claim_amount"),
            lambda: F.when(is_status, F.col("claim_amount")).otherwise(F.lit(0.0)),
        ),
    }


def calendar() -> dict[str, Derived]:
    """Parts of the dates themselves: a claim outside the date dimension has them too."""
    parts = {"year": F.year, "quarter": F.quarter, "month": F.month, "season": lambda c: x.season(F.month(c))}
    out = {f"service_{name}": Derived(("service_date",), lambda of=of: of("service_date")) for name, of in parts.items()}
    for name in ("year", "quarter"):
        out[f"submission_{name}"] = Derived(("submission_date",), lambda of=parts[name]: of("submission_date"))
    return out


def measures(cfg: Settings) -> dict[str, Derived]:
    out: dict[str, Derived] = {}
    for status in cfg.statuses:
        out.update(_status_columns(status))
    out.update(calendar())
    out["claim_line_key"] = Derived(
        ("claim_id", "claim_line_id"), lambda: F.concat("claim_id", F.lit("_"), "claim_line_id")
    )
    out["processing_delay_days"] = Derived(
        ("service_date", "submission_date"),
        lambda: x.delay_days(F.col("service_date"), F.col("submission_date")),
    )
    out["is_high_value_claim"] = Derived(("claim_amount",), lambda: F.col("claim_amount") > cfg.high_value)
    out["is_out_of_network"] = Derived(
        ("provider_network_status",), lambda: F.col("provider_network_status") == "OUT_OF_NETWORK"
    )
    return out


def fact_claims(
    claims: DataFrame | Callable[[Sequence[str]], DataFrame],
    frames: Frames,
    cfg: Settings,
    columns: Sequence[str] = COLUMNS,
    *,
    sources: Frames | None = None,
) -> DataFrame:
    """``columns`` of the fact. A dimension that no requested column comes from is not joined.

    ``claims`` may be a function of the claim columns needed, so that a view over several tables can
    leave out joins too.
    """
    looked_up, derived = lookups(frames, sources), measures(cfg)
    need = required(columns, looked_up, derived)
    given = {name for lk in looked_up for name in lk.gives} | set(derived)
    base = claims(sorted(need - given)) if callable(claims) else claims
    return star(base, looked_up, derived, columns)


def silver_enrich(claims: DataFrame, frames: Frames) -> DataFrame:
    """Claims with the texts of the diagnosis, procedure and payer references. The references hold
    one row per key, so the number of claims stays the same."""
    parts = [
        Lookup(name, key, key, {c: c for c in gives}, frames[name])
        for name, key, gives in (
            ("diagnosis", "diagnosis_code", ("diagnosis_desc", "diagnosis_category")),
            ("procedure", "procedure_code", ("procedure_desc", "procedure_category")),
            ("payer", "payer_id", ("payer_name", "payer_type")),
        )
    ]
    wanted = list(claims.columns) + [c for p in parts for c in p.gives]
    return star(claims, parts, {}, wanted)
