"""Thresholds and domains. Operators receive a ``Settings`` value; nothing is read from globals."""

from __future__ import annotations

from dataclasses import dataclass, field

# The domains below must equal the ones the claims contract names.
STATUSES = ("PENDING", "PAID", "DENIED", "ADJUSTED")
GENDERS = ("M", "F")
NETWORKS = ("IN_NETWORK", "OUT_OF_NETWORK")
PLACES_OF_SERVICE = tuple(
    """11 12 21 22 23 24 25 26 31 32 33 34 41 42 49 50 51 52 53 54 55 56 57 58 59 60 61 62
    63 64 65 66 67 68 69 70 71 72 73 74 75 76 77 78 79 80 81 82 83 84 85 86 87 88 89 90 91
    92 93 94 95 96 97 98 99""".split()
)
REQUIRED = {
    "claims": ("claim_id", "claim_line_id", "member_id", "provider_id", "claim_amount"),
    "members": ("member_id", "member_first_name", "member_last_name", "dob", "gender"),
    "providers": ("provider_id", "provider_name", "specialty", "network_status"),
}
ICD_PATTERN = r"^[A-Z]\d{2}(\.\d{1,3})?$"
CPT_PATTERN = r"^\d{5}$"
ZIP_PATTERN = r"^\d{5}$"
TRANSITIONS = (
    ("PENDING", "PAID"),
    ("PENDING", "DENIED"),
    ("DENIED", "ADJUSTED"),
    ("ADJUSTED", "PAID"),
)
# States per region, in the order in which a state is looked up.
REGION_STATES = (
    ("West", "CA OR WA NV AZ AK HI".split()),
    ("Mountain", "MT ID WY UT CO NM AZ".split()),
    ("Central", "ND SD NE KS OK TX MN IA MO AR LA".split()),
    ("East", "WI MI IL IN KY TN MS AL OH WV PA NY VT ME NH MA RI CT NJ DE MD DC".split()),
)
# Specialty patterns, the first that matches wins.
SPECIALTY_PATTERNS = (
    ("Primary Care", "(?i)family|internal|general"),
    ("Cardiology", "(?i)cardio|heart"),
    ("Orthopedics", "(?i)ortho|bone|joint"),
    ("Pediatrics", "(?i)pedi|child"),
    ("Surgery", "(?i)surg|operation"),
)
OTHER = "Other"


@dataclass(frozen=True)
class Settings:
    """Defaults are the contract's values; ``plans.model`` overrides some for the given tables."""

    # quality
    amount_min: float = 0.0
    amount_max: float = 100_000.0
    statuses: tuple[str, ...] = STATUSES
    places: tuple[str, ...] = PLACES_OF_SERVICE
    genders: tuple[str, ...] = GENDERS
    networks: tuple[str, ...] = NETWORKS
    age_min: int = 0
    age_max: int = 120
    icd_pattern: str = ICD_PATTERN
    cpt_pattern: str = CPT_PATTERN
    zip_pattern: str = ZIP_PATTERN
    # fact and marts
    high_value: float = 1_000.0
    high_cost: float = 10_000.0
    high_utilization: int = 12
    # anomalies
    duplicate_keys: tuple[str, ...] = ("provider_id", "member_id", "diagnosis_code", "procedure_code")
    duplicate_days: int = 1
    outlier_multiplier: float = 3.0
    denial_threshold: float = 0.3
    frequent_keys: tuple[str, ...] = ("member_id", "procedure_code")
    frequent_days: int = 7
    frequent_count: int = 3
    score_amount: float = 5_000.0
    risk_high: int = 50
    risk_medium: int = 25
    # streaming
    watermark: str = "5 minutes"
    late_seconds: int = 300
    drop_seconds: int = 3_600
    future_seconds: int = 3_600
    event_type: str = "STATUS_UPDATE"
    stalled_minutes: int = 30
    # audit
    report_hours: int = 24
    alert_pass_rate: float = 95.0
    alert_failures: int = 100
    alert_minutes: float = 120.0
    alert_deviation: float = 50.0
    fresh_hours: int = 2
    # dashboards
    months_recent: int = 12
    months_trend: int = 24
    months_risk: int = 6
    risk_denial_pct: float = 15.0
    hotspot_count: int = 10
    regions: tuple = field(default=REGION_STATES)
    specialties: tuple = field(default=SPECIALTY_PATTERNS)
