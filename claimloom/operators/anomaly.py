"""Anomaly flags on claims, built so that no window or join meets all claims of one key.

Day counts per key are folded before the shuffle, so a window sees one row per key and day. What
comes back to the claims is only the set of flagged keys, or one row per provider. These sets are
written first: Spark then knows their exact size, and joins them by broadcast without moving the
claims when they are small, by sort-merge when they are not.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from claimloom.config import Settings
from claimloom.functions import fields as x
from claimloom.functions.exact import money_sum, ratio
from claimloom.sources.scratch import written


def dense_days(
    claims: DataFrame,
    keys: Sequence[str],
    days: int,
    more_than: int,
    *,
    backward: bool = False,
    date: str = "service_date",
) -> DataFrame:
    """Keys and days whose following ``days`` days (the day itself included) hold more than
    ``more_than`` claims; with ``backward`` the days before count as well."""
    present = claims.filter(F.col(date).isNotNull())
    per_day = present.groupBy(*keys, date).agg(F.count("*").alias("__n"))
    frame = Window.partitionBy(*keys).orderBy(F.unix_date(date)).rangeBetween(-days if backward else 0, days)
    return per_day.withColumn("__n", F.sum("__n").over(frame)).filter(F.col("__n") > more_than).drop("__n")


def flag_members(claims: DataFrame, found: DataFrame, keys: Sequence[str], flag: str) -> DataFrame:
    """True for claims whose ``keys`` are in ``found`` (unique on them); null keys compare equal."""
    marked = written(found, flag).select(*[F.col(k).alias(f"__{k}") for k in keys], F.lit(True).alias(flag))
    on = [F.col(k).eqNullSafe(F.col(f"__{k}")) for k in keys]
    condition = on[0]
    for c in on[1:]:
        condition = condition & c
    joined = claims.join(marked, condition, "left").drop(*[f"__{k}" for k in keys])
    return joined.withColumn(flag, F.coalesce(F.col(flag), F.lit(False)))


def duplicates(claims: DataFrame, keys: Sequence[str], days: int, *, both: bool = False) -> DataFrame:
    """``duplicate_flag``: another claim of the same keys follows within ``days``."""
    found = dense_days(claims, keys, days, 1, backward=both)
    return flag_members(claims, found, [*keys, "service_date"], "duplicate_flag")


def frequent(claims: DataFrame, keys: Sequence[str], days: int, more_than: int) -> DataFrame:
    """``frequent_procedure_flag``: more than ``more_than`` claims of the keys within ``days``."""
    found = dense_days(claims, keys, days, more_than)
    return flag_members(claims, found, [*keys, "service_date"], "frequent_procedure_flag")


def provider_profile(claims: DataFrame) -> DataFrame:
    """Average amount and denial rate per provider, both from one aggregation."""
    return claims.groupBy("provider_id").agg(
        (money_sum("claim_amount") / F.count("claim_amount")).alias("provider_avg_amount"),
        ratio(F.count_if(F.col("claim_status") == "DENIED"), F.count("*")).alias("provider_denial_rate"),
    )


def _with_provider_profile(claims: DataFrame, source: DataFrame | None = None) -> DataFrame:
    """``claims`` with the figures of their provider, which are taken from ``source``."""
    profile = written(provider_profile(claims if source is None else source), "provider_profile").withColumnRenamed("provider_id", "__provider")
    return claims.join(profile, F.col("provider_id") == F.col("__provider"), "left").drop("__provider")


def _outlier(multiplier: float) -> Column:
    return F.coalesce(F.col("claim_amount") > F.col("provider_avg_amount") * multiplier, F.lit(False))


def _high_denial(threshold: float) -> Column:
    return F.coalesce(F.col("provider_denial_rate") > threshold, F.lit(False))


def outliers(claims: DataFrame, multiplier: float) -> DataFrame:
    """``amount_outlier_flag``: amount above ``multiplier`` times the provider's average."""
    return _with_provider_profile(claims).withColumn("amount_outlier_flag", _outlier(multiplier)).drop(
        "provider_avg_amount", "provider_denial_rate"
    )


def high_denial(claims: DataFrame, threshold: float) -> DataFrame:
    """``high_denial_provider_flag``: the claim's provider is in the high-denial set."""
    profile = provider_profile(claims)
    found = profile.filter(F.col("provider_denial_rate") > threshold).select("provider_id")
    return flag_members(claims, found, ["provider_id"], "high_denial_provider_flag")


# Flag, reason text and score.
FLAGS = (
    ("duplicate_flag", "Potential duplicate claim", 30),
    ("amount_outlier_flag", "Unusually high claim amount", 25),
    ("high_denial_provider_flag", "High denial rate provider", 20),
    ("frequent_procedure_flag", "Frequent procedure for member", 15),
)
AMOUNT_SCORE = 10


def combine(flagged: DataFrame) -> DataFrame:
    any_flag = F.greatest(*[F.col(flag) for flag, _, _ in FLAGS])
    return flagged.withColumns(
        {
            "anomaly_reasons": x.reasons([(F.col(flag), text) for flag, text, _ in FLAGS]),
            "has_anomaly": any_flag,
        }
    )


def detect(claims: DataFrame, cfg: Settings) -> DataFrame:
    """All four flags, the reasons and ``has_anomaly``. The flagged keys and the provider figures are found side by side, each from
    the few columns of the claims that it needs, and written; then the claims meet them once."""
    twice = dense_days(claims, cfg.duplicate_keys, cfg.duplicate_days, 1)
    often = dense_days(claims, cfg.frequent_keys, cfg.frequent_days, cfg.frequent_count)
    out = flag_members(claims, twice, [*cfg.duplicate_keys, "service_date"], "duplicate_flag")
    out = flag_members(out, often, [*cfg.frequent_keys, "service_date"], "frequent_procedure_flag")
    out = _with_provider_profile(out, claims).withColumns(
        {
            "amount_outlier_flag": _outlier(cfg.outlier_multiplier),
            "high_denial_provider_flag": _high_denial(cfg.denial_threshold),
        }
    )
    return combine(out.drop("provider_avg_amount", "provider_denial_rate"))


# The published columns of the anomaly mart before the scores.
MART_INPUT = tuple(
    """claim_line_key claim_id claim_line_id member_sk member_id provider_sk provider_id
    claim_amount claim_status service_date submission_date member_age provider_specialty_category
    payer_type diagnosis_code procedure_code place_of_service service_year service_month
    member_state""".split()
)


def score(cfg: Settings) -> Column:
    parts = [F.when(F.col(flag), F.lit(points)).otherwise(F.lit(0)) for flag, _, points in FLAGS]
    parts.append(F.when(F.col("claim_amount") > cfg.score_amount, F.lit(AMOUNT_SCORE)).otherwise(F.lit(0)))
    total = parts[0]
    for part in parts[1:]:
        total = total + part
    return total


def risk_level(points: Column, cfg: Settings) -> Column:
    return x.ladder([(points >= cfg.risk_high, "HIGH"), (points >= cfg.risk_medium, "MEDIUM")], F.lit("LOW"))


#: What the flags depend on.
DETECTION_INPUT = tuple("member_id provider_id claim_amount claim_status service_date diagnosis_code procedure_code".split())
#: What the mart's detection reads of a claim; the rest of the mart's columns, the payer among them, is looked up for flagged claims
#: only.
CLAIM_INPUT = tuple(
    """claim_id claim_line_id member_id provider_id claim_amount claim_status service_date submission_date
    diagnosis_code procedure_code place_of_service""".split()
)


def claim_anomalies(
    claims: DataFrame,
    cfg: Settings,
    widen: Callable[[DataFrame, list[str]], DataFrame],
    columns: Sequence[str] = MART_INPUT,
) -> DataFrame:
    """The anomaly mart of ``claims`` (``CLAIM_INPUT``), or some ``columns`` of it beside flags, reasons, amount, score and level.
    ``widen`` adds the dimension columns to flagged claims. The claim columns that detection and ``columns`` need are written once,
    so that the claims' own joins run once and not for every flag."""
    wanted = [c for c in MART_INPUT if c in columns or c == "claim_amount"]
    apart = {"submission_date", "place_of_service", "procedure_code", "claim_id", "claim_line_id"}  # nothing but the mart reads them
    ids = {"claim_id", "claim_line_id"} if "claim_line_key" in wanted else set()
    read = {*wanted, *ids, *cfg.duplicate_keys, *cfg.frequent_keys}
    shared = written(claims.select(*[c for c in claims.columns if c in read or c not in apart]), "claims")
    flagged = detect(shared, cfg).filter("has_anomaly")
    found = widen(flagged, [*wanted, *[flag for flag, _, _ in FLAGS], "anomaly_reasons"])
    scored = found.withColumn("anomaly_score", score(cfg))
    rated = scored.withColumn("anomaly_risk_level", risk_level(F.col("anomaly_score"), cfg))
    return rated.withColumn("requires_investigation", F.col("anomaly_risk_level") == "HIGH")
