"""Validation rules as values: flag once, then split, count and report from the same flags."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from claimloom.config import REQUIRED, Settings
from claimloom.functions import fields as x
from claimloom.functions.exact import percent

REASONS = "quarantine_reasons"


@dataclass(frozen=True)
class Rule:
    """A named check. ``fails`` maps each reason text to the condition under which it applies; a
    condition that is null does not apply."""

    name: str
    fails: tuple[tuple[str, Column], ...]

    @property
    def failing(self) -> Column:
        return reduce(lambda a, b: a | b, [F.coalesce(c, F.lit(False)) for _, c in self.fails])


def _rule(name: str, *fails: tuple[str, Column]) -> Rule:
    return Rule(name, fails)


def _required(dataset: str) -> list[Rule]:
    return [_rule(f"null_{c}", (f"Missing {c}", F.col(c).isNull())) for c in REQUIRED[dataset]]


def claim_rules(cfg: Settings, as_of: Column) -> list[Rule]:
    amount, service = F.col("claim_amount"), F.col("service_date")
    return _required("claims") + [
        _rule(
            "invalid_amounts",
            ("Amount below minimum", amount < cfg.amount_min),
            ("Amount above maximum", amount > cfg.amount_max),
        ),
        _rule("invalid_statuses", ("Invalid status", ~F.col("claim_status").isin(*cfg.statuses))),
        _rule(
            "invalid_place_of_service",
            ("Invalid place of service", ~F.col("place_of_service").isin(*cfg.places)),
        ),
        _rule("future_service_dates", ("Future service date", service > as_of)),
        _rule("invalid_date_order", ("Invalid date order", service > F.col("submission_date"))),
        _rule(
            "invalid_diagnosis_codes",
            ("Invalid diagnosis code", ~x.matches(F.col("diagnosis_code"), cfg.icd_pattern)),
        ),
        _rule(
            "invalid_procedure_codes",
            ("Invalid procedure code", ~x.matches(F.col("procedure_code"), cfg.cpt_pattern)),
        ),
    ]


def member_rules(cfg: Settings, as_of: Column) -> list[Rule]:
    age = x.years_between(F.col("dob"), as_of)
    start, end = F.col("eligibility_start_date"), F.col("eligibility_end_date")
    return _required("members") + [
        _rule("invalid_genders", ("Invalid gender", ~F.col("gender").isin(*cfg.genders))),
        _rule("invalid_age", ("Invalid age", ~age.between(cfg.age_min, cfg.age_max))),
        _rule("future_dob", ("Future date of birth", F.col("dob") > as_of)),
        _rule("invalid_eligibility_dates", ("Invalid eligibility dates", start > end)),
    ]


def provider_rules(cfg: Settings, as_of: Column | None = None) -> list[Rule]:
    return _required("providers") + [
        _rule(
            "invalid_network_status",
            ("Invalid network status", ~F.col("network_status").isin(*cfg.networks)),
        ),
        _rule("invalid_dates", ("Invalid date range", F.col("termination_date") < F.col("effective_date"))),
        _rule("invalid_zip_codes", ("Invalid ZIP code", ~x.matches(F.col("zip_code"), cfg.zip_pattern))),
    ]


def flag(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """Adds the reason text: empty for a clean row. One projection, no action."""
    labelled = [(condition, label) for rule in rules for label, condition in rule.fails]
    return df.withColumn(REASONS, x.reasons(labelled))


def split(flagged: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Clean rows and quarantined rows; every row is in exactly one of them."""
    clean = F.col(REASONS) == ""
    return flagged.filter(clean).drop(REASONS), flagged.filter(~clean)


def quarantine(flagged: DataFrame, run_id: str, as_of: Column) -> DataFrame:
    return split(flagged)[1].withColumns(
        {"quarantine_run_id": F.lit(run_id), "quarantine_timestamp": as_of}
    )


def failure_counts(df: DataFrame, rules: Sequence[Rule], table: str) -> DataFrame:
    """Failed rows per rule in long form, from a single pass over the data."""
    counted = df.agg(
        F.count("*").alias("total_count"), *[F.count_if(r.failing).alias(r.name) for r in rules]
    )
    pairs = F.array(*[F.struct(F.lit(r.name).alias("rule_name"), F.col(r.name).alias("n")) for r in rules])
    return counted.select("total_count", F.explode(pairs).alias("p")).select(
        F.lit(table).alias("table_name"),
        F.col("p.rule_name").alias("rule_name"),
        F.col("p.n").alias("failed_count"),
        "total_count",
    )


def result_row(flagged: DataFrame, table: str, rule: str, run_id: str, as_of: Column) -> DataFrame:
    """The row that the quality table keeps for a validation run."""
    failed, total = F.count_if(F.col(REASONS) != ""), F.count("*")
    return flagged.agg(failed.alias("failed_count"), total.alias("total_count")).select(
        F.lit(run_id).alias("pipeline_run_id"),
        F.lit(table).alias("table_name"),
        F.lit(rule).alias("rule_name"),
        F.when(F.col("total_count") >= 0, F.lit("SUCCESS")).alias("status"),
        "failed_count",
        "total_count",
        F.coalesce(percent(F.col("total_count") - F.col("failed_count"), "total_count"), F.lit(0.0)).alias(
            "pass_rate"
        ),
        as_of.alias("run_timestamp"),
    )


def reason_histogram(quarantined: DataFrame, *, each: bool = False) -> DataFrame:
    """Rows per reason text, or per single reason when ``each`` is set."""
    text = F.explode(F.split(REASONS, ", ")) if each else F.col(REASONS)
    return quarantined.select(text.alias("reason")).groupBy("reason").agg(F.count("*").alias("row_count"))


# -- intake profiles ---------------------------------------------------------------------------
def profile(
    df: DataFrame,
    required: Sequence[str],
    key: Sequence[str],
    checks: dict[str, Column] | None = None,
) -> DataFrame:
    """Row count, nulls per required field, further checks and surplus rows per key in one row."""
    distinct_keys = F.count_distinct(F.struct(*[F.col(c) for c in key]))
    return df.agg(
        F.count("*").alias("total_rows"),
        *[F.count_if(F.col(c).isNull()).alias(f"null_{c}") for c in required],
        *[F.count_if(condition).alias(name) for name, condition in (checks or {}).items()],
        (F.count("*") - distinct_keys).alias("duplicate_keys"),
    )


def claims_profile(df: DataFrame) -> DataFrame:
    return profile(
        df,
        REQUIRED["claims"],
        ("claim_id", "claim_line_id"),
        {"negative_amounts": F.col("claim_amount") < 0},
    )


def members_profile(df: DataFrame, cfg: Settings, as_of: Column) -> DataFrame:
    checks = {
        "invalid_genders": ~F.col("gender").isin(*cfg.genders),
        "future_dob": F.col("dob") > as_of,
    }
    return profile(df, REQUIRED["members"], ("member_id",), checks)


def providers_profile(df: DataFrame, cfg: Settings) -> DataFrame:
    checks = {
        "invalid_network_status": ~F.col("network_status").isin(*cfg.networks),
        "invalid_dates": F.col("termination_date") < F.col("effective_date"),
    }
    return profile(df, REQUIRED["providers"], ("provider_id",), checks)


def require_rows(df: DataFrame, label: str) -> DataFrame:
    """Stops a load whose input has no rows; reads at most one row."""
    if df.isEmpty():
        raise ValueError(f"no rows in {label}")
    return df


# -- checks of the finished star ----------------------------------------------------------------
FACT_KEYS = ("member_sk", "provider_sk", "diagnosis_sk", "procedure_sk", "payer_sk")
DATE_KEYS = ("service_date_key", "submission_date_key")


def fact_checks(fact: DataFrame, as_of: Column) -> DataFrame:
    return fact.agg(
        *[F.count_if(F.col(c).isNull()).alias(f"null_{c}") for c in FACT_KEYS + DATE_KEYS],
        F.count_if(F.col("claim_amount") < 0).alias("negative_amounts"),
        F.count_if(F.col("service_date") > as_of).alias("future_service_dates"),
        F.count_if(F.col("processing_delay_days") < 0).alias("invalid_processing_delays"),
    )


def _verdict(faults: Column) -> Column:
    return F.when(faults == 0, F.lit("PASS")).otherwise(F.lit("FAIL"))


def integrity(fact: DataFrame, members: DataFrame, providers: DataFrame) -> DataFrame:
    """One row per gold table with its number of faults and a verdict."""
    fact_faults = fact.agg(
        F.lit("fact_claims").alias("table_name"),
        F.count("*").alias("total_records"),
        (
            F.count_if(F.col("member_sk").isNull())
            + F.count_if(F.col("provider_sk").isNull())
            + F.count_if(F.col("service_date_key").isNull())
            + F.count_if(F.col("claim_amount") < 0)
            + F.count_if(F.col("paid_amount") > F.col("claim_amount"))
        ).alias("faults"),
    )
    member_faults = members.agg(
        F.lit("dim_member").alias("table_name"),
        F.count("*").alias("total_records"),
        (
            F.count("*")
            - F.count_distinct("member_id")
            + F.count_if((F.col("member_age") < 0) | (F.col("member_age") > 120))
        ).alias("faults"),
    )
    versions = providers.groupBy("provider_id").agg(
        F.count("*").alias("n"), F.count_if(F.col("is_current")).alias("current")
    )
    provider_faults = versions.agg(
        F.lit("dim_provider").alias("table_name"),
        F.coalesce(F.sum("n"), F.lit(0)).alias("total_records"),
        F.count_if(F.col("current") > 1).alias("faults"),
    )
    rows = fact_faults.unionByName(member_faults).unionByName(provider_faults)
    return rows.withColumn("validation_status", _verdict(F.col("faults")))


def integrity_or_error(spark: SparkSession, table: str, read: Callable[[], DataFrame]) -> DataFrame:
    """``read()``, or an ERROR row when the table cannot be read: its absence is the finding."""
    try:
        return read()
    except AnalysisException:
        return spark.createDataFrame(
            [(table, None, None, "ERROR")],
            "table_name string, total_records long, faults long, validation_status string",
        )


def offending(df: DataFrame, condition: Column, name: str, keys: Sequence[str]) -> DataFrame:
    """Assertion as a query: the rows that break it."""
    return df.filter(F.coalesce(condition, F.lit(False))).select(F.lit(name).alias("assertion"), *keys)


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.groupBy(*keys).agg(F.count("*").alias("row_count")).filter("row_count > 1")


def missing_in(df: DataFrame, dim: DataFrame, on: str, key: str) -> DataFrame:
    """Distinct non-null values of ``on`` that the dimension does not hold. Folding the values first
    keeps a hot key to one row in the join."""
    values = df.select(F.col(on).alias("missing_key")).filter("missing_key IS NOT NULL")
    counted = values.groupBy("missing_key").agg(F.count("*").alias("row_count"))
    return counted.join(dim.select(F.col(key).alias("missing_key")), "missing_key", "left_anti")


# -- quality table -------------------------------------------------------------------------------
def grade(pass_rate: Column) -> Column:
    return x.ladder(
        [(pass_rate >= 98, "A"), (pass_rate >= 95, "B"), (pass_rate >= 90, "C"), (pass_rate >= 80, "D")],
        F.lit("F"),
    )
