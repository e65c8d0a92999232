"""The given tables seen as claims, members, providers, references, events and audit rows."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import replace
from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from claimloom.config import Settings
from claimloom.operators import audit, dimensions, quality
from claimloom.operators import fact as fact_op
from claimloom.operators.changes import latest
from claimloom.operators.star import Derived, Lookup, star
from claimloom.streaming import events as ev

AS_OF = "2001-07-31"
EVENTS_AS_OF = "2024-01-30 00:00:00"
DATE_START, DATE_END = "1990-01-01", "2010-12-31"

SETTINGS = replace(
    Settings(),
    places=("1", "2", "3", "4"),
    icd_pattern=r"^[A-KM-Z][A-Z]{4,7}$",
    cpt_pattern=r"^\d{2,7}$",
    high_value=50_000.0,
    high_cost=100_000.0,
    high_utilization=2,
    duplicate_keys=("provider_id", "member_id"),
    duplicate_days=365,
    outlier_multiplier=1.9,
    denial_threshold=0.35,
    frequent_keys=("member_id", "diagnosis_code"),
    frequent_days=90,
    score_amount=90_000.0,
)

# Expressions of the views; they read the same in Spark SQL and in ANSI SQL.
MEMBER = {
    "member_id": "c_custkey",
    "member_first_name": "split_part(c_name, '#', 1)",
    "member_last_name": "split_part(c_name, '#', 2)",
    "dob": "DATE '1915-01-01' + CAST((CAST(round(c_acctbal * 100) AS BIGINT) + 310000000) % 31000 AS INT)",
    "gender": "CASE WHEN c_custkey % 50 = 0 THEN 'U' WHEN c_custkey % 2 = 0 THEN 'F' ELSE 'M' END",
    "city": "concat('City ', c_nationkey)",
    "state": "n_name",
    "zip_code": "lpad(CAST(c_custkey * 7919 % 100000 AS VARCHAR(9)), 5, '0')",
    "plan_id": "c_mktsegment",
    "eligibility_start_date": "DATE '1994-01-01' + CAST(c_custkey % 1000 AS INT)",
    "eligibility_end_date": """CASE WHEN c_custkey % 97 = 0 THEN DATE '1993-12-31' + CAST(c_custkey % 1000 AS INT)
        WHEN c_custkey % 3 = 0 THEN NULL
        ELSE DATE '1994-01-01' + CAST(1000 + c_custkey % 1000 + c_custkey % 2500 AS INT) END""",
}
PROVIDER = {
    "provider_id": "s_suppkey",
    "provider_name": "s_name",
    "specialty": """CASE s_suppkey % 6 WHEN 0 THEN 'Internal Medicine' WHEN 1 THEN 'Cardiology'
        WHEN 2 THEN 'Orthopedics' WHEN 3 THEN 'Pediatrics' WHEN 4 THEN 'Vascular Surgery'
        ELSE 'Dermatology' END""",
    "facility_name": "CASE WHEN s_suppkey % 11 = 0 THEN NULL ELSE concat(s_name, ' Clinic') END",
    "city": "concat('City ', s_nationkey)",
    "state": """CASE s_nationkey % 8 WHEN 0 THEN 'CA' WHEN 1 THEN 'AZ' WHEN 2 THEN 'UT' WHEN 3 THEN 'TX'
        WHEN 4 THEN 'NY' WHEN 5 THEN 'FL' WHEN 6 THEN 'OH' ELSE 'WA' END""",
    "zip_code": """CASE WHEN s_suppkey % 13 = 0 THEN '12A45'
        ELSE lpad(CAST(s_suppkey * 37 % 100000 AS VARCHAR(9)), 5, '0') END""",
    "network_status": """CASE WHEN s_suppkey % 41 = 40 THEN 'UNKNOWN' WHEN s_acctbal < 0 THEN 'OUT_OF_NETWORK'
        ELSE 'IN_NETWORK' END""",
    "effective_date": "DATE '1990-01-01' + CAST(s_suppkey % 3000 AS INT)",
    "termination_date": """CASE WHEN s_suppkey % 34 = 0 THEN DATE '1989-12-01' + CAST(s_suppkey % 3000 AS INT)
        WHEN s_suppkey % 17 = 0 THEN DATE '1990-01-01' + CAST(s_suppkey % 3000 + 4000 AS INT) END""",
}
CLAIM = {
    "claim_id": "concat('C', l_orderkey)",
    "claim_line_id": "concat('L', l_linenumber)",
    "provider_id": "l_suppkey",
    "procedure_code": "l_partkey",
    "claim_amount": "l_extendedprice",
    "claim_status": """CASE WHEN l_returnflag = 'R' THEN 'DENIED' WHEN l_returnflag = 'A' THEN 'ADJUSTED'
        WHEN l_linestatus = 'F' THEN 'PAID' ELSE 'PENDING' END""",
    "submission_date": "CAST(l_shipdate AS DATE)",
}
#: The numbers that the texts of a claim's keys are made of, one to one.
KEY_NUMBERS = {"claim_id": "l_orderkey", "claim_line_id": "l_linenumber"}
ORDER = {
    "member_id": "o_custkey",
    "service_date": "CAST(o_orderdate AS DATE)",
    "place_of_service": "substr(o_orderpriority, 1, 1)",
    "order_priority": "o_orderpriority",
}
CLAIM_COLUMNS = tuple(
    """claim_id claim_line_id member_id provider_id diagnosis_code procedure_code payer_id
    claim_amount service_date claim_status place_of_service submission_date denial_reason""".split()
)
EVENT = {
    "event_id": "concat('E', event_id)",
    "claim_id": "concat('C', user_id)",
    "claim_line_id": "concat('L', 1 + event_id % 3)",
    "event_type": """CASE WHEN event_type <> 'view' THEN 'STATUS_UPDATE' WHEN event_id % 3 = 0 THEN 'PAYMENT_POSTED'
        WHEN event_id % 3 = 1 THEN 'PROVIDER_CHANGE' ELSE 'AUDIT_NOTE' END""",
    "old_status": """CASE event_id % 4 WHEN 0 THEN 'PENDING' WHEN 1 THEN 'PAID' WHEN 2 THEN 'DENIED'
        ELSE 'ADJUSTED' END""",
    "new_status": """CASE event_type WHEN 'purchase' THEN 'PAID' WHEN 'error' THEN 'DENIED'
        WHEN 'signup' THEN 'PENDING' WHEN 'click' THEN 'ADJUSTED' END""",
    "denial_reason": "CASE WHEN event_type = 'error' THEN concat('REASON_', event_id % 5) END",
    "event_timestamp": "CAST(ts AS TIMESTAMP)",
    "source_system": "CASE WHEN event_id % 2 = 0 THEN 'adjudication_engine' ELSE 'portal' END",
}
RUN = {
    "pipeline_run_id": "concat('R', event_id)",
    "pipeline_name": "concat('pipeline_', user_id % 7)",
    "source_system": "concat('source_', user_id % 3)",
    "target_table": "concat('table_', user_id % 7)",
    "start_time": "CAST(ts AS TIMESTAMP)",
    "end_time": "CAST(ts AS TIMESTAMP) + INTERVAL 1 MINUTE * CAST(event_id % 200 AS INT)",
    "status": "CASE WHEN event_type = 'error' THEN 'FAILED' ELSE 'SUCCESS' END",
}
RESULT = {
    "pipeline_run_id": "concat('R', event_id)",
    "table_name": "concat('table_', user_id % 5)",
    "rule_name": "concat('rule_', event_type)",
    "status": "CASE WHEN event_id % 10 = 0 THEN 'FAILED' ELSE 'SUCCESS' END",
    "failed_count": "event_id % 20",
    "total_count": "200 + user_id",
    "run_timestamp": "CAST(ts AS TIMESTAMP)",
}


def exprs(mapping: dict[str, str]) -> list[Column]:
    return [F.expr(text).alias(name) for name, text in mapping.items()]


class Tables:
    """Lazy views over one folder of tables."""

    def __init__(self, spark: SparkSession, folder: str) -> None:
        self.spark, self.folder, self.cfg = spark, folder.rstrip("/"), SETTINGS
        self.as_of = F.lit(AS_OF).cast("date")
        self.events_as_of = F.lit(EVENTS_AS_OF).cast("timestamp")

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")

    # -- claims ------------------------------------------------------------------------------
    def claims(self, columns: Sequence[str] = CLAIM_COLUMNS, *, unique: bool = False) -> DataFrame:
        """Claim lines with the given columns; tables that none of them comes from are not read.

        ``unique`` keeps one row per claim line, the later submission first. That happens on the
        claim lines alone, so the lookups see fewer rows. The texts of the claim's keys are made after the lookups:
        rows are moved and sorted with the numbers alone.
        """
        own = {c: text for c, text in CLAIM.items() if c not in KEY_NUMBERS}
        base = self.table("lineitem").select(*KEY_NUMBERS.values(), "l_partkey", *exprs(own))
        if unique:
            order = [F.col(c).desc() for c in ("submission_date", "procedure_code", "provider_id", "claim_amount")]
            base = latest(base, list(KEY_NUMBERS.values()), order)
        lookups = [
            Lookup("orders", "l_orderkey", "o_orderkey", {c: c for c in ORDER}, self._orders),
            Lookup("part", "l_partkey", "p_partkey", {"diagnosis_code": "p_type"}, lambda: self.table("part")),
            *self._payers(),
        ]
        reason = Derived(
            ("claim_status", "order_priority"),
            lambda: F.when(F.col("claim_status") == "DENIED", F.col("order_priority")),
        )
        keys = {c: Derived((number,), lambda c=c: F.expr(CLAIM[c])) for c, number in KEY_NUMBERS.items()}
        return star(base, lookups, {**keys, "denial_reason": reason}, columns)

    def _payers(self) -> list[Lookup]:
        return [
            Lookup("customer", "member_id", "c_custkey", {"nation_key": "c_nationkey"}, lambda: self.table("customer")),
            Lookup(
                "nation",
                "nation_key",
                "n_nationkey",
                {"payer_id": "r_name"},
                self._nations,
                source=lambda: self.table("nation"),
            ),
        ]

    def with_payer(self, claims: DataFrame) -> DataFrame:
        """``claims`` without a payer, with that of their member."""
        return star(claims, self._payers(), {}, [*claims.columns, "payer_id"])

    def _orders(self) -> DataFrame:
        return self.table("orders").select("o_orderkey", *exprs(ORDER))

    def _nations(self) -> DataFrame:
        regions = self.table("region")
        return self.table("nation").join(regions, F.col("n_regionkey") == F.col("r_regionkey"), "left")

    def unique_claims(self, columns: Sequence[str] = CLAIM_COLUMNS) -> DataFrame:
        return self.claims(columns, unique=True)

    # -- people and references -----------------------------------------------------------------
    def members(self) -> DataFrame:
        nation = self.table("nation")
        return (
            self.table("customer")
            .join(nation, F.col("c_nationkey") == F.col("n_nationkey"), "left")
            .select(*exprs(MEMBER))
        )

    def providers(self) -> DataFrame:
        return self.table("supplier").select(*exprs(PROVIDER))

    def diagnosis_ref(self) -> DataFrame:
        return self.table("part").select(
            F.col("p_type").alias("diagnosis_code"),
            F.col("p_name").alias("diagnosis_desc"),
            F.col("p_brand").alias("diagnosis_category"),
        )

    def procedure_ref(self) -> DataFrame:
        return self.table("part").select(
            F.col("p_partkey").alias("procedure_code"),
            F.col("p_name").alias("procedure_desc"),
            F.col("p_brand").alias("procedure_category"),
        )

    def payer_ref(self) -> DataFrame:
        government = F.col("r_name").isin("AFRICA", "ASIA")
        return self.table("region").select(
            F.col("r_name").alias("payer_id"),
            F.concat(F.lit("Payer "), F.col("r_name")).alias("payer_name"),
            F.when(government, F.lit("Government")).otherwise(F.lit("Commercial")).alias("payer_type"),
        )

    # -- dimensions and fact ---------------------------------------------------------------------
    def dim_member(self) -> DataFrame:
        return dimensions.member_dim(self.members(), self.as_of)

    def dim_provider(self) -> DataFrame:
        return dimensions.provider_attributes(dimensions.first_load(self.providers(), self.as_of), self.cfg)

    def dim_date(self) -> DataFrame:
        return dimensions.date_dim(self.spark, DATE_START, DATE_END)

    @cached_property
    def frames(self) -> dict:
        ref = dimensions.reference_dim
        return {
            "member": self.dim_member,
            "provider": self.dim_provider,
            "diagnosis": lambda: ref(self.diagnosis_ref(), "diagnosis_code", "diagnosis_sk"),
            "procedure": lambda: ref(self.procedure_ref(), "procedure_code", "procedure_sk"),
            "payer": lambda: ref(self.payer_ref(), "payer_id", "payer_sk"),
            "date": self.dim_date,
        }

    def fact(self, columns: Sequence[str] = fact_op.COLUMNS, claims: DataFrame | None = None) -> DataFrame:
        """``claims``: rows to widen instead of all claims; columns of theirs may be asked for too."""
        return fact_op.fact_claims(self.claims if claims is None else claims, self.frames, self.cfg, columns, sources=self.sources)

    @cached_property
    def sources(self) -> dict:
        """The table behind each dimension, which bounds its rows."""
        return {
            "member": lambda: self.table("customer"),
            "provider": lambda: self.table("supplier"),
            "payer": lambda: self.table("region"),
        }

    # -- events ------------------------------------------------------------------------------------
    def events(self, raw: DataFrame | None = None) -> DataFrame:
        """Status events with their payload text and arrival time; ``raw`` may be a stream."""
        raw = self.table("events") if raw is None else raw
        payload = F.to_json(
            F.struct(
                F.col("value").alias("payment_amount"),
                F.date_format("ts", "yyyy-MM-dd").alias("payment_date"),
                F.concat(F.lit("P"), F.get_json_object("props", "$.k")).alias("processor_id"),
            )
        )
        minutes = F.make_dt_interval(mins=(F.col("event_id") % 10).cast("int"))
        return raw.select(
            *exprs(EVENT),
            payload.alias("additional_data"),
            (F.col("ts").cast("timestamp") + minutes).alias("arrival"),
        )

    def status_events(self) -> DataFrame:
        """Events that pass validation."""
        flagged = ev.flag_events(self.events(), self.cfg, F.col("arrival"))
        return flagged.filter("is_valid").drop("is_valid")

    # -- audit ---------------------------------------------------------------------------------------
    def runs(self) -> DataFrame:
        return self.table("events").select(*exprs(RUN))

    def quality_results(self) -> DataFrame:
        rate = F.expr("(total_count - failed_count) * CAST(100 AS DOUBLE) / total_count")
        return self.table("events").select(*exprs(RESULT)).withColumn("pass_rate", rate)

    def row_counts(self) -> DataFrame:
        """Events per type and day, as if each type were a table that is counted daily."""
        day = F.to_date("ts").alias("run_date")
        return (
            self.table("events")
            .groupBy(F.col("event_type").alias("table_name"), day)
            .agg(F.count("*").alias("record_count"))
        )

    def stream_monitoring(self) -> DataFrame:
        """Last event per user, as if each user were a stream; some are switched off."""
        return (
            self.table("events")
            .groupBy(F.concat(F.lit("stream_"), F.col("user_id")).alias("stream_name"))
            .agg(F.max(F.col("ts").cast("timestamp")).alias("last_event_time"), F.max("user_id").alias("__u"))
            .select("stream_name", "last_event_time", (F.col("__u") % 10 != 0).alias("is_active"))
        )

    def health_inputs(self) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
        """Run, quality and volume metrics and the integrity rows."""
        day = F.to_date(self.events_as_of)
        return (
            audit.run_metrics(self.runs(), self.events_as_of),
            audit.quality_metrics(self.quality_results(), self.events_as_of),
            audit.volume_metrics(self.row_counts(), day),
            self.integrity(),
        )

    def integrity(self) -> DataFrame:
        columns = "member_sk provider_sk service_date_key claim_amount paid_amount".split()
        return quality.integrity(self.fact(columns), self.dim_member(), self.dim_provider())
