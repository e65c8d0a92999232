"""Gold marts and the summaries that are published on top of them."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from claimloom.config import OTHER, Settings
from claimloom.functions import fields as x
from claimloom.functions.exact import cents, count_stddev, from_cents, money_avg, money_sum, rate_avg, ratio
from claimloom.operators.dashboards import denial_pct
from claimloom.operators.fact import Frames, calendar, lookups
from claimloom.operators.ranking import with_row_number, with_row_numbers
from claimloom.operators.star import star

STATUSES = ("paid", "denied", "pending", "adjusted")

# The grains of the published marts.
PROVIDER_KEYS = tuple(
    """provider_sk provider_id provider_specialty provider_specialty_category
    provider_network_status provider_region service_year service_quarter service_month""".split()
)
DENIAL_KEYS = tuple(
    """service_year service_quarter service_month payer_type provider_specialty_category
    provider_region member_age_group member_gender member_state diagnosis_code procedure_code
    place_of_service""".split()
)
MEMBER_KEYS = tuple(
    """member_sk member_id member_age member_age_group member_gender member_state service_year
    service_quarter service_month""".split()
)
DENIAL_ATTRIBUTES = tuple(c for c in DENIAL_KEYS if c not in ("service_year", "service_quarter", "service_month"))
# What the marts read from the fact. Attributes of a provider, a member or a month that the grain
# determines are looked up after the aggregation, on far fewer and narrower rows.
PROVIDER_INPUT = tuple(
    """provider_id service_date claim_status claim_amount paid_amount denied_amount pending_amount
    adjusted_amount is_high_value_claim processing_delay_days member_sk member_age""".split()
)
DENIAL_INPUT = DENIAL_ATTRIBUTES + tuple(
    "service_date provider_sk member_sk claim_id claim_amount is_denied_claim processing_delay_days".split()
)
# What the denial mart reads when its distinct counts are not wanted.
DENIAL_TOTALS_INPUT = DENIAL_ATTRIBUTES + tuple("service_date claim_amount is_denied_claim processing_delay_days".split())
MEMBER_INPUT = tuple(
    """member_id service_date claim_status claim_amount
    provider_sk provider_specialty_category payer_sk diagnosis_code procedure_code
    processing_delay_days""".split()
)


def _month() -> Column:
    return F.trunc("service_date", "MM").alias("service_date")


def _status_count(status: str) -> Column:
    return F.count_if(F.col("claim_status") == status)


def _with_rates(df: DataFrame, rates: dict[str, tuple[str, str]]) -> DataFrame:
    return df.withColumns({name: ratio(a, b) for name, (a, b) in rates.items()})


def provider_performance(fact: DataFrame, frames: Frames) -> DataFrame:
    """Provider by month. Grouped by provider and month start; names, categories and calendar
    columns follow from those two."""
    totals = fact.groupBy("provider_id", _month()).agg(
        F.count("*").alias("total_claims"),
        money_sum("claim_amount").alias("total_claim_amount"),
        money_avg("claim_amount").alias("avg_claim_amount"),
        F.max("claim_amount").alias("max_claim_amount"),
        F.min("claim_amount").alias("min_claim_amount"),
        *[money_sum(f"{s}_amount").alias(f"total_{s}_amount") for s in STATUSES],
        *[_status_count(s.upper()).alias(f"{s}_claims") for s in STATUSES],
        F.count_if("is_high_value_claim").alias("high_value_claims"),
        F.count_distinct("member_sk").alias("unique_members"),
        F.avg("processing_delay_days").alias("avg_processing_delay_days"),
        F.avg("member_age").alias("avg_member_age"),
    )
    wide = _widened(totals, frames, PROVIDER_KEYS)
    outside = F.coalesce(F.col("provider_network_status") == "OUT_OF_NETWORK", F.lit(False))
    counted = wide.withColumn(
        "out_of_network_claims", F.when(outside, F.col("total_claims")).otherwise(F.lit(0))
    )
    rates = {f"{c}_rate": (f"{c}_claims", "total_claims") for c in ("paid", "pending", "adjusted")}
    rates |= {
        "denial_rate": ("denied_claims", "total_claims"),
        "out_of_network_rate": ("out_of_network_claims", "total_claims"),
        "high_value_rate": ("high_value_claims", "total_claims"),
        "payment_rate": ("total_paid_amount", "total_claim_amount"),
        "avg_claim_per_member": ("total_claims", "unique_members"),
    }
    return _with_rates(counted, rates)


def _widened(totals: DataFrame, frames: Frames, keys: Sequence[str]) -> DataFrame:
    """Grouped rows with the dimension columns of ``keys``. The month start takes the place of the
    service date, so the date range must begin on the first of a month."""
    measures = [c for c in totals.columns if c not in keys and c != "service_date"]
    return star(totals, lookups(frames), calendar(), [*keys, *measures])


def denials_within(fact: DataFrame, payer_type: str | None = None, first: Column | None = None, last: Column | None = None) -> DataFrame:
    """Claims of one payer type whose month begins within ``first`` and ``last``. The conditions are on the service date and the
    payer type themselves, so they reach the scans below the mart."""
    if payer_type is not None:
        fact = fact.filter(F.col("payer_type") == payer_type)
    if first is not None:
        fact = fact.filter(F.col("service_date") >= F.trunc(F.add_months(F.date_sub(first, 1), 1), "MM"))
    if last is not None:
        fact = fact.filter(F.col("service_date") <= F.last_day(last))
    return fact


def denial_trends(fact: DataFrame, *, distinct: bool = True) -> DataFrame:
    """Denials and totals per group. Totals come from all claims in one narrow aggregation; only the
    denied claims go through the distinct counts. Both sides are
    hash-partitioned by the same struct, so joining them moves no rows, and null keys compare equal.
    Without ``distinct`` there is the first aggregation alone; ``fact`` then needs ``DENIAL_TOTALS_INPUT`` only."""
    key = F.struct(F.trunc("service_date", "MM").alias("month"), *DENIAL_ATTRIBUTES).alias("__key")
    ids = ["provider_sk", "member_sk", "claim_id"] if distinct else []
    rows = fact.select(key, "is_denied_claim", "claim_amount", "processing_delay_days", *ids)
    denied = F.col("is_denied_claim")

    def if_denied(column: str) -> Column:
        return F.when(denied, F.col(column))

    totals = rows.groupBy("__key").agg(
        F.count_if(denied).alias("denied_claims_count"),
        money_sum(if_denied("claim_amount")).alias("denied_amount"),
        money_avg(if_denied("claim_amount")).alias("avg_denied_amount"),
        F.max(if_denied("claim_amount")).alias("max_denied_amount"),
        F.min(if_denied("claim_amount")).alias("min_denied_amount"),
        F.avg(if_denied("processing_delay_days")).alias("avg_processing_delay_days"),
        F.count("*").alias("total_claims_count"),
        money_sum("claim_amount").alias("total_amount"),
    )
    joined = totals.filter("denied_claims_count > 0")
    if distinct:
        unique = {"unique_providers": "provider_sk", "unique_members": "member_sk", "unique_claims_denied": "claim_id"}
        counts = grouped_once(rows.filter(denied).select("__key", *ids), ["__key"], {}, unique)
        joined = joined.join(counts, "__key")
    month = F.col("__key.month")
    measures = [c for c in joined.columns if c != "__key"]
    kept = joined.select(
        F.year(month).alias("service_year"),
        F.quarter(month).alias("service_quarter"),
        F.month(month).alias("service_month"),
        *[F.col(f"__key.{c}").alias(c) for c in DENIAL_ATTRIBUTES],
        *measures,
        month.alias("denial_date"),
    )
    return _with_rates(
        kept,
        {
            "denial_count_rate": ("denied_claims_count", "total_claims_count"),
            "denial_amount_rate": ("denied_amount", "total_amount"),
        },
    )


def member_utilization(fact: DataFrame, frames: Frames, cfg: Settings) -> DataFrame:
    """Member by month, grouped by those two alone as in ``provider_performance``."""
    labels = [n for n, _ in cfg.specialties] + [OTHER]
    rows = fact.select("member_id", _month(), *[c for c in MEMBER_INPUT if c not in ("member_id", "service_date")])
    amount, status = F.col("claim_amount"), F.col("claim_status")

    def number(condition: Column) -> Column:
        return F.when(condition, F.lit(1)).otherwise(F.lit(0)).cast("long")

    def of(value: str) -> Column:
        return F.when(status == value, cents(amount)).otherwise(F.lit(0).cast("long"))

    summed = grouped_once(
        rows,
        ["member_id", "service_date"],
        {
            "total_claims": (F.sum, F.lit(1).cast("long")),
            "__cents": (F.sum, cents(amount)),
            "__amounts": (F.sum, number(amount.isNotNull())),
            "max_claim_amount": (F.max, amount),
            "__paid": (F.sum, of("PAID")),
            "__denied": (F.sum, of("DENIED")),
            "paid_claims": (F.sum, number(status == "PAID")),
            "denied_claims": (F.sum, number(status == "DENIED")),
            "high_value_claims": (F.sum, number(amount > cfg.high_value)),
            "__labels": (F.bit_or, _label_bits("provider_specialty_category", labels)),
            "__delay": (F.sum, F.col("processing_delay_days").cast("long")),
            "__delays": (F.sum, number(F.col("processing_delay_days").isNotNull())),
        },
        {
            "unique_providers": "provider_sk",
            "unique_payers": "payer_sk",
            "unique_diagnoses": "diagnosis_code",
            "unique_procedures": "procedure_code",
        },
    )
    totals = summed.select(
        "member_id",
        "service_date",
        "total_claims",
        from_cents("__cents").alias("total_claim_amount"),
        F.try_divide(from_cents("__cents"), F.col("__amounts")).alias("avg_claim_amount"),
        "max_claim_amount",
        from_cents("__paid").alias("total_paid_amount"),
        from_cents("__denied").alias("total_denied_amount"),
        "paid_claims",
        "denied_claims",
        "high_value_claims",
        "unique_providers",
        F.bit_count("__labels").cast("long").alias("unique_specialties"),
        "unique_payers",
        "unique_diagnoses",
        "unique_procedures",
        ratio("__delay", "__delays").alias("avg_processing_delay_days"),
    )
    rated = _with_rates(
        _widened(totals, frames, MEMBER_KEYS),
        {
            "denial_rate": ("denied_claims", "total_claims"),
            "high_value_rate": ("high_value_claims", "total_claims"),
            "payment_rate": ("total_paid_amount", "total_claim_amount"),
            "avg_claims_per_provider": ("total_claims", "unique_providers"),
        },
    )
    return rated.withColumns(
        {
            "utilization_date": x.month_start(F.col("service_year"), F.col("service_month")),
            "is_high_utilization": F.col("total_claims") > cfg.high_utilization,
            "is_high_cost_member": F.col("total_claim_amount") > cfg.high_cost,
        }
    )


def _label_bits(column: str, labels: Sequence[str]) -> Column:
    """One bit per label of a closed list: the bits of a group say how many labels it has, so that costs no further copy of
    the rows as another distinct count would."""
    bit = F.lit(0)
    for position, label in enumerate(labels):
        bit = F.when(F.col(column) == label, F.lit(1 << position)).otherwise(bit)
    return bit


Measures = Mapping[str, tuple[Callable[[Column], Column], Column]]


def grouped_once(rows: DataFrame, keys: Sequence[str], measures: Measures, distinct: Mapping[str, str]) -> DataFrame:
    """One row per group with ``measures`` (name: aggregate and value; sums, extremes and the like, which may be taken of partial
    results) and distinct counts (name: column). For groups of few rows, where combining before a shuffle saves nothing: rows move
    once, by the group's keys, and are copied for the distinct counts behind the shuffle, where plain ``count_distinct`` moves a copy
    per count and then the groups. Null keys are a group; the rows of a group meet in one task, which aggregates them in a hash table
    that spills, so a large group costs time there and no memory."""
    moved = rows.repartition(*[F.col(k) for k in keys])
    schema, values = rows.schema, dict.fromkeys(distinct.values())

    def copy(kind: int) -> Column:
        kept = [(F.col(c) if kind == k else F.lit(None).cast(schema[c].dataType)).alias(f"__v{k}") for k, c in enumerate(values, 1)]
        given = [(value if kind == 0 else F.when(F.lit(False), value)).alias(f"__m_{name}") for name, (_, value) in measures.items()]
        return F.struct(F.lit(kind).alias("__kind"), *kept, *given)

    kinds = range(0 if measures else 1, len(values) + 1)
    copies = moved.select(*keys, F.explode(F.array(*[copy(k) for k in kinds])).alias("__row")).select(*keys, "__row.*")
    once = copies.groupBy(*keys, "__kind", *[f"__v{k}" for k in range(1, len(values) + 1)]).agg(
        F.count("*").alias("__n"), *[how(F.col(f"__m_{name}")).alias(f"__m_{name}") for name, (how, _) in measures.items()]
    )
    place = {c: k for k, c in enumerate(values, 1)}
    return once.groupBy(*keys).agg(
        *[how(F.col(f"__m_{name}")).alias(name) for name, (how, _) in measures.items()],
        *[F.count_if((F.col("__kind") == place[c]) & F.col(f"__v{place[c]}").isNotNull()).alias(name) for name, c in distinct.items()],
    )


# -- second layer ----------------------------------------------------------------------------------
def provider_scorecard(mart: DataFrame, providers: DataFrame, ranks: Sequence[str] | None = None) -> DataFrame:
    """Provider mart with address, four ranks by amount (or those named) and three bands. A rank within a
    period only needs the mart of that period."""
    details = providers.filter("is_current").select(
        F.col("provider_sk").alias("__sk"),
        "provider_name",
        "facility_name",
        F.col("city").alias("provider_city"),
        F.col("state").alias("provider_state"),
    )
    enriched = mart.join(details, F.col("provider_sk") == F.col("__sk"), "left").drop("__sk")
    return with_bands(with_four_ranks(enriched, ranks=ranks))


# Rank names and their groups.
RANK_GROUPS = {
    "specialty_rank_quarter": ("service_year", "service_quarter", "provider_specialty_category"),
    "specialty_rank_year": ("service_year", "provider_specialty_category"),
    "regional_rank_quarter": ("service_year", "service_quarter", "provider_region"),
    "regional_rank_year": ("service_year", "provider_region"),
}
MONTH_TIES = ("total_claim_amount", "provider_id", "service_month", "provider_network_status", "provider_sk")


def with_four_ranks(
    mart: DataFrame, ties: Sequence[str] = MONTH_TIES, ranks: Sequence[str] | None = None
) -> DataFrame:
    """Ranks by amount within specialty and region, per quarter and year. The groups are few and
    grow with the number of providers, hence ``with_row_numbers``."""
    order = [F.col("total_claim_amount").desc()] + [F.col(c).asc() for c in ties[1:]]
    return with_row_numbers(mart, {name: RANK_GROUPS[name] for name in ranks or RANK_GROUPS}, order)


def with_bands(mart: DataFrame) -> DataFrame:
    return mart.withColumns(
        {
            "volume_category": x.volume_band(F.col("total_claim_amount")),
            "denial_performance_category": x.denial_band(F.col("denial_rate")),
            "value_category": x.value_band(F.col("avg_claim_amount")),
        }
    )


def rollup_rank(mart: DataFrame, grain: Sequence[str], name: str) -> DataFrame:
    """True rank of a provider for a whole quarter or year: amounts are added up first."""
    by = list(grain) + ["provider_specialty_category"]
    total = mart.groupBy("provider_id", *by).agg(money_sum("total_claim_amount").alias("total_claim_amount"))
    return with_row_number(total, name, by, [F.col("total_claim_amount").desc(), F.col("provider_id").asc()])


QUARTER_KEYS = ("payer_type", "provider_specialty_category", "service_year", "service_quarter")


def quarterly_denials(fact: DataFrame) -> DataFrame:
    """Denials per payer type, specialty and quarter, from the fact; quarters without one are left out."""
    denied = F.count_if(F.col("claim_status") == "DENIED")
    grouped = fact.groupBy(*QUARTER_KEYS).agg(
        denied.alias("denied_claims_count"), money_sum("denied_amount").alias("denied_amount")
    )
    return grouped.filter("denied_claims_count > 0")


def denial_growth(mart: DataFrame) -> DataFrame:
    """Quarterly denials with the change to the quarter before. Takes the denial mart or
    ``quarterly_denials``. The windows run over at most one row per quarter."""
    keys = QUARTER_KEYS
    quarters = mart.groupBy(*keys).agg(
        F.sum("denied_claims_count").alias("denied_claims_count"),
        money_sum("denied_amount").alias("denied_amount"),
    )
    index = F.col("service_year") * 4 + F.col("service_quarter")
    line = Window.partitionBy(*keys[:2]).orderBy("service_year", "service_quarter")
    adjacent = F.lag(index).over(line) == index - 1

    def previous(column: str) -> Column:
        return F.when(adjacent, F.lag(column).over(line))

    def growth(column: str, before: str) -> Column:
        prior = F.col(before)
        return F.when(prior > 0, ratio(F.col(column) - prior, prior))

    lagged = quarters.withColumns(
        {
            "prev_quarter_denials": previous("denied_claims_count"),
            "prev_quarter_denied_amount": previous("denied_amount"),
        }
    )
    grown = lagged.withColumns(
        {
            "qoq_denial_count_growth": growth("denied_claims_count", "prev_quarter_denials"),
            "qoq_denial_amount_growth": growth("denied_amount", "prev_quarter_denied_amount"),
        }
    )
    return grown.withColumn("denial_trend_category", x.trend_band(F.col("qoq_denial_count_growth")))


def with_months(mart: DataFrame, months: DataFrame) -> DataFrame:
    """Month attributes for a mart with year and month; ``months`` has one row per month."""
    month = F.broadcast(  # at most 12 rows per year of a limited date range
        months.select(
            F.col("year").alias("__y"),
            F.col("month").alias("__m"),
            "quarter_name",
            "month_name",
            "season",
            "fiscal_year",
            "fiscal_quarter",
        )
    )
    on = F.col("service_year").eqNullSafe(F.col("__y")) & F.col("service_month").eqNullSafe(F.col("__m"))
    return mart.join(month, on, "left").drop("__y", "__m")


def denial_scorecard(mart: DataFrame, growth: DataFrame, months: DataFrame) -> DataFrame:
    """The denial mart with the attributes of its month, the growth of its payer type and specialty over the quarter
    before, and four bands. ``growth`` has one row per payer type, specialty and quarter, few enough to be joined on
    those keys; its hot keys are split by adaptive execution."""
    added = ["prev_quarter_denials", "prev_quarter_denied_amount", "qoq_denial_count_growth", "qoq_denial_amount_growth"]
    quarters = growth.select(*[F.col(k).alias(f"__{k}") for k in QUARTER_KEYS], *added, "denial_trend_category")
    on = [F.col(k).eqNullSafe(F.col(f"__{k}")) for k in QUARTER_KEYS]
    wide = with_months(mart, months).join(quarters, on, "left").drop(*[f"__{k}" for k in QUARTER_KEYS])
    return wide.withColumns(
        {
            "denial_volume_category": x.denial_volume_band(F.col("denied_claims_count")),
            "denial_rate_category": x.denial_rate_band(F.col("denial_count_rate")),
            "denial_value_category": x.denial_value_band(F.col("avg_denied_amount")),
        }
    )


# -- published summaries -----------------------------------------------------------------------------
def provider_monthly(mart: DataFrame) -> DataFrame:
    return mart.groupBy("provider_id", "provider_specialty_category", "service_year", "service_month").agg(
        F.sum("total_claims").alias("total_claims"),
        money_sum("total_claim_amount").alias("total_amount"),
        money_avg("total_claim_amount").alias("avg_amount"),
        money_sum("total_denied_amount").alias("total_denied"),
        rate_avg("denial_rate").alias("avg_denial_rate"),
        F.sum("unique_members").alias("unique_members"),
    )


def denial_monthly(fact: DataFrame) -> DataFrame:
    """Monthly denials per payer type and specialty. Taken from the fact, which still knows the
    providers that the mart has counted away."""
    denied = F.col("is_denied_claim")
    return (
        fact.groupBy("service_year", "service_month", "payer_type", "provider_specialty_category")
        .agg(
            F.count_if(denied).alias("total_denied_claims"),
            money_sum("denied_amount").alias("total_denied_amount"),
            ratio(F.count_if(denied), F.count("*")).alias("denial_rate"),
            F.count_distinct(F.when(denied, F.col("provider_id"))).alias("affected_providers"),
        )
        .filter("total_denied_claims > 0")
    )


def provider_quarterly(mart: DataFrame) -> DataFrame:
    return mart.groupBy("provider_id", "provider_specialty_category", "service_year", "service_quarter").agg(
        F.sum("total_claims").alias("total_claims"),
        money_sum("total_claim_amount").alias("total_amount"),
        rate_avg("denial_rate").alias("avg_denial_rate"),
    )


def provider_summary(scorecard: DataFrame, provider_id, year: int, quarter: int) -> DataFrame:
    """Scorecard rows of one provider and quarter."""
    picked = scorecard.filter(
        (F.col("provider_id") == provider_id)
        & (F.col("service_year") == year)
        & (F.col("service_quarter") == quarter)
    )
    return picked.select(
        "provider_id",
        "provider_name",
        "provider_specialty_category",
        "service_year",
        "service_quarter",
        "service_month",
        "total_claims",
        "total_claim_amount",
        "avg_claim_amount",
        "denial_rate",
        "paid_rate",
        "unique_members",
        "specialty_rank_quarter",
        "volume_category",
        "denial_performance_category",
    )


#: What ``denial_by_payer`` reads.
PAYER_DENIAL_INPUT = DENIAL_TOTALS_INPUT + ("service_year", "service_quarter", "claim_status", "denied_amount")


def denial_by_payer(fact: DataFrame, payer_type: str, start: Column, end: Column) -> DataFrame:
    """Mart rows of one payer type within a date range, with the quarterly growth of their group. Of the claims only those of
    the payer type are read, from the quarter before the range to the end of its last quarter."""
    claims = denials_within(fact, payer_type)
    day = F.col("service_date")
    quarters = claims.filter((day >= F.add_months(F.trunc(start, "quarter"), -3)) & (day < F.add_months(F.trunc(end, "quarter"), 3)))
    added = ["qoq_denial_count_growth", "denial_trend_category"]
    growth = denial_growth(quarterly_denials(quarters)).select(*QUARTER_KEYS, *added)
    mart = denial_trends(denials_within(claims, None, start, end), distinct=False)
    rows = mart.select(*QUARTER_KEYS, "denied_claims_count", "denied_amount", "denial_count_rate", "denial_amount_rate")
    return rows.join(growth, list(QUARTER_KEYS), "left")


def executive_summary(fact: DataFrame) -> DataFrame:
    return (
        fact.groupBy("service_year", "service_month")
        .agg(
            F.count_distinct("claim_id").alias("total_claims"),
            money_sum("claim_amount").alias("total_amount"),
            money_sum("paid_amount").alias("paid_amount"),
            denial_pct().alias("denial_rate"),
            F.count_distinct("provider_id").alias("active_providers"),
            F.count_distinct("member_sk").alias("active_members"),
            F.avg("processing_delay_days").alias("avg_processing_delay"),
        )
        .withColumn("report_month", x.month_start(F.col("service_year"), F.col("service_month")))
        .drop("service_year", "service_month")
    )


def provider_monthly_view(scorecard: DataFrame) -> DataFrame:
    return scorecard.select(
        "provider_id",
        "provider_name",
        "provider_specialty_category",
        x.month_start(F.col("service_year"), F.col("service_month")).alias("performance_month"),
        "total_claims",
        "total_claim_amount",
        "denial_rate",
        "payment_rate",
        "unique_members",
    )


def denial_monthly_view(mart: DataFrame) -> DataFrame:
    return mart.select(
        x.month_start(F.col("service_year"), F.col("service_month")).alias("denial_month"),
        "payer_type",
        "provider_specialty_category",
        "denied_claims_count",
        "denied_amount",
        "denial_count_rate",
    )


def financial_summary(fact: DataFrame) -> DataFrame:
    return fact.agg(
        money_sum("claim_amount").alias("total_amount"),
        money_avg("claim_amount").alias("avg_amount"),
        F.min("claim_amount").alias("min_amount"),
        F.max("claim_amount").alias("max_amount"),
        *[money_sum(f"{s}_amount").alias(f"total_{s}") for s in STATUSES],
    )


def distribution(df: DataFrame, *columns: str) -> DataFrame:
    """Row count per value combination."""
    return df.groupBy(*columns).agg(F.count("*").alias("row_count"))


def describe_number(df: DataFrame, column: str) -> DataFrame:
    return df.agg(
        F.count(column).alias("value_count"),
        F.avg(column).alias("mean"),
        count_stddev(column).alias("stddev"),
        F.min(column).alias("min"),
        F.max(column).alias("max"),
    )


def insight(mart: DataFrame, key: str, count: str, amount: str, rate: str | None = None) -> DataFrame:
    """Mart totals per value of one column."""
    measures = [F.sum(count).alias("total_claims"), money_sum(amount).alias("total_amount")]
    if rate:
        measures.append(rate_avg(rate).alias("avg_rate"))
    return mart.groupBy(key).agg(*measures)
