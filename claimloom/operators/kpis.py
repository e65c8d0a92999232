"""KPI formulas on top of the fact and the marts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from claimloom.functions import fields as x
from claimloom.functions.exact import cents, count_stddev, money_avg, money_sum, rate_avg, ratio
from claimloom.operators.ranking import value_ranks
from claimloom.sources.scratch import written


def _denied() -> Column:
    return F.col("claim_status") == "DENIED"


def monthly_kpis(fact: DataFrame) -> DataFrame:
    """Claims, paid amount and denial rate per month: one row per month."""
    return fact.groupBy(F.trunc("service_date", "MM").alias("month")).agg(
        F.count("*").alias("total_claims"),
        money_sum("paid_amount").alias("paid_amount"),
        ratio(F.count_if(_denied()), F.count("*")).alias("denial_rate"),
    )


def dense_months(monthly: DataFrame) -> DataFrame:
    """Adds the months without rows between the first and the last, with null measures."""
    bounds = monthly.agg(F.min("month").alias("a"), F.max("month").alias("b"))
    calendar = bounds.select(F.explode(F.sequence("a", "b", F.expr("INTERVAL 1 MONTH"))).alias("month"))
    return calendar.join(monthly, "month", "left")


def change_over(monthly: DataFrame, value: str, lags: dict[str, int]) -> DataFrame:
    """Percent change of ``value`` against the row ``lag`` months before; null without a positive
    predecessor. The window runs over one row per calendar month."""
    line = Window.orderBy("month")
    out = dense_months(monthly.select("month", value))
    for name, lag in lags.items():
        before = F.lag(value, lag).over(line)
        change = F.when(before > 0, ratio((F.col(value) - before) * 100, before))
        out = out.withColumn(name, change)
    return out


def change_over_quarters(fact: DataFrame) -> DataFrame:
    quarters = fact.groupBy(F.trunc("service_date", "quarter").alias("quarter_start")).agg(
        money_sum("paid_amount").alias("paid_amount")
    )
    line = Window.orderBy("quarter_start")
    before = F.when(
        F.lag("quarter_start").over(line) == F.add_months("quarter_start", -3), F.lag("paid_amount").over(line)
    )
    change = F.when(before > 0, ratio((F.col("paid_amount") - before) * 100, before))
    return quarters.withColumn("qoq_change", change)


def denial_colour(fact: DataFrame) -> DataFrame:
    monthly = monthly_kpis(fact).select("month", (F.col("denial_rate") * 100).alias("denial_pct"))
    return monthly.withColumn("colour", x.traffic_light(F.col("denial_pct")))


def utilization_rate(fact: DataFrame, days: int, as_of: Column) -> DataFrame:
    """Claims per member and day over the last ``days`` days."""
    period = fact.filter(F.col("service_date") > F.date_sub(as_of, days))
    return period.agg(
        F.count("*").alias("total_claims"), F.count_distinct("member_id").alias("members")
    ).withColumn(
        "utilization_rate", ratio(ratio("total_claims", "members"), F.lit(days))
    )


def provider_totals(fact: DataFrame) -> DataFrame:
    return fact.groupBy("provider_id").agg(
        F.count("*").alias("total_claims"),
        money_sum("claim_amount").alias("total_amount"),
        ratio(money_sum("paid_amount"), money_sum("claim_amount")).alias("payment_rate"),
        ratio(F.count_if(_denied()), F.count("*")).alias("denial_rate"),
        ratio(F.count_if(F.col("claim_status") == "ADJUSTED"), F.count("*")).alias("adjusted_rate"),
    )


def provider_score(totals: DataFrame) -> DataFrame:
    """Weighted score. Volume is the percent rank by claims: ranks come from the distinct claim
    counts (their number is at most the square root of twice the number of claims)."""
    levels = totals.groupBy("total_claims").agg(F.count("*").alias("ties"))
    line = Window.orderBy("total_claims").rowsBetween(Window.unboundedPreceding, -1)
    ranked = levels.select(
        F.col("total_claims").alias("__claims"),
        F.coalesce(F.sum("ties").over(line), F.lit(0)).alias("__below"),
        F.sum("ties").over(Window.partitionBy()).alias("__all"),
    )
    joined = totals.join(ranked, F.col("total_claims") == F.col("__claims"))
    volume = F.when(F.col("__all") > 1, ratio("__below", F.col("__all") - 1)).otherwise(F.lit(0.0))
    # The weights of the score.
    score = (
        F.col("payment_rate") * 0.4
        + (F.lit(1.0) - F.col("denial_rate")) * 0.3
        + F.col("volume_score") * 0.2
        + F.col("quality_score") * 0.1
    )
    return (
        joined.withColumns({"volume_score": volume, "quality_score": F.lit(1.0) - F.col("adjusted_rate")})
        .withColumn("performance_score", score)
        .select("provider_id", "payment_rate", "denial_rate", "volume_score", "quality_score", "performance_score")
    )


def year_to_date(monthly: DataFrame) -> DataFrame:
    """Running count within the year, over one row per month."""
    line = Window.partitionBy(F.year("month")).orderBy("month").rowsBetween(Window.unboundedPreceding, 0)
    return monthly.select("month", "total_claims", F.sum("total_claims").over(line).alias("ytd_claims"))


def same_period_growth(monthly: DataFrame) -> DataFrame:
    """Growth against the same month of the year before, found by date so that gaps do not shift it."""
    before = monthly.select(F.add_months("month", 12).alias("month"), F.col("total_claims").alias("prior_claims"))
    joined = monthly.select("month", "total_claims").join(before, "month", "left")
    growth = F.when(F.col("prior_claims") > 0, ratio(F.col("total_claims") - F.col("prior_claims"), "prior_claims"))
    return joined.withColumn("yoy_growth", growth)


def dense_provider_rank(totals: DataFrame) -> DataFrame:
    """A provider without an amount has no rank."""
    totals = written(totals, "totals")
    ranked = value_ranks(totals.filter("total_amount IS NOT NULL"), "total_amount", descending=True).select(
        F.col("total_amount").alias("__amount"), F.col("dense_rank").alias("provider_rank")
    )
    return totals.join(ranked, F.col("total_amount") == F.col("__amount"), "left").select(
        "provider_id", "total_amount", "provider_rank"
    )


def provider_percentile(totals: DataFrame) -> DataFrame:
    """(ascending dense rank − 1) / number of providers with an amount; null without one."""
    totals = written(totals, "totals")
    ranked = value_ranks(totals.filter("total_amount IS NOT NULL"), "total_amount", descending=False)
    count = ranked.agg(F.sum("ties")).first()[0] or 0  # one number, read from the written ranks
    levels = ranked.select(
        F.col("total_amount").alias("__amount"),
        ratio(F.col("dense_rank") - 1, F.lit(count)).alias("provider_percentile"),
    )
    return totals.join(levels, F.col("total_amount") == F.col("__amount"), "left").select(
        "provider_id", "total_amount", "provider_percentile"
    )


def provider_rankings(totals: DataFrame, improvement: DataFrame, n: int = 10) -> DataFrame:
    """Six top lists in one table. Every list is cut to ``n`` rows before its places are numbered."""
    lists = {
        "claim_volume": (totals, F.col("total_claims").cast("double"), True),
        "claim_amount": (totals, F.col("total_amount"), True),
        "highest_denial_rate": (totals, F.col("denial_rate"), True),
        "best_payment_rate": (totals, F.col("payment_rate"), True),
        "lowest_denial_rate": (totals, F.col("denial_rate"), False),
        "most_improved": (improvement, F.col("improvement"), True),
    }
    out = None
    for name, (df, value, descending) in lists.items():
        rows = df.select("provider_id", value.alias("value")).filter("value IS NOT NULL")
        order = [F.col("value").desc() if descending else F.col("value").asc(), F.col("provider_id")]
        first = rows.orderBy(*order).limit(n)
        placed = first.select(
            F.lit(name).alias("ranking"),
            F.row_number().over(Window.orderBy(*order)).cast("long").alias("place"),
            "provider_id",
            "value",
        )
        out = placed if out is None else out.unionByName(placed)
    return out


def denial_improvement(fact: DataFrame, as_of: Column) -> DataFrame:
    """Drop of the denial rate from the quarter before to the quarter of ``as_of``."""
    this = F.trunc(as_of, "quarter")
    last = F.add_months(this, -3)
    day = F.col("service_date")
    rows = fact.filter((day >= last) & (day < F.add_months(this, 3)))

    def rate(condition: Column) -> Column:
        return ratio(F.count_if(condition & _denied()), F.count_if(condition))

    return rows.groupBy("provider_id").agg((rate(day < this) - rate(day >= this)).alias("improvement"))


def benchmark(totals: DataFrame, group: str, labels: int | None = None) -> DataFrame:
    """Provider figures minus their group's average. The average is aggregated and joined back: a
    window would bring a whole specialty into one task. Groups that come from a closed label list
    (``labels`` rows at most) are broadcast."""
    average = totals.groupBy(group).agg(
        rate_avg("denial_rate").alias("__denial"), rate_avg("payment_rate").alias("__payment")
    )
    average = average.withColumnRenamed(group, "__group")
    if labels is not None and labels <= 1000:
        average = F.broadcast(average)
    joined = totals.join(average, F.col(group).eqNullSafe(F.col("__group")), "left")
    return joined.select(
        "provider_id",
        F.lit(group).alias("benchmark"),
        F.col(group).alias("group_value"),
        (F.col("denial_rate") - F.col("__denial")).alias("denial_rate_gap"),
        (F.col("payment_rate") - F.col("__payment")).alias("payment_rate_gap"),
    )


def anomaly_rate(flagged: DataFrame, key: str) -> DataFrame:
    return flagged.groupBy(key).agg(
        F.count("*").alias("total_claims"),
        F.count_if("has_anomaly").alias("anomalies"),
        ratio(F.count_if("has_anomaly"), F.count("*")).alias("anomaly_rate"),
    )


def member_flow(fact: DataFrame) -> DataFrame:
    """New, retained and churned members per month. Claims are folded to member and month first, so
    a member's window holds at most one row per month."""
    active = fact.select("member_id", F.trunc("service_date", "MM").alias("month")).distinct()
    line = Window.partitionBy("member_id").orderBy("month")
    seen = active.select(
        "month", F.lag("month").over(line).alias("before"), F.lead("month").over(line).alias("after")
    )
    next_month = F.add_months("month", 1)
    stays = F.coalesce(F.col("before") == F.add_months("month", -1), F.lit(False))
    leaves = ~F.coalesce(F.col("after") == next_month, F.lit(False))
    here = seen.groupBy("month").agg(
        F.count_if(F.col("before").isNull()).alias("new_members"),
        F.count_if(stays).alias("retained_members"),
        F.lit(0).cast("long").alias("churned_members"),
    )
    gone = seen.filter(leaves).groupBy(next_month.alias("month")).agg(
        F.lit(0).cast("long").alias("new_members"),
        F.lit(0).cast("long").alias("retained_members"),
        F.count("*").alias("churned_members"),
    )
    return here.unionByName(gone).groupBy("month").agg(
        *[F.sum(c).alias(c) for c in ("new_members", "retained_members", "churned_members")]
    )


def seasonal_pattern(fact: DataFrame) -> DataFrame:
    return fact.groupBy("service_season").agg(
        F.count("*").alias("total_claims"),
        money_sum("claim_amount").alias("total_amount"),
        money_avg("claim_amount").alias("avg_amount"),
    )


def denial_alerts(fact: DataFrame, threshold: float = 0.2) -> DataFrame:
    """Months in which a provider's denial rate is above the threshold and above the month before."""
    month = F.trunc("service_date", "MM").alias("month")
    monthly = fact.groupBy("provider_id", month).agg(
        F.count("*").alias("total_claims"),
        ratio(F.count_if(_denied()), F.count("*")).alias("denial_rate"),
    )
    line = Window.partitionBy("provider_id").orderBy("month")
    previous = F.when(
        F.lag("month").over(line) == F.add_months("month", -1), F.lag("denial_rate").over(line)
    )
    return monthly.withColumn("previous_rate", previous).filter(
        (F.col("denial_rate") > threshold) & (F.col("denial_rate") > F.col("previous_rate"))
    )


def top_per_group(df: DataFrame, group: str, item: str, k: int = 3) -> DataFrame:
    """Most frequent items per group. Counted first; the rank filter then keeps k rows per group in
    every task before the shuffle."""
    counted = df.groupBy(group, item).agg(F.count("*").alias("claim_count"))
    order = [F.col("claim_count").desc(), F.col(item).asc()]
    rank = F.row_number().over(Window.partitionBy(group).orderBy(*order))
    placed = counted.withColumn("place", rank).filter(F.col("place") <= k)
    return placed.withColumn("place", F.col("place").cast("long"))


def _long_form(dimensions: Sequence[str]) -> tuple[Column, Column]:
    """Name and value of the one dimension that a grouping set keeps."""
    name = value = None
    for c in dimensions:
        kept = F.grouping(c) == 0
        text = F.col(c).cast("string")
        name = F.when(kept, F.lit(c)) if name is None else name.when(kept, F.lit(c))
        value = F.when(kept, text) if value is None else value.when(kept, text)
    return name, value


def denials_by(fact: DataFrame, dimensions: Sequence[str]) -> DataFrame:
    """Denial rate and amount per value and month of each dimension, in long form. Grouping sets
    read the claims once for all dimensions and combine rows before the shuffle."""
    rows = fact.withColumn("month", F.trunc("service_date", "MM"))
    name, value = _long_form(dimensions)
    sets = [[F.col(c), F.col("month")] for c in dimensions]
    grouped = rows.groupingSets(sets, *dimensions, "month").agg(
        name.alias("dimension"),
        value.alias("value"),
        F.count("*").alias("total_claims"),
        F.count_if(_denied()).alias("denied_claims"),
        ratio(F.count_if(_denied()), F.count("*")).alias("denial_rate"),
        money_sum("denied_amount").alias("denied_amount"),
    )
    return grouped.drop(*dimensions)


def amount_vs_frequency(fact: DataFrame, key: str) -> DataFrame:
    return fact.groupBy(key).agg(
        F.count("*").alias("claim_count"),
        money_avg("claim_amount").alias("avg_amount"),
        (count_stddev(cents("claim_amount")) / 100).alias("stddev_amount"),
    )


def dashboard_filter(
    fact: DataFrame,
    as_of: Column,
    *,
    days: int | None = None,
    between: tuple[Column, Column] | None = None,
    **equal: Sequence,
) -> DataFrame:
    """Rows that a dashboard selection leaves: last ``days`` days or a date range, and lists of
    accepted values per column. All conditions are plain predicates that push down."""
    day = F.col("service_date")
    if days is not None:
        fact = fact.filter((day > F.date_sub(as_of, days)) & (day <= as_of))
    if between is not None:
        fact = fact.filter(day.between(*between))
    for column, values in equal.items():
        fact = fact.filter(F.col(column).isin(*values))
    return fact


def utilization_by(fact: DataFrame, key: str) -> DataFrame:
    return fact.groupBy(key).agg(
        F.count("*").alias("total_claims"),
        F.count_distinct("member_id").alias("members"),
        money_sum("claim_amount").alias("total_amount"),
        ratio(F.count("*"), F.count_distinct("member_id")).alias("claims_per_member"),
    )


def patient_mix(fact: DataFrame, attributes: Sequence[str], *, members: DataFrame | None = None) -> DataFrame:
    """Members of a provider by age group, state and so on, and their share. Members are counted per
    provider and attribute value; the share's total runs over those few rows. With ``members`` (member_id and the
    attributes) pairs of keys are made unique first, so that the large aggregation holds two narrow keys."""
    name, value = _long_form(attributes)
    sets = [[F.col("provider_id"), F.col(c)] for c in attributes]
    if members is None:
        unique = fact.select("provider_id", "member_id", *attributes).distinct()
    else:
        pairs = fact.select("provider_id", "member_id").distinct()
        unique = pairs.join(members.select("member_id", *attributes).distinct(), "member_id", "left")
    mix = unique.groupingSets(sets, "provider_id", *attributes).agg(
        name.alias("attribute"), value.alias("value"), F.count("member_id").alias("members")
    )
    total = F.sum("members").over(Window.partitionBy("provider_id", "attribute"))
    return mix.select("provider_id", "attribute", "value", "members", ratio("members", total).alias("share"))


def service_use(fact: DataFrame, groups: Sequence[str]) -> DataFrame:
    """Claims per procedure category, one column per age group."""
    return fact.groupBy("procedure_category").agg(
        F.count("*").alias("total_claims"),
        money_sum("claim_amount").alias("total_amount"),
        *[F.count_if(F.col("member_age_group") == g).alias(label_column(g)) for g in groups],
    )


def label_column(label: str) -> str:
    return "claims_" + "".join(ch if ch.isalnum() else "_" for ch in label.lower()).strip("_")
