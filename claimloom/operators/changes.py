"""Deduplication, change capture and status merges on plain tables."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from claimloom.config import TRANSITIONS

CLAIM_KEYS = ("claim_id", "claim_line_id")


def latest(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """First row per key in ``order``. The filter on rank one lets Spark keep a single row per key
    in every input task before the shuffle, so a hot key stays small."""
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("__rank", rank).filter("__rank = 1").drop("__rank")


def _differs(a: str, b: str, columns: Sequence[str]) -> Column:
    return reduce(
        lambda p, q: p | q, [~F.col(f"{a}.{c}").eqNullSafe(F.col(f"{b}.{c}")) for c in columns]
    )


def _same_key(a: str, b: str, keys: Sequence[str]) -> Column:
    return reduce(lambda p, q: p & q, [F.col(f"{a}.{k}") == F.col(f"{b}.{k}") for k in keys])


def classified(current: DataFrame, incoming: DataFrame, keys: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """One pass over both sides: (change, cur, new), a row for every key of either. ``change`` is ``new`` (no current row), ``changed``
    (another value in one of ``columns``), ``same`` or ``absent`` (nothing came in). Changed, superseded, new and kept rows are all
    read from it, so both inputs are sorted and joined once. Both sides must be unique on ``keys``."""
    sides = [df.select(*[F.col(k).alias(f"__{name}_{k}") for k in keys], F.struct(*df.columns).alias(name)) for df, name in ((current, "cur"), (incoming, "new"))]
    on = reduce(lambda p, q: p & q, [F.col(f"__cur_{k}") == F.col(f"__new_{k}") for k in keys])
    kind = (
        F.when(F.col("cur").isNull(), F.lit("new"))
        .when(F.col("new").isNull(), F.lit("absent"))
        .when(_differs("new", "cur", columns), F.lit("changed"))
        .otherwise(F.lit("same"))
    )
    return sides[0].join(sides[1], on, "full").select(kind.alias("change"), "cur", "new")


def superseded_versions(found: DataFrame, ended: Column) -> DataFrame:
    """Current rows that a changed row replaces, closed at ``ended``; from ``classified``."""
    return found.filter("change = 'changed'").select("cur.*", ended.alias("history_effective_end_date"))


def snapshot(found: DataFrame) -> DataFrame:
    """The table after the upsert: what came in, and current rows for which nothing did; from ``classified``."""
    names = found.schema["cur"].dataType.names
    have = found.schema["new"].dataType.names
    return found.select(*[F.when(F.col("new").isNotNull(), F.col(f"new.{c}")).otherwise(F.col(f"cur.{c}")).alias(c) if c in have else F.col(f"cur.{c}").alias(c) for c in names])


def changed(current: DataFrame, incoming: DataFrame, keys: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """Incoming rows whose key exists with another value in one of ``columns``."""
    return (
        incoming.alias("new")
        .join(current.alias("cur"), _same_key("new", "cur", keys), "inner")
        .filter(_differs("new", "cur", columns))
        .select("new.*")
    )


def superseded(current: DataFrame, changes: DataFrame, keys: Sequence[str], ended: Column) -> DataFrame:
    """Current rows that ``changes`` replace, closed at ``ended``."""
    gone = current.join(changes.select(*keys), list(keys), "left_semi")
    return gone.withColumn("history_effective_end_date", ended)


def upsert(current: DataFrame, incoming: DataFrame, keys: Sequence[str]) -> DataFrame:
    kept = current.join(incoming.select(*keys), list(keys), "left_anti")
    return incoming.unionByName(kept, allowMissingColumns=True)


@dataclass(frozen=True)
class Merge:
    """Outcome of a status merge."""

    current: DataFrame
    history: DataFrame
    applied: DataFrame


STATUS_COLUMNS = ("claim_status", "denial_reason", "status_update_timestamp")


def with_status_columns(current: DataFrame) -> DataFrame:
    types = {"claim_status": "string", "denial_reason": "string", "status_update_timestamp": "timestamp"}
    absent = {c: F.lit(None).cast(t) for c, t in types.items() if c not in current.columns}
    return current.withColumns(absent) if absent else current


def latest_events(events: DataFrame, keys: Sequence[str] = CLAIM_KEYS) -> DataFrame:
    return latest(events, keys, [F.col("event_timestamp").desc(), F.col("event_id").desc()])


def merge_status(
    current: DataFrame,
    events: DataFrame,
    keys: Sequence[str] = CLAIM_KEYS,
    *,
    insert_unmatched: bool = False,
) -> Merge:
    """Apply the last event per key where it changes the status and is newer than the last update.

    ``current`` must be unique on ``keys``; so is the result. Running the same events again changes
    nothing, because an applied event is neither newer nor different afterwards.
    """
    cur = with_status_columns(current)
    last = latest_events(events, keys)
    incoming = last.select(
        *[F.col(k).alias(f"__{k}") for k in keys],
        F.struct("event_id", "new_status", "denial_reason", "event_timestamp").alias("__ev"),
    )
    on = reduce(lambda p, q: p & q, [cur[k] == incoming[f"__{k}"] for k in keys])
    kind = "full" if insert_unmatched else "left"
    both = cur.withColumn("__known", F.lit(True)).join(incoming, on, kind)
    fresh = F.coalesce(F.col("__ev.event_timestamp") > F.col("status_update_timestamp"), F.lit(True))
    applies = (
        F.col("__ev").isNotNull()
        & ~F.col("__ev.new_status").eqNullSafe(F.col("claim_status"))
        & fresh
    )
    both = both.withColumn("__apply", F.coalesce(applies, F.lit(False)))

    def new_or_old(column: str, source: str) -> Column:
        return F.when(F.col("__apply"), F.col(f"__ev.{source}")).otherwise(F.col(column))

    updated = {
        "claim_status": new_or_old("claim_status", "new_status"),
        "denial_reason": new_or_old("denial_reason", "denial_reason"),
        "status_update_timestamp": new_or_old("status_update_timestamp", "event_timestamp"),
    }
    out = [
        (updated.get(c) if c in updated else F.coalesce(F.col(c), F.col(f"__{c}")) if c in keys else F.col(c)).alias(c)
        for c in cur.columns
    ]
    changed_rows = both.filter(F.col("__apply") & F.col("__known"))
    history = changed_rows.select(
        *cur.columns,
        F.col("__ev.event_timestamp").alias("history_effective_end_date"),
        F.lit("STATUS_UPDATE").alias("history_reason"),
        F.col("__ev.event_id").alias("history_event_id"),
    )
    applied = last.join(changed_rows.select(*keys), list(keys), "left_semi")
    return Merge(both.select(*out), history, applied)


def audit_trail(applied: DataFrame, run_id: str) -> DataFrame:
    return applied.select(
        "event_id",
        *CLAIM_KEYS,
        "event_type",
        "old_status",
        "new_status",
        "denial_reason",
        "event_timestamp",
        "source_system",
        F.lit(run_id).alias("merge_pipeline_run_id"),
    )


def change_summary(applied: DataFrame) -> DataFrame:
    return applied.groupBy("old_status", "new_status", "denial_reason").agg(
        F.count("*").alias("change_count"), F.count_distinct("claim_id").alias("affected_claims")
    )


def change_claims(applied: DataFrame) -> DataFrame:
    """The claims behind every change group, one row each. A list per group would hold a large part
    of all claims in one row, since there are only a few groups."""
    return applied.groupBy("old_status", "new_status", "denial_reason", "claim_id").agg(
        F.count("*").alias("change_count")
    )


def recent_history(history: DataFrame, as_of: Column, hours: int = 1) -> DataFrame:
    end = F.col("history_effective_end_date")
    return history.filter((end >= as_of - F.expr(f"INTERVAL {hours} HOURS")) & (end <= as_of))


def status_history(events: DataFrame) -> DataFrame:
    """Status-change fact: one row per status event."""
    return events.select(
        "event_id",
        *CLAIM_KEYS,
        F.col("old_status").alias("from_status"),
        F.col("new_status").alias("to_status"),
        F.col("event_timestamp").alias("changed_at"),
        F.col("denial_reason").alias("change_reason"),
        "event_type",
    )


def transition_checks(events: DataFrame, allowed=TRANSITIONS) -> DataFrame:
    """Events per transition and whether the contract allows it."""
    pairs = [F.struct(F.lit(a).alias("old_status"), F.lit(b).alias("new_status")) for a, b in allowed]
    counted = events.groupBy("old_status", "new_status").agg(F.count("*").alias("event_count"))
    return counted.withColumn(
        "is_allowed", F.array_contains(F.array(*pairs), F.struct("old_status", "new_status"))
    )


def transition_matrix(events: DataFrame, statuses: Sequence[str]) -> DataFrame:
    """Old status by row, new status by column; the columns are fixed, so no pass looks for them."""
    return events.groupBy("old_status").agg(
        *[F.count_if(F.col("new_status") == s).alias(f"to_{s.lower()}") for s in statuses]
    )


def as_of_state(current: DataFrame, history: DataFrame, at: Column, start: str, end: str) -> DataFrame:
    """Versions valid at ``at`` under half-open intervals; a null end is open."""
    both = current.unionByName(history, allowMissingColumns=True)
    return both.filter((F.col(start) <= at) & (F.col(end).isNull() | (at < F.col(end))))
