"""Plans that must hold at any size."""

import pytest
from pyspark.sql import functions as F

from claimloom.operators import anomaly, dashboards, marts
from claimloom.plans import catalog, streams
from claimloom.plans.model import Tables
from claimloom.sources.scratch import written

FOLDER = "/root/testdata/sf0.001"
# The queries below drain a stream or write tables first; their own plans are only reads.
PURE = [n for n in catalog.queries() if n[0] in "cqdjaklmx" and n not in ("l01_top_n",)]


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", PURE[::4])
def test_no_cross_or_nested_loop_join(spark, name):
    text = plan(catalog.queries()[name](spark, FOLDER))
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text


def test_period_reaches_the_scan(spark):
    t = Tables(spark, FOLDER)
    text = plan(dashboards.by_payer_type(t.fact(dashboards.PAYER_INPUT), t.as_of, t.cfg))
    assert "GreaterThanOrEqual(o_orderdate,2000-07-31" in text
    assert "part.parquet" not in text and "supplier.parquet" not in text


def test_large_dimensions_are_not_broadcast(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "1000")
        t = Tables(spark, FOLDER)
        text = plan(t.fact(["claim_id", "member_state", "provider_region", "service_date_key"]))
        assert text.count("BroadcastHashJoin") == 1 and text.count("SortMergeJoin") >= 3
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_totals_and_distinct_counts_meet_without_a_shuffle(spark):
    t = Tables(spark, FOLDER)
    rows = written(t.fact(marts.DENIAL_INPUT), "plan")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        text = plan(marts.denial_trends(rows))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    joined = text[: text.index("HashAggregate")]
    assert "SortMergeJoin" in joined and "Exchange" not in joined


def test_a_refresh_reads_the_changed_months(spark, tmp_path):
    rows = spark.sql("SELECT id, make_date(2020, 1 + CAST(id % 12 AS INT), 1) AS m FROM range(100)")
    rows.write.partitionBy("m").parquet(str(tmp_path / "t"))
    months = [r[0] for r in rows.filter("id < 2").select("m").collect()]
    text = plan(streams.changed_months(spark.read.parquet(str(tmp_path / "t")), "m", months))
    assert "PartitionFilters: [m#" in text and "m#" in text.split("PartitionFilters")[1].split("]")[0]


def test_claims_are_joined_by_numbers(spark):
    """The texts of a claim's keys are made above the joins, so they are neither moved nor sorted."""
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        text = plan(Tables(spark, FOLDER).claims(["claim_id", "claim_line_id", "member_id"]))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert "SortMergeJoin" in text and "concat(C" in text and "concat(C" not in text[text.index("SortMergeJoin") :]


def test_patients_are_made_unique_by_keys(spark):
    """Rows are first made unique on the two keys alone; equal members count once, different rows of a member each."""
    from claimloom.operators import kpis

    fact = spark.createDataFrame([(1, 1), (1, 1), (1, 2), (2, 1), (None, 2), (1, None)], "provider_id long, member_id long")
    members = spark.createDataFrame([(1, "a", "x"), (1, "a", "x"), (1, "b", "x"), (2, "a", None)], "member_id long, age string, state string")
    both = fact.join(members, "member_id", "left")
    rows = lambda df: sorted(map(str, df.collect()))
    assert rows(kpis.patient_mix(fact, ["age", "state"], members=members)) == rows(kpis.patient_mix(both, ["age", "state"]))


def test_distinct_counts_move_rows_once(spark):
    """Several distinct counts beside sums: one exchange, by the group's keys; null keys are a group, null values do not count."""
    rows = spark.sql(
        """SELECT CASE WHEN id % 5 > 0 THEN id % 5 END AS k, CASE WHEN id % 3 > 0 THEN id % 7 END AS a,
        CASE WHEN id % 4 > 0 THEN concat('x', id % 11) END AS b, CAST(NULL AS INT) AS c, id AS n FROM range(200)"""
    )
    got = marts.grouped_once(rows, ["k"], {"n": (F.sum, F.col("n")), "most": (F.max, F.col("n"))}, {"x": "a", "y": "b", "z": "c"})
    want = rows.groupBy("k").agg(
        F.sum("n"), F.max("n"), F.count_distinct("a"), F.count_distinct("b"), F.count_distinct("c")
    )
    assert sorted(map(repr, map(tuple, got.collect()))) == sorted(map(repr, map(tuple, want.collect())))
    t = Tables(spark, FOLDER)
    mart = marts.member_utilization(written(t.fact(marts.MEMBER_INPUT), "plan"), t.frames, t.cfg)
    text = plan(mart)
    assert text.count("hashpartitioning(member_id#") + text.count("hashpartitioning(__key#") == 1 and "Expand" not in text


def test_anomalies_look_up_the_payer_for_flagged_claims_only(spark):
    """The level needs no dimension; the mart's payer joins the flagged claims, not all."""
    text = plan(catalog.queries()["a14_risk_insight"](spark, FOLDER))
    assert "customer.parquet" not in text and "supplier.parquet" not in text
    assert "payer_id" not in anomaly.CLAIM_INPUT
    text = plan(catalog.queries()["a04_claim_anomalies"](spark, FOLDER))
    assert "customer.parquet" in text and "orders.parquet" not in text  # the claims' own joins ran once, before
