from datetime import date, datetime

from pyspark.sql import functions as F

from claimloom.operators import changes, dimensions
from claimloom.operators.fact import silver_enrich

CURRENT = "claim_id string, claim_line_id string, claim_amount double, claim_status string, denial_reason string"
EVENT = """event_id string, claim_id string, claim_line_id string, event_type string, old_status string,
    new_status string, denial_reason string, event_timestamp timestamp, source_system string"""


def event(number, claim, status, hour, reason=None):
    at = datetime(2026, 3, 20, hour)
    return (f"E{number}", claim, "L1", "STATUS_UPDATE", "PENDING", status, reason, at, "s")


def current(spark):
    rows = [("C1", "L1", 10.0, "PENDING", None), ("C2", "L1", 20.0, "PAID", None), ("C3", "L1", 30.0, "PENDING", None)]
    return spark.createDataFrame(rows, CURRENT)


def events(spark, *rows):
    return spark.createDataFrame(list(rows), EVENT)


def state(df):
    return {r.claim_id: (r.claim_status, r.denial_reason) for r in df.collect()}


def test_merge_applies_the_latest_event(spark):
    ev = events(
        spark, event(1, "C1", "DENIED", 9, "late"), event(2, "C1", "PAID", 8), event(3, "C2", "PAID", 9),
        event(4, "C9", "PAID", 9),
    )
    merged = changes.merge_status(current(spark), ev)
    assert state(merged.current) == {"C1": ("DENIED", "late"), "C2": ("PAID", None), "C3": ("PENDING", None)}
    assert [(r.claim_id, r.claim_status, r.history_event_id) for r in merged.history.collect()] == [("C1", "PENDING", "E1")]
    assert [r.event_id for r in merged.applied.collect()] == ["E1"]
    again = changes.merge_status(merged.current, ev)
    assert again.history.count() == 0 and state(again.current) == state(merged.current)


def test_older_event_does_not_win(spark):
    first = changes.merge_status(current(spark), events(spark, event(1, "C1", "PAID", 9))).current
    second = changes.merge_status(first, events(spark, event(2, "C1", "DENIED", 8))).current
    assert state(second)["C1"] == ("PAID", None)


def test_unmatched_events_are_inserted_on_request(spark):
    merged = changes.merge_status(current(spark), events(spark, event(4, "C9", "PAID", 9)), insert_unmatched=True)
    assert state(merged.current)["C9"] == ("PAID", None) and merged.current.count() == 4
    assert merged.history.count() == 0


def test_latest_is_deterministic(spark):
    rows = [("K", 1, "a"), ("K", 2, "b"), ("K", 2, "c"), (None, 1, "d")]
    df = spark.createDataFrame(rows, "k string, v int, t string")
    got = changes.latest(df, ["k"], [F.col("v").desc(), F.col("t").desc()])
    assert sorted((r.k or "", r.t) for r in got.collect()) == [("", "d"), ("K", "c")]
    plan = got._jdf.queryExecution().toString()
    assert "WindowGroupLimit" in plan and "Partial" in plan


def test_changed_sees_nulls(spark):
    old = spark.createDataFrame([("A", None), ("B", 1), ("C", 2)], "k string, v int")
    new = spark.createDataFrame([("A", 1), ("B", 1), ("C", None), ("D", 4)], "k string, v int")
    got = changes.changed(old, new, ["k"], ["v"])
    assert sorted(r.k for r in got.collect()) == ["A", "C"]


PROVIDER = """provider_id string, provider_name string, specialty string, facility_name string, city string,
    state string, zip_code string, network_status string, effective_date date, termination_date date"""


def provider(key, facility="F", network="IN_NETWORK"):
    return (key, "n", "s", facility, "c", "CA", "12345", network, date(2020, 1, 1), None)


def day(text):
    return F.lit(text).cast("date")


def test_provider_history(spark):
    first = spark.createDataFrame([provider("P1"), provider("P2", None), provider("P3")], PROVIDER)
    dim = dimensions.scd2(None, first, day("2021-01-01"))
    second = spark.createDataFrame([provider("P1"), provider("P2", "F"), provider("P4")], PROVIDER)
    dim = dimensions.scd2(dim, second, day("2022-01-01"))
    third = spark.createDataFrame([provider("P2", "G"), provider("P4")], PROVIDER)
    dim = dimensions.scd2(dim, third, day("2023-01-01")).cache()
    rows = dim.orderBy("provider_id", "effective_start_date").collect()
    versions = {}
    for r in rows:
        versions.setdefault(r.provider_id, []).append(r)
    assert {k: len(v) for k, v in versions.items()} == {"P1": 1, "P2": 3, "P3": 1, "P4": 1}
    for line in versions.values():
        assert [v.is_current for v in line] == [False] * (len(line) - 1) + [True]
        for a, b in zip(line, line[1:]):
            assert a.effective_end_date == b.effective_start_date
    assert [v.facility_name for v in versions["P2"]] == [None, "F", "G"]
    assert dim.select("provider_sk").distinct().count() == len(rows)
    same = dimensions.scd2(dim, third, day("2023-01-01"))
    assert same.exceptAll(dim).count() == 0 and dim.exceptAll(same).count() == 0


def test_change_on_the_day_of_the_current_version(spark):
    dim = dimensions.scd2(None, spark.createDataFrame([provider("P1")], PROVIDER), day("2020-01-01"))
    after = dimensions.scd2(dim, spark.createDataFrame([provider("P1", "G")], PROVIDER), day("2020-01-01"))
    row = after.collect()
    assert len(row) == 1 and row[0].facility_name == "G" and row[0].is_current


def test_state_at_a_time_is_half_open(spark):
    rows = [("a", date(2020, 1, 1), date(2021, 1, 1)), ("b", date(2021, 1, 1), None)]
    df = spark.createDataFrame(rows, "v string, s date, e date")
    for at, expected in (("2020-12-31", "a"), ("2021-01-01", "b"), ("2030-01-01", "b")):
        got = changes.as_of_state(df.filter("e IS NULL"), df.filter("e IS NOT NULL"), day(at), "s", "e")
        assert [r.v for r in got.collect()] == [expected]


def test_reference_duplicates_do_not_multiply_claims(spark):
    claims = spark.createDataFrame([("C1", "A", 1, "P")] * 3, "claim_id string, diagnosis_code string, procedure_code int, payer_id string")
    diagnosis = spark.createDataFrame([("A", "x", "c")] * 5 + [("A", "w", "d")], "diagnosis_code string, diagnosis_desc string, diagnosis_category string")
    procedure = spark.createDataFrame([(1, "p", "q")] * 4, "procedure_code int, procedure_desc string, procedure_category string")
    payer = spark.createDataFrame([("P", "n", "t")], "payer_id string, payer_name string, payer_type string")
    ref = dimensions.reference_dim
    frames = {
        "diagnosis": lambda: ref(diagnosis, "diagnosis_code", "diagnosis_sk"),
        "procedure": lambda: ref(procedure, "procedure_code", "procedure_sk"),
        "payer": lambda: ref(payer, "payer_id", "payer_sk"),
    }
    got = silver_enrich(claims, frames).collect()
    assert len(got) == 3 and {(r.diagnosis_desc, r.diagnosis_category) for r in got} == {("w", "d")}
