import json
import os
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from claimloom import schemas
from claimloom.config import Settings
from claimloom.streaming import events as ev
from claimloom.streaming import merge, monitor, runner

CFG = Settings()
NOON = datetime(2026, 3, 20, 12)


def message(number, status="PAID", minutes=0, claim="C1", kind="STATUS_UPDATE", **more):
    at = (NOON + timedelta(minutes=minutes)).isoformat() + "Z"
    return {
        "event_id": f"E{number}", "claim_id": claim, "claim_line_id": "L1", "event_type": kind, "old_status": "PENDING",
        "new_status": status, "event_timestamp": at, "source_system": "s", **more,
    }


def drop(folder, number, *messages):
    folder.mkdir(exist_ok=True)
    path = folder / f"part-{number}.json"
    path.write_text("\n".join(m if isinstance(m, str) else json.dumps(m) for m in messages))
    os.utime(path, (1_700_000_000 + 60 * number, 1_700_000_000 + 60 * number))  # files are read in this order


def stream(spark, folder):
    session = runner.stream_session(spark)
    return ev.read_stream(session, str(folder), schemas.schema("claim_status_events", streaming=True), files_per_trigger=1)


def drained(spark, df, label):
    return spark.read.parquet(runner.run_sink(df, label)[0])


def test_rejects_are_kept(spark, tmp_path):
    folder = tmp_path / "in"
    drop(folder, 1, message(1), message(2, status="VOID"), message(3, minutes=121), message(4, kind="AUDIT"), "{broken")
    flagged = ev.flag_events(stream(spark, folder), CFG, F.lit(NOON))
    rows = drained(spark, flagged, "flags").collect()
    assert len(rows) == 5 and [r.event_id for r in rows if r.is_valid] == ["E1"]


def test_late_flag(spark):
    rows = [(NOON, NOON + timedelta(seconds=s)) for s in (300, 301)]
    df = spark.createDataFrame(rows, "event_timestamp timestamp, arrival timestamp")
    for name in ("event_id", "claim_id", "claim_line_id", "event_type", "new_status"):
        df = df.withColumn(name, F.lit("x"))
    got = ev.derive_events(df, CFG, F.col("arrival")).orderBy("arrival").collect()
    assert [r.is_late_event for r in got] == [False, True] and len({r.record_hash for r in got}) == 1


def test_events_too_late_are_dropped(spark):
    rows = [(1, 3_600), (2, 3_601), (3, None)]
    df = spark.createDataFrame(rows, "event_id int, processing_delay_seconds long")
    assert [r.event_id for r in ev.within_limit(df, CFG).collect()] == [1]


def test_state_behind_the_watermark_is_evicted(spark, tmp_path):
    """A key that is gone from the state lets a later copy through; one still within the watermark does not."""
    folder = tmp_path / "in"
    drop(folder, 1, message(1), message(2, minutes=20))
    drop(folder, 2, message(3, minutes=40))
    drop(folder, 3, message(1, minutes=41), message(3, minutes=41), message(4, minutes=1))
    got = drained(spark, ev.deduplicate(stream(spark, folder), CFG), "evicted").collect()
    assert sorted(r.event_id for r in got) == ["E1", "E1", "E2", "E3"]


def test_duplicates_within_the_watermark(spark, tmp_path):
    folder = tmp_path / "in"
    drop(folder, 1, message(1), message(1), message(2))
    drop(folder, 2, message(1, minutes=1), message(3, minutes=2))
    got = drained(spark, ev.deduplicate(stream(spark, folder), CFG), "unique")
    assert sorted(r.event_id for r in got.collect()) == ["E1", "E2", "E3"]


def test_payload(spark):
    text = '{"payment_amount": 1500.0, "payment_date": "2026-03-23", "processor_id": "P1"}'
    df = spark.createDataFrame([(text,), ("no json",), (None,)], "additional_data string")
    got = [r.payment_amount for r in ev.payload(df).collect()]
    assert got == [1500.0, None, None]


def test_empty_batch_metrics(spark):
    empty = spark.createDataFrame([], "is_late_event boolean, is_valid boolean, processing_delay_seconds long")
    row = runner.batch_metrics(empty, 0, "s", "r", F.lit(NOON)).first()
    assert (row.event_count, row.late_events, row.avg_processing_delay) == (0, 0, None)


CURRENT = "claim_id string, claim_line_id string, claim_status string, denial_reason string, month string"
FIELDS = ["claim_id", "claim_status", "denial_reason", "status_update_timestamp"]


@pytest.mark.parametrize("status, reason", [("PENDING", None), ("PAID", "KEEP"), ("DENIED", "OLD")])
def test_table_equals_one_merge(spark, tmp_path, status, reason):
    """Events cut into batches, a repeated event and a replayed batch leave the state and history of one merge."""
    rows = [(f"C{i}", "L1", status, reason, f"m{i % 3}") for i in range(6)]
    base = spark.createDataFrame(rows, CURRENT)
    store = merge.StatusTable(str(tmp_path / "store"), "month")
    store.create(base)
    folder = tmp_path / "in"
    batches = [
        [message(1, "DENIED", 1, "C1", denial_reason="r1"), message(2, "PENDING", 2, "C2"), message(3, "DENIED", 3, "C3", denial_reason="r3")],
        [message(4, "PAID", 4, "C1"), message(5, "PAID", 5, "C2"), message(9, "PAID", 6, "C99"), message(7, "PAID", 7, "C1")],
        [message(6, "ADJUSTED", 8, "C3"), message(1, "DENIED", 1, "C1", denial_reason="r1")],
    ]
    for number, some in enumerate(batches):
        drop(folder, number, *some)
    runner.run_batches(stream(spark, folder), store.apply, str(tmp_path / "checkpoint"))
    every = spark.read.schema(schemas.schema("claim_status_events", streaming=True)).json(str(folder))
    expected = merge.merge_in_order(base, every.dropDuplicates(["event_id"]))
    state = {r[0]: tuple(r)[1:] for r in store.current(spark).select(*FIELDS).collect()}
    assert state == {r[0]: tuple(r)[1:] for r in expected.current.select(*FIELDS).collect()} and len(state) == 6
    assert state["C1"][:2] == ("PAID", None) and state["C0"] == (status, reason, None)
    past = [*FIELDS, "history_effective_end_date", "history_event_id"]
    want = sorted(map(repr, expected.history.select(*past).collect()))
    assert sorted(map(repr, store.history(spark).select(*past).collect())) == want
    store.apply(every.filter("event_id IN ('E6')"), 2)
    assert {r[0]: tuple(r)[1:] for r in store.current(spark).select(*FIELDS).collect()} == state
    assert sorted(map(repr, store.history(spark).select(*past).collect())) == want


def test_history_does_not_depend_on_the_cut(spark, tmp_path):
    """Reversed batches, repeated events and late ones that split versions: the history of one merge, the statuses too."""
    rows = [(f"C{i}", "L1", "PENDING", None, f"m{i % 2}" if i else None) for i in range(5)]
    base = spark.createDataFrame(rows, CURRENT)
    sent = [
        message(1, "PAID", 1), message(2, "DENIED", 2, denial_reason="r2"), message(3, "PAID", 3), message(4, "PAID", 4),
        message(5, "PAID", 2, "C2"), message(6, "PAID", 1, "C2"), message(7, "PENDING", 1, "C3"), message(8, "DENIED", 5, "C3"),
        message(9, "ADJUSTED", 5, "C3"), message(10, "PAID", 3, "C0"), message(11, "DENIED", 2, "C0"), message(12, "PAID", 1, "C9"),
    ]
    schema = schemas.schema("claim_status_events", streaming=True)
    past = [*FIELDS, "history_effective_end_date", "history_event_id"]
    ordered = sorted(sent, key=lambda m: m["event_timestamp"])
    cuts = {
        "reversed": [ordered[k : k + 4] for k in range(8, -1, -4)],
        "mixed": [[sent[k] for k in (2, 6, 8)], [sent[k] for k in (0, 4, 9)], [sent[k] for k in (3, 2, 5, 11)], [sent[k] for k in (1, 7, 10)]],
    }
    drop(tmp_path / "all", 0, *sent)
    every = spark.read.schema(schema).json(str(tmp_path / "all"))
    want = sorted(map(repr, merge.merge_in_order(base, every).history.select(*past).collect()))
    statuses = {r[0]: r[1] for r in merge.merge_in_order(base, every).current.select("claim_id", "claim_status").collect()}
    for name, batches in cuts.items():
        store = merge.StatusTable(str(tmp_path / name), "month")
        store.create(base)
        for number, some in enumerate(batches):
            drop(tmp_path / f"{name}-{number}", 0, *some)
            batch = spark.read.schema(schema).json(str(tmp_path / f"{name}-{number}"))
            store.apply(batch, number)
        store.apply(batch, number)  # the last batch runs again
        assert sorted(map(repr, store.history(spark).select(*past).collect())) == want, name
        assert {r[0]: r[1] for r in store.current(spark).select("claim_id", "claim_status").collect()} == statuses


def test_late_event_leaves_the_current_state(spark, tmp_path):
    store = merge.StatusTable(str(tmp_path / "store"), "month")
    store.create(spark.createDataFrame([("C1", "L1", "PENDING", None, "m")], CURRENT))
    schema = schemas.schema("claim_status_events", streaming=True)
    for number, some in enumerate([message(2, "PAID", 2), message(1, "DENIED", 1)]):
        drop(tmp_path / str(number), 0, some)
        store.apply(spark.read.schema(schema).json(str(tmp_path / str(number))), number)
    assert [r.claim_status for r in store.current(spark).collect()] == ["PAID"]
    got = store.history(spark).orderBy("history_effective_end_date").select("claim_status", "history_event_id").collect()
    assert [tuple(r) for r in got] == [("PENDING", "E1"), ("DENIED", "E2")]


def test_progress_is_appended(spark, tmp_path):
    folder, path = tmp_path / "in", str(tmp_path / "progress")
    drop(folder, 1, message(1), message(2))
    source = stream(spark, folder)
    listener = monitor.ProgressWriter(spark, path)
    source.sparkSession.streams.addListener(listener)
    try:
        runner.run_sink(source, "listened")
        assert listener.ended.wait(60)
    finally:
        source.sparkSession.streams.removeListener(listener)
    assert spark.read.schema(monitor.PROGRESS).parquet(path).agg(F.sum("input_rows")).first()[0] == 2


def test_a_batch_writes_what_its_events_reach(spark, tmp_path):
    """An event for one claim of a large partition does not write the other claims of the partition again."""
    base = spark.range(5_000).selectExpr(
        "concat('C', id) AS claim_id", "'L1' AS claim_line_id", "'PENDING' AS claim_status", "CAST(NULL AS STRING) AS denial_reason",
        "id AS claim_amount", "'m' AS month",
    )
    store = merge.StatusTable(str(tmp_path / "store"), "month")
    store.create(base)
    at_start = {f for f in (tmp_path / "store").rglob("*.parquet")}
    drop(tmp_path / "in", 0, message(1, "PAID", 1, "C7"))
    batch = spark.read.schema(schemas.schema("claim_status_events", streaming=True)).json(str(tmp_path / "in"))
    assert store.apply(batch, 0) == ["m"]
    new = [str(f) for f in (tmp_path / "store").rglob("*.parquet") if f not in at_start]
    assert at_start <= set((tmp_path / "store").rglob("*.parquet"))
    assert sum(spark.read.parquet(f).count() for f in new) == 3  # the event, its version and the claim's state
    assert store.current(spark).count() == 5_000
    assert [tuple(r) for r in store.current(spark).filter("claim_status = 'PAID'").select("claim_id", "claim_amount").collect()] == [("C7", 7)]
    assert [tuple(r) for r in store.history(spark).select("claim_id", "claim_amount", "month").collect()] == [("C7", 7, "m")]
    assert store.history(spark, ["claim_id", "claim_status"]).collect()[0] == ("C7", "PENDING")


def test_a_claim_that_comes_twice_stays_twice(spark, tmp_path):
    base = spark.createDataFrame([("C1", "L1", "PENDING", None, "m")] * 2 + [("C2", "L1", "PAID", r, "m") for r in ("a", "b")], CURRENT)
    store = merge.StatusTable(str(tmp_path / "store"), "month")
    store.create(base)
    drop(tmp_path / "in", 0, message(1, "PAID", 1, "C1"), message(2, "PAID", 1, "C2"))
    batch = spark.read.schema(schemas.schema("claim_status_events", streaming=True)).json(str(tmp_path / "in"))
    for number in (0, 0, 1):
        store.apply(batch, number)
    got = sorted(tuple(r) for r in store.current(spark).select("claim_id", "claim_status", F.coalesce("denial_reason", F.lit("-"))).collect())
    assert got == [("C1", "PAID", "-"), ("C1", "PAID", "-"), ("C2", "PAID", "a"), ("C2", "PAID", "b")]
