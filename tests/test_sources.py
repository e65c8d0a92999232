import json
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from claimloom.operators.star import Lookup, star
from claimloom.sources import files, scratch, sizes, tables

LINES = [
    "diagnosis_code,diagnosis_desc,diagnosis_category",
    "J44.9,Chronic pulmonary disease, unspecified,Respiratory",
    "I10,Hypertension,Circulatory",
    "X99",
]


def test_unquoted_commas_are_repaired(spark, tmp_path):
    (tmp_path / "diagnosis_ref.csv").write_text("\n".join(LINES))
    text = spark.read.text(str(tmp_path)).filter("value NOT LIKE 'diagnosis_code,%'")
    good, bad = files.split_malformed(text, ["diagnosis_code", "diagnosis_desc", "diagnosis_category"])
    got = {r.diagnosis_code: (r.diagnosis_desc, r.diagnosis_category) for r in good.collect()}
    assert got == {
        "J44.9": ("Chronic pulmonary disease, unspecified", "Respiratory"),
        "I10": ("Hypertension", "Circulatory"),
    }
    assert [r.value for r in bad.collect()] == ["X99"]


def test_malformed_csv_lines_are_marked(spark, tmp_path):
    (tmp_path / "diagnosis_ref.csv").write_text("\n".join(LINES))
    df = files.read_dataset(spark, "diagnosis_ref", str(tmp_path), keep_malformed=True).cache()
    assert df.filter(F.col(files.CORRUPT).isNotNull()).count() == 2


def test_landing_is_routed_by_name(spark, tmp_path):
    for name in ("claims_1.csv", "providers_1.csv", "diagnosis_x.csv", "zzz.csv", "claims.txt"):
        (tmp_path / name).write_text("a\n")
    got = {r.file_name: r.dataset for r in files.list_landing(spark, str(tmp_path)).collect()}
    assert got == {
        "claims_1.csv": "claims", "providers_1.csv": "providers", "diagnosis_x.csv": "diagnosis_ref", "zzz.csv": "payer_ref",
    }


def test_event_array_file(spark, tmp_path):
    rows = [{"event_id": "E1", "claim_id": "C1", "event_timestamp": "2026-03-23T14:22:10Z", "denial_reason": ""}]
    (tmp_path / "events.json").write_text(json.dumps(rows, indent=2))
    row = files.read_events(spark, str(tmp_path), array_file=True).first()
    assert row.event_timestamp == datetime(2026, 3, 23, 14, 22, 10) and row.denial_reason == ""


def test_partition_overwrite_leaves_others(spark, tmp_path):
    path = str(tmp_path / "t")
    df = spark.createDataFrame([("a", 1), ("b", 2)], "p string, v int")
    tables.overwrite_partitions(df, path, ["p"])
    tables.overwrite_partitions(spark.createDataFrame([("b", 3)], "p string, v int"), path, ["p"], 4)
    assert sorted((r.p, r.v) for r in spark.read.parquet(path).collect()) == [("a", 1), ("b", 3)]


def test_versions(spark, tmp_path):
    path = str(tmp_path / "t")
    for version in (1, 2):
        tables.publish_version(spark.range(version), path, version)
    assert tables.read_version(spark, path).count() == 2 and tables.read_version(spark, path, 1).count() == 1


def test_high_water_mark(spark):
    marks = spark.createDataFrame([("claims", 3), ("claims", 5), ("x", 9)], "table_name string, high_water_mark int")
    assert tables.high_water_mark(marks, "claims") == 5
    assert tables.above_mark(spark.range(8), "id", 5).count() == 2
    assert tables.above_mark(spark.range(8), "id", tables.high_water_mark(marks, "none")).count() == 8


def test_scratch_follows_the_session(spark):
    assert scratch.fresh(spark, "x").startswith(spark.conf.get("spark.checkpoint.dir"))
    assert scratch.fresh(spark, "x") != scratch.fresh(spark, "x")


def test_broadcast_limit_follows_the_session(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        for text, expected in (("10MB", 10 << 20), ("-1", 0), ("2048", 2048)):
            spark.conf.set("spark.sql.autoBroadcastJoinThreshold", text)
            assert sizes.broadcast_limit(spark) == expected
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_star_joins_only_what_is_asked_for(spark):
    base = spark.createDataFrame([(1,), (2,), (None,)], "k long")
    opened = []

    def dimension():
        opened.append(1)
        return spark.createDataFrame([(1, "one")], "id long, label string")

    lookups = [Lookup("d", "k", "id", {"label": "label"}, dimension)]
    assert star(base, lookups, {}, ["k"]).count() == 3 and not opened
    got = star(base, lookups, {}, ["k", "label"]).collect()
    assert sorted((r.k or 0, r.label or "") for r in got) == [(0, ""), (1, "one"), (2, "")]


def test_a_failed_write_keeps_the_old_version(spark, tmp_path):
    path = str(tmp_path / "t")
    tables.publish_version(spark.range(3), path, 1)
    broken = spark.range(3).select(F.raise_error(F.lit("stop")).alias("id"))
    with pytest.raises(Exception):
        tables.publish_version(broken, path, 2)
    assert tables.read_version(spark, path).count() == 3
