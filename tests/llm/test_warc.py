import hashlib
import random

import pytest
from odd import ordered
from pyspark.sql import functions as F

from claimloom.llm import warc

SCHEMA = "page_id long, url string, html string"


def pages():
    big = "é" * 60
    return [
        (5, "http://a/\r\nX: y", big), (3, None, big), (9, "http://b/%0D", big), (1, "u", "small"), (2, "u", "small"), (4, "u", None),
        (6, "u", ""), (7, "u", "WARC/1.1\r\nWARC-Type: response\r\nContent-Length: 3\r\n\r\nabc\r\n\r\n" * 3), (8, "u", "\x1f\u008b\x08" * 50),
        (3, None, big), (10, "u", "x" * 99), (11, "u", "x" * 99), (12, "u", "y" * 300_000), (None, "u", big),
    ]


def test_round_trip(spark):
    df = spark.createDataFrame(pages(), SCHEMA).withColumn("payload_digest", F.lit("clash")).repartition(3)
    want = []
    for key, _, html in pages():
        body = (html or "").encode()
        again = len(body) >= 100 and body == pages()[0][2].encode() and key != 3
        want.append((key, len(body), hashlib.sha256(body).hexdigest(), "revisit" if again else "response", 3 if again else None))
    assert ordered(warc.round_trip(df).collect()) == ordered(want)


def test_empty_table(spark):
    assert warc.round_trip(spark.createDataFrame([], SCHEMA)).count() == 0


def row(key, body, kind="response"):
    return {"id": key, "kind": kind, "url": f"http://x/{key}", "payload": body, "payload_bytes": len(body), "payload_digest": hashlib.sha256(body).hexdigest(), "refers_to": None}


def told(data):
    found = list(warc.salvage(data))
    assert all(a < b for a, b, _, _ in found)
    gaps = [(a, b) for a, b, reason, _ in found if reason is not None]
    return [one["id"] for _, _, _, one in found if one], gaps


@pytest.mark.parametrize("packed", [True, False])
def test_damage_loses_only_its_record(packed):
    rnd = random.Random(7)
    parts = [warc.record(row(str(k), rnd.randbytes(400) + b"WARC/1.1\r\n")) for k in range(6)]
    parts = [warc.member(p) for p in parts] if packed else parts
    whole = b"".join(parts)
    assert told(whole) == (list("012345"), [])
    begin, end = len(parts[0]) + len(parts[1]), len(parts[0]) + len(parts[1]) + len(parts[2])
    for damage in (whole[: begin + 250] + b"\x00" * 40 + whole[begin + 290 :], whole[:begin] + b"?" * 3 + whole[begin + 3 :]):
        assert told(damage) == (list("01345"), [(begin, end)])
    assert told(whole[: begin + 100]) == (list("01"), [(begin, begin + 100)])
    assert told(b"garbage" + whole) == (list("012345"), [(0, 7)])
    assert told(b"") == ([], []) and told(b"nothing at all") == ([], [(0, 14)])


def test_members_and_plain_records_in_one_file():
    one, two = warc.record(row("1", b"a" * 200)), warc.member(warc.record(row("2", b"b")) + warc.record(row("3", b"c")))
    assert told(one + two + one) == (["1", "2", "3", "1"], [])


def test_long_urls_come_back(spark):
    rows = [(1, "http://a/" + "%" * 600_000, "x"), (2, "http://b/" + "y" * 2_000_000, "z" * 200), (3, "http://c/", "z" * 200)]
    assert sorted(r.page_id for r in warc.round_trip(spark.createDataFrame(rows, SCHEMA)).collect()) == [1, 2, 3]


def test_archive_packed_as_one_member():
    rnd = random.Random(5)
    parts = [warc.record(row(str(k), rnd.randbytes(30_000))) for k in range(6)]
    bad = bytearray(b"".join(parts))
    bad[len(parts[0]) + 5_000] ^= 255
    packed = warc.member(bytes(bad))
    assert told(packed) == (list("02345"), [(0, len(packed))])
    whole, after = warc.member(b"".join(parts)), warc.member(parts[0])
    cut = whole[: len(whole) // 2 - 5_000]
    assert told(cut) == (list("01"), [(0, len(cut))])
    assert told(cut + after) == (told(cut)[0] + ["0"], [(0, len(cut))])
    hurt = whole[:100_000] + b"\xff" * 50 + whole[100_050:]
    ids, gaps = told(hurt + after)
    assert ids[:3] == list("012") and ids[-1] == "0" and "3" not in ids and gaps == [(0, len(hurt))]


def test_gaps_are_logged(spark, tmp_path):
    (tmp_path / "x.warc").write_bytes(warc.record(row("1", b"a")) + b"lost" + warc.record(row("2", b"b")))
    rows = warc.read(spark, str(tmp_path)).orderBy("first_byte").collect()
    assert [(r.id, r.reason is None) for r in rows] == [("1", True), (None, False), ("2", True)]
    assert rows[1].end_byte - rows[1].first_byte == 4 and rows[1].file.endswith("x.warc") and bytes(rows[2].payload) == b"b"


def test_a_gap_after_writing_is_an_error(spark, monkeypatch):
    damaged = spark.createDataFrame([("f", 0, 9, "bad checksum")], "file string, first_byte long, end_byte long, reason string")
    missing = {name: F.lit(None).cast(kind) for name, kind in (x.split() for x in warc._READ.split(", ")) if name not in damaged.columns}
    monkeypatch.setattr(warc, "read", lambda *_, **__: damaged.withColumns(missing))
    pages = spark.createDataFrame([(1, "u", "text")], "page_id long, url string, html string")
    with pytest.raises(Exception, match="gap in archive f at byte 0 : bad checksum"):
        warc.round_trip(pages).collect()
