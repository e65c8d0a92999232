"""WARC archives of pages: a writer with revisit records, and a salvage reader.

Writing: pages are compared by SHA-256 of the payload. Of equal payloads of ``REVISIT`` bytes or more the smallest id
becomes a response record, the others revisit records that name it. Each record is a gzip member of its own; a task
writes files of about ``FILE_BYTES`` through Spark's data source interface, under hidden names that the job's commit makes
visible, so tasks that run twice leave nothing that is read.

Reading: a record counts if its member unpacks that far, its head and length fit and a response's payload has the digest that
its head names. After a failed check the reader searches for the next gzip member or version line that starts a
good record, goes on there, and logs the bytes between as a gap (file, first byte, end, reason). Of a member that is damaged
or holds bad records, the good ones are kept and a gap is logged for the rest. Plain archives and files that mix both are read by the same rules.

Null payloads count as empty, a null url is left out of the head. Rows that share the smallest id of equal payloads are
all responses. A null id is no candidate for the smallest one unless all are null.
"""

from __future__ import annotations

import hashlib
import re
import uuid
import zlib

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage

from claimloom.sources import scratch

REVISIT = 100
FILE_BYTES = 16 << 20
VERSION = b"WARC/1.1\r\n"
_STEP = 1 << 16
_HEAD = re.compile(rb"WARC/1\.[01]\r\n")
_MEMBER = b"\x1f\x8b\x08"
_CONTENT = "id string, kind string, url string, payload binary, payload_bytes long, payload_digest string, refers_to string"
_READ = "file string, first_byte long, end_byte long, reason string, " + _CONTENT


def record(row: dict) -> bytes:
    """One record with the fields of ``_CONTENT``."""
    body = (row["payload"] or b"") if row["kind"] == "response" else b""
    head = {
        "WARC-Type": row["kind"],
        "WARC-Record-ID": f"<urn:page:{'' if row['id'] is None else row['id']}>",
        "WARC-Target-URI": None if row["url"] is None else row["url"].replace("%", "%25").replace("\r", "%0D").replace("\n", "%0A"),
        "WARC-Payload-Digest": f"sha256:{row['payload_digest']}",
        "WARC-Payload-Length": str(row["payload_bytes"]),
        "WARC-Refers-To": None if row["refers_to"] is None else f"<urn:page:{row['refers_to']}>",
        "Content-Type": "text/html",
        "Content-Length": str(len(body)),
    }
    lines = b"".join(f"{k}: {v}\r\n".encode() for k, v in head.items() if v is not None)
    return VERSION + lines + b"\r\n" + body + b"\r\n\r\n"


def member(data: bytes) -> bytes:
    packer = zlib.compressobj(1, zlib.DEFLATED, 31)
    return packer.compress(data) + packer.flush()


def _parsed(data: bytes, at: int = 0) -> tuple[dict | None, int, str]:
    """The record at a place of unpacked bytes, where it ends, and why it is none."""
    if not _HEAD.match(data, at):
        return None, at, "no version line"
    fields, stop = {}, data.find(b"\r\n", at)
    while True:  # a line without a colon ends the search, so what follows damage is not looked through for each version line
        begin, stop = stop + 2, data.find(b"\r\n", stop + 2)
        if stop < 0:
            return None, at, "head does not end"
        if stop == begin:
            break
        name, colon, value = data[begin:stop].partition(b":")
        if not colon:
            return None, at, "bad head line"
        fields[name.strip().lower().decode("latin-1")] = value.strip().decode("utf-8", "replace")
    if not fields.get("content-length", "").isdigit():
        return None, at, "no length"
    end = stop + 2 + int(fields["content-length"])
    if data[end : end + 4] != b"\r\n\r\n":
        return None, at, "length does not fit"
    body, digest = data[stop + 2 : end], fields.get("warc-payload-digest", "").removeprefix("sha256:")
    kind = fields.get("warc-type", "")
    if kind == "response" and digest and hashlib.sha256(body).hexdigest() != digest:
        return None, at, "digest differs"
    name = lambda field: re.sub(r"^<urn:page:(.*)>$", r"\1", fields[field]) or None if field in fields else None
    size, url = fields.get("warc-payload-length", ""), fields.get("warc-target-uri")
    return (
        {
            "id": name("warc-record-id"),
            "kind": kind,
            "url": None if url is None else url.replace("%0D", "\r").replace("%0A", "\n").replace("%25", "%"),
            "payload": body if kind == "response" else None,
            "payload_bytes": int(size) if size.isdigit() else len(body),
            "payload_digest": digest or hashlib.sha256(body).hexdigest(),
            "refers_to": name("warc-refers-to"),
        },
        end + 4,
        "",
    )


def _unpacked(data: bytes, at: int) -> tuple[bytes, int, str]:
    """What the member at a place unpacks to, as far as it does, where it ends, and what is wrong with it."""
    unpacker, parts, read, step = zlib.decompressobj(31), [], at, _STEP
    while not unpacker.eof and read < len(data):
        try:
            parts.append(unpacker.decompress(data[read : read + step]))
        except zlib.error:
            if step == 1:
                return b"".join(parts), read, "member does not unpack"
            unpacker, step = zlib.decompressobj(31), 1  # again, byte by byte from here on, for all that comes before the damage
            parts = [unpacker.decompress(data[at:read])]
            continue
        read = min(read + step, len(data))
    return b"".join(parts), read - len(unpacker.unused_data), "" if unpacker.eof else "member is cut off"


def _inside(data: bytes) -> tuple[list[dict], str]:
    """Good records of unpacked bytes, and why others are none."""
    found, at, reason = [], 0, ""
    while at < len(data):
        one, end, why = _parsed(data, at)
        if one:
            found.append(one)
            at = end
            continue
        reason = reason or why
        line = _HEAD.search(data, at + 1)
        at = line.start() if line else len(data)
    return found, reason


def _at(data: bytes, at: int) -> tuple[list[dict], int, str]:
    """Records of the member or plain record at a place of a file, where it ends (at the place itself, if that is not known),
    and why something of it is lost."""
    if data.startswith(_MEMBER, at):
        inner, end, broken = _unpacked(data, at)
        found, why = _inside(inner)
        return found, at if broken or not found else end, broken or why or ("" if found else "empty member")
    one, end, why = _parsed(data, at)
    return ([one], end, "") if one else ([], at, why)


def salvage(data: bytes):
    """(first byte, end, reason, record or None) of every record and every gap of an archive's bytes, in order. A member of which
    only some records are good gives these and a gap, all with the bytes of the member."""
    at, lost, reason, kept = 0, None, "", []

    def ended(end: int):
        for one in kept:
            yield lost, end, None, one
        if lost is not None:
            yield lost, end, reason, None

    while at < len(data):
        found, end, why = _at(data, at)
        if found:
            yield from ended(at)
            lost, kept = None, []
            if end > at:
                for one in found:
                    yield at, end, None, one
                if why:
                    yield at, end, why, None
                at = end
                continue
            lost, reason, kept = at, why, found
        elif lost is None:
            lost, reason = at, why
        plain = _HEAD.search(data, at + 1)
        packed = data.find(_MEMBER, at + 1)
        at = min([x for x in (plain.start() if plain else -1, packed) if x >= 0], default=len(data))
    yield from ended(len(data))


class Archive(DataSource):
    """Sink ``warc_archive``: rows with the fields of ``_CONTENT`` as files of gzip members below ``path``."""

    @classmethod
    def name(cls) -> str:
        return "warc_archive"

    def schema(self) -> str:
        return _CONTENT

    def writer(self, schema, overwrite):
        return _Writer(self.options["path"])


class _Written(WriterCommitMessage):
    def __init__(self, names: list[str]):
        self.names = names


class _Writer(DataSourceArrowWriter):
    def __init__(self, path: str):
        self.path = path

    def _folder(self):
        from pyarrow import fs

        where = self.path if re.match(r"[a-z0-9]+:", self.path) else f"file://{self.path}"
        where = re.sub(r"^file:/+", "file:///", where)
        return fs.FileSystem.from_uri(where)

    def write(self, iterator) -> _Written:
        system, folder = self._folder()
        system.create_dir(folder, recursive=True)
        names, out = [], None
        for batch in iterator:
            for row in batch.to_pylist():
                if out is None:
                    names.append(f"part-{uuid.uuid4().hex}.warc.gz")
                    out = system.open_output_stream(f"{folder}/.{names[-1]}", compression=None)
                out.write(member(record(row)))
                if out.tell() >= FILE_BYTES:
                    out.close()
                    out = None
        if out is not None:
            out.close()
        return _Written(names)

    def _names(self, messages) -> list[str]:
        return [name for message in messages if message is not None for name in message.names]

    def commit(self, messages) -> None:
        system, folder = self._folder()
        for name in self._names(messages):
            system.move(f"{folder}/.{name}", f"{folder}/{name}")

    def abort(self, messages) -> None:
        system, folder = self._folder()
        for name in self._names(messages):
            system.delete_file(f"{folder}/.{name}")


def write(pages: DataFrame, path: str, key: str = "page_id", payload: str = "html") -> None:
    """Archives of all rows of ``pages`` (``key``, url, ``payload``) below ``path``."""
    spark = pages.sparkSession
    spark.dataSource.register(Archive)
    body = F.coalesce(F.col(payload).cast("binary"), F.lit("").cast("binary"))
    rows = pages.select(F.col(key).alias("key"), F.col("url"), body.alias("payload"))
    rows = rows.withColumn("payload_bytes", F.length("payload").cast("long")).withColumn("payload_digest", F.sha2("payload", 256))
    large = rows.filter(F.col("payload_bytes") >= REVISIT)
    equal = large.groupBy("payload_digest").agg(F.min("key").alias("first"), F.count("*").alias("n")).filter("n > 1")
    rows = rows.join(equal.select("payload_digest", "first"), "payload_digest", "left")
    again = F.col("first").isNotNull() & ~F.col("key").eqNullSafe(F.col("first"))
    rows = rows.select(
        F.col("key").cast("string").alias("id"),
        F.when(again, "revisit").otherwise("response").alias("kind"),
        "url",
        F.when(~again, F.col("payload")).alias("payload"),
        "payload_bytes",
        "payload_digest",
        F.when(again, F.col("first")).cast("string").alias("refers_to"),
    )
    rows.write.format("warc_archive").option("path", path).mode("append").save()


def _salvaged(payloads: bool):
    def run(batches):
        for batch in batches:
            for file, data in zip(batch.column("path"), batch.column("content"), strict=True):
                rows = []
                for first, end, reason, one in salvage(data.as_py()):
                    one = one or dict.fromkeys(x.split()[0] for x in _CONTENT.split(", "))
                    rows.append({"file": file.as_py(), "first_byte": first, "end_byte": end, "reason": reason} | one)
                    if not payloads:
                        rows[-1]["payload"] = None
                kinds = {"string": pa.string(), "long": pa.int64(), "binary": pa.binary()}
                names = [x.split() for x in _READ.split(", ")]
                yield pa.record_batch([pa.array([r[n] for r in rows], kinds[k]) for n, k in names], names=[n for n, _ in names])

    return run


def read(spark: SparkSession, path: str, payloads: bool = True) -> DataFrame:
    """Records (reason null) and gaps (reason set) of all archives below ``path``."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path).select("path", "content")
    return files.mapInArrow(_salvaged(payloads), _READ)


def round_trip(pages: DataFrame) -> DataFrame:
    """The archives of ``pages`` (page_id, url, html) written to the shared folder and read back: page_id, payload_bytes,
    payload_digest, record_type, refers_to. A gap in what was just written is an error, not a missing row."""
    spark = pages.sparkSession
    path = scratch.fresh(spark, "warc")
    write(pages, path)
    kind = pages.schema["page_id"].dataType.simpleString()
    lost = F.raise_error(F.concat_ws(" ", F.lit("gap in archive"), "file", F.lit("at byte"), "first_byte", F.lit(":"), "reason")).cast("boolean")
    whole = F.when(F.col("reason").isNull(), F.lit(True)).otherwise(lost)
    return read(spark, path, payloads=False).filter(whole).select(
        F.col("id").cast(kind).alias("page_id"),
        "payload_bytes",
        "payload_digest",
        F.col("kind").alias("record_type"),
        F.col("refers_to").cast(kind).alias("refers_to"),
    )
