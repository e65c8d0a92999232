"""Byte-level BPE encoding and decoding of whole tables.

Encoding: every distinct pre-token of the corpus is merged once (see ``pretokens``), its ids come back
to the blocks of texts and are put together by position. Decoding joins the token-byte table by id. That table
has one row for each entry of the vocabulary file, so its size does not depend on the data; it is sent to the tasks and
joined there.

Null texts count as empty and encode to no ids; equal rows each get a row. Ids are bytes: unsigned 32-bit
little-endian numbers, so that n_tokens is a quarter of their length.
"""

from __future__ import annotations

import base64

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from claimloom.llm import pretokens, shared


def read_ranks(path: str) -> dict[bytes, int]:
    """Token bytes and ranks of a vocabulary file: a base64 string and a number per line."""
    with open(path, "rb") as lines:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}


def word_encoder(ranks: dict[bytes, int]):
    """A function from the bytes of a pre-token to its ids."""

    def encode(word: bytes) -> list[int]:
        if word in ranks:
            return [ranks[word]]
        whole = pretokens.merged([word[k : k + 1] for k in range(len(word))], lambda a, b: ranks.get(a + b))
        return [ranks[x] for x in whole]

    return encode


def _assembled(key: str):
    def run(batches):
        for batch in batches:
            for row in batch.to_pylist():
                values, starts, sizes = pretokens.block_values(row)
                order = pretokens.unpack(row["numbers"])
                ends = np.append(0, np.cumsum(row["sizes"])).astype(np.int64)
                for first, end in pretokens.stretches(ends):
                    part = order[ends[first] : ends[end]]
                    lengths = np.append(0, np.cumsum(sizes[part]))[ends[first : end + 1] - ends[first]] * 4
                    ids = pretokens.gather(values, starts, sizes, part).astype("<u4").tobytes()
                    texts = [ids[a:b] for a, b in zip(lengths[:-1], lengths[1:], strict=True)]
                    yield pa.record_batch([pa.array(row[key][first:end]), pa.array(texts, pa.binary())], names=[key, "ids"])

    return shared.frugal(run)


def _decoded(table: dict[int, bytes]):
    def run(batches):
        tokens = [b""] * (max(table, default=-1) + 1)
        for number, token in table.items():
            tokens[number] = token
        sizes = np.array([len(t) for t in tokens], np.int64)
        starts, everything = np.cumsum(sizes) - sizes, np.frombuffer(b"".join(tokens), np.uint8)
        for batch in batches:
            column = batch.schema.get_field_index("ids")
            texts = []
            for ids in batch.column(column).to_pylist():
                texts.append(None if ids is None else pretokens.gather(everything, starts, sizes, np.frombuffer(ids, "<u4")).tobytes())
            yield pa.record_batch([*batch.columns, pa.array(texts, pa.binary())], names=[*batch.schema.names, "decoded"])

    return shared.frugal(run)


def encode(docs: DataFrame, ranks: dict[bytes, int], pattern: str, key: str = "doc_id") -> DataFrame:
    """One row for each row of ``docs`` (``key`` and text; other columns are ignored): ``key``, ids (binary)."""
    split = pretokens.blocks(docs, key, pattern)
    shipped = docs.sparkSession.sparkContext.broadcast(ranks)
    found = pretokens.with_values(split, lambda: word_encoder(shipped.value))
    return found.mapInArrow(_typed(_assembled(key), key, docs), f"{key} {split.kind}, ids binary")


def _typed(run, key: str, docs: DataFrame):
    """Batches whose first column has the type of ``key``, also where all of its values are null."""
    from pyspark.sql.pandas.types import to_arrow_type

    kind = to_arrow_type(docs.schema[key].dataType)

    def typed(batches):
        for batch in run(batches):
            yield pa.record_batch([batch.column(0).cast(kind), *batch.columns[1:]], names=batch.schema.names)

    return typed


def decode(encoded: DataFrame, ranks: dict[bytes, int]) -> DataFrame:
    """``encoded`` and the bytes that its ids stand for, as ``decoded``."""
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in encoded.schema.fields)
    return encoded.mapInArrow(_decoded({number: token for token, number in ranks.items()}), f"{kinds}, decoded binary")


def digests(encoded: DataFrame, key: str = "doc_id") -> DataFrame:
    """``key``, n_tokens, ids_sha256, decoded_sha256 of rows with ids and decoded."""
    return encoded.select(
        key,
        (F.length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )
