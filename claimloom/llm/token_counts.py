"""Token counts without encoding whole texts.

Offline, every vocabulary string is merged alone: those that come out as one token are proven whole, and a
pre-token that equals one of them counts as one token without any merging (``whole_tokens``). Only the
other pre-tokens are listed, shuffled and merged, each distinct one once (see ``pretokens``); a text's count
is the direct ones plus the sum over the rest.

Null texts count as empty: no bytes, no tokens. Equal rows each get a row.
"""

from __future__ import annotations

import json
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from claimloom.llm import byte_bpe, pretokens, shared


def byte_letters() -> dict[int, str]:
    """The printable letter that stands for each byte in byte-level vocabularies."""
    shown = [b for b in range(256) if 0x21 <= b <= 0x7E or 0xA1 <= b <= 0xAC or 0xAE <= b <= 0xFF]
    hidden = [b for b in range(256) if b not in shown]
    return {b: chr(b) for b in shown} | {b: chr(256 + k) for k, b in enumerate(hidden)}


@dataclass(frozen=True)
class Vocabulary:
    tokens: frozenset[bytes]
    merges: dict[tuple[bytes, bytes], int]
    special: str | None


def read_vocabulary(path: str) -> Vocabulary:
    """A byte-level BPE file; one added token at most."""
    with open(path, encoding="utf-8") as file:
        told = json.load(file)
    letter = {c: b for b, c in byte_letters().items()}
    raw = lambda text: bytes(letter[c] for c in text)
    added = [x["content"] for x in told["added_tokens"]]
    if len(added) > 1:
        raise ValueError("more than one added token")
    pairs = [x.split(" ") if isinstance(x, str) else x for x in told["model"]["merges"]]
    merges = {(raw(a), raw(b)): k for k, (a, b) in enumerate(pairs)}
    tokens = frozenset(raw(t) for t in told["model"]["vocab"] if t not in added)
    return Vocabulary(tokens, merges, added[0] if added else None)


def word_counter(vocabulary: Vocabulary):
    """A function from the bytes of a pre-token to a list with its number of tokens."""

    def count(word: bytes) -> list[int]:
        rank = lambda a, b: vocabulary.merges.get((a, b))
        return [len(pretokens.merged([word[k : k + 1] for k in range(len(word))], rank))]

    return count


def whole_tokens(vocabulary: Vocabulary) -> frozenset[str]:
    """Vocabulary strings that are valid text and that merging leaves as exactly one token."""
    count, whole = word_counter(vocabulary), []
    for token in vocabulary.tokens:
        if count(token) == [1]:
            try:
                whole.append(token.decode())
            except UnicodeDecodeError:
                continue
    return frozenset(whole)


def _summed(key: str):
    def run(batches):
        for batch in batches:
            for row in batch.to_pylist():
                values, starts, _ = pretokens.block_values(row)
                each = values[starts][pretokens.unpack(row["numbers"])].astype(np.int64)
                ends = np.append(0, np.cumsum(row["sizes"])).astype(np.int64)
                sums = np.append(0, np.cumsum(each))
                counts = np.array(row["n_direct"], np.int64) + sums[ends[1:]] - sums[ends[:-1]]
                yield pa.record_batch(
                    [pa.array(row[key]), pa.array(row["n_bytes"], pa.int64()), pa.array(counts)], names=[key, "n_bytes", "n_tokens"]
                )

    return shared.frugal(run)


def counts(docs: DataFrame, vocabulary: Vocabulary, pattern: str, key: str = "doc_id", limit: int = 512) -> DataFrame:
    """One row for each row of ``docs`` (``key`` and text; other columns are ignored): ``key``, n_bytes, n_tokens,
    over_limit. The added token's string inside a text is that one token."""
    split = pretokens.blocks(docs, key, pattern, whole_tokens(vocabulary), vocabulary.special)
    shipped = docs.sparkSession.sparkContext.broadcast(vocabulary)
    found = pretokens.with_values(split, lambda: word_counter(shipped.value))
    found = found.mapInArrow(byte_bpe._typed(_summed(key), key, docs), f"{key} {split.kind}, n_bytes long, n_tokens long")
    return found.withColumn("over_limit", F.col("n_tokens") > limit)
