"""Pre-tokens of texts, and a value for each distinct one: the shuffle that whole-corpus tokenizing shares.

1. Each task splits a block of texts by the tokenizer's pattern, numbers the block's distinct words and
   writes one row: the texts' ids and sizes, the word numbers in text order, the distinct words. The table is
   bucketed by block number, so later joins on the block move only the other side.
2. The distinct words of all blocks are shuffled by word with their block and number. A word meets once per
   block at most, however often it occurs, so a frequent word is no hot key. Sorted, equal words are
   neighbours, and each distinct word is worked on once.
3. What was found goes back by block, packed, and is joined to the blocks' word numbers.

Block numbers are stored in the written table, so a recomputed task reads the same ones. The table lives in
the session's warehouse until ``drop``.
"""

from __future__ import annotations

import array
import heapq
import uuid
from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from claimloom.llm import shared

#: Bytes of text in a block; a longer text is a block by itself.
BLOCK = 32 << 20
#: Words that are put together at once when a block is read.
STRETCH = 1 << 18
_BLOCK_KIND = "block long, {key} array<{kind}>, n_bytes array<long>, n_direct array<long>, sizes array<long>, numbers binary, words array<binary>"


class _Numbers(dict):
    def __missing__(self, word):
        self[word] = number = len(self)
        return number


def pack(numbers: np.ndarray) -> bytes:
    """32-bit numbers, byte planes one after the other, compressed."""
    planes = np.ascontiguousarray(numbers.astype("<u4").view(np.uint8).reshape(-1, 4).T)
    return len(numbers).to_bytes(8, "little") + pa.Codec("zstd", 1).compress(planes.tobytes(), asbytes=True)


def unpack(packed: bytes) -> np.ndarray:
    n = int.from_bytes(packed[:8], "little")
    planes = pa.Codec("zstd").decompress(packed[8:], 4 * n, asbytes=True) if n else b""
    return np.ascontiguousarray(np.frombuffer(planes, np.uint8).reshape(4, n).T).view("<u4").reshape(-1)


def _split(key: str, pattern: str, whole: frozenset[str], special: str | None):
    """Blocks of texts. Words in ``whole`` count as one each and are not listed; the string ``special``
    counts as one and splits the text."""

    def run(batches):
        find, made = regex.compile(pattern).findall, 0
        for batch in batches:
            for part in shared.pieces(batch, "text", BLOCK):
                numbers, order, sizes, direct = _Numbers(), array.array("I"), [], []
                for text in part.column("text").to_pylist():
                    parts = text.split(special) if special else [text]
                    found = len(parts) - 1
                    before = len(order)
                    for one in parts:
                        words = find(one)
                        if whole:
                            rest = [w for w in words if w not in whole]
                            found += len(words) - len(rest)
                            words = rest
                        order.extend(map(numbers.__getitem__, words))
                    sizes.append(len(order) - before)
                    direct.append(found)
                _, places = shared.raw(part.column("text"))
                one = lambda values: pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), values)
                ids = part.column(key)
                yield pa.record_batch(
                    [
                        pa.array([TaskContext.get().partitionId() << 33 | made], pa.int64()),
                        one(ids),
                        one(pa.array(np.diff(places))),
                        one(pa.array(direct, pa.int64())),
                        one(pa.array(sizes, pa.int64())),
                        pa.array([pack(np.frombuffer(order, np.uint32))], pa.binary()),
                        one(pa.array([w.encode() for w in numbers], pa.binary())),
                    ],
                    names=["block", key, "n_bytes", "n_direct", "sizes", "numbers", "words"],
                )
                made += 1

    return shared.frugal(run)


@dataclass
class Blocks:
    spark: SparkSession
    name: str
    key: str
    kind: str

    def table(self) -> DataFrame:
        return self.spark.table(self.name)

    def drop(self) -> None:
        self.spark.sql(f"DROP TABLE IF EXISTS {self.name}")


def blocks(docs: DataFrame, key: str, pattern: str, whole: frozenset[str] = frozenset(), special: str | None = None) -> Blocks:
    """The written block table of ``docs`` (``key`` and text; null texts count as empty)."""
    spark = docs.sparkSession
    texts = docs.select(F.col(key), F.coalesce("text", F.lit("")).alias("text"))
    kind = docs.schema[key].dataType.simpleString()
    found = texts.mapInArrow(_split(key, pattern, whole, special), _BLOCK_KIND.format(key=key, kind=kind))
    buckets = max(4, int(spark.conf.get("spark.sql.shuffle.partitions")))  # the session's measure of the data
    name = f"blocks_{uuid.uuid4().hex[:16]}"
    found.write.bucketBy(buckets, "block").format("parquet").option("compression", "zstd").saveAsTable(name)
    return Blocks(spark, name, key, kind)


def _valued(make: Callable[[], Callable[[bytes], list[int]]]):
    """For sorted rows (word, block, number): the values of the words, packed by block."""

    def run(batches):
        value, last, known = make(), None, []
        for batch in batches:
            lengths, values = [], []
            for word in batch.column("word").to_pylist():
                if word != last:
                    last, known = word, value(word)
                lengths.append(len(known))
                values.extend(known)
            at, order = batch.column("block").to_numpy(), np.argsort(batch.column("block").to_numpy(), kind="stable")
            lengths, numbers = np.array(lengths, np.uint32), batch.column("number").to_numpy().astype(np.uint32)
            values = gather(np.array(values, np.uint32), np.cumsum(lengths) - lengths, lengths, order)
            at, lengths, numbers = at[order], lengths[order], numbers[order]
            cuts = np.append(np.flatnonzero(np.append(True, at[1:] != at[:-1])) if len(at) else [], len(at)).astype(np.int64)
            ends = np.append(0, np.cumsum(lengths.astype(np.int64)))
            rows = list(zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True))
            yield pa.record_batch(
                [
                    pa.array([at[a] for a, _ in rows], pa.int64()),
                    pa.array([pack(numbers[a:b]) for a, b in rows], pa.binary()),
                    pa.array([pack(lengths[a:b]) for a, b in rows], pa.binary()),
                    pa.array([pack(values[ends[a] : ends[b]]) for a, b in rows], pa.binary()),
                ],
                names=["block", "number", "length", "value"],
            )

    return shared.frugal(run)


def gather(values: np.ndarray, starts: np.ndarray, lengths: np.ndarray, order: np.ndarray) -> np.ndarray:
    """The stretches of ``values`` that begin at ``starts``, in the given order, one after the other."""
    starts, lengths = starts.astype(np.int64)[order], lengths.astype(np.int64)[order]
    ends = np.cumsum(lengths)
    total = int(ends[-1]) if len(ends) else 0
    return values[np.repeat(starts - (ends - lengths), lengths) + np.arange(total)]


def with_values(split: Blocks, make: Callable[[], Callable[[bytes], list[int]]]) -> DataFrame:
    """The block table, each block with ``found``: a list of (number, length, value), packed, for all of its
    words. ``make`` is called in a task and gives a function from a word to its values."""
    table = split.table()
    words = table.select("block", F.posexplode("words").alias("number", "word"))
    words = words.repartition(F.col("word")).sortWithinPartitions("word")
    found = words.mapInArrow(_valued(make), "block long, number binary, length binary, value binary")
    found = found.groupBy("block").agg(F.collect_list(F.struct("number", "length", "value")).alias("found"))
    return table.drop("words").join(found.hint("merge"), "block", "left")


def stretches(ends: np.ndarray):
    """Consecutive texts (first, end) with about ``STRETCH`` words together, one text at least; ``ends``: words before each
    text and after the last one."""
    at = 0
    while at < len(ends) - 1:
        end = max(at + 1, int(np.searchsorted(ends, ends[at] + STRETCH, "right")) - 1)
        yield at, end
        at = end


def block_values(row: dict) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of a row of ``with_values``: all values, and by word number where they start and how many there are."""
    found = row["found"] or []
    numbers, lengths = (np.concatenate([unpack(x[k]) for x in found]) if found else np.zeros(0, np.uint32) for k in ("number", "length"))
    values = np.concatenate([unpack(x["value"]) for x in found]) if found else np.zeros(0, np.uint32)
    starts, sizes = np.zeros(len(numbers), np.int64), np.zeros(len(numbers), np.int64)
    starts[numbers] = np.cumsum(lengths.astype(np.int64)) - lengths
    sizes[numbers] = lengths
    return values, starts, sizes


def merged(word: list, rank: Callable) -> list:
    """Byte-pair merging: of all neighbours those with the lowest rank become one, the leftmost first, until no pair has a
    rank (null). Pairs wait in a heap and what is left stands in a linked list, so n symbols take n log n steps."""
    n, word = len(word), list(word)
    before, after = list(range(-1, n - 1)), list(range(1, n + 1))
    heap = [(r, k) for k in range(n - 1) if (r := rank(word[k], word[k + 1])) is not None]
    heapq.heapify(heap)
    while heap:
        r, k = heapq.heappop(heap)
        other = after[k]
        if word[k] is None or other == n or rank(word[k], word[other]) != r:
            continue  # one of the two has become part of another symbol
        word[k], word[other], after[k] = word[k] + word[other], None, after[other]
        if after[k] < n:
            before[after[k]] = k
            if (r := rank(word[k], word[after[k]])) is not None:
                heapq.heappush(heap, (r, k))
        if before[k] >= 0 and (r := rank(word[before[k]], word[k])) is not None:
            heapq.heappush(heap, (r, before[k]))
    return [x for x in word if x is not None]
