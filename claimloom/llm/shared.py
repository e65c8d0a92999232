"""What several operators share: texts as numpy arrays inside Arrow batches, 64-bit names of words,
and connected components."""

from __future__ import annotations

import ctypes
import functools
import gc

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from claimloom.sources import scratch

#: Bytes of text that a task works on at once; a longer text is one piece by itself.
PIECE = 4 << 20
#: Stretches of seven bytes that are named at once; a longer word is one step by itself.
SPAN = 1 << 18
#: Words of at most so many stretches are named stretch by stretch, longer ones all at once.
FEW = 4
#: Words are named by polynomials over the field of this many elements, taken at the point.
PRIME = (1 << 61) - 1
#: Entries of a sparse matrix that are multiplied at once, and numbers that are summed without being halved.
ENTRIES, LEAF = 1 << 11, 128

_POINT = 0x0D1B54A32D192ED0
_BASE = 0x9E3779B97F4A7C15
_ODD1, _ODD2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
_cache: dict[str, np.ndarray] = {}


def frugal(run):
    """A function of batches that returns freed memory to the system when its task ends. Python workers live on between
    tasks, and what earlier steps left would count against the executor."""

    def wrapped(batches):
        try:
            yield from run(batches)
        finally:
            gc.collect()
            pa.default_memory_pool().release_unused()
            try:
                ctypes.CDLL(None).malloc_trim(0)
            except (OSError, AttributeError):  # another C library: nothing to do
                pass

    return wrapped


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers whose output bits all depend on all input bits."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= _ODD1
    x ^= x >> np.uint64(27)
    x *= _ODD2
    x ^= x >> np.uint64(31)
    return x


def blank_bytes() -> np.ndarray:
    """True for the bytes that end a word: space and 0x09 to 0x0D."""
    table = np.zeros(256, bool)
    table[[0x20, *range(0x09, 0x0E)]] = True
    return table


def punctuation_bytes() -> np.ndarray:
    """True for every ASCII byte that is neither a letter nor a digit."""
    return np.array([b < 128 and not chr(b).isalnum() for b in range(256)])


def pieces(batch: pa.RecordBatch, text: str, limit: int = PIECE):
    """The batch in slices of at most ``limit`` bytes of text, one row at least."""
    column = batch.column(batch.schema.get_field_index(text))
    if not len(column):
        return
    ends = np.cumsum(pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False).astype(np.int64))
    at = 0
    while at < len(ends):
        before = ends[at - 1] if at else 0
        end = max(at + 1, int(np.searchsorted(ends, before + limit, "right")))
        yield batch.slice(at, end - at)
        at = end


def raw(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all texts, and where each begins and the last one ends; null counts as empty."""
    if column.null_count:
        column = pc.fill_null(column, "")
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, places, data = column.buffers()
    kind = np.int64 if pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type) else np.int32
    places = np.frombuffer(places, kind)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    data = np.frombuffer(data if data is not None else b"", np.uint8)[places[0] : places[-1]]
    return data, places - places[0]


def words(data: np.ndarray, places: np.ndarray, blank: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end of every word, and the number of words before each text and after the last."""
    inside = np.zeros(len(data) + 2, bool)
    np.logical_not(blank[data], out=inside[1:-1])
    edges = np.flatnonzero(inside[1:] != inside[:-1])  # starts and ends by turns
    cuts = np.unique(places)
    cuts = np.repeat(cuts[inside[cuts] & inside[cuts + 1]], 2)  # texts that end and begin within a word
    edges = np.insert(edges, np.searchsorted(edges, cuts), cuts)
    starts = edges[::2].copy()
    return starts, edges[1::2].copy(), np.searchsorted(starts, places)


def _times(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """x * y modulo ``PRIME`` for numbers below it: products of halves, folded at bit 61."""
    low, half = np.uint64(0xFFFFFFFF), np.uint64(32)
    x0, x1, y0, y1 = x & low, x >> half, y & low, y >> half
    middle = x0 * y1 + x1 * y0
    # The product is x1*y1*2^64 + middle*2^32 + x0*y0, and 2^61 counts as 1.
    small = x0 * y0
    out = (x1 * y1 << np.uint64(3)) + (middle >> np.uint64(29)) + ((middle & np.uint64((1 << 29) - 1)) << half)
    out = _least(out) + _least(small)
    return _least(out)


def _least(x: np.ndarray) -> np.ndarray:
    """Numbers below 2^64 modulo ``PRIME``."""
    prime = np.uint64(PRIME)
    x = (x & prime) + (x >> np.uint64(61))
    return np.minimum(x, x - prime)  # below zero counts as very much


def _powers(count: int) -> np.ndarray:
    """The first ``count`` powers of the point at which words are evaluated; they are kept for the next call."""
    powers = _cache.get("powers", np.ones(1, np.uint64))
    if len(powers) < count:
        step = np.full(1, _POINT, np.uint64)
        for _ in range(len(powers).bit_length() - 1):
            step = _times(step, step)
        while len(powers) < count:
            powers = np.concatenate([powers, _times(powers, step)])
            step = _times(step, step)
        _cache["powers"] = powers
    return powers


def names(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, fold: bool = False) -> np.ndarray:
    """A 64-bit name for every word; equal words have equal names. ``fold``: A-Z count as a-z.

    One rule for words of all lengths: seven bytes at a time are the coefficients of a polynomial modulo the prime
    2^61 - 1, and its value at a fixed point is mixed with the length. Over a prime field two words of n bytes agree
    at no more than n / 7 points; words of up to seven bytes never share a value."""
    out, at = np.empty(len(starts), np.uint64), 0
    if not len(starts):
        return out
    if fold:
        data = data + ((data - np.uint8(65) < np.uint8(26)).view(np.uint8) << np.uint8(5))
    eights = np.ndarray(len(data), "<u8", np.append(data, np.zeros(7, np.uint8)), strides=(1,))
    masks = np.array([(1 << 8 * n) - 1 for n in range(8)], np.uint64)
    sizes = ends - starts
    chunks = np.cumsum((sizes + 6) // 7)
    while at < len(starts):
        before = chunks[at - 1] if at else 0
        end = max(at + 1, int(np.searchsorted(chunks, before + SPAN, "right")))
        s, size = starts[at:end], sizes[at:end]
        values = eights[s] & masks[np.minimum(size, 7)]
        long = np.flatnonzero(size > 7)
        few, long = long[size[long] <= 7 * FEW], long[size[long] > 7 * FEW]
        for k in range(1, FEW):  # most words have few stretches; these are added step by step
            few = few[size[few] > 7 * k]
            more = eights[s[few] + 7 * k] & masks[np.minimum(size[few] - 7 * k, 7)]
            values[few] = _least(values[few] + _times(more, _powers(FEW)[k]))
        if len(long):
            each = (size[long] + 6) // 7 - 1
            heads = np.cumsum(each) - each
            place = np.arange(int(each.sum())) - np.repeat(heads, each) + 1
            more = eights[np.repeat(s[long], each) + 7 * place] & masks[np.minimum(np.repeat(size[long], each) - 7 * place, 7)]
            more = _times(more, _powers(int(each.max()) + 1)[place])
            # Halves are summed apart, so that no sum leaves 64 bits.
            high = np.add.reduceat(more >> np.uint64(32), heads)
            low = np.add.reduceat(more & np.uint64(0xFFFFFFFF), heads)
            more = _least(_times(_least(high), np.uint64(1 << 32)) + _least(low))
            values[long] = _least(values[long] + more)
        out[at:end] = mix(mix(values + np.uint64(_BASE)) + size.astype(np.uint64))
        at = end
    return out


def rolled(values: np.ndarray, width: int) -> np.ndarray:
    """The name of every ``width`` consecutive values (none, if there are fewer). Stretches are joined two and two; each
    left one is stirred first, for each length in another way, so that neither sums nor swapped values agree."""
    n = len(values) - width + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out, done, power, size = None, 0, values, 1

    def stirred(x: np.ndarray, round_: int) -> np.ndarray:
        return mix(x + np.uint64(round_ * _BASE % (1 << 64)))

    while True:
        if width & size:
            if out is None:
                out, done = power[:n], size
            else:
                out = stirred(out, 2 * size + 1) + power[done : done + n]
                done += size
        if done == width:
            return mix(out)
        power = stirred(power[: len(power) - size], 2 * size) + power[size:]
        size *= 2


def lists(values: np.ndarray, counts: np.ndarray) -> pa.ListArray:
    """Consecutive values as lists of the given lengths; 64-bit names become signed longs."""
    places = np.zeros(len(counts) + 1, np.int32)
    np.cumsum(counts, out=places[1:])
    return pa.ListArray.from_arrays(pa.array(places), pa.array(values.view(np.int64)))


def row_sums(table: np.ndarray, rows: np.ndarray, weights: np.ndarray, firsts: np.ndarray) -> np.ndarray:
    """For each stretch that begins at ``firsts`` the sum of ``weights[k] * table[rows[k]]``: a sparse matrix times a dense one.
    Stretches of one length are summed together, row upon row. The order is that of ``np.add.reduceat`` along a line of numbers: the
    first and the sum of the rest, which is halved until at most ``LEAF`` are left; so a sum does not depend on its neighbours."""
    kind = np.result_type(table, weights)
    table, weights, sizes = table.astype(kind, copy=False), weights.astype(kind, copy=False), np.diff(np.append(firsts, len(rows)))
    out = np.empty((len(firsts), table.shape[1]), kind)
    short = sizes <= LEAF + 1
    some = np.flatnonzero(short)
    _stretches(table, rows, weights, firsts[some], sizes[some], True, out, some)
    long = np.flatnonzero(~short)
    if len(long):
        split = [_leaves(n - 1) for n in sizes[long].tolist()]
        count = np.array([len(x) for x in split])
        leaf = np.concatenate(split)
        ends, heads = np.cumsum(leaf), np.cumsum(count) - count
        begin = ends - leaf + np.repeat(firsts[long] + 1 - (ends - leaf)[heads], count)
        sums = np.empty((len(leaf), table.shape[1]), kind)
        _stretches(table, rows, weights, begin, leaf, False, sums, np.arange(len(leaf)))
        for k, n, head in zip(long.tolist(), sizes[long].tolist(), heads.tolist(), strict=True):
            out[k] = table[rows[firsts[k]]] * weights[firsts[k]] + _halves(n - 1, iter(sums[head:]))
    return out


def _stretches(table, rows, weights, firsts, sizes, lead: bool, out: np.ndarray, places: np.ndarray) -> None:
    """Puts the sums of short stretches at their places in ``out``; ``lead``: the first entry is added last."""
    space = np.empty((ENTRIES, table.shape[1]), table.dtype)
    order = np.argsort(sizes, kind="stable")
    lengths, turns = np.unique(sizes[order], return_index=True)
    for n, turn, end in zip(lengths.tolist(), turns.tolist(), np.append(turns, len(order))[1:].tolist(), strict=True):
        step = ENTRIES // n
        for at in range(turn, end, step):
            some = order[at : min(at + step, end)]
            entry = firsts[some] + np.arange(n)[:, None]
            parts = space[: entry.size].reshape(n, len(some), -1)
            np.take(table, rows[entry], axis=0, out=parts, mode="clip")  # all are inside; this mode writes without a copy
            parts *= weights[entry][:, :, None]
            total = _leaf_sum(parts[1:] if lead and n > 1 else parts)
            out[places[some]] = parts[0] + total if lead and n > 1 else total


def _leaf_sum(parts: np.ndarray) -> np.ndarray:
    """The sum over the first axis, which is used up: eight sums side by side, then what is left, one by one."""
    total, done = parts[0], 1
    if len(parts) >= 8:
        done = len(parts) // 8 * 8
        sums = parts[:8]
        for k in range(8, done, 8):
            sums += parts[k : k + 8]
        while len(sums) > 1:
            sums = sums[::2] + sums[1::2]
        total = sums[0]
    for k in range(done, len(parts)):
        total += parts[k]
    return total


@functools.lru_cache(1 << 12)
def _leaves(n: int) -> tuple[int, ...]:
    """Lengths of the leaves of a sum of ``n`` numbers."""
    half = n // 2 // 8 * 8
    return (n,) if n <= LEAF else _leaves(half) + _leaves(n - half)


def _halves(n: int, sums) -> np.ndarray:
    """The sum of ``n`` numbers from the sums of its leaves."""
    if n <= LEAF:
        return next(sums)
    half = n // 2 // 8 * 8
    return _halves(half, sums) + _halves(n - half, sums)


def row_lists(column: pa.Array) -> list[np.ndarray]:
    """The lists of a column of longs as arrays of 64-bit names; a null is an empty list."""
    flat, ends = column.flatten().to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64), []
    at = 0
    for n in pc.fill_null(pc.list_value_length(column), 0).to_pylist():
        ends.append(flat[at : at + n])
        at += n
    return ends


def components(edges: DataFrame, left: str, right: str) -> DataFrame:
    """Columns ``node``, ``label``: for every end of an edge between two nodes the smallest node that it is connected to.

    Each round contracts the graph: nodes are ordered by a hash that changes from round to round, so that long chains shrink by a
    share; a node becomes its first neighbour's first neighbour, edges get the new ends, and loops and repeats are dropped, so
    each round works on a smaller table. Edges point from the later node to the earlier one only. Edges and labels live in
    written tables; only whether an edge is left reaches the driver. A node with very many edges is split by adaptive skew
    handling, as its rows meet in a join with one row."""

    def place(node: str, turn: int):
        return F.struct(F.xxhash64(F.lit(turn), node).alias("hash"), F.col(node).alias("node"))

    def pointed(df: DataFrame, one: str, two: str, turn: int) -> DataFrame:
        later = place(one, turn) > place(two, turn)
        ends = df.filter(F.col(one) != F.col(two)).select(
            F.when(later, F.col(one)).otherwise(F.col(two)).alias("node"), F.when(later, F.col(two)).otherwise(F.col(one)).alias("other")
        )
        return scratch.written(ends.distinct(), "edges")

    turn, labels = 0, None
    edges = pointed(edges, left, right, turn)
    while edges.limit(1).count():
        near = edges.groupBy("node").agg(F.min(place("other", turn)).alias("first")).select("node", F.col("first.node").alias("near"))
        far = near.select(F.col("node").alias("near"), F.col("near").alias("far"))
        step = scratch.written(near.join(far, "near", "left").select("node", F.coalesce("far", "near").alias("label")), "step")
        labels = step if labels is None else scratch.written(followed(labels, step), "labels")
        ends = edges.join(step.withColumnRenamed("label", "one"), "node").select("one", "other")
        ends = ends.join(step.select(F.col("node").alias("other"), F.col("label").alias("two")), "other", "left")
        turn += 1
        edges = pointed(ends.select("one", F.coalesce("two", "other").alias("two")), "one", "two", turn)
    if labels is None:
        return edges.select("node", F.col("other").alias("label"))
    labels = labels.filter("node <> label")
    least = labels.groupBy("label").agg(F.min("node").alias("node")).select("label", F.least("label", "node").alias("least"))
    found = labels.join(least, "label").select("node", F.col("least").alias("label"))
    return scratch.written(found.union(least.select(F.col("label").alias("node"), F.col("least").alias("label"))), "labels")


def contracted(edges: DataFrame, labels: DataFrame, left: str, right: str) -> DataFrame:
    """``edges`` between components: both ends replaced by their labels (``node``, ``label``), without loops and repeats."""
    for end in (left, right):
        found = labels.select(F.col("node").alias(end), F.col("label").alias("_label"))
        edges = edges.join(found, end, "left").withColumn(end, F.coalesce("_label", end)).drop("_label")
    return edges.select(left, right).filter(F.col(left) != F.col(right)).distinct()


def followed(labels: DataFrame, more: DataFrame) -> DataFrame:
    """Labels after a second step: ``more`` labels the labels."""
    on = more.select(F.col("node").alias("label"), F.col("label").alias("next"))
    moved = labels.join(on, "label", "left").select("node", F.coalesce("next", "label").alias("label"))
    return moved.union(more.join(labels.select("node"), "node", "left_anti"))
