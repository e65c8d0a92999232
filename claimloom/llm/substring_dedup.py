"""Removal of long word sequences that occur more than once, found by recompression.

Every text is rewritten in rounds. The first round replaces each run of one word by a symbol; each
further round splits the symbols by a hash bit into left and right ones and replaces every left-right
pair by a new symbol. A symbol's name is a hash of what it stands for, so equal runs and pairs get the
same name in every task and a round needs no exchange. Inside two equal passages the rounds do the same
thing except near the ends, so both hold the same symbols. Each symbol carries the stretch of words that
its making looked at; where that lies within a window, the symbol depends on the window alone. The
smallest such name, longer symbols first, represents the window: windows with equal words have equal
representatives. A window that is too uniform to have one (inside a long run) represents itself.

Consecutive windows with one representative make a pack, named by a hash of all their words. Spark counts
representatives and packs over all distinct texts:

* a window whose representative is unique is unique;
* all windows of a pack that occurs more than once are repeated;
* what is left, packs that share the representative but not all of their windows with others, is verified
  window by window. A window is told by a hash of its words and one of its representative, 128 bits in all.

Texts that occur more than once are found by their digest and take part once. Names are combined per
text and by partial aggregation before they are shuffled; the joins that bring counts back are plain
equi-joins, whose hot keys adaptive execution splits. Only texts with shared packs are moved.

Nulls count as empty texts. Equal rows each get a result row. Texts shorter than a window keep all words.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from claimloom.llm import shared
from claimloom.sources import scratch

ROUNDS = 5
#: Symbols of fewer words represent a window only where it has no other.
LONG = 4
_NONE = np.uint64(0)


def parse(names: np.ndarray, limits: np.ndarray, rounds: int = ROUNDS) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Symbols of all texts after the last round: name, first word, and the stretch of words (first, end)
    that decided on the symbol. ``limits``: words before each text and after the last one."""
    n = len(names)
    fresh = np.ones(n, bool)
    fresh[1:] = names[1:] != names[:-1]
    fresh[limits[limits < n]] = True
    first = np.flatnonzero(fresh)
    size = np.diff(np.append(first, n))
    name = names[first].copy()
    runs = size > 1
    name[runs] = shared.mix(name[runs] * np.uint64(3) + size[runs].astype(np.uint64))
    low, high = first - 1, first + size + 1
    for k in range(rounds):
        if len(name) < 2:
            break
        left = (shared.mix(name + np.uint64(k + 1)) >> np.uint64(63)).astype(bool)
        whole = np.zeros(len(name), bool)
        whole[np.searchsorted(first, limits[limits < n])] = True  # first symbols of texts
        pair = np.zeros(len(name), bool)
        pair[:-1] = left[:-1] & ~left[1:] & ~whole[1:]
        second = np.zeros(len(name), bool)
        second[1:] = pair[:-1]
        new_low, new_high = low.copy(), high.copy()
        alone = ~pair & ~second
        new_low[1:] = np.where((alone & ~left)[1:], low[:-1], low[1:])
        new_high[:-1] = np.where((alone & left)[:-1], high[1:], high[:-1])
        if alone[0] and not left[0]:
            new_low[0] = -1
        if alone[-1] and left[-1]:
            new_high[-1] = n + 1
        at = np.flatnonzero(pair)
        name = name.copy()
        name[at] = shared.mix(shared.mix(name[at] + np.uint64(0x51)) * np.uint64(5) + name[at + 1])
        new_high[at] = high[at + 1]
        keep = ~second
        name, first, low, high = name[keep], first[keep], new_low[keep], new_high[keep]
    return name, first, low, high


def representatives(names: np.ndarray, limits: np.ndarray, width: int, rounds: int = ROUNDS):
    """For each window its representative (0: none), the window's first word and its text; and the
    names and texts of all symbols."""
    name, first, low, high = parse(names, limits, rounds)
    n = len(names)
    short = np.diff(np.append(first, n)) < LONG
    name = (name >> np.uint64(1)) | (short.astype(np.uint64) << np.uint64(63))
    texts = np.repeat(np.arange(len(limits) - 1), np.maximum(np.diff(limits) - width + 1, 0))
    starts = np.arange(len(texts)) - np.repeat(
        np.cumsum(np.append(0, np.maximum(np.diff(limits) - width + 1, 0)))[:-1] - limits[:-1],
        np.maximum(np.diff(limits) - width + 1, 0),
    )
    below = np.cumsum(np.bincount(np.clip(low + 1, 0, n + 1), minlength=n + 2))  # symbols with low < i
    upto = np.cumsum(np.bincount(np.clip(high, 0, n + 1), minlength=n + 2))  # symbols with high <= i
    lo, hi = below[starts], upto[starts + width]
    out = np.zeros(len(starts), np.uint64)
    level, size, spread = name, 1, hi - lo
    while len(level) and size <= max(1, int(spread.max(initial=0))):
        pick = np.flatnonzero((spread >= size) & (spread < 2 * size))
        out[pick] = np.minimum(level[lo[pick]], level[hi[pick] - size])
        if len(level) <= size:
            break
        level, size = np.minimum(level[:-size], level[size:]), size * 2
    return out, starts, texts, name, np.searchsorted(limits, first, "right") - 1


def _named(column: pa.Array):
    data, places = shared.raw(column)
    starts, ends, limits = shared.words(data, places, shared.blank_bytes())
    return shared.names(data, starts, ends), limits


def _packs(names: np.ndarray, limits: np.ndarray, width: int):
    """The packs of all texts: first window (place in the list of windows), windows, representative, name,
    text; the hash and first word of every window; names and texts of all symbols."""
    reps, starts, texts, all_names, all_texts = representatives(names, limits, width)
    hashes = shared.rolled(names, width)[starts] if len(starts) else np.zeros(0, np.uint64)
    alone = reps == _NONE
    reps[alone] = shared.mix(hashes[alone] + np.uint64(77))
    turn = np.ones(len(reps), bool)
    turn[1:] = (reps[1:] != reps[:-1]) | (texts[1:] != texts[:-1]) | alone[1:] | alone[:-1]
    first = np.flatnonzero(turn)
    size = np.diff(np.append(first, len(reps)))
    if len(first):
        inside = (np.arange(len(reps)) - np.repeat(first, size)).astype(np.uint64)
        name = shared.mix(np.add.reduceat(shared.mix(hashes + inside * np.uint64(0x9E3779B97F4A7C15)), first) + size.astype(np.uint64))
    else:
        name = np.zeros(0, np.uint64)
    return first, size, reps[first], name, texts[first], hashes, starts, all_names, all_texts


def _symbols(width: int):
    """Per text: words, digest of the words joined by one space, the representatives of its windows (twice
    if the symbol occurs more than once in the text), and its distinct packs."""

    def run(batches):
        for batch in batches:
            for part in shared.pieces(batch, "text"):
                names, limits = _named(part.column("text"))
                _, _, reps, packs, texts, _, _, all_names, all_texts = _packs(names, limits, width)
                n, salt = part.num_rows, shared.mix(np.arange(1, part.num_rows + 1, dtype=np.uint64))
                known, counts = np.unique(shared.mix(all_names ^ salt[all_texts]), return_counts=True)
                keys, one, own = np.unique(shared.mix(reps ^ salt[texts]), return_index=True, return_counts=True)
                at = np.minimum(np.searchsorted(known, keys), max(len(known) - 1, 0))
                times = np.where(known[at] == keys, counts[at], 1) if len(known) else np.ones(len(keys), np.int64)
                times = np.minimum(np.maximum(times, own), 2)
                order = np.argsort(texts[one], kind="stable")
                symbols, owner = np.repeat(reps[one][order], times[order]), np.repeat(texts[one][order], times[order])
                _, one, own = np.unique(shared.mix(packs ^ salt[texts]), return_index=True, return_counts=True)
                order = np.argsort(texts[one], kind="stable")
                one, own = one[order], np.minimum(own[order], 2)
                each = np.bincount(texts[one], minlength=n)
                joined = [hashlib.sha256(b" ".join(t.split())).hexdigest() for t in part.column("text").cast(pa.binary()).to_pylist()]
                yield pa.record_batch(
                    [
                        part.column("doc_id"),
                        part.column("digest"),
                        pa.array(np.diff(limits)),
                        pa.array(joined, pa.string()),
                        shared.lists(symbols, np.bincount(owner, minlength=n)),
                        shared.lists(reps[one], each),
                        shared.lists(packs[one], each),
                        shared.lists(own.astype(np.uint64), each),
                    ],
                    names=["doc_id", "digest", "n_words", "kept_sha256", "symbols", "symbol", "pack", "times"],
                )

    return shared.frugal(run)


def _windows(width: int):
    """Per text the windows of its ``half`` packs: each distinct one with its representative and the number of
    times it starts in them (2 at most)."""

    def run(batches):
        for batch in batches:
            for part in shared.pieces(batch, "text"):
                names, limits = _named(part.column("text"))
                first, size, reps, packs, texts, hashes, _, _, _ = _packs(names, limits, width)
                out = []
                for k, some in enumerate(shared.row_lists(part.column("half"))):
                    a, b = np.searchsorted(texts, [k, k + 1])
                    own = a + np.flatnonzero(np.isin(packs[a:b], some))
                    window = np.concatenate([hashes[first[i] : first[i] + size[i]] for i in own]) if len(own) else np.zeros(0, np.uint64)
                    found, at, n = np.unique(window, return_index=True, return_counts=True)
                    out.append((found, np.repeat(reps[own], size[own])[at], np.minimum(n, 2)))
                sizes = np.array([len(x[0]) for x in out])
                yield pa.record_batch(
                    [
                        part.column("number"),
                        *(shared.lists(np.concatenate([x[i] for x in out]).astype(np.uint64), sizes) for i in range(3)),
                    ],
                    names=["number", "window", "symbol", "times"],
                )

    return shared.frugal(run)


def _removed(width: int):
    """Per text: how many words the windows of its ``full`` packs and its windows in ``again`` cover, and the
    other words joined by one space."""

    def run(batches):
        for batch in batches:
            for part in shared.pieces(batch, "text"):
                names, limits = _named(part.column("text"))
                first, size, _, packs, texts, hashes, starts, _, _ = _packs(names, limits, width)
                data, places = shared.raw(part.column("text"))
                removed, kept = [], []
                lists = zip(shared.row_lists(part.column("full")), shared.row_lists(part.column("again")), strict=True)
                for k, (full, again) in enumerate(lists):
                    a, b = np.searchsorted(texts, [k, k + 1])
                    hit = np.repeat(np.isin(packs[a:b], full), size[a:b])
                    if len(hit):
                        hit |= np.isin(hashes[first[a] : first[a] + len(hit)], again)
                        hit = starts[first[a] : first[a] + len(hit)][hit] - limits[k]
                    change = np.zeros(limits[k + 1] - limits[k] + 1, np.int64)
                    np.add.at(change, hit.astype(np.int64), 1)
                    np.add.at(change, hit.astype(np.int64) + width, -1)
                    gone = np.cumsum(change)[:-1] > 0
                    text = data[places[k] : places[k + 1]].tobytes()
                    kept.append(b" ".join(w for w, g in zip(text.split(), gone.tolist(), strict=True) if not g))
                    removed.append(int(gone.sum()))
                yield pa.record_batch(
                    [part.column("digest"), pa.array(removed, pa.int64()), pa.array(kept, pa.binary()).cast(pa.string())],
                    names=["digest", "n_removed", "kept"],
                )

    return shared.frugal(run)


def _find(docs: DataFrame, width: int) -> tuple[DataFrame, DataFrame]:
    """Rows of ``docs`` (doc_id, digest, n_words, kept_sha256 if nothing goes), and one row for each text that
    loses words: digest, n_removed, kept (the words that stay, joined by one space)."""
    text = F.coalesce("text", F.lit(""))
    texts = docs.select("doc_id", F.sha2(text, 256).alias("digest"), text.alias("text"))
    kind = docs.schema["doc_id"].dataType.simpleString()
    rows = texts.mapInArrow(
        _symbols(width),
        f"doc_id {kind}, digest string, n_words long, kept_sha256 string, symbols array<long>, "
        "symbol array<long>, pack array<long>, times array<long>",
    )
    rows = scratch.written(rows.withColumn("number", F.monotonically_increasing_id()), "symbols")
    copies = rows.filter(F.col("n_words") >= width).groupBy("digest").agg(F.count("*").alias("copies"), F.min("number").alias("number"))
    copies = scratch.written(copies, "copies")
    one = rows.join(copies.select("number"), "number", "left_semi")

    often = one.select(F.explode("symbols").alias("symbol")).groupBy("symbol").count().filter("count > 1").select("symbol")
    packs = one.select("number", F.explode(F.arrays_zip("symbol", "pack", "times")).alias("p")).select("number", "p.*")
    packs = scratch.written(packs.join(often, "symbol"), "packs")
    known = packs.groupBy("symbol", "pack").agg(F.sum("times").alias("total"), F.min("number").alias("least"))
    kinds = packs.groupBy("symbol").agg((F.max("pack") != F.min("pack")).alias("mixed"))
    known = known.join(kinds, "symbol")
    # One text with the pack stands for the others when its windows are compared with those of other packs.
    half = (F.col("total") == 1) | (F.col("mixed") & (F.col("number") == F.col("least")))
    packs = packs.join(known, ["symbol", "pack"]).withColumn("is_half", half).groupBy("number")
    packs = packs.agg(
        F.collect_list(F.when(F.col("total") > 1, F.col("pack"))).alias("full"),
        F.collect_list(F.when(F.col("is_half"), F.col("pack"))).alias("half"),
    )
    needed = packs.join(copies, "number").filter("copies = 1 or size(half) > 0")
    needed = needed.join(rows.select("number", F.col("doc_id").alias("_id")), "number").select(
        F.col("digest").alias("_digest"), "_id", "copies", "number", "full", "half"
    )
    same = (F.col("digest") == F.col("_digest")) & F.col("doc_id").eqNullSafe(F.col("_id"))
    chosen = texts.join(needed, same).select("digest", "text", "copies", "number", "full", "half")
    # Equal rows (id and text) all come along. They are copies, so their windows are repeated anyway.
    chosen = scratch.written(chosen, "texts")

    windows = chosen.filter("size(half) > 0").select("number", "text", "half").mapInArrow(
        _windows(width), "number long, window array<long>, symbol array<long>, times array<long>"
    )
    windows = windows.select("number", F.explode(F.arrays_zip("window", "symbol", "times")).alias("w")).select("number", "w.*")
    windows = scratch.written(windows, "windows")
    again = windows.groupBy("window", "symbol").agg(F.sum("times").alias("times")).filter("times > 1").select("window", "symbol")
    again = windows.join(again, ["window", "symbol"]).groupBy("number").agg(F.collect_list("window").alias("again"))

    none = F.array().cast("array<long>").alias("again")
    todo = chosen.filter("copies = 1").select("number", "digest", "text", "full", "half")
    clear = todo.filter("size(half) = 0").select("digest", "text", "full", none)
    mixed = todo.filter("size(half) > 0").join(again, "number", "left").select("digest", "text", "full", F.coalesce("again", none).alias("again"))
    kinds = "digest string, n_removed long, kept string"
    part = clear.mapInArrow(_removed(width), kinds).union(mixed.mapInArrow(_removed(width), kinds)).filter("n_removed > 0")
    whole = rows.join(copies.filter("copies > 1").select("number"), "number", "left_semi")
    whole = whole.select("digest", F.col("n_words").alias("n_removed"), F.lit("").alias("kept"))
    return rows.select("doc_id", "digest", "n_words", "kept_sha256"), scratch.written(part.union(whole), "removed")


def repeats(docs: DataFrame, width: int = 35) -> DataFrame:
    """One row for each row of ``docs`` (doc_id, text; other columns are ignored): doc_id, n_words, n_removed,
    kept_sha256 of the words that stay, joined by one space."""
    rows, changed = _find(docs.select("doc_id", "text"), width)
    changed = changed.select("digest", "n_removed", F.sha2("kept", 256).alias("kept"))
    return rows.join(changed, "digest", "left").select(
        "doc_id",
        "n_words",
        F.coalesce("n_removed", F.lit(0).cast("long")).alias("n_removed"),
        F.coalesce("kept", "kept_sha256").alias("kept_sha256"),
    )


def without_repeats(docs: DataFrame, width: int = 35) -> DataFrame:
    """``docs`` with the same columns and rows; a text that loses words becomes the rest, joined by one
    space, all other texts stay as they are. A column n_chars follows the text."""
    columns = docs.columns
    _, changed = _find(docs.select("doc_id", "text"), width)
    changed = changed.select(F.col("digest").alias("_digest"), F.col("kept").alias("_kept"))
    keyed = docs.withColumn("_digest", F.sha2(F.coalesce("text", F.lit("")), 256))
    joined = keyed.join(changed, "_digest", "left").withColumn("text", F.coalesce("_kept", "text"))
    if "n_chars" in columns:
        size = F.length("_kept").cast(docs.schema["n_chars"].dataType)
        joined = joined.withColumn("n_chars", F.when(F.col("_kept").isNotNull(), size).otherwise(F.col("n_chars")))
    return joined.select(*columns)
