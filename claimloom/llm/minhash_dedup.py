"""Near-duplicate documents by circulant MinHash.

A document's set holds its distinct five-word shingles (A-Z lower-cased; a shorter text is one shingle). Two
permutations make the whole signature: the first scatters the shingles over 32 bits, the second, shifted
by k places around the circle, gives coordinate k as the smallest place of the set. Bands of consecutive
coordinates are bucket keys. Band count and width follow from the threshold: the widest bands for which a
pair at the threshold shares none with a chance below ``MISS``.

Documents with equal sets form one class (by a 128-bit fingerprint) and take part once, so copies cost
nothing after the first step. Links between classes are found without listing pairs of a bucket:

1. every class is compared with one hub, the class among the hubs of its buckets that shares most buckets
   with others, on the full sets; the links contract the graph of buckets;
2. what is left of it, a class and the hub of a bucket in different components, is compared on the full
   sets, and its links contract the graph again;
3. components that are still connected through buckets form a cluster. The classes outside a cluster's largest
   component are compared with all others of the cluster, in blocks bounded by classes (``BLOCK``) and by
   bytes (``BLOCK_BYTES``). A block counts the shared shingles of all its pairs by products of incidence
   matrices, so no pair is left to an estimate, and returns links between different components only, at
   most one less than it has classes.

So a pair that shares a bucket is either in one component or known not to be linked.

Nulls: a null or blank text has the empty set and links with nothing; a null id is an id like any other,
and the smallest id of a component is taken over the ids that are not null. Equal rows are one class.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from claimloom.llm import shared
from claimloom.sources import scratch

SHINGLE = 5
MISS = 1e-6
COORDINATES = 128
BLOCK = 512
BLOCK_BYTES = 32 << 20
#: Shingles whose incidence is held as one matrix.
_WIDE = 4096
_CHUNK = 1 << 16


def bands_for(percent: int) -> tuple[int, int]:
    """Number and width of the bands for a threshold in percent."""
    for width in range(8, 0, -1):
        for count in range(1, COORDINATES // width + 1):
            if (1 - (percent / 100) ** width) ** count <= MISS:
                return count, width
    return COORDINATES, 1


def shingle_sets(part: pa.RecordBatch) -> list[np.ndarray]:
    """For each text its distinct shingles as sorted 64-bit names."""
    data, places = shared.raw(part.column("text"))
    starts, ends, limits = shared.words(data, places, shared.blank_bytes())
    names = shared.names(data, starts, ends, fold=True)
    fives, sets = shared.rolled(names, SHINGLE), []
    for a, b in zip(limits[:-1].tolist(), limits[1:].tolist(), strict=True):
        if b - a >= SHINGLE:
            sets.append(np.unique(fives[a : b - SHINGLE + 1]))
        else:
            sets.append(shared.mix(shared.rolled(names[a:b], b - a) + np.uint64(b - a)) if b > a else np.zeros(0, np.uint64))
    return sets


def signatures(sets: list[np.ndarray], coordinates: int) -> np.ndarray:
    """Row by row the signature of each set, none of them empty."""
    out = np.empty((len(sets), coordinates), np.uint32)
    sizes = np.array([len(s) for s in sets], np.int64)
    ends, at = np.cumsum(sizes), 0
    while at < len(sets):
        before = ends[at - 1] if at else 0
        end = max(at + 1, int(np.searchsorted(ends, before + _CHUNK, "right")))
        scattered = (shared.mix(np.concatenate(sets[at:end]) + np.uint64(11)) >> np.uint64(32)).astype(np.uint32)
        heads = np.cumsum(np.append(0, sizes[at:end]))[:-1]
        x, y = np.empty_like(scattered), np.empty_like(scattered)
        for k in range(coordinates):
            np.add(scattered, np.uint32(k), out=x)
            for shift, odd in ((16, 0x85EBCA6B), (13, 0xC2B2AE35), (16, 0)):
                np.right_shift(x, np.uint32(shift), out=y)
                np.bitwise_xor(x, y, out=x)
                if odd:
                    np.multiply(x, np.uint32(odd), out=x)
            out[at:end, k] = np.minimum.reduceat(x, heads)
        at = end
    return out


def band_keys(signature: np.ndarray, count: int, width: int) -> np.ndarray:
    keys = np.tile(np.arange(1, count + 1, dtype=np.uint64), (len(signature), 1))
    cells = signature[:, : count * width].reshape(len(signature), count, width).astype(np.uint64)
    for k in range(width):
        keys = shared.mix(keys * np.uint64(0x9E3779B97F4A7C15) + cells[:, :, k])
    return keys


def _print(found: np.ndarray) -> bytes | None:
    return hashlib.blake2b(found.tobytes(), digest_size=16).digest() if len(found) else None


def _rows(count: int, width: int):
    def run(batches):
        for batch in batches:
            for part in shared.pieces(batch, "text"):
                sets = shingle_sets(part)
                full = np.array([k for k, s in enumerate(sets) if len(s)], np.int64)
                keys = band_keys(signatures([sets[k] for k in full], count * width), count, width)
                sizes = np.zeros(len(sets), np.int64)
                sizes[full] = count
                yield pa.record_batch(
                    [
                        part.column("doc_id"),
                        part.column("digest"),
                        pa.array([len(s) for s in sets], pa.int64()),
                        pa.array([_print(s) for s in sets], pa.binary()),
                        shared.lists(keys.reshape(-1), sizes),
                    ],
                    names=["doc_id", "digest", "n_shingles", "print", "bands"],
                )

    return shared.frugal(run)


def _sets(batches):
    for batch in batches:
        for part in shared.pieces(batch, "text"):
            sets = [s for s in shingle_sets(part) if len(s)]
            yield pa.record_batch(
                [pa.array([_print(s) for s in sets], pa.binary()), pa.array([s.tobytes() for s in sets], pa.binary())],
                names=["print", "shingles"],
            )


def _similar(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    small, large = sorted((len(a), len(b)))
    if 100 * small < percent * large:
        return False
    both = len(np.intersect1d(a, b, assume_unique=True))
    return 100 * both >= percent * (len(a) + len(b) - both)


def _linked(percent: int):
    def run(batches):
        for batch in batches:
            one, two = batch.column("one").to_pylist(), batch.column("two").to_pylist()
            good = [_similar(np.frombuffer(a, np.uint64), np.frombuffer(b, np.uint64), percent) for a, b in zip(one, two, strict=True)]
            picked = batch.select(["print", "hub"]).filter(pa.array(good, pa.bool_()))
            yield from picked.to_batches() if isinstance(picked, pa.Table) else [picked]

    return shared.frugal(run)


def common(ones: list[np.ndarray], others: list[np.ndarray]) -> np.ndarray:
    """For every pair of a set of ``ones`` and one of ``others`` how many values they share."""
    out = np.zeros((len(ones), len(others)), np.int64)
    if not len(ones) or not len(others):
        return out
    both = np.intersect1d(np.concatenate(ones), np.concatenate(others))

    def placed(sets: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        value = np.concatenate(sets)
        at = np.searchsorted(both, value)
        good = np.flatnonzero(both[np.minimum(at, len(both) - 1)] == value) if len(both) else np.zeros(0, np.int64)
        good = good[np.argsort(at[good], kind="stable")]
        return at[good], np.repeat(np.arange(len(sets)), [len(s) for s in sets])[good]

    (one, one_owner), (other, other_owner) = placed(ones), placed(others)
    for first in range(0, len(both), _WIDE):
        sides = []
        for at, owner, n in ((one, one_owner, len(ones)), (other, other_owner, len(others))):
            a, b = np.searchsorted(at, [first, first + _WIDE])
            side = np.zeros((n, min(_WIDE, len(both) - first)), np.float32)
            side[owner[a:b], at[a:b] - first] = 1
            sides.append(side)
        out += (sides[0] @ sides[1].T).astype(np.int64)
    return out


def _block_links(percent: int):
    """Links between components among one block of classes outside the largest component (rows) and
    one block of the cluster (columns)."""

    def run(table: pa.Table) -> pa.Table:
        prints, labels = table.column("print").to_pylist(), table.column("label").to_pylist()
        sets = [np.frombuffer(x, np.uint64) for x in table.column("shingles").to_pylist()]
        row = np.flatnonzero(table.column("as_row").to_numpy())
        columns = np.flatnonzero(~table.column("as_row").to_numpy())
        parent: dict[bytes, bytes] = {}

        def root(x: bytes) -> bytes:
            while parent.get(x, x) != x:
                parent[x] = parent.get(parent[x], parent[x])
                x = parent[x]
            return x

        both = common([sets[a] for a in row], [sets[b] for b in columns])
        sizes = np.array([len(x) for x in sets], np.int64)
        found = []
        for i, j in np.argwhere(100 * both >= percent * (sizes[row][:, None] + sizes[columns][None, :] - both)):
            a, b = row[i], columns[j]
            x, y = root(labels[a]), root(labels[b])
            if x != y:
                parent[x] = y
                found.append((prints[a], prints[b]))
        return pa.table({"print": pa.array([x for x, _ in found], pa.binary()), "hub": pa.array([y for _, y in found], pa.binary())})

    return run


def _digest():
    return F.sha2(F.coalesce("text", F.lit("")), 256).alias("digest")


def groups(docs: DataFrame, percent: int = 80) -> DataFrame:
    """One row for each row of ``docs`` (doc_id, text; other columns are ignored): doc_id, n_shingles,
    component_id (the smallest id reachable over links of ``percent`` similarity), kept (doc_id is that id),
    digest (of the text)."""
    return _labelled(docs, percent).drop("label")


def _labelled(docs: DataFrame, percent: int) -> DataFrame:
    """``groups`` with the label of the component, which no other has even if ids repeat; null for empty texts."""
    docs = docs.select("doc_id", "text", _digest())
    count, width = bands_for(percent)
    kind = docs.schema["doc_id"].dataType.simpleString()
    rows = scratch.written(
        docs.mapInArrow(_rows(count, width), f"doc_id {kind}, digest string, n_shingles long, print binary, bands array<long>"), "prints"
    )
    classes = rows.filter("n_shingles > 0").groupBy("print")
    classes = classes.agg(F.min("doc_id").alias("first_id"), F.first("bands").alias("bands"), F.first("n_shingles").alias("size"))
    classes = scratch.written(classes, "classes")
    member = classes.select("print", F.explode("bands").alias("band"))
    busy = member.groupBy("band").agg(F.count("*").alias("size")).filter("size > 1")
    member = scratch.written(member.join(busy, "band"), "buckets")
    rank = member.groupBy("print").agg(F.sum("size").alias("rank"))
    rank = member.select("print", "band").join(rank, "print")
    hubs = rank.groupBy("band").agg(F.max(F.struct("rank", "print")).alias("hub")).select("band", "hub")
    edges = member.select("print", "band").join(hubs, "band").filter("print <> hub.print")
    edges = scratch.written(edges.select("print", "hub").distinct(), "hubs")
    nearest = edges.groupBy("print").agg(F.max("hub").alias("hub")).select("print", F.col("hub.print").alias("hub"))
    edges = edges.select("print", F.col("hub.print").alias("hub"))

    wanted = classes.join(member.select("print").distinct(), "print", "left_semi")
    ids = wanted.select(F.col("first_id").alias("wanted_id"))
    texts = docs.join(ids, F.col("doc_id").eqNullSafe(F.col("wanted_id")), "left_semi")
    full = texts.mapInArrow(shared.frugal(_sets), "print binary, shingles binary")
    full = scratch.written(full.join(wanted.select("print"), "print", "left_semi").dropDuplicates(["print"]), "sets")

    def verified(pairs: DataFrame) -> DataFrame:
        sides = pairs.join(full.select("print", F.col("shingles").alias("one")), "print")
        sides = sides.join(full.select(F.col("print").alias("hub"), F.col("shingles").alias("two")), "hub")
        return scratch.written(sides.select("print", "hub", "one", "two").mapInArrow(_linked(percent), "print binary, hub binary"), "links")

    labels = shared.components(verified(nearest), "print", "hub")
    # Of the other edges only those between components are looked at; their ends stay classes, as a link needs two sets.
    ends = edges.join(nearest, ["print", "hub"], "left_anti")
    for end, label in (("print", "one"), ("hub", "two")):
        found = labels.select(F.col("node").alias(end), F.col("label").alias(label))
        ends = ends.join(found, end, "left").withColumn(label, F.coalesce(label, end))
    ends = ends.filter("one <> two").select("print", "hub")
    links = shared.contracted(verified(ends), labels, "print", "hub")
    labels = scratch.written(shared.followed(labels, shared.components(links, "print", "hub")), "labels")

    # Clusters are made of components; every component of a cluster is one node.
    open_edges = scratch.written(shared.contracted(edges, labels, "print", "hub"), "open_edges")
    clusters = shared.components(open_edges, "print", "hub").select(F.col("node").alias("label"), F.col("label").alias("cluster"))
    placed = classes.select("print", "size").join(labels.select(F.col("node").alias("print"), "label"), "print", "left")
    placed = placed.withColumn("label", F.coalesce("label", "print")).join(clusters, "label")
    placed = scratch.written(placed.select("cluster", "print", "label", (F.col("size") * 8).alias("bytes")), "placed")
    parts = placed.groupBy("cluster", "label").agg(F.count("*").alias("n"), F.sum("bytes").alias("bytes"))
    split = parts.groupBy("cluster").agg(F.sum("n").alias("n"), F.sum("bytes").alias("bytes"), F.max(F.struct("n", "bytes", "label")).alias("most"))
    blocks = lambda n, size: F.greatest(F.ceil(n / BLOCK), F.ceil(size / BLOCK_BYTES))
    split = split.filter("n > 2").select(
        "cluster",
        F.col("most.label").alias("most"),
        blocks(F.col("n"), F.col("bytes")).alias("all_blocks"),
        blocks(F.col("n") - F.col("most.n"), F.col("bytes") - F.col("most.bytes")).alias("out_blocks"),
    )
    open_ = scratch.written(placed.join(split, "cluster"), "open")
    mine = F.pmod(F.xxhash64("print"), F.col("all_blocks"))
    outside = F.pmod(F.xxhash64("print"), F.col("out_blocks"))
    every = F.explode(F.sequence(F.lit(0).cast("long"), F.col("all_blocks") - 1))
    others = F.explode(F.sequence(F.lit(0).cast("long"), F.col("out_blocks") - 1))
    as_rows = open_.filter("label <> most").select("cluster", "print", "label", outside.alias("i"), every.alias("j"), F.lit(True).alias("as_row"))
    as_columns = open_.select("cluster", "print", "label", others.alias("i"), mine.alias("j"), F.lit(False).alias("as_row"))
    blocked = as_rows.union(as_columns).join(full, "print")
    more = blocked.groupBy("cluster", "i", "j").applyInArrow(_block_links(percent), "print binary, hub binary")
    more = shared.contracted(scratch.written(more, "links"), labels, "print", "hub")
    final = shared.followed(labels, shared.components(more, "print", "hub")).select(F.col("node").alias("print"), "label")
    known = classes.select("print", "first_id").join(final, "print", "left").withColumn("label", F.coalesce("label", "print"))
    least = known.groupBy("label").agg(F.min("first_id").alias("component_id"))
    known = known.join(least, "label").select("print", "component_id", "label")
    out = rows.select("doc_id", "digest", "n_shingles", "print").join(known, "print", "left")
    component = F.when(F.col("print").isNull(), F.col("doc_id")).otherwise(F.col("component_id"))
    return out.select(
        "doc_id",
        "n_shingles",
        component.alias("component_id"),
        F.col("doc_id").eqNullSafe(component).alias("kept"),
        "digest",
        "label",
    )


def one_of_each(docs: DataFrame, percent: int = 80) -> DataFrame:
    """``docs`` with the same columns and one row of each component: the smallest id (null comes last), then the smallest digest
    of the text; of equal rows (id and text) one stays. Empty texts are alone in their component, so they all stay, equal rows apart."""
    columns = docs.columns
    rows = _labelled(docs, percent).select("label", "doc_id", "digest")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "digest")).alias("first")
    found = rows.filter("label IS NOT NULL").groupBy("label").agg(first).select("first.doc_id", "first.digest")
    found = found.union(rows.filter("label IS NULL").select("doc_id", "digest").distinct())
    found = found.select(F.col("doc_id").alias("_kept_id"), F.col("digest").alias("_kept_digest"))
    keyed = docs.withColumn("_digest", _digest())
    same = F.col("doc_id").eqNullSafe(F.col("_kept_id")) & (F.col("_digest") == F.col("_kept_digest"))
    return keyed.join(found, same, "left_semi").dropDuplicates(["doc_id", "_digest"]).select(*columns)
