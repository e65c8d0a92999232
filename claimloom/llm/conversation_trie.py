"""The prefix trie of conversations, and sums over its subtrees by centroid decomposition.

Building: turns are numbered within their conversation by ranks over sorted slices, so that a conversation of any length is
spread over tasks. A prefix is named by chained SHA-256 digests of its turns: chains run within blocks of ``WIDTH`` turns,
the blocks' last names are chained in the same way one level up, and so on, so no task sees more than ``WIDTH`` turns
of a conversation at once. Rows with one name are one node; its smallest conversation and its depth tell it apart from all others.

Sums: every node's mass, the number of (conversation, turn) rows in its subtree, comes out of the grouping
that makes the nodes. Nodes form components, at first the whole trie. In each round, in every component of more than ``PART``
nodes at once:

1. the nodes with at least half of the mass of the component's top form the path from the top to the deepest of them, the
   centroid (masses are positive, so two branches cannot both have half);
2. the centroid's total is the sum over its subtree in the component, and it is added to all other nodes on the path, which
   give up the centroid's mass; what the centroid itself has been given so far plus its total is its result;
3. the centroid goes; its children become tops of components of their own (a node belongs to the child that its smallest
   conversation passes through), the rest keeps the old top. Each of them has at most half of the mass.

So there are at most log2(rows / ``PART``) rounds, also if the trie is one long chain. Components of up to ``PART`` nodes are
decomposed in the same way within a task, many of them at once in arrays. Sums and counts are combined before
every shuffle; components and centroids are joined without a hint, so Spark broadcasts them by their measured size only and
splits large components otherwise.

Turns without a conversation id take no part; a null role or text is empty; a null turn comes first; rows with the same turn are
ordered by the SHA-256 of role and text, equal rows all count. Other columns are ignored. An empty table has no nodes.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from claimloom.llm import shared
from claimloom.operators import ranking
from claimloom.sources import scratch

#: Turns that are chained within a task.
WIDTH = 1024
#: Nodes of a component that is decomposed within a task.
PART = 4096
#: Nodes that a task decomposes at once.
_TOGETHER = 1 << 16
ROOT = b""


def numbered(turns: DataFrame) -> DataFrame:
    """conv_id, place (from 1), digest and n_chars of every turn that has a conversation, written once."""
    text = lambda name: F.coalesce(F.col(name).cast("string"), F.lit(""))
    told = F.concat(F.octet_length(text("role")).cast("string"), F.lit(":"), text("role"), text("text"))
    rows = turns.filter(F.col("conv_id").isNotNull()).select(
        "conv_id", "turn", F.sha2(told, 256).alias("digest"), F.char_length(text("text")).cast("long").alias("n_chars"), F.monotonically_increasing_id().alias("row")
    )
    rows = ranking.with_row_number(rows, "place", ["conv_id"], [F.col("turn").asc_nulls_first(), F.col("digest"), F.col("row")])
    return scratch.written(rows.select("conv_id", "place", F.unhex("digest").alias("digest"), "n_chars"), "turns")


def plain(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Every conversation as it is: (conv_id, length) and (conv_id, place, digest, n_chars, length)."""
    rows = numbered(turns)
    convs = scratch.written(rows.groupBy("conv_id").agg(F.count("*").alias("length")), "conversations")
    return convs, rows.join(convs, "conv_id")


def with_shared_heads(turns: DataFrame, family: int = 100, longest: int = 5) -> tuple[DataFrame, DataFrame]:
    """Conversations that take their first h turns from the first one of their family (as many as it has), and from their own
    all but the first h; h is the CRC-32 of the decimal id modulo ``longest`` + 1. The same frames as ``plain``."""
    rows = numbered(turns)
    convs = rows.groupBy("conv_id").agg(F.count("*").alias("n_own"))
    convs = convs.withColumn("head", F.crc32(F.col("conv_id").cast("string").cast("binary")) % (longest + 1))
    convs = scratch.written(convs.withColumn("base", F.col("conv_id") - F.col("conv_id") % family), "counts")
    bases = convs.select(F.col("conv_id").alias("base"), F.col("n_own").alias("n_base"))
    taken = F.least("head", F.coalesce("n_base", F.lit(0)))
    convs = convs.join(bases, "base", "left").withColumn("taken", taken)
    convs = scratch.written(convs.withColumn("length", F.col("taken") + F.greatest(F.lit(0), F.col("n_own") - F.col("head"))), "conversations")
    first = rows.filter(F.col("place") <= longest).withColumnRenamed("conv_id", "base")
    given = convs.filter("taken > 0").select("conv_id", "base", "taken", "length").join(first, "base").filter("place <= taken")
    own = rows.join(convs, "conv_id").filter("place > head").withColumn("place", F.col("place") - F.col("head") + F.col("taken"))
    columns = ["conv_id", "place", "digest", "n_chars", "length"]
    return convs.select("conv_id", "length"), given.select(columns).union(own.select(columns))


def _chained(batches):
    """For rows sorted by conversation, block and place: the chained digest of the block up to this row, and the one before."""
    last, name = None, ROOT
    for batch in batches:
        names, befores = [], []
        of = zip(batch.column("conv_id").to_pylist(), batch.column("block").to_pylist(), batch.column("digest").to_pylist(), strict=True)
        for conv, block, digest in of:
            if (conv, block) != last:
                last, name = (conv, block), ROOT
            befores.append(name)
            name = hashlib.sha256(name + digest).digest()
            names.append(name)
        yield pa.record_batch([*batch.columns, pa.array(names, pa.binary()), pa.array(befores, pa.binary())], names=[*batch.schema.names, "name", "parent"])


def _after(prefix: Column, chain: Column) -> Column:
    """Name of a prefix that ends within a block: the blocks before it, then the chain; the first block's is the chain alone."""
    return F.when(prefix.isNull(), chain).when(F.length(chain) == 0, prefix).otherwise(F.unhex(F.sha2(F.concat(prefix, chain), 256)))


def named(rows: DataFrame) -> DataFrame:
    """``rows`` (conv_id, place, digest, ...) with the name of the prefix that ends there and of the one before, written once."""
    block = F.floor((F.col("place") - 1) / WIDTH)
    rows = rows.withColumn("block", block)
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields)
    rows = rows.repartition("conv_id", "block").sortWithinPartitions("conv_id", "block", "place")
    rows = scratch.written(rows.mapInArrow(shared.frugal(_chained), f"{kinds}, name binary, parent binary"), "chains")
    ends = rows.filter(F.col("place") % WIDTH == 0)
    if not ends.limit(1).count():
        return rows.drop("block", "digest")
    higher = named(ends.select("conv_id", (F.col("block") + 1).alias("place"), F.col("name").alias("digest"), F.col("name").alias("chain")))
    # Of block b: what stands before its rows, and the name of the last prefix before it.
    before = higher.select(
        "conv_id", F.col("place").alias("block"), F.col("name").alias("prefix"), _after(F.when(F.col("place") > 1, F.col("parent")), F.col("chain")).alias("last")
    )
    rows = rows.join(before, ["conv_id", "block"], "left")
    parent = F.when(F.col("prefix").isNotNull() & (F.length("parent") == 0), F.col("last")).otherwise(_after(F.col("prefix"), F.col("parent")))
    rows = rows.withColumn("parent", parent).withColumn("name", _after(F.col("prefix"), F.col("name")))
    return scratch.written(rows.drop("block", "digest", "prefix", "last"), "names")


def nodes(convs: DataFrame, paths: DataFrame) -> DataFrame:
    """name, parent, conv_id, depth, n_convs, mass, saved, parent_conv_id, n_children of every node, written once."""
    found = paths.groupBy("name").agg(
        F.min("parent").alias("parent"),
        F.min("conv_id").alias("conv_id"),
        F.min("place").alias("depth"),
        F.count("*").alias("n_convs"),
        F.sum(F.col("length") - F.col("place") + 1).alias("mass"),
        F.min("n_chars").alias("n_chars"),
    )
    root = convs.agg(F.min("conv_id").alias("conv_id"), F.count("*").alias("n_convs"), F.sum(F.col("length") + 1).alias("mass")).filter("n_convs > 0")
    root = root.select(F.lit(ROOT).alias("name"), F.lit(None).cast("binary").alias("parent"), "conv_id", F.lit(0).cast("long").alias("depth"), "n_convs", "mass", F.lit(0).cast("long").alias("n_chars"))
    found = found.union(root).withColumn("saved", (F.col("n_convs") - 1) * F.col("n_chars")).drop("n_chars")
    found = scratch.written(found, "nodes")
    children = found.filter("parent IS NOT NULL").groupBy(F.col("parent").alias("name")).agg(F.count("*").alias("n_children"))
    above = found.select(F.col("name").alias("parent"), F.col("conv_id").alias("parent_conv_id"))
    found = found.join(children, "name", "left").withColumn("n_children", F.coalesce("n_children", F.lit(0)))
    return scratch.written(found.join(above, "parent", "left"), "nodes")


def _decomposed(up: np.ndarray, depth: np.ndarray, mass: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Sums of ``values`` over the subtrees of a forest; ``up``: place of the parent, -1 for a top."""
    sums, given = np.zeros_like(values), np.zeros_like(values)
    mass, at = mass.copy(), np.arange(len(up))  # the nodes that are left

    def tops(up: np.ndarray) -> np.ndarray:
        top = np.where(up < 0, np.arange(len(up)), up)
        while (further := top[top] != top).any():
            top = np.where(further, top[top], top)
        return top

    while len(at):
        top = tops(up)
        path = np.flatnonzero(2 * mass[at] >= mass[at][top])
        path = path[np.lexsort((depth[at[path]], top[path]))]
        last = np.append(top[path][1:] != top[path][:-1], True)
        centroid = np.zeros(len(at), np.int64)
        centroid[top[path]] = np.repeat(path[last], np.diff(np.append(-1, np.flatnonzero(last))))
        centre = path[last]
        apart = up.copy()
        apart[centre] = -1
        below = tops(apart)
        total = np.zeros((len(at), values.shape[1]), values.dtype)
        np.add.at(total, below, values[at])
        sums[at[centre]] = given[at[centre]] + total[centre]
        path = path[~last]
        given[at[path]] += total[centroid[top[path]]]
        mass[at[path]] -= mass[at[centroid[top[path]]]]
        # Without the centroids; their children become tops.
        kept = np.ones(len(at), bool)
        kept[centre] = False
        place = np.cumsum(kept) - 1
        orphan = (up < 0) | ~kept[up]
        up = np.where(orphan, -1, place[up])[kept]
        at = at[kept]
    return sums


def _finished(batches):
    """Results of whole components, which come sorted."""

    def done(rows: pa.Table) -> pa.RecordBatch:
        names = rows.column("name").to_pylist()
        places = {name: k for k, name in enumerate(names)}
        comp, parent = rows.column("comp").to_pylist(), rows.column("parent").to_pylist()
        up = np.array([-1 if name == c else places[p] for name, c, p in zip(names, comp, parent, strict=True)], np.int64)
        number = lambda name: rows.column(name).to_numpy().astype(np.int64)
        sums = _decomposed(up, number("depth"), number("mass"), np.stack([number("leaves"), number("saved")], 1))
        columns = [sums[:, 0] + number("more_leaves"), sums[:, 1] + number("more_saved")]
        return pa.record_batch([pa.array(names, pa.binary()), *map(pa.array, columns)], names=["name", "n_leaves", "saved_tokens"])

    waiting: list[pa.RecordBatch] = []
    for batch in batches:
        waiting.append(batch)
        if sum(len(b) for b in waiting) >= _TOGETHER:
            rows = pa.Table.from_batches(waiting).combine_chunks()
            comp = rows.column("comp").to_pylist()
            cut = len(comp) - 1
            while cut and comp[cut - 1] == comp[-1]:
                cut -= 1
            if cut:
                yield done(rows.slice(0, cut))
            waiting = rows.slice(cut).to_batches()
    if waiting and sum(len(b) for b in waiting):
        yield done(pa.Table.from_batches(waiting).combine_chunks())


_FIELDS = ["name", "parent", "conv_id", "depth", "mass", "leaves", "saved", "more_leaves", "more_saved", "comp"]


def rollup(found: DataFrame, paths: DataFrame) -> DataFrame:
    """name, n_leaves and saved_tokens (sums over the subtree) of the ``found`` nodes; ``paths`` has their conversations."""
    zero = F.lit(0).cast("long")
    leaves = (F.col("n_children") == 0).cast("long")
    rows = found.select("name", "parent", "conv_id", "depth", "mass", leaves.alias("leaves"), "saved", zero.alias("more_leaves"), zero.alias("more_saved"), F.lit(ROOT).alias("comp"))
    rows = scratch.written(rows, "components")
    results, small = [], []
    while True:
        sizes = scratch.written(rows.groupBy("comp").agg(F.count("*").alias("n"), F.max("mass").alias("whole")), "sizes")
        small.append(rows.join(sizes.filter(F.col("n") <= PART).select("comp"), "comp", "left_semi").select(_FIELDS))
        large = sizes.filter(F.col("n") > PART).select("comp", "whole")
        if not large.limit(1).count():
            break
        rows = rows.join(large, "comp").withColumn("on_path", 2 * F.col("mass") >= F.col("whole"))
        centre = rows.filter("on_path").groupBy("comp").agg(F.max(F.struct("depth", "name", "mass")).alias("c"))
        centre = scratch.written(centre.select("comp", F.col("c.depth").alias("c_depth"), F.col("c.name").alias("c_name"), F.col("c.mass").alias("c_mass")), "centroids")
        children = paths.select("conv_id", F.col("name").alias("child"), F.col("parent").alias("c_name")).join(centre.select("comp", "c_name"), "c_name")
        cut = rows.join(centre, "comp").join(children.drop("c_name"), ["comp", "conv_id"], "left")
        cut = cut.withColumn("child", F.when(F.col("depth") > F.col("c_depth"), F.col("child"))).withColumn("is_centre", F.col("name") == F.col("c_name"))
        cut = scratch.written(cut.select(*_FIELDS, "on_path", "is_centre", "child", "c_mass"), "cut")
        totals = cut.filter("is_centre OR child IS NOT NULL").groupBy("comp").agg(F.sum("leaves").alias("t_leaves"), F.sum("saved").alias("t_saved"))
        cut = cut.join(totals, "comp")
        gain = lambda name: F.when(F.col("on_path"), F.col(f"t_{name}")).otherwise(0) + F.col(f"more_{name}")
        cut = cut.withColumns({"more_leaves": gain("leaves"), "more_saved": gain("saved")})
        cut = cut.withColumn("mass", F.col("mass") - F.when(F.col("on_path") & ~F.col("is_centre"), F.col("c_mass")).otherwise(0))
        cut = scratch.written(cut.withColumn("comp", F.coalesce("child", "comp")).select(*_FIELDS, "is_centre"), "components")
        results.append(cut.filter("is_centre").select("name", F.col("more_leaves").alias("n_leaves"), F.col("more_saved").alias("saved_tokens")))
        rows = cut.filter("NOT is_centre").drop("is_centre")
    rest = small[0]
    for more in small[1:]:
        rest = rest.union(more)
    rest = rest.repartition("comp").sortWithinPartitions("comp")
    out = rest.mapInArrow(shared.frugal(_finished), "name binary, n_leaves long, saved_tokens long")
    for more in results:
        out = out.union(more)
    return out


def _joined(batches):
    """Ids of sorted rows (name, conv_id), those of one name in a batch joined by commas."""
    for batch in batches:
        names, ids = batch.column("name").to_pylist(), batch.column("conv_id").to_pylist()
        heads = [k for k in range(len(names)) if not k or names[k] != names[k - 1]]
        runs = list(zip(heads, [*heads[1:], len(names)], strict=True))
        yield pa.record_batch(
            [
                pa.array([names[a] for a, _ in runs], pa.binary()),
                batch.column("conv_id").take(pa.array([a for a, _ in runs], pa.int64())),
                pa.array([",".join(map(str, ids[a:b])) for a, b in runs], pa.string()),
            ],
            names=["name", "first", "ids"],
        )


def _hashed(batches):
    """SHA-256 of the ids of each name, from sorted rows; a name's ids pass by piece by piece."""
    name, state = None, None
    for batch in batches:
        out = []
        for this, ids in zip(batch.column("name").to_pylist(), batch.column("ids").to_pylist(), strict=True):
            if state is not None and this == name:
                state.update(b",")
            else:
                if state is not None:
                    out.append((name, state.hexdigest()))
                name, state = this, hashlib.sha256()
            state.update(ids.encode())
        yield pa.record_batch([pa.array([x for x, _ in out], pa.binary()), pa.array([x for _, x in out], pa.string())], names=["name", "ends_sha256"])
    if state is not None:
        yield pa.record_batch([pa.array([name], pa.binary()), pa.array([state.hexdigest()])], names=["name", "ends_sha256"])


def ends(convs: DataFrame, paths: DataFrame) -> DataFrame:
    """name, ends_sha256 of the nodes at which a conversation ends: of the decimal ids of those that end there, ascending,
    with commas between. Ids are joined where they are sorted, so a node with very many ends is few rows when it is hashed."""
    last = paths.filter(F.col("place") == F.col("length")).select("name", "conv_id")
    last = last.union(convs.filter("length = 0").select(F.lit(ROOT).alias("name"), "conv_id"))
    kind = last.schema["conv_id"].dataType.simpleString()
    joined = last.repartitionByRange("name", "conv_id").sortWithinPartitions("name", "conv_id").mapInArrow(_joined, f"name binary, first {kind}, ids string")
    return joined.repartition("name").sortWithinPartitions("name", "first").mapInArrow(_hashed, "name binary, ends_sha256 string")


def trie(convs: DataFrame, rows: DataFrame) -> DataFrame:
    """All nodes of the conversations (see ``plain``): conv_id (smallest member), depth, parent_conv_id, n_convs, n_children,
    n_leaves, saved_tokens, ends_sha256."""
    paths = named(rows)
    found = nodes(convs, paths)
    out = found.join(rollup(found, paths), "name").join(ends(convs, paths), "name", "left")
    nothing = hashlib.sha256(b"").hexdigest()
    return out.select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", F.coalesce("ends_sha256", F.lit(nothing)).alias("ends_sha256"))
