"""Exact top-k inner products by norm-bucketed retrieval.

Vectors are sorted by length and cut into buckets. Each query gets a lower bound of its k-th best product from
the longest vectors; bound / (query length x longest vector of the bucket) is the cosine that a vector of the bucket
must reach. Above 1 the bucket is skipped. At a high local cosine the bucket is pruned by coordinates (the largest
coordinates of the query bound those of any vector that close), else by length; what remains is multiplied exactly,
in 64-bit integers. Blocks of queries meet only the buckets that some query of the block can still use.

Rows with a null vector or id, or with null or non-finite components take no part, nor do pairs of different dimension. Candidates are
all rows but those with the query's id; every query row is answered, equal ones too. Ties go to the smaller id. Products must fit 64 bits.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from claimloom.sources import scratch

BUCKET = 1024
QUERIES = 128
COORDINATES = 3
HIGH = 0.6
_TOLERANCE = 1e-9
_PACKED = "part long, dim int, longest double, n long, ids binary, cells binary"


def _integers(scale: int):
    def run(batches):
        for batch in batches:
            ids, rows, out = batch.column("vec_id").to_pylist(), batch.column("embedding"), []
            values = rows.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
            sizes = np.array([0 if x is None else x for x in pa.compute.list_value_length(rows).to_pylist()], np.int64)
            ends = np.cumsum(sizes)
            for k, n in enumerate(sizes.tolist()):
                x = values[ends[k] - n : ends[k]]
                if rows[k].is_valid and ids[k] is not None and np.isfinite(x).all():
                    cells = np.floor(scale * x).astype(np.int64)
                    out.append((ids[k], n, float(np.sqrt((cells.astype(np.float64) ** 2).sum())), cells.tobytes()))
            kinds = (pa.int64(), pa.int32(), pa.float64(), pa.binary())
            yield pa.record_batch(
                [pa.array([x[i] for x in out], kind) for i, kind in enumerate(kinds)], names=["vec_id", "dim", "length", "cells"]
            )

    return run


def _blocks(size: int):
    """Sorted rows in blocks of one dimension."""
    from pyspark import TaskContext

    def run(batches):
        made, rows = TaskContext.get().partitionId() << 33, []

        def block():
            ids = np.array([r[0] for r in rows], np.int64)
            return pa.record_batch(
                [
                    pa.array([made], pa.int64()),
                    pa.array([rows[0][1]], pa.int32()),
                    pa.array([max(r[2] for r in rows)], pa.float64()),
                    pa.array([len(rows)], pa.int64()),
                    pa.array([ids.tobytes()], pa.binary()),
                    pa.array([b"".join(r[3] for r in rows)], pa.binary()),
                ],
                names=["part", "dim", "longest", "n", "ids", "cells"],
            )

        for batch in batches:
            for row in zip(*(batch.column(k).to_pylist() for k in range(4)), strict=True):
                if rows and (len(rows) == size or rows[0][1] != row[1]):
                    yield block()
                    made, rows = made + 1, []
                rows.append(row)
        if rows:
            yield block()

    return run


def _matrix(cells: bytes, dim: int, n: int) -> np.ndarray:
    return np.frombuffer(cells, np.int64).reshape(n, dim)


def _best(ids: np.ndarray, scores: np.ndarray, k: int) -> np.ndarray:
    return np.lexsort((ids, -scores))[:k]


def _bounds(k: int):
    """Per block of queries a lower bound of each query's k-th best product, from one bucket of long vectors."""

    def run(batches):
        for batch in batches:
            for row in batch.to_pylist():
                queries = _matrix(row["q_cells"], row["dim"], row["q_n"])
                vectors, ids = _matrix(row["cells"], row["dim"], row["n"]), np.frombuffer(row["ids"], np.int64)
                own, bounds = np.frombuffer(row["q_ids"], np.int64), []
                for q, name in zip(queries, own, strict=True):
                    scores = (vectors @ q)[ids != name]
                    bounds.append(float(np.partition(scores, -k)[-k]) if len(scores) >= k else -np.inf)
                yield pa.record_batch([pa.array([row["q_part"]], pa.int64()), pa.array([bounds], pa.list_(pa.float64()))], names=["q_part", "bounds"])

    return run


def _search(k: int):
    def run(batches):
        for batch in batches:
            out: list[tuple[int, int, int, int]] = []
            for row in batch.to_pylist():
                queries, own = _matrix(row["q_cells"], row["dim"], row["q_n"]), np.frombuffer(row["q_ids"], np.int64)
                vectors, ids = _matrix(row["cells"], row["dim"], row["n"]), np.frombuffer(row["ids"], np.int64)
                lengths = np.sqrt((vectors.astype(np.float64) ** 2).sum(axis=1))
                unit = vectors / np.maximum(lengths, 1e-300)[:, None]
                for at, (q, name, bound) in enumerate(zip(queries, own, row["bounds"], strict=True)):
                    size = float(np.sqrt((q.astype(np.float64) ** 2).sum()))
                    reach = size * row["longest"]
                    if reach * (1 + _TOLERANCE) < bound:
                        continue
                    local = bound / reach if reach > 0 else -np.inf
                    if local >= HIGH:
                        direction, free = q / size, np.sqrt(max(0.0, 1 - local * local))
                        near = np.ones(len(ids), bool)
                        for c in np.argsort(-np.abs(q))[:COORDINATES]:
                            x = direction[c]
                            spread = free * np.sqrt(max(0.0, 1 - x * x)) + _TOLERANCE
                            # With a larger cosine the stretch only shrinks where the query's own value allows it.
                            top = 1.0 if x >= local else x * local + spread
                            low = -1.0 if -x >= local else x * local - spread
                            near &= (unit[:, c] <= top) & (unit[:, c] >= low)
                    elif bound > 0:
                        near = lengths * size * (1 + _TOLERANCE) >= bound
                    else:
                        near = np.ones(len(ids), bool)
                    near &= ids != name
                    some = np.flatnonzero(near)
                    scores = vectors[some] @ q
                    for i in _best(ids[some], scores, k):
                        out.append((row["q_part"], at, int(name), int(ids[some][i]), int(scores[i])))
            yield pa.record_batch(
                [pa.array([x[i] for x in out], pa.int64()) for i in range(5)], names=["q_part", "q_at", "query_id", "vec_id", "score"]
            )

    return run


def top(vectors: DataFrame, is_query, k: int = 5, scale: int = 256) -> DataFrame:
    """For every row of ``vectors`` (vec_id, embedding; other columns are ignored) that ``is_query`` picks its ``k`` best other
    rows: query_id, rank, vec_id, score. Components become floor(scale * x)."""
    spark = vectors.sparkSession
    rows = vectors.select("vec_id", F.col("embedding").cast("array<double>").alias("embedding"))
    rows = scratch.written(rows.mapInArrow(_integers(scale), "vec_id long, dim int, length double, cells binary"), "vectors")
    order = [F.col("dim"), F.col("length").desc(), F.col("vec_id")]
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))

    def blocks(df: DataFrame, size: int) -> DataFrame:
        # No more partitions than full blocks, else every partition ends in a small one.
        full = max(1, df.count() // size)
        placed = df.repartitionByRange(parts, *order).sortWithinPartitions(*order).coalesce(full)
        return placed.mapInArrow(_blocks(size), _PACKED)

    buckets = scratch.written(blocks(rows, BUCKET), "buckets")
    asked = blocks(rows.filter(is_query), QUERIES)
    asked = scratch.written(
        asked.select(F.col("part").alias("q_part"), "dim", F.col("longest").alias("q_longest"), F.col("n").alias("q_n"), F.col("ids").alias("q_ids"), F.col("cells").alias("q_cells")),
        "queries",
    )
    # One bucket of long vectors per dimension gives the first bounds.
    first = buckets.groupBy("dim").agg(F.max(F.struct(F.least("n", F.lit(k + 1)), "longest", "part")).alias("m")).select("dim", F.col("m.part").alias("part"))
    first = buckets.join(first, ["dim", "part"], "left_semi")
    bounds = asked.join(first, "dim").mapInArrow(_bounds(k), "q_part long, bounds array<double>")
    asked = scratch.written(asked.join(bounds, "q_part"), "bounded")
    # Every pair of a query block and a bucket of its dimension that may still hold a result.
    pairs = asked.select("q_part", "dim", "q_longest", F.array_min("bounds").alias("least")).join(buckets.select("dim", "part", "longest"), "dim")
    pairs = pairs.filter(F.col("q_longest") * F.col("longest") * (1 + _TOLERANCE) >= F.col("least")).select("q_part", "part")
    work = pairs.join(buckets, "part").join(asked.drop("dim"), "q_part")
    found = work.mapInArrow(_search(k), "q_part long, q_at long, query_id long, vec_id long, score long")
    place = Window.partitionBy("q_part", "q_at").orderBy(F.col("score").desc(), "vec_id")
    found = found.withColumn("rank", F.row_number().over(place)).filter(F.col("rank") <= k)
    return found.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
