"""Centroid clustering of vectors (Lloyd's rounds) in integer arithmetic, by column expressions only.

Components become floor(scale * x), x as double. In every round ``zip_with`` and ``aggregate`` compute a vector's squared
distances to the centroids, which stand in the plan as one literal array; ``array_min`` over structs (distance, number)
picks the nearest, the smaller number if two are as near. One aggregation with a sum per component gives the next
centroids: floor(sum / count), exact for negative sums too. A centroid without vectors stays as it is.

Each round is one scan with sums combined before the shuffle, so a cluster that holds most of the vectors is no hot key:
a task sends one row per cluster. Only ``k`` rows of sums reach the driver, whatever the number of vectors. The
cells are written once; a lost executor repeats its part of one round.

Vectors that are null, have other than ``dim`` components, or hold a null or non-finite component take no part; the
others keep every row, equal ones too. The first centroids are the vectors with the smallest SHA-256 of the seed and
their id, equal hashes in the order of their cells; a null id hashes like the empty string. With fewer vectors than ``k``, each one is
a centroid; an empty table gives no rows. Sums and distances are 64-bit: a cell above ``LARGEST``
raises an error, and so does a sum that passes 64 bits. Other columns are ignored.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from claimloom.sources import scratch

#: Cells are at most so large, so that a squared distance over 64 of them fits 64 bits.
LARGEST = 1 << 27
Centroids = list[list[int]]


def cells(vectors: DataFrame, dim: int = 64, scale: int = 256) -> DataFrame:
    """(vec_id, cells) of the vectors that take part, written once."""
    rows = vectors.select("vec_id", F.col("embedding").cast("array<double>").alias("embedding"))
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = rows.filter((F.size("embedding") == dim) & finite)
    far = F.raise_error(F.lit(f"a component is beyond {LARGEST} cells")).cast("long")
    cell = lambda x: F.when(F.abs(x) <= LARGEST / scale, F.floor(F.lit(float(scale)) * x)).otherwise(far)
    return scratch.written(rows.select("vec_id", F.transform("embedding", cell).alias("cells")), "cells")


def first_centroids(rows: DataFrame, k: int, seed: str) -> Centroids:
    """The cells of the ``k`` rows whose hash is smallest, in its order."""
    hashed = F.sha2(F.concat(F.lit(seed), F.coalesce(F.col("vec_id").cast("string"), F.lit(""))), 256)
    found = rows.select(hashed.alias("hash"), "cells").orderBy("hash", "cells").limit(k)
    return [list(row.cells) for row in found.collect()]


def nearest(centroids: Centroids):
    """Struct (distance, cluster) of the nearest centroid of ``cells``."""
    literal = ", ".join(f"array({', '.join(f'{x}L' for x in c)})" for c in centroids)
    return F.expr(
        f"""array_min(transform(array({literal}), (centroid, number) -> named_struct(
            'distance', aggregate(zip_with(cells, centroid, (x, y) -> (x - y) * (x - y)), 0L, (sum, square) -> sum + square),
            'cluster', number)))"""
    )


def moved(rows: DataFrame, centroids: Centroids) -> Centroids:
    """The centroids after one round."""
    placed = rows.select(nearest(centroids).getField("cluster").alias("cluster"), "cells")
    sums = [F.sum(F.col("cells").getItem(at)).alias(f"s{at}") for at in range(len(centroids[0]))]
    after = [list(c) for c in centroids]
    for row in placed.groupBy("cluster").agg(F.count("*").alias("n"), *sums).collect():
        after[row.cluster] = [row[f"s{at}"] // row.n for at in range(len(sums))]
    return after


def fit(rows: DataFrame, k: int = 40, rounds: int = 5, seed: str = "2:") -> Centroids:
    """Centroids of ``cells`` after ``rounds`` rounds; none for an empty table."""
    centroids = first_centroids(rows, k, seed)
    for _ in range(rounds if centroids else 0):
        centroids = moved(rows, centroids)
    return centroids


def assigned(rows: DataFrame, centroids: Centroids) -> DataFrame:
    """vec_id, cluster and squared distance of every row of ``cells``."""
    if not centroids:
        return rows.select("vec_id", F.lit(None).cast("int").alias("cluster"), F.lit(None).cast("long").alias("distance")).limit(0)
    return rows.select("vec_id", nearest(centroids).alias("near")).select("vec_id", "near.cluster", "near.distance")


def described(placed: DataFrame, centroids: Centroids) -> DataFrame:
    """``placed`` (see ``assigned``) with cluster_inertia, inertia and centroid_sha256. The joined table has a row per centroid."""
    spark = placed.sparkSession
    placed = scratch.written(placed, "clusters")
    sums = {row.cluster: row.total for row in placed.groupBy("cluster").agg(F.sum("distance").alias("total")).collect()}
    everything = sum(sums.values())
    facts = [
        (number, sums.get(number, 0), everything, hashlib.sha256(",".join(map(str, centroid)).encode()).hexdigest())
        for number, centroid in enumerate(centroids)
    ]
    facts = spark.createDataFrame(facts, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return placed.join(F.broadcast(facts), "cluster").select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")
