import hashlib
import math
import random

import pytest
from odd import ordered
from pyspark.sql import functions as F

from claimloom.llm import centroid_clustering as clustering


def brute(rows, dim, k, rounds, seed):
    """The same result in plain Python."""
    kept = [(i, [math.floor(256 * x) for x in v]) for i, v in rows if v is not None and len(v) == dim and all(x is not None and math.isfinite(x) for x in v)]
    hashed = lambda i: hashlib.sha256(f"{seed}{'' if i is None else i}".encode()).hexdigest()
    centroids = [v for _, v in sorted((hashed(i), v) for i, v in kept)[:k]]
    near = lambda v: min((sum((a - b) ** 2 for a, b in zip(v, c, strict=True)), n) for n, c in enumerate(centroids))
    for _ in range(rounds):
        groups = {}
        for _, v in kept:
            groups.setdefault(near(v)[1], []).append(v)
        centroids = [[sum(x) // len(groups[n]) for x in zip(*groups[n], strict=True)] if n in groups else c for n, c in enumerate(centroids)]
    placed = [(i, *near(v)) for i, v in kept]
    total = {}
    for _, d, n in placed:
        total[n] = total.get(n, 0) + d
    digest = lambda c: hashlib.sha256(",".join(map(str, c)).encode()).hexdigest()
    return [(i, n, d, total[n], sum(total.values()), digest(centroids[n])) for i, d, n in placed]


def found(df, dim, k, rounds, seed):
    cells = clustering.cells(df, dim=dim)
    centroids = clustering.fit(cells, k=k, rounds=rounds, seed=seed)
    return ordered(clustering.described(clustering.assigned(cells, centroids), centroids).collect())


@pytest.mark.parametrize("k", [1, 7, 300])
def test_equals_brute_force(spark, k):
    """Equal vectors and ids, ties, negative sums, one cluster with a third of all rows, rows that take no part, more centroids than vectors."""
    rnd = random.Random(k)
    rows = [(n, [rnd.gauss(0, 1) for _ in range(4)]) for n in range(100)]
    rows += [(200 + n, [0.5, -0.5, 0.0, -1 / 256]) for n in range(70)] + [rows[5]] * 3 + [(300, rows[6][1]), (5, rows[7][1])]
    rows += [(400, [1.0, 0.0, 0.0, 0.0]), (401, [-1.0, 0.0, 0.0, 0.0]), (None, [0.0] * 4), (None, [0.25] * 4)]
    odd = [(500, None), (501, []), (502, [1.0] * 3), (503, [1.0] * 5), (504, [1.0, None, 1.0, 1.0]), (505, [float("nan")] * 4), (506, [1.0, float("-inf"), 1.0, 1.0])]
    df = spark.createDataFrame(rows + odd, "vec_id long, embedding array<double>").withColumns({x: F.lit("clash") for x in ("cluster", "distance", "cells", "n", "s0")})
    assert found(df.repartition(5), 4, k, 5, "2:") == ordered(brute(rows, 4, k, 5, "2:"))


def test_no_rounds_and_floats(spark):
    rows = [(n, [n / 3, -n / 7]) for n in range(40)]
    df = spark.createDataFrame(rows, "vec_id int, embedding array<float>")
    rows = [(i, [float(x) for x in v]) for i, v in df.collect()]
    assert found(df, 2, 3, 0, "a") == ordered(brute(rows, 2, 3, 0, "a"))


def test_nothing_takes_part(spark):
    for rows in ([], [(1, None), (2, [1.0])]):
        df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
        cells = clustering.cells(df)
        assert clustering.fit(cells) == []
        out = clustering.described(clustering.assigned(cells, []), [])
        assert out.collect() == [] and out.columns == ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]


def test_numbers_beyond_the_range_raise(spark):
    with pytest.raises(Exception, match="beyond"):
        clustering.cells(spark.createDataFrame([(1, [1e30] * 64)], "vec_id long, embedding array<double>"))


def test_native(spark):
    """No Python worker in the plan."""
    df = spark.createDataFrame([(1, [1.0] * 64)], "vec_id long, embedding array<double>")
    cells = clustering.cells(df)
    plan = clustering.assigned(cells, clustering.fit(cells))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
