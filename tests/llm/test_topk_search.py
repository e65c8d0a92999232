import math
import random

import pytest
from odd import ordered
from pyspark.sql import functions as F

from claimloom.llm import topk_search


def brute(rows, k, every):
    good = [(i, [math.floor(256 * x) for x in v]) for i, v in rows if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for i, q in [(i, v) for i, v in good if i % every == 0]:
        scores = sorted((-sum(a * b for a, b in zip(q, v, strict=True)), j) for j, v in good if j != i and len(v) == len(q))
        out += [(i, rank + 1, j, -s) for rank, (s, j) in enumerate(scores[:k])]
    return out


@pytest.mark.parametrize("spread", [0.0, 1.5])
def test_equals_brute_force(spark, monkeypatch, spread):
    """Equal and very different lengths, many equal vectors, near ones, negative products, several small buckets."""
    monkeypatch.setattr(topk_search, "BUCKET", 32)
    monkeypatch.setattr(topk_search, "QUERIES", 4)
    rnd = random.Random(4)
    rows = []
    for k in range(400):
        v = [rnd.gauss(0, 1) for _ in range(8)]
        size = math.exp(spread * rnd.gauss(0, 1)) / math.sqrt(sum(x * x for x in v))
        rows.append((k, [x * size for x in v]))
    rows += [(1000 + k, rows[7][1]) for k in range(60)] + [(2000 + k, [x * 1.01 for x in rows[3][1]]) for k in range(20)]
    rows += [(5000, None), (5050, [1.0, None]), (5100, [float("nan")] * 8), (5150, [float("inf")] * 8), (None, rows[0][1]), (5200, []), (5201, [])]
    rows += [(5250, [1.0, 2.0]), (5251, [3.0, -1.0]), (5300, [0.0] * 8), rows[10], rows[50], rows[50], (50, rows[3][1])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumn("score", F.lit("clash"))
    got = topk_search.top(df, F.col("vec_id") % 50 == 0, k=5).collect()
    assert ordered(got) == ordered(brute(rows, 5, 50))


def test_empty_table(spark):
    df = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert topk_search.top(df, F.col("vec_id") % 50 == 0).count() == 0
