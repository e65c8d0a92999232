import random

import numpy as np
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from claimloom.operators import ranking


@pytest.fixture(scope="module")
def rows(spark):
    rnd = random.Random(3)
    data = [(i, rnd.choice(["a", "a", "a", "b", None]), float(rnd.randrange(40)) if i % 3 else 7.0) for i in range(3000)]
    return spark.createDataFrame(data, "id long, g string, v double").repartition(16)


@pytest.mark.parametrize("by", [[], ["g"]])
def test_row_number(spark, rows, by):
    """Sliced ranks equal a window; a third of the rows share one value."""
    order = [F.col("v").desc(), F.col("id").asc()]
    got = ranking.with_row_number(rows, "n", by, order)
    plain = Window.partitionBy(*(by or [F.lit(0)])).orderBy(*order)
    expected = rows.withColumn("n", F.row_number().over(plain).cast("long"))
    assert got.select("id", "g", "v", "n").exceptAll(expected).count() == 0 and got.count() == 3000


@pytest.mark.parametrize("descending", [True, False])
def test_value_ranks(spark, rows, descending):
    got = ranking.value_ranks(rows, "v", descending=descending)
    line = Window.partitionBy(F.lit(0)).orderBy(F.col("v").desc() if descending else F.col("v").asc())
    expected = rows.select(
        "v", F.dense_rank().over(line).cast("long").alias("d"), F.rank().over(line).cast("long").alias("r")
    ).distinct()
    assert got.select("v", F.col("dense_rank").alias("d"), F.col("rank").alias("r")).exceptAll(expected).count() == 0
    assert got.count() == expected.count()


def test_percentiles(spark, rows):
    points = [0.0, 0.1, 0.333, 0.5, 0.9, 1.0]
    data = [r.v for r in rows.select("v").collect()]
    got = {r.percentile: r.amount for r in ranking.percentiles(rows, "v", points).collect()}
    for p in points:
        assert got[p] == pytest.approx(np.percentile(data, p * 100))
