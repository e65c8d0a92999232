import random
import re

import numpy as np
import pytest
from odd import ALIKE, documents, empty, ordered
from pyspark.sql import functions as F

from claimloom.llm import minhash_dedup, shared


def brute(rows, percent):
    sets = []
    for _, text in rows:
        w = re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode().lower())
        sets.append({tuple(w[k : k + 5]) for k in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set())
    parent = list(range(len(sets)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in range(len(sets)):
        for b in range(a):
            if sets[a] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
                parent[root(a)] = root(b)
    least = {}
    for k, (key, _) in enumerate(rows):
        least[root(k)] = min([x for x in (least.get(root(k)), key) if x is not None], default=None)
    return [(key, len(sets[k]), least[root(k)], key == least[root(k)]) for k, (key, _) in enumerate(rows)]


def test_bands_miss_less_than_one_in_a_million():
    for percent in (80, 85, 95):
        count, width = minhash_dedup.bands_for(percent)
        assert (1 - (percent / 100) ** width) ** count <= 1e-6 and count * width <= minhash_dedup.COORDINATES


@pytest.mark.parametrize("block", [16, 512])
def test_equals_brute_force(spark, monkeypatch, block):
    """A large group whose members differ from each other by more than from their origin, links in chains, small texts."""
    monkeypatch.setattr(minhash_dedup, "BLOCK", block)
    rnd = random.Random(3)
    words = [f"w{k}" for k in range(500)]
    origin = [rnd.choice(words) for _ in range(120)]
    rows = []
    for k in range(160):
        text = list(origin) if k % 4 else [rnd.choice(words) for _ in range(rnd.choice([1, 3, 20, 100]))]
        for _ in range(rnd.randrange(6) if k % 4 else 0):
            text[rnd.randrange(len(text))] = rnd.choice(words)
        rows.append((1000 - k, " ".join(text)))
    chain = list(origin[:100])
    for k in range(12):
        chain[k * 8] = f"new{k}"
        rows.append((2000 - k, " ".join(chain)))
    got = minhash_dedup.groups(spark.createDataFrame(rows, "doc_id long, text string"), 85).drop("digest")
    assert ordered(got.collect()) == ordered(brute(rows, 85))


def test_long_words_that_are_alike(spark):
    words = [f"w{k}" for k in range(34)]
    rows = [(k, " ".join([*words[:17], word, *words[17:]])) for k, word in enumerate(ALIKE)]
    got = minhash_dedup.groups(spark.createDataFrame(rows, "doc_id long, text string"), 85).drop("digest").collect()
    assert ordered(got) == ordered(brute(rows, 85)) and all(r.kept for r in got)


def test_many_unlinked_texts_in_one_cluster(spark, monkeypatch):
    """Texts that share buckets with each other but reach the threshold with few: links have to be found apart from the hubs."""
    monkeypatch.setattr(minhash_dedup, "BLOCK", 16)
    monkeypatch.setattr(minhash_dedup, "BLOCK_BYTES", 4096)
    rnd = random.Random(8)
    origin = [f"w{k}" for k in range(150)]
    rows = []
    for k in range(120):
        text = list(origin)
        at = rnd.randrange(100)
        text[at : at + 12 + k % 9] = [f"own{k}x{j}" for j in range(12 + k % 9)]
        rows.append((k, " ".join(text)))
        if k % 5 == 0:
            text[3] = "other"
            rows.append((500 + k, " ".join(text)))
    got = minhash_dedup.groups(spark.createDataFrame(rows, "doc_id long, text string"), 85).drop("digest")
    assert ordered(got.collect()) == ordered(brute(rows, 85))


def test_shared_values_are_counted_exactly(monkeypatch):
    monkeypatch.setattr(minhash_dedup, "_WIDE", 7)
    rnd = np.random.default_rng(2)
    ones, others = ([np.unique(rnd.integers(0, 90, rnd.integers(1, 60)).astype(np.uint64)) for _ in range(n)] for n in (9, 13))
    got = minhash_dedup.common(ones, others)
    assert all(got[i, j] == len(np.intersect1d(a, b)) for i, a in enumerate(ones) for j, b in enumerate(others))
    assert minhash_dedup.common(ones, []).shape == (9, 0)


@pytest.mark.parametrize("shape", ["chain", "star", "random"])
def test_components(spark, shape):
    rnd = random.Random(6)
    n = 60
    edges = {"chain": [(k, k + 1) for k in range(n)], "star": [(n, k) for k in range(n)], "random": [(rnd.randrange(n), rnd.randrange(n)) for _ in range(n // 2)]}[shape]
    parent = list(range(n + 1))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        x, y = sorted((root(a), root(b)))
        parent[y] = x
    got = shared.components(spark.createDataFrame(edges, "a long, b long"), "a", "b").collect()
    want = {k: root(k) for a, b in edges if a != b for k in (a, b)}
    assert len(got) == len(want) and {r.node: r.label for r in got} == want


def test_odd_rows(spark):
    docs = documents(spark)
    rows = [tuple(r) for r in docs.select("doc_id", "text").collect()]
    got = ordered(minhash_dedup.groups(docs, 80).select("doc_id", "n_shingles", "component_id").collect())
    assert got == ordered(r[:3] for r in brute(rows, 80))
    left = minhash_dedup.one_of_each(docs)
    assert left.columns == docs.columns
    assert sorted(str(r.doc_id) for r in left.collect()) == ["1", "2", "3", "4", "5", "7", "9", "None"]


def test_one_row_stays_when_ids_repeat_or_are_null(spark):
    long = [f"w{k}" for k in range(100)]
    near = lambda prefix: [" ".join(prefix + w for w in [*long[:99], end]) for end in ("x", "y", "z")]
    same, none, other, mixed = near("a"), near("b"), near("c"), near("d")
    rows = [(1, x) for x in same] + [(None, x) for x in none] + [(1, x) for x in other] + [(None, mixed[0]), (7, mixed[1]), (8, mixed[2])]
    left = [tuple(r) for r in minhash_dedup.one_of_each(spark.createDataFrame(rows, "doc_id long, text string")).collect()]
    assert sorted(text[0] for _, text in left) == ["a", "b", "c", "d"] and (7, mixed[1]) in left


def test_empty_table(spark):
    assert minhash_dedup.groups(empty(spark)).count() == 0
    assert minhash_dedup.one_of_each(empty(spark)).count() == 0
    assert minhash_dedup.one_of_each(empty(spark).withColumn("text", F.lit(None).cast("string"))).count() == 0
