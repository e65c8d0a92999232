import hashlib
import math
import random
import zlib
from collections import defaultdict

import numpy as np
import pytest
from odd import ordered
from pyspark.sql import functions as F

from claimloom.llm import conversation_trie

SCHEMA = "conv_id long, turn long, role string, text string"


def digest(role, text):
    return hashlib.sha256(f"{len(role.encode())}:{role}{text}".encode()).hexdigest()


def brute(rows, shared):
    convs = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            role, text = role or "", text or ""
            convs[conv].append((turn is not None, turn or 0, digest(role, text), role, text))
    own = {k: [x[3:] for x in sorted(v)] for k, v in convs.items()}
    built = {}
    for k, v in own.items():
        h = zlib.crc32(str(k).encode()) % 6 if shared else 0
        built[k] = own.get(k - int(math.fmod(k, 100)), [])[:h] + v[h:]
    members, children, leaves, saved = defaultdict(list), defaultdict(list), {}, {}
    for k, v in built.items():
        for d in range(len(v) + 1):
            members[tuple(v[:d])].append(k)
    for n in members:
        if n:
            children[n[:-1]].append(n)
    for n in sorted(members, key=len, reverse=True):
        leaves[n] = sum(leaves[x] for x in children[n]) if children[n] else 1
        saved[n] = sum(saved[x] for x in children[n]) + ((len(members[n]) - 1) * len(n[-1][1]) if n else 0)
    out = []
    for n, m in members.items():
        last = ",".join(str(k) for k in sorted(m) if len(built[k]) == len(n))
        above = min(members[n[:-1]]) if n else None
        out.append((min(m), len(n), above, len(m), len(children[n]), leaves[n], saved[n], hashlib.sha256(last.encode()).hexdigest()))
    return ordered(out)


def rows():
    """Shared heads, copies of one conversation, a long chain, branches, odd rows."""
    rnd = random.Random(5)
    made = [(c, t, rnd.choice(["user", "assistant", None]), rnd.choice(["", "hi", "né", None, "z" * 9])) for c in range(0, 330, 3) for t in range(rnd.randint(1, 7))]
    made += [(c, t, "user", "copy") for c in range(1000, 1090) for t in range(3)]
    made += [(2000, t, "user", f"t{t}") for t in range(120)] + [(2101, t, "user", f"t{t}") for t in range(60)]
    made += [(3001, None, "user", "first"), (3001, 1, "user", "b"), (3001, 1, "user", "a"), (3001, 1, "user", "a"), (3001, 2, None, None)]
    made += [(None, 1, "user", "x"), (-7, 0, "user", "minus"), (-107, 0, "user", "minus"), (-100, 0, "user", "base"), (4005, 0, "user", "alone")]
    return made


@pytest.mark.parametrize(("part", "width"), [(4096, 1024), (8, 4), (1, 2)])
@pytest.mark.parametrize("shared", [True, False])
def test_equals_brute_force(spark, monkeypatch, part, width, shared):
    monkeypatch.setattr(conversation_trie, "PART", part)
    monkeypatch.setattr(conversation_trie, "WIDTH", width)
    made = rows()
    if part == 1:  # every node takes its turn as a centroid between tasks
        made = [r for r in made if r[0] is None or r[0] < 60 or r[0] in (1000, 1001, 3001)]
    df = spark.createDataFrame(made, SCHEMA).withColumns({x: F.lit("clash") for x in ("place", "name", "parent", "comp", "depth", "length", "head", "digest", "row")})
    build = conversation_trie.with_shared_heads if shared else conversation_trie.plain
    assert ordered(conversation_trie.trie(*build(df.repartition(4))).collect()) == brute(made, shared)


def test_empty_tables(spark):
    for made in ([], [(None, 1, "user", "x")]):
        for build in (conversation_trie.plain, conversation_trie.with_shared_heads):
            assert conversation_trie.trie(*build(spark.createDataFrame(made, SCHEMA))).collect() == []


def test_very_long_text(spark):
    made = [(1, 0, "user", "ä" * 2_000_000), (2, 0, "user", "ä" * 2_000_000), (3, 0, "user", "ä" * 1_999_999)]
    assert ordered(conversation_trie.trie(*conversation_trie.plain(spark.createDataFrame(made, SCHEMA))).collect()) == brute(made, False)


@pytest.mark.parametrize("shape", ["chain", "star", "random", "forest"])
def test_sums_within_a_task(shape):
    rnd = np.random.default_rng(6)
    n = 700
    up = {"chain": np.arange(n) - 1, "star": np.where(np.arange(n) == 0, -1, 0), "random": np.array([-1, *(rnd.integers(0, k) for k in range(1, n))])}
    up = up.get(shape, np.where(np.arange(n) % 50 == 0, -1, np.arange(n) - 1 - np.arange(n) % 3 // 2))
    up = np.where((up >= 0) & (up // 50 != np.arange(n) // 50), np.arange(n) // 50 * 50, up) if shape == "forest" else up
    depth, weight, values = np.zeros(n, np.int64), rnd.integers(1, 9, n), rnd.integers(0, 99, (n, 2))
    for k in range(n):
        depth[k] = depth[up[k]] + 1 if up[k] >= 0 else 0
    mass, sums = weight.copy(), values.copy()
    for k in range(n - 1, -1, -1):
        if up[k] >= 0:
            mass[up[k]] += mass[k]
            sums[up[k]] += sums[k]
    assert (conversation_trie._decomposed(up, depth, mass, values) == sums).all()
