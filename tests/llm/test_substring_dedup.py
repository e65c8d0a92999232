import collections
import hashlib
import random
import re

import numpy as np
import pytest
from odd import ALIKE, documents, empty, ordered

from claimloom.llm import shared, substring_dedup


def brute(rows, width):
    split = [re.findall(r"[^\x20\x09-\x0D]+", text or "") for _, text in rows]
    times = collections.Counter(tuple(w[k : k + width]) for w in split for k in range(len(w) - width + 1))
    out = []
    for (key, _), w in zip(rows, split, strict=True):
        gone = [False] * len(w)
        for k in range(len(w) - width + 1):
            if times[tuple(w[k : k + width])] > 1:
                gone[k : k + width] = [True] * width
        kept = " ".join(x for x, g in zip(w, gone, strict=True) if not g)
        out.append((key, len(w), sum(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return out


@pytest.mark.parametrize("width", [3, 8, 35])
def test_equals_brute_force(spark, width):
    """Few letters make runs, periods, overlaps and passages that differ at their ends."""
    rnd = random.Random(5)
    rows = [(k, " ".join(rnd.choice("ab" if k % 3 else "abcdefgh") for _ in range(rnd.choice([0, 3, 10, 60, 200])))) for k in range(60)]
    passage = " ".join(f"p{k}" for k in range(60))
    rows += [(100, "a " * 100), (101, "a " * 90 + "b"), (102, "a b " * 50), (103, f"x {passage} y"), (104, f"{passage} z w"), (5, rows[5][1])]
    got = substring_dedup.repeats(spark.createDataFrame(rows, "doc_id long, text string"), width).collect()
    assert ordered(got) == ordered(brute(rows, width))


def test_long_words_that_are_alike(spark):
    words = [f"w{k}" for k in range(34)]
    rows = [(k, " ".join([*words[:17], word, *words[17:]])) for k, word in enumerate([*ALIKE, "x" * 70_000, "x" * 69_999 + "y"])]
    got = substring_dedup.repeats(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert ordered(got) == ordered(brute(rows, 35)) and not any(r.n_removed for r in got)


def test_odd_rows(spark):
    docs = documents(spark)
    rows = [tuple(r) for r in docs.select("doc_id", "text").collect()]
    want = ordered(brute(rows, 35))
    assert ordered(substring_dedup.repeats(docs).collect()) == want
    out = substring_dedup.without_repeats(docs)
    assert out.columns == docs.columns and out.schema == docs.schema
    texts = {r.doc_id: (r.text, r.n_chars, r.lang) for r in out.collect()}
    assert out.count() == len(rows) and texts[7] == ("", 0, None) and texts[3][0] == " \n\t " and texts[1][0] is None


def test_empty_table(spark):
    assert substring_dedup.repeats(empty(spark)).count() == 0
    assert substring_dedup.without_repeats(empty(spark)).count() == 0


@pytest.mark.parametrize("width", [2, 3, 5, 35])
def test_swapped_words_have_other_names(width):
    values = shared.mix(np.arange(1, width + 1, dtype=np.uint64))
    names = {int(shared.rolled(values, width)[0])}
    for i in range(width):
        for j in range(i):
            other = values.copy()
            other[[i, j]] = other[[j, i]]
            names.add(int(shared.rolled(other, width)[0]))
    assert len(names) == 1 + width * (width - 1) // 2
