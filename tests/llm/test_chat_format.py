import hashlib
import random

import pytest
from odd import ordered

from claimloom.llm import chat_format as chat

MESSAGES = "tree long, id long, parent long, role string, text string, score double"


def test_best_branch_of_a_tree(spark):
    rows = [
        (1, 1, None, "user", "q", 0.0), (1, 2, 1, "assistant", "a", 1.0), (1, 3, 1, "assistant", "b", 2.0),
        (1, 4, 2, "user", "more", 5.0), (1, 5, 3, "user", "less", None), (2, 9, 77, "user", "orphan", 1.0),
        (None, 1, None, "user", "null tree", 0.0),
    ]
    found = chat.conversations(spark.createDataFrame(rows, MESSAGES), keep=2).collect()
    told = {(r.tree, r["rank"]): [t for _, t in chat.read_turns(r.formatted)] for r in found}
    assert told == {(1, 1): ["q", "a", "more"], (1, 2): ["q", "b", "less"], (2, 1): ["orphan"], (None, 1): ["null tree"]}
    assert {chat.masked(r.formatted, r.loss) for r in found} == {"a", "b", ""}


def test_a_long_chain_takes_few_rounds(spark):
    rows = [(1, k, k - 1 if k else None, "user", str(k), 0.0) for k in range(300)]
    found = chat.conversations(spark.createDataFrame(rows, MESSAGES)).first()
    assert [t for _, t in chat.read_turns(found.formatted)] == [str(k) for k in range(300)]


def test_a_cycle_is_an_error(spark):
    rows = [(1, 1, 3, "user", "x", 0.0), (1, 2, 1, "user", "y", 0.0), (1, 3, 2, "user", "z", 0.0), (1, 4, 3, "user", "leaf", 0.0)]
    with pytest.raises(ValueError):
        chat.conversations(spark.createDataFrame(rows, MESSAGES))


def test_any_text_comes_back(spark):
    rnd = random.Random(2)
    bits = [*chat.CONTROL, "\\", "\n", "</s>\n", "|>\n", "<\\|", "é", "𝄞", " ", "x", ""]
    rows = []
    for key in range(120):
        for turn in range(rnd.randrange(1, 6)):
            text = None if rnd.random() < 0.1 else "".join(rnd.choice(bits) for _ in range(rnd.randrange(8)))
            rows.append((key if key else None, turn, rnd.choice(["user", "assistant", "a|>\nb", None]), text))
    rows += [(500, 1, "user", "same"), (500, 1, "user", "same")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    digest = lambda t: hashlib.sha256(t.encode()).hexdigest()
    want = []
    for key in {r[0] for r in rows}:
        turns = sorted((r[1:] for r in rows if r[0] == key), key=lambda r: (r[0], (r[1] is not None, r[1] or ""), (r[2] is not None, r[2] or "")))
        loss = "".join(x or "" for _, role, x in turns if role == "assistant")
        want.append((key, len(turns), digest("".join(f"{role or ''}\n{x or ''}\n" for _, role, x in turns)), len(loss), digest(loss)))
    got = [tuple(r)[:5] for r in chat.digests(chat.conversations(chat.chains(df))).collect()]
    assert ordered(got) == ordered(want)


def test_empty_table(spark):
    empty = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert chat.digests(chat.conversations(chat.chains(empty))).count() == 0
