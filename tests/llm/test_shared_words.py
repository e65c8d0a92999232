import random
import re

import numpy as np
import pyarrow as pa

from claimloom.llm import shared


def texts():
    rnd = random.Random(4)
    letters = "aAzZ@[`{ \t\n.-09\u00e9\u4e2d"
    made = ["".join(rnd.choice(letters) for _ in range(rnd.choice([0, 1, 7, 8, 30, 200]))) for _ in range(300)]
    return [None, "", " ", "word", "word", "", *made, "x" * 5000, "a b", "", ""]


def test_words_are_those_of_each_text():
    """A word ends where its text ends, also beside a text that begins with one."""
    told = texts()
    data, places = shared.raw(pa.array(told, pa.string()))
    for blank, pattern in ((shared.blank_bytes(), rb"[^\x20\x09-\x0d]+"), (shared.punctuation_bytes(), rb"[0-9A-Za-z\x80-\xff]+")):
        starts, ends, limits = shared.words(data, places, blank)
        want = [re.findall(pattern, (t or "").encode()) for t in told]
        assert [bytes(data[a:b]) for a, b in zip(starts, ends, strict=True)] == [w for x in want for w in x]
        assert limits.tolist() == [0, *np.cumsum([len(x) for x in want]).tolist()]
    none = shared.words(np.zeros(0, np.uint8), np.zeros(1, np.int64), shared.blank_bytes())
    assert [len(x) for x in none] == [0, 0, 1]


def test_names_are_polynomials_of_all_bytes():
    words = [bytes(random.Random(n).randrange(33, 256) for _ in range(n)) for n in [*range(1, 64), 500, 3000]] * 2
    ends = np.cumsum([len(w) for w in words])
    data, starts = np.frombuffer(b"".join(words), np.uint8), ends - [len(w) for w in words]
    for fold in (False, True):
        want = []
        for w in (w.lower() if fold else w for w in words):
            parts = [int.from_bytes(w[k : k + 7], "little") for k in range(0, len(w), 7)]
            want.append(sum(x * pow(shared._POINT, k, shared.PRIME) for k, x in enumerate(parts)) % shared.PRIME)
        want = shared.mix(shared.mix(np.array(want, np.uint64) + np.uint64(shared._BASE)) + (ends - starts).astype(np.uint64))
        assert np.array_equal(shared.names(data, starts, ends, fold), want)
