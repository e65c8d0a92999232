import random
import zlib

from odd import documents, empty

from claimloom.llm import toxicity
from pyspark.sql import functions as F

BAD = ["idiot", "stupid", "moron"]


def corpus(n, seed=1):
    rnd = random.Random(seed)
    syllables = ["ta", "re", "mi", "lo", "su", "ne", "ka", "fo", "be", "du"]
    rows = []
    for k in range(n):
        words = ["".join(rnd.choice(syllables) for _ in range(rnd.randrange(1, 4))) for _ in range(rnd.choice([20, 60, 150]))]
        toxic = int(rnd.random() < 0.3)
        for _ in range(max(1, len(words) // 40) if toxic else 0):
            words[rnd.randrange(len(words))] = rnd.choice(BAD)
        rows.append((k, " ".join(words), toxic))
    return rows


def test_held_out_accuracy(spark):
    rows = corpus(700)
    docs = documents(spark, [(100 + k, t, None, None, None) for k, t, _ in rows])
    labels = spark.createDataFrame([(100 + k, 1, y) for k, _, y in rows] + [(None, 1, 1), (5, None, None), (100, 1, rows[0][2])], "doc_id long, quality int, toxic int")
    model = toxicity.fit(docs, labels)
    found = toxicity.scored(docs.drop("_score"), model).select("doc_id", "_score", toxicity.held_out(F.col("doc_id")).alias("out")).collect()
    score = {r.doc_id: r._score for r in found if r.out}
    assert all(0 <= r._score <= 1 for r in found) and all(r.out == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in found)
    truth = {100 + k: y for k, _, y in rows}
    right = sum((score[k] >= 0.5) == (truth[k] == 1) for k in score if k in truth)
    assert right >= 0.95 * sum(k in truth for k in score) > 100


def test_inserted_characters_stay_close():
    keys, slots, features = toxicity._index(["^idiot"])
    near = toxicity.closeness(["^idiot", "^idxiot", "^id-iot", "^i.d.i.o.t", "^tarelo", "^" + "x" * 40 + "idiot"], keys, slots, features)[:, 0]
    assert near[0] > 0.99 and min(near[1:3]) > 0.5 and near[3] > 0.3 and near[4] == 0 and near[5] > 0.3


def test_spelled_out_words_are_read():
    rows = corpus(300)
    model = toxicity.train([t for _, t, _ in rows], [y for _, _, y in rows])
    scorer = toxicity._Scorer(model.keys, model.slots, model.features)
    plain, spelled = scorer.features(["ta re mi " * 5 + "lo su ne", "ta re mi " * 5 + "i d i o t"])
    assert spelled.max() > 5 * max(plain.max(), 0.01)


def test_few_labels(spark):
    docs = documents(spark).drop("_score")
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    model = toxicity.fit(docs, labels)
    assert {r._score for r in toxicity.scored(docs, model).collect()} == {0.0}
    left = toxicity.without_toxic(docs, labels)
    assert left.schema == docs.schema and left.count() == docs.count()
    assert toxicity.without_toxic(empty(spark), labels).count() == 0


def test_texts_are_scored_in_small_pieces(monkeypatch):
    """Each piece may bring as many new words as it has; scores do not depend on the cut."""
    import numpy as np
    import pyarrow as pa

    texts = [f"good day {k} " * 20 + ("vile" * (k % 3)) for k in range(9000)]
    model = toxicity.train(texts[:300], [int(k % 3 > 0) for k in range(300)])
    whole = next(toxicity._scored(model)(iter([pa.record_batch([pa.array(texts[-50:])], names=["text"])]))).column("_score")
    sizes, features = [], toxicity._Scorer.features
    monkeypatch.setattr(toxicity._Scorer, "features", lambda self, part: sizes.append(sum(map(len, part))) or features(self, part))
    out = list(toxicity._scored(model)(iter([pa.record_batch([pa.array(texts)], names=["text"])])))
    assert model.constant is None and sum(sizes) == sum(map(len, texts)) and max(sizes) <= 1 << 20
    assert np.array_equal(np.concatenate([b.column("_score").to_numpy() for b in out])[-50:], whole.to_numpy())


def test_closeness_is_the_kernel_and_sums_by_rows(monkeypatch):
    """Every three-character subsequence that a word and a landmark share, by hand."""
    import itertools

    import numpy as np

    from claimloom.llm import shared

    def weights(word):
        found = {}
        for i, j, k in itertools.combinations(range(len(word)), 3):
            if k - i < toxicity.SPAN:
                key = word[i], word[j], word[k]
                found[key] = found.get(key, 0) + toxicity.DECAY ** (k - i + 1)
        return found

    landmarks, rnd = ["^idiot", "^stup", "^moron"], random.Random(4)
    words = ["^" + "".join(rnd.choices("idotsupmrn.", k=rnd.randrange(1, 31))) for _ in range(2000)]
    told = [weights(x) for x in landmarks]
    want = np.zeros((len(words), len(landmarks)))
    for row, word in enumerate(words):
        mine = [(i, j, k) for i, j, k in itertools.combinations(range(len(word)), 3) if k - i < toxicity.SPAN]
        hits = [(k - i, (word[i], word[j], word[k])) for i, j, k in mine if any((word[i], word[j], word[k]) in x for x in told)]
        if len(hits) >= 3:
            for n, x in enumerate(told):
                want[row, n] = sum(toxicity.DECAY ** (span + 1) * x.get(key, 0) for span, key in hits) / sum(w * w for w in x.values())
    called, sums = [], shared.row_sums
    monkeypatch.setattr(shared, "row_sums", lambda *told: called.append(1) or sums(*told))
    got = toxicity.closeness(words, *toxicity._index(landmarks))
    assert called and np.allclose(got, want, rtol=1e-4, atol=1e-5) and (want > 0).any(axis=1).mean() > 0.2
