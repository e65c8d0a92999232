import random

from odd import documents, empty, ordered

from claimloom.llm import decontaminate


def passages(n, seed=1):
    rnd = random.Random(seed)
    words = [f"term{k}" for k in range(3000)] + ["the", "of", "and"] * 300
    text = lambda size: [rnd.choice(words) for _ in range(size)]
    items = [text(rnd.randrange(15, 60)) for _ in range(n)]
    return rnd, text, items


def planted():
    """Items inside texts as they are, with punctuation and case changed, with a fifth of the words replaced, and clean texts."""
    rnd, text, items = passages(40)
    rows, want = [], set()
    for k, item in enumerate(items):
        about = lambda: text(rnd.choice([0, 10, 90, 300]))
        loud = ", ".join(w.upper() for w in item) + "!"
        loose = [w if rnd.random() < 0.88 or j >= len(item) - 8 else "other" for j, w in enumerate(item)]
        for form, told in enumerate((" ".join(item), loud, " ".join(loose))):
            rows.append((1000 + 10 * k + form, " ".join([*about(), told, *about()])))
            want.add((1000 + 10 * k + form, k))
        rows.append((5000 + k, " ".join(text(400))))
        rows.append((6000 + k, " ".join([*text(40), *item[: len(item) // 3], *text(40)])))
    return [(k, " ".join(x)) for k, x in enumerate(items)], rows, want


def test_planted_items_are_found_and_clean_texts_are_not(spark):
    items, rows, want = planted()
    docs = documents(spark, [(k, t, None, None, None) for k, t in rows])
    benchmark = spark.createDataFrame([*items, (900, None), (901, ""), (902, "too short"), (903, items[0][1])], "item_id long, text string")
    found = {(r.doc_id, r.item_id) for r in decontaminate.leaks(docs, benchmark).collect()}
    want |= {(d, 903) for d, i in want if i == 0}
    assert found <= want and len(found) >= 0.97 * len(want)
    assert {x for x in want if x[0] % 10 < 2} <= found
    left = decontaminate.without_leaks(docs, benchmark)
    assert left.schema == docs.schema
    keep = [r for r in (tuple(r) for r in docs.select("doc_id", "text").collect()) if r[0] not in {d for d, _ in found}]
    assert ordered(left.select("doc_id", "text").collect()) == ordered(keep)


def test_candidates_against_brute_force(spark):
    """Recall of the latent search itself: of all passages that hold an item whole, how many are candidates."""
    import numpy as np
    import pyarrow as pa

    items, rows, want = planted()
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    index = next(decontaminate._indexes(docs, benchmark))
    words, limits = decontaminate._words(pa.array([t for _, t in rows]))
    near = {(int(text), int(item)) for _, text, item, _ in index.near(words, limits)}
    texts = {d: n for n, (d, _) in enumerate(rows)}
    exact = [(texts[d], i) for d, i in want]
    assert np.mean([x in near for x in exact]) >= 0.97


def test_several_blocks_of_items(spark, monkeypatch):
    monkeypatch.setattr(decontaminate, "ITEMS", 16)
    items, rows, want = planted()
    found = decontaminate.leaks(spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"))
    got = {(r.doc_id, r.item_id) for r in found.collect()}
    assert got <= want and len(got) >= 0.97 * len(want)


def test_items_of_every_length_are_found(spark):
    """Word for word inside texts whose other words are the benchmark's too; and with every tenth word replaced."""
    rnd, text, _ = passages(0)
    sizes = [k for k in (5, 6, 8, 9, 12, 20, 33, 40, 64, 65, 100, 150, 200, 300, 500) for _ in range(20)]
    items, rows = [text(k) for k in sizes], []
    for k, item in enumerate(items):
        rows.append((k, " ".join([*text(rnd.randrange(200)), *item, *text(rnd.randrange(200))])))
        rows.append((1000 + k, " ".join([*text(50), *["other" if j % 10 == 4 else w for j, w in enumerate(item)], *text(50)])))
    benchmark = spark.createDataFrame([(k, " ".join(x)) for k, x in enumerate(items)], "item_id long, text string")
    leaks = decontaminate.leaks(spark.createDataFrame(rows, "doc_id long, text string"), benchmark).collect()
    found = {(r.doc_id, r.item_id) for r in leaks}
    lost = [sizes[d % 1000] for d in [k for k in range(len(items))] + [1000 + k for k in range(len(items))] if (d, d % 1000) not in found]
    assert not lost
    assert all(r.share >= 0.8 for r in leaks if r.doc_id < 1000 and r.doc_id == r.item_id)


def test_copies_of_a_leaking_text_do_not_hide_its_item(spark):
    """A third of all rows are copies of one text with an item; every word of the item is in all of them."""
    rnd, text, items = passages(3)
    copy = " ".join([*text(100), *items[0], *text(100)])
    rows = [(k, copy) for k in range(60)] + [(100 + k, " ".join(text(200))) for k in range(120)]
    rows.append((900, " ".join([*text(90), *items[0], *text(90)])))
    benchmark = spark.createDataFrame([(k, " ".join(x)) for k, x in enumerate(items)], "item_id long, text string")
    found = {(r.doc_id, r.item_id) for r in decontaminate.leaks(spark.createDataFrame(rows, "doc_id long, text string"), benchmark).collect()}
    assert found == {(k, 0) for k in range(60)} | {(900, 0)}


def test_frequencies_count_equal_texts_once(spark):
    import numpy as np
    import pyarrow as pa

    terms = decontaminate.Terms.of(decontaminate._words(pa.array(["a b c"]))[0])
    rows = [("a b " + "x " * 80,)] * 50 + [("a c",), ("A c",), ("",), (None,), ("y",)]
    often, total = decontaminate._frequencies(spark.createDataFrame(rows, "text string").repartition(5), terms)
    assert sorted(often.tolist()) == [1, 2, 3] and total == 2 + 1 + 1 + 1 and np.issubdtype(often.dtype, np.integer)


def test_fit_takes_distinct_texts(spark, monkeypatch):
    rows = [("copy",)] * 500 + [(f"text {k}",) for k in range(1000)]
    docs = spark.createDataFrame(rows, "text string").repartition(5)
    assert decontaminate._fit_texts(docs).count() == 1001
    monkeypatch.setattr(decontaminate, "FIT_TEXTS", 100)
    copies = spark.createDataFrame([(f"text {k % 1000}",) for k in range(9000)], "text string")
    assert 60 < decontaminate._fit_texts(copies).count() < 200


def test_one_document(spark):
    """In a table of one text every word is in all texts."""
    rnd, text, items = passages(2)
    docs = spark.createDataFrame([(1, " ".join([*text(30), *items[0], *text(30)]))], "doc_id long, text string")
    benchmark = spark.createDataFrame([(k, " ".join(x)) for k, x in enumerate(items)], "item_id long, text string")
    assert [(r.doc_id, r.item_id) for r in decontaminate.leaks(docs, benchmark).collect()] == [(1, 0)]
    assert decontaminate.without_leaks(docs, benchmark).count() == 0


def test_empty_tables(spark):
    docs, none = documents(spark), spark.createDataFrame([], "item_id long, text string")
    assert decontaminate.leaks(docs, none).count() == 0 and decontaminate.without_leaks(docs, none).count() == docs.count()
    some = spark.createDataFrame([(1, "a b c d e f")], "item_id long, text string")
    assert decontaminate.leaks(empty(spark), some).count() == 0
    assert {r.doc_id for r in decontaminate.leaks(docs, some).collect()} == {5, 6}


def test_common_length():
    assert decontaminate.common_length([1, 2, 3, 4], [9, 1, 3, 9, 4]) == 3
    assert decontaminate.common_length([1, 1, 1], [1, 1]) == 2 and decontaminate.common_length([], [1]) == 0


def test_space_is_fitted_on_every_distinct_text(spark):
    """The sums behind the latent space are those over the passages of all texts, copies once; 5,000 of them are more than a sample held."""
    import numpy as np
    import pyarrow as pa

    rnd = random.Random(3)
    words = [f"w{k}" for k in range(40)]
    texts = [" ".join([f"only{k}", *(rnd.choice(words) for _ in range(rnd.choice([3, 70, 100]) if k % 50 == 0 else 4))]) for k in range(5000)]
    rows = [(k, t) for k, t in enumerate([*texts, *texts[:300], None, ""])]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    terms = decontaminate.Terms.of(decontaminate._words(pa.array([" ".join([*words, *(f"only{k}" for k in range(0, 5000, 7))])]))[0])
    width = len(terms.names)
    lists = decontaminate._lists(docs, terms)
    often, total = decontaminate._frequencies(docs, terms, lists)
    names = {int(x): k for k, x in enumerate(terms.names)}
    vectors = []
    for t in texts:
        told = [names.get(int(x)) for x in decontaminate._words(pa.array([t]))[0]]
        for a in range(0, max(1, 1 + -(-(len(told) - 64) // 32)) * 32, 32):
            x = np.zeros(width)
            for term in told[a : a + 64]:
                if term is not None:
                    x[term] += 1
            vectors.append(x)
    x = np.array(vectors)
    assert total == len(x) and (often == (x > 0).sum(0)).all()
    idf = (np.log((1 + total) / (1 + often)) + 1).astype(np.float32)
    x = np.log1p(x) * idf
    x /= np.maximum(np.linalg.norm(x, axis=1), 1e-12)[:, None]
    basis = np.random.default_rng(1).standard_normal((width, 20)).astype(np.float32)
    for back in (True, False):
        want = (x.T if back else (x @ basis).T) @ (x @ basis)
        assert np.allclose(decontaminate._summed(lists, idf, basis, back), want, rtol=1e-3, atol=1e-3 * np.abs(want).max())


def test_passages_that_can_hold_no_part_are_not_projected(spark, monkeypatch):
    """They are no candidates whatever their cosine; the candidates are those of a search without the test."""
    import numpy as np
    import pyarrow as pa

    items, rows, want = planted()
    rnd = random.Random(5)
    rows += [(9000 + k, " ".join(f"foreign{rnd.randrange(900)}" if rnd.random() < 0.95 else items[0][1].split()[0] for _ in range(300))) for k in range(300)]
    index = next(decontaminate._indexes(spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")))
    words, limits = decontaminate._words(pa.array([t for _, t in rows]))
    projected, seen = decontaminate._projected, []
    monkeypatch.setattr(decontaminate, "_projected", lambda passage, *rest: seen.append(len(np.unique(passage))) or projected(passage, *rest))
    near = list(index.near(words, limits))
    at, term = index.terms.find(words)
    sizes = np.unique(index.parts[:, 2]).tolist()
    every = [len(np.unique(decontaminate._counted(at, term, limits, len(index.idf), size)[0])) for size in sizes]
    assert len(seen) == len(sizes) and sum(seen) < 0.8 * sum(every)
    monkeypatch.setattr(decontaminate, "_able", lambda passage, *rest: np.ones(len(passage), bool))
    whole = list(index.near(words, limits))
    assert near and [x[:3] for x in near] == [x[:3] for x in whole] and np.allclose([x[3] for x in near], [x[3] for x in whole], atol=1e-5)


def test_terms_are_found_also_if_their_first_bits_are_equal():
    import numpy as np

    rnd = np.random.default_rng(1)
    some = rnd.integers(0, 1 << 64, 3000, np.uint64)
    some[:900] = (some[:900] >> np.uint64(16)) | np.uint64(77 << 48)
    terms = decontaminate.Terms.of(some[::3])
    words = rnd.choice(np.concatenate([some, [np.uint64(0), np.uint64((1 << 64) - 1)]]), 20000)
    known = {int(x): k for k, x in enumerate(terms.names)}
    want = [(k, known[int(w)]) for k, w in enumerate(words) if int(w) in known]
    at, term = terms.find(words)
    assert list(zip(at.tolist(), term.tolist(), strict=True)) == want


def test_counts_of_passages_against_brute_force():
    import numpy as np

    rnd = np.random.default_rng(1)
    sizes = np.concatenate([[0, 1, 7, 8, 9, 12, 13, 0, 200], rnd.integers(0, 60, 200)])
    limits = np.append(0, np.cumsum(sizes))
    at = np.flatnonzero(rnd.random(limits[-1]) < 0.6)
    term = rnd.integers(0, 9, len(at))
    known = dict(zip(at.tolist(), term.tolist(), strict=True))
    for size, width in ((8, 9), (8, 1 << 40), (16, 9), (64, 9)):
        want, begins = [], []
        for text, n in enumerate(sizes.tolist()):
            for a in range(0, max(size, n + size // 2 - 1) - size + 1 if n else 0, size // 2):
                told = [known[k] for k in range(limits[text] + a, min(limits[text] + a + size, limits[text + 1])) if k in known]
                want += [(len(begins), t, told.count(t)) for t in sorted(set(told))]
                begins.append((limits[text] + a, text))
        passage, terms, times, first, text = decontaminate._counted(at, term, limits, width, size)
        assert list(zip(passage.tolist(), terms.tolist(), times.tolist(), strict=True)) == want
        assert list(zip(first.tolist(), text.tolist(), strict=True)) == begins


def test_a_large_batch_is_searched_piece_by_piece(spark, monkeypatch):
    """So that what a task works on stays in the processor's caches."""
    import pyarrow as pa

    items, rows, want = planted()
    index = next(decontaminate._indexes(spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")))
    many = [(k, t) for _ in range(1 + (3 << 20) // sum(len(t) for _, t in rows)) for k, t in rows]
    batch = pa.record_batch([pa.array([k for k, _ in many], pa.int64()), pa.array([t for _, t in many])], names=["doc_id", "text"])
    words, seen = decontaminate._words, []
    monkeypatch.setattr(decontaminate, "_words", lambda column: seen.append(sum(map(len, column.to_pylist()))) or words(column))
    found = {(d, i) for b in decontaminate._found(index, pa.int64())(iter([batch])) for d, i in zip(*(b.column(k).to_pylist() for k in range(2)), strict=True)}
    assert found <= want and len(found) >= 0.97 * len(want)
    assert sum(seen) >= 3 << 20 and max(seen) <= decontaminate.PIECE
