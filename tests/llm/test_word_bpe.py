import hashlib
import random
import time

import public_tokenizers as public
import pytest
from odd import documents, empty, ordered
from tokenizers import Tokenizer

from claimloom.llm import lexicon, word_bpe

PATH = public.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


@pytest.fixture(scope="module")
def tokenizer():
    return word_bpe.read(PATH)


def want(library, rows):
    out = []
    digest = lambda x: hashlib.sha256(x.encode()).hexdigest()
    for key, text in rows:
        ids = library.encode(text or "", add_special_tokens=False).ids
        out.append((key, len(ids), digest(" ".join(map(str, ids))), digest(library.decode(ids, skip_special_tokens=False))))
    return ordered(out)


@pytest.fixture(scope="module")
def odd_texts(spark):
    """Every code point between letters, digits and signs; combining marks; added tokens in texts; case that changes the length."""
    rnd = random.Random(1)
    points = [chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    rows = [(k, "".join(c + rnd.choice(["", " ", "a", "1", ".", "Ä"]) for c in points[a : a + 997])) for k, a in enumerate(range(0, len(points), 997))]
    marks = [c for c in points if 0x300 <= ord(c) < 0x370 or 0x1AB0 <= ord(c) < 0x1B00 or 0x591 <= ord(c) < 0x600]
    rows += [(5000 + k, "".join(rnd.choice("aeouAEOUсЕ한か") + "".join(rnd.choices(marks, k=rnd.randint(0, 3))) for _ in range(300))) for k in range(30)]
    texts = ["a<|endoftext|>b <|startoftext|><|endoftext|> <|endoftext", "IT'S We'LL they'd 'S '' 1234", "ΣΑΣ ΟΔΟΣ İstanbul ǅ ß", "é<|endoftext|>́e", "the the\nthe　the"]
    rows += [(6000 + k, t) for k, t in enumerate(texts)] + [(6001, texts[1]), (7000, "ab" * 60 + " " + "x" * 70 + " yes")]
    return documents(spark, [(k, t, None, None, None) for k, t in rows])


@pytest.mark.parametrize("limit", [0, 300, word_bpe.LEXICON])
def test_equals_the_library(spark, library, tokenizer, odd_texts, limit):
    got = word_bpe.digests(word_bpe.decode(word_bpe.encode(odd_texts.repartition(5), tokenizer, limit=limit), tokenizer))
    assert ordered(got.collect()) == want(library, odd_texts.select("doc_id", "text").collect())


def test_whole_table(spark, library, tokenizer):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    got = word_bpe.digests(word_bpe.decode(word_bpe.encode(docs, tokenizer), tokenizer))
    assert ordered(got.collect()) == want(library, docs.select("doc_id", "text").collect())


def test_empty_table(spark, tokenizer):
    assert word_bpe.decode(word_bpe.encode(empty(spark), tokenizer), tokenizer).count() == 0


def test_long_word(library, tokenizer):
    rnd = random.Random(2)
    word = "".join(rnd.choices("abcdefghijklmnopqrstuvwxyz", k=1_000_000))
    start = time.time()
    assert word_bpe.merger(tokenizer)(word) == library.encode(word, add_special_tokens=False).ids
    assert time.time() - start < 60


def test_frequent_words(spark):
    counts = spark.createDataFrame([("a", 900), ("b", 900), ("c", 100), ("d", 99), ("e", 1), (" <|x|>", 5000), ("l" * 65, 5000)], "word string, n long")
    assert sorted(word_bpe.frequent(counts, 2)) == ["a", "b"]
    assert word_bpe.frequent(counts, 1) == []  # a class comes whole or not at all
    assert sorted(word_bpe.frequent(counts, 4)) == ["a", "b", "c", "d"]
    assert sorted(word_bpe.frequent(counts)) == ["a", "b", "c", "d", "e"]


def read_back(tmp_path, entries):
    path = tmp_path / "lexicon"
    path.write_bytes(lexicon.build(sorted(entries.items())))
    return lexicon.Lexicon(path)


def test_transducer_equals_a_table(tmp_path):
    rnd = random.Random(3)
    word = lambda: bytes(rnd.choices(b"ab\x00\xff", k=rnd.randint(1, 9)))
    entries = {word(): tuple(rnd.choices(range(6), k=rnd.randint(0, 4))) for _ in range(3000)}
    held = read_back(tmp_path, entries)
    asked = [*entries, *(word() for _ in range(2000)), b"", b"a" * 500]
    rnd.shuffle(asked)
    is_held, sizes, numbers = held.look_up(asked)
    assert is_held.tolist() == [w in entries for w in asked]
    assert sizes.tolist() == [len(entries.get(w, ())) for w in asked]
    assert numbers.tolist() == [x for w in asked for x in entries.get(w, ())]


def test_transducer_is_minimal(tmp_path):
    """Words with one ending share its states, whatever their first output; no two states mean the same."""
    entries = {stem + end: (k, *ids) for k, stem in enumerate([b"walk", b"talk", b"jump", b"x"]) for end, ids in ((b"", ()), (b"ed", (90,)), (b"ing", (91, 92)))}
    held = read_back(tmp_path, entries)
    behind = {}
    for state in range(len(held.lasts)):
        arcs = [(int(k) & 255, int(t), int(o)) for k, t, o in zip(held.keys, held.targets, held.outputs, strict=True) if int(k) >> 8 == state]
        assert behind.setdefault((int(held.lasts[state]), *arcs), state) == state
    # start; w/t, wa, wal; j, ju, jum; after the stem: one for all; e, in, i; the end.
    assert len(held.lasts) == 1 + 3 + 3 + 1 + 3 + 1


def test_empty_lexicon(tmp_path):
    is_held, sizes, numbers = read_back(tmp_path, {}).look_up([b"a", b""])
    assert not is_held.any() and not sizes.any() and not len(numbers)


def test_composed_texts_are_split_without_the_normalizer(tokenizer, library, monkeypatch):
    """Every code point below the combining marks between others; only texts beyond go through the library's normalizer."""
    import tokenizers

    seen = []

    class Watched:
        def __init__(self, inner):
            self.normalizer = self
            self.normalize_str = lambda text: seen.append(text) or inner.normalizer.normalize_str(text)

    real = Tokenizer.from_str(tokenizer.source)
    monkeypatch.setattr(tokenizers, "Tokenizer", type("T", (), {"from_str": staticmethod(lambda source: Watched(real))}))
    rnd = random.Random(6)
    texts = [f"a{c}B {c}{c}\t1{c}2 '{c}S .{c}.{c}" for c in map(chr, range(0x300))]
    texts += ["".join(rnd.choices([*map(chr, range(0x300)), *"'sStT \n"], k=40)) for _ in range(2000)]
    beyond = ["ę́ É", "ΟΔΟΣ", "К̆ かな"]
    split, merge = word_bpe.splitter(tokenizer), word_bpe.merger(tokenizer)
    for text in texts + beyond:
        assert [x for word in split(text) for x in merge(word)] == library.encode(text, add_special_tokens=False).ids
    assert seen == beyond
    other = word_bpe.splitter(word_bpe.Tokenizer(tokenizer.source, r"\s|\S", *[getattr(tokenizer, k) for k in ("end", "vocabulary", "merges", "added")]))
    assert other("A \t b") == ["a", " ", "b"] and seen == [*beyond, "A \t b"]
