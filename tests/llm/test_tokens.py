import base64
import hashlib
import random
import struct
import time

import public_tokenizers as public
import pytest
import tiktoken
from odd import documents, empty, ordered
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from claimloom.llm import byte_bpe, token_counts

RANKS = byte_bpe.read_ranks(public.path("byte_bpe_50k.tiktoken"))


@pytest.fixture(scope="module")
def odd_texts(spark):
    rnd = random.Random(1)
    rows = [(k, "".join(chr(c) + rnd.choice(["", " ", "a", "1", "."]) for c in range(a, a + 397) if not 0xD800 <= c < 0xE000)) for k, a in enumerate(range(0, 0x11000, 397))]
    rows += [(2003, "a<|endoftext|>b <|endoftext|><|endoftext|>"), (2004, "it's we'll   \n\n x"), (2004, "it's we'll   \n\n x")]
    return documents(spark, [(k, t, None, None, None) for k, t in rows])


def test_encoding_equals_the_library(spark, odd_texts):
    library = tiktoken.Encoding("own", pat_str=public.PATTERN, mergeable_ranks=RANKS, special_tokens={})
    encoded = byte_bpe.encode(odd_texts, RANKS, public.PATTERN)
    want = []
    for key, text in odd_texts.select("doc_id", "text").collect():
        ids = library.encode_ordinary(text or "")
        digest = hashlib.sha256(struct.pack(f"<{len(ids)}I", *ids)).hexdigest()
        want.append((key, len(ids), digest, hashlib.sha256((text or "").encode()).hexdigest()))
    got = byte_bpe.digests(byte_bpe.decode(encoded, RANKS)).collect()
    assert ordered(got) == ordered(want)


def test_counts_equal_the_library(spark, odd_texts):
    library = Tokenizer.from_file(public.path("byte_bpe_50k.json"))
    vocabulary = token_counts.read_vocabulary(public.path("byte_bpe_50k.json"))
    want = []
    for key, text in odd_texts.select("doc_id", "text").collect():
        n = len(library.encode(text or "", add_special_tokens=False).ids)
        want.append((key, len((text or "").encode()), n, n > 512))
    assert ordered(token_counts.counts(odd_texts, vocabulary, public.PATTERN).collect()) == ordered(want)


def test_long_words_equal_the_libraries():
    """One word of a megabyte, random and all alike."""
    library = tiktoken.Encoding("own", pat_str=public.PATTERN, mergeable_ranks=RANKS, special_tokens={})
    other = Tokenizer.from_file(public.path("byte_bpe_50k.json"))
    vocabulary = token_counts.read_vocabulary(public.path("byte_bpe_50k.json"))
    rnd = random.Random(3)
    for word in ("".join(rnd.choices("abcdefghijklmnopqrstuvwxyz", k=1_000_000)), "a" * 1_000_000):
        start = time.time()
        assert byte_bpe.word_encoder(RANKS)(word.encode()) == library.encode_ordinary(word)
        assert token_counts.word_counter(vocabulary)(word.encode()) == [len(other.encode(word, add_special_tokens=False).ids)]
        assert time.time() - start < 60


def test_whole_tokens_encode_alone():
    library = Tokenizer.from_file(public.path("byte_bpe_50k.json"))
    vocabulary = token_counts.read_vocabulary(public.path("byte_bpe_50k.json"))
    whole = token_counts.whole_tokens(vocabulary)
    assert 40_000 < len(whole) <= len(vocabulary.tokens)
    for text in sorted(whole)[::97]:
        assert token_counts.word_counter(vocabulary)(text.encode()) == [1]
        if len(library.pre_tokenizer.pre_tokenize_str(text)) == 1:
            assert len(library.encode(text, add_special_tokens=False).ids) == 1


def test_empty_table_and_null_ids(spark):
    vocabulary = token_counts.read_vocabulary(public.path("byte_bpe_50k.json"))
    assert byte_bpe.decode(byte_bpe.encode(empty(spark), RANKS, public.PATTERN), RANKS).count() == 0
    assert token_counts.counts(empty(spark), vocabulary, public.PATTERN).count() == 0
    ids = spark.createDataFrame([(1, None), (2, bytearray())], "doc_id long, ids binary")
    assert [r.decoded for r in byte_bpe.decode(ids, RANKS).orderBy("doc_id").collect()] == [None, b""]


def test_ranks_are_the_file():
    with open(public.path("byte_bpe_50k.tiktoken"), "rb") as lines:
        first = lines.readline().split()
    assert RANKS[base64.b64decode(first[0])] == int(first[1])


def test_text_comes_back(spark):
    rows = spark.createDataFrame([(1, "héllo  wörld\n"), (2, "日本語 <|x|>")], "doc_id long, text string")
    decoded = byte_bpe.decode(byte_bpe.encode(rows, RANKS, public.PATTERN), RANKS)
    assert {r.doc_id: r.t for r in decoded.select("doc_id", F.col("decoded").cast("string").alias("t")).collect()} == {1: "héllo  wörld\n", 2: "日本語 <|x|>"}
