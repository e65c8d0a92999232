"""Encoding and decoding with a word-level BPE (word-end marks, normalised words) by a lexicon of frequent words.

1. The distinct words of each piece of text are counted in the tasks and summed over the corpus.
2. The most frequent ones are merged once and compiled into a minimal acyclic transducer (see ``lexicon``). Which
   ones is told by a table of frequency classes (sixteen to a doubling), so that no task sorts the words; the highest classes that have at
   most ``LEXICON`` words together are taken. This bounds what the driver builds, not what is encoded.
3. The file is written to the shared folder and handed to every executor by Spark; its workers map it. Encoding is one
   scan of the texts without a shuffle: a piece's distinct words are looked up together, and words that the lexicon does not
   hold are merged exactly, each once in a piece and, while the task's table of ``KNOWN`` words has room, once in a task.

Texts are normalised and split as the tokenizer file says; strings of its added tokens inside a text are those tokens.
Null texts count as empty and encode to no ids; equal rows each get a row; a null id is an id like any other. Words of any length
are merged in time n log n. Columns other than the id and text are ignored. An empty table gives an empty lexicon and no rows.
"""

from __future__ import annotations

import array
import json
import re
import uuid
from collections import Counter
from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyarrow import fs
from pyspark import SparkFiles
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from claimloom.llm import lexicon, pretokens, shared, token_counts
from claimloom.sources import scratch

#: Words that the lexicon holds at most.
LEXICON = 1 << 16
#: Longest word of the lexicon, in bytes of UTF-8.
LONGEST = 64
#: Merged words that a task remembers at most.
KNOWN = 1 << 18
#: Scripts in which the pattern library's letters and digits are those of the tokenizer library, whatever their Unicode versions.
_COMMON = regex.compile("[\x00-ԯ]*")
#: Scripts whose texts are composed as they stand (no combining marks, none with another form), with one small letter for each capital.
_COMPOSED = re.compile("[\x00-\u02ff]*")
#: Steps of normalising that such a text needs only the last of, and the words for which this holds: none has a blank in it.
_STEPS = [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "}, {"type": "Lowercase"}]
_WORDS = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"


@dataclass(frozen=True)
class Tokenizer:
    source: str  # the tokenizer file
    pattern: str
    end: str
    vocabulary: dict[str, int]
    merges: dict[tuple[str, str], int]
    added: dict[str, int]


def read(path: str) -> Tokenizer:
    """A tokenizer file whose words are the matches of one pattern and whose model merges byte letters with a word-end mark."""
    with open(path, encoding="utf-8") as file:
        source = file.read()
    told = json.loads(source)
    split, model = told["pre_tokenizer"]["pretokenizers"][0], told["model"]
    pairs = [x.split(" ") if isinstance(x, str) else x for x in model["merges"]]
    return Tokenizer(
        source,
        split["pattern"]["Regex"],
        model["end_of_word_suffix"],
        model["vocab"],
        {(a, b): k for k, (a, b) in enumerate(pairs)},
        {x["content"]: x["id"] for x in told["added_tokens"]},
    )


def splitter(tokenizer: Tokenizer) -> Callable[[str], list[str]]:
    """A function from a text to its words; an added token comes as its string after a blank, which no word holds."""
    import tokenizers

    normalize = tokenizers.Tokenizer.from_str(tokenizer.source).normalizer.normalize_str
    find = regex.compile(tokenizer.pattern).findall
    every = tokenizers.pre_tokenizers.Split(tokenizers.Regex(tokenizer.pattern), "removed", invert=True).pre_tokenize_str
    added = re.compile("|".join(map(re.escape, tokenizer.added)) or "(?!)")
    quick = tokenizer.pattern == _WORDS and json.loads(tokenizer.source)["normalizer"] == {"type": "Sequence", "normalizers": _STEPS}

    def plain(text: str) -> list[str]:
        if quick and _COMPOSED.fullmatch(text):
            return find(text.lower())
        text = normalize(text)
        return find(text) if _COMMON.fullmatch(text) else [word for word, _ in every(text)]

    def split(text: str) -> list[str]:
        found, at = [], 0
        for match in added.finditer(text):
            found += plain(text[at : match.start()])
            found.append(" " + match.group())
            at = match.end()
        return found + plain(text[at:]) if at else plain(text)

    return split


def merger(tokenizer: Tokenizer) -> Callable[[str], list[int]]:
    """A function from a word to its ids, by merging."""
    letter, rank = token_counts.byte_letters(), lambda a, b: tokenizer.merges.get((a, b))

    def ids(word: str) -> list[int]:
        letters = [letter[b] for b in word.encode()]
        letters[-1] += tokenizer.end
        return [tokenizer.vocabulary[x] for x in pretokens.merged(letters, rank)]

    return ids


def _counted(load: Callable[[], Tokenizer]):
    def run(batches):
        split = splitter(load())
        for batch in batches:
            for part in shared.pieces(batch, "text"):
                counts: Counter[str] = Counter()
                for text in part.column("text").to_pylist():
                    counts.update(split(text))
                yield pa.record_batch([pa.array(list(counts), pa.string()), pa.array(list(counts.values()), pa.int64())], names=["word", "n"])

    return shared.frugal(run)


def word_counts(docs: DataFrame, tokenizer: Tokenizer) -> DataFrame:
    """(word, n) over all texts; added tokens come after a blank."""
    shipped = docs.sparkSession.sparkContext.broadcast(tokenizer)
    found = docs.select(F.coalesce("text", F.lit("")).alias("text")).mapInArrow(_counted(lambda: shipped.value), "word string, n long")
    return found.groupBy("word").agg(F.sum("n").alias("n"))


def frequent(counts: DataFrame, limit: int = LEXICON) -> list[str]:
    """Words of the highest frequency classes, at most ``limit`` together, that are not longer than ``LONGEST`` bytes."""
    counts = counts.filter(~F.startswith("word", F.lit(" ")) & (F.octet_length("word") <= LONGEST))
    level = F.floor(16 * F.log2("n"))
    taken, least = 0, None
    for row in sorted(counts.groupBy(level.alias("level")).count().collect(), key=lambda row: -row.level):
        taken += row["count"]
        if taken > limit:
            break
        least = row.level
    return [] if least is None else [row.word for row in counts.filter(level >= least).select("word").collect()]


def compiled(words: list[str], tokenizer: Tokenizer) -> bytes:
    """The lexicon's file."""
    ids = merger(tokenizer)
    return lexicon.build((word, tuple(ids(word.decode()))) for word in sorted(word.encode() for word in words))


def _shipped(spark, file: bytes) -> str:
    """Name under which every executor has the file."""
    name = f"lexicon-{uuid.uuid4().hex[:16]}"
    path = f"{scratch.root(spark)}/{name}"
    system, place = fs.FileSystem.from_uri(path if ":" in path else f"file://{path}")
    with system.open_output_stream(place) as out:
        out.write(file)
    spark.sparkContext.addFile(path)
    return name


def _encoded(load: Callable[[], Tokenizer], name: str, key: str, kind: pa.DataType):
    def run(batches):
        tokenizer = load()
        split, merge, known = splitter(tokenizer), merger(tokenizer), {}
        held = lexicon.Lexicon(SparkFiles.get(name))

        def unseen(word: str) -> list[int]:
            if word.startswith(" "):
                return [tokenizer.added[word[1:]]]
            if word not in known:
                ids = merge(word)
                if len(known) < KNOWN and len(word) <= LONGEST:
                    known[word] = ids
                return ids
            return known[word]

        for batch in batches:
            for part in shared.pieces(batch, "text"):
                numbers, order, ends = pretokens._Numbers(), array.array("I"), [0]
                for text in part.column("text").to_pylist():
                    order.extend(map(numbers.__getitem__, split(text)))
                    ends.append(len(order))
                words = list(numbers)
                is_held, sizes, values = held.look_up([word.encode() for word in words])
                rest = [unseen(words[k]) for k in np.flatnonzero(~is_held).tolist()]
                starts = np.cumsum(sizes) - sizes
                sizes[~is_held] = [len(ids) for ids in rest]
                starts[~is_held] = len(values) + np.cumsum(sizes[~is_held]) - sizes[~is_held]
                values = np.concatenate([values, np.fromiter((x for ids in rest for x in ids), np.uint32)])
                order = np.frombuffer(order, np.uint32)
                ids = pretokens.gather(values, starts, sizes, order).astype(np.int32)
                places = np.append(0, np.cumsum(sizes[order]))[ends].astype(np.int32)
                column = pa.ListArray.from_arrays(pa.array(places), pa.array(ids))
                yield pa.record_batch([part.column(key).cast(kind), column], names=[key, "ids"])

    return shared.frugal(run)


def encode(docs: DataFrame, tokenizer: Tokenizer, key: str = "doc_id", limit: int = LEXICON) -> DataFrame:
    """One row for each row of ``docs`` (``key`` and text): ``key``, ids (array of int)."""
    from pyspark.sql.pandas.types import to_arrow_type

    spark, field = docs.sparkSession, docs.schema[key]
    counts = scratch.written(word_counts(docs, tokenizer), "words")
    name = _shipped(spark, compiled(frequent(counts, limit), tokenizer))
    shipped = spark.sparkContext.broadcast(tokenizer)
    texts = docs.select(key, F.coalesce("text", F.lit("")).alias("text"))
    run = _encoded(lambda: shipped.value, name, key, to_arrow_type(field.dataType))
    return texts.mapInArrow(run, f"`{key}` {field.dataType.simpleString()}, ids array<int>")


#: Ids that are turned into text at a time; a longer row is a part of its own.
PART = 1 << 20


def _decoded(load: Callable[[], Tokenizer]):
    def run(batches):
        tokenizer = load()
        told = {number: token for token, number in (tokenizer.vocabulary | tokenizer.added).items()}
        tokens = pa.array([told.get(k) for k in range(max(told) + 1)], pa.string())
        for batch in batches:
            column = batch.schema.get_field_index("ids")
            sizes = pc.fill_null(pc.list_value_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
            parts = (np.cumsum(sizes, dtype=np.int64) - sizes) // PART
            cuts = [0, *(np.flatnonzero(np.diff(parts)) + 1).tolist(), batch.num_rows] if batch.num_rows else []
            for start, end in zip(cuts, cuts[1:], strict=False):
                part = batch.slice(start, end - start)
                ids = part.column(column)
                ends = np.append(0, np.cumsum(sizes[start:end])).astype(np.int32)
                lists = pa.ListArray.from_arrays(pa.array(ends), tokens.take(ids.flatten()))
                texts = pc.if_else(ids.is_valid(), pc.binary_join(lists, " "), pa.scalar(None, pa.string()))
                yield pa.record_batch([*part.columns, texts], names=[*part.schema.names, "decoded"])

    return shared.frugal(run)


def decode(encoded: DataFrame, tokenizer: Tokenizer) -> DataFrame:
    """``encoded`` and the text of its ids, as ``decoded``: the tokens' strings with blanks between, as the file names no decoder."""
    shipped = encoded.sparkSession.sparkContext.broadcast(tokenizer)
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in encoded.schema.fields)
    return encoded.mapInArrow(_decoded(lambda: shipped.value), f"{kinds}, decoded string")


def digests(decoded: DataFrame, key: str = "doc_id") -> DataFrame:
    """``key``, n_tokens, ids_sha256 (decimal ids with a blank between), decoded_sha256."""
    return decoded.select(
        key,
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )
