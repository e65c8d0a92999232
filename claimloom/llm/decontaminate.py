"""Benchmark decontamination by latent semantic retrieval.

Texts are cut into overlapping passages, and items of more than ``PASSAGE`` words into equal parts of at most that many. A part is
looked for in passages of the shortest of ``SIZES`` that it fits into, so that it makes up more than half of some passage's length (8
words for 5). The term space holds the benchmark's words; passages and benchmark
items are TF-IDF vectors in it, with document frequencies counted over the passages of all distinct texts; every term has a
weight, however frequent it is. A randomised singular value decomposition
gives the latent space: each task multiplies its passages with a random matrix, sums of these small products and a
second pass with the orthonormal basis give the leading directions. It is fitted on the items and every passage of all distinct
texts, whose terms are written once and read by both passes; every passage of every text is then searched. Passages whose cosine to a part reaches
``COSINE`` and that hold ``OVERLAP`` of the part's terms are candidates; a passage with fewer terms of all parts of its size
than the least that any of them asks for can be none, so it is not projected. (Some passage holds three quarters of the part's words.)
The whole item is then compared around the place that the part gives it; places that overlap are one. It counts if the longest common subsequence of words, within a stretch of one and a half times the
item's length, covers ``COVER`` of the item, or, for paraphrases, ``LOOSE`` of it and ``ANSWER`` of its answer (its last words).

Words are runs of letters, digits and non-ASCII characters; A-Z count as a-z. The benchmark is worked through in blocks of
``ITEMS`` items, a long one counting once for each ``BYTES`` bytes, so what is sent to the tasks has a fixed size for any corpus and benchmark.

Nulls: a null text or benchmark item counts as empty; items of fewer than ``SHORTEST`` words are not looked for. Equal rows each get
their rows. Empty tables give no hits.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from claimloom.llm import shared
from claimloom.sources import scratch

PASSAGE = 64
SIZES = (8, 16, 32, PASSAGE)
RANK, EXTRA = 64, 16
ITEMS, BYTES = 1024, 512
SHORTEST = 5
COSINE = 0.5
OVERLAP = 0.4
COVER, LOOSE, ANSWER = 0.8, 0.6, 0.8
ANSWER_WORDS = 8
FIT_TEXTS = 2000
_SEED = 17
PIECE = 1 << 20  # bytes of texts or written lists that a task works on at once
_ROWS = 16  # rows of a matrix that are summed together


def _words(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    data, places = shared.raw(column)
    starts, ends, limits = shared.words(data, places, shared.punctuation_bytes())
    return shared.names(data, starts, ends, fold=True), limits


@dataclass
class Terms:
    """Sorted names of the benchmark's words; for each value of their first 16 bits how many names are below it, and how many have it."""

    names: np.ndarray
    below: np.ndarray
    count: np.ndarray

    @classmethod
    def of(cls, names: np.ndarray) -> Terms:
        names = np.unique(names)
        count = np.bincount((names >> np.uint64(48)).astype(np.int64), minlength=1 << 16).astype(np.int32)
        return cls(names, (np.cumsum(count) - count).astype(np.int32), count)

    def find(self, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places of the words that are terms, and which terms they are."""
        some = words >> np.uint64(48)
        at = np.flatnonzero(self.count[some] > 0)
        some, sought = some[at], words[at]
        term = self.below[some].astype(np.int64)
        left = np.flatnonzero(self.names[term] != sought)
        for k in range(1, self.count.max(initial=0)):  # the words that are not the k-th name with their bits
            left = left[self.count[some[left]] > k]
            term[left] += 1
            left = left[self.names[term[left]] != sought[left]]
        good = self.names[term] == sought
        return at[good], term[good]


def _passages(limits: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """First word and text of every passage of ``size`` words: one each half of that, the last one reaching the end of the text."""
    sizes, step = np.diff(limits), size // 2
    count = np.where(sizes > 0, 1 + np.maximum(0, -(-(sizes - size) // step)), 0)
    text = np.repeat(np.arange(len(sizes)), count)
    place = np.arange(len(text)) - np.repeat(np.cumsum(count) - count, count)
    return limits[:-1][text] + place * step, text


def _counted(at, term, limits, width: int, size: int = PASSAGE) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Sparse passage-term counts (passage, term, times), sorted by passage; first word and text of the passages. ``at`` and
    ``term``: places, ascending, of the words that are among the ``width`` terms, and which they are."""
    first, text = _passages(limits, size)
    owner = np.repeat(np.arange(len(limits) - 1), np.diff(np.searchsorted(at, limits)))
    count = np.bincount(text, minlength=len(limits) - 1)
    shift = max(1, int(width - 1).bit_length())
    kind = np.int32 if (len(first) + 1) << shift < 1 << 31 else np.int64  # short keys are sorted faster
    place = ((at - limits[owner]) // (size // 2)).astype(kind)
    key = (((np.cumsum(count) - count).astype(kind)[owner] + place) << shift) + term.astype(kind)
    # A word is in the passage whose first half it is in, the last half of a text excepted, and in the one before.
    keys = np.concatenate([key[place < count.astype(kind)[owner]], key[place > 0] - (1 << shift)])
    keys.sort()
    turn = np.flatnonzero(np.append(True, keys[1:] != keys[:-1])) if len(keys) else np.zeros(0, np.int64)
    found = keys[turn].astype(np.int64)
    return found >> shift, found & ((1 << shift) - 1), np.diff(np.append(turn, len(keys))), first, text


def _able(passage, term, held: np.ndarray, least: int) -> np.ndarray:
    """Of the sparse counts those of passages with ``least`` terms that are marked in ``held``."""
    if not len(passage):
        return np.zeros(0, bool)
    turn = np.flatnonzero(np.append(True, passage[1:] != passage[:-1]))
    enough = np.add.reduceat(held[term].astype(np.int32), turn) >= least
    return np.repeat(enough, np.diff(np.append(turn, len(passage))))


def _weighted(passage, term, times, idf) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    return passage, term, (np.log1p(times) * idf[term]).astype(np.float32)


def _projected(passage, term, value, basis: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The passages that have terms, and their vectors times ``basis``."""
    if not len(passage):
        return passage, np.zeros((0, basis.shape[1]), np.float32)
    turn = np.flatnonzero(np.append(True, passage[1:] != passage[:-1]))
    return passage[turn], shared.row_sums(basis, term, value, turn)


def _term_lists(terms: Terms):
    """For each text its digest, its number of words, and (place, term) of each word that is a term."""

    def run(batches):
        for batch in batches:
            for part in shared.pieces(batch, "text", PIECE):
                words, limits = _words(part.column("text"))
                at, term = terms.find(words)
                owner = np.searchsorted(limits, at, "right") - 1
                pairs = np.stack([at - limits[owner], term], 1).astype(np.int32)
                ends = (8 * np.searchsorted(at, limits)).astype(np.int32)
                lists = pa.Array.from_buffers(pa.binary(), part.num_rows, [None, pa.py_buffer(ends), pa.py_buffer(pairs)])
                yield pa.record_batch([part.column("digest"), pa.array(np.diff(limits)), lists], names=["digest", "words", "terms"])

    return shared.frugal(run)


def _lists(docs: DataFrame, terms: Terms) -> DataFrame:
    """The terms of all distinct texts, written once. Copies meet by their digest only and are combined before the exchange."""
    lists = docs.select(F.sha2("text", 256).alias("digest"), "text").mapInArrow(_term_lists(terms), "digest string, words long, terms binary")
    return scratch.written(lists.dropDuplicates(["digest"]).select("words", "terms"), "terms")


def _listed(batches, width: int):
    """Passage-term counts of written lists, piece by piece."""
    for batch in batches:
        for part in shared.pieces(batch, "terms", PIECE):
            limits = np.append(0, np.cumsum(part.column("words").to_numpy(zero_copy_only=False)))
            data, places = shared.raw(part.column("terms"))
            pairs = data.view(np.int32).reshape(-1, 2)
            at = pairs[:, 0] + np.repeat(limits[:-1], np.diff(places) // 8)
            yield _counted(at, pairs[:, 1].astype(np.int64), limits, width)


def _often(width: int):
    """In how many passages each term is; how many passages there are comes as term -1."""

    def run(batches):
        total, count = np.zeros(width, np.int64), 0
        for _, term, _, first, _ in _listed(batches, width):
            total += np.bincount(term, minlength=width)
            count += len(first)
        some = np.flatnonzero(total)
        yield pa.record_batch([pa.array(np.append(some, -1)), pa.array(np.append(total[some], count))], names=["term", "n"])

    return shared.frugal(run)


def _frequencies(docs: DataFrame, terms: Terms, lists: DataFrame | None = None) -> tuple[np.ndarray, int]:
    """In how many passages of distinct texts each term is, and how many there are. ``lists``: what ``_lists`` gave for them."""
    lists, width = _lists(docs, terms) if lists is None else lists, len(terms.names)
    counted = lists.mapInArrow(_often(width), "term long, n long")
    counts = {r["term"]: r["n"] for r in counted.groupBy("term").agg(F.sum("n").alias("n")).collect()}  # as many as the block has words
    total = counts.pop(-1, 0)
    return np.array([counts.get(k, 0) for k in range(width)]), total


def _sketch(idf: np.ndarray, basis: np.ndarray, back: bool):
    """Sum over passages of x (x B) if ``back``, else of (x B)' (x B), for unit vectors x; some rows of the matrix at a time."""

    def run(batches):
        total = np.zeros((len(idf) if back else basis.shape[1], basis.shape[1]))
        for passage, term, times, _, _ in _listed(batches, len(idf)):
            total += _product(*_weighted(passage, term, times, idf), basis, back)
        blocks = [(k, total[k : k + _ROWS]) for k in range(0, len(total), _ROWS)]
        blocks = [(k, rows.tobytes()) for k, rows in blocks if rows.any()]
        yield pa.record_batch([pa.array([k for k, _ in blocks], pa.int32()), pa.array([x for _, x in blocks], pa.binary())], names=["row", "total"])

    return shared.frugal(run)


def _added(batches):
    """Sums of the same rows of the tasks' matrices."""
    sums: dict[int, np.ndarray] = {}
    for batch in batches:
        for row, total in zip(batch.column("row").to_pylist(), batch.column("total").to_pylist(), strict=True):
            sums[row] = sums.get(row, 0) + np.frombuffer(total)
    yield pa.record_batch([pa.array(list(sums), pa.int32()), pa.array([x.tobytes() for x in sums.values()], pa.binary())], names=["row", "total"])


def _summed(lists: DataFrame, idf: np.ndarray, basis: np.ndarray, back: bool) -> np.ndarray:
    """``_sketch`` over all lists; the tasks' matrices are added in tasks, so one matrix comes back however many there are."""
    kind = "row int, total binary"
    parts = lists.mapInArrow(_sketch(idf, basis, back), kind).repartition("row").mapInArrow(_added, kind)
    out = np.zeros((len(idf) if back else basis.shape[1], basis.shape[1]))
    for r in parts.collect():
        rows = np.frombuffer(r["total"]).reshape(-1, basis.shape[1])
        out[r["row"] : r["row"] + len(rows)] = rows
    return out


def _product(passage, term, value, basis, back: bool) -> np.ndarray:
    which, y = _projected(passage, term, value, basis)
    if not len(which):
        return np.zeros((len(basis) if back else basis.shape[1], basis.shape[1]))
    at = np.cumsum(np.append(False, passage[1:] != passage[:-1]))
    size = np.sqrt(np.bincount(at, value.astype(np.float64) ** 2))
    if not back:
        y = y / size[:, None]
        return (y.T @ y).astype(np.float64)
    out = np.zeros((len(basis), basis.shape[1]))
    order = np.argsort(term.astype(np.min_scalar_type(len(basis))), kind="stable")  # 16 bits are sorted by counting
    first = np.flatnonzero(np.append(True, term[order][1:] != term[order][:-1]))
    at = at[order]
    out[term[order][first]] = shared.row_sums(y, at, value[order] / size[at] ** 2, first)
    return out


def common_length(a: list[int], b: list[int]) -> int:
    """Length of the longest common subsequence, by bit rows."""
    places: dict[int, int] = {}
    for k, x in enumerate(a):
        places[x] = places.get(x, 0) | 1 << k
    row, full = (1 << len(a)) - 1, (1 << len(a)) - 1
    for x in b:
        hit = row & places.get(x, 0)
        row = ((row + hit) | (row - hit)) & full
    return len(a) - row.bit_count()


def _parts(length: int) -> list[tuple[int, int, int]]:
    """First and end word of the parts of an item, and the size of the passages that they are looked for in."""
    count = -(-length // PASSAGE)
    cuts = [length * k // count for k in range(count + 1)]
    return [(a, b, min(x for x in SIZES if x >= b - a)) for a, b in zip(cuts[:-1], cuts[1:], strict=True)]


@dataclass
class Index:
    """``parts``: item, first word in it and passage size of each part; ``latent``: its vector; ``held``: sorted numbers (part times
    number of terms, plus term) of the terms that the parts hold."""

    ids: list
    items: list[np.ndarray]
    terms: Terms
    idf: np.ndarray
    basis: np.ndarray
    parts: np.ndarray
    latent: np.ndarray
    held: np.ndarray

    def near(self, words: np.ndarray, limits: np.ndarray, cosine: float = COSINE):
        """Candidates (word at which the item would begin, text, item, cosine)."""
        need = np.maximum(1, np.ceil(OVERLAP * np.bincount(self.held // len(self.idf), minlength=len(self.parts))))
        at, known = self.terms.find(words)
        for size in np.unique(self.parts[:, 2]).tolist():
            mine = np.flatnonzero(self.parts[:, 2] == size)
            passage, term, times, first, text = _counted(at, known, limits, len(self.idf), size)
            held = np.zeros(len(self.idf), bool)
            held[(self.held % len(self.idf))[np.isin(self.held // len(self.idf), mine)]] = True
            able = _able(passage, term, held, need[mine].min())
            passage, term, value = _weighted(passage[able], term[able], times[able], self.idf)
            which, y = _projected(passage, term, value, self.basis)
            y /= np.maximum(np.linalg.norm(y, axis=1), 1e-12)[:, None]
            ends = np.append(np.searchsorted(passage, which), len(passage))
            latent, rows = self.latent[mine].T, max(1, (1 << 23) // len(mine))
            for a in range(0, len(which), rows):
                close = y[a : a + rows] @ latent
                row, part = np.divmod(np.flatnonzero(close >= cosine), len(mine))
                for b in range(0, len(row), 1 << 15):
                    r, m = a + row[b : b + (1 << 15)], mine[part[b : b + (1 << 15)]]
                    good = np.flatnonzero(self._shared(m, ends[r], ends[r + 1], term) >= need[m])
                    cosines = close[row[b + good], part[b + good]]
                    for p, k, c in zip(which[r[good]].tolist(), m[good].tolist(), cosines.tolist(), strict=True):
                        item, offset, _ = self.parts[k].tolist()
                        yield int(first[p]) - offset, int(text[p]), item, c

    def _shared(self, part: np.ndarray, begin: np.ndarray, end: np.ndarray, term: np.ndarray) -> np.ndarray:
        """For each part how many of the terms from ``begin`` to ``end`` it holds."""
        sizes = end - begin
        heads = np.cumsum(sizes) - sizes
        entry = np.repeat(begin - heads, sizes) + np.arange(sizes.sum())
        keys = np.repeat(part, sizes) * len(self.idf) + term[entry]
        at = np.minimum(np.searchsorted(self.held, keys), len(self.held) - 1)
        before = np.append(0, np.cumsum(self.held[at] == keys))
        return before[heads + sizes] - before[heads]

    def verified(self, item: int, part: np.ndarray) -> tuple[float, float, int, int]:
        """Best share of the item and of its answer in a stretch of the part, and where that stretch is."""
        told = self.items[item]
        length, known = len(told), np.unique(told)
        a = np.searchsorted(known, told).tolist()
        at = np.minimum(np.searchsorted(known, part), len(known) - 1)
        inside = known[at] == part
        before, b = np.append(0, np.cumsum(inside)).tolist(), at[inside].tolist()
        stretch, best = max(length, length * 3 // 2), (0.0, 0.0, 0, 0)
        for start in range(0, max(1, len(part) - length + 1), max(1, length // 4)):
            end = min(start + stretch, len(part))
            most = (before[end] - before[start]) / length
            if most < LOOSE or most <= best[0]:
                continue
            some = b[before[start] : before[end]]
            share = common_length(a, some) / length
            if share >= LOOSE and share > best[0]:
                tail = a[-ANSWER_WORDS:]
                best = (share, common_length(tail, some) / len(tail), start, end)
        return best

    def hits(self, column: pa.Array) -> list[tuple]:
        """(text, item, first word, end word, cosine, share, answer share) of every item found in a text, its best stretch."""
        words, limits = _words(column)
        places: dict[tuple[int, int], list] = {}
        for start, text, item, cosine in self.near(words, limits):
            places.setdefault((text, item), []).append((start, cosine))
        found: dict[tuple[int, int], tuple] = {}
        for (text, item), spots in places.items():
            length = len(self.items[item])
            slack, regions = length // 2 + min(PASSAGE, 2 * length), []
            for start, cosine in sorted(spots):
                a, b = max(limits[text], start - slack), min(limits[text + 1], start + length + slack)
                if regions and a <= regions[-1][1]:
                    regions[-1] = (regions[-1][0], max(b, regions[-1][1]), max(cosine, regions[-1][2]))
                else:
                    regions.append((a, b, cosine))
            for a, b, cosine in regions:
                share, answer, start, end = self.verified(item, words[a:b])
                if share >= COVER or (share >= LOOSE and answer >= ANSWER):
                    place = int(a - limits[text])
                    new = (share, cosine, answer, place + start, place + end)
                    found[text, item] = max(found.get((text, item), new), new)
        return [(int(t), int(i), x[3], x[4], x[1], x[0], x[2]) for (t, i), x in sorted(found.items())]


def _fit_texts(docs: DataFrame) -> DataFrame:
    """About ``FIT_TEXTS`` to twice as many distinct texts, each once, however many copies it has: for a look at a corpus. The
    operator does not use it; its space is fitted on all texts."""
    distinct = docs.agg(F.approx_count_distinct("text")).first()[0]
    chosen = F.pmod(F.xxhash64("text", F.lit(_SEED)), F.lit(max(1, distinct // FIT_TEXTS))) == 0
    return docs.select("text").filter(chosen).dropDuplicates(["text"])


def _block_index(docs: DataFrame, rows: list) -> Index | None:
    """The index of one block of benchmark rows (item_id, text)."""
    words, limits = _words(pa.array([r["text"] or "" for r in rows], pa.string()))
    kept = [k for k in range(len(rows)) if limits[k + 1] - limits[k] >= SHORTEST]
    if not kept:
        return None
    items = [words[limits[k] : limits[k + 1]] for k in kept]
    terms = Terms.of(np.concatenate(items))
    lists = _lists(docs, terms)
    often, total = _frequencies(docs, terms, lists)
    idf = (np.log((1 + total) / (1 + often)) + 1).astype(np.float32)
    parts = [(k, *part) for k, x in enumerate(items) for part in _parts(len(x))]
    pairs = [np.unique(terms.find(items[k][a:b])[1], return_counts=True) for k, a, b, _ in parts]
    owner = np.repeat(np.arange(len(parts)), [len(t) for t, _ in pairs])
    vectors = _weighted(owner, np.concatenate([t for t, _ in pairs]), np.concatenate([n for _, n in pairs]), idf)

    def summed(basis: np.ndarray, back: bool) -> np.ndarray:
        corpus = _summed(lists, idf, basis, back)
        # The items weigh as much as the passages, so that the space can tell them apart.
        mine = _product(*vectors, basis, back)
        return corpus / max(np.abs(corpus).sum(), 1e-12) + mine / max(np.abs(mine).sum(), 1e-12)

    wide = min(len(terms.names), RANK + EXTRA)
    random = np.random.default_rng(_SEED).standard_normal((len(idf), wide)).astype(np.float32)
    span, _ = np.linalg.qr(summed(random, True))
    span = span.astype(np.float32)
    values, turn = np.linalg.eigh(summed(span, False))
    basis = (span @ turn[:, np.argsort(-values)[:RANK]]).astype(np.float32)
    which, latent = _projected(*vectors, basis)
    full = np.zeros((len(parts), basis.shape[1]), np.float32)
    full[which] = latent / np.maximum(np.linalg.norm(latent, axis=1), 1e-12)[:, None]
    held = owner * len(idf) + vectors[1]
    return Index([rows[k]["item_id"] for k in kept], items, terms, idf, basis, np.array([(k, a, size) for k, a, _, size in parts]), full, held)


def _indexes(docs: DataFrame, benchmark: DataFrame):
    told = benchmark.select("item_id", "text")
    parts = F.greatest(F.lit(1), F.ceil(F.octet_length(F.coalesce("text", F.lit(""))) / BYTES))
    blocks = -(-(told.agg(F.sum(parts)).first()[0] or 0) // (ITEMS // 2))  # blocks by hash, half full on average
    place = F.pmod(F.xxhash64("item_id", "text"), F.lit(max(1, blocks)))
    for k in range(blocks):
        index = _block_index(docs, told.filter(place == k).orderBy("item_id", "text").collect())
        if index is not None:
            yield index


def _found(index: Index, kind: pa.DataType):
    names = ["doc_id", "item", "first_word", "end_word", "cosine", "share", "answer_share"]

    def run(batches):
        for batch in batches:
            for part in shared.pieces(batch, "text", PIECE):
                hits, ids = index.hits(part.column("text")), part.column("doc_id").to_pylist()
                columns = [pa.array([ids[h[0]] for h in hits], part.column("doc_id").type)]
                columns.append(pa.array([index.ids[h[1]] for h in hits], kind))
                columns += [pa.array([h[k] for h in hits], pa.int64() if k < 4 else pa.float64()) for k in range(2, 7)]
                yield pa.record_batch(columns, names=names)

    return shared.frugal(run)


def leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """One row for each benchmark item found in a row of ``docs`` (doc_id, text): doc_id, item_id, first_word, end_word (the
    stretch of words that was verified), cosine, share (of the item), answer_share."""
    from pyspark.sql.pandas.types import to_arrow_type

    docs = docs.select("doc_id", "text")
    kind, key = benchmark.schema["item_id"].dataType, docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {key}, item_id {kind.simpleString()}, first_word long, end_word long, cosine double, share double, answer_share double"
    out = docs.sparkSession.createDataFrame([], schema)
    for index in _indexes(docs, benchmark):
        out = out.union(docs.mapInArrow(_found(index, to_arrow_type(kind)), schema))
    return out


def _clean(index: Index):
    def run(batches):
        for batch in batches:
            for part in shared.pieces(batch, "text", PIECE):
                keep = np.ones(part.num_rows, bool)
                keep[[h[0] for h in index.hits(part.column("text"))]] = False
                yield part.filter(pa.array(keep))

    return shared.frugal(run)


def without_leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``docs``, all columns as they are, in whose text no benchmark item is found."""
    out = docs
    for index in _indexes(docs, benchmark):
        out = out.mapInArrow(_clean(index), T.StructType(docs.schema.fields))
    return out
