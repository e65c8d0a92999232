"""Toxicity of whole texts by a subsequence string kernel, Nystroem landmarks and a support vector machine.

The kernel of two words sums over all three-character subsequences that both hold (at most ``SPAN`` characters from first
to last), each weighted by ``DECAY`` to the power of its span in either word. An insult with inserted characters keeps most of
its subsequences, so it stays close to the plain one. Words begin with a boundary mark, so word beginnings count; runs of
single characters (spelled-out words) are read as one word too. Landmarks are the words and word beginnings that set the
labelled toxic texts most apart from the others. A text's feature for a landmark is the root of the mean, over its words, of the cubed
kernel (landmark's own kernel = 1); the features are whitened with the landmarks' kernel matrix (Nystroem) and separated by
a linear support vector machine with squared hinge loss, whose margin a logistic curve turns into a score.

Training reads at most ``MAX_LABELLED`` labelled texts of at most ``MAX_BYTES`` each, those with the smallest hash of the id; scoring
reads every text whole. Words are scored once per task and block, not once per occurrence.

Nulls: a null text counts as empty, a null label or id is not trained on. Without labels of both kinds every score is the share of
toxic labels (0 without any). Equal rows each get a row.
"""

from __future__ import annotations

import array
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from claimloom.llm import shared

SPAN = 7
DECAY = 0.75
LANDMARKS = 48
MAX_LABELLED = 3000
MAX_BYTES = 1 << 18
#: A landmark is in so many toxic texts at least, and its shares differ by so many deviations.
FEWEST, APART = 4, 4.0
LEAST = 0.02
WIDTHS = (12, 32)
OVERLAP = 8
KNOWN_WORDS = 200_000
#: Bytes of text that are scored at once; all of their words may be new to the table.
PIECE = 1 << 20
_CHUNK = 20_000
_EDGES = "".join(chr(b) for b in range(33, 127) if not chr(b).isalnum())


def plain(word: str) -> str:
    return word.lower().strip(_EDGES)


@dataclass
class Model:
    landmarks: list[str]
    keys: np.ndarray
    slots: np.ndarray
    features: np.ndarray
    whiten: np.ndarray
    weights: np.ndarray
    curve: tuple[float, float]
    constant: float | None = None


def _letters(words: list[str], width: int) -> np.ndarray:
    return np.array(words, f"<U{width}").view(np.uint32).reshape(len(words), width)


def _subsequences(letters: np.ndarray):
    """Key, word and weight of every three-character subsequence, one gap pattern after the other."""
    width = letters.shape[1]
    one, two, three = (letters * np.uint32(odd) for odd in (0x9E3779B1, 0x85EBCA77, 0xC2B2AE3D))
    for last in range(2, min(SPAN, width)):
        there = letters[:, last:] != 0
        for middle in range(1, last):
            key = one[:, : width - last] ^ (two[:, middle : width - last + middle] << np.uint32(1)) ^ (three[:, last:] >> np.uint32(1))
            yield key * np.uint32(0x27D4EB2F), there, DECAY ** (last + 1)


def _index(landmarks: list[str]):
    """The landmarks' subsequences: sorted keys, a table from 16 key bits to the first key with them, and weights by landmark."""
    letters, found = _letters(landmarks, max([3, *map(len, landmarks)])), [Counter() for _ in landmarks]
    for key, there, weight in _subsequences(letters):
        for n, place in zip(*np.nonzero(there), strict=True):
            found[n][int(key[n, place])] += weight
    keys = np.array(sorted({k for c in found for k in c}), np.uint32)
    weights = np.zeros((len(keys), len(landmarks)), np.float32)
    for n, c in enumerate(found):
        for k, w in c.items():
            weights[np.searchsorted(keys, k), n] = w
    own = (weights**2).sum(axis=0)
    slots = np.zeros(1 << 16, bool)
    slots[keys >> np.uint32(16)] = True
    return keys, slots, weights / np.maximum(own, 1e-9)


def closeness(words: list[str], keys: np.ndarray, slots: np.ndarray, features: np.ndarray) -> np.ndarray:
    """Row by row the kernel of each word with each landmark, in units of the landmark's own."""
    out = np.zeros((len(words), features.shape[1]), np.float32)
    size = np.array([len(w) for w in words])
    for at, width in enumerate(WIDTHS):
        pick = np.flatnonzero((size <= width) & (size > (WIDTHS[at - 1] if at else 0)))
        for start in range(0, len(pick), _CHUNK):
            part = pick[start : start + _CHUNK]
            out[part] = _close([words[k] for k in part], width, keys, slots, features)
    for k in np.flatnonzero(size > WIDTHS[-1]):  # long words piece by piece
        step = WIDTHS[-1] - OVERLAP
        pieces = [words[k][i : i + WIDTHS[-1]] for i in range(0, len(words[k]) - OVERLAP, step)]
        for start in range(0, len(pieces), _CHUNK):
            out[k] = np.maximum(out[k], _close(pieces[start : start + _CHUNK], WIDTHS[-1], keys, slots, features).max(axis=0))
    return out


def _close(words: list[str], width: int, keys, slots, features) -> np.ndarray:
    rows, found, weights = [], [], []
    for key, there, weight in _subsequences(_letters(words, width)):
        row, place = np.nonzero(slots[key >> np.uint32(16)] & there)
        key = key[row, place]
        at = np.minimum(np.searchsorted(keys, key), max(len(keys) - 1, 0))
        hit = keys[at] == key if len(keys) else np.zeros(0, bool)
        rows.append(row[hit])
        found.append(at[hit])
        weights.append(np.full(int(hit.sum()), weight, np.float32))
    row, at, weight = np.concatenate(rows), np.concatenate(found), np.concatenate(weights)
    out = np.zeros((len(words), features.shape[1]), np.float32)
    enough = np.bincount(row, minlength=len(words)) >= 3
    keep = enough[row]
    row, at, weight = row[keep], at[keep], weight[keep]
    order = np.argsort(row, kind="stable")
    row, at, weight = row[order], at[order], weight[order]
    if len(row):
        first = np.flatnonzero(np.append(True, row[1:] != row[:-1]))
        out[row[first]] = shared.row_sums(features, at, weight, first)
    return out


class _Words(dict):
    """Numbers of words; new ones are kept for ``rows``."""

    def __missing__(self, word):
        self[word] = number = len(self)
        return number


class _Scorer:
    """Features of texts. Words are known across texts, up to ``KNOWN_WORDS``; then the table starts anew."""

    def __init__(self, keys, slots, features):
        self.index, self.words, self.table, self.single = (keys, slots, features), _Words(), None, None

    def _cubed(self, words: list[str]) -> np.ndarray:
        near = np.clip(closeness(["^" + plain(w) for w in words], *self.index), 0, 1) ** 3
        near[near < LEAST] = 0
        return near

    def features(self, texts: list[str]) -> np.ndarray:
        if len(self.words) > KNOWN_WORDS:
            self.words, self.table = _Words(), None
        order, ends, before = array.array("I"), [0], len(self.words)
        for text in texts:
            order.extend(map(self.words.__getitem__, text.split()))
            ends.append(len(order))
        new = list(self.words)[before:]
        near = self._cubed(new) if new else np.zeros((0, self.index[2].shape[1]), np.float32)
        single = np.array([len(w) == 1 for w in new], bool)
        self.table = near if self.table is None else np.concatenate([self.table, near])
        self.single = single if before == 0 else np.concatenate([self.single, single])
        order, ends = np.frombuffer(order, np.uint32).astype(np.int64), np.array(ends)
        out = np.zeros((len(texts), self.table.shape[1]), np.float32)
        hit = np.flatnonzero(self.table.any(axis=1)[order]) if len(order) else np.zeros(0, np.int64)
        np.add.at(out, np.searchsorted(ends, hit, "right") - 1, self.table[order[hit]])
        self._spelled(texts, order, ends, out)
        return np.sqrt(out / np.maximum(np.diff(ends), 1)[:, None])

    def _spelled(self, texts: list[str], order, ends, out) -> None:
        alone = np.append(False, np.append(self.single[order], False)) if len(order) else np.zeros(2, bool)
        turn = np.flatnonzero(alone[1:] != alone[:-1]).reshape(-1, 2)
        runs = turn[turn[:, 1] - turn[:, 0] >= 3]
        if not len(runs):
            return
        names, words, owner = list(self.words), [], []
        for a, b in runs.tolist():
            for text in range(np.searchsorted(ends, a, "right") - 1, np.searchsorted(ends, b, "left")):
                part = order[max(a, ends[text]) : min(b, ends[text + 1])]
                if len(part) >= 3:
                    words.append("".join(names[k] for k in part))
                    owner.append(text)
        if words:
            np.add.at(out, owner, self._cubed(words))


def _landmarks(texts: list[str], labels: np.ndarray) -> list[str]:
    """Words and word beginnings with the largest difference of shares between toxic and other texts."""
    seen = (Counter(), Counter())
    for text, label in zip(texts, labels, strict=True):
        words = {plain(w) for w in text.split()}
        seen[int(label)].update({"^" + w[:k] for w in words for k in {*range(3, 9), len(w)} if 3 <= k <= len(w) <= 40})
    other, toxic = seen
    n, m = max(1, int((labels == 0).sum())), max(1, int((labels == 1).sum()))
    ranked = []
    for word, a in toxic.items():
        if a < FEWEST:
            continue
        share = (a + other[word]) / (n + m)
        apart = (a / m - other[word] / n) / np.sqrt(max(share * (1 - share), 1e-9) * (1 / n + 1 / m))
        ranked.append((-apart, word))
    chosen: list[str] = []
    for apart, word in sorted(ranked):
        if len(chosen) == LANDMARKS or -apart < APART:
            break
        if not any(word.startswith(c) or c.startswith(word) for c in chosen):
            chosen.append(word)
    return chosen


def _separate(x: np.ndarray, y: np.ndarray, cost: float = 1.0) -> np.ndarray:
    """Linear support vector machine with squared hinge loss, both classes weighing the same; the last weight is the offset. Newton
    steps on the active rows."""
    x = np.column_stack([x, np.ones(len(x))])
    sign = np.where(y > 0, 1.0, -1.0)
    weight = cost * len(y) / (2 * np.where(y > 0, max((y > 0).sum(), 1), max((y <= 0).sum(), 1)))
    w, ridge = np.zeros(x.shape[1]), np.diag(np.append(np.ones(x.shape[1] - 1), 1e-6))
    for turn in range(50):
        active = sign * (x @ w) < 1
        a = x[active] * weight[active, None]
        new = np.linalg.solve(ridge + a.T @ x[active], a.T @ sign[active])
        if np.abs(new - w).max() < 1e-8:
            break
        w = (w + new) / 2 if turn > 10 else new  # damped, should the active rows alternate
    return w


def _curve(margin: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope and offset of the logistic curve from margin to label."""
    x, w = np.column_stack([margin, np.ones(len(margin))]), np.zeros(2)
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        g = x.T @ (p - y) + 1e-3 * w
        h = (x * (p * (1 - p))[:, None]).T @ x + 1e-3 * np.eye(2)
        step = np.linalg.solve(h, g)
        w -= step
        if np.abs(step).max() < 1e-9:
            break
    return float(w[0]), float(w[1])


def train(texts: list[str], labels: list[int]) -> Model:
    y = np.array(labels, np.float64)
    chosen = _landmarks(texts, y) if len(y) else []
    if not chosen or y.min() == y.max():
        none = np.zeros(0, np.float32)
        return Model([], none, none, none, none, none, (0.0, 0.0), float(y.mean()) if len(y) else 0.0)
    keys, slots, features = _index(chosen)
    near = np.clip(closeness(chosen, keys, slots, features), 0, 1) ** 3
    values, vectors = np.linalg.eigh((near + near.T) / 2 + 0.1 * np.eye(len(chosen)))
    whiten = vectors @ np.diag(np.maximum(values, 0.05) ** -0.5) @ vectors.T
    scorer, rows = _Scorer(keys, slots, features), []
    for k in range(0, len(texts), 200):
        rows.append(scorer.features(texts[k : k + 200]))
    x = np.concatenate(rows) @ whiten
    scale = 1 / max(float(np.sqrt((x**2).sum(axis=1).mean())), 1e-9)
    weights = _separate(x * scale, y, cost=10.0)
    weights[:-1] *= scale
    margin = x @ weights[:-1] + weights[-1]
    return Model(chosen, keys, slots, features, whiten, weights, _curve(margin, y))


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def fit(docs: DataFrame, labels: DataFrame) -> Model:
    """The model of the labelled rows of ``docs`` that are not held out."""
    some = labels.select("doc_id", "toxic").filter("doc_id IS NOT NULL AND toxic IS NOT NULL").filter(~held_out(F.col("doc_id")))
    some = some.groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    some = some.orderBy(F.xxhash64("doc_id"), "doc_id").limit(MAX_LABELLED)
    text = docs.select("doc_id", "text").filter(F.octet_length("text") <= MAX_BYTES)
    rows = text.join(F.broadcast(some), "doc_id").groupBy("doc_id").agg(F.min("text").alias("text"), F.max("toxic").alias("toxic"))
    found = rows.orderBy("doc_id").collect()  # MAX_LABELLED rows at most
    return train([r["text"] for r in found], [int(r["toxic"]) for r in found])


def _scored(model: Model):
    def run(batches):
        scorer = _Scorer(model.keys, model.slots, model.features) if model.constant is None else None
        for batch in batches:
            for part in shared.pieces(batch, "text", PIECE):
                if scorer is None:
                    score = np.full(part.num_rows, model.constant)
                else:
                    x = scorer.features([t or "" for t in part.column("text").to_pylist()]) @ model.whiten
                    margin = x @ model.weights[:-1] + model.weights[-1]
                    score = 1 / (1 + np.exp(-np.clip(model.curve[0] * margin + model.curve[1], -30, 30)))
                yield pa.record_batch([*part.columns, pa.array(score, pa.float64())], names=[*part.schema.names, "_score"])

    return shared.frugal(run)


def scored(docs: DataFrame, model: Model) -> DataFrame:
    """``docs`` with all of its columns and ``_score``, the likelihood from 0 to 1 that the text is toxic."""
    return docs.mapInArrow(_scored(model), T.StructType([*docs.schema.fields, T.StructField("_score", T.DoubleType())]))


def without_toxic(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs`` with a score below 0.5, all columns as they are."""
    return scored(docs, fit(docs, labels)).filter("_score < 0.5").select(*docs.columns)
