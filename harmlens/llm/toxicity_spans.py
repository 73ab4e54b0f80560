"""Toxic spans by a linear-chain conditional random field.

Token labels come from labelled documents outside the held-out fold: a token counts as toxic where its
word or one of its prefixes is far more frequent in toxic than in clean documents (likelihood-ratio
test with Bonferroni-like threshold, near copies counted once). The CRF is trained on those tags with
word, prefix, suffix and shape features; forward-backward marginals of every token give the spans, and a
logistic calibration of their maximum and sum gives the document score.

Null and empty texts have no tokens and get the calibrated score of zero marginals. Offsets count code
points, end exclusive.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from harmlens.llm import chain, logistic
from harmlens.llm.batches import Texts, attach, mix, texts_of
from harmlens.llm.labels import training_sample

FOLDS, HELD_OUT = 3, 1
SCORE, SPANS = "__toxicity_score", "__toxic_spans"
SPAN = T.ArrayType(T.StructType([T.StructField("start", T.LongType()), T.StructField("end", T.LongType()), T.StructField("p", T.DoubleType())]))
EDGES = "".join(chr(c) for c in range(33, 127) if not chr(c).isalnum())


@dataclass(frozen=True)
class Settings:
    per_class: int = 1200  # bound of the labelled sample, for each class
    max_bytes: int = 5 << 19  # of a class's sample texts, each whole
    buckets: int = 1 << 18  # of the hashed features
    evidence: float = 25.0  # least likelihood-ratio statistic of a tagging feature
    purity: float = 0.9  # least share of a tagging feature's class-balanced mass in toxic documents
    steps: int = 40
    ridge: float = 1e-3
    span_p: float = 0.5  # least marginal of a reported token


@dataclass(frozen=True)
class Model:
    weights: np.ndarray  # of the hashed features, for the toxic state
    bias: float
    start: np.ndarray
    moves: np.ndarray
    calibration: np.ndarray
    settings: Settings


def normal(word: str) -> str:
    return word.strip(EDGES).lower()


def word_features(word: str) -> list[str]:
    """Features of one token; an all-punctuation token has only its shape."""
    w = normal(word)
    if not w:
        return ["s:punct"]
    out = [f"w:{w}", f"e:{w[-3:]}"]
    out += [f"p:{w[:k]}" for k in (3, 4, 5, 6) if len(w) >= k]
    return out


def _bucket(features: list[str], buckets: int) -> np.ndarray:
    codes = np.fromiter((int.from_bytes(f.encode()[-7:], "little") + 131 * len(f) + sum(f.encode()) * 65_599 for f in features), dtype=np.uint64, count=len(features))
    return (mix(codes) % np.uint64(buckets)).astype(np.int64)


class Vocabulary:
    """Feature buckets of distinct words, numbered as they appear."""

    def __init__(self, buckets: int):
        self.buckets, self.ids, self.flat, self.ends = buckets, {}, [], [0]

    def add(self, word: str) -> int:
        at = self.ids.get(word)
        if at is None:
            at = self.ids[word] = len(self.ids)
            found = _bucket(word_features(word), self.buckets)
            self.flat.append(found)
            self.ends.append(self.ends[-1] + len(found))
        return at


def _independent(sample: list[tuple[list[str], int]]) -> list[int]:
    """Indexes of sample texts that share few rare word triples with an earlier one."""
    seen: set = set()
    keep = []
    for i, (words, _) in enumerate(sample):
        triples = {hash_triple(words[j : j + 3]) for j in range(max(1, len(words) - 2))}
        least = sorted(triples)[:12]
        if sum(t in seen for t in least) <= len(least) // 3:
            keep.append(i)
        seen.update(least)
    return keep


def hash_triple(words: list[str]) -> int:
    value = 0
    for b in " ".join(words).encode():
        value = (value * 1_099_511_628_211 ^ b) & 0xFFFFFFFFFFFFFFFF
    return value


def tagging_features(docs: list[tuple[list[str], int]], settings: Settings) -> set[str]:
    """Words and prefixes that mark toxic documents."""
    counts = (Counter(), Counter())
    totals = [0, 0]
    for words, y in docs:
        totals[y] += 1
        counts[y].update({f for w in set(words) for f in word_features(w) if f[0] in "wp"})
    if not all(totals):
        return set()
    marks = set()
    for f, a in counts[1].items():
        b = counts[0][f]
        pa_, pb = a / totals[1], b / totals[0]
        if a < 3 or pa_ < settings.purity * (pa_ + pb):
            continue
        expected = (a + b) * totals[1] / sum(totals)
        g = 2 * (a * np.log(a / expected) + (b * np.log(b / (a + b - expected)) if b else 0.0))
        if g >= settings.evidence:
            marks.add(f)
    return marks


def fit(docs: DataFrame, labels: DataFrame, settings: Settings = Settings()) -> Model:
    """Tag, train and calibrate on a bounded sample of labelled rows outside the held-out fold."""
    sample = training_sample(docs, labels, "toxic", FOLDS, HELD_OUT, settings.per_class, settings.max_bytes)
    split = [([b.decode() for b in t.encode().split()], y) for t, y in sample]
    return fit_tokens(split, settings)


def fit_tokens(split: list[tuple[list[str], int]], settings: Settings = Settings()) -> Model:
    """``fit`` on tokenised labelled documents."""
    kept = [split[i] for i in _independent(split)]
    marks = tagging_features(kept, settings)
    vocabulary = Vocabulary(settings.buckets)
    rows, first, tags, tagged = [], [], [], {}
    for words, y in kept:
        for j, w in enumerate(words):
            rows.append(vocabulary.add(w))
            first.append(j == 0)
            if w not in tagged:
                tagged[w] = any(f in marks for f in word_features(w))
            tags.append(y == 1 and tagged[w])
    model = _train(vocabulary, np.array(rows, dtype=np.int64), np.array(first, dtype=bool), np.array(tags, dtype=np.int8), settings)
    return Model(*model, _calibrate(model, split, settings), settings)


def _train(vocabulary: Vocabulary, rows, first, tags, settings: Settings):
    weights, bias = np.zeros(settings.buckets), -3.0
    start, moves = np.zeros(2), np.zeros((2, 2))
    if not len(rows):
        return weights, bias, start, moves
    flat = np.concatenate(vocabulary.flat)
    owner = np.repeat(np.arange(len(vocabulary.ids)), np.diff(vocabulary.ends))
    size = np.zeros(settings.buckets)
    bias_size = 0.0
    pair_size, start_size = np.zeros((2, 2)), np.zeros(2)
    positive = max(1.0, float(tags.sum()))
    begins = np.flatnonzero(first)
    cuts = [*begins[np.unique(np.searchsorted(begins, np.arange(0, len(rows), 1 << 17)).clip(max=len(begins) - 1))], len(rows)]
    parts = [slice(a, b) for a, b in zip(cuts[:-1], cuts[1:]) if b > a]  # whole sequences, to bound memory
    for _ in range(settings.steps):  # full gradient, AdaGrad step sizes
        word_score = np.bincount(owner, weights[flat], minlength=len(vocabulary.ids)) + bias
        per_word, d_start, d_moves, d_bias = np.zeros(len(vocabulary.ids)), np.zeros(2), np.zeros((2, 2)), 0.0
        for part in parts:
            d_unary, by_start, by_moves = chain.log_likelihood_gradient(word_score[rows[part]], first[part], start, moves, tags[part])
            per_word += np.bincount(rows[part], d_unary, minlength=len(vocabulary.ids))
            d_start, d_moves, d_bias = d_start + by_start, d_moves + by_moves, d_bias + d_unary.sum()
        g = np.bincount(flat, per_word[owner], minlength=settings.buckets) / positive - settings.ridge * weights
        size += g * g
        weights += 0.5 * g / (np.sqrt(size) + 1e-6) * (np.abs(g) > 1e-9)
        g = d_bias / positive
        bias_size += g * g
        bias += 0.5 * g / (np.sqrt(bias_size) + 1e-6)
        for value, grad, held in ((start, d_start / positive, start_size), (moves, d_moves / positive, pair_size)):
            grad = grad - settings.ridge * value
            held += grad * grad
            value += 0.2 * grad / (np.sqrt(held) + 1e-6)
    return weights, bias, start, moves


def document_features(p: np.ndarray, row: np.ndarray, n: int) -> np.ndarray:
    """Log-odds of the highest marginal and the expected number of toxic tokens, per document."""
    most, total = np.full(n, 1e-6), np.zeros(n)
    np.maximum.at(most, row, np.clip(p, 1e-6, 1 - 1e-6))
    np.add.at(total, row, np.where(p >= 0.05, p, 0.0))  # what is surely clean doesn't add up over a long text
    return np.column_stack([np.log(most / (1 - most)) / 4.0, np.log1p(total)])


def _calibrate(trained, split, settings: Settings) -> np.ndarray:
    weights, bias, start, moves = trained
    scores: dict[str, float] = {}
    x = []
    for at in range(0, len(split), 256):
        part = split[at : at + 256]
        flat = [w for words, _ in part for w in words]
        for w in set(flat) - scores.keys():
            scores[w] = weights[_bucket(word_features(w), settings.buckets)].sum() + bias
        row = np.repeat(np.arange(len(part)), [len(words) for words, _ in part])
        unary = np.array([scores[w] for w in flat])
        first = np.diff(row, prepend=-1) > 0
        x.append(document_features(chain.marginals(unary, first, start, moves), row, len(part)))
    y = np.array([y for _, y in split], dtype=float)
    if len(set(y)) < 2:
        return np.array([1.0, 0.0, -1.0])
    return logistic.fit(np.concatenate(x), y)


class WordScores:
    """Potential of each distinct word, kept between batches up to a bound."""

    def __init__(self, model: Model, bound: int = 400_000):
        self.model, self.bound = model, bound
        self.keys, self.values = np.zeros(0, np.uint64), np.zeros(0)

    def of(self, held: Texts, hashes: np.ndarray, start: np.ndarray, stop: np.ndarray) -> np.ndarray:
        distinct, at, inverse = np.unique(hashes, return_index=True, return_inverse=True)
        place = np.searchsorted(self.keys, distinct)
        known = np.zeros(len(distinct), dtype=bool)
        inside = place < len(self.keys)
        known[inside] = self.keys[place[inside]] == distinct[inside]
        value = np.zeros(len(distinct))
        value[known] = self.values[place[known]]
        new = np.flatnonzero(~known)
        if len(new):
            features, ends = [], [0]
            for i in at[new]:
                features.extend(word_features(held.decode(start[i], stop[i])))
                ends.append(len(features))
            summed = np.add.reduceat(self.model.weights[_bucket(features, self.model.settings.buckets)], ends[:-1])
            value[new] = summed + self.model.bias
            if len(self.keys) + len(new) > self.bound:
                self.keys, self.values = distinct, value
            else:
                keys = np.concatenate([self.keys, distinct[new]])
                order = np.argsort(keys)
                self.keys, self.values = keys[order], np.concatenate([self.values, value[new]])[order]
        return value[inverse]


def spans_of(held: Texts, start, stop, row, p, least: float) -> list[list[dict]]:
    """Runs of neighbouring toxic tokens as code point spans of their text."""
    out: list[list[dict]] = [[] for _ in range(len(held))]
    hit = np.flatnonzero(p >= least)
    if not len(hit):
        return out
    fresh = np.ones(len(hit), dtype=bool)
    fresh[1:] = (hit[1:] != hit[:-1] + 1) | (row[hit[1:]] != row[hit[:-1]])
    head = np.flatnonzero(fresh)
    tail = np.append(head[1:], len(hit)) - 1
    points = np.concatenate([[0], np.cumsum((held.data & 0xC0) != 0x80)])  # code points before each byte
    rows = row[hit[head]]
    origin = points[held.ends[rows]]
    begins, ends = points[start[hit[head]]] - origin, points[stop[hit[tail]]] - origin
    for r, a, b, most in zip(rows.tolist(), begins.tolist(), ends.tolist(), np.maximum.reduceat(p[hit], head).tolist()):
        out[r].append({"start": a, "end": b, "p": most})
    return out


def scored(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """``docs`` with ``__toxicity_score`` (0 to 1) and ``__toxic_spans`` (start, end, p) of each whole text."""

    def scorer() -> Callable[[pa.Array], list]:
        scores = WordScores(model)

        def score(column: pa.Array) -> list:
            held = texts_of(column)
            start, stop, row = held.words()
            unary = scores.of(held, held.span_hashes(held.prefix_sums(False), start, stop), start, stop) if len(start) else np.zeros(0)
            p = chain.marginals(unary, np.diff(row, prepend=-1) > 0, model.start, model.moves)
            calibrated = logistic.score(document_features(p, row, len(held)), model.calibration)
            return [calibrated, spans_of(held, start, stop, row, p, model.settings.span_p)]

        return score

    return attach(docs, text, [T.StructField(SCORE, T.DoubleType()), T.StructField(SPANS, SPAN)], scorer)
