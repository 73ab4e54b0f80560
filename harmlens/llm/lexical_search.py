"""Ranked lexical search of a set of items over all documents, by presence masks.

Terms are the maximal matches of ``TERM`` in the whole text, with only A-Z lower-cased. Two passes read the texts. The
first counts documents, terms and document frequencies of the items' terms, combined within each task. The second takes
documents in blocks: one bitmap for each term tells which documents hold it, the bitmaps of an item's terms give each
document's mask, and documents are grouped by mask. No document of a group can score more than the sum of its terms'
largest contributions in the block, so groups are scored by descending bound until the bound falls below the score of
the item's last place. Each task keeps the best documents of every item over all its blocks; those alone are shuffled
and ranked. Scores are whole numbers, so any order of work gives the same result.

Items are the query set: they reach the tasks in passes bounded by items and terms (``Settings``), each over all
documents. An item without terms finds nothing. Items with equal ids, and documents with equal ids, are each on their
own. Null and empty texts hold no term and don't count as documents; a document without an id counts and is found, after
those of equal score that have one. Ids of documents are integers. Other columns are ignored.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
#: By byte: what belongs to a term, with A-Z lower-cased, and a space for the rest. Bytes of other characters belong to terms.
_FOLD = bytes(b if b >= 128 or chr(b).isalnum() else 32 for b in bytes(range(256)).lower())


@dataclass(frozen=True)
class Settings:
    best: int = 10
    lowest: int = 1  # score
    items: int = 2048  # of one pass
    terms: int = 1 << 15  # distinct ones of one pass, unless a single item has more
    cells: int = 1 << 25  # terms x documents of a block
    block_documents: int = 8192


def terms_of(text: bytes | None) -> list[bytes]:
    return (text or b"").translate(_FOLD).split()


@dataclass
class Items:
    """The items of one pass: their ids, and each one's terms as numbers with their times."""

    ids: list
    numbers: dict[bytes, int]
    terms: list[np.ndarray]
    times: list[np.ndarray]


def passes(items: DataFrame, settings: Settings) -> Iterator[Items]:
    """Items in bounded portions, read one partition at a time."""
    held = Items([], {}, [], [])
    for item_id, text in items.select("item_id", F.col("text").cast("binary")).toLocalIterator():
        counted = Counter(terms_of(text))
        if held.ids and (len(held.ids) >= settings.items or len(held.numbers | counted) > settings.terms):
            yield held
            held = Items([], {}, [], [])
        held.ids.append(item_id)
        held.terms.append(np.array([held.numbers.setdefault(t, len(held.numbers)) for t in counted], dtype=np.int64))
        held.times.append(np.array(list(counted.values()), dtype=np.int64))
    if held.ids:
        yield held


DOCUMENTS, TERMS = -1, -2


def _totals(docs: DataFrame, numbers: dict[bytes, int]) -> dict[int, int]:
    """Documents that hold each term; under the two negative keys the documents with terms, and all their terms."""
    shared = docs.sparkSession.sparkContext.broadcast(numbers)  # Settings.terms at most, or one item's

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        numbers, total = shared.value, Counter()
        for batch in batches:
            for text in batch.column(0).to_pylist():
                terms = terms_of(text)
                if terms:
                    total[DOCUMENTS] += 1
                    total[TERMS] += len(terms)
                    total.update(map(numbers.__getitem__, numbers.keys() & terms))
        yield pa.RecordBatch.from_pydict({"term": pa.array(total.keys(), pa.int64()), "n": pa.array(total.values(), pa.int64())})

    counted = docs.select(F.col("text").cast("binary")).mapInArrow(run, "term bigint, n bigint")
    return {r["term"]: r["n"] for r in counted.groupBy("term").agg(F.sum("n").alias("n")).collect()}


class Block:
    """Postings of some documents: a bitmap for each term, and what each term adds to each document's score by weight."""

    def __init__(self, found: list[tuple[object, int, dict[int, int]]], n_terms: int, documents: int, terms: int):
        self.ids = [doc_id for doc_id, _, _ in found]
        sizes = np.array([len(tf) for _, _, tf in found], dtype=np.int64)
        self.ends = np.concatenate([[0], np.cumsum(sizes)])
        self.term = np.fromiter((t for _, _, tf in found for t in tf), dtype=np.int64, count=self.ends[-1])
        times = np.fromiter((n for _, _, tf in found for n in tf.values()), dtype=np.int64, count=self.ends[-1])
        m = 100 - 75 + 75 * np.array([n for _, n, _ in found], dtype=np.int64) * documents // terms
        row = np.repeat(np.arange(len(found)), sizes)
        self.share = 1_000_000_000 * times // (1000 * times + 8 * m[row])
        holds = np.zeros((n_terms, len(found)), dtype=bool)
        holds[self.term, row] = True
        self.bitmaps = np.packbits(holds, axis=1)
        self.largest = np.zeros(n_terms, dtype=np.int64)
        np.maximum.at(self.largest, self.term, self.share)

    def groups(self, terms: np.ndarray, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Bound of every distinct mask, from the highest, and its documents: ``documents[ends[i]:ends[i + 1]]``."""
        holds = np.unpackbits(self.bitmaps[terms], axis=1, count=len(self.ids))
        words = np.zeros((len(self.ids), -(-len(terms) // 64) * 8), dtype=np.uint8)
        words[:, : -(-len(terms) // 8)] = np.packbits(holds, axis=0).T
        first, *rest = words.view(np.uint64).T
        _, mask = np.unique(first, return_inverse=True)
        for word in rest:
            seen, code = np.unique(word, return_inverse=True)
            _, mask = np.unique(mask * len(seen) + code, return_inverse=True)
        documents = np.argsort(mask, kind="stable")
        ends = np.concatenate([[0], np.cumsum(np.bincount(mask))])
        bound = (weights * self.largest[terms]) @ holds[:, documents[ends[:-1]]]
        order = np.argsort(-bound, kind="stable")
        size = np.diff(ends)[order]
        new_ends = np.concatenate([[0], np.cumsum(size)])
        return bound[order], documents[np.repeat(ends[order] - new_ends[:-1], size) + np.arange(len(documents))], new_ends

    def scores(self, documents: np.ndarray, weight_of: np.ndarray) -> np.ndarray:
        size = self.ends[documents + 1] - self.ends[documents]
        ends = np.concatenate([[0], np.cumsum(size)])
        at = np.repeat(self.ends[documents] - ends[:-1], size) + np.arange(ends[-1])
        total = np.concatenate([[0], np.cumsum(weight_of[self.term[at]] * self.share[at])])
        return total[ends[1:]] - total[ends[:-1]]


def improve(best: list[tuple[int, float, object]], block: Block, terms: np.ndarray, weights: np.ndarray, weight_of: np.ndarray,
            settings: Settings) -> list[tuple[int, float, object]]:
    """The best (-score, id, id or None) of one item, from those of earlier blocks and a further block."""
    weight_of[terms] = weights
    bound, documents, ends = block.groups(terms, weights)
    at, step = 0, 16
    while at < len(bound):
        least = -best[-1][0] if len(best) == settings.best else settings.lowest
        stop = min(at + step, int(np.searchsorted(-bound, -least, side="right")))
        if stop <= at:
            break  # no further mask can reach the last place
        chosen = documents[ends[at] : ends[stop]]
        scores = block.scores(chosen, weight_of)
        good = scores >= least
        ids = [block.ids[d] for d in chosen[good]]
        best = sorted([*best, *((-s, math.inf if i is None else i, i) for s, i in zip(scores[good].tolist(), ids))], key=lambda x: x[:2])[: settings.best]
        at, step = stop, step * 2
    weight_of[terms] = 0
    return best


def _best_of_tasks(docs: DataFrame, items: Items, totals: dict[int, int], settings: Settings) -> DataFrame:
    """Rows (item, doc_id, score): of each task and item the best documents."""
    n, length = totals[DOCUMENTS], totals[TERMS]
    weight = np.array([math.floor(1000 * math.log((2 * n + 2) / (2 * totals.get(t, 0) + 1))) for t in range(len(items.numbers))], dtype=np.int64)
    weights = [weight[terms] * times for terms, times in zip(items.terms, items.times)]
    shared = docs.sparkSession.sparkContext.broadcast((items.numbers, items.terms, weights))
    rows = max(1, min(settings.block_documents, settings.cells // max(1, len(items.numbers))))

    def blocks(batches: Iterator[pa.RecordBatch], numbers: dict[bytes, int]) -> Iterator[Block]:
        found = []
        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                terms = terms_of(text)
                held = Counter(map(numbers.__getitem__, filter(numbers.__contains__, terms)))
                if held:
                    found.append((doc_id, len(terms), held))
                if len(found) == rows:
                    yield Block(found, len(numbers), n, length)
                    found = []
        if found:
            yield Block(found, len(numbers), n, length)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        numbers, terms, weights = shared.value
        best = [[] for _ in terms]
        weight_of = np.zeros(len(numbers), dtype=np.int64)
        for block in blocks(batches, numbers):
            for i, own in enumerate(terms):
                if len(own):
                    best[i] = improve(best[i], block, own, weights[i], weight_of, settings)
        out = [(i, doc_id, -minus) for i, places in enumerate(best) for minus, _, doc_id in places]
        yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in out], pa.int64()) for k in range(3)], names=["item", "doc_id", "score"])

    return docs.select(F.col("doc_id").cast("bigint"), F.col("text").cast("binary")).mapInArrow(run, "item bigint, doc_id bigint, score bigint")


def ranked(docs: DataFrame, items: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """item_id, rank (from 1), doc_id, score: each item's best documents, by score, then id."""
    if not isinstance(docs.schema["doc_id"].dataType, T.IntegralType):
        raise TypeError("ids of documents must be integers")
    spark, kind = docs.sparkSession, items.schema["item_id"].dataType.simpleString()
    order = [F.col("score").desc(), F.col("doc_id").asc_nulls_last()]
    place = lambda *keys: F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    out = spark.createDataFrame([], f"item_id {kind}, rank int, doc_id bigint, score bigint")
    for held in passes(items, settings):
        totals = _totals(docs, held.numbers)
        if not totals.get(DOCUMENTS):
            break
        found = _best_of_tasks(docs, held, totals, settings)
        # in two steps, so that no task sorts the best of all tasks for one item
        some = found.withColumn("part", F.pmod(F.xxhash64("doc_id"), F.lit(32))).withColumn("place", place("item", "part")).filter(F.col("place") <= settings.best)
        top = some.withColumn("rank", place("item")).filter(F.col("rank") <= settings.best)
        names = spark.createDataFrame(list(enumerate(held.ids)), f"item bigint, item_id {kind}")  # Settings.items rows
        out = out.unionByName(top.join(F.broadcast(names), "item").select("item_id", "rank", "doc_id", "score"))
    return out
