"""Quality rules: base text statistics and a likelihood ratio between trusted and raw text.

Every text is counted as hashed word unigrams and bigrams. The trusted target is all text labelled good,
the raw corpus is all text. With ``c`` the target's count of a bucket and ``e`` the count it would have at
the raw corpus's rate, a bucket weighs ``log((c + k) / (e + k))``: what is rare weighs little. A text's
ratio is the mean weight of its n-grams; it is kept when it passes the base rules and its ratio reaches a
fixed threshold. The counts cover all rows; only the two bucket vectors, of a fixed size, reach the driver.

Null and empty texts have no words, all counts 0, fail the base rules and have ratio 0. Without any
trusted text all weights are 0, so that the base rules alone decide.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from harmlens.llm.batches import U64, Texts, attach, mix, slices, texts_of

SYMBOLS = np.isin(np.arange(256), np.frombuffer(b"#*$%&|<>", dtype=np.uint8))
COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
FIELDS = [T.StructField(f"__{c}", T.LongType()) for c in COUNTS] + [
    T.StructField("__base_failed", T.BooleanType()), T.StructField("__ratio", T.DoubleType()), T.StructField("__kept", T.BooleanType())]


@dataclass(frozen=True)
class Settings:
    buckets: int = 1 << 16
    shrink: float = 8.0  # pseudo-count k
    least_ratio: float = -0.1  # mean log ratio of an n-gram
    least_words: int = 50
    repeat_percent: int = 50


def gram_buckets(held: Texts, settings: Settings) -> tuple[np.ndarray, np.ndarray]:
    """Bucket and row of every unigram and bigram of lower-cased (A-Z) words."""
    start, stop, row = held.words()
    word = held.span_hashes(held.prefix_sums(True), start, stop)
    same = row[1:] == row[:-1]
    pair = mix(word[:-1] * U64(0x9E3779B97F4A7C15) + word[1:])[same]
    codes = np.concatenate([word, pair])
    return (codes % U64(settings.buckets)).astype(np.int64), np.concatenate([row, row[1:][same]])


def _counts(texts: DataFrame, settings: Settings) -> DataFrame:
    """Rows (bucket, n) of all texts; each task sends one row per bucket at most."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(settings.buckets, dtype=np.int64)
        for batch in batches:
            for lo, hi in slices(batch.column(0)):
                bucket, _ = gram_buckets(texts_of(batch.column(0).slice(lo, hi - lo)), settings)
                total += np.bincount(bucket, minlength=settings.buckets)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), pa.array(total[at], pa.int64())], names=["bucket", "n"])

    return texts.mapInArrow(run, "bucket int, n bigint").groupBy("bucket").agg(F.sum("n").alias("n"))


def fit(docs: DataFrame, labels: DataFrame, settings: Settings = Settings()) -> np.ndarray:
    """Weight of every bucket."""
    good = labels.filter("quality = 1 and doc_id is not null").select(F.col("doc_id").alias("id")).distinct()
    # the labels' side is built into hash tables, so the texts are neither sorted nor spilled
    trusted = docs.select(F.col("doc_id").alias("id"), F.col("text").alias("t")).join(good.hint("shuffle_hash"), "id", "left_semi").select("t")
    raw = _counts(docs.select(F.col("text").alias("t")), settings).withColumn("which", F.lit(0))
    both = raw.unionByName(_counts(trusted, settings).withColumn("which", F.lit(1))).collect()  # 2 * buckets rows
    counts = np.zeros((2, settings.buckets))
    for r in both:
        counts[r["which"], r["bucket"]] = r["n"]
    if not counts[1].sum():
        return np.zeros(settings.buckets)
    expected = counts[0] * (counts[1].sum() / counts[0].sum())
    return np.log((counts[1] + settings.shrink) / (expected + settings.shrink))


def base_counts(held: Texts) -> np.ndarray:
    """The five base counts of each text, in the order of ``COUNTS``."""
    rows = len(held)
    out = np.zeros((5, rows), dtype=np.int64)
    data, ends = held.data, held.ends
    start, stop, row = held.words()
    out[0] = np.bincount(row, minlength=rows)
    space = np.isin(data, np.frombuffer(b" \t\n\v\f\r", dtype=np.uint8))
    sums = lambda mask: np.diff(np.concatenate([[0], np.cumsum(mask)])[ends])
    out[1] = sums(~space & ((data & 0xC0) != 0x80))
    out[2] = sums(SYMBOLS[data])
    hashes = held.prefix_sums(False)
    # lines: cut at \n and at the rows' ends
    breaks = np.flatnonzero(data == 10)
    line_start = np.concatenate([ends[:-1], breaks + 1])
    line_row = np.concatenate([np.arange(rows), held.row_of(breaks)])
    order = np.lexsort((line_start, line_row))
    line_start, line_row = line_start[order], line_row[order]
    line_stop = np.concatenate([line_start[1:] - 1, ends[-1:]])
    last = np.concatenate([line_row[1:] != line_row[:-1], [True]]) if rows else np.zeros(0, bool)
    line_stop[last] = ends[1:][line_row[last]]
    filled = np.concatenate([[0], np.cumsum(~space)])
    lined = filled[line_stop] > filled[line_start]
    key = mix(held.span_hashes(hashes, line_start[lined], line_stop[lined]) + line_row[lined].astype(np.uint64) * U64(0xD6E8FEB86659FD93))
    out[3] = np.bincount(line_row[lined], minlength=rows)
    _, at = np.unique(key, return_index=True)
    out[3] -= np.bincount(line_row[lined][at], minlength=rows)
    if len(start) >= 3:
        word = held.span_hashes(hashes, start, stop)
        whole = row[2:] == row[:-2]
        three = mix(mix(word[:-2] * U64(0x9E3779B97F4A7C15) + word[1:-1]) * U64(0xC2B2AE3D27D4EB4F) + word[2:])
        three = mix(three + row[2:].astype(np.uint64) * U64(0xD6E8FEB86659FD93))[whole]
        _, inverse, times = np.unique(three, return_inverse=True, return_counts=True)
        begin = np.flatnonzero(whole)[times[inverse] >= 2]
        covered = np.zeros(len(start), dtype=bool)
        for k in range(3):
            covered[begin + k] = True
        out[4] = np.bincount(row[covered], minlength=rows)
    return out


def ratios(held: Texts, weights: np.ndarray, settings: Settings) -> np.ndarray:
    """Mean weight of each text's n-grams; 0 without words."""
    bucket, row = gram_buckets(held, settings)
    total = np.bincount(row, weights[bucket], minlength=len(held))
    return total / np.maximum(1, np.bincount(row, minlength=len(held)))


def judged(docs: DataFrame, weights: np.ndarray, settings: Settings = Settings(), text: str = "text") -> DataFrame:
    """``docs`` with the base counts, ``__base_failed``, ``__ratio`` and ``__kept`` of each whole text."""

    def scorer() -> Callable[[pa.Array], list]:
        def score(column: pa.Array) -> list:
            held = texts_of(column)
            counts = base_counts(held)
            failed = (counts[0] < settings.least_words) | (100 * counts[4] > settings.repeat_percent * counts[0])
            ratio = ratios(held, weights, settings)
            return [*counts, failed, ratio, ~failed & (ratio >= settings.least_ratio)]

        return score

    return attach(docs, text, FIELDS, scorer)


def kept(docs: DataFrame, weights: np.ndarray, settings: Settings = Settings()) -> DataFrame:
    """The documents that the rules keep, with their own columns."""
    return judged(docs, weights, settings).filter("__kept").drop(*(f.name for f in FIELDS))
