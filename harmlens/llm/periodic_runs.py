"""Periodic runs in the words of each text, and the text without their repetitions.

Words are ``[^\\x20\\x09-\\x0D]+`` of the whole text. A run is a stretch of at least 12 words, and of two periods, that
repeats itself with its smallest period and can't be longer; ``square_catchers`` finds all of them. The collapsed text
keeps of each run its first period and has one space between words. The texts of a batch are appended one after the
other, the ones with most words first, so that long periods are searched in long texts only; a word's code holds its
text's number, so that no run crosses texts.

A null, empty or blank text has no words: no runs, and an empty collapsed text. Every row has its own result, repeated
rows and rows without an id included. Other columns are passed on; columns named like the results are refused.
"""

from __future__ import annotations

from collections.abc import Callable
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from harmlens.llm.batches import U64, attach, mix
from harmlens.llm.square_catchers import SquareCatchers

RUNS, COLLAPSED = "__runs", "__collapsed"
SHORTEST = 12
PIECE = 1 << 20  # words appended at once, which bounds what the catchers catch at once
RUN = T.StructType([T.StructField(name, T.LongType()) for name in ("start", "length", "period")])
FIELDS = [T.StructField(RUNS, T.ArrayType(RUN)), T.StructField(COLLAPSED, T.StringType())]


def runs_of(texts: list[list[bytes]], shortest: int = SHORTEST) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Text number, start, length and period of every run, by text, start and period."""
    counts = np.array([len(words) for words in texts], dtype=np.int64)
    order = np.argsort(-counts, kind="stable")
    order = order[counts[order] >= shortest]
    sizes = counts[order]
    ends = np.concatenate([[0], np.cumsum(sizes)])
    codes = np.empty(ends[-1], dtype=np.uint64)
    for i, row in enumerate(order):
        # equal words of a text only have to get equal codes within this call
        codes[ends[i] : ends[i + 1]] = np.fromiter(map(hash, texts[row]), dtype=np.int64, count=sizes[i]).view(np.uint64) + U64(row)
    codes = mix(codes ^ mix(np.repeat(order.astype(np.uint64), sizes)))
    # a run of period q needs a text of 2 * q words
    catchers = SquareCatchers(shortest, lambda period: int(ends[np.searchsorted(-sizes, -2 * period, side="right")]))
    for at in range(0, len(codes), PIECE):
        catchers.append(codes[at : at + PIECE])
    start, length, period = catchers.runs()
    at = np.searchsorted(ends, start, side="right") - 1
    row = order[at]
    by = np.lexsort((period, start, row))
    return row[by], (start - ends[at])[by], length[by], period[by]


def collapsed(words: list[bytes], start: np.ndarray, length: np.ndarray, period: np.ndarray) -> bytes:
    """The words that stand in no run after its first period, joined by one space."""
    if not len(start):
        return b" ".join(words)
    depth = np.zeros(len(words) + 1, dtype=np.int64)
    np.add.at(depth, start + period, 1)
    np.add.at(depth, start + length, -1)
    return b" ".join(compress(words, np.cumsum(depth[:-1]) == 0))


def with_runs(docs: DataFrame, text: str = "text", shortest: int = SHORTEST) -> DataFrame:
    """``docs`` with ``__runs`` (by start, then period) and ``__collapsed``."""

    def scorer() -> Callable[[pa.Array], list]:
        def score(column: pa.Array) -> list:
            texts = [(t or b"").split() for t in column.cast(pa.large_binary()).to_pylist()]
            row, *parts = runs_of(texts, shortest)
            ends = np.searchsorted(row, np.arange(len(texts) + 1))
            left = [collapsed(words, *(p[ends[i] : ends[i + 1]] for p in parts)) for i, words in enumerate(texts)]
            runs = pa.StructArray.from_arrays([pa.array(p, pa.int64()) for p in parts], names=[f.name for f in RUN])
            return [pa.ListArray.from_arrays(pa.array(ends, pa.int32()), runs), pa.array(left, pa.binary()).cast(pa.string())]

        return score

    return attach(docs, text, FIELDS, scorer)


def longest(runs: str | Column) -> Column:
    """The run of greatest length; of equal ones the smallest start, then period. Null without runs."""
    best = F.array_max(F.transform(runs, lambda r: F.struct(r["length"].alias("length"), (-r["start"]).alias("s"), (-r["period"]).alias("p"))))
    return F.when(best.isNotNull(), F.struct((-best["s"]).alias("start"), best["length"].alias("length"), (-best["p"]).alias("period")))
