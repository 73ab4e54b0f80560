"""Quality classifier by compression: the size difference between two dictionaries, and the compression ratio.

Two zstandard dictionaries are built, one from good and one from bad labelled texts. A text that
compresses better with the good dictionary looks like good text: the size difference, normalised by
the sum of both sizes, and the compression ratio itself are calibrated to a score by logistic regression
on labelled texts that no dictionary has seen. A text is compressed in blocks, each with the full
dictionary, so that the whole of a long text counts alike.

Null and empty texts have no bytes; they get the score of zero difference and ratio, the same for all.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from harmlens.llm import logistic
from harmlens.llm.batches import attach, texts_of
from harmlens.llm.labels import training_sample

FOLDS, HELD_OUT = 4, 2
ACCEPT = 0.7
SCORE = "__quality_score"


@dataclass(frozen=True)
class Settings:
    per_class: int = 2000  # bound of the labelled sample, for each class
    max_bytes: int = 8 << 20  # of a class's sample texts, each whole
    dictionary_bytes: int = 512 << 10
    block_bytes: int = 1024
    level: int = 3


@dataclass(frozen=True)
class Model:
    good: bytes
    bad: bytes
    weights: np.ndarray
    settings: Settings


def _dictionary(samples: list[bytes], settings: Settings) -> bytes:
    """Trained where there is enough text, else the samples themselves."""
    total = sum(map(len, samples))
    size = min(settings.dictionary_bytes, total // 3)
    if len(samples) >= 16 and size >= 1024:
        try:
            return zstandard.train_dictionary(size, samples, k=128, d=8).as_bytes()
        except zstandard.ZstdError:  # too uniform to train on
            pass
    return b"\n".join(samples)[-settings.dictionary_bytes:] or b"\n" * 8


def _compressors(model: Model):
    out = []
    for raw in (model.good, model.bad):
        kind = zstandard.DICT_TYPE_AUTO
        held = zstandard.ZstdCompressionDict(raw, dict_type=kind)
        held.precompute_compress(level=model.settings.level)
        out.append(zstandard.ZstdCompressor(dict_data=held, write_content_size=False, write_checksum=False, write_dict_id=False))
    return out


def features(texts: list[bytes], good, bad, block: int) -> np.ndarray:
    """Per text: normalised size difference, compression ratio and their products."""
    sizes = np.zeros((len(texts), 3))
    for i, text in enumerate(texts):
        for at in range(0, len(text), block):
            part = text[at : at + block]
            sizes[i] += (len(good.compress(part)), len(bad.compress(part)), len(part))
    g, b, n = sizes.T
    difference = 10 * np.divide(b - g, b + g, out=np.zeros_like(g), where=(b + g) > 0)
    ratio = np.divide(g + b, 2 * n, out=np.zeros_like(g), where=n > 0)
    return np.column_stack([difference, ratio, difference * np.abs(difference), ratio**2, difference * ratio])


def fit(docs: DataFrame, labels: DataFrame, settings: Settings = Settings()) -> Model:
    """Train on a bounded sample of labelled rows outside the held-out fold."""
    sample = training_sample(docs, labels, "quality", FOLDS, HELD_OUT, settings.per_class, settings.max_bytes)
    build, calibrate = sample[0::2], sample[1::2] or sample
    text_of = lambda rows, y: [t.encode() for t, label in rows if label == y]
    blocks = lambda texts: [t[at : at + settings.block_bytes] for t in texts for at in range(0, len(t), settings.block_bytes)]
    model = Model(_dictionary(blocks(text_of(build, 1)), settings), _dictionary(blocks(text_of(build, 0)), settings), np.zeros(6), settings)
    x = features([t.encode() for t, _ in calibrate], *_compressors(model), settings.block_bytes)
    y = np.array([label for _, label in calibrate], dtype=float)
    weights = logistic.fit(x, y) if len(set(y)) == 2 else np.array([0.0] * 5 + [2.0 if y.sum() == len(y) else -2.0])
    return Model(model.good, model.bad, weights, settings)


def scored(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """``docs`` with the quality score of each whole text appended as ``__quality_score``."""

    def scorer() -> Callable[[pa.Array], list]:
        good, bad = _compressors(model)

        def score(column: pa.Array) -> list:
            held = texts_of(column)
            texts = [held.data[a:b].tobytes() for a, b in zip(held.ends[:-1], held.ends[1:])]
            return [logistic.score(features(texts, good, bad, model.settings.block_bytes), model.weights)]

        return score

    return attach(docs, text, [T.StructField(SCORE, T.DoubleType())], scorer)


def accepted(docs: DataFrame, model: Model) -> DataFrame:
    """The documents whose score is at least 0.7, with their own columns."""
    return scored(docs, model).filter(F.col(SCORE) >= ACCEPT).drop(SCORE)
