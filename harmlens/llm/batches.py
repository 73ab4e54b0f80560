"""Whole texts as byte arrays: words, lines and their hashes, computed for a batch of rows at once.

Spark deals the rows and moves the results; the functions here only replace a per-row loop inside a
task. Words follow the contract ``[^\\x20\\x09-\\x0D]+`` and hashes cover every byte of every text.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

SLICE_BYTES = (1 << 21) - 1  # text handled at once; a longer single text is handled alone
U64 = np.uint64
_MULTIPLIER = 0x9E3779B97F4A7C15
_INVERSE = U64(pow(_MULTIPLIER, -1, 1 << 64))


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scramble of 64-bit integers."""
    x = x ^ (x >> U64(30))
    x = x * U64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> U64(27))
    x = x * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


def _byte_codes(lower: bool) -> np.ndarray:
    byte = np.arange(256, dtype=np.uint64)
    if lower:
        byte[65:91] += U64(32)
    return mix(byte + U64(0x5851F42D4C957F2D))


CODES = {True: _byte_codes(True), False: _byte_codes(False)}
IS_SPACE = np.zeros(256, dtype=bool)
IS_SPACE[[32, 9, 10, 11, 12, 13]] = True


@lru_cache(maxsize=2)
def _powers(bits: int) -> tuple[np.ndarray, np.ndarray]:
    n = (1 << bits) + 1
    up = np.full(n, _MULTIPLIER, dtype=np.uint64)
    down = np.full(n, _INVERSE, dtype=np.uint64)
    up[0] = down[0] = 1
    return np.cumprod(up, dtype=np.uint64), np.cumprod(down, dtype=np.uint64)


@dataclass
class Texts:
    """The bytes of a run of texts, one after the other; ``ends`` has one more entry than there are rows."""

    data: np.ndarray
    ends: np.ndarray

    def __len__(self) -> int:
        return len(self.ends) - 1

    def prefix_sums(self, lower: bool) -> np.ndarray:
        """Running sums from which ``span_hashes`` takes the hash of any span."""
        up, _ = _powers(max(21, int(len(self.data)).bit_length()))
        out = np.zeros(len(self.data) + 1, dtype=np.uint64)
        np.cumsum(CODES[lower][self.data] * up[: len(self.data)], out=out[1:])
        return out

    def span_hashes(self, sums: np.ndarray, start: np.ndarray, stop: np.ndarray) -> np.ndarray:
        _, down = _powers(max(21, int(len(self.data)).bit_length()))
        return mix((sums[stop] - sums[start]) * down[start] + (stop - start).astype(np.uint64))

    def words(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Start, stop and row of every word, in order."""
        inside = np.zeros(len(self.data) + 2, dtype=np.int8)
        inside[1:-1] = ~IS_SPACE[self.data]
        step = np.diff(inside)
        start, stop = np.flatnonzero(step == 1), np.flatnonzero(step == -1)
        # rows touch without a separator: cut words that run over a row's end
        cuts = np.unique(self.ends[1:-1])
        if len(start) and len(cuts):
            at = np.searchsorted(start, cuts, side="right") - 1
            split = cuts[(at >= 0) & (cuts > start[np.maximum(at, 0)]) & (cuts < stop[np.maximum(at, 0)])]
            if len(split):
                start, stop = np.sort(np.concatenate([start, split])), np.sort(np.concatenate([stop, split]))
        return start, stop, self.row_of(start)

    def row_of(self, position: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.ends, position, side="right") - 1

    def decode(self, start: int, stop: int) -> str:
        return self.data[start:stop].tobytes().decode("utf-8", "replace")


def texts_of(column: pa.Array | pa.ChunkedArray) -> Texts:
    """A string column; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_string()).fill_null("")
    _, offsets, data = column.buffers()
    ends = np.frombuffer(offsets, dtype=np.int64)[column.offset : column.offset + len(column) + 1] if offsets else np.zeros(1, np.int64)
    raw = np.frombuffer(data, dtype=np.uint8)[ends[0] : ends[-1]] if data is not None and len(column) else np.zeros(0, np.uint8)
    return Texts(raw, ends - ends[0])


def slices(column: pa.Array) -> Iterator[tuple[int, int]]:
    """Row ranges of at most ``SLICE_BYTES`` each, or of one row."""
    ends = texts_of(column).ends
    at = 0
    while at < len(ends) - 1:
        stop = max(at + 1, int(np.searchsorted(ends, ends[at] + SLICE_BYTES, side="right")) - 1)
        yield at, stop
        at = stop


Scorer = Callable[[pa.Array], list]


def attach(df: DataFrame, column: str, fields: list[T.StructField], scorer: Callable[[], Scorer]) -> DataFrame:
    """``df`` with ``fields`` appended: ``scorer()`` is called once per task, its result once per run of texts.

    It gets the string column of some rows and returns one array (or list) per field.
    """
    names = df.columns
    clash = {f.name for f in fields} & set(names)
    if clash or len(set(names)) < len(names):
        raise ValueError(f"columns clash: {sorted(clash) or names}")
    schema = T.StructType([*df.schema.fields, *fields])
    at = names.index(column)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema

        score = scorer()
        wanted = to_arrow_schema(schema)
        kinds = [wanted.field(f.name).type for f in fields]
        for batch in batches:
            for lo, hi in slices(batch.column(at)):
                part = batch.slice(lo, hi - lo)
                found = score(part.column(at))
                arrays = [a if isinstance(a, pa.Array) else pa.array(a, type=k) for a, k in zip(found, kinds)]
                yield pa.RecordBatch.from_arrays([*part.columns, *arrays], names=[*names, *(f.name for f in fields)])

    return df.mapInArrow(run, schema)


def take_arrays(values: np.ndarray, ends: np.ndarray, kind: pa.DataType) -> pa.Array:
    """A list column from flat values and row ends."""
    return pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(values, type=kind))
