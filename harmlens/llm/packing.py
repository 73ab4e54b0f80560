"""Packing documents into fixed-length token sequences: first-fit decreasing in randomised groups.

A document is its token ids and one end id. It is cut at every multiple of the sequence length; whole
pieces are sequences of their own. The remainders are packed in random groups of a fixed expected size:
longest first, each into the first bin with room, found in a tournament tree whose nodes hold the largest
free capacity below them. At last the emptiest bins are emptied into the larger gaps of the others, cutting
where needed, as long as no fragment gets shorter than a bound.

Ids come from the rank form of the byte-level vocabulary; the tests verify parity with the JSON form. Strings
of special tokens are ordinary text. Null text is empty: the document is the end id alone. Rows may repeat
and ids may be null, since groups are dealt at random and not by key. Random numbers are seeded.
"""

from __future__ import annotations

import base64
import math
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import public_tokenizers
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from harmlens.llm.batches import slices

PIECES = "doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, sequence_id bigint, offset bigint"


@dataclass(frozen=True)
class Settings:
    vocabulary: str = public_tokenizers.path("byte_bpe_50k.tiktoken")
    pattern: str = public_tokenizers.PATTERN
    capacity: int = 1024
    end_id: int = 0
    group_docs: int = 2048
    least_cut: int = 32  # fragments made to fill gaps have at least so many ids
    seed: int = 17


@lru_cache(maxsize=2)
def encoding(path: str, pattern: str) -> tiktoken.Encoding:
    with open(path, "rb") as lines:
        ranks = {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in lines)}
    return tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


def tokenized(docs: DataFrame, settings: Settings, with_ids: bool) -> DataFrame:
    """doc_id, n, crcs of the whole pieces and the remaining ids (32-bit little-endian), or all ids."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoding(settings.vocabulary, settings.pattern).encode_to_numpy
        for batch in batches:
            for lo, hi in slices(batch.column(1)):
                n, crcs, tails = [], [], []
                for text in batch.column(1).slice(lo, hi - lo).to_pylist():
                    ids = np.append(encode(text or "", disallowed_special=()), settings.end_id).astype("<u4")
                    whole = len(ids) // settings.capacity * settings.capacity
                    n.append(len(ids))
                    crcs.append([zlib.crc32(ids[at : at + settings.capacity]) for at in range(0, whole, settings.capacity)])
                    tails.append((ids if with_ids else ids[whole:]).tobytes())
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(lo, hi - lo), pa.array(n, pa.int64()), pa.array(crcs, pa.list_(pa.int64())), pa.array(tails, pa.binary())],
                    names=["doc_id", "n", "crcs", "ids"],
                )

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id bigint, n bigint, crcs array<bigint>, ids binary")


class Tournament:
    """First bin with enough room, in logarithmic time."""

    def __init__(self, bins: int, capacity: int):
        self.leaves = 1 << max(0, (bins - 1).bit_length())
        self.room = [capacity] * (2 * self.leaves)

    def place(self, size: int) -> int:
        room, node = self.room, 1
        while node < self.leaves:
            node = 2 * node if room[2 * node] >= size else 2 * node + 1
        chosen = node - self.leaves
        room[node] -= size
        node >>= 1
        while node:
            best = max(room[2 * node], room[2 * node + 1])
            if room[node] == best:
                break
            room[node] = best
            node >>= 1
        return chosen


def first_fit_decreasing(sizes: list[int], capacity: int) -> list[list[int]]:
    """Bins of item numbers; ``sizes`` descend."""
    tree = Tournament(len(sizes), capacity)
    bins: list[list[int]] = []
    for item, size in enumerate(sizes):
        at = tree.place(size)
        if at == len(bins):
            bins.append([])
        bins[at].append(item)
    return bins


Piece = tuple[int, int, int]  # item, first id, length


def fill_gaps(bins: list[list[Piece]], capacity: int, least: int) -> list[list[Piece]]:
    """Empty the emptiest bins into gaps of the others, cutting pieces, while whole bins vanish."""
    used = lambda b: sum(p[2] for p in b)
    bins = sorted(bins, key=used)
    room = [capacity - used(b) for b in bins]
    donor, receivers = 0, [i for i in range(len(bins) - 1, -1, -1) if room[i] >= least]
    receivers.sort(key=lambda i: (-room[i], i))
    while donor < len(bins) - 1:
        placed: list[tuple[int, Piece]] = []
        left = {i: room[i] for i in receivers if i > donor and room[i] >= least}
        targets = iter(sorted(left, key=lambda i: (-left[i], i)))
        at = next(targets, None)
        for item, start, length in bins[donor]:
            while length and at is not None:
                take = min(length, left[at])
                if 0 < length - take < least:
                    take = length - least
                if take < min(length, least):
                    at = next(targets, None)
                    continue
                placed.append((at, (item, start, take)))
                left[at] -= take
                start, length = start + take, length - take
                if left[at] < least:
                    at = next(targets, None)
            if length:
                break
        else:
            for i, piece in placed:
                bins[i].append(piece)
                room[i] -= piece[2]
            bins[donor] = []
            donor += 1
            continue
        break
    return [b for b in bins if b]


def pack_group(group: pa.Table, settings: Settings, with_ids: bool) -> pa.Table:
    """Pieces of one group. Sequence numbers start with the group's number."""
    base = group.column("g")[0].as_py() << 32
    ids = [np.frombuffer(b, dtype="<u4") for b in group.column("ids").to_pylist()]
    doc, n, crcs = (group.column(c).to_pylist() for c in ("doc_id", "n", "crcs"))
    whole = [settings.capacity * len(c) for c in crcs]
    tails = [x[w:] if with_ids else x for x, w in zip(ids, whole)]
    order = sorted((i for i in range(len(doc)) if len(tails[i])), key=lambda i: (-len(tails[i]), doc[i] is None, doc[i] or 0, zlib.crc32(tails[i]), i))
    fitted = first_fit_decreasing([len(tails[i]) for i in order], settings.capacity)
    bins = fill_gaps([[(order[k], 0, len(tails[order[k]])) for k in b] for b in fitted], settings.capacity, settings.least_cut)
    rows, sequence = [], base
    for i, marks in enumerate(crcs):
        for k, crc in enumerate(marks):
            at = k * settings.capacity
            rows.append((doc[i], at, settings.capacity, crc, n[i], sequence, 0, ids[i][at : at + settings.capacity] if with_ids else None))
            sequence += 1
    for held in bins:
        offset = 0
        for i, start, length in held:
            part = tails[i][start : start + length]
            rows.append((doc[i], whole[i] + start, length, zlib.crc32(part), n[i], sequence, offset, part if with_ids else None))
            offset += length
        sequence += 1
    names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
    columns = list(zip(*rows)) or [[]] * 8
    out = {name: pa.array(c, pa.int64()) for name, c in zip(names, columns)}
    if with_ids:
        out["ids"] = pa.array([x.tolist() for x in columns[7]], pa.list_(pa.int32()))
    return pa.table(out)


def packed(docs: DataFrame, settings: Settings = Settings(), with_ids: bool = False) -> DataFrame:
    """One row per piece: where it lies in its document and in its sequence; ``with_ids`` adds its ids."""
    tokens = tokenized(docs, settings, with_ids)
    groups = max(1, math.ceil(docs.count() / settings.group_docs))
    dealt = tokens.withColumn("g", F.floor(F.rand(settings.seed) * groups).cast("bigint"))
    schema = PIECES + (", ids array<int>" if with_ids else "")
    return dealt.groupBy("g").applyInArrow(lambda group: pack_group(group, settings, with_ids), schema)
