"""Lines that many documents share, dropped from all of them but one, by a sharded minimal perfect hash.

A line's key is the line stripped of white space at both ends, with A-Z lower-cased; a text is cut at \\n, and a null or
empty text is one empty line. Keys of at least ``characters`` code points that ``documents`` documents hold are repeated:
their lines go, except in the document of the largest id that holds them. The other lines stay as they are.

Documents are reduced once to the digests of their long lines (128 bits of xxh3). Digests are counted, first within each
task. Those that are repeated form the index: shards by digest, each a minimal perfect hash over its digests with arrays of
fingerprints, counts and largest ids in the order of its places (``hashed_index``). Documents send one packed array of
digests for each batch and shard; the shard looks them up and answers with the lines to drop. What no shard may take, a
line held by more than one in ``head`` of all, is kept out of the shards: there are at most ``head`` such lines, whose
arrays go to every task. So no task gets more than a bounded share, however often a line repeats. At last each document
gets the answers it asked for, and its text is cut once more; texts are moved once.

Each row is a document, also of a repeated id; rows of the largest id all keep the line. A row without an id counts, and
as it can't be named keeps its lines. Ids are integers. Other columns are passed on, unless named like the results.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from harmlens.llm import hashed_index
from harmlens.llm.batches import take_arrays
from harmlens.llm.hashed_index import Index
from harmlens.workspace import cut_lineage

SPACE = b" \t\n\v\f\r"
CARRIED = ["u4", "i8"]  # count, largest id
KEPT, LINES, DROPPED = "__kept_text", "__n_lines", "__n_dropped"
RESULTS = [T.StructField(KEPT, T.StringType()), T.StructField(LINES, T.LongType()), T.StructField(DROPPED, T.LongType())]


@dataclass(frozen=True)
class Settings:
    characters: int = 40
    documents: int = 5
    head: int = 4096
    shard_lines: int = 1 << 16  # of a shard on average, repeated or not


def key_of(line: bytes, characters: int) -> bytes | None:
    """The line's key; None where it is shorter than ``characters`` code points."""
    key = line.strip(SPACE)
    if len(key) < characters or not key.isascii() and len(key.decode("utf-8", "replace")) < characters:
        return None
    return key.lower()


def digest_of(key: bytes) -> bytes:
    return xxhash.xxh3_128_digest(key)


def digests(docs: DataFrame, settings: Settings) -> DataFrame:
    """doc_id and the digests of each document's distinct long lines, one after the other, sorted."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for text in batch.column(1).to_pylist():
                keys = {key for line in (text or b"").split(b"\n") if (key := key_of(line, settings.characters))}
                out.append(b"".join(sorted(map(digest_of, keys))))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, pa.binary())], names=["doc_id", "digests"])

    return docs.select(F.col("doc_id").cast("bigint"), F.col("text").cast("binary")).mapInArrow(run, "doc_id bigint, digests binary")


def _unpacked(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, first and second half of every digest of a batch."""
    column = batch.column(1).cast(pa.large_binary())
    ends = np.frombuffer(column.buffers()[1], dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    halves = np.frombuffer(column.buffers()[2] or b"", dtype=np.uint8)[ends[0] : ends[-1]].copy().view(np.uint64).reshape(-1, 2)
    return np.repeat(np.arange(len(column)), np.diff(ends) // 16), halves[:, 0], halves[:, 1]


NO_ID = np.iinfo(np.int64).min


def _ids(batch: pa.RecordBatch) -> np.ndarray:
    return batch.column(0).fill_null(NO_ID).to_numpy(zero_copy_only=False)


def counted(held: DataFrame) -> DataFrame:
    """Rows (first, second, n, largest): every digest, the documents that hold it and their largest id."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            row, first, second = _unpacked(batch)
            order = np.lexsort((second, first))
            first, second, ids = first[order], second[order], _ids(batch)[row[order]]
            fresh = np.ones(len(first), dtype=bool)
            fresh[1:] = (first[1:] != first[:-1]) | (second[1:] != second[:-1])
            head = np.flatnonzero(fresh)
            n = np.diff(np.append(head, len(first)))
            largest = np.maximum.reduceat(ids, head) if len(head) else ids[:0]
            parts = first[head].view(np.int64), second[head].view(np.int64), n, largest
            yield pa.RecordBatch.from_arrays([pa.array(p, pa.int64()) for p in parts], names=["first", "second", "n", "largest"])

    seen = held.mapInArrow(run, "first bigint, second bigint, n bigint, largest bigint")
    return seen.groupBy("first", "second").agg(F.sum("n").alias("n"), F.max("largest").alias("largest"))


def _built(part: dict[str, np.ndarray]) -> Index:
    count = np.minimum(part["n"], np.iinfo(np.uint32).max).astype("u4")
    return hashed_index.build(part["first"].view(np.uint64), part["second"].view(np.uint64), count, part["largest"])


def shard_of(first: np.ndarray, shards: int) -> np.ndarray:
    return ((first >> np.uint64(32)) * np.uint64(shards) >> np.uint64(32)).astype(np.int64)


_SHARD_SQL = "shiftright(shiftrightunsigned(first, 32) * {shards}L, 32)"


def index_shards(lines: DataFrame, shards: int) -> DataFrame:
    """Rows (shard, parts): the perfect hash and the arrays of each shard over the lines (first, second, n, largest)."""

    def run(key: tuple, group: pa.Table) -> pa.Table:
        index = _built({c: group.column(c).to_numpy() for c in ("first", "second", "n", "largest")})
        return pa.table({"shard": pa.array([key[0].as_py()], pa.int64()), "parts": pa.array([index.written()], pa.list_(pa.binary()))})

    dealt = lines.withColumn("shard", F.expr(_SHARD_SQL.format(shards=shards)))
    return dealt.groupBy("shard").applyInArrow(run, "shard bigint, parts array<binary>")


def _dropping(index: Index, first: np.ndarray, second: np.ndarray, ids: np.ndarray, documents: int) -> tuple[np.ndarray, np.ndarray]:
    """Whether the index knows each line, and whether the document of that id loses it."""
    place = index.places(first, second)
    known = place >= 0
    count, largest = (c[place[known]] for c in index.carried)
    lost = np.zeros(len(first), dtype=bool)
    lost[known] = (count >= documents) & (largest != ids[known]) & (ids[known] != NO_ID)
    return known, lost


def probes(held: DataFrame, head: list[bytes], shards: int) -> DataFrame:
    """Rows (shard, ids, halves): for each batch and shard its documents' digests that the head does not know."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known_lines = Index.read(head, CARRIED)
        for batch in batches:
            row, first, second = _unpacked(batch)
            ids = _ids(batch)[row]
            use = (known_lines.places(first, second) < 0) & (ids != NO_ID)
            first, second, ids = first[use], second[use], ids[use]
            shard = shard_of(first, shards)
            order = np.argsort(shard, kind="stable")
            at, begin = np.unique(shard[order], return_index=True)
            ends = np.append(begin, len(order))
            columns = [take_arrays(v[order], ends, pa.int64()) for v in (ids, first.view(np.int64), second.view(np.int64))]
            yield pa.RecordBatch.from_arrays([pa.array(at, pa.int64()), *columns], names=["shard", "ids", "first", "second"])

    return held.mapInArrow(run, "shard bigint, ids array<bigint>, first array<bigint>, second array<bigint>")


def answers(asked: DataFrame, index: DataFrame, settings: Settings) -> DataFrame:
    """Rows (doc_id, first): the lines that documents lose, as their shards know them."""

    def run(key: tuple, asked: pa.Table, index: pa.Table) -> pa.Table:
        out = [np.zeros(0, np.int64)] * 2
        if index.num_rows and asked.num_rows:
            known = Index.read(index.column("parts")[0].as_py(), CARRIED)
            ids, first, second = (asked.column(c).combine_chunks().flatten().to_numpy() for c in ("ids", "first", "second"))
            _, lost = _dropping(known, first.view(np.uint64), second.view(np.uint64), ids, settings.documents)
            out = [ids[lost], first[lost]]
        return pa.table({"doc_id": pa.array(out[0], pa.int64()), "first": pa.array(out[1], pa.int64())})

    return asked.groupBy("shard").cogroup(index.groupBy("shard")).applyInArrow(run, "doc_id bigint, first bigint")


def _cut(docs: DataFrame, text: str, head: list[bytes], settings: Settings) -> DataFrame:
    """``docs`` (with ``__lost``: first halves of lines to drop) with its results."""
    kept = [f for f in docs.schema.fields if f.name != "__lost"]
    schema = T.StructType([*kept, *RESULTS])
    names = docs.columns
    doc_at, text_at, lost_at = (names.index(c) for c in ("doc_id", text, "__lost"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known_lines = Index.read(head, CARRIED)
        for batch in batches:
            texts, n_lines, n_dropped = [], [], []
            for doc_id, text, lost in zip(batch.column(doc_at).to_pylist(), batch.column(text_at).cast(pa.binary()).to_pylist(), batch.column(lost_at).to_pylist()):
                lines = (text or b"").split(b"\n")
                n_lines.append(len(lines))
                left = lines
                if doc_id is not None and text:
                    keys = [key_of(line, settings.characters) for line in lines]
                    halves = np.frombuffer(b"".join(map(digest_of, filter(None, keys))), dtype=np.uint64).reshape(-1, 2)
                    _, gone = _dropping(known_lines, halves[:, 0], halves[:, 1], np.full(len(halves), doc_id), settings.documents)
                    if lost:
                        gone |= np.isin(halves[:, 0].view(np.int64), lost)
                    if gone.any():
                        verdict = iter(gone.tolist())
                        left = [line for line, key in zip(lines, keys) if not (key and next(verdict))]
                texts.append(b"\n".join(left))
                n_dropped.append(len(lines) - len(left))
            found = pa.array(texts, pa.binary()).cast(pa.string()), pa.array(n_lines, pa.int64()), pa.array(n_dropped, pa.int64())
            passed = [batch.column(names.index(f.name)) for f in kept]
            yield pa.RecordBatch.from_arrays([*passed, *found], names=[f.name for f in schema])

    return docs.mapInArrow(run, schema)


def deduplicated(docs: DataFrame, settings: Settings = Settings(), text: str = "text") -> DataFrame:
    """``docs`` with ``__kept_text``, ``__n_lines`` (before dropping) and ``__n_dropped``."""
    if not isinstance(docs.schema["doc_id"].dataType, T.IntegralType):
        raise TypeError("ids of documents must be integers")
    if clash := {"__lost", "__id", *(f.name for f in RESULTS)} & set(docs.columns):
        raise ValueError(f"columns clash: {sorted(clash)}")
    held = cut_lineage(digests(docs.select("doc_id", F.col(text).alias("text")), settings))
    lines = cut_lineage(counted(held))
    total = lines.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    repeated = lines.filter(F.col("n") >= settings.documents)
    often = F.col("n") > total // settings.head  # at most ``head`` lines
    rows = repeated.filter(often).collect()
    column = lambda c: np.array([r[c] for r in rows], dtype=np.int64)
    head = _built({c: column(c) for c in ("first", "second", "n", "largest")}).written()
    shards = max(1, -(-total // settings.shard_lines))
    index = cut_lineage(index_shards(repeated.filter(~often), shards))
    lost = answers(probes(held, head, shards), index, settings).groupBy("doc_id").agg(F.collect_list("first").alias("__lost"))
    # the answers' side is built into hash tables: texts are moved once, neither sorted nor spilled
    asked = docs.join(lost.withColumnRenamed("doc_id", "__id").hint("shuffle_hash"), F.col("doc_id") == F.col("__id"), "left").drop("__id")
    return _cut(asked, text, head, settings)
