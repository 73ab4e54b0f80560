"""SentencePiece encoding and decoding with the tokenizers library.

The model file is read as plain protobuf wire format. From its pieces, scores and specifications a tokenizer
is rebuilt: the normaliser (compiled character map, white-space rules), the metaspace marker, unigram scores
or the merges that byte-pair scores stand for, and byte fallback. No piece of a model may hold the marker
after another character for words to be encoded apart; models that do are encoded text by text.

Distinct words are encoded in batches, in as many threads as a task has cores, and kept in a bounded cache.
Each distinct word's ids are compared with those of the sentencepiece library and decoded again by the rebuilt
decoder, in runs of words as they stand in a text, and one by one where a run does not come back. So every row
carries whether its whole text agrees with the library and comes back unchanged.

Null and empty texts have no ids, and agree. Strings of control symbols are ordinary text.
"""

from __future__ import annotations

import os
import struct
from array import array
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field
from functools import lru_cache
from itertools import accumulate, chain
from operator import eq

import numpy as np
import public_tokenizers
import pyarrow as pa
import sentencepiece
import tokenizers
from pyspark.sql import DataFrame
from pyspark.sql import types as T
from tokenizers import decoders, models, normalizers, pre_tokenizers

from harmlens.llm.batches import attach, take_arrays

MARK = "▁"
MODEL = public_tokenizers.path("piece_bpe_32k.model")
#: Field numbers and kinds of the public protobuf schema; fixed values.
PIECES, TRAINER, NORMALIZER = 1, 2, 3
NORMAL, UNKNOWN, CONTROL, USER_DEFINED, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
UNIGRAM, BPE = 1, 2
TOGETHER = 32  # distinct words that are decoded as one run
FIELDS = [T.StructField("__ids", T.ArrayType(T.IntegerType())), T.StructField("__parity", T.BooleanType()), T.StructField("__round_trip", T.BooleanType())]


def wire(data: bytes) -> Iterator[tuple[int, int | bytes]]:
    """Fields of a protobuf message."""
    at = 0

    def varint() -> int:
        nonlocal at
        value = shift = 0
        while True:
            byte = data[at]
            at += 1
            value |= (byte & 127) << shift
            shift += 7
            if byte < 128:
                return value

    while at < len(data):
        key = varint()
        kind = key & 7
        if kind == 0:
            yield key >> 3, varint()
            continue
        size = {1: 8, 5: 4}[kind] if kind != 2 else varint()
        yield key >> 3, data[at : at + size]
        at += size


@dataclass
class PieceModel:
    """What a model file says."""

    pieces: list[tuple[str, float, int]] = field(default_factory=list)  # piece, score, kind
    kind: int = UNIGRAM
    byte_fallback: bool = False
    charsmap: bytes = b""
    dummy_prefix: bool = True
    trim: bool = True
    escape: bool = True

    @classmethod
    def parse(cls, data: bytes) -> PieceModel:
        out = cls()
        for number, value in wire(data):
            if number == PIECES:
                one = dict(wire(value))
                out.pieces.append((one.get(1, b"").decode(), struct.unpack("<f", one[2])[0] if 2 in one else 0.0, one.get(3, NORMAL)))
            elif number == TRAINER:
                spec = dict(wire(value))
                out.kind, out.byte_fallback = spec.get(3, UNIGRAM), bool(spec.get(35, 0))
            elif number == NORMALIZER:
                spec = dict(wire(value))
                out.charsmap = spec.get(2, b"")
                out.dummy_prefix, out.trim, out.escape = (bool(spec.get(k, 1)) for k in (3, 4, 5))
        return out

    @property
    def unknown(self) -> int:
        return next(i for i, (_, _, kind) in enumerate(self.pieces) if kind == UNKNOWN)

    @property
    def by_words(self) -> bool:
        """Whether no piece goes on over a marker, so that words can be encoded apart."""
        plain = self.escape and self.dummy_prefix and not self.trim and not self.charsmap
        return plain and not any(MARK in piece.lstrip(MARK) for piece, _, kind in self.pieces if kind == NORMAL)


def rebuild(model: PieceModel) -> tokenizers.Tokenizer:
    """The same tokenizer in the other library."""
    usable = {piece: i for i, (piece, _, kind) in enumerate(model.pieces) if kind in (NORMAL, USER_DEFINED)}
    if model.kind == BPE:
        vocabulary = {piece: i for i, (piece, _, _) in enumerate(model.pieces)}
        # each way to put a piece together from two others; higher scores merge first
        merges = [(-model.pieces[i][1], i, piece[:k], piece[k:]) for piece, i in usable.items() for k in range(1, len(piece)) if piece[:k] in usable and piece[k:] in usable]
        core = models.BPE(vocab=vocabulary, merges=[(a, b) for *_, a, b in sorted(merges, key=lambda m: (m[0], m[1], len(m[2])))], unk_token=model.pieces[model.unknown][0], fuse_unk=True, byte_fallback=model.byte_fallback)
    elif model.kind == UNIGRAM:
        core = models.Unigram([(piece, score) for piece, score, _ in model.pieces], unk_id=model.unknown, byte_fallback=model.byte_fallback)
    else:
        raise ValueError(f"model kind {model.kind} is not supported")
    out = tokenizers.Tokenizer(core)
    steps = [normalizers.Precompiled(model.charsmap)] if model.charsmap else []
    if model.trim:
        steps += [normalizers.Replace(tokenizers.Regex(" {2,}"), " "), normalizers.Strip()]
    if model.dummy_prefix:
        steps.append(normalizers.Prepend(MARK if model.escape else " "))
    if model.escape:
        steps.append(normalizers.Replace(" ", MARK))
    out.normalizer = normalizers.Sequence(steps)
    # words that start with the marker are independent of the word before
    if model.by_words:
        out.pre_tokenizer = pre_tokenizers.Split(tokenizers.Regex(f"(?<=[^{MARK}])(?={MARK})"), "isolated")
    back = [decoders.Replace(MARK, " "), decoders.ByteFallback(), decoders.Fuse()]
    out.decoder = decoders.Sequence(back + ([decoders.Strip(" ", 1, 0)] if model.dummy_prefix else []))
    out.encode_special_tokens = True
    return out


@lru_cache(maxsize=1)
def loaded(path: str) -> tuple[PieceModel, tokenizers.Tokenizer, sentencepiece.SentencePieceProcessor]:
    with open(path, "rb") as file:
        data = file.read()
    model = PieceModel.parse(data)
    return model, rebuild(model), sentencepiece.SentencePieceProcessor(model_proto=data)


def _words(text: str) -> list[str]:
    """The text in pieces whose concatenation, one space before each, is a space and the text."""
    parts = text.split(" ")
    if "" not in parts:
        return parts
    out, run = [], 0
    for part in parts:
        if part:
            out.append(" " * run + part)
            run = 0
        else:
            run += 1
    if run:
        out.append(" " * (run - 1))
    return out


class Encoder:
    """Ids of texts by way of distinct words, which are numbered as they appear."""

    def __init__(self, path: str, bound: int = 400_000, threads: int | None = None):
        threads = threads or int(os.environ.get("OMP_NUM_THREADS") or 1)  # Spark sets it to a task's cores
        os.environ["TOKENIZERS_PARALLELISM"] = "true" if threads > 1 else "false"
        os.environ["RAYON_NUM_THREADS"] = str(threads)
        self.model, self.tokenizer, self.reference = loaded(path)
        self.bound, self.threads, self.by_words = bound, threads, self.model.by_words
        self._forget()

    def _forget(self) -> None:
        self.numbers: dict[str, int] = {}
        self.ids, self.ends = array("i"), array("q", [0])
        self.agree, self.same = bytearray(), bytearray()  # with the library's ids; with the word when decoded

    def _learn(self, keys: list[str]) -> None:
        texts = [k[1:] if k[0:1] == MARK else k for k in keys]
        own = [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
        theirs = self.reference.encode(texts, num_threads=self.threads)
        self.agree.extend(map(eq, own, theirs))
        self.same.extend(self._come_back(own, texts))
        first = len(self.numbers)
        self.numbers.update(zip(keys, range(first, first + len(keys))))
        self.ids.extend(chain.from_iterable(own))
        self.ends.extend(accumulate(map(len, own), initial=self.ends.pop()))

    def _come_back(self, ids: list[list[int]], texts: list[str]) -> list[bool]:
        """Whether the decoder gives each text back: of words a run at a time, as they stand in a text, else one by one."""
        runs = range(0, len(ids), TOGETHER)
        if self.by_words:
            decoded = self.decode([list(chain.from_iterable(ids[at : at + TOGETHER])) for at in runs])
            right = [text == " ".join(texts[at : at + TOGETHER]) for text, at in zip(decoded, runs)]
        else:
            right = [False] * len(runs)
        single = [i for at, ok in zip(runs, right) if not ok for i in range(at, min(at + TOGETHER, len(ids)))]
        out = [True] * len(ids)
        for i, text in zip(single, self.decode([ids[i] for i in single])):
            out[i] = text == texts[i]
        return out

    def decode(self, ids: list[list[int]]) -> list[str]:
        return self.tokenizer.decode_batch(ids, skip_special_tokens=False)

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """All ids, where each text's end, parity with the library, and whether decoding gives the text back.

        Texts that end in a space or hold the marker are encoded whole, under the marker and the text.
        """
        split = [[] if not t else _words(t) if self.by_words and MARK not in t and t[-1] != " " else [MARK + t] for t in texts]
        if len(self.numbers) > self.bound:
            self._forget()
        new = list(set(chain.from_iterable(split)) - self.numbers.keys())
        for at in range(0, len(new), 4096):
            self._learn(new[at : at + 4096])
        words = np.fromiter(map(self.numbers.__getitem__, chain.from_iterable(split)), dtype=np.int64)
        ends = np.array(self.ends, dtype=np.int64)
        begin, length = ends[words], ends[words + 1] - ends[words]
        stops = np.cumsum(length)
        place = np.repeat(begin - (stops - length), length) + np.arange(stops[-1] if len(stops) else 0)
        per_text = np.concatenate([[0], np.cumsum([len(w) for w in split])]).astype(np.int64)
        whole = lambda flags: np.diff(np.concatenate([[0], np.cumsum(1 - np.frombuffer(bytes(flags), dtype=np.int8)[words].astype(np.int64))])[per_text]) == 0
        return np.array(self.ids, dtype=np.int32)[place], np.concatenate([[0], stops])[per_text], whole(self.agree), whole(self.same)


@lru_cache(maxsize=1)
def encoder(path: str) -> Encoder:
    """One per worker process, so that tasks share what is known about words."""
    return Encoder(path)


def encoded(docs: DataFrame, path: str = MODEL, text: str = "text") -> DataFrame:
    """``docs`` with ``__ids``, ``__parity`` and ``__round_trip`` of each whole text."""

    def scorer() -> Callable[[pa.Array], list]:
        def score(column: pa.Array) -> list:
            ids, ends, agree, same = encoder(path).encode([t or "" for t in column.to_pylist()])
            return [take_arrays(ids, ends, pa.int32()), agree, same]

        return score

    return attach(docs, text, FIELDS, scorer)


def decoded(rows: DataFrame, ids: str = "ids", path: str = MODEL) -> DataFrame:
    """``rows`` with ``__text``, the text of an id column; null and empty ids give an empty text."""
    names = rows.columns
    at = names.index(ids)
    schema = T.StructType([*rows.schema.fields, T.StructField("__text", T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, batch.num_rows, 512):
                part = batch.slice(lo, 512)
                texts = encoder(path).decode([i or [] for i in part.column(at).to_pylist()])
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(texts, pa.string())], names=[*names, "__text"])

    return rows.mapInArrow(run, schema)


