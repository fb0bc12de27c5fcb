"""Byte-level BPE encoding and decoding (operator 12) on a serialised sentencepiece model.

A rank file (token bytes -> rank) is turned into a sentencepiece BPE model without any training: the
model's protocol buffer is written field by field.  Every byte stands for one printable character
(the usual byte-to-character map), so a token's bytes become a piece; its score is the negative
rank, its identifier the rank; the normaliser is the identity (no character map, no space in front,
no white space removed or escaped).  sentencepiece joins the best-scored adjacent pair, leftmost on
ties, which is the lowest-rank merge of byte-level BPE.

Texts are cut into pre-tokens by the vocabulary's pattern, and each pre-token is encoded on its own.
The pattern's letters and numbers are those of the library that defines the encoding: code points
that the ``regex`` module classes otherwise (a newer Unicode version) are found by asking
that library once, and stand in for a character of the right class while the text is cut.
Decoding maps identifiers to pieces and their characters back to bytes.

On Spark both directions are columns (Arrow batches, no shuffle); the serialised model is
broadcast, its size fixed by the vocabulary.  A task keeps the identifiers of pre-tokens it has met in
a memo of bounded bytes, which ends with the task.

Defined cases: null text counts as empty; an empty text has no identifiers and decodes to no bytes; a
null array of identifiers decodes to null; an identifier outside the vocabulary is an error; special strings in
a text are ordinary text; rows, ties and columns of the input are kept, clashing output names are replaced;
texts of any length are encoded whole.
"""

from __future__ import annotations

import base64
import re
import struct
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
import sentencepiece
import tiktoken
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf
from pyspark.sql.types import ArrayType, BinaryType, IntegerType, StructField, StructType

from .common import texts

MEMO_BYTES = 64 << 20       # of a task's memo of pre-tokens
GROUP = 1 << 19             # characters of texts that are encoded together
SLICE = 64                  # rows handed on together
LONGEST = 64                # characters of a pre-token that the memo keeps
NORMAL, UNKNOWN, BPE = 1, 2, 2      # fixed values of the model format: piece types, model type


def read_ranks(path: str) -> list[bytes]:
    """Tokens of a rank file, by rank (0, 1, ... without gaps)."""
    with open(path, "rb") as f:
        by = {int(rank): base64.b64decode(token) for token, rank in map(bytes.split, filter(None, f.read().splitlines()))}
    if sorted(by) != list(range(len(by))) or len(set(by.values())) != len(by):
        raise ValueError("ranks must be 0, 1, ... and tokens distinct")
    return [by[i] for i in range(len(by))]


@lru_cache(maxsize=1)
def byte_characters() -> str:
    """The character of each byte: itself if printable and no space, else one from U+0100 on, in order."""
    own = [*range(ord("!"), ord("~") + 1), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(own)]
    char = {b: chr(b) for b in own} | {b: chr(0x100 + i) for i, b in enumerate(rest)}
    return "".join(char[b] for b in range(256))


def to_characters(data: bytes) -> str:
    return data.decode("latin-1").translate(byte_characters())


@lru_cache(maxsize=1)
def _byte_of() -> dict[str, int]:
    return {c: b for b, c in enumerate(byte_characters())}


def to_bytes(piece: str) -> bytes:
    """The inverse map."""
    return bytes(map(_byte_of().__getitem__, piece))


# ------------------------------------------------------------------ the model's protocol buffer
def _varint(n: int) -> bytes:
    out = bytearray()
    while n > 127:
        out.append(n & 127 | 128)
        n >>= 7
    return bytes([*out, n])


def _number(field: int, n: int) -> bytes:
    return _varint(field << 3) + _varint(n)


def _block(field: int, data: bytes) -> bytes:
    return _varint(field << 3 | 2) + _varint(len(data)) + data


def _piece(text: str, score: float, kind: int) -> bytes:
    return _block(1, text.encode()) + _varint(2 << 3 | 5) + struct.pack("<f", score) + _number(3, kind)


def serialise(tokens: list[bytes]) -> bytes:
    """The sentencepiece model of ``tokens``: pieces (field 1), trainer (2) and normaliser settings (3).  The unknown
    piece, which the format demands, comes last and is never met: all single bytes are pieces."""
    if missing := set(range(256)) - {t[0] for t in tokens if len(t) == 1}:
        raise ValueError(f"{len(missing)} bytes are no tokens")
    if len(tokens) >= 1 << 24:
        raise ValueError("scores hold 24 bits")
    pieces = [_piece(to_characters(t), -float(rank), NORMAL) for rank, t in enumerate(tokens)]
    pieces.append(_piece("<unk>", -float(len(tokens)), UNKNOWN))
    trainer = _number(3, BPE) + _number(4, len(pieces)) + _number(40, len(tokens))
    normaliser = _block(1, b"identity") + b"".join(_number(f, 0) for f in (3, 4, 5))
    return b"".join(_block(1, p) for p in pieces) + _block(2, trainer) + _block(3, normaliser)


# ------------------------------------------------------------------ pre-tokens
@lru_cache(maxsize=1)
def _other_class() -> dict[int, str]:
    """Code points that the encoding's library and ``regex`` class otherwise -> a character of the library's class."""
    every = "".join(map(chr, [*range(0xD800), *range(0xE000, 0x110000)]))
    single, out = {bytes([b]): b for b in range(256)}, {}
    mine, theirs = {}, {}
    for kind, stand_in in ((r"\p{L}", "z"), (r"\p{N}", "0"), (r"\s", " ")):
        enc = tiktoken.Encoding("class", pat_str=kind, mergeable_ranks=single, special_tokens={})
        theirs |= dict.fromkeys(bytes(enc.encode_ordinary(every)).decode(), stand_in)
        mine |= dict.fromkeys(regex.findall(kind, every), stand_in)
    for c in mine.keys() | theirs.keys():
        if mine.get(c) != theirs.get(c):
            out[ord(c)] = theirs.get(c, "")
    return out


class Cutter:
    """Cuts a text into the matches of a pattern."""

    def __init__(self, pattern: str, other: dict[int, str]):
        self.pattern, self.other = regex.compile(pattern), other
        starts = [c for c in other if c - 1 not in other]
        ends = [c for c in other if c + 1 not in other]
        spans = "".join(f"{re.escape(chr(a))}-{re.escape(chr(b))}" for a, b in zip(sorted(starts), sorted(ends)))
        self.odd = re.compile(f"[{spans}]") if other else None
        self.far = re.compile(f"[{re.escape(chr(min(other, default=0)))}-\U0010ffff]")      # quick test for most texts

    def __call__(self, text: str) -> list[str]:
        if self.odd and not text.isascii() and self.far.search(text) and self.odd.search(text):
            return [text[m.start():m.end()] for m in self.pattern.finditer(text.translate(self.other))]
        return self.pattern.findall(text)


class Codec:
    """Identifiers of texts and bytes of identifiers, under one serialised model."""

    def __init__(self, model: bytes, pattern: str, other: dict[int, str], memo_bytes: int = MEMO_BYTES):
        self.sp = sentencepiece.SentencePieceProcessor(model_proto=model)
        self.cut = Cutter(pattern, other)
        self.char = byte_characters()
        pieces = [self.sp.id_to_piece(i) for i in range(self.sp.get_piece_size() - 1)]
        self.bytes_of = [to_bytes(p) for p in pieces]
        self.four = [i.to_bytes(4, "little") for i in range(len(pieces))]
        self.rank_of = {p: i for i, p in enumerate(pieces)}
        self.memo: dict[str, bytes] = {}
        self.held, self.limit = 0, memo_bytes

    def encode_new(self, words: list[str]) -> list[bytes]:
        """Little-endian 32-bit identifiers of pre-tokens; one that is itself a token is that token."""
        chars = [w.encode().decode("latin-1").translate(self.char) for w in words]
        join, four = b"".join, self.four
        return [join([four[k] for k in ids]) if len(ids) < 2 or c not in self.rank_of else four[self.rank_of[c]]
                for c, ids in zip(chars, self.sp.encode(chars, num_threads=1))]

    def _encode_group(self, group: list[str]) -> list[bytes]:
        words = list(map(self.cut, group))
        memo = self.memo
        new = [w for w in set().union(*words) if w not in memo]
        more = {}
        for w, ids in zip(new, self.encode_new(new) if new else ()):
            if len(w) > LONGEST or self.held >= self.limit:
                more[w] = ids
            else:
                memo[w] = ids
                self.held += 160 + 2 * len(w) + len(ids)
        if more:
            out = [b"".join([more.get(w) or memo[w] for w in ws]) for ws in words]
        else:
            out = [b"".join(map(memo.__getitem__, ws)) for ws in words]
        if self.held >= self.limit:
            self.memo, self.held = {}, 0
        return out

    def encode(self, batch: list[str]) -> list[bytes]:
        """Identifiers (little-endian, 32 bits) of each text; texts are taken in groups of about ``GROUP`` characters, so
        that pre-tokens that are new are encoded together and little is held."""
        out, group, size = [], [], 0
        for t in batch:
            group.append(t)
            size += len(t)
            if size >= GROUP:
                out += self._encode_group(group)
                group, size = [], 0
        return out + self._encode_group(group)

    def decode(self, ids: list[int]) -> bytes:
        if ids and min(ids) < 0:
            raise IndexError("identifier outside the vocabulary")
        return b"".join(map(self.bytes_of.__getitem__, ids))


def _lists(ids: list[bytes]) -> pa.ListArray:
    ends = np.cumsum([0, *(len(i) // 4 for i in ids)], dtype=np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.Array.from_buffers(pa.int32(), int(ends[-1]), [None, pa.py_buffer(b"".join(ids))]))


class ByteBpe:
    """Columns that encode and decode under the rank file at ``ranks_path`` and its pattern; read on the driver,
    sent to tasks as one broadcast of fixed size."""

    def __init__(self, spark: SparkSession, ranks_path: str, pattern: str):
        parts = serialise(read_ranks(ranks_path)), pattern, _other_class()
        self.shared = spark.sparkContext.broadcast(parts)

    def encode(self, text: str | Column) -> Column:
        """array<int> of a text's identifiers."""
        shared = self.shared

        @arrow_udf("array<int>")
        def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
            codec = Codec(*shared.value)
            for arr in batches:
                yield _lists(codec.encode(texts(arr)))

        return run(text)

    def decode(self, ids: str | Column) -> Column:
        """binary: the bytes of an array of identifiers."""
        shared = self.shared

        @arrow_udf("binary")
        def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
            codec = Codec(*shared.value)
            for arr in batches:
                yield pa.array([None if i is None else codec.decode(i) for i in arr.to_pylist()], pa.binary())

        return run(ids)


def encode_decode(docs: DataFrame, ranks_path: str, pattern: str, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """The columns ``keep`` (default: all) of ``docs`` with ``ids`` (identifiers of the text) and ``decoded`` (their bytes).

    One pass: a task takes a few rows of a batch at a time and hands them on, so that it holds little beside its memo."""
    kept = [c for c in (docs.columns if keep is None else keep) if c.lower() not in ("ids", "decoded")]
    rows = docs.select(*kept, F.coalesce(F.col(text).cast("string"), F.lit("")).alias("decoded"))
    fields = [rows.schema[c] for c in kept]
    schema = StructType([*fields, StructField("ids", ArrayType(IntegerType())), StructField("decoded", BinaryType())])
    shared = ByteBpe(docs.sparkSession, ranks_path, pattern).shared

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = Codec(*shared.value)
        for b in batches:
            for a in range(0, b.num_rows, SLICE):
                part = b.slice(a, SLICE)
                ids = codec.encode(part.column(part.num_columns - 1).to_pylist())
                back = [codec.decode(np.frombuffer(i, "<i4").tolist()) for i in ids]
                yield pa.RecordBatch.from_arrays([*part.columns[:-1], _lists(ids), pa.array(back, pa.binary())],
                                                 names=[*kept, "ids", "decoded"])

    return rows.mapInArrow(run, schema)


def ids_sha256(ids: str) -> Column:
    """Lower-case hex of the decimal identifiers joined by one space."""
    return F.sha2(F.array_join(F.col(ids).cast("array<string>"), " ").cast("binary"), 256)
