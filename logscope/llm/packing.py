"""Best-fit packing (operator 1): bounded-space online best fit.

Documents become token sequences; only those longer than ``capacity`` are cut, into pieces of
``capacity`` tokens (the last may be shorter).  Pieces arrive one after another at a packer
that keeps a fixed number of open bins, keyed by their free space: bit ``f`` of one integer
says whether a bin with ``f`` free tokens is open.  A piece goes into the open bin with the
least sufficient free space (lowest set bit at or above its length); when a new bin would
exceed the fixed number, the fullest open bin closes first (lowest set bit of all).

On Spark: one pass tokenises the texts into narrow piece rows (about 40 bytes each), written
once to the shared checkpoint folder; they are dealt by a hash into tasks of about
``pieces_per_task`` pieces, and each task runs its own packer, so no state is shared and a lost
task is simply run again.  Sequence ids are the task's number in the upper 31 bits and the
bin's number in the lower 32.

Defined cases: null text counts as empty, and an empty document is the lone end token
(length 1); rows that repeat are packed as often as they occur; null ids are kept.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import LongType, StructField, StructType
from tokenizers import Tokenizer

from .byte_bpe import byte_characters
from .common import Memo, cut, slices, texts

CAPACITY = 2048
OPEN_BINS = 512
PIECES_PER_TASK = 100_000
MEMO_BYTES = 192 << 20     # of a task's memo of words
MARKS = ".,!?;:%*&$#|()"
PLAIN = "\u0130"          # below it, lower case is one letter for one letter
PIECE = "array<struct<piece:int,start:long,length:long,ids_crc32:long>>"


class BestFit:
    """Bounded-space online best fit over bins of ``capacity``."""

    def __init__(self, capacity: int, open_bins: int):
        self.capacity, self.limit = capacity, open_bins
        self.bits, self.open, self.made = 0, 0, 0
        self.by_free: dict[int, list[int]] = {}

    def _take(self, free: int) -> int:
        bins = self.by_free[free]
        b = bins.pop()
        if not bins:
            self.bits &= ~(1 << free)
        self.open -= 1
        return b

    def put(self, length: int) -> tuple[int, int]:
        """(bin, offset) of a piece of ``length`` tokens (1 to capacity)."""
        fit = self.bits >> length << length
        if fit:
            free = (fit & -fit).bit_length() - 1
            b = self._take(free)
        else:
            if self.open >= self.limit:
                self._take((self.bits & -self.bits).bit_length() - 1)
            b, free, self.made = self.made, self.capacity, self.made + 1
        left = free - length
        if left:
            self.by_free.setdefault(left, []).append(b)
            self.bits |= 1 << left
            self.open += 1
        return b, self.capacity - free


def word_tokenizer(path: str, memo_bytes: int = MEMO_BYTES) -> Callable[[str], bytes]:
    """A function text -> ids (little-endian unsigned 32-bit) for a tokenizers file whose
    normaliser and pattern drop white space, so words are encoded one by one and kept in a memo of bounded bytes.  Byte-level
    vocabularies in lower case only, as the file named in the module's queries."""
    tok, chars = Tokenizer.from_file(path), byte_characters()
    merges, four = tok.model.tokenize, [i.to_bytes(4, "little") for i in range(tok.get_vocab_size())]

    def encode(word: str) -> bytes:
        # what encodes alike is encoded once: the vocabulary's own pattern always cuts between a
        # letter and the marks behind it, and its normaliser lower-cases letter by letter
        plain = word.isascii() or max(word) < PLAIN
        stem = word.rstrip(MARKS) if plain else word
        low = word.lower() if plain else word
        if len(stem) < len(word) and stem and stem[-1].isalpha():
            return words[stem] + words[word[len(stem):]]
        if low != word and "<|" not in word:
            return words[low]
        if plain and word.isalpha():
            # one match of the pattern, normal already: straight to the merges, as bytes' characters
            letters = word if word.isascii() else word.encode().decode("latin-1").translate(chars)
            return b"".join([four[t.id] for t in merges(letters)])
        return b"".join(i.to_bytes(4, "little") for i in tok.encode(word, add_special_tokens=False).ids)

    words = Memo(encode, memo_bytes)

    def ids(text: str) -> bytes:
        return b"".join(map(words.__getitem__, text.replace("\n", " ").split(" "))) if text else b""

    return ids


def pieces(text: str | Column, tokenizer_path: str, capacity: int = CAPACITY, end_id: int = 0, memo_bytes: int = MEMO_BYTES) -> Column:
    """Array of (piece, start, length, ids_crc32) of each text's tokens followed by ``end_id``."""
    end, width = end_id.to_bytes(4, "little"), 4 * capacity
    typ = pa.list_(pa.struct([("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()),
                              ("ids_crc32", pa.int64())]))

    @arrow_udf(PIECE)
    def encode(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        ids = word_tokenizer(tokenizer_path, memo_bytes)
        for parts in slices(batches):
            out = []
            for t in (t for part in parts for t in texts(part)):
                seq = ids(t) + end
                out.append([{"piece": k, "start": k * capacity, "length": len(p) // 4, "ids_crc32": zlib.crc32(p)}
                            for k, p in enumerate(seq[a:a + width] for a in range(0, len(seq), width))])
            yield pa.array(out, typ)

    return encode(text)


def pack(items: DataFrame, length: str = "length", capacity: int = CAPACITY, open_bins: int = OPEN_BINS,
         per_task: int = PIECES_PER_TASK) -> DataFrame:
    """``items`` (a stored, narrow table) with ``sequence_id`` and ``offset``.

    ``length`` must lie in 1..capacity.  The number of tasks grows with the number of items."""
    n = items.count()
    tasks = max(1, -(-n // per_task))
    out = StructType(items.schema.fields + [StructField("sequence_id", LongType()), StructField("offset", LongType())])
    schema = to_arrow_schema(out)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        base = TaskContext.get().partitionId() << 32
        packer = BestFit(capacity, open_bins)
        for b in batches:
            placed = [packer.put(x) for x in b.column(b.schema.get_field_index(length)).to_pylist()]
            cols = [*b.columns, pa.array([base + s for s, _ in placed], pa.int64()),
                    pa.array([o for _, o in placed], pa.int64())]
            yield pa.RecordBatch.from_arrays([c.cast(f.type) for c, f in zip(cols, schema)], schema=schema)

    # a hash of the whole row deals the items evenly and mixes lengths, which best fit needs
    dealt = items.repartition(tasks, F.xxhash64(*items.columns)) if tasks > 1 else items.coalesce(1)
    return dealt.mapInArrow(run, out)


def pack_documents(docs: DataFrame, tokenizer_path: str, doc_id: str = "doc_id", text: str = "text",
                   capacity: int = CAPACITY, open_bins: int = OPEN_BINS, end_id: int = 0,
                   memo_bytes: int = MEMO_BYTES) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset."""
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.explode(pieces(text, tokenizer_path, capacity, end_id, memo_bytes)).alias("p"))
    return pack(cut(rows.select("doc_id", "p.*")), "length", capacity, open_bins)
