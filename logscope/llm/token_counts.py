"""Token counts (operator 9): heap-and-linked-list byte-pair merging.

The vocabulary of a sentencepiece BPE model gives each piece a score; the merge of two
adjacent symbols is possible when their concatenation is a piece.  The best-scored
(lowest-rank) pair, leftmost on ties, is popped from a heap and joined in a linked list, until
no pair can be merged.  The token count is the number of initial symbols minus the number of
merges; a character outside the vocabulary counts as one initial symbol per UTF-8 byte
(byte fallback).  No identifiers are produced.

A merge can never join two characters that are adjacent in no piece of the vocabulary, so a
text is cut there (in particular before every word) and the counts of the parts add up exactly;
parts repeat, so their counts are kept in a bounded memo per task.

Defined cases: null text counts as empty; empty text has 0 tokens; ``n_bytes`` is the UTF-8
length; special strings inside a text are ordinary text, as the library's default; rows,
ties and columns of the input are kept as they are.
"""

from __future__ import annotations

import heapq
import os
from collections.abc import Iterator
from operator import add

import pyarrow as pa
import sentencepiece
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from .common import Memo, slices, texts

SPACE = "▁"
MEMO_BYTES = 128 << 20      # of a task's memos: a third for parts of words, the rest for words


def merge_count(part: str, cost: dict[str, float]) -> int:
    """Tokens of ``part`` after all merges; ``cost`` maps a piece to its rank (lower first)."""
    n = len(part)
    start = sum([1 if c in cost else len(c.encode()) for c in part])
    if n < 2:
        return start
    sym, nxt, prv = list(part), list(range(1, n + 1)), list(range(-1, n - 1))
    heap = []
    for i in range(n - 1):
        r = cost.get(part[i:i + 2])
        if r is not None:
            heap.append((r, i, i + 1, 2))
    heapq.heapify(heap)
    merges = 0
    while heap:
        _, i, j, size = heapq.heappop(heap)
        if not sym[i] or not sym[j] or nxt[i] != j or len(sym[i]) + len(sym[j]) != size:
            continue        # one of the two has been merged meanwhile
        sym[i] += sym[j]
        sym[j] = ""
        merges += 1
        k = nxt[i] = nxt[j]
        if k < n:
            prv[k] = i
            r = cost.get(sym[i] + sym[k])
            if r is not None:
                heapq.heappush(heap, (r, i, k, size + len(sym[k])))
        h = prv[i]
        if h >= 0:
            r = cost.get(sym[h] + sym[i])
            if r is not None:
                heapq.heappush(heap, (r, h, i, len(sym[h]) + size))
    return start - merges


class PieceCounter:
    """Counts the tokens of texts for one sentencepiece BPE model."""

    def __init__(self, model_path: str, memo_bytes: int = MEMO_BYTES):
        sp = sentencepiece.SentencePieceProcessor(model_file=model_path)
        self.cost = {sp.id_to_piece(i): -sp.get_score(i) for i in range(sp.get_piece_size())
                     if not (sp.is_control(i) or sp.is_byte(i) or sp.is_unknown(i) or sp.is_unused(i))}
        self.joined = {p[i:i + 2] for p in self.cost for i in range(len(p) - 1)}
        self.parts = Memo(lambda part: merge_count(part, self.cost), memo_bytes // 3)
        self.words = Memo(lambda word: self.segment(SPACE + word), memo_bytes - memo_bytes // 3)
        # words are looked up one by one only where the model adds one space in front, keeps
        # the text as it is and has no piece that runs on into the next word
        plain = "Ab  ﬁ①é\t\n"
        self.by_word = (sp.normalize(plain) == SPACE + plain.replace(" ", SPACE)
                        and not any(a != SPACE and b == SPACE for a, b in self.joined))
        self.normal = sp.normalize

    def segment(self, seg: str) -> int:
        """Tokens of normalised text, cut wherever no piece of the vocabulary can span."""
        joined, parts, total, a = self.joined, self.parts, 0, 0
        for i, pair in enumerate(map(add, seg, seg[1:]), 1):
            if pair not in joined:
                total, a = total + parts[seg[a:i]], i
        return total + parts[seg[a:]] if seg else 0

    def count(self, text: str) -> int:
        if not text:
            return 0
        if not self.by_word:
            return self.segment(self.normal(text))
        if "  " in text or SPACE in text or text[0] == " " or text[-1] == " ":
            return self.segment(SPACE + text.replace(" ", SPACE))
        return sum(map(self.words.__getitem__, text.split(" ")))


def token_count(text: str | Column, model_path: str) -> Column:
    """Column of token counts of ``text`` under the model file at ``model_path`` (the same
    path on every executor)."""
    if not os.path.basename(model_path).endswith(".model"):
        raise ValueError("expected a sentencepiece .model file")

    @arrow_udf("long")
    def count(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        counter = PieceCounter(model_path)
        for parts in slices(batches):
            yield pa.array([counter.count(t) for part in parts for t in texts(part)], pa.int64())

    return count(text)


def count_tokens(docs: DataFrame, model_path: str, text: str = "text", limit: int = 4096) -> DataFrame:
    """``docs`` with ``n_bytes``, ``n_tokens`` and ``over_limit`` (more than ``limit`` tokens);
    columns of those names are replaced."""
    body = F.coalesce(F.col(text), F.lit(""))
    return (docs.withColumns({"n_bytes": F.octet_length(body).cast("long"), "n_tokens": token_count(text, model_path)})
            .withColumn("over_limit", F.col("n_tokens") > limit))
