"""Benchmark decontamination (operator 2): q-gram lemma filtering and banded alignment.

Texts are compared as normalised bytes: lower-cased by Unicode, ASCII punctuation removed, white space
single.  An item is found by either of two rules, for edits of letters and for excerpts.

*Passages.*  Each benchmark item is cut into passages of ``PASSAGE`` bytes that overlap by half (a shorter
item is one passage; the last one ends with the item).  A document is contaminated by an item
when some region of it is within ``k = floor(EDIT_RATE * m)`` edits of one of its passages (m bytes).

*Filter.*  By the q-gram lemma such a region shares at least ``m + 1 - q - k*q`` q-grams with the
passage, and their diagonals (place in the document minus place in the passage) differ by at
most ``k``.  Diagonals are dealt into bands of width ``BAND`` that overlap by ``k``, so one band holds
them all; the shared q-grams of each (passage, band) are counted and bands below the bound
are left out.  The bound is positive as ``EDIT_RATE * q < 1``.

*Verify.*  What the filter retains is aligned inside its band by dynamic programming (free ends
in the document), all regions of a batch side by side.

*Runs.*  A document is also contaminated by an item when any ``WORDS`` words of the item that follow
each other, wherever they start, are within ``WORD_EDITS`` words (replaced, left out or put in) of some run of
its words.  An item of 8 to 12 words must be there whole within one word, a shorter one exactly.  By the
pigeonhole principle such a run holds ``GRAM`` words in sequence unchanged; these are the seeds, one for
each exact run, and are extended to both sides by dynamic programming over words.  So the rule is exact.
Words are what white space parts: a text in a script without spaces is met by the passage rule alone.

The benchmark is the stated query set: it is collected in blocks of at most ``BLOCK_BYTES`` of text (a
longer item is a block of its own), and each block is broadcast and met by all documents.  Documents are
never shuffled; memory per task is bounded by a slice of a document and its hits.

Defined cases: null texts count as empty and are clean; items shorter than ``MIN_ITEM`` normalised bytes
have no passage and are found by words alone; one of fewer than three words and ``MIN_SHORT`` bytes
is found only where it is the whole text; an item without letters or digits is skipped; equal items are all reported; repeated documents are reported
each; an empty benchmark leaves all documents clean.
"""

from __future__ import annotations

import string
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from .common import raw

Q = 12
PASSAGE = 96
EDIT_RATE = 0.05
BAND = 16
MIN_ITEM = 40
WORDS = 13
WORD_EDITS = 2
GRAM = 4
MIN_SHORT = 16
BLOCK_BYTES = 1 << 20
SLICE = 1 << 20

_TABLE = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))
_MARKS = string.punctuation.encode()


def normalise(text: bytes) -> bytes:
    text = text.translate(_TABLE, _MARKS)
    if not text.isascii():
        text = text.decode("utf-8", "surrogateescape").lower().encode("utf-8", "surrogateescape")
    return b" ".join(text.split())


def groups(docs: list[bytes]) -> Iterator[list[bytes]]:
    """Normalised texts, short ones side by side in groups of about ``SLICE`` bytes."""
    group: list[bytes] = []
    size = 0
    for t in docs:
        t = normalise(t)
        if group and size + len(t) > SLICE:
            yield group
            group, size = [], 0
        group.append(t)
        size += len(t)
    yield group


def qgrams(buf: np.ndarray) -> np.ndarray:
    """A 64-bit mix of each Q-byte window (Q between 8 and 16)."""
    n = len(buf) - Q + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    at = lambda k: np.ndarray((n,), "<u8", buf.data, k, (1,))  # noqa: E731  unaligned view
    h = at(0) * np.uint64(0x9E3779B97F4A7C15)
    h ^= h >> np.uint64(29)
    h += at(Q - 8) * np.uint64(0xC2B2AE3D27D4EB4F)
    h *= np.uint64(0x9FB21C651E98DF25)
    return h ^ (h >> np.uint64(32))


class Passages:
    """Q-gram index of one block of benchmark items."""

    def __init__(self, items: list[tuple[int, bytes]], passage: int = PASSAGE, rate: float = EDIT_RATE,
                 min_item: int = MIN_ITEM):
        self.text, self.item = [], []
        for item, t in items:
            t = normalise(t)
            if len(t) < max(min_item, Q):
                continue
            starts = range(0, max(1, len(t) - passage + 1), passage // 2)
            for a in sorted({*starts, max(0, len(t) - passage)}):
                self.text.append(np.frombuffer(t[a:a + passage], np.uint8))
                self.item.append(item)
        size = np.array([len(t) for t in self.text], np.int64)
        self.k = (size * rate).astype(np.int64)
        self.size, self.need = size, size + 1 - Q - self.k * Q
        assert rate * Q < 1 and passage * rate < BAND and (self.need > 0).all()
        grams = [qgrams(t) for t in self.text]
        h = np.concatenate(grams) if grams else np.empty(0, np.uint64)
        of = np.repeat(np.arange(len(grams)), [len(g) for g in grams])
        at = np.concatenate([np.arange(len(g)) for g in grams]) if grams else np.empty(0, np.int64)
        order = np.argsort(h, kind="stable")
        self.gram, self.of, self.at = h[order], of[order], at[order]
        bits = max(16, (16 * len(h)).bit_length())      # a table that few other q-grams pass
        self.shift = np.uint64(64 - bits)
        self.seen = np.zeros(1 << bits, bool)
        self.seen[self.gram >> self.shift] = True

    def hits(self, buf: np.ndarray, a: int, b: int) -> tuple[np.ndarray, np.ndarray]:
        """(passage, diagonal) of the q-grams shared with windows that start in [a, b)."""
        h = qgrams(buf[a:b + Q - 1])
        place = np.flatnonzero(self.seen[h >> self.shift])
        h = h[place]
        lo = np.searchsorted(self.gram, h)
        n = np.searchsorted(self.gram, h, "right") - lo
        idx = np.repeat(lo - np.r_[0, np.cumsum(n)[:-1]], n) + np.arange(n.sum())
        return self.of[idx], np.repeat(place + a, n) - self.at[idx]

    def regions(self, buf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(passage, band) with enough shared q-grams in the whole buffer."""
        found = []
        for a in range(0, max(len(buf) - Q + 1, 0), SLICE):
            p, d = self.hits(buf, a, min(a + SLICE, len(buf) - Q + 1))
            if len(p):
                d = d + PASSAGE             # diagonals before the first byte count as well
                band = d // BAND
                over = (d % BAND < self.k[p]) & (band > 0)      # also of the band before
                key = np.concatenate([p * (1 << 40) + band, p[over] * (1 << 40) + band[over] - 1])
                found.append(np.unique(key, return_counts=True))
        if not found:
            e = np.empty(0, np.int64)
            return e, e
        key, inv = np.unique(np.concatenate([k for k, _ in found]), return_inverse=True)
        count = np.bincount(inv, weights=np.concatenate([c for _, c in found]))
        key = key[count >= self.need[key >> 40]]
        return key >> 40, key & ((1 << 40) - 1)

    def verify(self, buf: np.ndarray, passage: np.ndarray, band: np.ndarray) -> np.ndarray:
        """Whether each region holds its passage within its edit budget: rows of the alignment
        are the passage's bytes, columns the diagonals from k left of the band to k right of it."""
        ok = np.zeros(len(passage), bool)
        for s in range(0, len(passage), 4096):
            p, b = passage[s:s + 4096], band[s:s + 4096]
            k = int(self.k[p].max())
            width = BAND + 3 * k + 1
            first = b * BAND - PASSAGE - k
            text = np.zeros((len(p), PASSAGE), np.uint8)
            for size in np.unique(self.size[p]):
                rows = np.flatnonzero(self.size[p] == size)
                text[rows, :size] = np.stack([self.text[x] for x in p[rows]])
            off = np.arange(width)
            cost = np.zeros((len(p), width), np.int32)
            best = np.full(len(p), 1 << 20, np.int32)
            for i in range(int(self.size[p].max())):
                at = first[:, None] + off + i
                char = np.where((at >= 0) & (at < len(buf)), buf[np.clip(at, 0, len(buf) - 1)], 0)
                new = cost + (char != text[:, i:i + 1])                      # diagonal step
                new[:, :-1] = np.minimum(new[:, :-1], cost[:, 1:] + 1)       # a passage byte is missing
                cost = np.minimum.accumulate(new - off, axis=1) + off        # a document byte is extra
                done = self.size[p] == i + 1
                best[done] = cost[done].min(axis=1)
            ok[s:s + 4096] = best <= self.k[p]
        return ok

    def items_in(self, docs: list[bytes]) -> list[list[int]]:
        """Sorted ids of the items found in each text."""
        return [f for group in groups(docs) for f in self.items_of(group)]

    def items_of(self, group: list[bytes]) -> list[list[int]]:
        """Sorted ids of the items found in each of some normalised texts."""
        found: list[set[int]] = [set() for _ in group]
        gap = b"\0" * (PASSAGE // 2)
        buf = np.frombuffer(gap + gap.join(group) + gap, np.uint8)
        if self.text and group:
            p, b = self.regions(buf)
            ok = self.verify(buf, p, b)
            start = np.cumsum([len(gap)] + [len(t) + len(gap) for t in group])[:-1]
            mid = b[ok] * BAND - PASSAGE + BAND // 2 + self.size[p[ok]] // 2
            doc = np.searchsorted(start, mid, "right") - 1
            for x, d in zip(p[ok].tolist(), doc.tolist()):
                found[max(d, 0)].add(self.item[x])
        return [sorted(f) for f in found]


_NO_ITEM, _NO_DOC = np.uint64(0), np.uint64(1)      # words that end an item, a text
_FACTOR = 0x9E3779B97F4A7C15


def word_hashes(text: bytes) -> np.ndarray:
    """A 64-bit hash of each word of a normalised text, made in slices."""
    out, a = [], 0
    while a < len(text):
        b = len(text) if len(text) - a <= SLICE else text.rfind(b" ", a, a + SLICE)
        b = b if b > a else a + SLICE       # a longer word is cut
        buf = np.frombuffer(text, np.uint8, b - a, a)
        space = np.flatnonzero(buf == 32)
        start = np.r_[0, space + 1]
        size = np.diff(np.r_[start, len(buf) + 1])
        power = np.cumprod(np.full(int(size.max()), _FACTOR, np.uint64))
        place = np.arange(len(buf) + 1) - np.repeat(start, size)
        h = np.add.reduceat((np.r_[buf, np.uint8(32)].astype(np.uint64) + np.uint64(1)) * power[place], start)
        out.append(h ^ (h >> np.uint64(31)))
        a = b + (text[b:b + 1] == b" ")
    h = np.concatenate(out) if out else np.empty(0, np.uint64)
    return np.maximum(h, np.uint64(2))


def word_grams(words: np.ndarray, q: int) -> np.ndarray:
    """A 64-bit mix of each q words in sequence."""
    h = np.zeros(max(len(words) - q + 1, 0), np.uint64)
    for k in range(q):
        h = (h ^ words[k:k + len(h)]) * np.uint64(0xC2B2AE3D27D4EB4F)
        h ^= h >> np.uint64(29)
    return h


class Runs:
    """Word index of one block of benchmark items."""

    def __init__(self, items: list[tuple[int, bytes]]):
        self.whole: dict[bytes, list[int]] = {}
        self.item, words, at, budget, want = [], [], [WORDS], [], []
        for item, t in items:
            t = normalise(t)
            w = word_hashes(t)
            if not len(w):
                continue
            if len(w) < 3 and len(t) < MIN_SHORT:
                self.whole.setdefault(t, []).append(item)
                continue
            self.item.append(item)
            words += [w, np.full(WORDS, _NO_ITEM)]
            at.append(at[-1] + len(w) + WORDS)
            want.append(min(len(w), WORDS))
            budget.append(WORD_EDITS if len(w) >= WORDS else int(len(w) >= 2 * GRAM))
        self.words = np.concatenate([np.full(WORDS, _NO_ITEM), *words])
        self.start = np.array(at[:-1], np.int64)
        self.want, self.budget = np.array(want, np.int64), np.array(budget, np.int64)
        self.grams = {}
        for q in range(1, GRAM + 1):        # items shorter than a seed are a seed of their own
            h = word_grams(self.words, q)
            own = np.repeat(self.want, np.diff(np.r_[self.start, len(self.words)])) if len(self.start) else np.empty(0, np.int64)
            own = np.r_[np.zeros(len(self.words) - len(own), np.int64), own][:len(h)]
            full = (self.words[:len(h)] != _NO_ITEM) & (self.words[q - 1:] != _NO_ITEM)
            place = np.flatnonzero(full & (own == q if q < GRAM else own >= GRAM))
            if not len(place):
                continue
            place = place[np.argsort(h[place], kind="stable")]
            bits = max(16, (16 * len(place)).bit_length())
            seen = np.zeros(1 << bits, bool)
            seen[h[place] >> np.uint64(64 - bits)] = True
            self.grams[q] = (h[place], place, seen, np.uint64(64 - bits))

    def reach(self, words: np.ndarray, i: np.ndarray, p: np.ndarray, step: int) -> list[np.ndarray]:
        """How many words of the item, from ``i`` on in direction ``step``, align with the text's from
        ``p`` on within 0, 1, ... WORD_EDITS edits; at most WORDS - GRAM count."""
        k, far = WORD_EDITS, 1 << 20
        cost = np.full((len(i), 2 * k + 1), far, np.int32)
        cost[:, k:] = np.arange(k + 1)
        out = [np.zeros(len(i), np.int64) for _ in range(k + 1)]
        for r in range(WORDS - GRAM):
            word = self.words[i + step * r]
            new = np.stack([cost[:, c] + (words[p + step * (r + c - k)] != word) for c in range(2 * k + 1)], axis=1)
            new[:, :-1] = np.minimum(new[:, :-1], cost[:, 1:] + 1)       # a word of the item is missing
            for c in range(1, 2 * k + 1):
                new[:, c] = np.minimum(new[:, c], new[:, c - 1] + 1)     # the text has a word more
            new[word == _NO_ITEM] = far
            cost = new
            least = cost.min(axis=1)
            for e in range(k + 1):
                out[e] += least <= e
        return out

    def items_of(self, group: list[bytes]) -> list[list[int]]:
        """Sorted ids of the items found in each of some normalised texts."""
        found: list[set[int]] = [set(self.whole.get(t, ())) for t in group]
        if not self.grams:
            return [sorted(f) for f in found]
        gap = np.full(WORDS, _NO_DOC)
        parts = [word_hashes(t) for t in group]
        words = np.concatenate([gap, *(x for w in parts for x in (w, gap))])
        start = np.cumsum([len(gap)] + [len(w) + len(gap) for w in parts])[:-1]
        for q, (gram, place, seen, shift) in self.grams.items():
            h = word_grams(words, q)
            at = np.flatnonzero(seen[h >> shift])
            lo = np.searchsorted(gram, h[at])
            n = np.searchsorted(gram, h[at], "right") - lo
            at, lo, n = at[n > 0], lo[n > 0], n[n > 0]
            end = np.cumsum(n)
            for a in range(0, int(end[-1]) if len(end) else 0, SLICE >> 3):     # so many seeds at a time
                nth = np.arange(a, min(a + (SLICE >> 3), int(end[-1])))
                x = np.searchsorted(end, nth, "right")
                i, p = place[lo[x] + nth - (end[x] - n[x])], at[x]
                if q == GRAM:       # the first seed of an exact run stands for all
                    first = self.words[i - 1] != words[p - 1]
                    i, p = i[first], p[first]
                own = np.searchsorted(self.start, i, "right") - 1
                ok = np.ones(len(i), bool)
                if q == GRAM:
                    left, right = self.reach(words, i - 1, p - 1, -1), self.reach(words, i + q, p + q, 1)
                    ok = np.zeros(len(i), bool)
                    for e in range(WORD_EDITS + 1):
                        for f in range(WORD_EDITS + 1 - e):
                            ok |= (e + f <= self.budget[own]) & (left[e] + q + right[f] >= self.want[own])
                doc = np.searchsorted(start, p[ok], "right") - 1
                for o, d in set(zip(own[ok].tolist(), doc.tolist())):
                    found[d].add(self.item[o])
        return [sorted(f) for f in found]


class Index:
    """Both rules over one block of benchmark items."""

    def __init__(self, items: list[tuple[int, bytes]]):
        self.rules = (Passages(items), Runs(items))

    def items_in(self, docs: list[bytes]) -> list[list[int]]:
        """Sorted ids of the items found in each text."""
        return [sorted({*a, *b}) for group in groups(docs) for a, b in zip(*(x.items_of(group) for x in self.rules))]


def _item_block_column(text: Column, block: list[tuple[int, bytes]], spark) -> Column:
    shared = spark.sparkContext.broadcast(block)

    @arrow_udf("array<long>")
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        index = Index(shared.value)
        for arr in batches:
            yield pa.array(index.items_in(raw(arr)), pa.list_(pa.int64()))

    return run(text)


def blocks(benchmark: DataFrame, item_id: str = "item_id", text: str = "text",
           limit: int = BLOCK_BYTES) -> Iterator[list[tuple[int, bytes]]]:
    """The benchmark in blocks of at most ``limit`` bytes of text, one at a time on the driver."""
    block: list[tuple[int, bytes]] = []
    size = 0
    for r in benchmark.select(item_id, text).filter(F.col(item_id).isNotNull() & F.col(text).isNotNull()).toLocalIterator():
        t = r[1].encode()
        if block and size + len(t) > limit:
            yield block
            block, size = [], 0
        block.append((int(r[0]), t))
        size += len(t)
    if block:
        yield block


def contamination(docs: DataFrame, benchmark: DataFrame, text: str = "text", out: str = "items", item_id: str = "item_id",
                  item_text: str = "text", block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``docs`` with column ``out``: the sorted ids of the benchmark items found in the text."""
    cols = [_item_block_column(F.col(text), b, docs.sparkSession) for b in blocks(benchmark, item_id, item_text, block_bytes)]
    if not cols:
        return docs.withColumn(out, F.array().cast("array<long>"))
    return docs.withColumn(out, cols[0] if len(cols) == 1 else F.array_sort(F.array_distinct(F.concat(*cols))))


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` without those in which an item of the benchmark is found."""
    from .common import fresh

    (found,) = fresh(docs, "_items")
    return contamination(docs, benchmark, text, found).filter(F.size(found) == 0).drop(found)
