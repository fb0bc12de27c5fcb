"""Language-model scores from an Elias-Fano n-gram trie (operator 7).

*Model.*  Tokens are the words of the lower-cased text (A-Z only) and one end per text; the end also
stands before the first word.  With ``c`` the training counts, ``N`` their sum and ``V`` the number of distinct
tokens, ``base(w) = (c(w) + 1) / (N + V + 1)`` and, with ``m = MASS * c(v) ** GROWTH``,

    p(w | v) = (c(v, w) + m * base(w)) / (c(v) + m)        (base(w) where c(v) is 0),

a Dirichlet prior whose weight grows with the context as its number of distinct successors does.
It sums to one over the vocabulary and the unknown word.

*Trie.*  The n-grams are dealt into shards by their words' hashes: by the context's into at most
``ROWS_OF_SHARDS`` rows and by the successor's into columns, so the successors of one very common word
spread as the corpus grows.  A shard holds, as Elias-Fano levels in one memory-mapped file, its words, its
contexts, the monotone pointers from contexts to successors, and the successors relative to their
context.  A pair is looked up by finding its context, reading its range of siblings through the
pointers, and a successor search within it.  Pair counts, the part of the smoothed probability that
depends on the pair, are quantised to 16 bits (exact below 32,768, then by steps of 0.1 %).

*On Spark.*  Texts are read once.  Each task turns them into chunks; a chunk's distinct words and pairs,
with their counts in training texts, go to their shards as packed arrays (one row per chunk and shard).  A shard
adds up the counts of all chunks, builds its trie and answers every chunk's words and pairs.  The answers
meet the chunk's token numbers, which went along, and the texts are scored there.  Two shuffles of compact rows; what is sent grows with the corpus; nothing is collected.

Defined cases: null text counts as empty (one end token); rows with a null id count as held out or not
by the caller's condition and keep a null id; repeated rows count each time; without training
rows every probability is 1 / (0 + 0 + 1); an empty table gives an empty result.  A text is held whole in one
task's memory.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import raw, total_bytes
from .elias_fano import EliasFano, Levels

CHUNK_BYTES = 16 << 20
SHARD_BYTES = 16 << 20
ROWS_OF_SHARDS = 32
MASS, GROWTH = 2.0, 0.9
SEED = 7
END = b"\n"             # no word holds white space
EXACT = 1 << 15
STEP = np.log(1.001)

SCHEMA = ("chunk long, shard int, kind int, words binary, word_n binary, ctx binary, ctx_n binary, "
          "succ binary, succ_n binary, n long, v long")
_ARROW = pa.schema([("chunk", pa.int64()), ("shard", pa.int32()), ("kind", pa.int32()),
                    *((c, pa.binary()) for c in ("words", "word_n", "ctx", "ctx_n", "succ", "succ_n")),
                    ("n", pa.int64()), ("v", pa.int64())])
ASKED, TOKENS, WIDE = 0, 1, 2       # kinds of rows; answers with 64-bit counts are wide


def _row(chunk: int, shard: int, kind: int, *blobs, n: int = 0, v: int = 0) -> pa.RecordBatch:
    blobs = [None if b is None else b.tobytes() for b in blobs] + [None] * (6 - len(blobs))
    cols = [[chunk], [shard], [kind], *([b] for b in blobs), [n], [v]]
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(cols, _ARROW)], schema=_ARROW)


def _grid(shards: int) -> tuple[int, int]:
    """Rows (by context) and columns (by successor); beyond ``ROWS_OF_SHARDS`` squared both grow with the root of the shards, so that
    neither the contexts of a row nor the successors of one very common word outgrow a shard."""
    rows = min(shards, max(ROWS_OF_SHARDS, 1 << (shards.bit_length() // 2)))
    return rows, shards // rows


def encode_counts(n: np.ndarray) -> np.ndarray:
    high = EXACT + np.log(np.maximum(n, EXACT) / EXACT) / STEP
    return np.where(n < EXACT, n, np.minimum(np.rint(high), 65535)).astype("<u2")


def decode_counts(code: np.ndarray) -> np.ndarray:
    return np.where(code < EXACT, code, EXACT * np.exp((code.astype(np.float64) - EXACT) * STEP))


def _place(chunk: int, shards: int) -> int:
    """The shard whose task hands on a chunk's tokens: chunks are numbered within partitions, so their hash is spread."""
    return xxhash.xxh64_intdigest(chunk.to_bytes(8, "little"), SEED) % shards


def _pairs(token: np.ndarray, end: int, words: int, shard: np.ndarray, cols: int):
    """(contexts, successors, place of each token's pair, pairs per shard) of a stream of tokens;
    pairs in order of their shard, within it by context and successor."""
    prev = np.empty_like(token)
    prev[0], prev[1:] = end, token[:-1]
    key, inv = np.unique(prev.astype(np.int64) * words + token, return_inverse=True)
    ctx, succ = key // words, key % words
    of = shard[ctx] // cols * cols + shard[succ] % cols
    order = np.argsort(of, kind="stable")
    place = np.empty(len(order), np.int64)
    place[order] = np.arange(len(order))
    return ctx[order], succ[order], place[inv], of[order]


def _chunk_rows(chunk: int, ids: list, train: list, token_lists: list, vocabulary: list, shards: int) -> Iterator[pa.RecordBatch]:
    rows, cols = _grid(shards)
    h = np.array([xxhash.xxh64_intdigest(w, SEED) for w in vocabulary], np.uint64)
    bits = rows.bit_length() - 1
    row = (h >> np.uint64(64 - bits)).astype(np.int64) if bits else np.zeros(len(h), np.int64)
    of = row * cols + (h & np.uint64(cols - 1)).astype(np.int64)
    order = np.lexsort((h, of))
    rank = np.empty(len(order), np.int32)
    rank[order] = np.arange(len(order))
    h, of = h[order], of[order]
    token = rank[np.concatenate(token_lists)]
    size = np.array([len(t) for t in token_lists])
    learn = np.repeat(np.array(train, np.float64), size)
    ctx, succ, place, pair_of = _pairs(token, int(rank[0]), len(h), of, cols)
    word_n = np.bincount(token, weights=learn, minlength=len(h)).astype("<u4")
    pair_n = np.bincount(place, weights=learn, minlength=len(ctx)).astype("<u4")
    w_at, p_at = np.searchsorted(of, np.arange(shards + 1)), np.searchsorted(pair_of, np.arange(shards + 1))
    for s in range(shards):
        w, p = slice(w_at[s], w_at[s + 1]), slice(p_at[s], p_at[s + 1])
        c = ctx[p]
        first = np.flatnonzero(np.r_[True, c[1:] != c[:-1]]) if len(c) else np.empty(0, np.int64)
        five = (h[succ[p]] >> np.uint64(24)).astype("<u8").view(np.uint8).reshape(-1, 8)[:, :5]
        yield _row(chunk, s, ASKED, h[w].astype("<u8"), word_n[w], h[c[first]].astype("<u8"),
                   np.diff(np.r_[first, len(c)]).astype("<u4"), five, pair_n[p])
    known = np.array([i is not None for i in ids], np.uint8)
    planes = token.astype("<u4").view(np.uint8).reshape(-1, 4).T        # byte planes compress better
    yield _row(chunk, _place(chunk, shards), TOKENS, planes, size.astype("<i8"), np.array([i or 0 for i in ids], "<i8"), known)


def _chunks(shards: int, chunk_bytes: int):
    """(doc_id, text, train) -> one row per chunk and shard, and one with the chunk's tokens."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunk = TaskContext.get().partitionId() << 24
        fresh = lambda: ([], [], [], {END: 0}, 0)
        ids, train, lists, number, size = fresh()
        for b in batches:
            for i, t, learn in zip(b.column(0).to_pylist(), raw(b.column(1)), b.column(2).to_pylist()):
                w = t.lower().split()
                for x in set(w).difference(number):
                    number[x] = len(number)
                w.append(END)
                lists.append(np.fromiter(map(number.__getitem__, w), np.int32, len(w)))
                ids.append(i)
                train.append(bool(learn))
                size += len(t)
                if size >= chunk_bytes:
                    yield from _chunk_rows(chunk, ids, train, lists, list(number), shards)
                    chunk += 1
                    ids, train, lists, number, size = fresh()
        if ids:
            yield from _chunk_rows(chunk, ids, train, lists, list(number), shards)

    return run


class TrieShard:
    """One shard of the trie, built from training counts (all positive)."""

    def __init__(self, words: np.ndarray, word_n: np.ndarray, ctx: np.ndarray, succ: np.ndarray, pair_n: np.ndarray):
        self.store = Levels()
        self.words = EliasFano(words, self.store)
        self.word_n = self.store.add(word_n.astype("<u8"))
        own, first = np.unique(ctx, return_index=True)      # ctx and succ are sorted by both
        self.contexts = EliasFano(own, self.store)
        self.pointers = EliasFano(np.r_[first, len(ctx)], self.store)
        base = np.repeat(np.arange(len(own), dtype=np.uint64), np.diff(np.r_[first, len(ctx)])) << np.uint64(40)
        self.successors = EliasFano(base | succ, self.store)
        self.pair_n = self.store.add(encode_counts(pair_n))

    def count(self, words: np.ndarray) -> np.ndarray:
        if not self.words.n:
            return np.zeros(len(words), "<u4")
        at = self.words.find(words)
        n = np.where(at >= 0, self.word_n[np.maximum(at, 0)], np.uint64(0)).astype("<u8")
        return n if len(n) and n.max() >> np.uint64(32) else n.astype("<u4")      # wide only where it must be

    def pair_codes(self, ctx: np.ndarray, ctx_n: np.ndarray, succ: np.ndarray) -> np.ndarray:
        """Quantised counts of the pairs of each context with its ``ctx_n`` successors in ``succ``."""
        if not self.contexts.n or not len(ctx):
            return np.zeros(len(succ), "<u2")
        r = self.contexts.find(ctx)
        ok = np.maximum(r, 0)
        first, last = self.pointers[ok].astype(np.int64), self.pointers[ok + 1].astype(np.int64)
        last = np.where(r >= 0, last, first)        # unknown context: no siblings
        spread = lambda a: np.repeat(a, ctx_n)
        at = self.successors.find((spread(ok).astype(np.uint64) << np.uint64(40)) | succ, spread(first), spread(last))
        return np.where(at >= 0, self.pair_n[np.maximum(at, 0)], 0).astype("<u2")


def _merge(parts: list[dict]) -> TrieShard:
    """The trie of a shard from the counts of all chunks."""
    join = lambda k: np.concatenate([p[k] for p in parts])
    words, inv = np.unique(join("words"), return_inverse=True)
    n = np.bincount(inv, weights=join("word_n"), minlength=len(words))
    ctx, inv = np.unique(join("ctx"), return_inverse=True)
    if len(ctx) >= 1 << 24:
        raise OverflowError("a shard has 2^24 distinct contexts or more; lower shard_bytes, which adds rows of shards")
    key = (np.repeat(inv.astype(np.uint64), join("ctx_n")) << np.uint64(40)) | join("succ")
    key, inv = np.unique(key, return_inverse=True)
    pair_n = np.bincount(inv, weights=join("succ_n"), minlength=len(key))
    key, pair_n, words, n = key[pair_n > 0], pair_n[pair_n > 0], words[n > 0], n[n > 0]
    return TrieShard(words, n, ctx[(key >> np.uint64(40)).astype(np.int64)], key & np.uint64((1 << 40) - 1), pair_n)


def _asked(row: dict) -> dict:
    get = lambda k, t: np.frombuffer(row[k] or b"", t)
    five = get("succ", np.uint8).reshape(-1, 5)
    wide = np.zeros((len(five), 8), np.uint8)
    wide[:, :5] = five
    return {"chunk": row["chunk"], "words": get("words", "<u8"), "word_n": get("word_n", "<u4"), "ctx": get("ctx", "<u8"),
            "ctx_n": get("ctx_n", "<u4"), "succ": wide.view("<u8").ravel(), "succ_n": get("succ_n", "<u4")}


def _answer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """All rows of a shard (a partition holds one) -> its answers to each chunk; token rows pass."""
    shards: dict[int, list[dict]] = {}
    for b in batches:
        for i in range(b.num_rows):
            one = b.slice(i, 1)
            if one.column(2)[0].as_py() == TOKENS:
                yield one
            else:
                row = one.to_pylist()[0]
                shards.setdefault(row["shard"], []).append(_asked(row))
    for shard, parts in shards.items():
        trie = _merge(parts)
        n, v = int(trie.word_n.sum(dtype=np.uint64)), trie.words.n
        for p in parts:
            count = trie.count(p["words"])
            yield _row(p["chunk"], shard, WIDE if count.itemsize == 8 else ASKED, None, count, None, None, None,
                       trie.pair_codes(p["ctx"], p["ctx_n"], p["succ"]), n=n, v=v)
        trie.store.close()


def _score_chunk(tokens: dict, answers: list[dict], mass: float, growth: float) -> pa.RecordBatch:
    answers.sort(key=lambda r: r["shard"])
    rows, cols = _grid(len(answers))
    word_n = [np.frombuffer(r["word_n"], "<u8" if r["kind"] == WIDE else "<u4") for r in answers]
    code = np.concatenate([np.frombuffer(r["succ_n"], "<u2") for r in answers])
    total, distinct = sum(r["n"] for r in answers), sum(r["v"] for r in answers)
    shard = np.repeat(np.arange(len(answers)), [len(x) for x in word_n])
    count = np.concatenate(word_n).astype(np.float64)
    planes = np.frombuffer(tokens["words"], np.uint8)
    token = np.ascontiguousarray(planes.reshape(4, -1).T).view("<u4").ravel().astype(np.int32)
    size = np.frombuffer(tokens["word_n"], "<i8")
    start = np.r_[0, np.cumsum(size)[:-1]]
    ends = token[start + size - 1]
    ctx, succ, place, _ = _pairs(token, int(ends[0]), len(count), shard, cols)
    base = (count + 1) / (total + distinct + 1)
    seen, m = count[ctx], mass * count[ctx] ** growth
    p = np.where(seen > 0, (decode_counts(code) + m * base[succ]) / np.where(seen > 0, seen + m, 1), base[succ])
    known = np.frombuffer(tokens["ctx_n"], np.uint8).astype(bool)
    ids = np.frombuffer(tokens["ctx"], "<i8")
    add = lambda x: np.add.reduceat(x, start)
    return pa.RecordBatch.from_arrays(
        [pa.array(ids, mask=~known), pa.array(size.astype(np.int64)), pa.array(add((count[token] > 0).astype(np.int64))),
         pa.array(np.full(len(ids), total, np.int64)), pa.array(add(np.log10(base)[token])), pa.array(add(np.log10(p)[place]))],
        names=["doc_id", "n_tokens", "n_known", "train_tokens", "base_score", "score"])


def _score(mass: float, growth: float):
    """Rows sorted by chunk -> scores of the chunk's texts."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, tokens, answers = None, None, []
        for b in batches:
            for r in (b.slice(i, 1).to_pylist()[0] for i in range(b.num_rows)):
                if r["chunk"] != now:
                    if now is not None:
                        yield _score_chunk(tokens, answers, mass, growth)
                    now, tokens, answers = r["chunk"], None, []
                if r["kind"] == TOKENS:
                    tokens = r
                else:
                    answers.append(r)
        if now is not None:
            yield _score_chunk(tokens, answers, mass, growth)

    return run


def score_texts(docs: DataFrame, is_train: Column, doc_id: str = "doc_id", text: str = "text", chunk_bytes: int = CHUNK_BYTES,
                shard_bytes: int = SHARD_BYTES, mass: float = MASS, growth: float = GROWTH) -> DataFrame:
    """One row per document: doc_id (long), n_tokens, n_known, train_tokens, base_score, score."""
    _, size = total_bytes(docs, text)
    shards = 8
    while shards * shard_bytes < size:
        shards *= 2
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"),
                       F.coalesce(is_train, F.lit(False)).alias("train"))
    asked = rows.mapInArrow(_chunks(shards, chunk_bytes), SCHEMA)
    # one partition per shard, so the rows need no sorting
    answered = asked.repartitionById(shards, "shard").mapInArrow(_answer, SCHEMA)
    return answered.repartition("chunk").sortWithinPartitions("chunk").mapInArrow(
        _score(mass, growth), "doc_id long, n_tokens long, n_known long, train_tokens long, base_score double, score double")
