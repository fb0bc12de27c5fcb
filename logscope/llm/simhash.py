"""SimHash near-duplicates by Golay-code fuzzy hashing (operator 4).

1. *Fingerprints.*  A-Z is lower-cased, words are runs of anything but ASCII white space, and
   every ``words``-word shingle (repeats included; a shorter text is one shingle) is hashed by
   XXH64 with seed 42.  A bit is set when it is set in over half the hashes; a text without
   words has fingerprint 0, linked like any other.
2. *Keys.*  A fingerprint is cut into segments A (23 bits), B (23) and C (18).  Two fingerprints
   that differ in at most 4 bits have, by pigeonhole, either C equal and at most 2 errors in A
   or in B; or at most 2 errors in A and in B; or A or B equal.  Words at distance 2 or less share the
   index of a codeword within distance 4 (``golay``), so the keys are (C, code of A), (C, code
   of B), (code of A, code of B), A and B: about 41 a fingerprint.
3. *Join and verify.*  Distinct fingerprints meet by key in sorted partitions; each bucket is
   compared bit by bit, and what leaves a task is not the pairs but one edge from each member of
   a connected set to its smallest member.  A bucket of more than ``BLOCK`` fingerprints is cut into blocks
   and every two blocks are compared in a task of their own: nothing is dropped or capped.
4. *Components.*  Alternating large-star and small-star steps over the edges, each written to
   the shared checkpoint folder, until nothing changes.

Defined cases: null text counts as empty (fingerprint 0).  Rows with a null id take part in
linking; a group without any id has a null ``component_id``.  Repeated rows get the same result
each.  An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from .common import cut, fresh, raw, signed
from .golay import near_codewords

SEED = 42
MAX_BITS = 4        # what the keys guarantee
BLOCK = 4096        # fingerprints compared with each other in one piece
SMALL_RUN = 48      # buckets up to this size are compared by shifted columns
GATHER = 1 << 18    # rows looked at together


def fingerprint(text: bytes, words: int = 4) -> int:
    """Unsigned 64-bit SimHash of UTF-8 bytes."""
    w = text.lower().split()       # bytes: A-Z and ASCII white space only
    if not w:
        return 0
    s, n = b" ".join(w), len(w)
    if n <= words:
        return xxhash.xxh64_intdigest(s, SEED)
    size = np.fromiter(map(len, w), np.int64, n)
    end = np.cumsum(size + 1) - 1
    first, last = (end - size)[:n - words + 1], end[words - 1:]
    digest, count, total = xxhash.xxh64_intdigest, np.zeros(64, np.int64), n - words + 1
    for k in range(0, total, 1 << 15):
        at = zip(first[k:k + (1 << 15)].tolist(), last[k:k + (1 << 15)].tolist())
        h = np.array([digest(s[a:b], SEED) for a, b in at], np.uint64)
        bits = np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        count += bits.sum(axis=0, dtype=np.uint32)
    set_bits = np.packbits(count * 2 > total, bitorder="little")
    return int(set_bits.view("<u8")[0])


def simhash(text: str | Column, words: int = 4) -> Column:
    """Column of fingerprints, as signed longs."""
    @arrow_udf("long")
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for arr in batches:
            yield pa.array([signed(fingerprint(t, words)) for t in raw(arr)], pa.int64())

    return run(text)


def fuzzy_keys(fp: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(positions, keys) of the keys of unsigned fingerprints."""
    a = (fp & np.uint64((1 << 23) - 1)).astype(np.uint32)
    b = ((fp >> np.uint64(23)) & np.uint64((1 << 23) - 1)).astype(np.uint32)
    c = (fp >> np.uint64(46)).astype(np.int64)
    ka, kb = near_codewords(a).astype(np.int64), near_codewords(b).astype(np.int64)
    first = np.arange(ka.shape[1]) == 0
    va, vb = first | (ka != ka[:, :1]), first | (kb != kb[:, :1])      # not a repeat of the first
    kind = lambda k, v: (k << 32) | v
    n, at = len(fp), np.arange(len(fp))
    both = (va[:, :, None] & vb[:, None, :]).reshape(n, -1)
    cols = [(kind(0, (c[:, None] << 12) | ka), va), (kind(1, (c[:, None] << 12) | kb), vb),
            (kind(2, ((ka[:, :, None] << 12) | kb[:, None, :]).reshape(n, -1)), both),
            (kind(3, a.astype(np.int64))[:, None], np.ones((n, 1), bool)),
            (kind(4, b.astype(np.int64))[:, None], np.ones((n, 1), bool))]
    return (np.concatenate([np.broadcast_to(at[:, None], m.shape)[m] for _, m in cols]),
            np.concatenate([k[m] for k, m in cols]))


def _keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        fp = b.column(0).to_numpy(zero_copy_only=False)
        at, key = fuzzy_keys(fp.view(np.uint64))
        for k in range(0, len(key), 1 << 17):
            s = slice(k, k + (1 << 17))
            yield pa.RecordBatch.from_arrays([pa.array(key[s]), pa.array(fp[at[s]])], names=["key", "fp"])


def _stars(fp: np.ndarray, max_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """(member, smallest member) of each connected set in one bucket; every fingerprint is
    compared once with those not reached yet."""
    left, out_a, out_b = np.unique(fp), [], []
    while len(left) > 1:
        root, left = left[0], left[1:]
        todo = [root]
        while todo and len(left):
            near = np.bitwise_count(left ^ todo.pop()) <= max_bits
            got = left[near]
            if len(got):
                left = left[~near]
                todo.extend(got)
                out_a.append(got)
                out_b.append(np.full(len(got), root))
    e = np.empty(0, fp.dtype)
    return (np.concatenate(out_a), np.concatenate(out_b)) if out_a else (e, e)


def _small_runs(key: np.ndarray, fp: np.ndarray, max_bits: int, longest: int) -> tuple[np.ndarray, np.ndarray]:
    """Stars over all linked pairs of the small buckets of one stretch of sorted rows."""
    pa_, pb_ = [], []
    for s in range(1, longest):
        hit = np.flatnonzero((key[s:] == key[:-s]) & (np.bitwise_count(fp[s:] ^ fp[:-s]) <= max_bits))
        if len(hit):
            pa_.append(fp[hit])
            pb_.append(fp[hit + s])
    if not pa_:
        e = np.empty(0, fp.dtype)
        return e, e
    nodes, inv = np.unique(np.concatenate(pa_ + pb_), return_inverse=True)
    m = len(inv) // 2
    pairs = np.unique(inv[:m].astype(np.int64) * len(nodes) + inv[m:])
    up = list(range(len(nodes)))

    def find(x: int) -> int:
        while up[x] != x:
            up[x] = up[up[x]]
            x = up[x]
        return x

    for x, y in zip((pairs // len(nodes)).tolist(), (pairs % len(nodes)).tolist()):
        x, y = find(x), find(y)
        if x != y:
            up[max(x, y)] = min(x, y)
    root = np.array([find(x) for x in range(len(nodes))])
    own = root == np.arange(len(nodes))
    return nodes[~own], nodes[root[~own]]


def _runs(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[list[np.ndarray]]:
    """Stretches of whole runs of equal leading columns (all but the last), at least GATHER
    rows each but the last; a longer run comes in pieces of BLOCK rows (see _bucket_edges)."""
    held: list[list[np.ndarray]] = []
    rows = 0
    for b in batches:
        held.append([b.column(i).to_numpy(zero_copy_only=False) for i in range(width)])
        rows += b.num_rows
        if rows < GATHER:
            continue
        cols = [np.concatenate(c) for c in zip(*held)]
        same = np.ones(rows, bool)
        for c in cols[:-1]:
            same &= c == c[-1]
        start = rows - int(np.argmin(same[::-1])) if not same.all() else 0
        if start:
            yield [c[:start] for c in cols]
        held, rows = [[c[start:] for c in cols]], rows - start
    if rows:
        yield [np.concatenate(c) for c in zip(*held)]


EDGE = "a long, b long, key long, block int"


def _edge_batch(a, b, key=None, block=None) -> pa.RecordBatch:
    n = len(a)
    none = [pa.nulls(n, pa.int64()), pa.nulls(n, pa.int32())]
    more = none if key is None else [pa.array(np.full(n, key, np.int64)), pa.array(np.full(n, block, np.int32))]
    return pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), pa.array(b.view(np.int64)), *more],
                                      names=["a", "b", "key", "block"])


def _bucket_edges(max_bits: int, block_rows: int):
    """Sorted (key, fp) rows -> edges; a bucket beyond ``block_rows`` is also handed on by block."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for key, fp in _runs(batches, 2):
            fp = np.ascontiguousarray(fp).view(np.uint64)
            edge = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
            size = np.diff(np.r_[edge, len(key)])
            of = np.repeat(size, size)
            small = (of > 1) & (of <= SMALL_RUN)
            if small.any():
                yield _edge_batch(*_small_runs(key[small], fp[small], max_bits, int(of[small].max())))
            for k in np.flatnonzero(size > SMALL_RUN):
                bucket, n = fp[edge[k]:edge[k] + size[k]], int(size[k])
                for i in range(0, n, block_rows):
                    part = bucket[i:i + block_rows]
                    yield _edge_batch(*_stars(part, max_bits))
                    if n > block_rows:
                        yield _edge_batch(part, part, key[edge[k]], i // block_rows)

    return run


def _block_edges(max_bits: int):
    """Sorted (key, lo, hi, fp) rows -> edges within each pair of blocks."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for *by, fp in _runs(batches, 4):
            fp = np.ascontiguousarray(fp).view(np.uint64)
            new = np.zeros(len(fp), bool)
            new[0] = True
            for c in by:
                new[1:] |= c[1:] != c[:-1]
            edge = np.flatnonzero(new)
            for i, j in zip(edge, np.r_[edge[1:], len(fp)]):
                yield _edge_batch(*_stars(fp[i:j], max_bits))

    return run


def fuzzy_edges(prints: DataFrame, fp: str = "fp", max_bits: int = MAX_BITS, block_rows: int = BLOCK) -> DataFrame:
    """Edges (a, b), a > b as unsigned, that connect exactly the fingerprints of ``prints``
    (distinct longs) which a chain of steps of ``max_bits`` or fewer bits connects."""
    if not 0 <= max_bits <= MAX_BITS:
        raise ValueError(f"the keys cover up to {MAX_BITS} differing bits")
    keys = prints.select(fp).mapInArrow(_keys, "key long, fp long")
    found = cut(keys.repartition("key").sortWithinPartitions("key", "fp")
                .mapInArrow(_bucket_edges(max_bits, block_rows), EDGE))
    edges, hot = found.filter("key IS NULL").select("a", "b"), found.filter("key IS NOT NULL")
    if hot.limit(1).count():
        blocks = hot.groupBy("key").agg(F.max("block").alias("last"))
        other = F.explode(F.sequence(F.lit(0), F.col("last"))).alias("other")
        pairs = (hot.join(blocks, "key").select("key", "a", "block", other).filter("other != block")
                 .select("key", F.least("block", "other").alias("lo"), F.greatest("block", "other").alias("hi"), "a"))
        edges = edges.union(pairs.repartition("key", "lo", "hi").sortWithinPartitions("key", "lo", "hi", "a")
                            .mapInArrow(_block_edges(max_bits), EDGE).select("a", "b"))
    return edges.distinct()


def components(edges: DataFrame, max_rounds: int = 64) -> DataFrame:
    """(node, root) for every node of ``edges`` (a, b longs): the smallest node of its component,
    by alternating large-star and small-star steps."""
    edges = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a != b").distinct()
    before = None
    for _ in range(max_rounds):
        both = edges.union(edges.select("b", "a"))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.filter("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        star = large.join(low, "a").select(F.explode(F.array(
            F.struct("a", F.col("m").alias("b")), F.struct(F.col("b").alias("a"), F.col("m").alias("b")))).alias("e"))
        edges = cut(star.select("e.*").filter("a != b").distinct())
        now = edges.agg(F.count(F.lit(1)), F.expr("sum(cast(xxhash64(a, b) as decimal(20,0)))")).first()
        if now == before:
            roots = edges.select(F.col("b").alias("a")).distinct()
            return edges.union(roots.select("a", "a")).toDF("node", "root")
        before = now
    raise RuntimeError("the components did not settle")


def simhash_groups(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", words: int = 4,
                   max_bits: int = MAX_BITS) -> DataFrame:
    """One row per document: doc_id, fp (long), fingerprint (16 hex digits), component_id."""
    prints = cut(docs.select(F.col(doc_id).alias("doc_id"), simhash(text, words).alias("fp")))
    distinct = prints.groupBy("fp").agg(F.min("doc_id").alias("rep"))
    found = components(fuzzy_edges(distinct, "fp", max_bits))
    linked = distinct.join(found, distinct.fp == found.node).select("fp", "rep", "root")
    smallest = linked.groupBy("root").agg(F.min("rep").alias("first"))
    linked = linked.join(smallest, "root").select("fp", "first")
    # stored, so that the last join reads two plain shuffles and a fingerprint that very many
    # documents share is split by the skew join
    group = cut(distinct.join(linked, "fp", "left")
                .select("fp", F.coalesce("first", "rep").alias("component_id")))
    return prints.join(group, "fp").select(
        "doc_id", "fp", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def keep_one(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", words: int = 4,
             max_bits: int = MAX_BITS) -> DataFrame:
    """``docs`` with one row of each group: the one with the smallest id and, where that id repeats in the
    group, the smallest hash of the text.  Rows without an id cannot be named and stay."""
    own, first, least = fresh(docs, "_own", "_first", "_least")
    prints = cut(docs.select(F.col(doc_id).alias("doc_id"), simhash(text, words).alias("fp"), F.xxhash64(text).alias("h")))
    each = prints.groupBy("fp", "doc_id", "h").agg(F.count(F.lit(1)).alias("n"))
    distinct = cut(each.groupBy("fp").agg(F.min(F.when(F.col("doc_id").isNotNull(), F.struct("doc_id", "h", "n"))).alias("least")))
    found = components(fuzzy_edges(distinct, "fp", max_bits))
    # an id is no name of a row: a repeated one can be in several groups and be the smallest of each
    kept = cut(distinct.join(found, distinct.fp == found.node, "left").groupBy(F.coalesce("root", "fp").alias("root"))
               .agg(F.min("least").alias("least")).filter("least IS NOT NULL")
               .select(F.col("least.doc_id").alias(first), F.col("least.h").alias(least), F.col("least.n").alias("n")))
    # the kept rows grow with the documents: a shuffled join at every size
    rows = docs.withColumn(own, F.xxhash64(text))
    out = rows.join(kept.select(first, least).hint("shuffle_merge"),
                    (rows[doc_id] == F.col(first)) & (rows[own] == F.col(least)), "left_semi")
    if kept.filter("n > 1").limit(1).count():       # rows equal in id and text
        out = out.dropDuplicates([doc_id, own])
    return out.drop(own).unionByName(docs.filter(F.col(doc_id).isNull()))
