"""Conversation prefix trie (operator 13): a z-fast trie over the turns of conversations.

Every distinct sequence of a conversation's first ``d`` turns is a node of depth ``d``.  Tasks build local
z-fast tries (``zfast``): equal sequences of a batch are put together, the exit node of each is located by fat
binary search over handles, and the batch is inserted.  Each task then expands its
compacted edges into one row per node, and rows of one node meet in a grouped aggregate of sums and minima.  So a
prefix that holds a third of all conversations is one row per task, and no conversation has to meet another.

Only hashes travel: a turn is digested where it is read (128 bits of role and text, and its number of words), and a
prefix is named by the exclusive-or of 128-bit hashes of (position, turn).  Positions are found in chunks of
turn numbers with a running sum over chunks, and long conversations enter the tries in segments of ``SEGMENT`` turns
below the hash of what came before, so that no conversation is held whole.

A second pass adds up the subtrees.  A node belongs to its smallest member; the nodes of one member are the lower end of its
path, from its first own depth ``t`` on.  Hence the sum over a subtree of (members - 1) x words is, over all members, the
words of the turns above ``t`` and from the node on, and the leaves below a node are the members that own one: sums
over members again, which local tries add up along their edges.  The SHA-256 of ends reads each
node's sorted identifiers as a stream of text chunks made by range-partitioned tasks.

Defined cases: rows with a null ``conv_id`` belong to no conversation; null role or text counts as empty; null turns come first;
turns with equal numbers are ordered by the MD5 of role and text (repeated rows follow one another); an empty table has no node, not
even a root; conversations without turns are members of the root; other columns are not read, whatever their names;
texts of any length are digested whole.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import cut
from .zfast import ZFastTrie

SEGMENT = 1024              # turns that enter a trie as one sequence
CHUNK = 4096                # turn numbers that are ranked together
TRIE_ELEMENTS = 400_000     # of a local trie, which is then expanded and begun anew
TEXT_CHUNK = 1 << 16        # bytes of identifiers in a row of ends
ROOT = bytes(16)
WORD = r"[^\x20\x09-\x0D]+"
EARLIER = (Window.unboundedPreceding, -1)


# ------------------------------------------------------------------ turns and rebuilt conversations
def turn_digests(conversations: DataFrame) -> DataFrame:
    """``(conv, turn, mark, words)`` of every row with an id; ``mark`` digests role and text."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    mark = F.md5(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text).cast("binary"))
    return (conversations.filter(F.col("conv_id").isNotNull())
            .select(F.col("conv_id").cast("long").alias("conv"), F.col("turn").cast("long").alias("turn"), mark.alias("mark"),
                    F.regexp_count(text, F.lit(WORD)).cast("long").alias("words")))


def numbered(turns: DataFrame) -> DataFrame:
    """``turns`` with ``idx``, the position in its conversation from 0; a conversation is ranked in chunks of turn numbers."""
    t = turns.withColumn("chunk", F.coalesce(F.floor(F.col("turn") / F.lit(CHUNK)), F.lit(-1 << 63)))
    before = F.sum("n").over(Window.partitionBy("conv").orderBy("chunk").rowsBetween(*EARLIER))
    offsets = (t.groupBy("conv", "chunk").agg(F.count(F.lit(1)).alias("n"))
               .select("conv", "chunk", F.coalesce(before, F.lit(0)).alias("offset")))
    rank = F.row_number().over(Window.partitionBy("conv", "chunk").orderBy(F.col("turn").asc_nulls_first(), "mark"))
    return (t.withColumn("rank", rank).join(offsets, ["conv", "chunk"])
            .select("conv", (F.col("offset") + F.col("rank") - 1).alias("idx"), "mark", "words"))


def rebuilt(conversations: DataFrame, group: int = 20, most: int = 4) -> tuple[DataFrame, DataFrame]:
    """Turns ``(conv, pos, mark, words)`` (``pos`` from 1) and lengths ``(conv, n)`` of the rebuilt conversations: the first h turns of
    conversation ``c - c % group``, then the own turns of ``c`` after its first h; h = crc32(c as text) % ``most``."""
    own = cut(numbered(turn_digests(conversations)))
    h = F.crc32(F.col("conv").cast("string").cast("binary")) % most
    heads = (own.filter((F.col("conv") % group == 0) & (F.col("idx") < most - 1)).groupBy(F.col("conv").alias("from"))
             .agg(F.array_sort(F.collect_list(F.struct("idx", "mark", "words"))).alias("head")))    # at most most - 1 turns
    convs = own.groupBy("conv").agg(F.count(F.lit(1)).alias("own")).withColumns({"from": F.col("conv") - F.col("conv") % group, "h": h})
    convs = cut(convs.join(heads, "from", "left")
                .withColumn("head", F.when(F.col("h") > 0, F.slice("head", F.lit(1), F.col("h").cast("int"))))
                .withColumn("head", F.coalesce("head", F.expr("cast(array() as array<struct<idx:bigint,mark:string,words:bigint>>)"))))
    k = F.size("head").cast("long")
    taken = convs.select("conv", F.explode("head").alias("t")).select("conv", (F.col("t.idx") + 1).alias("pos"), "t.mark", "t.words")
    rest = (own.filter(F.col("idx") >= h).join(convs.select("conv", "h", k.alias("k")), "conv")
            .select("conv", (F.col("idx") - F.col("h") + F.col("k") + 1).alias("pos"), "mark", "words"))
    return taken.union(rest), convs.select("conv", (k + F.greatest(F.col("own") - F.col("h"), F.lit(0))).alias("n"))


# ------------------------------------------------------------------ local tries
def _key(a: str, b: str) -> Column:
    return F.unhex(F.concat(*[F.lpad(F.hex(c), 16, "0") for c in (a, b)]))


def _segments(turns: DataFrame, lengths: DataFrame, segment: int) -> DataFrame:
    """``(conv, seg, a, b, x, y, w)``: a segment's element hashes and words in order, and the prefix hash before it."""
    marks = turns.select("conv", "pos", F.xxhash64(F.lit(1), "pos", "mark").alias("x"), F.xxhash64(F.lit(2), "pos", "mark").alias("y"),
                         "words", F.floor((F.col("pos") - 1) / F.lit(segment)).alias("seg"))
    segs = (marks.groupBy("conv", "seg")
            .agg(F.array_sort(F.collect_list(F.struct("pos", "x", "y", "words"))).alias("t"),     # at most ``segment`` rows
                 F.bit_xor("x").alias("tx"), F.bit_xor("y").alias("ty"))
            .select("conv", "seg", "tx", "ty", F.col("t.x").alias("x"), F.col("t.y").alias("y"), F.col("t.words").alias("w")))
    none = F.expr("cast(array() as array<bigint>)")
    zero = F.lit(0).cast("long")
    turnless = lengths.filter("n = 0").select("conv", zero.alias("seg"), zero.alias("tx"), zero.alias("ty"),
                                              none.alias("x"), none.alias("y"), none.alias("w"))
    segs = cut(segs.union(turnless))
    run = Window.partitionBy("conv").orderBy("seg").rowsBetween(*EARLIER)
    starts = segs.select("conv", "seg", *[F.coalesce(F.bit_xor(t).over(run), F.lit(0)).alias(s) for t, s in (("tx", "a"), ("ty", "b"))])
    return cut(segs.join(starts, ["conv", "seg"]))


def _keys(a: int, b: int, x: np.ndarray, y: np.ndarray) -> list[bytes]:
    """Hashes of all prefixes: the one before the segment, then one per turn."""
    one = np.bitwise_xor.accumulate(np.concatenate(([a], x)).astype(np.int64))
    two = np.bitwise_xor.accumulate(np.concatenate(([b], y)).astype(np.int64))
    raw = np.stack([one, two], 1).astype(">i8").tobytes()
    return [raw[i:i + 16] for i in range(0, len(raw), 16)]


def _batches(batches: Iterator[pa.RecordBatch]) -> Iterator[list[tuple]]:
    for b in batches:
        cols = {f: c for f, c in zip(b.schema.names, b.columns)}
        lists = {}
        for f in "xyw":
            c = cols[f]
            at = c.offsets.to_numpy()
            lists[f] = at - at[0], c.flatten().to_numpy()
        rest = [cols[f].to_pylist() for f in b.schema.names if f not in "xyw"]
        out = []
        for i, row in enumerate(zip(*rest)):
            x, y, w = (v[at[i]:at[i + 1]] for at, v in (lists[f] for f in "xyw"))
            out.append((*row, x, y, w))
        yield out


def _merged(items: Iterator[tuple]) -> list[tuple]:
    """Equal sequences of a batch as one, in order of their hashes."""
    by: dict[tuple, list] = {}
    for start, keys, words, least, weights in items:
        have = by.get((start, keys[-1]))
        if have is None:
            by[start, keys[-1]] = [start, keys, words, least, list(weights)]
        else:
            have[3] = min(have[3], least)
            have[4] = [p + q for p, q in zip(have[4], weights)]
    return sorted(by.values(), key=lambda s: (s[0], s[1][1:2], s[1][-1]))


def _tries(batches: Iterator[pa.RecordBatch], sequences) -> Iterator[list]:
    """Local tries of bounded size, as their nodes with sums gathered upwards."""
    trie = ZFastTrie()
    for rows in _batches(batches):
        for a in range(0, len(rows), 1000):
            trie.insert_batch(_merged(s for r in rows[a:a + 1000] for s in sequences(*r)))
            if trie.size >= TRIE_ELEMENTS:
                yield trie.gather()
                trie = ZFastTrie()
    yield trie.gather()


def _depths(n) -> range:
    """Depths of the rows of a node: its edge, and the depth of the root of all."""
    return range(n.lo + 1, n.hi + 1) if n.up is not None else range(0, 1 if n.hi == 0 else 0)


def _local_nodes(segs: DataFrame, segment: int) -> DataFrame:
    """First pass: ``(key, depth, parent, conv, n, words)`` of the nodes of local tries."""
    def sequences(conv, seg, a, b, x, y, w):
        return [(seg * segment, _keys(a, b, x, y), w, conv, (1, 0, 0))]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for nodes in _tries(batches, sequences):
            rows = [(n.key(d), d, n.key(d - 1) if d else None, n.least, n.weights[0], int(n.words[d - n.base - 1]) if d else 0)
                    for n in nodes for d in _depths(n)]
            for i in range(0, len(rows), 20_000):
                cols = list(zip(*rows[i:i + 20_000]))
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, (pa.binary(), pa.int64(), pa.binary(), *[pa.int64()] * 3))],
                                                 names=["key", "depth", "parent", "conv", "n", "words"])

    return (segs.select("conv", "seg", "a", "b", "x", "y", "w")
            .mapInArrow(run, "key binary, depth long, parent binary, conv long, n long, words long"))


def _local_sums(segs: DataFrame, segment: int) -> DataFrame:
    """Second pass: ``(key, saved, leaves)`` summed over the members of local tries.  ``last`` is the depth above the first node that
    the conversation owns, ``tail`` the words of its turns behind this segment down to there, ``leaf`` 1 if it owns a leaf."""
    def sequences(conv, seg, a, b, last, tail, leaf, x, y, w):
        start = seg * segment
        keys = _keys(a, b, x, y)
        upper = min(last, start + len(w)) - start
        if upper > 0 or (upper == 0 and start == 0):
            yield start, keys[:upper + 1], w[:upper], conv, (1, tail, 0)
        if leaf:
            yield start, keys, w, conv, (0, 0, 1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for nodes in _tries(batches, sequences):
            below = {id(n): n.weights[1] for n in nodes}
            rows = []
            for n in reversed(nodes):
                saved, count, leaves = below[id(n)], n.weights[0], n.weights[2]
                for d in reversed(_depths(n)):
                    saved += count * int(n.words[d - n.base - 1]) if d else 0
                    if saved or leaves:
                        rows.append((n.key(d), saved, leaves))
                if n.up is not None:        # words of this edge and below count for every node above
                    below[id(n.up)] += saved - n.weights[1]
            for i in range(0, len(rows), 20_000):
                cols = list(zip(*rows[i:i + 20_000]))
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, (pa.binary(), pa.int64(), pa.int64()))],
                                                 names=["key", "saved", "leaves"])

    return (segs.select("conv", "seg", "a", "b", "last", "tail", "leaf", "x", "y", "w")
            .mapInArrow(run, "key binary, saved long, leaves long"))


# ------------------------------------------------------------------ ends
def ends_sha256(ends: DataFrame, text_chunk: int = TEXT_CHUNK) -> DataFrame:
    """``(key, ends_sha256)`` of ``ends (key, conv)``: a key's identifiers, ascending and comma-joined.  Range-partitioned tasks make chunks
    of text, so a hot key is many tasks' work; its digest, sequential by nature, reads one stream of chunks."""
    def chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, first, parts, size, out = None, 0, [], 0, []
        names = ["key", "first", "text"]

        def done():
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), (pa.binary(), pa.int64(), pa.string()))], names=names)

        for b in batches:
            for k, c in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                if parts and (k != key or size >= text_chunk):
                    out.append((key, first, ",".join(parts)))
                    parts, size = [], 0
                if not parts:
                    key, first = k, c
                parts.append(str(c))
                size += len(parts[-1]) + 1
            if len(out) >= 256:
                yield done()
                out.clear()
        if parts:
            out.append((key, first, ",".join(parts)))
        if out:
            yield done()

    def digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, sha, out = None, None, []

        def done():
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), (pa.binary(), pa.string()))],
                                              names=["key", "ends_sha256"])

        for b in batches:
            for k, t in zip(b.column(0).to_pylist(), b.column(2).to_pylist()):
                if k == key:
                    sha.update(b"," + t.encode())
                else:
                    if sha:
                        out.append((key, sha.hexdigest()))
                    key, sha = k, hashlib.sha256(t.encode())
            if len(out) >= 10_000:
                yield done()
                out.clear()
        if sha:
            out.append((key, sha.hexdigest()))
        if out:
            yield done()

    rows = (ends.repartitionByRange("key", "conv").sortWithinPartitions("key", "conv")
            .mapInArrow(chunks, "key binary, first long, text string"))
    return rows.repartition("key").sortWithinPartitions("key", "first").mapInArrow(digests, "key binary, ends_sha256 string")


def prefix_trie(turns: DataFrame, lengths: DataFrame, segment: int = SEGMENT) -> DataFrame:
    """One row per node of the trie of ``turns (conv, pos, mark, words)``, ``pos`` from 1 without gaps; ``lengths (conv, n)`` names every
    member: key, conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256."""
    segs = _segments(turns, lengths, segment)
    nodes = (_local_nodes(segs, segment).groupBy("key")
             .agg(F.min("depth").alias("depth"), F.min("parent").alias("parent"), F.min("conv").alias("conv"), F.sum("n").alias("n")))
    nodes = cut(nodes)
    children = nodes.filter("depth > 0").groupBy(F.col("parent").alias("key")).agg(F.count(F.lit(1)).alias("children"))
    nodes = cut(nodes.join(children, "key", "left").fillna(0, ["children"]))

    owned = nodes.groupBy("conv").agg(F.min("depth").alias("t"), F.max((F.col("children") == 0).cast("int")).alias("leaf"))
    owner = lengths.join(owned, "conv", "left").select(
        "conv", F.coalesce(F.col("t") - 1, F.col("n")).alias("last"), F.coalesce("leaf", F.lit(0)).alias("leaf"))
    segs = segs.join(owner, "conv")
    upper = F.slice("w", F.lit(1), F.greatest(F.lit(0), F.least(F.size("w"), F.col("last") - F.col("seg") * segment)).cast("int"))
    segs = cut(segs.withColumn("part", F.aggregate(upper, F.lit(0).cast("long"), lambda s, v: s + v)))
    later = Window.partitionBy("conv").orderBy(F.col("seg").desc()).rowsBetween(*EARLIER)
    tails = segs.select("conv", "seg", F.coalesce(F.sum("part").over(later), F.lit(0)).alias("tail"))
    sums = (_local_sums(segs.join(tails, ["conv", "seg"]), segment).groupBy("key")
            .agg(F.sum("saved").alias("saved"), F.sum("leaves").alias("leaves")))

    ends = segs.groupBy("conv").agg(F.bit_xor("tx").alias("x"), F.bit_xor("ty").alias("y")).select(_key("x", "y").alias("key"), "conv")
    shas = ends_sha256(ends)

    # children of the root, which may be most nodes, know their parent's member without a join
    root = nodes.filter("depth = 0").select("conv").scalar()
    parents = nodes.filter("children > 0 AND depth > 0").select(F.col("key").alias("parent"), F.col("conv").alias("parent_conv"))
    out = nodes.join(sums, "key", "left").join(shas, "key", "left")
    deep = out.filter("depth > 1").join(parents, "parent").withColumn("parent_conv_id", F.col("parent_conv")).drop("parent_conv")
    top = out.filter("depth <= 1").withColumn("parent_conv_id", F.when(F.col("depth") == 1, root))
    none = hashlib.sha256(b"").hexdigest()
    return deep.unionByName(top).select(
        "key", F.col("conv").alias("conv_id"), "depth", "parent_conv_id", F.col("n").alias("n_convs"), F.col("children").alias("n_children"),
        F.coalesce("leaves", F.lit(0)).alias("n_leaves"), F.coalesce("saved", F.lit(0)).alias("saved_tokens"),
        F.coalesce("ends_sha256", F.lit(none)).alias("ends_sha256"))


def conversation_trie(conversations: DataFrame, segment: int = SEGMENT) -> DataFrame:
    """``prefix_trie`` of the rebuilt conversations of a table with conv_id, turn, role and text."""
    return prefix_trie(*rebuilt(conversations), segment)
