"""Z-fast trie and conversation nodes against brute force."""
import hashlib
import random
import re
import zlib

import pytest

from logscope.llm import conversations as C
from logscope.llm.zfast import ZFastTrie, two_fattest

SCHEMA = "conv_id long, turn long, role string, text string"
COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def test_two_fattest():
    for a in range(40):
        for b in range(a + 1, 70):
            assert two_fattest(a, b) == max(range(a + 1, b + 1), key=lambda x: x & -x)


def hashed(seq):
    return [hashlib.md5(repr(seq[:d]).encode()).digest() for d in range(len(seq) + 1)]


@pytest.mark.parametrize("seed", range(30))
def test_exit_nodes_and_counts(seed):
    rng = random.Random(seed)
    trie, seqs = ZFastTrie(), []
    for i in range(60):
        s = tuple(rng.choice("ab") for _ in range(rng.randint(0, rng.choice((3, 12, 40)))))
        if seqs and rng.random() < 0.5:
            s = rng.choice(seqs)[:rng.randint(0, 30)] + s
        keys = hashed(s)
        root = trie.roots.get(keys[0])
        if root:
            # exit node: the deepest node that shares an element of its edge, found by walking all nodes
            share = lambda n: max((d for d in range(min(n.hi, len(s)) + 1) if n.key(d) == keys[d]), default=0)
            on = [n for n in trie.nodes() if n.up is None or share(n) > n.lo]
            assert trie.exit_node(root, keys) is max(on, key=lambda n: n.lo if n.up else -1)
        trie.insert(0, keys, [1] * len(s), i, (1, 0, 0))
        seqs.append(s)
    got = {n.key(d): (n.weights[0], n.least) for n in trie.gather() for d in (range(n.lo + 1, n.hi + 1) if n.up else (0,))}
    want = {}
    for i, s in enumerate(seqs):
        for k in hashed(s):
            c, least = want.get(k, (0, i))
            want[k] = (c + 1, min(least, i))
    assert got == want


def brute(rows):
    own = {}
    for c, turn, role, text in rows:
        if c is not None:
            role, text = role or "", text or ""
            mark = hashlib.md5(f"{len(role.encode())}:{role}{text}".encode()).hexdigest()
            own.setdefault(c, []).append(((turn is not None, turn or 0, mark), (role, text)))
    own = {c: [t for _, t in sorted(v)] for c, v in own.items()}
    convs = {}
    for c in own:
        h = zlib.crc32(str(c).encode()) % 4
        src = c - (c % 20 if c >= 0 else -(-c % 20))
        convs[c] = tuple(own.get(src, [])[:h] + own[c][h:])
    node = {}
    for c, t in convs.items():
        for d in range(len(t) + 1):
            node.setdefault(t[:d], []).append(c)
    kids, out = {}, []
    for t in node:
        if t:
            kids.setdefault(t[:-1], []).append(t)
    leaves, saved = {}, {}
    for t in sorted(node, key=len, reverse=True):
        below = kids.get(t, [])
        leaves[t] = sum(leaves[k] for k in below) or 1
        words = len(re.findall(r"[^\x20\x09-\x0D]+", t[-1][1])) if t else 0
        saved[t] = sum(saved[k] for k in below) + (len(node[t]) - 1) * words
        ends = sorted(c for c in node[t] if len(convs[c]) == len(t))
        out.append((min(node[t]), len(t), min(node[t[:-1]]) if t else None, len(node[t]), len(below), leaves[t], saved[t],
                    hashlib.sha256(",".join(map(str, ends)).encode()).hexdigest()))
    return sorted(out, key=str)


def run(spark, rows, segment=C.SEGMENT):
    got = C.conversation_trie(spark.createDataFrame(rows, SCHEMA), segment)
    assert got.columns == ["key", *COLUMNS]
    return sorted([tuple(r)[1:] for r in got.collect()], key=str)


def some(seed, convs=60, most=9):
    rng, rows = random.Random(seed), []
    turn = lambda: (rng.choice(("user", "bot", None)), rng.choice(("", None, "a", "a  b", "c\td\x0be f", "é ö")))
    old = []
    for c in rng.sample(range(-50, 200), convs):
        t = [turn() for _ in range(rng.randint(1, most))]
        if old and rng.random() < 0.6:
            t = rng.choice(old)[:rng.randint(1, most)] + t[:rng.randint(0, 3)]
        old.append(t)
        rows += [(c, rng.choice((i, i, i, None)) if rng.random() < 0.1 else i, *x) for i, x in enumerate(t)]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("seed,segment", [(1, 1024), (2, 3), (3, 1)])
def test_nodes_equal_brute_force(spark, monkeypatch, seed, segment):
    monkeypatch.setattr(C, "CHUNK", 4)
    rows = some(seed) + [(7, 1, "user", "x"), (7, 1, "user", "x"), (None, 1, "user", "no id"), (300, -5, "user", "first"), (300, None, None, None)]
    assert run(spark, rows, segment) == brute(rows)


def test_small_tries_and_text_chunks_merge(spark, monkeypatch):
    monkeypatch.setattr(C, "TRIE_ELEMENTS", 10)
    monkeypatch.setattr(C, "TEXT_CHUNK", 20)
    rows = some(4, 90) + [(c, i, "user", "same") for c in range(1000, 1400) for i in range(5)]    # a hot conversation
    assert run(spark, rows, 4) == brute(rows)


def test_long_conversation_and_turnless(spark):
    rows = [(20, i, "user", f"turn {i} " + "w " * (i % 5)) for i in range(3000)] + [(21, i, "user", f"turn {i} " + "w " * (i % 5)) for i in range(2500)]
    rows += [(c, 0, "user", "only") for c in range(501, 520)]       # shorter than what they borrow, from a conversation that is absent
    rows += [(20 + c, 0, "user", "x" * 400_000) for c in (3, 5)]
    got = run(spark, rows, 700)
    assert got == brute(rows) and any(r[1] == 0 for r in got)


def test_empty_and_extra_columns(spark):
    assert run(spark, []) == []
    rows = some(5, 20)
    df = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 as depth", "'x' as conv", "2 as key", "3 as words")
    assert sorted([tuple(r)[1:] for r in C.conversation_trie(df).collect()], key=str) == brute(rows)
