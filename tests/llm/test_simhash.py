"""SimHash groups against brute force; the Golay keys' guarantee."""
import random

import numpy as np
import xxhash

from logscope.llm import simhash as S
from logscope.llm.golay import KEYS, error_patterns, near_codewords, syndrome
from logscope.llm.queries import op4_simhash_groups

from .conftest import SF_MID


def brute(text):
    t = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words, cur = [], ""
    for c in t + " ":
        if c in " \t\n\x0b\x0c\r":
            words, cur = words + [cur] * bool(cur), ""
        else:
            cur += c
    if not words:
        return 0
    h = [xxhash.xxh64_intdigest(" ".join(words[i:i + 4]).encode(), 42) for i in range(max(1, len(words) - 3))]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def brute_groups(ids, prints):
    v, lab = np.array(prints, np.uint64), list(range(len(ids)))
    near = [np.flatnonzero(np.bitwise_count(v ^ x) <= 4) for x in v]
    seen, out = set(), {}
    for i in range(len(ids)):
        if i not in seen:
            todo, comp = [i], []
            seen.add(i)
            while todo:
                x = todo.pop()
                comp.append(x)
                new = [int(y) for y in near[x] if int(y) not in seen]
                seen.update(new)
                todo += new
            known = [ids[x] for x in comp if ids[x] is not None]
            for x in comp:
                out[x] = min(known) if known else None
    return [out[i] for i in lab]


def test_golay_code_is_perfect():
    e = error_patterns()
    assert e.shape == (2048, KEYS) and sorted(np.bitwise_count(e[:, 0]).tolist())[-1] == 3
    assert (syndrome(e.ravel()).reshape(e.shape) == np.arange(2048)[:, None]).all()


def test_words_two_bits_apart_share_a_codeword():
    rng = np.random.default_rng(1)
    a = rng.integers(0, 1 << 23, 3000).astype(np.uint32)
    for i in range(23):
        for j in range(i, 23):
            b = a[:60] ^ np.uint32(1 << i) ^ np.uint32((1 << j) if j != i else 0)
            ka, kb = near_codewords(a[:60]), near_codewords(b)
            assert all(set(x) & set(y) for x, y in zip(ka.tolist(), kb.tolist()))


def test_fingerprints_four_bits_apart_share_a_key():
    rng, random.seed = np.random.default_rng(2), random.seed
    a = rng.integers(0, 1 << 64, 4000, dtype=np.uint64)
    flip = np.array([sum(1 << b for b in rng.choice(64, rng.integers(0, 5), replace=False).tolist()) for _ in a], np.uint64)
    (pa, ka), (pb, kb) = S.fuzzy_keys(a), S.fuzzy_keys(a ^ flip)
    one, two = [set() for _ in a], [set() for _ in a]
    for p, k in zip(pa.tolist(), ka.tolist()):
        one[p].add(k)
    for p, k in zip(pb.tolist(), kb.tolist()):
        two[p].add(k)
    assert all(x & y for x, y in zip(one, two)) and len(ka) < 50 * len(a)


def test_fingerprints():
    for t in ["", None, " \n\t", "One", "a b c", "a b c d", "A b\x0bC d e f", "x y z w " * 900, "É ß 一 二 三", "a" * 10000]:
        assert S.fingerprint((t or "").encode()) == brute(t), t


def test_whole_table_equals_brute_force(spark):
    docs = sorted((r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SF_MID}/documents.parquet").collect())
    prints = [brute(t) for _, t in docs]
    want = dict(zip([i for i, _ in docs], zip([f"{p:016x}" for p in prints], brute_groups([i for i, _ in docs], prints))))
    got = {r["doc_id"]: (r["fingerprint"], r["component_id"]) for r in op4_simhash_groups(spark, SF_MID).collect()}
    assert got == want


def planted(n=250, seed=3):
    """Fingerprints in chains, dense balls and at random."""
    rng = random.Random(seed)
    out = [rng.getrandbits(64) for _ in range(n)]
    for start in out[:4]:
        x = start
        for _ in range(40):             # a chain of steps of up to 4 bits
            for b in rng.sample(range(64), rng.randint(1, 4)):
                x ^= 1 << b
            out.append(x)
    for start in out[4:6]:              # a dense ball: many share many keys
        out += [start ^ (1 << rng.randrange(64)) ^ (1 << rng.randrange(64)) for _ in range(120)]
    return sorted(set(out))


def test_links_lose_nothing_whatever_the_block_size(spark):
    v = planted()
    frame = spark.createDataFrame([(x - (1 << 64) if x >= 1 << 63 else x,) for x in v], "fp long")
    want = brute_groups(v, v)
    for rows in (4096, 60, 50):
        edges = S.fuzzy_edges(frame, block_rows=rows)
        assert edges.count() < 41 * len(v)          # stars, not pairs
        root = {r["node"] % (1 << 64): r["root"] % (1 << 64) for r in S.components(edges).collect()}
        groups = {}
        for x, g in zip(v, want):
            groups.setdefault(g, set()).add(root.get(x, x))
        assert all(len(g) == 1 for g in groups.values()) and len({next(iter(g)) for g in groups.values()}) == len(groups)


def test_components_of_long_paths_and_stars(spark):
    e = [(i, i + 1) for i in range(200)] + [(1000, 1000 + i) for i in range(1, 150)] + [(5, 5)]
    got = {r["node"]: r["root"] for r in S.components(spark.createDataFrame(e, "a long, b long")).collect()}
    assert all(got[i] == 0 for i in range(201)) and all(got[1000 + i] == 1000 for i in range(150))
    assert S.components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_odd_rows(spark, docs_of):
    rows = [(5, None), (4, ""), (9, " \n"), (7, "same text here now"), (3, "same text here now"), (3, "same text here now"),
            (None, "same text here now"), (None, "only without id x y z")]
    got = S.simhash_groups(docs_of(rows)).collect()
    assert sorted((r["doc_id"] or -1, r["component_id"]) for r in got if r["component_id"]) == [
        (-1, 3), (3, 3), (3, 3), (4, 4), (5, 4), (7, 3), (9, 4)]
    assert sum(r["component_id"] is None for r in got) == 1
    kept = S.keep_one(docs_of(rows)).collect()
    assert sorted(r["doc_id"] for r in kept if r["doc_id"] is not None) == [3, 4]
    assert sum(r["doc_id"] is None for r in kept) == 2
    assert S.simhash_groups(docs_of([])).count() == 0 and S.keep_one(docs_of([])).count() == 0


def test_extra_columns_with_clashing_names(spark):
    df = spark.createDataFrame([(1, "a b c d", "x", 2), (2, "a b c d", "y", 3)], "doc_id long, text string, _first string, _n int")
    assert [tuple(r) for r in S.keep_one(df).collect()] == [(1, "a b c d", "x", 2)]
