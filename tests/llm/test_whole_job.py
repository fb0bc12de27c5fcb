"""Cases in which an operator once did less than its whole job."""
import random

import numpy as np
from pyspark.sql import functions as F

import corpus_pipeline
from logscope.llm import decontamination as D
from logscope.llm import language as G
from logscope.llm import neighbours as N
from logscope.llm import simhash as S


# ------------------------------------------------------------------ decontamination
def word_edits(a, b):
    """Least word edits of a against any part of b."""
    row = [0] * (len(b) + 1)
    for i, x in enumerate(a):
        new = [i + 1]
        for j, y in enumerate(b):
            new.append(min(row[j] + (x != y), row[j + 1] + 1, new[j] + 1))
        row = new
    return min(row)


def brute_runs(doc, item):
    a, b = D.normalise(item).split(), D.normalise(doc).split()
    if len(a) < 3 and len(D.normalise(item)) < D.MIN_SHORT:
        return bool(a) and a == b
    n = min(len(a), D.WORDS)
    most = D.WORD_EDITS if len(a) >= D.WORDS else int(len(a) >= 8)
    return any(word_edits(a[i:i + n], b) <= most for i in range(len(a) - n + 1))


def test_runs_equal_brute_force():
    rng = random.Random(5)
    words = [f"w{i}" for i in range(40)]
    text = lambda n: [rng.choice(words) for _ in range(n)]
    items = [(i, " ".join(text(n)).encode()) for i, n in enumerate([1, 2, 3, 4, 5, 7, 8, 10, 12, 13, 14, 20, 30, 60])]
    items += [(90, b"averyveryverylongword"), (91, b"..."), (92, items[-1][1])]
    docs = [b"", b"w1", items[0][1], items[1][1]]
    for i in range(300):
        w = rng.choice(items)[1].decode().split()
        a = rng.randrange(max(1, len(w) - 12))
        w = w[a:a + rng.randint(11, 20)]
        for _ in range(rng.randint(0, 3)):
            k = rng.randrange(len(w))
            w[k:k + rng.choice((0, 1))] = rng.choice(([], ["zz"], [rng.choice(words)]))
            w = w or ["zz"]
        docs.append(" ".join(text(rng.randint(0, 6)) + w + text(rng.randint(0, 6))).encode())
    rule, got = D.Runs(items), []
    for group in D.groups(docs):
        got += rule.items_of(group)
    want = [[i for i, t in items if brute_runs(d, t)] for d in docs]
    assert got == want and 50 < sum(map(bool, want)) < 300


def test_excerpts_edits_and_short_items_are_found():
    rng = random.Random(6)
    word = lambda: "".join(rng.choice("abcdefghijklmnop") for _ in range(rng.randint(2, 8)))
    items = [(i, " ".join(word() for _ in range(rng.randint(30, 60)))) for i in range(60)]
    pad = " ".join(word() for _ in range(40))
    docs = []
    for _, t in items:
        w = t.split()
        a = rng.randrange(len(w) - 12)
        odd = [x if i % 10 else "zzz" for i, x in enumerate(w)]
        docs += [" ".join([pad, *w[a:a + 13], pad]), " ".join([pad, *odd, pad])]
    index = D.Index([(i, t.encode()) for i, t in items])
    assert index.items_in([d.encode() for d in docs]) == [[i] for i, _ in items for _ in range(2)]
    index = D.Index([(1, "Größe ÄRGER und Übermut".encode()), (2, b"Who wrote Hamlet?"), (3, b"42")])
    assert index.items_in(["x größe ärger UND übermut y".encode(), b"so, who wrote hamlet", b"who wrote hamlets", b"42 x", b" 42."]) == [[1], [2], [], [], [3]]


def test_long_text_over_slices_by_words():
    item = (9, b"one two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen sixteen seventeen")
    cut = b" ".join(item[1].split()[2:15])
    pad = b"lorem ipsum dolor sit amet " * 45000
    for n in range(D.SLICE - 90, D.SLICE, 7):
        assert D.Index([item]).items_in([pad[:n].rstrip() + b" " + cut + b" " + pad]) == [[9]]
    assert D.Index([item]).items_in([b"x" * (3 * D.SLICE), pad]) == [[], []]


def test_decontamination_drops_an_excerpt(spark, docs_of):
    item = " ".join(f"word{i} tail" for i in range(30))
    bench = spark.createDataFrame([(7, item)], "item_id long, text string")
    docs = docs_of([(1, "aa " + " ".join(item.split()[11:24]) + " bb"), (2, "clean text")])
    assert [r["items"] for r in D.contamination(docs, bench).orderBy("doc_id").collect()] == [[7], []]
    assert [r["doc_id"] for r in D.drop_contaminated(docs, bench).collect()] == [2]
    assert D.contamination(docs, bench).filter(F.size("items") > 0).count() == 1


# ------------------------------------------------------------------ language
def prose(rng, letters, n):
    return " ".join("".join(rng.choice(letters) for _ in range(rng.randint(2, 5))) for _ in range(n))


def test_a_rare_language_is_identified(spark, tmp_path):
    """One language at 0.1 % of the rows in another script, one in the same script."""
    rng = random.Random(8)
    common = ["th", "er", "on", "an", "re", "a", "in"]
    rows = [(i, prose(rng, common, 30), "en", "s") for i in range(10_000)]
    rows += [(20_000 + i, prose(rng, ["και", "το", "αν", "ος", "η", "με"], 30), "el", "s") for i in range(10)]
    rows += [(30_000 + i, prose(rng, ["ij", "aa", "oe", "ge", "k", "cht"], 30), "nl", "s") for i in range(10)]
    rows += [(40_000, rows[0][1], "zz", "s")]        # one row is no language
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    model = G.train_text(docs)
    assert model.languages == ["el", "en", "nl"]
    got = {r["doc_id"]: r for r in G.identify(docs, model, declared="lang", host="source").collect()}
    assert len(got) == len(rows) and all(got[i]["accepted"] for i, *_ in rows)
    assert all(got[i]["language"] == x for i, _, x, _ in rows if x != "zz")
    kept = corpus_pipeline.keep_identified(spark, docs, str(tmp_path))
    assert kept.count() == len(rows)


def test_many_languages_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(G, "HELD", 7)
    rng = random.Random(9)
    rows = [(k * 100 + i, prose(rng, [chr(0x400 + 8 * k + x) for x in range(8)], 30), "l" + chr(97 + k // 26) + chr(97 + k % 26), f"h{k}.site.x")
            for k in range(60) for i in range(12)]
    rng.shuffle(rows)
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    model = G.train_text(docs)
    assert len(model.languages) == 60
    got = {r["doc_id"]: r for r in G.identify(docs, model, declared="lang", host="source").collect()}
    assert all(got[i]["language"] == x and got[i]["accepted"] for i, _, x, _ in rows)


# ------------------------------------------------------------------ neighbours
def test_repeated_ids_keep_their_neighbours(spark):
    rng = np.random.default_rng(11)
    x = rng.normal(size=(400, 8))
    ids = np.r_[np.zeros(30, int), np.repeat(np.arange(1, 11), 2), np.arange(11, 361)][:400]
    x[:30] = x[0] + 0.01 * rng.normal(size=(30, 8))     # more rows of an id than k, all close to each other
    x[31] = x[30]                                       # a vector repeated under its id
    frame = spark.createDataFrame([(int(i), v.tolist()) for i, v in zip(ids, x)], "vec_id long, embedding array<double>")
    got = N.nearest(frame, F.col("vec_id") <= 12, 10, share=1.0, block_rows=64).collect()
    asked = {(int(i), tuple(v)) for i, v in zip(ids, x) if i <= 12}
    want = []
    for i, v in asked:
        score = (x * np.array(v)).sum(axis=1)
        order = [j for j in np.lexsort((ids, -score)) if ids[j] != i][:10]
        want += [(i, r + 1, int(ids[j]), round(float(score[j]), 9)) for r, j in enumerate(order)]
    assert len(asked) == 30 + 19 + 2
    assert sorted((r["query_id"], r["rank"], r["vec_id"], round(r["score"], 9)) for r in got) == sorted(want)


# ------------------------------------------------------------------ near-duplicates
def test_repeated_ids_keep_one_row_of_each_group(docs_of):
    a, b, c = ("".join(f"{x}{i} " for i in range(30)) for x in "pqr")
    rows = [(3, a), (5, a), (7, b), (7, a), (8, c), (8, c), (9, c), (2, b), (2, c), (None, a)]
    got = [(r["doc_id"], r["text"]) for r in S.keep_one(docs_of(rows)).collect()]
    # id 7 has a copy of 3's text and of 2's; id 2 is the smallest of two groups
    assert sorted(got, key=str) == sorted([(2, b), (2, c), (3, a), (None, a)], key=str)
    got = [(r["doc_id"], r["text"]) for r in S.keep_one(docs_of([(1, a), (2, a), (2, b)])).collect()]
    assert sorted(got) == [(1, a), (2, b)]
    got = [(r["doc_id"], r["text"]) for r in S.keep_one(docs_of([(1, a), (2, a), (2, b), (4, c), (4, c)])).collect()]
    assert sorted(got) == [(1, a), (2, b), (4, c)]
