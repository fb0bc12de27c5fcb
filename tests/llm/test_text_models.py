"""Toxicity, language, decontamination, licences and the pipeline."""
import random
import zlib

import numpy as np
from pyspark.sql import functions as F

import corpus_pipeline
from logscope.llm import decontamination as D
from logscope.llm import language as G
from logscope.llm import toxicity as T
from logscope.llm.licenses import scan, scan_licenses
from logscope.llm.queries import QUERIES, op2_decontamination, op3_language_id, op6_license_scan, op8_toxicity

from .conftest import SF_MID, SF_SMALL

CLEAN = "the of and a to in is it you that he was for on are with as his they be at one have this from".split()


def toxic_corpus(n=600, seed=1):
    rng, rows = random.Random(seed), []
    bad = ["idi" + x for x in ("ot", "otic", "ots", "otz", "oten", "otly")] + ["mor" + x for x in ("on", "ons", "onic", "onz", "only")]
    for i in range(n):
        w = [rng.choice(CLEAN) + rng.choice(["", "s", "ed", "ing"]) for _ in range(rng.randint(20, 120))]
        y = i % 4 == 0
        for _ in range(1 + len(w) // 15 if y else 0):
            w.insert(rng.randrange(len(w)), rng.choice(bad[:-2]))
        rows.append((i, " ".join(w), int(y)))
    return rows


# ------------------------------------------------------------------ toxicity
def test_toxicity_generalises_to_unseen_forms(spark):
    rows = toxic_corpus()
    docs = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string")
    labels = spark.createDataFrame([(r[0], 1, r[2]) for r in rows if r[0] < 450], "doc_id long, quality int, toxic int")
    model = T.fit(docs, labels)
    got = {r["doc_id"]: r for r in T.score_toxicity(docs, model).collect()}
    right = [got[i]["predicted"] == y for i, _, y in rows if i >= 450]
    assert np.mean(right) > 0.95 and all(0 <= r["score"] <= 1 for r in got.values())
    words = T._Words(model.rows)
    unseen = T.score_text(words, model.bias, " ".join(CLEAN) + " idiotical moronz idiotish")
    assert unseen > T.score_text(words, model.bias, " ".join(CLEAN) + " tables chairs windows")


def test_toxicity_training_ignores_order_and_held_out_labels(spark):
    rows = toxic_corpus(120)
    docs = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string")
    labels = spark.createDataFrame([(r[0], r[2]) for r in rows], "doc_id long, toxic int")
    a, b = T.fit(docs, labels), T.fit(docs.repartition(7), labels.repartition(3))
    assert (a.rows == b.rows).all() and a.bias == b.bias
    flipped = labels.withColumn("toxic", F.when(T.held_out(), 1 - F.col("toxic")).otherwise(F.col("toxic")))
    c, d = (T.fit(docs, x.filter(~T.held_out())) for x in (labels, flipped))
    assert (c.rows == d.rows).all()


def test_toxicity_odd_rows(spark, docs_of):
    docs = docs_of([(1, None), (2, ""), (3, "some text"), (3, "some text"), (None, "x"), (4, "w " * 50000)])
    labels = spark.createDataFrame([(3, 1), (4, 0), (1, None), (None, 1), (99, 1)], "doc_id long, toxic int")
    got = T.score_toxicity(docs, T.fit(docs, labels)).collect()
    assert len(got) == 6 and got[0]["score"] == got[1]["score"]
    empty = T.fit(docs, labels.limit(0))
    assert {(r["score"], r["predicted"]) for r in T.score_toxicity(docs, empty).collect()} == {(0.5, 0)}
    assert T.score_toxicity(docs_of([]), empty).count() == 0


def test_toxicity_query_covers_the_table(spark):
    rows = op8_toxicity(spark, SF_MID).collect()
    assert sorted(r["doc_id"] for r in rows) == list(range(1000))
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) for r in rows)
    labels = {r["doc_id"]: r["toxic"] for r in spark.read.parquet(f"{SF_MID}/labels.parquet").collect()}
    held = [(r["score"], labels[r["doc_id"]]) for r in rows if r["held_out"] and r["doc_id"] in labels]
    pos, neg = [s for s, y in held if y], [s for s, y in held if not y]
    assert np.mean([p > n for p in pos for n in neg]) > 0.8


# ------------------------------------------------------------------ language
def test_language_of_whole_tables(spark):
    rows = op3_language_id(spark, SF_MID).collect()
    docs = {r["doc_id"]: r["lang"] for r in spark.read.parquet(f"{SF_MID}/documents.parquet").collect()}
    pages = spark.read.parquet(f"{SF_MID}/pages.parquet").count()
    got = {r["doc_id"]: r for r in rows if r["doc_id"] is not None}
    assert set(got) == set(docs) and sum(r["page_id"] is not None for r in rows) == pages
    assert np.mean([got[i]["language"] == x for i, x in docs.items()]) > 0.98
    assert np.mean([r["accepted"] for r in rows]) > 0.99


def test_text_alone_on_held_out_documents(spark):
    docs = spark.read.parquet(f"{SF_MID}/documents.parquet")
    model = G.train_text(docs.filter("doc_id % 3 != 0"))
    got = G.identify(docs.filter("doc_id % 3 = 0"), model).collect()
    assert model.languages == ["de", "en", "es", "fr"]
    assert np.mean([r["language"] == r["lang"] for r in got if r["n_chars"] > 200]) > 0.95


def test_evidence_decides_where_the_text_does_not(spark):
    train = spark.createDataFrame([(f"aaa bbb aab {i}", "x") for i in range(50)] + [(f"ccc ddd ccd {i}", "y") for i in range(50)], "text string, lang string")
    model = G.train_text(train)
    rows = [(i, "aaa bbb aab", "x", "one.site.xx", "xx") for i in range(30)] + [(100 + i, "ccc ddd ccd", "y", "two.other.yy", "yy") for i in range(30)]
    rows += [(200, "zzz", "x", None, None), (201, "zzz", "y", None, None), (202, "zzz", None, "one.site.xx", "xx"), (203, "zzz", None, "new.other.yy", None),
             (204, None, "x", "one.site.xx", "xx"), (205, "123 !!", None, None, None), (206, "zzz", None, None, "yy")]
    df = spark.createDataFrame(rows, "id int, text string, declared string, host string, suffix string")
    got = {r["id"]: r for r in G.identify(df, model, "text", "declared", "host", "suffix").collect()}
    assert len(got) == len(rows)
    best = lambda i: "x" if got[i]["px"] > got[i]["py"] else "y"  # noqa: E731, F841
    assert all(got[i]["language"] == "x" and got[i]["accepted"] for i in range(30))
    assert {i: got[i]["language"] for i in (204, 205)} == {204: "und", 205: "und"} and not got[204]["accepted"]
    closed = G.TextModel(model.languages, model.table.copy())
    closed.table[:, -1] = -50           # no way out: the evidence must choose
    got = {r["id"]: r["language"] for r in G.identify(df, closed, "text", "declared", "host", "suffix").collect()}
    assert {i: got[i] for i in (200, 201, 202, 203, 206)} == {200: "x", 201: "y", 202: "x", 203: "y", 206: "y"}


def test_language_odd_tables(spark, docs_of):
    none = G.train_text(docs_of([]))
    got = G.identify(docs_of([(1, "text"), (2, None)]), none, declared="lang", host="source").collect()
    assert [(r["language"], r["posterior"], r["accepted"]) for r in got] == [("und", 1.0, False)] * 2
    model = G.train_text(docs_of([(1, "some text here"), (1, "some text here"), (None, "more"), (3, None)]))
    assert G.identify(docs_of([]), model, declared="lang", host="source").count() == 0
    clash = spark.createDataFrame([(1, "some text", "q", 5, "h")], "doc_id long, text string, language string, _ll int, `a.b` string")
    out = G.identify(clash, model).collect()[0]
    assert out["_ll"] == 5 and out["a.b"] == "h" and out["language"] == "en"


def test_page_evidence(spark):
    html = '<!DOCTYPE html><HTML class="a" lang=\'fr-CA\'><script>var t="</p>";</script><!-- x --><p>Bonjour <b>tous</b></p>'
    rows = [(1, "https://User@M.Ex.Example.COM:80/fr?x#y", html), (2, None, None), (3, "not a url", "<p>hi")]
    got = {r["page_id"]: tuple(r)[1:] for r in G.page_evidence(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert " ".join(got[1][0].split()) == "Bonjour tous" and got[1][1:] == ("fr", "m.ex.example.com", "com")
    assert got[2] == (None, None, None, None) and got[3][1:] == (None, None, None)


# ------------------------------------------------------------------ decontamination
def edits(a, b):
    """Least edits of a against any part of b."""
    row = np.zeros(len(b) + 1, int)
    for i, x in enumerate(a):
        new = np.empty_like(row)
        new[0] = i + 1
        step = np.minimum(row[1:] + 1, row[:-1] + (np.frombuffer(b, np.uint8) != x))
        for j, s in enumerate(step):
            new[j + 1] = min(s, new[j] + 1)
        row = new
    return int(row.min())


def brute_items(doc, items):
    t, out = D.normalise(doc), set()
    for i, item in items:
        n = D.normalise(item)
        if len(n) < D.MIN_ITEM:
            continue
        starts = {*range(0, max(1, len(n) - D.PASSAGE + 1), D.PASSAGE // 2), max(0, len(n) - D.PASSAGE)}
        if any(edits(p, t) <= int(len(p) * D.EDIT_RATE) for p in (n[a:a + D.PASSAGE] for a in starts)):
            out.add(i)
    return sorted(out)


def noisy(text, n, rng):
    x = bytearray(text)
    for _ in range(n):
        k = rng.randrange(len(x))
        x[k:k + rng.choice((0, 1))] = rng.choice((b"", b"q", b"z"))
    return bytes(x)


def test_regions_equal_brute_force():
    rng = random.Random(7)
    text = lambda n: " ".join("".join(rng.choice(["th", "er", "on", "an", "re", "a"]) for _ in range(rng.randint(1, 4))) for _ in range(n)).encode()
    items = [(i, text(rng.randint(5, 30))) for i in range(12)]
    docs = []
    for i in range(40):
        item = rng.choice(items)[1]
        docs.append(text(rng.randint(0, 20)) + b" " + noisy(item, rng.randint(0, len(item) // 12), rng) + b" " + text(rng.randint(0, 20)))
    docs += [b"", b"x", items[0][1], items[0][1][:60], b"\0" * 300, items[3][1] + items[4][1]]
    got = D.Passages(items).items_in(docs)
    want = [brute_items(d, items) for d in docs]
    assert got == want and 5 < sum(map(bool, want)) < 46


def test_long_document_over_slices():
    item = (9, b"the quick brown fox jumps over the lazy dog and runs away from the angry farmer with his dogs")
    pad = b"lorem ipsum dolor sit amet " * 45000
    assert D.Passages([item]).items_in([pad + item[1] + pad, pad, pad + item[1]]) == [[9], [], [9]]
    edge = pad[:D.SLICE - 40]       # the passage lies across the border of two slices
    assert D.Passages([item]).items_in([edge + b" " + item[1]]) == [[9]]


def test_decontamination_query(spark):
    items = [(r["item_id"], r["text"].encode()) for r in spark.read.parquet(f"{SF_MID}/benchmark.parquet").collect()]
    docs = {r["doc_id"]: r["text"].encode() for r in spark.read.parquet(f"{SF_MID}/documents.parquet").collect()}
    norm = [(i, D.normalise(t)) for i, t in items]
    got = {r["doc_id"]: r["items"] for r in op2_decontamination(spark, SF_MID).collect()}
    assert set(got) == set(docs)
    whole = {d: sorted(i for i, t in norm if t in D.normalise(x)) for d, x in docs.items()}
    assert sum(map(bool, whole.values())) > 10
    for d, x in docs.items():
        assert set(whole[d]) <= set(got[d])
        assert bool(whole[d]) == bool(got[d]), d        # clean documents stay clean


def test_blocks_of_the_benchmark_and_odd_rows(spark, docs_of):
    long = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron"
    bench = spark.createDataFrame([(1, long), (2, long), (3, None), (4, "short"), (None, long), (5, ""), (6, long.upper() + "!")], "item_id long, text string")
    docs = docs_of([(1, f"x {long}. y"), (2, None), (3, ""), (4, "clean text"), (1, f"x {long}. y"), (None, long)])
    for size in (1 << 20, 10):
        got = sorted(((r["doc_id"] or 0), r["items"]) for r in D.contamination(docs, bench, block_bytes=size).collect())
        assert got == [(0, [1, 2, 6]), (1, [1, 2, 6]), (1, [1, 2, 6]), (2, []), (3, []), (4, [])]
    assert D.drop_contaminated(docs, bench).columns == docs.columns
    assert sorted(r["doc_id"] for r in D.drop_contaminated(docs, bench).collect()) == [2, 3, 4]
    assert D.contamination(docs, bench.limit(0)).filter("size(items) > 0").count() == 0
    assert D.contamination(docs_of([]), bench).count() == 0


# ------------------------------------------------------------------ licences
def test_licence_rules():
    mit = ("/* Copyright 2020 X\n * Permission is hereby granted, free of charge, to any person obtaining a copy of this.\n"
           " * The above copyright notice and this permission notice shall be included in all copies.\n"
           " * The software is provided \"as is\", without warranty of any kind. */ foo")
    cases = {mit: ["MIT"], "foo.\nReleased under the MIT License.\nbar": ["MIT"], "Licensed under CC BY-NC 4.0.": ["CC-BY-NC-4.0"],
             "This work is licensed under the GNU General Public License, version 3.": ["GPL-3"],
             "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with "
             "the License. You may obtain a copy of the License at\n\n http://x. Unless required by applicable law or agreed to in "
             "writing, software.": ["Apache-2.0"], "# SPDX-License-Identifier: GPL-2.0-only": ["GPL-2.0-only"],
             "This program is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General "
             "Public License; either version 2.1 of the License, or (at your option) any later version.": ["LGPL-2.1-or-later"],
             "Redistribution and use in source and binary forms, with or without modification, are permitted: 1. Redistributions of source "
             "code must retain the above copyright notice. 2. Redistributions in binary form must reproduce the above copyright notice. "
             "Neither the name of X may be used to endorse or promote products.": ["BSD-3-Clause"],
             "Released under the MIT License. Text. Licensed under CC BY-NC 4.0.": ["MIT", "CC-BY-NC-4.0"], "": [], "no cue": []}
    for text, want in cases.items():
        assert [n for n, _, _ in scan(text)[0]] == want, text
    assert scan("This license is odd.") == ([], 1)
    (name, a, b), = scan("One. Released under the MIT licence. Two.")[0]
    assert "One. Released under the MIT licence. Two."[a:b] == "Released under the MIT licence."


def test_licences_of_the_table(spark):
    import re
    docs = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SF_MID}/documents.parquet").collect()}
    plain = {"Apache-2.0": "Licensed under the Apache License, Version 2.0", "GPL-3": "licensed under the GNU General Public License, version 3",
             "MIT": "Released under the MIT License", "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0"}
    rows = op6_license_scan(spark, SF_MID).collect()
    assert {r["doc_id"] for r in rows} == set(docs)
    for r in rows:
        want = sorted(k for k, p in plain.items() if re.search(re.escape(p), docs[r["doc_id"]], re.I))
        assert list(r["licenses"]) == want


def test_licence_odd_rows(docs_of):
    got = scan_licenses(docs_of([(1, None), (2, ""), (3, "Released under the MIT License. " * 2000), (3, "x"), (None, "x")])).collect()
    assert [list(r["licenses"]) for r in got] == [[], [], ["MIT"], [], []] and len(got[2]["matches"]) == 2000
    assert scan_licenses(docs_of([])).count() == 0


# ------------------------------------------------------------------ pipeline
def test_pipeline_equals_its_stages_by_brute_force(spark):
    """Each stage on its predecessor's rows: what it keeps, checked by other means."""
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    frames = [docs]
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, frames[-1], SF_SMALL)
        frames.append(spark.createDataFrame(out.collect(), out.schema))
    assert [f.columns for f in frames[:-1]] == [docs.columns] * 5
    kept = [{r["doc_id"]: r["text"] for r in f.select("doc_id", "text").collect()} for f in frames[:-1]]
    from .test_simhash import brute, brute_groups
    ids = sorted(kept[2])
    assert set(kept[3]) == {i for i, g in zip(ids, brute_groups(ids, [brute(kept[2][i]) for i in ids])) if g == i}
    items = [(r["item_id"], D.normalise(r["text"].encode())) for r in spark.read.parquet(f"{SF_SMALL}/benchmark.parquet").collect()]
    leaks = {i for i, t in kept[3].items() if any(x in D.normalise(t.encode()) for _, x in items)}
    assert set(kept[4]) == set(kept[3]) - leaks
    labels = {r["doc_id"]: r["toxic"] for r in spark.read.parquet(f"{SF_SMALL}/labels.parquet").collect()}
    assert len(kept[1]) >= 0.9 * sum(not labels.get(i) for i in kept[0]) and kept[2] == kept[1]
    assert {r["doc_id"] for r in frames[5].collect()} == set(kept[4])
    run = corpus_pipeline.run(spark, SF_SMALL)
    assert sorted(map(tuple, run.select("doc_id", "piece", "ids_crc32").collect())) == sorted(
        map(tuple, frames[5].select("doc_id", "piece", "ids_crc32").collect()))


def test_pipeline_on_empty_and_odd_documents(spark, docs_of):
    odd = [(1, None), (2, ""), (3, "some plain english text here"), (3, "some plain english text here"), (None, "text"), (7, "x " * 30000)]
    for rows in ([], odd):
        docs = docs_of(rows)
        for _, stage in corpus_pipeline.STAGES:
            out = stage(spark, docs, SF_SMALL)
            docs = spark.createDataFrame(out.collect(), out.schema)
        assert rows or docs.count() == 0


def test_every_operator_has_one_query():
    import __spark_entry__ as e
    names = [q for q in e.queries() if q.startswith("op")]
    assert sorted(int(q[2:].split("_")[0]) for q in names) == list(range(1, 14))
    assert set(QUERIES) <= set(e.queries()) and "pipeline" in QUERIES


# ------------------------------------------------------------------ bounded memory, finite models, languages without training rows
def test_a_very_long_labelled_text_leaves_scores_finite(spark):
    rng = np.random.default_rng(3)
    rows = toxic_corpus(120)
    long = " ".join("prefix" + "".join(chr(97 + x) for x in w) for w in rng.integers(0, 26, (70_000, 6)))
    rows = [*rows, (1000, long, 1), (1001, long + " x", 0)]
    docs = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string")
    labels = spark.createDataFrame([(r[0], r[2]) for r in rows], "doc_id long, toxic int")
    model = T.fit(docs, labels)
    assert np.isfinite(model.rows).all() and np.isfinite(model.bias)
    got = T.score_toxicity(docs, model).collect()
    assert all(0 <= r["score"] <= 1 for r in got) and 10 < sum(r["predicted"] for r in got) < 110


def test_labels_that_contradict_are_not_learned_from(spark):
    rows = toxic_corpus(120)
    docs = spark.createDataFrame([r[:2] for r in rows] + [(5000, "either way")], "doc_id long, text string")
    labels = [(r[0], r[2]) for r in rows]
    one = T.fit(docs, spark.createDataFrame(labels, "doc_id long, toxic int"))
    two = T.fit(docs, spark.createDataFrame(labels + [(5000, 0), (5000, 1)], "doc_id long, toxic int"))
    assert (one.rows == two.rows).all() and one.bias == two.bias


def test_calibration_scales_towards_unseen_rows():
    rng = np.random.default_rng(1)
    rows = np.zeros(T.ROWS, np.float32)
    rows[1] = 0.2
    labels = rng.integers(0, 2, 400)
    bags = [(np.array([1]), np.array([float(T.PRIOR * (4 if y else 1))], np.float32)) for y in labels]
    scale, shift = T.calibration(T.Model(rows, 0.0), bags, labels)
    z = [(rows[1] * scale) * c[0] / (T.PRIOR + c[0]) + shift for _, c in bags]
    assert scale > 5 and all((v > 0) == bool(y) for v, y in zip(z, labels))
    assert T.calibration(T.Model(rows, 0.0), bags, np.zeros(400)) == (1.0, 0.0)


def test_memo_is_bounded_and_keeps_frequent_words():
    from logscope.llm.common import Memo

    made = []
    memo = Memo(lambda w: made.append(w) or len(w), 100 * (Memo.ENTRY + 6))
    for i in range(5000):
        assert memo[f"w{i}"] == len(f"w{i}") and memo["often"] == 5
        assert len(memo) + len(memo.old) <= 101
    assert made.count("often") == 1 and memo["x" * 500] == 500 and "x" * 500 not in memo


def test_declared_language_without_training_rows_stands(spark):
    rows = [(i, f"the house and the garden of the people are old and good {i}", "en") for i in range(40)]
    rows += [(100 + i, f"das haus und der garten der leute sind alt und gut {i}", "de") for i in range(40)]
    rows += [(200 + i, "ο κήπος και το σπίτι των ανθρώπων είναι παλιά και όμορφα", "el") for i in range(3)]
    rows += [(300, "ο κήπος και το σπίτι των ανθρώπων", None), (301, "12 34", "el"), (302, "the people of the garden are good", "el")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    got = {r["doc_id"]: r for r in G.identify(docs, G.train_text(docs, min_rows=10, min_share=1.0), declared="lang").collect()}
    assert all(got[200 + i]["language"] == "el" and got[200 + i]["accepted"] for i in range(3))
    assert (got[300]["language"], got[300]["accepted"]) == ("und", False) and got[301]["language"] == "und"
    assert got[302]["language"] == "en" and got[0]["language"] == "en" and got[100]["language"] == "de"


def test_markup_language_is_the_lang_attribute_itself(spark):
    html = ['<html xml:lang="fr" lang="de">a</html>', '<html data-lang="fr">a</html>', "<html lang=es>a</html>"]
    pages = spark.createDataFrame([(i, "http://a.b/", h) for i, h in enumerate(html)], "page_id long, url string, html string")
    assert [r["declared"] for r in G.page_evidence(pages).orderBy("page_id").collect()] == ["de", None, "es"]
