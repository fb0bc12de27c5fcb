"""Best-fit packing and token counts against their libraries."""
import random
import zlib

import numpy as np
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from logscope.llm.packing import BestFit, pack, pack_documents, word_tokenizer
from logscope.llm.queries import PIECE_BPE, WORD_BPE, op1_best_fit_packing, op9_token_counts
from logscope.llm.token_counts import PieceCounter, count_tokens, merge_count

from .conftest import SF_MID

ODD = [None, "", " ", "  a  b ", "a\n\nb", "\t", "x\x00y", "<s> </s> <0x41>", "<|endoftext|>.", "A<|startoftext|>b", "ΣΑΣ. ﬁ 一二😀",
       "İ. é é. ª²x.", "don't!! IT'S", "a　b", "ÄÖ!! ß.", "▁x ▁", "!!! ###$$$", "z" * 5000, "word " * 30000]


def test_counts_equal_the_library(docs_of):
    sp = sentencepiece.SentencePieceProcessor(model_file=PIECE_BPE)
    rows = [(i, t) for i, t in enumerate(ODD)] + [(None, "null id"), (3, "again"), (3, "again")]
    got = count_tokens(docs_of(rows), PIECE_BPE, limit=100).collect()
    assert len(got) == len(rows)
    for r in got:
        n = len(sp.encode(r["text"] or ""))
        assert (r["n_tokens"], r["n_bytes"], r["over_limit"]) == (n, len((r["text"] or "").encode()), n > 100)


def test_whole_table_equals_the_library(spark):
    sp = sentencepiece.SentencePieceProcessor(model_file=PIECE_BPE)
    text = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SF_MID}/documents.parquet").collect()}
    want = dict(zip(text, map(len, sp.encode(list(text.values())))))
    assert {r["doc_id"]: r["n_tokens"] for r in op9_token_counts(spark, SF_MID).collect()} == want


@settings(max_examples=150, deadline=None)
@given(st.text(alphabet="ab t\n.é一▁<s>", max_size=40))
def test_any_text_counts_as_the_library(text):
    counter = test_any_text_counts_as_the_library.__dict__.setdefault("c", PieceCounter(PIECE_BPE))
    sp = test_any_text_counts_as_the_library.__dict__.setdefault("s", sentencepiece.SentencePieceProcessor(model_file=PIECE_BPE))
    assert counter.count(text) == len(sp.encode(text))


def test_merge_order_is_rank_then_leftmost():
    assert merge_count("aaa", {"a": 9, "aa": 1}) == 2
    assert merge_count("abc", {"a": 9, "b": 9, "c": 9, "bc": 1, "ab": 2, "abc": 3}) == 1
    assert merge_count("é", {}) == 2        # bytes of an unknown character


def test_piece_model_only():
    from logscope.llm.token_counts import token_count
    with pytest.raises(ValueError):
        token_count("text", "x.json")


def test_word_ids_equal_the_library():
    tok, ids = Tokenizer.from_file(WORD_BPE), word_tokenizer(WORD_BPE)
    for t in ODD:
        assert ids(t or "") == np.array(tok.encode(t or "", add_special_tokens=False).ids, "<u4").tobytes(), t


def check_bins(rows, capacity):
    by = {}
    for r in rows:
        by.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for b in by.values():
        end = 0
        for offset, length in sorted(b):
            assert offset == end
            end += length
        assert end <= capacity
    return len(by)


def test_packing_whole_table(spark):
    tok = Tokenizer.from_file(WORD_BPE)
    rows = op1_best_fit_packing(spark, SF_MID).collect()
    n = check_bins(rows, 2048)
    pieces = {}
    for r in rows:
        pieces.setdefault(r["doc_id"], []).append(r)
    for d in spark.read.parquet(f"{SF_MID}/documents.parquet").collect():
        ids = tok.encode(d["text"], add_special_tokens=False).ids + [0]
        got = sorted(pieces.pop(d["doc_id"]), key=lambda r: r["piece"])
        want = [ids[a:a + 2048] for a in range(0, len(ids), 2048)]
        assert [(r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in got] == [
            (i, i * 2048, len(p), zlib.crc32(np.array(p, "<u4").tobytes())) for i, p in enumerate(want)]
    assert not pieces
    assert n <= 1.05 * sum(r["length"] for r in rows) / 2048 + 1


def test_best_fit_takes_the_fullest_bin_that_fits_and_closes_the_fullest():
    p = BestFit(10, 2)
    assert [p.put(x) for x in (6, 7, 3, 4)] == [(0, 0), (1, 0), (1, 7), (0, 6)]
    p = BestFit(10, 2)
    assert [p.put(x) for x in (6, 7, 8)] == [(0, 0), (1, 0), (2, 0)]        # bin 1 (3 free) closes
    assert p.put(3) == (0, 6)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 50), max_size=200), st.integers(1, 8))
def test_best_fit_equals_brute_force(lengths, limit):
    p, bins, open_ = BestFit(50, limit), [], []
    for x in lengths:
        fit = [b for b in open_ if 50 - bins[b] >= x]
        if fit:
            least = min(50 - bins[b] for b in fit)
            b, offset = p.put(x)
            assert b in fit and 50 - bins[b] == least and offset == bins[b]
        else:
            if len(open_) >= limit:
                fullest = max(bins[b] for b in open_)
                closed = [b for b in open_ if bins[b] == fullest]
                b, offset = p.put(x)
                gone = [c for c in closed if c not in [y for f in p.by_free.values() for y in f]]
                open_.remove(gone[0])
            else:
                b, offset = p.put(x)
            assert offset == 0 and b == len(bins)
            bins.append(0)
            open_.append(b)
        bins[b] += x
        if bins[b] == 50:
            open_.remove(b)


def test_packing_odd_rows(docs_of):
    rows = [(i, t) for i, t in enumerate(ODD)] + [(None, "null id"), (3, "again"), (3, "again")]
    got = pack_documents(docs_of(rows), WORD_BPE).collect()
    check_bins(got, 2048)
    assert {r["length"] for r in got if r["doc_id"] in (0, 1, 2)} == {1}
    assert sum(r["doc_id"] == 3 for r in got) == 3 and sum(r["doc_id"] is None for r in got) == 1
    assert pack_documents(docs_of([]), WORD_BPE).count() == 0


def test_packing_over_several_tasks(spark):
    random.seed(0)
    items = spark.createDataFrame([(i, random.randint(1, 100)) for i in range(3000)], "id long, length long")
    rows = pack(items, "length", 100, open_bins=16, per_task=500).collect()
    assert sorted(r["id"] for r in rows) == list(range(3000))
    assert check_bins(rows, 100) <= 1.15 * sum(r["length"] for r in rows) / 100


def test_the_memo_keeps_the_words_of_a_task():
    made = []
    counter = PieceCounter(PIECE_BPE)
    counter.words.make = lambda word: made.append(word) or 1
    text = " ".join(f"w{i:x}" for i in range(200_000))
    assert counter.count(text) == counter.count(text) == 200_000
    assert len(made) == 200_000         # a smaller memo makes most of them twice


def test_the_pipeline_packs_with_a_smaller_memo_and_the_same_ids(monkeypatch):
    import corpus_pipeline
    import pyarrow as pa

    from logscope.llm import packing
    from logscope.llm.common import each_raw, raw
    from logscope.llm.queries import WORD_BPE

    seen = {}
    monkeypatch.setattr(corpus_pipeline, "pack_documents", lambda docs, path, **how: seen.update(how))
    corpus_pipeline.pack(None, None, "")
    assert seen["memo_bytes"] == corpus_pipeline.PACK_MEMO_BYTES < packing.MEMO_BYTES
    text = " ".join(f"Word{i % 700} x{i}." for i in range(3000))
    assert packing.word_tokenizer(WORD_BPE, 1 << 14)(text) == packing.word_tokenizer(WORD_BPE)(text)
    arr = pa.array(["é", None, "", *map(str, range(600))])
    assert list(each_raw(arr)) == raw(arr)
