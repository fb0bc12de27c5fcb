"""Byte-level BPE against the tiktoken library, and its round trip."""
import hashlib
import random

import public_tokenizers
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from logscope.llm import byte_bpe as B
from logscope.llm.queries import BYTE_BPE, op12_byte_bpe

from .conftest import SF_MID

ODD = [None, "", " ", "  a  b ", "a\n\n b\t", "x\x00y", "<|endoftext|> <s>", "it's we'll I'VE", "ΣΑΣ. ﬁ 一二😀", "é ª²", "ab " * 30000, "z" * 3000,
       "՘a ₘ9 \U00011de0\U00011de1x", "a 　b", "�", "12345 678", "   "]


@pytest.fixture(scope="module")
def library():
    ranks = {t: i for i, t in enumerate(B.read_ranks(BYTE_BPE))}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


@pytest.fixture(scope="module")
def codec():
    return B.Codec(B.serialise(B.read_ranks(BYTE_BPE)), public_tokenizers.PATTERN, B._other_class(), memo_bytes=1 << 16)


def ids_of(codec, text):
    raw = codec.encode([text])[0]
    return [int.from_bytes(raw[i:i + 4], "little") for i in range(0, len(raw), 4)]


def test_bytes_map_to_distinct_printable_characters():
    chars = B.byte_characters()
    assert len(set(chars)) == 256 and not any(c.isspace() for c in chars) and chars[65] == "A"
    assert B.to_bytes(B.to_characters(bytes(range(256)))) == bytes(range(256))


def test_every_token_is_encoded_as_itself(codec):
    tokens = B.read_ranks(BYTE_BPE)
    assert codec.sp.encode([B.to_characters(t) for t in tokens]) == [[i] for i in range(len(tokens))]
    assert codec.decode(list(range(len(tokens)))) == b"".join(tokens)


def test_model_of_a_small_vocabulary_and_its_checks():
    tokens = [bytes([b]) for b in range(256)] + [b"ab", b"bc", b"abc"]
    codec = B.Codec(B.serialise(tokens), r"\w+|\W", {})
    assert ids_of(codec, "abcb bc") == [258, 98, 32, 257] and codec.decode([258, 98, 32, 257]) == b"abcb bc"
    with pytest.raises(ValueError):
        B.serialise(tokens[1:])
    with pytest.raises(IndexError):
        codec.decode([-1])
    with pytest.raises(IndexError):
        codec.decode([len(tokens)])


@settings(max_examples=300, deadline=None)
@given(st.text(max_size=60))
def test_any_text_is_encoded_as_by_the_library(codec, library, text):
    assert ids_of(codec, text) == library.encode_ordinary(text)


def test_characters_of_every_class_and_a_full_memo(codec, library):
    rng = random.Random(2)
    for _ in range(400):
        text = "".join(chr(rng.choice([rng.randrange(32, 0x3000), rng.randrange(0xE000, 0x1FFFF), 32, 39, 0x558])) for _ in range(40))
        assert ids_of(codec, text) == library.encode_ordinary(text)
    assert codec.held <= 1 << 17


def test_odd_rows_and_clashing_names(docs_of, library):
    rows = [(i, t) for i, t in enumerate(ODD)] + [(None, "null id"), (3, "again"), (3, "again")]
    docs = docs_of(rows).withColumn("ids", F.lit("x")).withColumn("decoded", F.lit(1)).withColumn("n_tokens", F.lit(9))
    got = B.encode_decode(docs, BYTE_BPE, public_tokenizers.PATTERN).collect()
    assert len(got) == len(rows)
    for r in got:
        text = r["text"] or ""
        assert r["ids"] == library.encode_ordinary(text) and bytes(r["decoded"]) == text.encode() and r["n_tokens"] == 9
    assert B.encode_decode(docs.limit(0), BYTE_BPE, public_tokenizers.PATTERN).collect() == []


def test_null_identifiers_decode_to_null(spark):
    bpe = B.ByteBpe(spark, BYTE_BPE, public_tokenizers.PATTERN)
    rows = spark.createDataFrame([([72, 0],), (None,), ([],)], "i array<int>").select(bpe.decode("i").alias("d")).collect()
    assert [r["d"] and bytes(r["d"]) for r in rows] == [bytes([*B.read_ranks(BYTE_BPE)[72], *B.read_ranks(BYTE_BPE)[0]]), None, b""] or rows[2]["d"] == b""


def test_whole_table_equals_the_library(spark, library):
    sha = lambda b: hashlib.sha256(b).hexdigest()
    text = {r["doc_id"]: r["text"] or "" for r in spark.read.parquet(f"{SF_MID}/documents.parquet").collect()}
    want = {}
    for k, t in text.items():
        ids = library.encode_ordinary(t)
        want[k] = (len(ids), sha(" ".join(map(str, ids)).encode()), sha(t.encode()))
    got = op12_byte_bpe(spark, SF_MID)
    assert dict(got.dtypes) == {"doc_id": "bigint", "n_tokens": "bigint", "ids_sha256": "string", "decoded_sha256": "string"}
    assert {r[0]: tuple(r)[1:] for r in got.collect()} == want
