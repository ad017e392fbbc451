"""BPE against the tokenizers library: ids, decoded texts, and the registered query."""

import hashlib
import struct

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

tokenizers = pytest.importorskip("tokenizers")

from odd_tables import docs_of  # noqa: E402,F401
from vigil.llm.bpe import PairIndexCodec, bpe_decode, bpe_encode, codec, op1_bpe, tokenizer_path  # noqa: E402

HARD = ["", " ", "a<|endoftext|>b <|startoftext|><|startoftext|>", "İstanbul ΣΑΣ ς x\x1cy\x85z é ́a", "漢字テスト 👩‍👩‍👧", "aaaa aaaaaaaa",
        "'S it'LL 12345 ½ ﻿ ​<|endoftext", "ẛ̣ ﬁ K Å <|EndOfText|>", "x" * 30_000, "ab" * 3000 + " the", "\x00 \x01", "A.B a.b"]


@pytest.fixture(scope="module")
def library():
    return tokenizers.Tokenizer.from_file(tokenizer_path())


@pytest.fixture(scope="module")
def own():
    return PairIndexCodec(tokenizer_path())


def ids_of(raw):
    return list(struct.unpack(f"<{len(raw) // 4}I", raw))


def test_hard_texts(library, own):
    coded = own.encode_block([t.encode() for t in HARD] + [None])
    for text, raw in zip(HARD, coded, strict=False):
        want = library.encode(text, add_special_tokens=False).ids
        assert ids_of(raw) == want
        assert own.decode(raw) == library.decode(want, skip_special_tokens=False)
    assert coded[-1] == b"" and own.decode(b"") == ""


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(alphabet=st.one_of(st.characters(codec="utf-8"), st.sampled_from("abthe <|>endoftxsr'.,\n0")), max_size=40), max_size=4))
def test_random_texts(library, own, texts):
    for text, raw in zip(texts, own.encode_block([t.encode() for t in texts]), strict=True):
        assert ids_of(raw) == library.encode(text, add_special_tokens=False).ids


def test_word_table_can_be_full(library, monkeypatch):
    monkeypatch.setattr("vigil.llm.bpe.KEPT_WORDS", 3)
    monkeypatch.setattr("vigil.llm.bpe.INDEX_WORDS", 2)
    own = PairIndexCodec(tokenizer_path())
    for text in ("one two three four five", "five six one", "one one seven eight nine ten"):
        assert ids_of(own.encode_block([text.encode()])[0]) == library.encode(text, add_special_tokens=False).ids


def test_ids_without_a_token(own):
    assert own.decode(struct.pack("<2I", 0, 1 << 30)) == own.decode(struct.pack("<I", 0))


def test_query_equals_the_library(spark, library):
    got = {r.doc_id: r for r in op1_bpe(spark, "/root/testdata/sf0.001").collect()}
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()
    assert len(got) == len(docs)
    for d in docs:
        want = library.encode(d.text or "", add_special_tokens=False).ids
        r = got[d.doc_id]
        assert (r.n_tokens, r.ids_sha256) == (len(want), hashlib.sha256(struct.pack(f"<{len(want)}I", *want)).hexdigest())
        assert r.decoded_sha256 == hashlib.sha256(library.decode(want, skip_special_tokens=False).encode()).hexdigest()


def test_odd_tables(spark, docs_of):
    rows = [(1, None), (1, "same"), (1, "same"), (None, "no id"), (2, "")]
    out = bpe_decode(bpe_encode(docs_of(rows, extra=True), tokenizer_path()), tokenizer_path()).collect()
    assert sorted((r.doc_id or -1, r.n_tokens, r.decoded) for r in out) == sorted(
        [(1, 0, ""), (1, 1, "same</w>"), (1, 1, "same</w>"), (-1, 2, "no</w> id</w>"), (2, 0, "")])
    assert bpe_encode(docs_of(rows).limit(0), tokenizer_path()).count() == 0
    assert codec(tokenizer_path()) is codec(tokenizer_path())
