"""Byte-level BPE against the library that the rank file is made for, and back to the bytes."""

from __future__ import annotations

import hashlib

import numpy as np
import public_tokenizers
import pytest
import regex
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st

from batchload.llm import bpe
from batchload.llm.queries import QUERIES

PATH = public_tokenizers.path("byte_bpe_50k.tiktoken")
PIECES = st.one_of(
    st.text(max_size=20),
    st.sampled_from(["the ", " the", "aaaa", "====", "\n\n", "  ", "<|endoftext|>", "don't", "1234", "🙂", "é"]),
)


@pytest.fixture(scope="module")
def ranks():
    with open(PATH, "rb") as file:
        return bpe.Ranks(file.read())


@pytest.fixture(scope="module")
def reference(ranks):
    return tiktoken.Encoding(
        "own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks.ranks, special_tokens={}
    )


def encoded(ranks, texts):
    words, cut = bpe._Words(ranks), regex.compile(public_tokenizers.PATTERN).findall
    return words.ids([words.numbered(cut(text)) for text in texts]).to_pylist()


def test_blocks_of_texts(ranks, reference):
    @settings(max_examples=80, deadline=None)
    @given(st.lists(st.lists(PIECES, max_size=8).map("".join), max_size=6))
    def check(texts):
        ids = encoded(ranks, texts)
        assert ids == [reference.encode_ordinary(text) for text in texts]
        for text, found in zip(texts, ids, strict=True):
            assert ranks.decode(np.array(found, np.int32)).tobytes() == text.encode()

    check()


def test_runs_and_rare_orders(ranks, reference):
    texts = [c * n for c in "a=- " for n in (1, 2, 3, 5, 17, 64, 999)]
    texts += ["ab" * 5000, "thethethe" * 300]
    assert encoded(ranks, texts) == [reference.encode_ordinary(text) for text in texts]


def test_a_word_by_itself(ranks, reference):
    for word in ("the", " antidisestablishmentarianism", "zzzzzz"):
        assert ranks.encode_word(word.encode()) == reference.encode_ordinary(word)


def test_late_merges_of_lower_rank():
    # "xy" (rank 257) comes up after "yz" has made a token of rank 256 that "x" joins to at 255 or so:
    # words in which that happens are encoded by themselves.
    import base64

    tokens = [bytes([b]) for b in range(256)]
    extra = [b"abc", b"bc", b"ab"]  # "a" + "bc" joins to a token of lower rank than "bc"
    lines = b"\n".join(base64.b64encode(t) + b" %d" % i for i, t in enumerate(tokens + extra))
    small = bpe.Ranks(lines)
    words = [b"abc", b"abcbcabc", b"bcbcab", b"cbcbabcab"]
    ids, starts = small.encode_words(words)
    for k, word in enumerate(words):
        assert ids[starts[k] : starts[k + 1]].tolist() == small.encode_word(word)


def test_odd_rows(spark, documents, odd_rows, reference):
    docs = documents(odd_rows)
    rows = bpe.decode(bpe.encode(docs, PATH, public_tokenizers.PATTERN), PATH).collect()
    assert len(rows) == len(odd_rows)
    texts = {row[0]: row[1] or "" for row in odd_rows if row[0] is not None}
    for row in rows:
        if row["doc_id"] is not None:
            assert row["ids"] == reference.encode_ordinary(texts[row["doc_id"]])
            assert bytes(row["decoded"]).decode() == texts[row["doc_id"]]


def test_one_pass_or_two(spark, documents, odd_rows):
    docs = documents(odd_rows[:-2])
    once = bpe.round_trip(docs, PATH, public_tokenizers.PATTERN).collect()
    twice = bpe.decode(bpe.encode(docs, PATH, public_tokenizers.PATTERN), PATH).collect()
    assert once == twice
    some = bpe.encode(docs, PATH, public_tokenizers.PATTERN).selectExpr("doc_id", "nullif(ids, ids) AS ids")
    assert all(r["decoded"] is None for r in bpe.decode(some, PATH).collect())


def test_empty_table(spark, documents):
    none = documents([])
    assert bpe.decode(bpe.encode(none, PATH, public_tokenizers.PATTERN), PATH).count() == 0


def test_query(spark, reference):
    sf_dir = "/root/testdata/sf0.001"
    texts = dict(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect())
    for row in QUERIES["op4_byte_bpe"](spark, sf_dir).collect():
        ids = reference.encode_ordinary(texts[row["doc_id"]])
        assert row["n_tokens"] == len(ids)
        assert row["ids_sha256"] == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert row["decoded_sha256"] == hashlib.sha256(texts[row["doc_id"]].encode()).hexdigest()
