"""The stages of the pipeline against what each operator says of its own input."""

from __future__ import annotations

import hashlib

import public_tokenizers
import pytest
import tiktoken

import corpus_pipeline
from batchload.llm import bpe, secrets
from batchload.llm.common import components, stored
from batchload.llm.jaccard import similar_documents

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def passed(spark):
    """The documents before each stage, and what the last one returns."""
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    secret = spark.createDataFrame(
        [(900_001, "Nothing but a token: s3cr3t-value-0001 in here", "en", "src0", 46),
         (900_002, "Съешь же ещё этих мягких французских булок да выпей чаю", None, "src1", 55),
         (900_003, None, None, None, None)],
        docs.schema,
    )
    tables = [stored(docs.unionByName(secret))]
    for _, stage in corpus_pipeline.STAGES:
        tables.append(stored(stage(spark, tables[-1], SF_DIR)))
    return tables


def test_columns(passed):
    for table in passed[:-1]:
        assert table.columns == ["doc_id", "text", "lang", "source", "n_chars"]


def test_language_stage(passed):
    before = {r["doc_id"]: r for r in passed[0].collect()}
    after = {r["doc_id"]: r for r in passed[1].collect()}
    assert before.keys() - after.keys() == {900_002, 900_003}
    assert all(after[i] == before[i] for i in after)


def test_one_of_each_group_stays(passed):
    groups = {r["doc_id"]: r["component_id"] for r in similar_documents(passed[1]).collect()}
    assert sorted(r["doc_id"] for r in passed[2].collect()) == sorted(set(groups.values()))


def test_secrets_are_gone(spark, passed):
    models = secrets.train(passed[2])
    before = {r["doc_id"]: r["text"] for r in passed[2].collect()}
    for r in passed[3].collect():
        spans = secrets.spans_of(before[r["doc_id"]], models)
        assert (r["text"] == before[r["doc_id"]]) == (not spans)
        assert r["text"].count("[SECRET]") <= len(spans) and r["n_chars"] == len(r["text"])
        assert not secrets.base_spans(r["text"])
    assert passed[3].count() == passed[2].count()
    (planted,) = passed[3].where("doc_id = 900001").collect()
    assert planted["text"] == "Nothing but a [SECRET] in here"


def test_mix(passed):
    before = {r["doc_id"]: r for r in passed[3].collect()}
    times = {}
    for r in passed[4].collect():
        assert r == before[r["doc_id"]]
        times[r["doc_id"]] = times.get(r["doc_id"], 0) + 1
    assert max(times.values()) <= 2
    words = {i: len(r["text"].split()) for i, r in before.items()}
    taken = sum(words[i] * n for i, n in times.items())
    assert abs(taken - 1.5 * sum(words.values())) < 0.02 * taken


def test_tokens(passed):
    with open(public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb") as file:
        ranks = bpe.Ranks(file.read())
    reference = tiktoken.Encoding(
        "own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks.ranks, special_tokens={}
    )
    texts = {r["doc_id"]: r["text"] for r in passed[4].collect()}
    for r in passed[5].collect():
        assert r["ids"] == reference.encode_ordinary(texts[r["doc_id"]])
        assert r["n_tokens"] == len(r["ids"])
        assert r["decoded_sha256"] == hashlib.sha256(texts[r["doc_id"]].encode()).hexdigest()


def test_odd_rows(spark, documents, odd_rows):
    """Every stage alone, on nulls, repeated rows and clashing names; and on an empty table."""
    odd, empty = documents(odd_rows), documents([])
    for number, (_, stage) in enumerate(corpus_pipeline.STAGES):
        got = stage(spark, odd, SF_DIR)
        rows = got.collect()
        if number < 4:
            assert got.columns == odd.columns
        if number == 1:
            # 2 and 6 have the shingles of 1; of rows without an id all stay.
            ids = sorted((r["doc_id"] for r in rows if r["doc_id"] is not None))
            assert ids == [1, 3, 4, 5, 7, 8] and sum(r["doc_id"] is None for r in rows) == 2
        if number in (2, 4):
            assert len(rows) == len(odd_rows)
        assert stage(spark, empty, SF_DIR).count() == 0


def test_equal_rows_are_one_and_no_text_is_lost(spark, documents):
    docs = documents([(1, "a b c d e f", "en", "a"), (1, "a b c d e f", "en", "a"), (1, "other", "en", "a")])
    rows = corpus_pipeline.near_duplicates(spark, docs, SF_DIR).collect()
    assert sorted(row["text"] for row in rows) == ["a b c d e f", "other"]


def test_texts_of_one_id_go_only_with_a_similar_one(spark, documents):
    """Every text that is not similar to one that stays is there, whatever ids it shares."""
    texts = {name: " ".join(f"{name}{k}" for k in range(60)) for name in "ABCD"}
    near = {name: text + " more" for name, text in texts.items()}
    rows = [(5, "A"), (3, "A"), (5, "B"), (1, "B"), (9, "C"), (9, "D"), (9, "D")]
    docs = [(i, texts[name], "en", "a") for i, name in rows]
    docs += [(7, near["C"], "en", "a"), (2, near["D"], "en", "a"), (8, None, "en", "a"), (8, "", "en", "a")]
    got = corpus_pipeline.near_duplicates(spark, documents(docs), SF_DIR).collect()
    kept = {(row["doc_id"], row["text"]) for row in got}
    assert len(kept) == len(got)
    assert kept == {(3, texts["A"]), (1, texts["B"]), (7, near["C"]), (2, near["D"]), (8, None), (8, "")}


def test_near_copies_by_five_words_and_eighty_hundredths(spark, documents):
    """Copies that four words and 85 hundredths tell apart: two words replaced, 20 appended."""
    one, two = ([f"{name}{k}" for k in range(100)] for name in "ab")
    replaced = [f"new{k}" if k in (30, 60) else word for k, word in enumerate(one)]
    appended = two + [f"more{k}" for k in range(20)]
    apart = two[:70] + [f"other{k}" for k in range(30)]
    docs = documents([
        (k, " ".join(words), "en", "a") for k, words in enumerate([one, replaced, two, appended, apart])
    ])
    kept = corpus_pipeline.near_duplicates(spark, docs, SF_DIR).collect()
    assert sorted(r["doc_id"] for r in kept) == [0, 2, 4]


def test_components_of_chains(spark):
    edges = [(k, k + 1) for k in range(300)] + [(1000, 1001), (5000, 2000), (7, 7)]
    got = {r["node"]: r["component"] for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert all(got[k] == 0 for k in range(301)) and got[1001] == 1000 and got[5000] == 2000
