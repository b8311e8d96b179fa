"""Language models: probabilities that sum to one, the same as a plain reading, held-out accuracy."""

from __future__ import annotations

import math
from collections import Counter

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from batchload.llm import langid
from batchload.llm.queries import QUERIES


def grams(texts):
    counts = Counter()
    for text in texts:
        codes, _ = langid.normalised([text])
        line = "".join(map(chr, codes))
        counts.update(line[i : i + langid.ORDER] for i in range(len(line) - langid.ORDER + 1))
    return pd.DataFrame({"gram": list(counts), "n": list(counts.values())})


def windows(strings):
    return np.array([[ord(c) for c in s] for s in strings], np.uint32)


TEXTS = ["banana bandana", "an abacus and a banana band", "cab", "bad cad"]


def test_normalised():
    codes, starts = langid.normalised(["Ab, 12 c!", "", "É\n\n"])
    text = "".join(map(chr, codes)).replace(langid.PAD, "_")
    assert text == "____ab c ____" + "____é "
    assert starts.tolist() == [0, 9, 13]


def test_probabilities_sum_to_one():
    model = langid.fit(grams(TEXTS))
    alphabet = sorted({c for g in grams(TEXTS)["gram"] for c in g if c != langid.PAD})
    for context in ("    ", "bana", "xban", "xyzw", "n an", " ban"):
        p = np.exp(model.score(windows([context + c for c in alphabet])))
        unseen = np.exp(model.score(windows([context + "Ω"])))[0]
        assert math.isclose(p.sum() + unseen, 1, rel_tol=1e-9), context


def test_against_plain_kneser_ney():
    counts = grams(TEXTS)
    model = langid.fit(counts)
    levels = [dict(zip(counts["gram"], counts["n"], strict=True))]
    for _ in range(langid.ORDER - 1):
        levels.insert(0, dict(Counter(g[1:] for g in levels[0])))
    alphabet = len(levels[0]) + 1

    def p(gram):
        if not gram:
            return 1 / alphabet
        level = levels[len(gram) - 1]
        n1, n2 = (sum(n == k for n in level.values()) for k in (1, 2))
        d = n1 / (n1 + 2 * n2) if n1 and n2 else 0.5
        held = {g: n for g, n in level.items() if g[:-1] == gram[:-1]}
        if not held:
            return p(gram[1:])
        total = sum(held.values())
        return max(held.get(gram, 0) - d, 0) / total + d * len(held) / total * p(gram[1:])

    strings = ["banan", " band", "xxban", "n ban", "zzzzz", "bandq", "cabad"]
    assert np.allclose(np.exp(model.score(windows(strings))), [p(s) for s in strings])


@pytest.fixture(scope="module")
def found(spark):
    return langid.train(spark.read.parquet("/root/testdata/sf0.01/documents.parquet"))


def test_held_out_accuracy(spark):
    sf_dir = "/root/testdata/sf0.1"
    said = QUERIES["op10_language_id"](spark, sf_dir).where("held_out")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "lang")
    row = said.join(docs, "doc_id").agg(
        F.avg((F.col("lang_pred") == F.col("lang")).cast("double")), F.count("*"), F.min("score"), F.max("score"),
        F.avg(F.col("rejected").cast("double")),
    ).first()
    assert row[1] > 2000 and row[0] > 0.99 and 0 <= row[2] <= row[3] <= 1 and row[4] < 0.001


def test_blocks_and_pieces_change_nothing(found, monkeypatch):
    texts = ["Et le la des " * 40, "", "the and of it is " * 90, "x", "der die und " * 7]
    sums, n = found.entropies(texts)
    monkeypatch.setattr(langid, "BLOCK", 50)
    again, m = found.entropies(texts)
    assert np.allclose(sums, again) and (n == m).all()
    one = np.stack([found.entropies([text])[0][0] for text in texts])
    assert np.allclose(sums, one)


def test_rejection(found):
    said = found.identify(["Привет мир, как дела сегодня " * 10, "qzxjk wvqxz " * 50, "12 34", None, ""])
    assert said["rejected"].all()
    assert said["lang"][2:].isna().all() and (said["score"][2:] == 0).all()


def test_odd_rows(spark, documents, odd_rows):
    docs = documents(odd_rows)
    found = langid.train(docs)
    assert found.langs == ["en"]
    rows = docs.select("doc_id", langid.identify(F.col("text"), found, spark).alias("x")).collect()
    assert len(rows) == len(odd_rows)
    by_id = {r["doc_id"]: r["x"] for r in rows}
    assert by_id[1]["lang"] == by_id[6]["lang"] == "en"
    assert all(by_id[k]["lang"] is None and by_id[k]["rejected"] for k in (3, 4, 5, 7, 8))


def test_rare_languages_and_long_documents(spark, documents):
    """Every language has a model: those of one document, and those of long documents only."""
    long = "der Hund und die Katze sind im Haus mit einer Maus " * 500
    rows = [(k, "the cat is in the house with a mouse and a dog", "en", "a") for k in range(60)]
    rows += [(100 + k, f"un chat dans la maison numero {k}", f"l{k:02}", "a") for k in range(12)]
    rows += [(200 + k, long, "de", "a") for k in range(6)]
    found = langid.train(documents(rows))
    assert found.langs == sorted({lang for _, _, lang, _ in rows})
    said = found.identify([text for _, text, _, _ in rows])
    assert said["lang"].tolist()[:60] == ["en"] * 60 and said["lang"].tolist()[-6:] == ["de"] * 6
    assert not said["rejected"].any()


def test_size_of_the_sample():
    assert (langid.TRAIN_DOCS, langid.CALIBRATE_DOCS) == (1_500, 500)


def test_without_labels(spark, documents):
    found = langid.train(documents([(1, "text", None, "a")]))
    said = found.identify(["text", None, "12"])
    assert said["rejected"].tolist() == [False, True, True] and said["lang"].isna().all()
    empty = documents([])
    assert empty.select(langid.identify(F.col("text"), langid.train(empty), spark)).count() == 0
