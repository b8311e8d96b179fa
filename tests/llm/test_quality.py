"""The random field: inference against enumeration, and held-out accuracy."""

from __future__ import annotations

import pytest

import itertools

import numpy as np
from pyspark.sql import functions as F

from batchload.llm import quality
from batchload.llm.queries import QUERIES


def test_forward_backward_against_enumeration():
    rng = np.random.default_rng(0)
    n = np.array([4, 1, 3])
    emit, moves = rng.normal(size=(3, 4)), rng.normal(size=(2, 2))
    log_z, good, pairs = quality.forward_backward(emit, n, moves)
    expected_pairs = np.zeros((2, 2))
    for c, length in enumerate(n):
        weights = {}
        for path in itertools.product((0, 1), repeat=int(length)):
            score = sum(emit[c, t] for t in range(length) if path[t])
            weights[path] = np.exp(score + sum(moves[a, b] for a, b in itertools.pairwise(path)))
        z = sum(weights.values())
        assert np.isclose(log_z[c], np.log(z))
        for t in range(length):
            assert np.isclose(good[c, t], sum(w for p, w in weights.items() if p[t]) / z)
        for p, w in weights.items():
            for a, b in itertools.pairwise(p):
                expected_pairs[a, b] += w / z
        assert (good[c, length:] == 0).all()
    assert np.allclose(pairs, expected_pairs)


def test_measures():
    rows, lengths = quality.measures("Ha ha ha ha.\n\nABC %%% 12")
    assert rows.shape == (3, len(quality.MEASURES)) and lengths.tolist() == [12, 0, 10]
    named = dict(zip(quality.MEASURES, rows[0], strict=True))
    assert np.isclose(named["repeated"], 1 / 4) and np.isclose(named["distinct"], 3 / 4)
    assert np.isfinite(quality.measures(" \x00 \ud800")[0]).all()


def test_held_out_accuracy(spark):
    sf_dir = "/root/testdata/sf0.1"
    scored = QUERIES["op9_quality"](spark, sf_dir).where("held_out")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").where("quality IS NOT NULL")
    hits = scored.join(labels, "doc_id").select((F.col("predicted") == F.col("quality")).alias("ok"), "score")
    row = hits.agg(F.avg(F.col("ok").cast("double")), F.count("*"), F.min("score"), F.max("score")).first()
    assert row[1] > 500 and row[0] > 0.98 and 0 <= row[2] <= row[3] <= 1


def test_odd_rows(spark, documents, odd_rows):
    docs = documents(odd_rows)
    labels = spark.createDataFrame(
        [(1, 1), (2, 1), (7, 0), (7, 0), (8, 0), (3, None), (None, 1), (4, 0), (99, 1)], "doc_id long, quality int"
    )
    chain = quality.train(docs, labels)
    rows = docs.select("doc_id", quality.score(F.col("text"), chain).alias("s")).collect()
    assert len(rows) == len(odd_rows) and all(0 <= r["s"] <= 1 for r in rows)
    by_id = {r["doc_id"]: r["s"] for r in rows}
    assert by_id[3] == by_id[4] and by_id[1] > 0.5 > by_id[8]


def test_without_labels(spark, documents, odd_rows):
    chain = quality.train(documents(odd_rows), spark.createDataFrame([], "doc_id long, quality int"))
    assert chain.score("any text") == 0.5 == chain.score(None)
    assert documents([]).select(quality.score(F.col("text"), chain)).count() == 0


def long_documents(lines):
    """Sixty labelled documents of so many lines, half of them prose and half spam."""
    good = "The old house stands near the river, and its garden is full of apple trees.\n"
    bad = "BUY $$$ now!!! 100% FREE *** click >>> 555 $$$ win win win\n"
    docs = [(k, (good if k % 2 else bad) * lines) for k in range(60)]
    return docs, [(k, k % 2) for k in range(60)]


@pytest.mark.parametrize("lines", [5, 250, 3000])
def test_documents_of_any_length_train(spark, lines):
    docs, labels = long_documents(lines)
    table = spark.createDataFrame(docs, "doc_id long, text string")
    chain = quality.train(table, spark.createDataFrame(labels, "doc_id long, quality int"))
    scores = {r.doc_id: r.s for r in table.select("doc_id", quality.score(table.text, chain).alias("s")).collect()}
    assert all(s > 0.9 if k % 2 else s < 0.1 for k, s in scores.items())


def test_lines_are_bounded_over_whole_texts(spark, monkeypatch):
    """Where lines are too many, stretches are chosen from all over the texts."""
    docs, labels = long_documents(1000)
    seen = []
    monkeypatch.setattr(quality, "TRAIN_LINES", 12_000)
    monkeypatch.setattr(quality, "fit", lambda chains, labels: seen.append((chains, labels)))
    quality.train(
        spark.createDataFrame(docs, "doc_id long, text string"),
        spark.createDataFrame(labels, "doc_id long, quality int"),
    )
    chains, marks = seen[0]
    assert 6_000 < sum(map(len, chains)) < 18_000 and 0.25 < marks.mean() < 0.75
    assert any(chain[0, -2] == 1 for chain in chains) and any(chain[0, -2] == 0 for chain in chains)
