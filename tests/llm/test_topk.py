"""Top-k against a plain sort, and against the same query in SQL."""

from __future__ import annotations

from collections import Counter

import duckdb
import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from batchload.llm import topk
from batchload.llm.queries import ORACLES, QUERIES
from batchload.llm.topk import Slices, narrowed, top_k


@settings(max_examples=60, deadline=None)
@given(st.integers(1, 200), st.integers(1, 6), st.integers(1, 12), st.integers(0, 2**31), st.sampled_from([1, 3, 100]))
def test_block(n, dims, k, seed, spread):
    rng = np.random.default_rng(seed)
    ids = rng.permutation(n * 2)[:n]
    values = rng.integers(-spread, spread + 1, (n, dims))
    block = Slices.read(*Slices.of(ids, values).written(), dims)
    for own in (int(ids[0]), -1):
        weights = rng.integers(-spread, spread + 1, dims)
        got, scores = block.top(weights.tolist(), k, own)
        all_scores = dict(zip(ids.tolist(), (values @ weights).tolist(), strict=True))
        all_scores.pop(own, None)
        expected = sorted(all_scores.items(), key=lambda x: (-x[1], x[0]))[:k]
        assert sorted(zip(got.tolist(), scores, strict=True)) == sorted(expected)


def _vectors(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>, ids string, dims string, part string")


def test_odd_rows(spark):
    x = ("x", "x", "x")
    rows = [
        (0, [1.0, 0.5], *x), (1, [1.0, 0.5], *x), (2, [1.0, 0.5], *x), (3, None, *x), (4, [None, 1.0], *x),
        (5, [float("nan"), 1.0], *x), (6, [float("inf"), 1.0], *x), (None, [9.0, 9.0], *x), (7, [-1.0, 0.0], *x),
        (7, [-1.0, 0.0], *x), (8, [1.0, 2.0, 3.0], *x), (20, [0.5, 0.5], *x), (20, [0.5, 0.5], *x), (40, None, *x),
        (60, [], *x),
    ]
    vectors = _vectors(spark, rows)
    got = top_k(vectors, vectors.where("vec_id % 20 = 0"), 3).collect()
    by_query = {}
    for r in sorted(got, key=lambda r: (r["query_id"], r["rank"])):
        by_query.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    assert by_query == {
        0: [(1, 1, 5120), (2, 2, 5120), (3, 20, 3072)],
        20: [(1, 0, 3072), (2, 1, 3072), (3, 2, 3072)],
    }


def test_empty_table(spark):
    empty = _vectors(spark, [])
    assert top_k(empty, empty).count() == 0


def test_oracle(spark):
    sf_dir = "/root/testdata/sf0.001"
    c = duckdb.connect()
    c.execute(f"CREATE VIEW embeddings AS SELECT * FROM read_parquet('{sf_dir}/embeddings.parquet')")
    got = QUERIES["op2_top_k"](spark, sf_dir)
    expected = c.execute(ORACLES["op2_top_k"])
    names = [d[0] for d in expected.description]
    assert Counter(map(tuple, got.select(names).collect())) == Counter(expected.fetchall())


def test_many_blocks_and_lanes(spark, monkeypatch):
    """Blocks of a few rows, several lanes, lengths that only one side has, wide and narrow numbers."""
    monkeypatch.setattr(topk, "BLOCK_CELLS", 64)
    monkeypatch.setattr(topk, "QUERY_CELLS", 16)
    monkeypatch.setattr(topk, "LANE_BLOCKS", 2)
    rng = np.random.default_rng(5)
    rows = [(i, (rng.normal(size=4) * (1 if i % 3 else 10_000)).tolist(), "x", "x", "x") for i in range(150)]
    rows += [(1000 + i, [1.0, 2.0, 3.0, 4.0, 5.0], "x", "x", "x") for i in range(3)]
    asked = _vectors(spark, rows[::5][:30] + [(9, [1.0] * 7, "x", "x", "x")])
    got = {}
    for r in top_k(_vectors(spark, rows), asked, 7).orderBy("query_id", "rank").collect():
        got.setdefault(r["query_id"], []).append((r["vec_id"], r["score"]))
    whole = {i: np.floor(np.float32(v).astype(float) * 64).astype(int) for i, v, *_ in rows if len(v) == 4}
    assert got == {
        q: sorted(((i, int(v @ whole[q])) for i, v in whole.items() if i != q), key=lambda x: (-x[1], x[0]))[:7]
        for q in list(whole)[::5]
    }


@pytest.mark.parametrize("values,size", [([], 1), ([-128, 127], 1), ([128], 2), ([-(2**31)], 4), ([2**31], 8)])
def test_narrowed(values, size):
    values = np.array(values, np.int64)
    assert narrowed(values).itemsize == size and narrowed(values).tolist() == values.tolist()
