"""Near-duplicate vectors against all pairs."""

from __future__ import annotations

import numpy as np
import pytest

from batchload.llm import neardup
from batchload.llm.neardup import fit, near_duplicates, units

SCHEMA = "vec_id long, embedding array<double>, label int, id string, n string, bucket string"


def brute(ids, vectors, labels, threshold=0.93):
    data = units(vectors)
    linked = (data @ data.T >= threshold) & (labels[:, None] == labels[None, :])
    np.fill_diagonal(linked, False)
    component = ids.copy()
    while True:
        low = np.minimum(component, np.where(linked, component[None, :], ids.max()).min(axis=1))
        if (low == component).all():
            return linked.sum(axis=1), component
        component = low


def made(rng, n, dims):
    """Vectors at random, with groups of copies and of neighbours on either side of the threshold."""
    rows = [rng.normal(size=dims) for _ in range(n)]
    for group in range(30):
        for _ in range(rng.integers(1, 12)):
            noise = rng.normal(size=dims) * rng.choice([0.0, 0.1, 0.3, 0.38, 0.45])
            rows.append(rows[group] * rng.choice([1.0, 3.0]) + noise)
    return np.array(rows)


@pytest.mark.parametrize("block_rows,number", [(neardup.BLOCK_ROWS, "double"), (40, "double"), (40, "float")])
def test_all_pairs(spark, monkeypatch, block_rows, number):
    monkeypatch.setattr(neardup, "BLOCK_ROWS", block_rows)
    monkeypatch.setattr(neardup, "LANE_BLOCKS", 2)
    rng = np.random.default_rng(3)
    vectors = made(rng, 400, 16).astype(np.float32 if number == "float" else np.float64)
    ids, labels = rng.permutation(len(vectors)), rng.integers(0, 3, len(vectors))
    rows = [
        (int(i), v.tolist(), int(x), "x", "x", "x") for i, v, x in zip(ids, vectors, labels, strict=True)
    ]
    table = spark.createDataFrame(rows, SCHEMA.replace("array<double>", f"array<{number}>"))
    got = near_duplicates(table).toPandas().set_index("vec_id").loc[ids]
    links, component = brute(ids, vectors, labels)
    assert (got["n_links"].to_numpy() <= links).all()
    assert got["n_links"].sum() >= 0.98 * links.sum() > 0
    assert (got["component_id"].to_numpy() == component).mean() > 0.98
    assert (got["kept"] == (got.index == got["component_id"])).all()


def test_recall_of_the_grid():
    rng = np.random.default_rng(4)
    sample = units(rng.normal(size=(3000, 32)))
    grid = fit(sample, 16, 0.93, 0.995)
    away = rng.normal(size=sample.shape)
    away -= (away * sample).sum(axis=1)[:, None] * sample
    partners = 0.93 * sample + np.sqrt(1 - 0.93**2) * units(away)
    there, back = grid.ranked(sample, grid.visits), grid.ranked(partners, grid.visits)
    found = (there == back[:, :1]).any(axis=1) | (back == there[:, :1]).any(axis=1)
    assert found.mean() >= 0.985
    assert grid.visits < 16 * 16 / 4


def test_multi_sequence_order():
    rng = np.random.default_rng(5)
    grid = fit(units(rng.normal(size=(500, 8))), 6, 0.93, 0.9)
    rows = units(rng.normal(size=(50, 8)))
    one = neardup.distances(rows[:, :4], grid.first)
    two = neardup.distances(rows[:, 4:], grid.second)
    sums = (one[:, :, None] + two[:, None, :]).reshape(50, -1)
    expected = np.sort(sums, axis=1)[:, :10]
    got = np.take_along_axis(sums, grid.ranked(rows, 10).astype(int), axis=1)
    assert np.allclose(got, expected)


def test_odd_rows(spark):
    x = ("x", "x", "x")
    rows = [
        (1, [1.0, 0.0], 1, *x), (2, [2.0, 0.0], 1, *x), (2, [2.0, 0.0], 1, *x), (3, [1.0, 0.0], 2, *x),
        (4, None, 1, *x), (5, [0.0, 0.0], 1, *x), (6, [float("nan"), 1.0], 1, *x), (7, [None, 1.0], 1, *x),
        (8, [1.0, 0.0], None, *x), (None, [1.0, 0.0], 1, *x), (9, [1e300, 1e299], 1, *x),
        (10, [1e-300, 0.0], 1, *x), (11, [1.0, 0.0, 0.0], 1, *x), (12, [], 1, *x), (13, [5.0], 1, *x),
        (14, [-1.0, 0.0], 1, *x),
    ]
    got = sorted(
        tuple(r) for r in near_duplicates(spark.createDataFrame(rows, SCHEMA)).collect() if r[0] is not None
    )
    alone = [(k, 0, k, True) for k in (3, 4, 5, 6, 7, 8, 11, 12, 13, 14)]
    linked = [(1, 4, 1, True), (2, 4, 1, False), (2, 4, 1, False), (9, 4, 1, False), (10, 4, 1, False)]
    assert got == sorted(alone + linked)


def test_empty_table(spark):
    assert near_duplicates(spark.createDataFrame([], SCHEMA)).count() == 0
