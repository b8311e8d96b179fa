"""Comparison by fingerprints against a comparison of the rows themselves."""

from __future__ import annotations

import random
from collections import Counter, defaultdict

import pytest

from batchload.operators.fingerprint import differing_rows, reconcile_contents

SCHEMA = "b string, k long, v string, w double, o string"


def plain(source, target):
    """Differing keys, and the status of every group."""
    one, two = Counter(source), Counter(target)
    left = {"s": one - two, "t": two - one}
    keys = defaultdict(lambda: [0, 0])
    for at, side in enumerate("st"):
        for (b, k, *_), n in left[side].items():
            keys[b, k][at] += n
    found = {
        (b, k, "missing_in_target" if not t else "missing_in_source" if not s else "changed", s, t)
        for (b, k), (s, t) in keys.items()
    }
    groups = {}
    for b in {r[0] for r in (*source, *target)}:
        s, t = (sum(1 for r in side if r[0] == b) for side in (source, target))
        bad = any(key[0] == b for key in keys)
        status = "missing_in_target" if not t else "missing_in_source" if not s else "differs" if bad else "ok"
        groups[b] = (s or None, t or None, status)
    return found, groups


def check(spark, source, target, tmp_path, leaf_rows):
    one, two = (spark.createDataFrame(rows, SCHEMA) for rows in (source, target))
    found, groups = plain(source, target)
    got = reconcile_contents(one, two, ["b"])
    assert {r.b: (r.source_rows, r.target_rows, r.status) for r in got.collect()} == groups
    rows = differing_rows(one, two, ["b"], "k", str(tmp_path), leaf_rows=leaf_rows).collect()
    assert len(rows) == len(found)
    assert {(r.b, r.k, r.status, r.source_rows, r.target_rows) for r in rows} == found


@pytest.mark.parametrize("leaf_rows", [1, 50])
def test_any_change_is_found(spark, tmp_path, leaf_rows):
    rng = random.Random(3)
    source = [
        (f"b{i % 7}" if i % 11 else None, i * 37 - 9000, rng.choice("xyz"), i / 3, None)
        for i in range(1500)
    ]
    target = list(source)
    target[10] = (*target[10][:2], "other", *target[10][3:])
    target[20] = (*target[20][:3], None, target[20][4])
    target[33] = (*target[33][:2], None, target[33][3], target[33][2])  # the value moves on
    target[44] = (target[44][0], 10**15, *target[44][2:])
    target[55] = target[56]  # one row twice, another not at all
    target[66] = ("b3" if target[66][0] != "b3" else "b4", *target[66][1:])
    target.append(("new", 5, "x", None, None))
    source += [("old", None, "x", 1.0, None), ("b1", None, "q", 1.0, None), ("b1", None, "q", 1.0, None)]
    target += [("b1", None, "q", 1.0, None), ("b1", None, "r", 1.0, None)]
    check(spark, source, target, tmp_path, leaf_rows)


def test_equal_tables_and_empty_ones(spark, tmp_path):
    rows = [("a", 1, "x", 0.5, None), ("a", 1, "x", 0.5, None), ("b", None, None, None, None)]
    check(spark, rows, rows[::-1], tmp_path / "1", 1)
    check(spark, rows, [], tmp_path / "2", 1)
    check(spark, [], [], tmp_path / "3", 1)


def test_keys_over_the_whole_range(spark, tmp_path):
    source = [("a", k, "x", 1.0, None) for k in (-(2**61), -1, 0, 1, 2**61)] * 3
    target = [*source[:-1], ("a", 2**61, "y", 1.0, None)]
    check(spark, source, target, tmp_path, 1)


def test_only_differing_ranges_are_compared_row_by_row(spark, tmp_path):
    source = spark.range(100_000).selectExpr("id % 2 AS b", "id AS k", "id * 3 AS v")
    target = source.selectExpr("b", "k", "CASE WHEN k = 77777 THEN -1 ELSE v END AS v")
    found = differing_rows(source, target, ["b"], "k", str(tmp_path))
    assert [tuple(r) for r in found.collect()] == [(1, 77777, 1, 1, "changed")]
    ranges = [spark.read.parquet(str(p)).count() for p in tmp_path.iterdir()]
    assert set(ranges) == {1} and len(ranges) >= 3
