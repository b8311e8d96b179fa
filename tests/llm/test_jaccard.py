"""The Jaccard join against all pairs of shingle sets."""

from __future__ import annotations

import random
import re

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from batchload.llm import jaccard
from batchload.llm.jaccard import (
    Shingler,
    Similarity,
    keys_of,
    levels,
    similar_documents,
    telling_keys,
)


def shingle_set(text, n=4):
    text = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    if not words:
        return frozenset()
    width = min(n, len(words))
    return frozenset(tuple(words[i : i + width]) for i in range(len(words) - width + 1))


def brute(rows, percent=85):
    """The smallest id reachable per id, by comparing all rows with all."""
    parent = {i: i for i, _ in rows if i is not None}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    sets = [(i, shingle_set(text)) for i, text in rows if i is not None]
    for i, x in sets:
        for j, y in sets:
            if i != j and x and y and 100 * len(x & y) >= percent * len(x | y):
                a, b = root(i), root(j)
                parent[max(a, b)] = min(a, b)
    return {i: root(i) for i in parent}


def edited(words, rng, share):
    out = list(words)
    for _ in range(int(len(words) * share)):
        at = rng.randrange(len(out))
        what = rng.random()
        if what < 0.4:
            out[at] = f"new{rng.randrange(10**6)}"
        elif what < 0.7 and len(out) > 1:
            del out[at]
        else:
            out.insert(at, f"ins{rng.randrange(10**6)}")
    return out


@settings(max_examples=200, deadline=None)
@given(st.integers(0, 2**31), st.integers(1, 900), st.floats(0, 0.17))
def test_linked_sets_keep_keys_in_common(seed, n, share):
    """Linked sets have more keys in common than are dropped by frequency."""
    rule, rng = Similarity(), np.random.default_rng(seed)
    x = rng.integers(0, 2**63, n, dtype=np.uint64)
    changed = int(n * share)
    y = np.concatenate([x[changed:], rng.integers(0, 2**63, rng.integers(0, changed + 1), dtype=np.uint64)])
    x, y = np.unique(x), np.unique(y)
    common, union = len(np.intersect1d(x, y)), len(np.union1d(x, y))
    if np.array_equal(x, y) or 100 * common < 85 * union:
        return
    shared = np.intersect1d(keys_of(x, rule), keys_of(y, rule))
    spare = {level.number: level.spare for level in levels(rule)}
    assert any(
        (np.sum((shared & np.uint64(63)) == np.uint64(k)) > n_spare) for k, n_spare in spare.items()
    )


@settings(max_examples=200, deadline=None)
@given(st.integers(0, 2**31), st.integers(1, 900), st.floats(0, 0.22), st.sampled_from([80, 85]))
def test_linked_sets_share_a_key_when_keys_are_dropped(seed, n, share, percent):
    """Empty parts first, then by frequency, whatever the frequencies are."""
    rule, rng = Similarity(percent), np.random.default_rng(seed)
    x = rng.integers(0, 2**63, n, dtype=np.uint64)
    changed = int(n * share)
    y = np.concatenate([x[changed:], rng.integers(0, 2**63, rng.integers(0, changed + 1), dtype=np.uint64)])
    x, y = np.unique(x), np.unique(y)
    common, union = len(np.intersect1d(x, y)), len(np.union1d(x, y))
    if np.array_equal(x, y) or 100 * common < percent * union:
        return

    def left(elements):
        keys, quotas = telling_keys(elements, rule)
        assert len(keys) <= len(keys_of(elements, rule))
        out = []
        for quota in quotas:
            mine = [int(k) for k in keys if int(k) & 63 == quota & 63]
            mine.sort(key=lambda k: (-(hash((k, seed)) % 7), -k))
            out += mine[quota >> 6 :]
        return set(out)

    assert left(x) & left(y)


def test_very_large_sets_keep_keys_in_common():
    """Texts of 30 MB and more: 5.3 million shingles, 0.95 of them in common."""
    rule, rng = Similarity(), np.random.default_rng(3)
    x = np.unique(rng.integers(0, 2**63, 5_300_000, dtype=np.uint64))
    y = x[rng.random(len(x)) < 0.95]
    shared = np.intersect1d(keys_of(x, rule), keys_of(y, rule))
    numbers, n = np.unique(shared & np.uint64(63), return_counts=True)
    assert any(k > levels(rule)[int(number)].spare for number, k in zip(numbers, n, strict=True))


@pytest.mark.parametrize("percent", [10, 50, 60, 78, 80, 85, 99])
def test_bands_reach_the_longest_texts(percent):
    bands = levels(Similarity(percent))
    assert bands[-1].high >= jaccard.LONGEST - 1 and len(bands) <= 64
    assert all(a.high + 1 == b.low for a, b in zip(bands, bands[1:]))


@settings(max_examples=100, deadline=None)
@given(st.integers(0, 2**31), st.integers(1, 400), st.integers(0, 400))
def test_bitmaps_bound_the_overlap_from_above(seed, n, common):
    rng = np.random.default_rng(seed)
    x = np.unique(rng.integers(0, 2**63, n, dtype=np.uint64))
    y = np.unique(np.concatenate([x[:common], rng.integers(0, 2**63, n // 2 + 1, dtype=np.uint64)]))
    one, two = (np.frombuffer(jaccard.signature(s), np.uint64) for s in (x, y))
    words = min(len(one), len(two))
    differ = int(np.bitwise_count(jaccard.folded(one, words) ^ jaccard.folded(two, words)).sum())
    assert (len(x) + len(y) - differ) // 2 >= len(np.intersect1d(x, y))


def test_shingles():
    shingles = Shingler(4)
    for text in ("", "  \n", "A b", "a B", "a b c d", "a b c d e", "a b c d a b c d", "É é", "x\x0by\x1cz"):
        assert len(shingles(text)) == len(shingle_set(text)), text
    assert (shingles("A b") == shingles("a\tB ")).all()
    assert (shingles("É b") != shingles("é b")).all()
    assert (shingles("a b c") != shingles("a b")).all()


@pytest.mark.parametrize("tile", [jaccard.TILE, 3])
def test_groups_of_near_copies(spark, monkeypatch, tile):
    """Chains and groups of near copies, common passages, small sets; large tiles and tiny ones."""
    monkeypatch.setattr(jaccard, "TILE", tile)
    rng = random.Random(5)
    rows, number = [], 0
    passage = [f"common{i}" for i in range(60)]
    for group in range(25):
        words = [f"w{group}x{rng.randrange(5000)}" for _ in range(rng.choice([3, 5, 8, 12, 30, 90, 300]))]
        for _ in range(rng.choice([1, 2, 5, 12])):
            rows.append((number, " ".join(words)))
            number += 1
            if rng.random() < 0.6:  # a chain: each copy is an edit of the last
                words = edited(words, rng, 0.03)
    for k in range(60):  # documents that share a passage of a third, a half or more of their words
        own = [f"own{k}y{i}" for i in range(rng.choice([4, 10, 60, 120]))]
        rows.append((number, " ".join(own[: len(own) // 2] + passage + own[len(own) // 2 :])))
        number += 1
    base = [f"b{i}" for i in range(120)]
    for _ in range(60):  # near copies of one document, some similar only to some of the others
        rows.append((number, " ".join(edited(base, rng, rng.choice([0.01, 0.02, 0.04])))))
        number += 1
    rng.shuffle(rows)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r["doc_id"]: r["component_id"] for r in similar_documents(docs).collect()}
    assert got == brute(rows)


def test_odd_rows(spark, documents, odd_rows):
    got = similar_documents(documents(odd_rows)).collect()
    assert len(got) == len(odd_rows)
    named = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in got if r["doc_id"] is not None}
    sets = {row[0]: shingle_set(row[1]) for row in odd_rows}
    # Prose three times over has the same shingles as twenty thousand times.
    assert named == {
        1: (len(sets[1]), 1), 2: (len(sets[2]), 1), 3: (0, 3), 4: (0, 4), 5: (0, 5), 6: (len(sets[6]), 1),
        7: (1, 7), 8: (1, 8),
    }
    assert all(r["component_id"] is None for r in got if r["doc_id"] is None)


def test_rows_that_repeat_an_id(spark):
    rows = [(5, "a b c d e"), (3, "a b c d e"), (5, "v w x y z"), (1, "v w x y z"), (9, "q")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted((r["doc_id"], r["component_id"]) for r in similar_documents(docs).collect())
    assert got == [(1, 1), (3, 1), (5, 1), (5, 1), (9, 9)]


def test_empty_table(spark, documents):
    assert similar_documents(documents([])).count() == 0


def test_other_threshold(spark):
    rng = random.Random(2)
    base = [f"b{i}" for i in range(80)]
    rows = [(k, " ".join(edited(base, rng, 0.02 * (k % 5)))) for k in range(40)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r["doc_id"]: r["component_id"] for r in similar_documents(docs, percent=60).collect()}
    assert got == brute(rows, 60)
