"""Prefix tries against a plain tree in memory."""

from __future__ import annotations

import os
import zlib
from collections import defaultdict
from hashlib import sha256

import pytest
from pyspark.sql import functions as F

from batchload.llm import trie as module
from batchload.llm.queries import QUERIES
from batchload.llm.trie import sketch, trie

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
COLUMNS = [
    "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
    "ends_sha256",
]
SCHEMA = "conv_id long, turn long, role string, text string"


def whole(role, text):
    return sha256(f"{len(role)}:{role}{text}".encode()).hexdigest()


def plain(rows):
    turns = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            turns[conv].append((turn is not None, turn or 0, whole(role or "", text or ""), role or "", text or ""))
    turns = {conv: [(r, t) for *_, r, t in sorted(found)] for conv, found in turns.items()}
    members = defaultdict(set)
    rebuilt = {}
    for conv, own in turns.items():
        h = zlib.crc32(str(conv).encode()) % 6
        base = conv - (conv % 100 if conv >= 0 else -(-conv % 100))
        rebuilt[conv] = tuple(turns.get(base, [])[:h] + own[h:])
        for depth in range(len(rebuilt[conv]) + 1):
            members[rebuilt[conv][:depth]].add(conv)
    children = defaultdict(list)
    for node in members:
        if node:
            children[node[:-1]].append(node)
    leaves, saved, out = {}, {}, []
    for node in sorted(members, key=len, reverse=True):
        leaves[node] = sum(leaves[c] for c in children[node]) or 1
        here = (len(members[node]) - 1) * len(node[-1][1]) if node else 0
        saved[node] = here + sum(saved[c] for c in children[node])
        ends = ",".join(str(c) for c in sorted(members[node]) if len(rebuilt[c]) == len(node))
        out.append(
            (
                min(members[node]), len(node), min(members[node[:-1]]) if node else None,
                len(members[node]), len(children[node]), leaves[node], saved[node],
                sha256(ends.encode()).hexdigest(),
            )
        )
    return sorted(out, key=str)


def of(df, **options):
    found = trie(df, **options)
    assert found.columns == COLUMNS
    return sorted([tuple(row) for row in found.collect()], key=str)


def test_query_on_the_given_conversations(spark):
    rows = spark.read.parquet(f"{SF_DIR}/conversations.parquet")
    got = QUERIES["op11_prefix_trie"](spark, SF_DIR)
    assert [kind for _, kind in got.dtypes] == ["bigint"] * 7 + ["string"]
    got = sorted([tuple(row) for row in got.collect()], key=str)
    assert got == plain([tuple(r) for r in rows.select("conv_id", "turn", "role", "text").collect()])


def mixed():
    """Copies, prefixes of one another, common first turns, turnless ones, families without a
    head."""
    rows = []
    for conv in range(700):
        n = conv * 7 % 9 + 1
        for turn in range(n):
            word = f"w{conv % (3 if turn < 3 else 40)} {turn}"
            rows.append((conv * 3 - 300, turn, "ua"[turn % 2], word * (turn + 1)))
    rows += [(5000, t, "u", "hello") for t in range(2)]
    rows += [(5007, t, "u", "hello") for t in range(1)]
    return rows


@pytest.mark.parametrize("sketch_bytes", [module.SKETCH_BYTES, 40, 1])
def test_mixed(spark, sketch_bytes):
    """The same result whether the sketch clears many prefixes, few or none."""
    rows = mixed()
    assert of(spark.createDataFrame(rows, SCHEMA), sketch_bytes=sketch_bytes) == plain(rows)


def test_one_conversation_over_many_tasks(spark):
    """A third of all turns are one conversation's, and a copy of it and a longer one share them."""
    rows = [(conv, turn, "u", f"t{turn % 7}") for conv in (300, 301, 417) for turn in range(900 + conv % 2)]
    rows += [(conv, 0, "u", f"single {conv}") for conv in range(1000, 1300)]
    df = spark.createDataFrame(rows, SCHEMA).repartition(7)
    assert of(df) == plain(rows)
    stride = module.STRIDE
    module.STRIDE = 64
    try:
        assert of(df) == plain(rows)
    finally:
        module.STRIDE = stride


def test_odd_rows(spark):
    rows = [
        (1, None, None, None), (1, 0, "u", ""), (1, 0, "u", ""), (2, 5, None, "é" * 100_000),
        (3, 1, "u", "b"), (3, 1, "u", "a"), (None, 1, "u", "x"), (-205, 1, "u", "x"),
        (-200, 0, "u", "y"), (9_000_000_000_000_000_001, None, "u", "z"),
    ]
    df = spark.createDataFrame(rows, SCHEMA)
    for name in ("depth", "k1", "at", "head", "rank", "parent"):
        df = df.withColumn(name, F.lit("x"))
    assert of(df) == plain(rows)
    assert of(df.where("false")) == []
    assert of(df.where("conv_id = 2")) == plain([rows[3]])


def test_the_sketch_only_ever_counts_too_much(spark):
    rows = mixed()
    prefixes = module.rebuilt_prefixes(spark.createDataFrame(rows, SCHEMA))
    truth = {(r.k1, r.k2): r["count"] for r in prefixes.groupBy("k1", "k2").count().collect()}
    sent = spark.sparkContext.broadcast(sketch(prefixes, prefixes.count()))
    said = prefixes.select("k1", "k2", module._alone(sent, "k1", "k2").alias("alone")).distinct().collect()
    cleared = [(r.k1, r.k2) for r in said if r.alone]
    assert all(truth[key] == 1 for key in cleared)
    assert len(cleared) > 0.9 * sum(n == 1 for n in truth.values())
