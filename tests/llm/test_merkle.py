"""Merkle manifests against a plain construction of the whole tree."""

from __future__ import annotations

import os
import zlib
from hashlib import sha256

import pytest
from pyspark.sql import functions as F

from batchload.llm import merkle
from batchload.llm.queries import QUERIES

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
NAMES = ("doc_id", "source", "lang", "n_chars", "text")


def h(*texts):
    return sha256("".join(texts).encode()).hexdigest()


def field(value):
    return "-" if value is None else f"{len(str(value).encode())}:{value}"


def climb(level):
    """All levels over a row of nodes, and for each node the siblings up to the top."""
    levels = [level]
    while len(levels[-1]) > 1:
        row = levels[-1]
        levels.append([h(*row[i : i + 8]) for i in range(0, len(row), 8)])
    proofs = []
    for place in range(len(level)):
        proof = []
        for row in levels[:-1]:
            run = row[place // 8 * 8 : place // 8 * 8 + 8]
            proof.append((place % 8, [x for i, x in enumerate(run) if i != place % 8]))
            place //= 8
        proofs.append(proof)
    return levels[-1][0], proofs


def plain(rows):
    """rows: tuples in the order of NAMES; the manifest as a sorted list."""
    by_lang = {}
    for row in rows:
        by_lang.setdefault(row[2], []).append(row)
    langs = sorted(by_lang, key=lambda x: (x is not None, (x or "").encode()))
    trees = {}
    for lang in langs:
        leaves = [(row[0], h(*map(field, row)), row) for row in by_lang[lang]]
        leaves.sort(key=lambda x: (x[0] is not None, x[0] or 0, x[1]))
        trees[lang] = (leaves, *climb([leaf for _, leaf, _ in leaves]))
    root, tops = climb([trees[lang][1] for lang in langs])
    out = []
    for lang, top in zip(langs, tops):
        leaves, subroot, proofs = trees[lang]
        for (doc_id, leaf, row), proof in zip(leaves, proofs):
            proof = proof + top
            seen = leaf
            if doc_id is not None and zlib.crc32(str(doc_id).encode()) % 3 == 0 and row[4]:
                low = "".join(c.lower() if "A" <= c <= "Z" else c for c in row[4])
                seen = h(*map(field, (*row[:4], low)))
            for place, others in proof:
                seen = h(*others[:place], seen, *others[place:])
            text = h(*[x for _, others in proof for x in others])
            out.append((doc_id, leaf, subroot, root, text, seen, seen == root))
    return sorted(out, key=str)


def of(df):
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    bad = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 0
    copy = F.when(bad, F.translate("text", upper, upper.lower())).otherwise(F.col("text"))
    found = merkle.manifest(df, list(NAMES), shown={"text": copy})
    return sorted([(*row, row.folded_root == row.root) for row in found.collect()], key=str)


def test_query_on_the_given_documents(spark):
    rows = spark.read.parquet(f"{SF_DIR}/documents.parquet").select(*NAMES).collect()
    got = QUERIES["op13_merkle_manifest"](spark, SF_DIR)
    assert got.columns == [
        "doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"
    ]
    got = sorted([tuple(row) for row in got.collect()], key=str)
    assert got == plain([tuple(row) for row in rows])
    assert {row[6] for row in got} == {True, False}


@pytest.mark.parametrize("sizes", [[1], [2, 1], [8, 9, 1], [600, 64, 65, 3], [5000]])
def test_trees_of_any_size(spark, sizes):
    """One leaf, full and broken runs, one layer of blocks and two, partitions without a name."""
    rows, doc_id = [], 0
    for lang, n in zip((None, "é", "a", "z"), sizes):
        for _ in range(n):
            doc_id += 1
            rows.append((doc_id * 7919 % 100_003, "S", lang, doc_id, f"Text {doc_id % 50}"))
    df = spark.createDataFrame(rows, "doc_id long, source string, lang string, n_chars long, text string")
    assert of(df) == plain(rows)


def test_many_partitions(spark):
    rows = [(i, None, f"lang{i % 700}", i, "X") for i in range(1500)]
    df = spark.createDataFrame(rows, "doc_id long, source string, lang string, n_chars long, text string")
    assert of(df) == plain(rows)


def test_odd_rows(spark, documents, odd_rows):
    df = documents(odd_rows)
    rows = [tuple(row) for row in df.select(*NAMES).collect()]
    assert of(df) == plain(rows)
    assert of(df.where("false")) == []


def test_one_changed_row_fails_alone(spark):
    """Only what the reader holds otherwise is refused; every other row still leads to the root."""
    df = spark.range(2000).selectExpr(
        "id AS doc_id", "'s' AS source", "'en' AS lang", "5L AS n_chars", "concat('row ', id) AS text"
    )
    copy = F.when(F.col("doc_id") == 1234, F.lit("other")).otherwise(F.col("text"))
    found = merkle.manifest(df, list(NAMES), shown={"text": copy})
    bad = found.where("folded_root <> root").collect()
    assert [row.id for row in bad] == [1234]
    whole = merkle.manifest(df, list(NAMES))
    assert whole.where("folded_root <> root").count() == 0


def test_blocks_are_the_largest_groups():
    """A block's own sweep against the plain construction of its subtree."""
    leaves = [h(str(i)) for i in range(300)]
    root, proofs = climb(leaves)
    inbox = merkle.sweep_up(0, leaves, 300)
    assert inbox[max(inbox)] == [root]
    for proof, mine in zip(proofs, merkle.sweep_down(0, leaves, 300, [])):
        assert [(place, "".join(others)) for place, others in proof] == mine
        assert merkle.fold(leaves[proof[0][0]], mine) is not None
