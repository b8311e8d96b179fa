"""License scans against exact containment at every place."""

from __future__ import annotations

import random

from batchload.llm.licenses import CONTAINED, TEMPLATES, anchors, bands_for, classes, scan, words_of


def brute(rows):
    """(doc_id, template) pairs with enough shingles in some run of 1.5 times the class's size."""
    by_name, found = classes(TEMPLATES, CONTAINED), set()
    for i, text in rows:
        words = words_of(text or "")
        for name, template in TEMPLATES.items():
            c, parts = by_name[name], words_of(template)
            wanted = {tuple(parts[j : j + c.k]) for j in range(len(parts) - c.k + 1)}
            have = [tuple(words[j : j + c.k]) for j in range(len(words) - c.k + 1)]
            hits = [j for j, shingle in enumerate(have) if shingle in wanted]
            for start in hits:
                inside = {have[j] for j in hits if start <= j < start + int(1.5 * c.most)}
                if len(inside) >= CONTAINED * len(wanted) - 1e-9:
                    found.add((i, name))
                    break
    return found


def test_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    got = {(r["doc_id"], r["license"]) for r in scan(docs).collect()}
    assert got == brute(docs.select("doc_id", "text").collect()) and got


def test_edited_copies(spark):
    rng, rows = random.Random(1), []
    filler = [f"filler{i}" for i in range(500)]
    for i, (name, template) in enumerate(list(TEMPLATES.items()) * 6):
        words = template.split()
        for _ in range(rng.choice([0, 0, 1, 2, 5])):
            words[rng.randrange(len(words))] = "changed"
        at = rng.randrange(400)
        rows.append((i, " ".join(filler[:at] + words + filler[at : at + rng.randrange(100)])))
    got = {(r["doc_id"], r["license"]): r for r in scan(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got.keys() == brute(rows)
    for (i, _), r in got.items():
        words = words_of(dict(rows)[i])
        assert 0.8 <= r["containment"] <= 1 and 0 <= r["first_word"] <= r["last_word"] < len(words)
        assert not words[r["first_word"]].startswith("filler")


def test_every_match_holds_an_anchor():
    chosen = anchors(TEMPLATES, CONTAINED)
    by_name = classes(TEMPLATES, CONTAINED)
    for name, template in TEMPLATES.items():
        words, k = words_of(template), by_name[name].k
        shingles = {tuple(words[i : i + k]) for i in range(len(words) - k + 1)}
        without = {s for s in shingles if not set(s) & set(chosen)}
        assert len(without) < CONTAINED * len(shingles)


def test_bands():
    for similarity in (0.2, 0.5, 0.9):
        for rows in (1, 2):
            n = bands_for(similarity, rows, 1e-5)
            assert (1 - similarity**rows) ** n <= 1e-5 < (1 - similarity**rows) ** (n - 1)


def test_odd_rows(spark, documents, odd_rows):
    line = "Licensed under the Apache License, Version 2.0."
    long_text = "word " * 200_000 + line.upper() + " end" * 100_000
    rows = [*odd_rows, (20, line, "en", "a"), (20, line, "en", "a"), (21, long_text, None, None), (None, line, None, None)]
    got = scan(documents(rows)).collect()
    assert sorted((r["doc_id"] or 0, r["license"], r["containment"]) for r in got) == [
        (0, "apache-line", 1.0), (20, "apache-line", 1.0), (21, "apache-line", 1.0),
    ]
    assert [(r["first_word"], r["last_word"]) for r in got if r["doc_id"] == 21] == [(200_000, 200_007)]


def test_empty_tables(spark, documents):
    assert scan(documents([])).count() == 0
    assert scan(documents([(1, "All rights reserved.", "en", "a")]), {}).count() == 0
    assert scan(documents([(1, "All rights reserved.", "en", "a")]), {"none": "..."}).count() == 0
