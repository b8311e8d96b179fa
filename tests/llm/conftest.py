from __future__ import annotations

import pytest

#: Names that the operators use inside; tables may have columns of these names too.
CLASHING = ("node", "key", "size", "rows", "copies", "row", "words", "id", "n", "label", "keys", "h")


@pytest.fixture(scope="session")
def documents(spark):
    """A function that makes a table of documents with columns of clashing names."""

    def make(rows):
        """rows: (doc_id, text, lang, source)."""
        schema = "doc_id long, text string, lang string, source string, n_chars long"
        full = [(*row, None if row[1] is None else len(row[1])) for row in rows]
        extra = "".join(f", {name} string" for name in CLASHING)
        return spark.createDataFrame([(*row, *["x"] * len(CLASHING)) for row in full], schema + extra)

    return make


@pytest.fixture(scope="session")
def odd_rows():
    """Nulls in every column, empty and very long texts, ties and repeated rows."""
    prose = "the quick brown fox jumps over the lazy dog and the cat is in the house with a mouse "
    return [
        (1, prose * 3, "en", "a"),
        (2, prose * 3, "en", "a"),
        (2, prose * 3, "en", "a"),
        (3, "", "en", "b"),
        (4, None, None, None),
        (None, prose, "en", "a"),
        (None, None, None, None),
        (5, "   \n\t ", None, "b"),
        (6, prose * 20_000, "en", None),
        (7, "=" * 300_000, "en", "c"),
        (8, "12 34 !!", None, "c"),
    ]
