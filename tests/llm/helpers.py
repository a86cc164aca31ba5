"""Small fixtures of awkward rows."""

from __future__ import annotations

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint, rep string, score string, `set_id` string, rest string, bucket string"


def docs(spark, rows):
    """(doc_id, text) rows with the other columns of documents, and columns named like internal ones."""
    full = [(i, t, "en", "s", len(t or ""), "x", "x", "x", "x", "x") for i, t in rows]
    return spark.createDataFrame(full, DOCS)


AWKWARD = [
    (1, None), (2, ""), (3, " \t\n"), (4, "one"), (5, "one two"), (6, "One  TWO"), (7, "one two"), (7, "one two"),
    (8, "a b c d e f g h i j"), (9, "a b c d e f g h i k"), (10, "é ü　zwei drei\u00a0vier"), (11, "the cat sat on the mat " * 3000),
    (None, "one two"), (None, None), (12, "😀 emoji 😀 text"),
]
