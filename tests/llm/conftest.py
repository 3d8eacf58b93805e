import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

ODD = [
    (1, "The cat sat on the mat and the cat ran.\nIt ran far.", "en", "a"),
    (1, "The cat sat on the mat and the cat ran.\nIt ran far.", "en", "a"),  # repeated row
    (2, None, "en", "a"),
    (3, "", None, None),
    (4, " \t\n ", "en", "b"),
    (5, "123 456 !!", "fr", "b"),
    (None, "a text without an id stands here", "en", "b"),
    (6, "le chat est sur la table et le chien dort", "fr", "c"),
    (7, "word " * 30_000, "en", "a"),
    (8, "le chien dort et le chat est sur la table", "fr", "c"),
]


@pytest.fixture()
def odd_documents(spark):
    """Nulls in every column, empty and very long texts, repeated rows, and
    extra columns with names the operators use themselves."""
    rows = [(*r, None if r[1] is None else len(r[1]), "x", 1, 2.0) for r in ODD]
    return spark.createDataFrame(
        rows, "doc_id long, text string, lang string, source string, n_chars long, words string, id long, score double"
    )
