import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

LONG = " ".join(f"w{i % 977} x{i % 31}" for i in range(60_000)) + "\nfoot line"

TEXTS = [
    None, "", "   ", "\n\n", "one", "two words", "ONE", "a b c d e", "A b C d E",
    "the same line\nsecond line\nthe same line", "  The Same Line \nother",
    "tab\tsep\x0bvt\x0cff\rcr", "nbsp stays one word   here",
    "café Ünïcode ÀÉ ü 中文 字 🦊 emoji", "</s>[INST] ok [/INST] <|end|> <\\s>",
    "x" * 5000, "# * $ % & | < >", LONG, LONG, "a b a b a b a b a b a b",
    "The same body of text goes on and on for more than five words here",
    "The same body of text goes on and on for more than five words there",
]


@pytest.fixture(scope="session")
def edge(spark):
    """Rows with nulls in any column, empty and long texts, repeats, and
    columns whose names clash with results."""
    rows = [(None if i == 4 else i, t, None if i % 5 == 0 else f"src{i % 2}", f"clash {i}", i, "own")
            for i, t in enumerate(TEXTS)]
    rows += rows[5:9]  # repeated rows
    return spark.createDataFrame(
        rows, "doc_id long, text string, source string, kept_text string, n_words int, `__odd` string").repartition(3)


@pytest.fixture(scope="session")
def empty(spark, edge):
    return spark.createDataFrame([], edge.schema)


@pytest.fixture(scope="session")
def edge_rows(edge):
    return [(r.doc_id, r.text) for r in edge.collect()]
