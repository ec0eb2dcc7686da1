"""Fixtures of the tests beside this file."""

import pytest

DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long, label int, predicted int"

#: Nulls, empty and blank texts, repeated rows, copies, a long text; the last two columns clash with names the operators use.
ODD = [
    (1, "The quick brown fox jumps over the lazy dog near the old river bank today", "en", "a", 1, 1, 1),
    (2, None, None, None, None, None, None),
    (3, "", "en", "b", 0, 0, 0),
    (4, " \n\t ", "en", "c", 3, 0, 0),
    (1, "The quick brown fox jumps over the lazy dog near the old river bank today", "en", "a", 1, 1, 1),
    (5, "THE quick brown fox jumps over the lazy dog near the old river bank today", "en", "b", 1, 1, 1),
    (6, "one two", "en", "a", 7, 0, 0),
    (7, "One  two", "en", "a", 7, 0, 0),
    (8, "word " * 30_000, "en", "d", 150_000, 0, 0),
    (9, "Zażółć gęślą jaźń 日本語 <|endoftext|> #2 İstanbul\x1c ", "pl", "e", 1, 0, 0),
    (None, "a row without an id", "en", "a", 1, 0, 0),
]


@pytest.fixture
def odd(spark):
    return spark.createDataFrame(ODD, DOCUMENTS).repartition(3)


@pytest.fixture
def empty(spark):
    return spark.createDataFrame([], DOCUMENTS)


@pytest.fixture
def labels(spark):
    """Toxic texts hold one of two words; texts of poor quality shout."""
    return spark.createDataFrame(
        [(i, i % 2, (i // 2) % 2) for i in range(1000, 1400)] + [(1000, None, None), (None, 1, 1), (1001, 7, 7)],
        "doc_id long, quality int, toxic int",
    )


@pytest.fixture
def labelled(spark, labels):
    rows = []
    for i in range(1000, 1400):
        words = [f"{w}{(i * k) % 17}x" for k, w in enumerate("alpha beta gamma delta epsilon zeta eta theta".split(), 1)]
        if (i // 2) % 2:
            words.insert(i % 7, "blockhead" if i % 3 else "nitwit")
        text = " ".join(words)
        rows.append((i, text if i % 2 else text.upper() + " !!! ###" * 5, "en", f"s{i % 9}", len(text), 0, 0))
    return spark.createDataFrame(rows, DOCUMENTS)
