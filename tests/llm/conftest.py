import pytest

LONG = "alpha beta gamma " * 20_000


@pytest.fixture(scope="session")
def hostile(spark):
    """Documents with nulls everywhere, empty and very long texts, ties,
    repeated rows and extra columns named like internal ones."""
    rows = [(1, "one two three four", "en", "a", 18), (1, "one two three four", "en", "a", 18),
            (2, "one two three four", None, "a", None), (3, None, "fr", None, 0), (None, "no id here at all", "en", "b", 1),
            (None, None, None, None, None), (4, "", "en", "b", 0), (5, LONG, "en", "b", len(LONG)),
            (6, "One Two THREE four", "en", "c", 18), (7, "   \n\t ", "en", "c", 6), (7, "other text, same id", "de", "c", 1),
            (8, "ﬁ 漢字 \U0001f600 ▁ x", "xx", "c", 9), (9, "word", "en", "c", 4), (10, "All rights reserved. CC BY-NC 4.0", "en", "c", 3)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    return df.selectExpr("*", "1 as label", "2 as words", "3 as shard", "4 as score", "5 as print", "6 as tokens",
                         "7 as block", "8 as rid", "9 as `group`", "10 as id", "11 as hash", "12 as epoch")


@pytest.fixture(scope="session")
def empty(hostile):
    return hostile.where("doc_id = -1")
