import os

import pytest

SF = "/root/testdata/sf0.001"

LONG = " ".join(f"word{i % 977} number{i}" for i in range(30_000))

ODD = [
    (1, None, None, None, None),
    (2, "", "en", "a", 0),
    (2, "", "en", "a", 0),
    (3, " \n\t ", "en", None, 4),
    (None, "a text without an id that has enough words to be read as one", "en", "a", 1),
    (None, None, None, None, None),
    (4, LONG, "en", "b", len(LONG)),
    (5, "x" * 200_000, "en", "b", 200_000),
    (6, "The same text stands here twice and is long enough to count for something.", "en", "a", 7),
    (6, "The same text stands here twice and is long enough to count for something.", "en", "a", 7),
    (7, "the SAME text stands here twice and is long enough to count for something.", "de", "a", 7),
    (8, "퟿ é中😀 \x00 <|end|> </s> \\ \\\\", "fr", "c", 3),
]
CLASHING = "_id int, _text string, _label int, fp long, copy int, kept boolean, score double, item string, _row int"


@pytest.fixture
def sf():
    if not os.path.isdir(SF):
        pytest.skip("driver tables are not here")
    return SF


@pytest.fixture
def odd(spark):
    """Documents with nulls, empty and very long texts, repeats, and columns of clashing names."""
    rows = [(*r, 1, "other", 0, 5, 9, None, 0.5, "i", 3) for r in ODD]
    return spark.createDataFrame(rows, f"doc_id long, text string, lang string, source string, n_chars long, {CLASHING}")


@pytest.fixture
def no_documents(odd):
    return odd.where("false")


@pytest.fixture
def labels(spark):
    rows = [(1, 1, 0), (6, 1, 0), (4, 0, 1), (5, None, None), (None, 1, 1), (99, 0, 1)]
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int")


@pytest.fixture
def table(spark, sf):
    return lambda name: spark.read.parquet(f"{sf}/{name}.parquet")
