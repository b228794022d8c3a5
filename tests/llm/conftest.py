import os

import pytest

SMALL = "/root/testdata/sf0.001"
ODD = [
    (1, "", "en", "src0", 0),
    (2, None, None, None, None),
    (None, "a text without an id, mail me@x.org", "en", "src0", 35),
    (3, "Tabs\tand\x0bold\x0cspaces \u00a0 here\r\n\r\nnot\u2003ascii \U0001f600 end", "en", "src1", 40),
    (4, "the same row twice " * 20, "en", "src1", 380),
    (4, "the same row twice " * 20, "en", "src1", 380),
    (5, " \n\t ", "de", None, 4),
    (6, "one two three four", "fr", "src2", 18),
    (8, "long blanks" + " " * 1_200_000 + "end" + "\n" * 1_100_000, "en", "src2", 2_300_014),
    (7, "wo" * 60_000 + " " + "many words of a very long text " * 5000, "en", "src2", 275_001),
]


@pytest.fixture(scope="session")
def sf_dir():
    return SMALL


@pytest.fixture(scope="session")
def documents(spark):
    return spark.read.parquet(os.path.join(SMALL, "documents.parquet"))


@pytest.fixture(scope="session")
def odd(spark):
    """Documents with nulls, empty and long texts, repeated rows and columns of clashing names."""
    from pyspark.sql import functions as F

    df = spark.createDataFrame(ODD, "doc_id long, text string, lang string, source string, n_chars long")
    return df.withColumns({c: F.lit("x") for c in ("i", "h", "left", "copy", "found", "ids", "start", "length", "kept", "n", "word", "anchor", "span", "label", "host", "rule", "band")})


@pytest.fixture(scope="session")
def empty(odd):
    return odd.limit(0)
