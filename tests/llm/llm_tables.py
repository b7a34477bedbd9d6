"""Tables that every operator has to take."""

import pytest
from pyspark.sql import functions as F

SMOKE = "/root/testdata/sf0.001"
COLUMNS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture()
def documents(spark):
    """Documents with nulls in every column, empty and repeated rows, and columns whose names could clash."""

    def make(rows, clash=True):
        df = spark.createDataFrame([(*r, "en", None if r[0] is None else f"s{r[0] % 3}", None) for r in rows], COLUMNS)
        if clash:
            for name in ("_Digest", "_hash", "_id", "digest", "rank", "_range", "key", "Text_Hash", "_copies", "size", "_Score", "root", "Component_Id"):
                df = df.withColumn(name, F.lit("x"))
        return df

    return make


AWKWARD = [(None, None), (None, "a b"), (1, None), (2, ""), (3, "a b"), (3, "a b"), (4, "a b"), (5, "w " * 30_000), (6, " \n\t"), (7, "é ü <|im_end|>"), (8, "one two three four")]


@pytest.fixture()
def awkward(documents):
    return documents(AWKWARD)


@pytest.fixture()
def empty(documents):
    return documents([(1, "x")]).filter("doc_id < 0")
