import os
import sys

import pytest
from pyspark.sql import types as T

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

DOCUMENT = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
    T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()),
    T.StructField("n_chars", T.LongType()),
    # names that the operators use inside
    T.StructField("row_id", T.StringType()), T.StructField("n_words", T.StringType()),
    T.StructField("words", T.StringType()), T.StructField("part", T.StringType()),
    T.StructField("start", T.StringType()), T.StructField("size", T.StringType()),
])


@pytest.fixture(scope="session")
def documents(spark):
    """Rows of (doc_id, text[, source]) as a table with extra columns whose names clash."""
    def make(rows, parts=3):
        full = [(r[0], r[1], "en", r[2] if len(r) > 2 else "s", None if r[1] is None else len(r[1]),
                 "x", "x", "x", "x", "x", "x") for r in rows]
        return spark.createDataFrame(full, DOCUMENT).repartition(parts)
    return make


#: null and empty texts, a null id, repeated rows, white space only, no spaces, other scripts
ODD = [
    (1, None), (2, ""), (None, "alone without an id but with words"), (3, "same row"),
    (3, "same row"), (4, " \t\n\r\x0b\x0c "), (5, "x" * 5000), (6, "ünï 中文 😀 ÄÖ  two  spaces \n\n end "),
    (7, "<|endoftext|> and <s> inside"), (8, "tab\tnbsp em x\n y"), (None, None),
    (9, "a" + " b" * 3000),
]
