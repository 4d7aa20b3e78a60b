"""Rows that every document operator has to take."""

import pytest
from pyspark.sql import types as T

SCHEMA = T.StructType([
    T.StructField("doc_id", T.LongType()),
    T.StructField("text", T.StringType()),
    T.StructField("lang", T.StringType()),
    T.StructField("source", T.StringType()),
    T.StructField("n_chars", T.LongType()),
])
PROSE = "The river was high and the old bridge over it stood in the water that came down from the hills. "
LONG = " ".join(f"word{i % 977} and the other{i % 31}." for i in range(9000))
ROWS = [
    (1, PROSE * 3, "en", "a", None),
    (2, None, "en", None, 0),
    (3, "", None, "a", 0),
    (4, PROSE * 3, "en", "b", None),
    (4, PROSE * 3, "en", "b", None),
    (5, "password = hunter22 " + PROSE, "en", "a", None),
    (6, LONG, "en", "a", None),
    (None, PROSE, "fr", "a", None),
    (7, "été déjà vu — 日本語 \U0001f600 ß" * 5, "fr", "a", None),
    (8, "!!! ... 123", "en", "a", None),
    (9, " \n\t ", "en", "a", None),
]
#: names that operators use for columns of their own
CLASHING = ["fp", "block", "bucket", "kept", "component_id", "score", "spans", "ids", "shard", "size", "node", "digest"]


def documents(spark, rows=ROWS):
    return spark.createDataFrame(rows, SCHEMA)


def crowded(df):
    from pyspark.sql import functions as F

    return df.withColumns({name: F.lit("x") for name in CLASHING})


def write(df, folder):
    df.coalesce(2).write.parquet(f"{folder}/documents.parquet")
    return str(folder)


both = pytest.mark.parametrize("shape", [lambda df: df, crowded], ids=["plain", "clashing"])
