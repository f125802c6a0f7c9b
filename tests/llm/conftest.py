import pytest
from pyspark.sql import types as T

DOC = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
                    T.StructField("kept", T.StringType()), T.StructField("start", T.IntegerType())])


@pytest.fixture(scope="session")
def make_docs(spark):
    """Documents with two further columns whose names clash with inner ones."""
    return lambda rows: spark.createDataFrame([(i, t, "x", 1) for i, t in rows], DOC)


@pytest.fixture(scope="session")
def docs(spark, sf_small):
    return spark.read.parquet(f"{sf_small}/documents.parquet")


@pytest.fixture(scope="session")
def odd_rows():
    """Nulls, empty and long texts, ties and repeated rows."""
    line = "the same line stands here and there, again and again, over one hundred bytes long so that it counts as a passage"
    return [(5, None), (6, ""), (7, " \n\t "), (None, line), (8, line + "\n" + line), (9, line), (9, line), (10, line + " b"),
            (11, "w " * 40_000 + "é́ <|endoftext|> password: hunter2hunter2"), (12, "a"), (13, "tail " * 7)]
