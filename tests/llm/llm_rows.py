"""Documents with every odd case, shared by the tests."""

import pytest
from pyspark.sql import types as T

DOCS = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
                     T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()),
                     T.StructField("n_chars", T.LongType()),
                     # columns whose names operators use for their own results
                     *[T.StructField(n, T.StringType()) for n in (
                         "shard", "kept", "score", "label", "node", "_norm", "_dropped", "id", "part", "start")]])

LONG = "lorem ipsum dolor sit amet consectetur " * 6000 + "x" * 5000


def doc(i, text, lang="en", source="a"):
    return (i, text, lang, source, None if text is None else len(text), *["?"] * 10)


EDGE = [doc(None, "a row without an id"), doc(None, None), doc(0, None), doc(1, ""), doc(2, " \t\n\x0b\x0c\r"),
        doc(3, "one"), doc(4, "one"), doc(5, "two words"), doc(5, "two words"), doc(6, LONG), doc(7, LONG + " end"),
        doc(8, "Überall wächst das Gras, und die Vögel singen; der Fluß fließt.", "de"),
        doc(9, "café <|endoftext|> <|ENDOFTEXT|> it's 3.14 \x1c a b İstanbul ΣΣ"),
        doc(10, "日本語のテキスト。二番目の文。", None), doc(11, "### $$$ 123 !!!", "en", None),
        doc(12, "The  same\ntext"), doc(13, "Thesametext"), doc(14, "The same text ")]


@pytest.fixture(scope="session")
def edge(spark):
    return spark.createDataFrame(EDGE, DOCS)


@pytest.fixture(scope="session")
def none(spark):
    return spark.createDataFrame([], DOCS)
