"""Tables of edge cases that every text operator must take."""

from pyspark.sql import types as T

DOC_SCHEMA = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("lang", T.StringType()),
        T.StructField("source", T.StringType()),
        # names the operators use themselves
        T.StructField("score", T.DoubleType()),
        T.StructField("fp", T.StringType()),
        T.StructField("key", T.StringType()),
        T.StructField("size", T.LongType()),
        T.StructField("Text_Hash", T.StringType()),
    ]
)
LONG_TEXT = " ".join(f"wort{i % 977} und noch eins" for i in range(30_000))
PLAIN = "the quick brown fox jumps over the lazy dog near the river bank at noon"
EDGE_ROWS = [
    (1, PLAIN, "en", "a", 1.0, "f", "k", 5, "h"),
    (1, PLAIN, "en", "a", 1.0, "f", "k", 5, "h"),
    (2, PLAIN, "en", None, None, None, None, None, None),
    (3, "", "en", "a", None, None, None, None, None),
    (4, None, None, "b", None, None, None, None, None),
    (None, "no id here at all today", "en", "b", None, None, None, None, None),
    (None, None, None, None, None, None, None, None, None),
    (5, LONG_TEXT, "de", "c", 0.5, "", "", 0, ""),
    (6, " \t\r\n ", "en", "c", None, None, None, None, None),
    (7, "Ünïcode \u00a0 \U0001f600 \u0130stanbul \u03a3", "xx", "d", None, None, None, None, None),
]


def edge_docs(spark):
    return spark.createDataFrame(EDGE_ROWS, DOC_SCHEMA)


def no_docs(spark):
    return spark.createDataFrame([], DOC_SCHEMA)


def docs_of(spark, texts, **columns):
    rows = [(i, t, *[v[i] for v in columns.values()]) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, "doc_id long, text string" + "".join(f", {c} string" for c in columns))
