"""Small tables with the awkward cases every operator must stand."""

from pyspark.sql import types as T

DOCS = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("lang", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("n_chars", T.LongType()),
        # Names the operators use inside.
        *[T.StructField(n, T.StringType()) for n in ("size", "id", "key", "component", "label")],
    ]
)

LONG = " ".join(f"word{i % 977} and{i % 31}" for i in range(3_000))


def docs(spark, rows):
    """Rows of (doc_id, text, lang, source)."""
    full = [(i, t, lang, src, len(t or ""), "a", "b", "c", "d", "e") for i, t, lang, src in rows]
    return spark.createDataFrame(full, DOCS)


def awkward(spark):
    return docs(
        spark,
        [
            (1, None, None, None),
            (2, "", "en", "a"),
            (3, " \n\t ", "en", "a"),
            (4, "word", "en", "b"),
            (4, "word", "en", "b"),
            (None, "no id here but some words to read", "en", None),
            (5, "a tie of words, a tie of words, a tie of words.\nA line.\nA line.", "en", "b"),
            (6, "a tie of words, a tie of words, a tie of words.\nA line.\nA line.", "en", "b"),
            (7, LONG, "en", "c"),
            (8, "ünïcödé 漢字 \U0001f600 text\r\nwith odd  spaces <|endoftext|> !", "fr", "c"),
        ],
    )
