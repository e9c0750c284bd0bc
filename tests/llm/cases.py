"""Small tables with the awkward cases every operator has to take."""

from pyspark.sql import types as T

DOCS = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
                     T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()),
                     T.StructField("n_chars", T.LongType()), T.StructField("score", T.StringType()),
                     T.StructField("length", T.StringType()), T.StructField("_bucket", T.StringType()),
                     T.StructField("label", T.StringType()), T.StructField("slot", T.StringType())])


def docs_frame(spark, texts):
    """Texts (or (doc_id, text) pairs) as documents, with columns whose names operators use themselves."""
    rows = []
    for i, t in enumerate(texts):
        key, text = t if isinstance(t, tuple) else (i, t)
        rows.append((key, text, ("en", "de", None)[i % 3], ("a", "b", "b", None)[i % 4],
                     None if text is None else len(text), "x", "y", "z", "w", "v"))
    return spark.createDataFrame(rows, DOCS)


AWKWARD = [
    None, "", " ", "\n\n", "a", "a", "Straße  mit   Blanks \n und\tTabs ", "é" * 300, "one two three four five six",
    "x" * 20_000, "word " * 9_000, "\x1c odd\x1d separators \x85 here", "  lead and trail  ", "<|endoftext|> </s> <s>",
    "▁marks▁ and ▁ more", "emoji 😀😀 familia 👨‍👩‍👧 end", "a b c 　 d", "tie tie tie", "tie tie tie", (3, "same id"), (3, "same id"),
    (None, "no id"), (None, "no id"), "don't we'll I'm 'twas\n\n \n  end", "1 22 333 4444 55555 ½ ² ٣",
]
