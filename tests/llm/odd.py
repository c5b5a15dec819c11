"""Tables with nulls, ties, repeats, long texts and clashing column names."""

from pyspark.sql import types as T

LONG = "word " * 40_000 + "x" * 50_000
CLASHES = ["id", "rid", "run", "digest", "key", "n", "shard", "size", "language", "keep_id", "text_hash", "positions", "fp", "source_size", "ids"]
ODD_DOCS = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("lang", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("n_chars", T.LongType()),
        *[T.StructField(c, T.StringType()) for c in CLASHES],
    ]
)
PASSAGE = " ".join(f"p{k}" for k in range(60))
ODD_ROWS = [
    (1, None, None, None, None),
    (2, "", "en", "a", 0),
    (3, "  \t\n", "en", "a", 4),
    (4, "the same text", "en", "a", 13),
    (5, "the  same text", "en", "b", 14),
    (5, "the  same text", "en", "b", 14),
    (6, "thesametext", None, "b", 11),
    (None, "the same text", "en", None, 13),
    (None, None, None, None, None),
    (7, LONG, "en", "c", len(LONG)),
    (8, LONG, "de", "c", len(LONG)),
    (9, PASSAGE + " one end", "de", "d", 1),
    (10, "a start " + PASSAGE, "de", "d", 1),
    (11, "1234 5678 !!", "fr", "", 1),
    (12, 'password = "hunter2abc9" é漢', "fr", "", 1),
]


def odd_docs(spark):
    return spark.createDataFrame([(*r, *["z"] * len(CLASHES)) for r in ODD_ROWS], ODD_DOCS)


def no_docs(spark):
    return spark.createDataFrame([], ODD_DOCS)
