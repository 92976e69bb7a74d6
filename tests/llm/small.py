"""Small hand-made tables with the awkward cases: nulls, empty and very long
texts, ties, repeated rows, clashing column names."""

import random

SF_SMALL = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def documents(spark, rows, extra=()):
    """rows: (doc_id, text[, lang[, source]]); ``extra``: clashing column names."""
    full = [(*r, *(None,) * (4 - len(r)), None if r[1] is None else len(r[1])) for r in rows]
    df = spark.createDataFrame(full, DOCS)
    from pyspark.sql import functions as F
    for name in extra:
        df = df.withColumn(name, F.lit("clash"))
    return df


def prose(seed, n, vocabulary=400):
    r = random.Random(seed)
    words = ["".join(random.Random(i).choice("abcdefghijklmnop") for _ in range(3 + i % 6)) for i in range(vocabulary)]
    return " ".join(r.choice(words) for _ in range(n))


AWKWARD = [
    (1, None, None, None), (2, "", "en", "a"), (3, " \t\n\x0b\x0c\r", "en", "a"), (4, "one", "en", "b"),
    (5, "one two three four", "en", "b"), (6, "One\ttwo  three\nfour", "en", None), (7, prose(1, 60), "en", "a"),
    (7, prose(1, 60), "en", "a"), (8, prose(1, 60) + " tail", "en", "a"), (9, prose(2, 30_000), "de", "c"),
    (None, prose(3, 50), "de", "c"), (None, prose(3, 50), "de", "c"), (10, "x" * 200_000, "fr", "c"),
    (11, "123 456 !!! ---", "fr", "b"), (12, "été ÉTÉ naïve 你好 \U0001f600", "fr", "b"),
]
CLASHING = ("digest", "salt", "n", "row", "hash", "size", "c", "part", "_digest", "_row", "_kept", "_words", "_finish",
            "score", "id", "kept", "w", "i", "label", "y")
