"""Awkward rows that every operator must take."""
import random

from pyspark.sql import functions as F
from pyspark.sql import types as T

SF = "/root/testdata/sf0.001"

DOCS = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
                     T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()),
                     T.StructField("n_chars", T.LongType())])
#: Names that operators use inside; a table may have them as well.
CLASHING = ["print", "fingerprint", "component_id", "_row", "_print", "root", "best", "kept", "anomaly", "seed", "seeds", "text_hash",
            "spans", "found", "n_tokens", "_tokens", "_p0", "p0", "rate", "copies", "_copy", "votes", "score", "start", "ids", "low",
            "held_out", "_label", "domain", "n_words", "least", "query_id", "rank", "v", "_block", "_at", "own", "anchor"]
SYLLABLES = "the an ti on er re in st ha ou ble ing nd es".split()


def words(n, seed):
    r = random.Random(seed)
    return " ".join("".join(r.choices(SYLLABLES, k=r.randint(1, 4))) for _ in range(n))


def awkward():
    base = words(80, 1)
    near = base.replace(base.split()[40], "changed", 1)
    return [
        (1, base, "en", "a", len(base)), (2, base, "en", "a", len(base)), (3, near, None, None, None),
        (4, None, "en", "a", None), (5, "", "en", "a", 0), (6, " \n\t ", "en", "b", 4), (None, base, "en", "a", 9),
        (None, None, None, None, None), (7, words(60, 2), "en", "a", 1), (7, words(60, 2), "en", "a", 1), (7, words(70, 3), "fr", "a", 1),
        (8, words(30000, 4), "fr", "b", 1), (9, "a" * 50000, "fr", "b", 1), (10, "été ÉTÉ ſecret K   x y 日本語 \U0001f600", "fr", "b", 1),
        (11, "Straße " * 200, "fr", "b", 1), (12, "!!! $$$ 123 |", "en", "b", 1), (13, base + " " + base, "en", "a", 1),
    ]


def frame(spark, rows, extra=True):
    df = spark.createDataFrame(rows, DOCS)
    if extra:
        for c in CLASHING:
            df = df.withColumn(c, F.lit("x"))
    return df
