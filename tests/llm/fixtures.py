"""Small tables with the awkward cases every operator must handle."""

import random

from pyspark.sql import types as T

DOCS = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
                     T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()),
                     T.StructField("n_chars", T.LongType())])

# Names that operators use inside; a user's table may have them too.
CLASHES = ("row", "block", "bucket", "fp", "key", "root", "place", "ids", "score", "n_words", "answers", "lang_pred")


def prose(seed: int, n: int, vocabulary: int = 400) -> str:
    rng = random.Random(seed)
    return " ".join(f"w{rng.randrange(vocabulary)}x{rng.randrange(3)}" for _ in range(n))


def awkward_texts() -> list:
    base, other = prose(1, 60), prose(2, 90)
    return [base, base, "  " + base.upper() + "\n", other, other + " tail", "intro " + other, None, "", " \t\n ", "one",
            prose(3, 3), prose(4, 19), prose(5, 20), prose(5, 20), "a " * 70, "Éé ÀÀ ß " * 12, prose(6, 6000),
            prose(7, 25) + "\x1c\x85   " + prose(5, 20), prose(8, 30) + " " + base[:200], "!!! ??? 123"]


def documents(spark, texts=None, ids=None, clashing: bool = False):
    texts = awkward_texts() if texts is None else texts
    ids = list(range(len(texts))) if ids is None else ids
    rows = [(i, t, "en", f"s{k % 3}", None if t is None else len(t)) for k, (i, t) in enumerate(zip(ids, texts))]
    df = spark.createDataFrame(rows, DOCS)
    if clashing:
        for name in CLASHES:
            df = df.selectExpr("*", f"'x' AS `{name}`")
    return df


def empty(spark):
    return spark.createDataFrame([], DOCS)
