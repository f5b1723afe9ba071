"""Plain Python forms of the operators, to compare with."""

import re

from pyspark.sql import types as T

SF_DIR = "/root/testdata/sf0.001"
ALNUM = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")
SPACED = re.compile("[^\x20\x09-\x0d]+")

DOCUMENT = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
    T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType()),
])


def documents(spark, texts, extra=()):
    """Documents 0, 1, ... of these texts, or (id, text) pairs; ``extra`` names columns that hold something else."""
    rows = [t if isinstance(t, tuple) else (i, t) for i, t in enumerate(texts)]
    df = spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in rows], DOCUMENT).repartition(3)
    for name in extra:
        df = df.selectExpr("*", f"'x' AS {name}")
    return df


def table(spark, name):
    return spark.read.parquet(f"{SF_DIR}/{name}.parquet")


def lowered(text):
    return re.sub("[A-Z]+", lambda m: m[0].lower(), text or "")


def shingle_set(text, k):
    words = SPACED.findall(lowered(text))
    return {tuple(words[i : i + k]) for i in range(len(words) - k + 1)} if len(words) >= k else ({tuple(words)} if words else set())


# Texts that every operator has to take: null, empty, blank, one word, signs only, other scripts, very long.
ODD = [None, "", " \n\t ", "one", "!!! ...", "ÄÖÜ ß", "日本語 のテキスト", "a" * 70_000, "word " * 30_000, "x y  z\r\n\n", "🙂 🙂", "\x00\x01 a"]
