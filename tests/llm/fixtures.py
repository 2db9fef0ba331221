"""Inputs shared by the corpus operator tests."""

import random

from pyspark.sql import types as T

SF = "/root/testdata/sf0.001"

SCHEMA = T.StructType([
    T.StructField("doc_id", T.LongType()),
    T.StructField("text", T.StringType()),
    T.StructField("lang", T.StringType()),
    T.StructField("source", T.StringType()),
    T.StructField("n_chars", T.LongType()),
    # names that operators use inside
    T.StructField("rid", T.StringType()),
    T.StructField("removed", T.StringType()),
    T.StructField("coverage", T.StringType()),
])


def rows(texts):
    return [(i, t, "en", f"s{i % 2}", len(t or ""), "x", "y", "z") for i, t in enumerate(texts)]


def frame(spark, texts):
    return spark.createDataFrame(rows(texts), SCHEMA)


def stored(spark, texts, tmp_dir, name="docs"):
    """The texts as a stored table of several files."""
    frame(spark, texts).coalesce(2).write.mode("overwrite").parquet(f"{tmp_dir}/{name}")
    return spark.read.schema(SCHEMA).parquet(f"{tmp_dir}/{name}")


def sentence(rng, n, vocabulary=400):
    return " ".join(f"w{rng.randrange(vocabulary)}x" for _ in range(n))


def corpus(seed=1, n=60):
    """Distinct texts, exact copies, near copies, empty, NULL and long ones."""
    rng = random.Random(seed)
    texts = ["\n".join(sentence(rng, rng.randrange(5, 40)) for _ in range(rng.randrange(1, 8)))
             for _ in range(n)]
    texts += [texts[0]] * 3
    for k in range(12):
        words = texts[1].split(" ")
        words[rng.randrange(len(words))] = f"changed{k}"
        texts.append(" ".join(words))
    texts += [None, "", " \n\t ", "word", "two words", "ÀÉ ñ ß 日本語", sentence(rng, 5000),
              "a " * 3000, None, ""]
    return texts
