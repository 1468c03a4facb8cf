import random

import pytest
from pyspark.sql import types as T

KIND = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType())])


def words(rng: random.Random, n: int, size: int = 400) -> list[str]:
    return [f"w{rng.randrange(size)}x" for _ in range(n)]


def hard_texts(seed: int = 0) -> list[str | None]:
    """Nulls, empty and very long texts, copies, ties, near copies, shared passages, odd white space."""
    rng = random.Random(seed)
    base = words(rng, 120)
    passage = words(rng, 60)
    out: list[str | None] = [None, "", " \n\t ", "one", "one two three", None, "\x0b\x0c one\r\ntwo", " ".join(base), " ".join(base), "\n".join(base)]
    for i in range(12):
        near = list(base)
        near[rng.randrange(120)] = f"new{i}"
        out.append(" ".join(near))
    for i in range(10):
        out.append("\n".join([" ".join(words(rng, 30)), " ".join(passage[:30]), " ".join(passage[30:]), "shared tail line of text here", " ".join(words(rng, 25))]))
    out.append(" ".join(words(rng, 30_000, 10**6)) + " " + " ".join(passage))
    out.append("same " * 300)
    out.append("日本語 текст ñandú ▁     😀 " * 5)
    out.append("a" * 50_000)
    lines = [" ".join(words(rng, 8)) for _ in range(14)]
    for i in range(4):
        out.append("\n".join([f"only here {i}", *lines, "", "", f"the end of {i}"]))
    for i in range(20):
        out.append(" ".join(words(rng, rng.randrange(1, 60), 30)))
    return out


def frame(spark, texts, extra: bool = True):
    rows = [(i, t, ["en", "de", None][i % 3], ["s0", "s1", None, "s2"][i % 4], None if t is None else len(t)) for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, KIND).repartition(3)
    if extra:  # names that operators use inside
        for c in ("i", "t", "h", "p", "c", "n", "bucket", "spans", "keep", "kept", "score", "n_tokens"):
            from pyspark.sql import functions as F

            df = df.withColumn(c, F.lit("mine"))
    return df


@pytest.fixture(scope="session")
def texts():
    return hard_texts()


@pytest.fixture(scope="session")
def docs(spark, texts):
    return frame(spark, texts).cache()


@pytest.fixture(scope="session")
def empty(spark):
    return frame(spark, [])


@pytest.fixture(scope="session")
def odd(spark):
    """Rows that repeat, a doc_id with two texts, and null doc_ids."""
    w = " ".join(f"k{i}" for i in range(40))
    rows = [(None, w), (None, None), (5, w), (5, w), (5, "other text of five words"), (2, w + " more"), (7, "")]
    return spark.createDataFrame(rows, "doc_id long, text string")
