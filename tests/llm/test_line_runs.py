"""Line dedup as the pipeline has it: runs of one line, short passages."""

import random

import corpus_pipeline
from pyspark.sql import functions as F
from flowtide.llm import line_dedup

A, B = "the one line that comes again and again", "some other line of more than the least length"


def clean(spark, texts):
    d = spark.createDataFrame([(i, t, None, None, None) for i, t in enumerate(texts)], "doc_id long, text string, lang string, source string, n_chars long")
    return {r.doc_id: r["text"] for r in corpus_pipeline.line_chunks(spark, d, "").collect()}


def test_runs_within_a_document(spark):
    got = clean(spark, ["\n".join(["first", *[A] * 9, "last"]), "\n".join([B, B, "x", B]), "s\ns\ns", None, ""])
    assert got == {0: f"first\n{A}\nlast", 1: f"{B}\nx\n{B}", 2: "s", 3: None, 4: ""}


def test_runs_across_documents(spark):
    long, short = [A] * 5, ["ab", "c"]
    got = clean(spark, ["\n".join(["one", "two", *long, "three"]), "\n".join(["four", *[A] * 3, "five"]), "\n".join(short), "\n".join(short), "\n\n", "\n\n"])
    assert got == {0: f"one\ntwo\n{A}\nthree", 1: f"four\n{A}\nfive", 2: "ab\nc", 3: "", 4: "\n\n", 5: "\n\n"}  # short chunks go, empty ones have nothing to lose


def test_copies_go_whole(spark):
    """Whatever the lines, no chunk of a copy is left out of the comparison."""
    rng = random.Random(3)
    texts = ["\n".join(f"{rng.randrange(10**12)} is a line of a copied text" for _ in range(n)) for n in range(2, 60)]
    got = clean(spark, texts * 2)
    assert [got[i] for i in range(len(texts))] == texts
    assert all(got[len(texts) + i] == "" for i in range(len(texts)))


def test_every_chunk_has_two_lines(spark):
    rng = random.Random(4)
    texts = ["\n".join(f"line {rng.randrange(6)}" for _ in range(n)) for n in range(1, 80)]
    d = spark.createDataFrame([(t,) for t in texts], "text string")
    for r in line_dedup._cut(d, F.col("text"), 32).collect():
        chunks = [r["__ld_l"][a - 1 : b] for a, b in zip(r["__ld_s"], r["__ld_e"])]
        assert "\n".join("\n".join(c) for c in chunks) == r["text"] and (len(chunks) == 1 or all(len(c) > 1 for c in chunks))
        assert not any(a[-1] == b[0] for a, b in zip(chunks, chunks[1:]))
