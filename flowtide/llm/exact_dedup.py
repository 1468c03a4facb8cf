"""Operator 2, exact dedup, on DataFrame functions alone.

Texts are equal when identical after each run of white space is replaced by one space. The first pass reads every text once, keeps
its SHA-256 in a slim table and sets two bits in a 64-bit word of a blocked Bloom filter that tells what was set twice: a word's
rows are counted, and its masks are combined by OR and by XOR. Of two rows, OR without XOR is what both set; of three or more every
set bit counts as set twice. The filter has WORDS_A_ROW words a row, whatever the number of rows; only words that are hit take room.
The second pass tests every slim row: one both of whose bits were set twice may be repeated, any other is alone for certain and
passes straight through. Only the possible rows are grouped by their hash, after partial aggregation.

Shuffled are one record of 32 bytes for each hit word and task, and the possible rows; texts never are. The words that hold
repeats are broadcast if they are counted to fit the limit, else slim rows meet them by the word.

Defined cases: null text counts as empty. Of equal texts the row with the smallest doc_id stays; a null
doc_id comes after all others; of rows that repeat a doc_id one stays. An empty table gives an empty result.
Other columns are not touched and may have any name.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import SPACES, small, stash

WORDS_A_ROW = 8


def normalised(text: Column) -> Column:
    return F.regexp_replace(F.coalesce(text, F.lit("")), SPACES, " ")


def _bits(slim: DataFrame, words: int) -> DataFrame:
    """Adds w, the filter's word, and m, a mask of the row's two bits."""
    a, b = F.xxhash64(F.lit(1), "h"), F.xxhash64(F.lit(2), "h")
    one = F.lit(1).cast("long")
    return (
        slim.withColumn("w", F.pmod(a, F.lit(words).cast("long")))
        .withColumn("b1", F.pmod(b, one * 64).cast("int"))
        .withColumn("b2", F.pmod(F.shiftright(b, 8), one * 64).cast("int"))
        .withColumn("m", F.expr("shiftleft(1L, b1)").bitwiseOR(F.expr("shiftleft(1L, b2)")))
        .drop("b1", "b2")
    )


def decide(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", words_a_row: float = WORDS_A_ROW) -> DataFrame:
    """A row for each row of docs: doc_id, keep_id, group_size, kept, text_sha256."""
    slim = docs.select(F.col(doc_id).alias("i"), F.unhex(F.sha2(normalised(F.col(text)), 256)).alias("h"))
    slim = stash(slim.withColumn("r", F.monotonically_increasing_id()), "hashes")
    rows = _bits(slim, max(1, round(words_a_row * slim.count())))
    words = rows.groupBy("w").agg(F.count("*").alias("n"), F.bit_or("m").alias("any"), F.bit_xor("m").alias("odd")).where("n > 1")
    twice = F.when(F.col("n") == 2, F.col("any").bitwiseAND(F.bitwise_not("odd"))).otherwise(F.col("any"))
    bits = stash(words.select("w", twice.alias("seen")).where("seen <> 0"), "bits")
    tested = rows.join(small(bits), "w", "left").withColumn("maybe", F.coalesce(F.col("seen").bitwiseAND(F.col("m")) == F.col("m"), F.lit(False))).select("i", "h", "r", "maybe")

    possible = tested.where("maybe").drop("maybe")
    first = F.min(F.struct(F.col("i").isNull().alias("none"), "i", "r"))
    groups = possible.groupBy("h").agg(first.alias("f"), F.count("*").alias("n")).where("n > 1").select("h", "n", F.col("f.i").alias("keep"), F.col("f.r").alias("keep_r"))
    groups = stash(groups, "groups")
    same = possible.join(small(groups, row_bytes=160), "h", "left")
    alone = tested.where("not maybe").drop("maybe").select("*", F.lit(None).cast("long").alias("n"), F.col("i").alias("keep"), F.lit(None).cast("long").alias("keep_r"))
    out = same.select("i", "h", "r", "n", F.when(F.col("n").isNull(), F.col("i")).otherwise(F.col("keep")).alias("keep"), "keep_r").unionByName(alone)
    return out.select(
        F.col("i").alias("doc_id"),
        F.col("keep").alias("keep_id"),
        F.coalesce("n", F.lit(1)).cast("long").alias("group_size"),
        F.coalesce(F.col("keep_r") == F.col("r"), F.lit(True)).alias("kept"),
        F.lower(F.hex("h")).alias("text_sha256"),
    )


ORACLE = r"""
with d as (select doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') as t from documents)
select doc_id, min(doc_id) over (partition by t) as keep_id, count(*) over (partition by t) as group_size,
       doc_id = min(doc_id) over (partition by t) as kept, sha256(t) as text_sha256
from d
"""
