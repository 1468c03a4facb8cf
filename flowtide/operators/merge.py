"""Merging a table's snapshot into its stream: what the stream touched, what of a chunk still counts, what has to be read again."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


#: What a touched row goes by: the same key in another table is another row.
ROW = ("table", "key_json")


def fold_touches(events: DataFrame) -> DataFrame:
    """table, key_json, xid of the last event (in stream order), and whether a complete image is among those since the key's last baseline.

    Updates build on the image before them; any other event starts anew. So a key is complete if its last whole image is no
    older than its last event that is no update; both are maxima, combined before the shuffle.
    """
    at = F.struct("commit_lsn", "seq")
    e = events.where("op <> 'truncate'")
    one = e.groupBy(*ROW).agg(F.max_by("xid", at).alias("xid"), F.max(F.when(~F.col("is_partial"), at)).alias("whole"), F.max(F.when(F.col("op") != "update", at)).alias("base"))
    return one.select(*ROW, "xid", F.coalesce((F.col("whole") >= F.col("base")) | (F.col("base").isNull() & F.col("whole").isNotNull()), F.lit(False)).alias("complete"))


def tracked(events: DataFrame, tables: list[str]) -> DataFrame:
    """Events of the tables that a backfill is tracking."""
    return events.where(F.col("table").isin(tables))


def last_truncate(events: DataFrame) -> DataFrame:
    """table, the largest xid that truncated it: a row for each table truncated."""
    return events.where("op = 'truncate'").groupBy("table").agg(F.max("xid").alias("truncate_xid"))


def verdict(xmin: Column, xid: Column, complete: Column, truncate_xid: Column) -> Column:
    """emit, drop or retry a row of a chunk whose snapshot sees every transaction below xmin."""
    return (
        F.when(F.coalesce(truncate_xid, F.lit(0)) >= F.when(xmin > 0, xmin).otherwise(F.lit(1)), "drop")
        .when(xid.isNull() | (xid < xmin), "emit").when(complete, "drop").otherwise("retry")
    )


def judge_chunk(chunk: DataFrame, touches: DataFrame, truncates: DataFrame, xmin: int) -> DataFrame:
    """chunk with verdict added, by its rows' table and key. Truncates hold for whole tables, so they are joined by table."""
    t = touches.select(*ROW, F.col("xid").alias("__xid"), F.col("complete").alias("__complete"))
    out = chunk.join(t, list(ROW), "left").join(truncates.select("table", "truncate_xid"), "table", "left")
    return out.withColumn("verdict", verdict(F.lit(xmin), F.col("__xid"), F.col("__complete"), F.col("truncate_xid"))).drop("__xid", "__complete", "truncate_xid")


def own_markers(markers: DataFrame, prefix: str, nonce: str) -> DataFrame:
    """Markers (lsn, transactional, prefix, content) of this session's backfill: kind, generation, number, lsn. Others, and what can't be read, are no concern of it."""
    m = markers.where((F.col("prefix") == prefix) & ~F.col("transactional")).withColumn("m", F.from_json("content", "nonce string, kind string, generation long, number long"))
    return m.where(F.col("m.nonce") == nonce).select("lsn", "m.kind", "m.generation", "m.number")


def match_chunks(markers: DataFrame, chunks: DataFrame) -> DataFrame:
    """Chunk rows with their marker's position; a chunk of another generation, or without a marker, waits."""
    m = markers.where("kind = 'chunk'").select("generation", "number", F.col("lsn").alias("marker_lsn"))
    return chunks.join(m, ["generation", "number"])


def read_id(oid: Column, marker_lsn: Column, lsn_text) -> Column:
    return F.concat(oid.cast("string"), F.lit("."), lsn_text(marker_lsn))


def owed_moves(events: DataFrame) -> DataFrame:
    """Insert halves of key changes that came without all columns: their rows have to be read again."""
    return events.where("op = 'insert' and is_partial")


def prune(touches: DataFrame, xmin: int) -> DataFrame:
    """What later chunks can still need."""
    return touches.where(F.col("xid") >= xmin)


def overflowed(touches: DataFrame, limit: int = 1 << 20) -> bool:
    """Whether more keys are tracked than the guard allows; a backfill then starts tracking anew."""
    return touches.limit(limit + 1).count() > limit
