"""Bounded reads of a table in key order: chunks, ranges, bounds, re-reads, and whether a table can be read so."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..plans.scratch import settle


def key_after(keys: list[str], after: list | None, upto: list | None) -> Column:
    """after < key <= upto, compared column by column; None leaves a side open.

    What it implies for the first column stands beside it, as a comparison of structs alone reaches no scan.
    """
    key = F.struct(*keys)
    lit = lambda values: F.struct(*(F.lit(v).alias(k) for k, v in zip(keys, values)))
    out = F.lit(True)
    if after is not None:
        out = out & (F.col(keys[0]) >= F.lit(after[0])) & (key > lit(after))
    if upto is not None:
        out = out & (F.col(keys[0]) <= F.lit(upto[0])) & (key <= lit(upto))
    return out


def next_chunk(table: DataFrame, keys: list[str], after: list | None, upto: list | None, rows: int, max_bytes: int | None = None, size: Column | None = None) -> DataFrame:
    """The next rows in key order; the range reaches the scan, the order is a top-n.

    With max_bytes, rows end with the one that brings their sizes (of their text form, or `size`) to it: of at most `rows` rows, one at least.
    """
    chunk = table.where(key_after(keys, after, upto)).orderBy(*keys).limit(rows)
    if max_bytes is None:
        return chunk
    each = size if size is not None else sum((F.coalesce(F.octet_length(F.col(c).cast("string")), F.lit(0)) for c in table.columns), F.lit(0))
    before = F.coalesce(F.sum(each.cast("long")).over(Window.orderBy(*keys).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))  # over at most `rows` rows
    return chunk.withColumn("__before", before).where(F.col("__before") < max_bytes).drop("__before")


def upper_key(table: DataFrame, keys: list[str]) -> DataFrame:
    """The largest key, one row."""
    return table.agg(F.max(F.struct(*keys)).alias("k")).select("k.*")


def chunk_ids(table: DataFrame, keys: list[str], rows: int) -> DataFrame:
    """Adds chunk and row_in_chunk, for chunks of `rows` rows in key order, without one global sort task.

    Rows are dealt into sorted ranges of the key and written once with their range and place in it, so that every later look at
    them sees the same ranges; a count for each range (as many rows as partitions) shifts the places.
    """
    at = F.monotonically_increasing_id()  # the partition in the upper bits, the row's place in it below
    ranged = settle(table.repartitionByRange(*keys).sortWithinPartitions(*keys).withColumn("__at", at), "ranges")
    part, rank = F.shiftright("__at", 33), F.col("__at").bitwiseAND(F.lit((1 << 33) - 1))
    counts = ranged.groupBy(part.alias("__part")).agg(F.count("*").alias("__n"))
    before = counts.select("__part", F.coalesce(F.sum("__n").over(Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("__before"))
    out = ranged.withColumn("__part", part).join(F.broadcast(before), "__part")  # a row for each partition
    place = rank + F.col("__before")
    return out.withColumns({"chunk": F.floor(place / rows).cast("long"), "row_in_chunk": (place % rows).cast("long")}).drop("__part", "__at", "__before")


def next_limit(rows_read: Column, truncated: Column, limit: Column, configured: int) -> Column:
    """The adaptive row limit: what fitted if bytes ran out, else doubled up to the configured one."""
    return F.when(truncated, F.greatest(rows_read, F.lit(1))).otherwise(F.least(F.lit(configured), limit * 2))


def gate(xmin: Column, fence: Column) -> Column:
    """A chunk's snapshot counts only once it sees every transaction that ran when tracking began; until then it is taken again."""
    return xmin >= fence


def reread(table: DataFrame, keys: list[str], wanted: DataFrame) -> DataFrame:
    """Exactly the rows with the wanted keys."""
    return table.join(wanted.select(*keys).distinct(), keys, "left_semi")


def key_profile(table: DataFrame, keys: list[str]) -> DataFrame:
    """Rows, rows with a null key, and distinct keys, in one pass after partial aggregation by key."""
    null = F.lit(False)
    for k in keys:
        null = null | F.col(k).isNull()
    per_key = table.groupBy(*keys).agg(F.count("*").alias("n"))
    return per_key.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n_rows"), F.coalesce(F.sum(F.when(null, F.col("n"))), F.lit(0)).alias("null_keys"), F.count(F.when(~null, 1)).alias("distinct_keys"))


def refusal(profile: DataFrame) -> Column:
    """Why a table can't be read in chunks, or 'ok'."""
    return (
        F.when(F.col("relkind") != "r", "not an ordinary table").when(F.col("has_children"), "has child tables").when(F.col("replica_identity") != "d", "replica identity is not default")
        .when(F.col("row_security"), "row security hides rows").when(~F.col("publishes_all"), "not all operations are published").when(~F.col("is_member"), "not in the publication")
        .when(F.col("has_filters"), "the publication filters rows or columns").when(F.col("n_keys") == 0, "no primary key").when(F.col("json_key"), "a key column is json").otherwise("ok")
    )
