"""Batches and acknowledgements as tables."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..plans.scratch import settle


def jump_table(sums: np.ndarray, max_bytes: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """What a run of rows does to a batch that is open when it begins: least open size, seals, size left open at its end.

    sums: running sizes of the run. The last row in ascending order of the open size that is not above it holds; below the first, nothing is sealed.
    The first seal is at one of the rows that begin within max_bytes; from each, pointers to the next seal jump double the distance in each round.
    """
    n = len(sums)
    hop = np.searchsorted(sums, sums + max_bytes)
    seals = (hop < n).astype(np.int64)
    hop = np.where(hop < n, hop, np.arange(n))
    while not np.array_equal(hop, further := hop[hop]):
        seals, hop = seals + seals[hop], further
    first = np.searchsorted(np.concatenate(([0], sums[:-1])), max_bytes)
    least, count, rest = np.maximum(max_bytes - sums[:first], 0), seals[:first] + 1, sums[-1] - sums[hop[:first]]
    # chains from near starts soon meet: rows with the same outcome are one, the last of them
    ends = np.append((count[1:] != count[:-1]) | (rest[1:] != rest[:-1]), True)
    return least[ends][::-1], count[ends][::-1], rest[ends][::-1]


def pack(sizes: DataFrame, max_bytes: int, stream: str = "stream") -> DataFrame:
    """Adds batch: a batch is sealed once it has max_bytes or more. sizes: stream, pos (ordered, once each), bytes, anything else.

    Each batch depends on where the last ended, yet no task walks a whole stream: rows are dealt into sorted ranges and written once, each
    range tells in a jump table how it goes on from any open batch, only these tables are chained in order, and then every range is walked by itself.
    """
    part = F.shiftright("__at", 33).alias("__part")  # monotonically_increasing_id: the range in the upper bits
    dealt = sizes.repartitionByRange(stream, "pos").sortWithinPartitions(stream, "pos")
    ranged = settle(dealt.withColumn("__at", F.monotonically_increasing_id()), "pack").select("*", part)
    names = sizes.columns
    kind = ranged.schema[stream].dataType.simpleString()

    def jumps(key: tuple, rows: pa.Table) -> pa.Table:
        size = rows["bytes"].to_numpy()[np.argsort(rows["__at"].to_numpy())]
        sums = np.cumsum(size, dtype=np.int64)
        least, seals, rest = jump_table(sums, max_bytes)
        same = lambda v: pa.repeat(v, len(least))
        return pa.table({stream: same(key[0]), "__part": same(key[1]), "total": same(pa.scalar(sums[-1])), "least": least, "seals": seals, "rest": rest})

    def chain(key: tuple, table: pa.Table) -> pa.Table:
        number, size, starts = 0, 0, []
        order = table.sort_by([("__part", "ascending"), ("least", "ascending")])
        parts, least, seals, rest, total = (order[c].to_numpy() for c in ("__part", "least", "seals", "rest", "total"))
        edges = np.append(np.flatnonzero(np.append(True, parts[1:] != parts[:-1])), len(parts))
        for a, b in zip(edges[:-1], edges[1:]):
            starts.append((int(parts[a]), number, size))
            at = a + int(np.searchsorted(least[a:b], size, "right")) - 1
            number, size = (number, size + int(total[a])) if at < a else (number + int(seals[at]), int(rest[at]))
        p, n, s = zip(*starts)
        return pa.table({stream: pa.repeat(key[0], len(p)), "__part": pa.array(p, pa.int64()), "__number": pa.array(n, pa.int64()), "__size": pa.array(s, pa.int64())})

    tables = ranged.select(stream, "__part", "__at", F.col("bytes").cast("long").alias("bytes")).groupBy(stream, "__part")
    tables = tables.applyInArrow(jumps, f"`{stream}` {kind}, __part long, total long, least long, seals long, rest long")
    starts = settle(tables.groupBy(stream).applyInArrow(chain, f"`{stream}` {kind}, __part long, __number long, __size long"), "starts")

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, number, size = None, 0, 0
        for b in batches:
            out = []
            for s, p, n, o, bytes_ in zip(*(b[c].to_pylist() for c in (stream, "__part", "__number", "__size", "bytes"))):
                if (s, p) != at:
                    at, number, size = (s, p), n, o
                out.append(number)
                size += bytes_
                if size >= max_bytes:
                    number, size = number + 1, 0
            yield b.select(names).append_column("batch", pa.array(out, pa.int64()))

    schema = sizes.select("*", F.lit(0).cast("long").alias("batch")).schema
    rows = ranged.join(starts, [stream, "__part"]).select(*names, "__part", "__at", "__number", "__size")
    return rows.repartition("__part").sortWithinPartitions("__at").mapInArrow(walk, schema)


def ack_of_batches(packed: DataFrame) -> DataFrame:
    """batch, events, bytes, ack_lsn: only a batch that holds a transaction's last event acknowledges it, a fragment 0."""
    ack = F.coalesce(F.max(F.when(F.col("ends_tx"), F.col("end_lsn"))), F.lit(0))
    return packed.groupBy("batch").agg(F.count("*").alias("events"), F.sum("bytes").alias("bytes"), ack.alias("ack_lsn"), F.min_by("commit_ts", "pos").alias("oldest_commit"))


def prefix(batches: DataFrame) -> DataFrame:
    """One row: the position up to which every batch is done (flushed), and the same for delivered batches whatever their order.

    The first undone batch is found by an aggregate, not by a running window, so no task sees all batches.
    """
    first = batches.agg(F.min(F.when(~F.col("done"), F.col("batch"))).alias("__first"))
    b = batches.crossJoin(first)  # one row
    before = F.col("__first").isNull() | (F.col("batch") < F.col("__first"))
    return b.agg(F.coalesce(F.max(F.when(before, F.col("ack_lsn"))), F.lit(0)).alias("flushed_lsn"), F.coalesce(F.max(F.when(F.col("done"), F.col("ack_lsn"))), F.lit(0)).alias("delivered_lsn"))


def hold(flushed: Column, held: Column) -> Column:
    """Acknowledgement goes no further than the earliest position that something is owed for."""
    return F.least(flushed, held)


def in_flight(batches: DataFrame) -> DataFrame:
    """Entries from the first undone batch on, and the bytes of the undone ones."""
    first = batches.agg(F.min(F.when(~F.col("done"), F.col("batch"))).alias("__first"))
    return batches.crossJoin(first).agg(
        F.count(F.when(F.col("batch") >= F.col("__first"), 1)).alias("depth"), F.coalesce(F.sum(F.when(~F.col("done"), F.col("bytes"))), F.lit(0)).alias("bytes")
    )  # one row


def admits(other_bytes: Column, depth: Column, limit: int, most: int = 1024) -> Column:
    return (other_bytes < limit) & (depth <= most)


