"""Streams: the same operators inside micro-batches, with state as versioned tables or in the state store."""

from __future__ import annotations

import time
from collections.abc import Callable, Iterable

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor
from pyspark.sql.streaming.query import StreamingQuery

from ..operators import consume, encode
from ..plans.scratch import remove, settle
from ..sources import pgoutput
from .sinks import FATAL, delay


def has(spark: SparkSession, at: str) -> bool:
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(at)
    return path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(path)


def deliver(frames: DataFrame, sink: Callable[[DataFrame, int], None], checkpoint: str, ignore=None, tables: Iterable[str] | None = None, known: DataFrame | None = None, trigger: dict | None = None) -> StreamingQuery:
    """Frames of the change log to events to a sink. Each batch is whole transactions, so numbers and splits need no state.

    Relations are described in the stream: those of earlier batches are kept in a table beside the checkpoint.
    """
    path = f"{checkpoint}/relations"

    def each(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        new = pgoutput.relations(batch)
        described = new.collect()  # descriptions of tables, few in any batch
        every = spark.createDataFrame(described, new.schema)
        if described:
            every.write.mode("overwrite").parquet(f"{path}/batch={batch_id}")
        if has(spark, path):
            every = spark.read.schema(new.schema).parquet(f"{path}/*")
        every = every if known is None else every.unionByName(known)
        e = encode.encode(pgoutput.changes(batch), every.dropDuplicates(["rel_oid", "valid_from_lsn"]), ignore, tables)
        sink(e.withColumns({"pos_lsn": F.col("commit_lsn"), "is_stream": F.lit(1)}), batch_id)

    return frames.writeStream.foreachBatch(each).option("checkpointLocation", f"{checkpoint}/offsets").trigger(**(trigger or {"availableNow": True})).start()


def first_arrivals(events: DataFrame, delay_threshold: str = "1 hour") -> DataFrame:
    """Streaming dedup by identity within a watermark on the commit time; later replays are the consumer's to drop."""
    ident = F.when(F.col("backfill").isNull(), F.concat(F.lit("s"), F.col("commit_lsn").cast("string"))).otherwise(F.concat(F.lit("r"), F.col("backfill")))
    return events.withColumn("__id", ident).withWatermark("commit_ts", delay_threshold).dropDuplicatesWithinWatermark(["__id", "seq"]).drop("__id")


class Materialiser:
    """The table that a stream amounts to, as a version for each batch: version n comes from n - 1 and batch n alone.

    A replayed batch writes its own version again from the same input, so the result doesn't depend on failures. Each key keeps the position
    of its last event, deleted keys too, so an event that is delivered again in a later batch changes nothing. Only the last two versions stay.
    """

    def __init__(self, path: str, key: str, columns: dict, sent: dict):
        self.path, self.key, self.columns, self.sent = path, key, columns, sent

    def _state(self, spark: SparkSession, n: int) -> DataFrame:
        return spark.read.parquet(f"{self.path}/v={n}")

    def version(self, spark: SparkSession, n: int) -> DataFrame:
        return self._state(spark, n).where("not deleted").drop("at", "deleted")

    def write(self, batch: DataFrame, batch_id: int) -> None:
        spark, e = batch.sparkSession, batch
        if batch_id:
            old = self._state(spark, batch_id - 1)
            seen = old.select(F.col(self.key).alias("__k"), F.col("at").alias("__at"))
            new = batch.join(seen, F.col(self.key) == F.col("__k"), "left").where(F.col("__at").isNull() | (F.struct(*consume.POSITION) > F.col("__at"))).drop("__k", "__at")
            state = old.select(*(c for c in old.columns if c not in ("at", "deleted")), F.when(F.col("deleted"), "delete").otherwise("read").alias("op"), F.lit(None).cast("string").alias("origin"), "at.*")
            e = settle(new.unionByName(state, allowMissingColumns=True), "batch")
        # what a state row holds was all sent
        sent = {c: s | (F.col("op") == "read") for c, s in self.sent.items()}
        out = consume.materialise(e, self.key, self.columns, sent, moved=consume.moves(e, self.key), checkpoint=settle, state=True)
        out.write.mode("overwrite").parquet(f"{self.path}/v={batch_id}")
        if batch_id > 1:
            remove(spark, f"{self.path}/v={batch_id - 2}")


class TouchTracker(StatefulProcessor):
    """Per key: the last transaction that touched it, and whether an image since its last baseline is complete.

    Input rows: table, key_json, commit_lsn, seq, op, xid, is_partial; each batch's rows of a key are put in order here.
    """

    def init(self, handle) -> None:
        self.state = handle.getValueState("touch", "xid long, complete boolean")

    def handleInputRows(self, key, rows, timer_values):
        frame = pd.concat(list(rows)).sort_values(["commit_lsn", "seq"])
        xid, complete = self.state.get() if self.state.exists() else (None, False)
        for op, x, partial in zip(frame["op"], frame["xid"], frame["is_partial"]):
            complete = not partial or (op == "update" and complete)
            xid = x
        self.state.update((int(xid), bool(complete)))
        yield pd.DataFrame({"table": [key[0]], "key_json": [key[1]], "xid": [int(xid)], "complete": [bool(complete)]})

    def close(self) -> None:
        pass


def track(events: DataFrame) -> DataFrame:
    """A streaming table of touches; needs the RocksDB state store."""
    return events.groupBy("table", "key_json").transformWithStateInPandas(TouchTracker(), "table string, key_json string, xid long, complete boolean", "update", "none")


def supervise(start: Callable[[], StreamingQuery], least: float = 0.5, most: float = 30.0, progressed: Callable[[], object] | None = None, sleep=time.sleep, attempts: int | None = None) -> None:
    """Runs a query to its end and starts it again after failures that may pass; the delay starts over after progress."""
    attempt, n, seen = 0, 0, progressed() if progressed else None
    while True:
        try:
            start().awaitTermination()
            return
        except Exception as e:
            n += 1
            if isinstance(e, FATAL) or any(f.__name__ in str(e) for f in FATAL) or (attempts is not None and n >= attempts):
                raise
            now = progressed() if progressed else None
            attempt, seen = (0, now) if now != seen else (attempt + 1, seen)
            sleep(delay(attempt, least, most))
