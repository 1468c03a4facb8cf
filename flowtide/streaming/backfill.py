"""A running backfill: a table read in chunks of key order, each merged into the stream at a marker, going on where the last run ended."""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F

from ..control_store import DONE, ControlStore, Progress
from ..functions import codec
from ..operators import encode, merge, snapshot
from ..plans.scratch import settle

PREFIX = "flowtide.backfill"


@dataclass
class Source:
    """What a backfill asks of the database and its stream.

    snapshot: the table as of now (the relation's columns, by name), and an xid below which every transaction is in it.
    next_xid: the first xid that nobody has. emit: writes a marker into the log, outside any transaction, and returns its position.
    events: rendered events with from <= commit_lsn < to, once the stream has come to `to`; a marker stands before a commit of the same position.
    """

    snapshot: Callable[[], tuple[DataFrame, int]]
    next_xid: Callable[[], int]
    emit: Callable[[str], int]
    events: Callable[[int, int], DataFrame]


class Waiting(RuntimeError):
    """A transaction from before tracking began has not ended in time, so no snapshot can be trusted yet."""


@dataclass
class Backfill:
    """Reads one table. `deliver` takes read events and returns once they are delivered; only then is progress saved.

    A run that is cut off delivers its last chunk again under another id: at-least-once, and consumers go by the later position.
    Rows that the stream touched without all columns are read again, `attempts` times, then parked to be read at the end.
    """

    source: Source
    store: ControlStore
    slot: str
    generation: int
    relation: Row
    deliver: Callable[[DataFrame], None]
    rows: int = 10_000
    max_bytes: int | None = 64 << 20
    attempts: int = 5
    poll: float = 1.0
    patience: float = 3600.0
    sleep: Callable[[float], None] = time.sleep
    nonce: str = field(default_factory=lambda: uuid.uuid4().hex)

    def __post_init__(self):
        self.table = f"{self.relation.schema_name}.{self.relation.table_name}"
        self.keys = [c.name for c in self.relation["columns"] if c.is_key]
        self.began, self.fence, self.number = None, 0, 0

    # markers and snapshots

    def _emit(self, kind: str) -> int:
        return self.source.emit(json.dumps({"nonce": self.nonce, "kind": kind, "generation": self.generation, "number": self.number}))

    def track(self) -> None:
        """From this marker on, touches are known; whoever ran before it has an xid below the fence."""
        self.began = self._emit("track")
        self.fence = self.source.next_xid()

    def _snapshot(self) -> tuple[DataFrame, int]:
        """A snapshot that sees every transaction from before the fence; taken again until it does."""
        until = time.monotonic() + self.patience
        while True:
            table, xmin = self.source.snapshot()
            if xmin >= self.fence:
                return table, xmin
            if time.monotonic() > until:
                raise Waiting(f"{self.table}: transactions below {self.fence} are still open")
            self.sleep(self.poll)

    def _typed(self, table: DataFrame, key: list[str] | None) -> list[Column] | None:
        return None if key is None else [F.lit(v).cast(table.schema[k].dataType) for k, v in zip(self.keys, key)]

    def _wanted(self, table: DataFrame, keys: DataFrame) -> DataFrame:
        """Rows of the table whose key_json is among `keys`."""
        cells = F.from_json("key_json", "map<string,string>")
        return snapshot.reread(table, self.keys, keys.select(*(cells[k].cast(table.schema[k].dataType).alias(k) for k in self.keys)))

    # merging

    def _merge(self, chunk: DataFrame, xmin: int) -> DataFrame:
        """Delivers what still counts of a chunk at a marker of its own; returns the rows that have to be read again."""
        self.number += 1
        placed = snapshot.chunk_ids(chunk, self.keys, 1 << 40)
        at = self._emit("chunk")
        seen = merge.tracked(self.source.events(self.began, at), [self.table])
        touches = merge.prune(merge.fold_touches(seen), xmin)
        ident = merge.read_id(F.lit(self.relation.rel_oid), F.lit(at), codec.lsn_text)
        reads = encode.render_reads(placed, self.relation, F.lit(at), ident, F.col("row_in_chunk"), F.current_timestamp())
        reads = reads.withColumns({"backfill": ident, "pos_lsn": F.lit(at), "is_stream": F.lit(0), "seq": F.col("row_in_chunk")}).drop("chunk", "row_in_chunk")
        judged = settle(merge.judge_chunk(reads, touches, merge.last_truncate(seen), xmin), "judged")
        self.deliver(judged.where("verdict = 'emit'").drop("verdict"))
        return judged.where("verdict = 'retry'").select("key_json")

    def _settle(self, chunk: DataFrame, xmin: int) -> DataFrame | None:
        """Merges a chunk and what has to be read again; what is left after the last attempt, or None."""
        for attempt in range(self.attempts):
            again = self._merge(chunk, xmin)
            if again.isEmpty():
                return None
            if attempt + 1 < self.attempts:
                table, xmin = self._snapshot()
                chunk = settle(self._wanted(table, again), "again")
        return again

    # the run

    def run(self) -> Progress:
        where = self.slot, self.table
        p = self.store.register(*where, self.relation.rel_oid, self.generation)
        if p.status == DONE:
            return p
        self.track()
        if p.upper is None:
            table, _ = self._snapshot()
            top = snapshot.upper_key(table, self.keys).first()
            if top[0] is None:  # an empty table: what comes later comes in the stream
                self.store.finish(*where)
                return self.store.progress(*where)
            self.store.save_upper(*where, [str(v) for v in top])
        upper, last, limit = self.store.progress(*where).upper, p.last, self.rows
        while True:
            table, xmin = self._snapshot()
            ranged = snapshot.next_chunk(table, self.keys, self._typed(table, last), self._typed(table, upper), limit, self.max_bytes)
            chunk = settle(ranged, "chunk")
            n, top = chunk.agg(F.count("*"), F.max(F.struct(*self.keys))).first()
            if not n:
                break
            left = self._settle(chunk, xmin)
            if left is not None:
                cells = F.from_json("key_json", "map<string,string>")
                self.store.park(*where, [list(r) for r in left.select(*(cells[k].alias(k) for k in self.keys)).collect()])  # of one chunk, at most `rows`
            last = [str(v) for v in top]
            self.store.save(*where, last, n)
            limit = min(self.rows, limit * 2) if n == limit or last == upper else max(n, 1)
        pending = self.store.progress(*where).pending
        if pending and (left := self._parked(pending)) is not None:
            raise Waiting(f"{self.table}: {left.count()} rows keep changing without all columns; they stay parked")
        self.store.finish(*where)
        return self.store.progress(*where)

    def _parked(self, pending: list[list[str]]) -> DataFrame | None:
        table, xmin = self._snapshot()
        types = ", ".join(f"`{k}` string" for k in self.keys)
        wanted = table.sparkSession.createDataFrame([tuple(k) for k in pending], types)
        wanted = wanted.select(*(F.col(k).cast(table.schema[k].dataType).alias(k) for k in self.keys))
        return self._settle(settle(snapshot.reread(table, self.keys, wanted), "parked"), xmin)

    def complete_moves(self, since: int, upto: int) -> int | None:
        """Reads again the rows that moved to another key without all columns, of commits from `since` to `upto`.

        Returns the position that acknowledgement may not pass: None once all are delivered, else the first commit that is still owed.
        """
        if self.began is None:
            self.track()
        owed = settle(merge.owed_moves(merge.tracked(self.source.events(since, upto), [self.table])).select("key_json", "commit_lsn"), "owed")
        if owed.isEmpty():
            return None
        table, xmin = self._snapshot()
        left = self._settle(settle(self._wanted(table, owed.select("key_json").distinct()), "moved"), xmin)
        return None if left is None else owed.join(left, "key_json").agg(F.min("commit_lsn")).first()[0]
