"""A backfill beside a table that changes all the while: what a consumer ends up with is the table."""

import random

import pytest

from flowtide.control_store import DONE, ControlStore
from flowtide.operators import consume, merge
from flowtide.plans.scratch import settle
from flowtide.streaming.backfill import PREFIX, Backfill, Source, Waiting
from pyspark.sql import Row
from pyspark.sql import functions as F

EVENT = "table string, op string, origin string, key string, key_json string, commit_lsn long, seq int, xid long, is_partial boolean, a string, b string"
RELATION = Row(rel_oid=77, valid_from_lsn=0, schema_name="public", table_name="t", replica_identity="d", columns=[Row(name="id", oid=20, is_key=True), Row(name="a", oid=25, is_key=False), Row(name="b", oid=25, is_key=False)])


class Database:
    """A table, its log, and a few transactions between any two calls."""

    def __init__(self, spark, seed, rows=14, churn=2):
        self.spark, self.rng, self.churn = spark, random.Random(seed), churn
        self.table = {i: [f"a{i}", f"b{i}"] for i in range(rows)}
        self.lsn, self.xid, self.log, self.markers, self.n, self.behind = 1000, 50, [], [], 0, 0

    def event(self, op, key, partial=False, origin=None, seq=0):
        a, b = self.table.get(key, [None, None]) if op != "delete" else (None, None)
        self.log.append(("public.t", op, origin, str(key), f'{{"id":{key}}}', self.lsn, seq, self.xid, partial, a, None if partial else b))

    def step(self):
        for _ in range(self.churn):
            self.n, self.lsn, self.xid = self.n + 1, self.lsn + 10, self.xid + 1
            kind = self.rng.choice(["insert", "update", "partial", "delete", "move"])
            if kind == "insert" or len(self.table) < 5:
                self.table[100 + self.n] = [f"new{self.n}", "b"]
                self.event("insert", 100 + self.n)
                continue
            key = self.rng.choice(sorted(self.table))
            if kind == "delete":
                self.event("delete", key)
                del self.table[key]
            elif kind == "move":
                to = self.rng.choice([-self.n, 500 + self.n])
                self.event("delete", key, origin="update")
                self.table[to] = [f"m{self.n}", self.table.pop(key)[1]]
                self.event("insert", to, True, "update", 1)
            else:
                self.table[key] = [f"u{self.n}", self.table[key][1] if kind == "partial" else f"w{self.n}"]
                self.event("update", key, kind == "partial")

    def snapshot(self):
        d = self.spark.createDataFrame([(k, *v) for k, v in sorted(self.table.items())], "id long, a string, b string")
        at = self.xid + 1
        self.step()
        self.behind, late = max(self.behind - 1, 0), self.behind > 0
        return d, 1 if late else at

    def emit(self, content):
        self.step()
        self.lsn += 10
        self.markers.append((self.lsn, False, PREFIX, content))
        at = self.lsn
        self.step()
        return at

    def events(self, since, upto):
        return self.spark.createDataFrame([e for e in self.log if since <= e[5] < upto], EVENT)

    def source(self):
        return Source(self.snapshot, lambda: self.xid + 1, self.emit, self.events)


def consumer(spark, database, delivered):
    stream = spark.createDataFrame(database.log, EVENT).withColumns({"pos_lsn": F.col("commit_lsn"), "is_stream": F.lit(1), "backfill": F.lit(None).cast("string"), "arrival": F.lit(0)})
    reads = spark.createDataFrame(delivered, "key string, pos_lsn long, is_stream int, seq long, backfill string, a string, b string, arrival int").withColumns({"table": F.lit("public.t"), "op": F.lit("read")})
    e = settle(consume.dedupe(stream.withColumn("seq", F.col("seq").cast("long")).unionByName(reads, allowMissingColumns=True)))
    whole = F.col("op").isin("read", "insert", "update")
    sent = {"a": whole, "b": whole & ~F.coalesce("is_partial", F.lit(False))}
    got = consume.materialise(e, "key", {"a": F.col("a"), "b": F.col("b")}, sent, moved=consume.moves(e), checkpoint=settle)
    return {int(r.key): [r.a, r.b] for r in got.collect()}


@pytest.mark.parametrize("seed,kill", [(1, None), (2, 2)])
def test_converges_even_if_killed_between_chunks(spark, tmp_path, seed, kill):
    db, store, delivered, calls = Database(spark, seed), ControlStore(spark, str(tmp_path)), [], []

    def deliver(reads):
        calls.append(1)
        delivered.extend((str(r.id), r.pos_lsn, r.is_stream, r.seq, r.backfill, r.a, r.b, len(calls)) for r in reads.collect())
        if len(calls) == kill:
            raise ConnectionError("the sink is gone")

    make = lambda: Backfill(db.source(), store, "s", 0, RELATION, deliver, rows=5, poll=0, attempts=3)
    if kill:
        with pytest.raises(ConnectionError):
            make().run()
        before = store.progress("s", "public.t")
        assert before.status != DONE and before.upper and before.rows == 5  # the chunk whose delivery failed is not in it
    db.behind = 2  # two snapshots that don't see all yet
    b = make()
    try:
        b.run()
    except Waiting:
        db.churn = 0
        b = make()
        b.run()
    db.churn = 0
    assert b.complete_moves(0, db.lsn + 1) is None
    assert store.progress("s", "public.t").status == DONE
    n = len(calls)
    assert make().run().status == DONE and len(calls) == n
    assert consumer(spark, db, delivered) == db.table
    own = merge.own_markers(spark.createDataFrame([*db.markers, (1, False, PREFIX, "{"), (2, True, PREFIX, db.markers[-1][3]), (3, False, "other", db.markers[-1][3])], "lsn long, transactional boolean, prefix string, content string"), PREFIX, b.nonce)
    kinds = [r.kind for r in own.orderBy("lsn").collect()]
    assert kinds[0] == "track" and set(kinds[1:]) == {"chunk"} and len(kinds) - 1 == b.number


def test_an_empty_table_and_moves_that_stay_owed(spark, tmp_path):
    db, store, delivered = Database(spark, 3, rows=0, churn=0), ControlStore(spark, str(tmp_path)), []
    make = lambda attempts: Backfill(db.source(), store, "s", 0, RELATION, lambda r: delivered.extend(r.collect()), poll=0, attempts=attempts)
    assert make(1).run().status == DONE and not delivered
    db.table = {1: ["a", "b"]}
    db.lsn, db.xid = db.lsn + 10, db.xid + 1
    moved = db.lsn
    db.event("delete", 9, origin="update")
    db.event("insert", 1, True, "update", 1)
    b = make(1)
    b.track()
    was = db.emit

    def emit(content):  # the row changes again between snapshot and marker
        db.lsn, db.xid = db.lsn + 10, db.xid + 1
        db.event("update", 1, True)
        return was(content)

    b.source.emit = emit
    assert b.complete_moves(0, moved + 1) == moved and not delivered
    b.source.emit = was
    assert b.complete_moves(0, moved + 1) is None and [(r.id, r.b) for r in delivered] == [(1, "b")]


def test_a_snapshot_that_never_sees_all_is_an_error(spark, tmp_path):
    db = Database(spark, 4, churn=0)
    db.behind = 1000
    with pytest.raises(Waiting):
        Backfill(db.source(), ControlStore(spark, str(tmp_path)), "s", 0, RELATION, lambda r: None, poll=0, patience=-1).run()
