"""The source, deliveries that fail half way, and random interleavings that must converge."""

import json
import random

import pytest
from pyspark.sql import functions as F

from flowtide.operators import consume
from flowtide.plans.scratch import settle
from flowtide.sources import changelog
from flowtide.sources import pgoutput as pg
from flowtide.streaming import pipeline, sinks
from flowtide.streaming.pipeline import Materialiser


def transaction(xid, *messages):
    at = xid * 1000
    return [(at, pg.begin(at + 500, xid)), *((at + 1 + i, m) for i, m in enumerate(messages)), (at + 500, pg.commit(at + 500, at + 548))]


@pytest.fixture
def source(spark, tmp_path):
    spark.dataSource.register(changelog.ChangelogSource)
    folder = str(tmp_path / "log")
    rel = [(0, pg.relation(42, "public", "users", [("id", 20, True), ("name", 25, False)]))]
    for n in range(5):
        tx = [f for x in range(3) for f in transaction(1 + 3 * n + x, pg.insert(42, [str(3 * n + x), f"name {n}"]))]
        changelog.write_segment(folder, f"{n:06d}", (rel if not n else []) + tx)
    return folder


def test_batch_read(spark, source):
    f = spark.read.format("changelog").option("path", source).load()
    assert f.count() == 46 and pg.changes(f).count() == 15
    assert spark.read.format("changelog").option("path", source + "/none").load().count() == 0


def test_delivery_survives_a_crash(spark, source, tmp_path):
    """A sink that dies after it delivered: the batch comes again, and dropping what came before leaves each event once."""
    got, failed = [], []

    def sink(batch, n):
        got.extend((n, r.commit_lsn, r.seq, r.value_json) for r in batch.orderBy("commit_lsn", "seq").collect())
        if n == 1 and not failed:
            failed.append(n)
            raise RuntimeError("lost after delivery")

    def start():
        f = spark.readStream.format("changelog").option("path", source).option("maxBytesPerTrigger", 1).option("ackPath", str(tmp_path / "ack")).load()
        return pipeline.deliver(f, sink, str(tmp_path / "c"), trigger={"processingTime": "0 seconds"})

    def run():
        q = start()
        q.processAllAvailable()
        q.stop()
        return q

    with pytest.raises(Exception, match="lost after delivery"):
        run()
    run()
    first = {}
    for n, lsn, seq, value in got:
        assert first.setdefault((lsn, seq), value) == value
    assert len(first) == 15 and len(got) > 15 and failed
    assert json.loads((tmp_path / "ack" / "ack.json").read_text())["lsn"] > 0
    assert [json.loads(v)["new"]["id"] for v in (first[k] for k in sorted(first))] == list(range(15))


def test_supervisor(spark):
    tries = []

    class Query:
        def __init__(self, error):
            self.error = error

        def awaitTermination(self):
            if self.error:
                raise self.error

    def start():
        tries.append(1)
        return Query(RuntimeError("passes") if len(tries) < 3 else None)

    pipeline.supervise(start, sleep=lambda _: None)
    assert len(tries) == 3
    with pytest.raises(sinks.Rejected):
        pipeline.supervise(lambda: Query(sinks.Rejected("no")), sleep=lambda _: None)


def test_text_writer_replaces_replays(spark, tmp_path):
    e = spark.createDataFrame([("k", 1, 1, 0, "a"), ("k", 2, 1, 0, "b"), ("j", 1, 1, 1, "c")], "key_json string, pos_lsn long, is_stream int, seq long, value_json string")
    write = sinks.text_writer(str(tmp_path / "out"))
    write(e, 0)
    write(e, 0)
    assert sorted(r.value for r in spark.read.text(str(tmp_path / "out" / "*")).collect()) == ["a", "b", "c"]


def workload(seed):
    """Random writes on a table, the stream they make, and a snapshot read at some point of it."""
    rng = random.Random(seed)
    table = {str(i): ["a", None, "bio"] for i in range(30)}
    snap_at, events, reads, lsn, fresh = rng.randrange(60, 120), [], [], 0, 1000
    for n in range(240):
        lsn += 1
        if n == snap_at:
            reads = [("read", None, k, lsn, 0, i, *v, True) for i, (k, v) in enumerate(sorted(table.items()))]
            continue
        keys = sorted(table)
        kind = rng.random()
        if kind < 0.4 and keys:
            k = rng.choice(keys)
            table[k][0], table[k][1] = rng.choice(["x", "y", None]), str(n)
            events.append(("update", None, k, lsn, 1, 0, table[k][0], table[k][1], None, False))
        elif kind < 0.6 and keys:
            k = rng.choice(keys)
            table[k] = [str(n), None, rng.choice([None, f"bio{n}"])]
            events.append(("update", None, k, lsn, 1, 0, *table[k], True))
        elif kind < 0.7 and keys:
            k = rng.choice(keys)
            del table[k]
            events.append(("delete", None, k, lsn, 1, 0, None, None, None, False))
        elif kind < 0.82 and keys:
            k, fresh = rng.choice(keys), fresh + 1
            free = [x for x in map(str, range(1, fresh + 1)) if x not in table]  # keys that were used before, too
            to = rng.choice(free)
            table[to] = table.pop(k)
            table[to][1] = str(n)
            events.append(("delete", "update", k, lsn, 1, 0, None, None, None, False))
            events.append(("insert", "update", to, lsn, 1, 1, *table[to][:2], None, False))
        else:
            fresh += 1
            to = rng.choice([x for x in map(str, range(1, fresh + 1)) if x not in table])
            table[to] = [str(n), "new", f"b{n}"]
            events.append(("insert", None, to, lsn, 1, 0, *table[to], True))
    return table, [e for e in events if e[3] > snap_at] + reads, events


@pytest.mark.parametrize("seed", range(3))
def test_convergence(spark, seed):
    """A consumer that has a snapshot and what came after it ends up with the table, replays or not."""
    table, log, _ = workload(seed)
    rng = random.Random(seed)
    again = rng.sample(log, 40)
    rows = [(*e, i) for i, e in enumerate([*log, *again])]
    e = spark.createDataFrame(rows, "op string, origin string, key string, pos_lsn long, is_stream int, seq long, a string, b string, bio string, has_bio boolean, arrival long")
    e = e.withColumn("commit_lsn", F.when(F.col("is_stream") == 1, F.col("pos_lsn"))).withColumn("backfill", F.when(F.col("is_stream") == 0, F.lit("1.0/1")))
    e = settle(consume.dedupe(e))
    columns = {c: F.col(c) for c in ("a", "b", "bio")}
    sent = {"a": F.col("op") != "delete", "b": F.col("op") != "delete", "bio": F.col("has_bio")}
    got = consume.materialise(e, "key", columns, sent, moved=consume.moves(e), checkpoint=settle)
    assert {r.key: [r.a, r.b, r.bio] for r in got.collect()} == table


def test_truncate_ends_all_before_it(spark):
    rows = [("insert", None, "1", 1, 1, 0, "a", "t"), ("truncate", None, None, 2, 1, 0, None, "t"), ("insert", None, "2", 3, 1, 0, "b", "t"), ("insert", None, "3", 1, 1, 1, "c", "u")]
    e = spark.createDataFrame(rows, "op string, origin string, key string, pos_lsn long, is_stream int, seq long, a string, table string")
    got = consume.materialise(e, "key", {"a": F.col("a")}, {"a": F.lit(True)}, truncates=e.where("op = 'truncate'"))
    assert {r.key for r in got.collect()} == {"2", "3"}


def change(op, origin, key, lsn, seq=0, a=None, b=None):
    return op, origin, key, lsn, 1, seq, lsn, a, b


CHANGE = "op string, origin string, key string, pos_lsn long, is_stream int, seq long, commit_lsn long, a string, b string"


def ab():
    return {c: F.col(c) for c in "ab"}, {c: F.col(c).isNotNull() for c in "ab"}


def move(old, new, lsn, a=None, b=None):
    return [change("delete", "update", old, lsn), change("insert", "update", new, lsn, 1, a, b)]


def test_long_chains_and_keys_that_come_back(spark):
    """A row that moves 60 times, between three keys at last, while others take the keys it left."""
    rows = [change("insert", None, "0", 1, 0, "a0", "b0")]
    for i in range(40):
        rows += move(str(i), str(i + 1), 10 + i)
    rows += [change("insert", None, "0", 100, 0, "other", "one")]
    for i in range(21):
        rows += move(("40", "x", "y")[i % 3], ("x", "y", "40")[i % 3], 200 + i)
    e = spark.createDataFrame(rows, CHANGE)
    got = {r.key: (r.a, r.b) for r in consume.materialise(e, "key", *ab(), moved=consume.moves(e), checkpoint=settle).collect()}
    assert got == {"40": ("a0", "b0"), "0": ("other", "one")}
    roots = consume.ancestry(e, consume.moves(e), checkpoint=settle).collect()
    assert len(roots) == 61 and {r.root for r in roots} == {"0"}
    h = consume.history(e, "key", consume.moves(e), settle).collect()
    assert len(h) == len(rows) - 1 and {r.root for r in h} == {"0"}


def test_state_ignores_what_it_has_seen(spark, tmp_path):
    """Events that come again in a later batch, and events of deleted and moved keys."""
    m = Materialiser(str(tmp_path / "state"), "key", *ab())
    first = [change("insert", None, "1", 1, 0, "a", "b"), change("insert", None, "2", 2, 0, "c", "d"), change("insert", None, "3", 3, 0, "e", "f")]
    second = [change("update", None, "1", 4, 0, "new"), change("delete", None, "2", 5), *move("3", "4", 6, "g")]
    for n, batch in enumerate([first, second, first + second, [*move("4", "3", 7), change("insert", None, "4", 8, 0, "h", "i")]]):
        m.write(spark.createDataFrame(batch, CHANGE), n)
    assert {r.key: (r.a, r.b) for r in m.version(spark, 2).collect()} == {"1": ("new", "b"), "4": ("g", "f")}
    assert {r.key: (r.a, r.b) for r in m.version(spark, 3).collect()} == {"1": ("new", "b"), "3": ("g", "f"), "4": ("h", "i")}
    assert not (tmp_path / "state/v=0").exists()
