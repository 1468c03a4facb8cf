import random

from flowtide import queries as q
from flowtide.operators import ledger

SF = "/root/testdata/sf0.001"


def test_the_whole_log_is_packed(spark):
    """Against a plain loop over all events in order."""
    rows = q.packed(spark, SF).collect()
    assert len(rows) == q.events(spark, SF).count() == 2544
    batch, size, last = 0, 0, {}
    for r in rows:
        last[r.commit_lsn] = max(last.get(r.commit_lsn, 0), r.seq)
    want, acks = {}, {}
    for r in sorted(rows, key=lambda r: (r.commit_lsn, r.seq)):
        assert r.bytes == len(r.value_json.encode()) + 1
        want[r.commit_lsn, r.seq] = batch
        acks[batch] = max(acks.get(batch, 0), r.end_lsn if r.seq == last[r.commit_lsn] else 0)
        size += r.bytes
        if size >= q.MAX_BYTES:
            batch, size = batch + 1, 0
    assert {(r.commit_lsn, r.seq): r.batch for r in rows} == want
    assert {r.batch: r.ack_lsn for r in ledger.ack_of_batches(q.packed(spark, SF)).collect()} == acks


def test_ranges_chain_into_the_batches_of_a_plain_loop(spark):
    """Streams that span many ranges or share one, rows of no bytes and rows above the limit, against a loop."""
    rng, rows = random.Random(7), []
    for stream, n in (("a", 4000), ("b", 1), ("c", 37), ("ü", 900)):
        rows += [(stream, i * 3, rng.choice((0, 1, 7, 60, 300)) if rng.random() < 0.99 else 5000, f"{stream}{i}") for i in range(n)]
    want = {}
    for stream in "abcü":
        batch = size = 0
        for _, pos, n, _ in sorted(r for r in rows if r[0] == stream):
            want[stream, pos] = batch
            size += n
            if size >= 1000:
                batch, size = batch + 1, 0
    rng.shuffle(rows)
    d = spark.createDataFrame(rows, "stream string, pos long, bytes long, extra string")
    was = spark.conf.get("spark.sql.shuffle.partitions"), spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    try:
        spark.conf.set("spark.sql.shuffle.partitions", "13")
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
        got = ledger.pack(d, 1000).collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", was[0])
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", was[1])
    assert len(got) == len(rows) and {(r.stream, r.pos): r.batch for r in got} == want
    assert all(r.extra == f"{r.stream}{r.pos // 3}" for r in got)
    assert ledger.pack(d.limit(0), 1000).count() == 0
