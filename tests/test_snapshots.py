"""Chunks of wide tables over many ranges, ranges that reach the scan, byte budgets; changes of relations that nobody described."""

import pytest
from pyspark.sql import functions as F

from flowtide.operators import encode, merge, snapshot
from flowtide.plans import changelog as log


def test_every_row_of_a_wide_table_has_its_chunk(spark):
    """More than eight ranges, of which adaptive plans would join some and not others by what else is read beside the key."""
    settings = {"spark.sql.shuffle.partitions": "16", "spark.sql.adaptive.coalescePartitions.initialPartitionNum": "16", "spark.sql.adaptive.advisoryPartitionSizeInBytes": "2m"}
    before = {k: spark.conf.get(k) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        t = spark.range(30_000).select((F.col("id") * 7 % 30_000).alias("k"), F.repeat(F.sha2(F.col("id").cast("string"), 256), 16).alias("wide"))
        got = snapshot.chunk_ids(t, ["k"], 1000)
        assert got.select(F.shiftright("k", 0)).count() == 30_000
        assert got.where((F.floor(F.col("k") / 1000) != F.col("chunk")) | (F.col("k") % 1000 != F.col("row_in_chunk")) | (F.length("wide") != 1024)).count() == 0
        assert got.select("k").distinct().count() == 30_000
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def test_key_ranges_reach_the_scan(spark, tmp_path):
    spark.range(2000).select(F.col("id").alias("a"), (F.col("id") % 3).alias("b")).write.parquet(str(tmp_path / "t"))
    t = spark.read.parquet(str(tmp_path / "t"))
    c = snapshot.next_chunk(t, ["a", "b"], [500, 1], [900, 0], 50)
    plan = c._jdf.queryExecution().toString()
    assert "GreaterThanOrEqual(a,500)" in plan and "LessThanOrEqual(a,900)" in plan
    assert [r.a for r in c.collect()] == [r for r in range(500, 551) if (r, r % 3) > (500, 1)][:50]


def test_a_chunk_ends_with_its_bytes(spark):
    t = spark.createDataFrame([(i, "x" * 10) for i in range(20)], "k long, v string")
    size = F.length("v")
    rows = lambda n: [r.k for r in snapshot.next_chunk(t, ["k"], [3], None, 10, n, size).collect()]
    assert rows(25) == [4, 5, 6] and rows(1) == [4] and rows(1000) == list(range(4, 14))
    assert [r.ok for r in spark.createDataFrame([(5, 6), (6, 6)], "x long, f long").select(snapshot.gate(F.col("x"), F.col("f")).alias("ok")).collect()] == [False, True]


def test_an_unknown_relation_is_an_error_whatever_is_published(spark):
    known = log.relations(spark).where(F.col("rel_oid") != log.SUPPLIER)
    with pytest.raises(Exception, match="unknown relation id 102"):
        encode.encode(log.truncate_log(spark), known, tables=["part"]).collect()
    assert encode.encode(log.truncate_log(spark), log.relations(spark), tables=["part"]).count() == 1


def test_straight_lines_and_lambdas_render_alike(spark):
    cell = lambda kind, value=None: (kind, value)
    columns = [("id", 20, True), ('na"me', 25, False), ("f", 701, False), ("b", 16, False), ("j", 114, False), ("n", 1700, False)]
    relations = spark.createDataFrame([(1, 0, "public", "t", "d", columns)], log.RELATION)
    odd = 'q"\\ \x01 \x85  é\n'
    new = [cell("t", "1"), cell("t", odd), cell("t", "NaN"), cell("t", "t"), cell("t", '{"a":\r\n1}'), cell("t", "1.50")]
    part = [cell("t", "2"), cell("u"), cell("n"), cell("n"), cell("n"), cell("u")]
    old = [cell("t", "1"), *[cell("n")] * 5]
    rows = [(10, 1, 1, 2, [1], "insert", None, None, new), (11, 1, 1, 2, [1], "update", "K", old, part), (12, 1, 1, 2, [1], "update", None, None, part), (13, 1, 1, 2, [1], "delete", "O", new, None), (14, 1, 1, 2, [1], "truncate", None, None, None)]
    schema = log.RAW_CHANGE.replace("commit_ts timestamp, ", "")
    raw = spark.createDataFrame(rows, schema).withColumn("commit_ts", F.lit("2026-01-02 03:04:05").cast("timestamp"))
    c = encode.with_relation(raw, relations)
    known = relations.collect()
    names = ["seq", "op", "key_json", "old_json", "new_json", "unchanged", "is_partial", "value_json"]
    plain = encode.render(encode.number(encode.split_key_changes(c))).select(names).orderBy("seq").collect()
    straight = encode.render(encode.number(encode.split_key_changes(c, known)), known).select(names).orderBy("seq").collect()
    assert plain == straight and len(plain) == 6


def test_markers_and_guards(spark):
    m = spark.createDataFrame([(5, False, "flowtide", '{"nonce":"a","kind":"chunk","generation":1,"number":2}'), (6, False, "flowtide", "no json"), (7, True, "flowtide", '{"nonce":"a"}'), (8, False, "other", '{"nonce":"a"}'), (9, False, "flowtide", '{"nonce":"b"}')], "lsn long, transactional boolean, prefix string, content string")
    own = merge.own_markers(m, "flowtide", "a")
    assert [r.lsn for r in own.collect()] == [5]
    chunks = spark.createDataFrame([(1, 2, "x"), (2, 2, "y"), (1, 3, "z")], "generation long, number long, row string")
    assert [(r.row, r.marker_lsn) for r in merge.match_chunks(own, chunks).collect()] == [("x", 5)]
    touches = spark.range(10)
    assert merge.overflowed(touches, 9) and not merge.overflowed(touches, 10)
