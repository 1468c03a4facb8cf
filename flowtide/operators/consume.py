"""What a consumer does with a replayed stream: first arrivals, the table's latest state, histories, gaps, order checks.

A position is (pos_lsn, is_stream, seq): a read stands at its marker, before the transaction that has the same LSN.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

POSITION = ("pos_lsn", "is_stream", "seq")


def dedupe(events: DataFrame, arrival: str = "arrival") -> DataFrame:
    """The first arrival of each event. Stream events go by (commit_lsn, seq), reads by (backfill, seq); the two never meet."""
    ident = ["backfill", F.when(F.col("backfill").isNull(), F.col("commit_lsn")), "seq"]
    w = Window.partitionBy(*ident).orderBy(arrival)
    return events.withColumn("__rn", F.row_number().over(w)).where("__rn = 1").drop("__rn")


def is_base() -> Column:
    """Whether an event starts a row anew under its key: all but an update, which patches, and the delete half of a key change, which takes the row away."""
    return F.col("op").isin("read", "insert") | ((F.col("op") == "delete") & (F.coalesce("origin", F.lit("")) == ""))


def moves(events: DataFrame, key: str = "key") -> DataFrame:
    """old_key, new_key, commit_lsn, seq, out and came of each key change: its delete half (at `out`) is the event before its insert half (at `came`)."""
    half = events.where("origin = 'update'")
    at = F.struct(*POSITION)
    before = half.where("op = 'delete'").select("commit_lsn", (F.col("seq") + 1).alias("seq"), F.col(key).alias("old_key"), at.alias("out"))
    after = half.where("op = 'insert'").select("commit_lsn", "seq", F.col(key).alias("new_key"), at.alias("came"))
    return before.join(after, ["commit_lsn", "seq"])


def ancestry(events: DataFrame, moved: DataFrame, key: str = "key", values: dict[str, Column] | None = None, checkpoint=None) -> DataFrame:
    """For each move: new_key, came, the row's first key (root), where the row began under its old key (began), and v_<name>: the last value
    of each column (wrapped, null if none was sent) that the row had before the move, wherever its earlier moves led.

    A row's life under one key lasts from a base event to the move that takes it away, so a key that is used again has several lives.
    A move's parent is the move that began the life it ends, if a move did. Positions fall along parents, so there is no cycle, and
    pointers that jump double the distance in each round: chains of n moves take log n rounds. `checkpoint` cuts the plan between rounds.
    """
    cut = checkpoint or (lambda df: df)
    names = list(values or {})
    at = F.struct(*POSITION)
    e = events.where("op <> 'truncate'").select(F.col(key).alias("old_key"), at.alias("at"), F.when(is_base(), at).alias("base"), *((values or {})[c].alias(f"v_{c}") for c in names))
    m = moved.select("old_key", "new_key", "out", "came")
    latest = [F.max(F.when(F.col(f"v_{c}").isNotNull(), F.struct("at", f"v_{c}"))).alias(f"v_{c}") for c in names]
    seen = m.join(e, "old_key", "left").where(F.col("at").isNull() | (F.col("at") < F.col("out")))
    lives = m.join(seen.groupBy("new_key", "came").agg(F.max("base").alias("began"), *latest), ["new_key", "came"], "left")
    own = [F.when(F.col("began").isNull() | (F.col(f"v_{c}.at") >= F.col("began")), F.col(f"v_{c}.v_{c}")).alias(f"v_{c}") for c in names]
    lives = cut(lives.select("new_key", "came", "old_key", "began", *own))
    up = lives.alias("a").join(lives.select(F.col("new_key").alias("k"), F.col("came").alias("c")).alias("b"), F.expr("a.old_key = b.k and a.began = b.c"), "left")
    up = cut(up.select("a.*", F.col("a.old_key").alias("root"), F.col("b.k").alias("up_key"), F.col("b.c").alias("up_came")))
    while not up.where("up_key is not null").isEmpty():
        b = up.select(F.col("new_key").alias("k"), F.col("came").alias("c"), F.col("root").alias("r"), F.col("up_key").alias("uk"), F.col("up_came").alias("uc"), *(F.col(f"v_{c}").alias(f"w_{c}") for c in names))
        j = up.join(b, F.expr("up_key = k and up_came = c"), "left")
        up = cut(j.select("new_key", "came", "old_key", "began", *(F.coalesce(f"v_{c}", f"w_{c}").alias(f"v_{c}") for c in names), F.coalesce("r", "root").alias("root"), F.col("uk").alias("up_key"), F.col("uc").alias("up_came")))
    return up.drop("up_key", "up_came")


def materialise(events: DataFrame, key: str, columns: dict[str, Column], sent: dict[str, Column], moved: DataFrame | None = None, truncates: DataFrame | None = None, checkpoint=None, state: bool = False) -> DataFrame:
    """The table that applying the events in order gives: key and columns.

    events hold each event once. A read, an insert or a delete starts a row anew, an update patches what it sent. The insert half
    of a key change goes on with the row that its delete half took away: of `moved` rows, what came without a value has it from
    the lives before (ancestry). A truncate ends every row of its table that came before it. Values are wrapped so that a null that was
    sent counts. With `state`, deleted keys are rows too (deleted), and `at` is the position of a key's last event.

    One aggregation by key, combined before the shuffle: a column's last value counts if it is no older than the key's last base.
    """
    names = list(columns)
    e = events.where("op <> 'truncate'")
    if truncates is not None:
        last = truncates.groupBy("table").agg(F.max(F.struct(*POSITION)).alias("__t"))
        e = e.join(last, "table", "left").where(F.col("__t").isNull() | (F.struct(*POSITION) > F.col("__t"))).drop("__t")
    at = F.struct(*POSITION)
    wrapped = {c: F.when(sent[c], F.struct(columns[c].alias("v"))) for c in names}
    d = e.select(F.col(key).alias("__key"), at.alias("__at"), F.when(is_base(), at).alias("__base"), "op", *(F.when(w.isNotNull(), F.struct(at.alias("at"), w.alias("w"))).alias(f"v_{c}") for c, w in wrapped.items()))
    one = d.groupBy("__key").agg(F.max("__base").alias("__base"), F.max(F.struct("__at", F.col("op") == "delete")).alias("__last"), *(F.max_by(f"v_{c}", f"v_{c}.at").alias(f"v_{c}") for c in names))
    own = [F.when(F.col("__base").isNull() | (F.col(f"v_{c}.at") >= F.col("__base")), F.col(f"v_{c}.w")).alias(f"v_{c}") for c in names]
    one = one.select("__key", "__base", F.col("__last.__at").alias("at"), F.col("__last.col2").alias("deleted"), *own)
    if moved is not None:
        before = ancestry(e, moved, key, wrapped, checkpoint).select(F.col("new_key").alias("__k"), F.col("came").alias("__c"), *(F.col(f"v_{c}").alias(f"w_{c}") for c in names))
        one = one.join(before, F.expr("__key = __k and __base = __c"), "left").select("__key", "at", "deleted", *(F.coalesce(f"v_{c}", f"w_{c}").alias(f"v_{c}") for c in names))
    out = [F.col("__key").alias(key), *(F.when(~F.col("deleted"), F.col(f"v_{c}")["v"]).alias(c) for c in names)]
    return one.select(*out, "at", "deleted") if state else one.where("not deleted").select(*out)


def history(events: DataFrame, key: str, moved: DataFrame, checkpoint=None) -> DataFrame:
    """Every event of the rows whose key ever changed, with root, the row's first key; a key's other lives are left out.

    Only events of keys that took part in a move are ordered, key by key.
    """
    lives = ancestry(events, moved, key, None, checkpoint)
    zero = F.struct(*(F.lit(-1).cast(events.schema[c].dataType).alias(c) for c in POSITION))
    came = lives.select(F.col("new_key").alias(key), F.col("came").alias("__began"), "root")
    first = lives.where(F.col("old_key") == F.col("root")).select(F.col("old_key").alias(key), F.coalesce("began", zero).alias("__began"), "root")
    every = came.unionByName(first).groupBy(key, "__began").agg(F.min("root").alias("root"))
    e = events.where("op <> 'truncate'").join(every.select(key).distinct(), key, "left_semi")
    began = F.max(F.when(is_base(), F.struct(*POSITION))).over(Window.partitionBy(key).orderBy(*POSITION).rowsBetween(Window.unboundedPreceding, 0))
    return e.withColumn("__began", F.coalesce(began, zero)).join(every, [key, "__began"]).drop("__began")


def gaps(first_arrivals: DataFrame, ident: str, order: str) -> DataFrame:
    """Of ids that count up from 0: how many came in, and the first that is missing (null if none is)."""
    ids = first_arrivals.select(F.col(ident).alias("id")).distinct()
    following = ids.alias("a").join(ids.alias("b"), F.expr("b.id = a.id + 1"), "left_anti").agg(F.min(F.col("id") + 1).alias("after"))
    total = ids.agg(F.count("*").alias("n"), F.max("id").alias("top"), F.min("id").alias("low"))
    first = F.when(F.col("low") > 0, F.lit(0)).when(F.col("after") <= F.col("top"), F.col("after"))
    return total.crossJoin(following).select(F.col("n").alias("arrived"), first.cast("long").alias("first_missing"))  # two single rows


def order_violations(events: DataFrame, key: str, partition: Column) -> DataFrame:
    """For each key: events, partitions that saw it, and places where order goes back."""
    w = Window.partitionBy(key).orderBy("arrival")
    p = F.struct(*POSITION)
    return events.withColumn("__p", p).withColumn("__b", F.lag("__p").over(w)).withColumn("__part", partition).groupBy(key).agg(
        F.count("*").alias("n_events"), F.countDistinct("__part").alias("n_partitions"), F.sum((F.coalesce(F.col("__b") > F.col("__p"), F.lit(False))).cast("long")).alias("n_backward")
    )


def ops_per_key(events: DataFrame, key: str) -> DataFrame:
    """The operations of each key in order."""
    ops = F.transform(F.sort_array(F.collect_list(F.struct(*POSITION, "op"))), lambda x: x["op"])
    return events.groupBy(key).agg(F.array_join(ops, ",").alias("ops"))
