"""A deterministic change log derived from the driver's tables; positions are arithmetic on the row's key.

Phases: 0 inserts, 1 and 2 updates (complete images and patches), 3 and 5 key changes, 4 deletes, 6 a truncate
of two tables, 7 inserts after it. Row k of orders goes to transaction k div 100 of a phase, at place k mod 100.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schema import INT8, NUMERIC, RAW_CHANGE, RELATION, TEXT

BASE, PHASE, TX, STEP = 16777216, 1 << 32, 65536, 64
ORDERS, PART, SUPPLIER, SLOTS = 100, 101, 102, 900
STATE_SCHEMA, STATE_TABLES = "cdc_state", ("slots", "backfills")
SNAPSHOT_XMIN = 1000 + 2 * 1_000_000
CHUNK_LSN = BASE + 3 * PHASE - 2 * TX
REREAD_LSN = CHUNK_LSN + TX
CHUNK_ROWS = 1000
MOVED = 10_000_000

ORDERS_COLUMNS = [("o_orderkey", INT8, True), ("o_orderstatus", TEXT, False), ("o_totalprice", NUMERIC, False), ("o_orderpriority", TEXT, False)]
PART_COLUMNS = [("p_partkey", INT8, True), ("p_name", TEXT, False)]


def relations(spark: SparkSession) -> DataFrame:
    rows = [
        (ORDERS, 0, "public", "orders", "d", ORDERS_COLUMNS),
        (PART, 0, "public", "part", "d", PART_COLUMNS),
        (SUPPLIER, 0, "public", "supplier", "d", [("s_suppkey", INT8, True)]),
        (SLOTS, 0, STATE_SCHEMA, "slots", "d", [("slot_name", TEXT, True)]),
    ]
    return spark.createDataFrame(rows, RELATION)


def position(p: int, g: Column, i: Column, extra: int = 0) -> dict[str, Column]:
    """Where a message stands: its transaction's ids and its own LSN."""
    g, i = g.cast("long"), i.cast("long")
    commit = F.lit(BASE + p * PHASE) + g * TX
    micros = (F.lit(1789898400 + p * 3600) + g) * 1_000_000 + (g * 125_000) % 1_000_000
    return {
        "lsn": commit - TX + STEP + i * STEP + extra, "xid": F.lit(1000 + p * 1_000_000) + g, "commit_lsn": commit, "end_lsn": commit + 48,
        "commit_ts": F.timestamp_micros(micros),
    }


def phase_of(xid: Column) -> Column:
    return F.floor((xid - 1000) / 1_000_000)


def text(value: Column) -> Column:
    """A cell: text, or null."""
    return F.struct(F.when(value.isNull(), "n").otherwise("t").alias("kind"), value.cast("string").alias("value"))


def unchanged() -> Column:
    return F.struct(F.lit("u").alias("kind"), F.lit(None).cast("string").alias("value"))


def _row(p: int, g: Column, i: Column, oid: Column, op: str, new=None, old=None, extra: int = 0) -> Column:
    none = F.lit(None)
    cells = lambda c: none.cast("array<struct<kind:string,value:string>>") if c is None else F.array(*c)
    fields = position(p, g, i, extra) | {
        "rel_oids": oid, "op": F.lit(op), "old_kind": F.lit("K") if old else none.cast("string"), "old": cells(old), "new": cells(new),
    }
    return F.struct(*(v.alias(k) for k, v in fields.items()))


def order_state(orders: DataFrame) -> DataFrame:
    """k and the columns' values at the start (0), after phase 1 and after phase 2."""
    k = F.col("o_orderkey")
    price = F.col("o_totalprice").cast("decimal(18,2)")
    s1 = F.when(k % 3 == 0, "X").otherwise(F.col("o_orderstatus"))
    return orders.select(
        k.alias("k"), F.col("o_orderstatus").alias("s0"), s1.alias("s1"), F.when((k % 7 == 3) & (k % 5 != 0), "Y").otherwise(s1).alias("s2"),
        price.alias("p0"), F.when(k % 5 == 0, (price + F.lit("1.00").cast("decimal(18,2)")).cast("decimal(18,2)")).otherwise(price).alias("p2"), F.when(k % 13 != 0, F.col("o_orderpriority")).alias("r"),
    )


def orders_log(orders: DataFrame, phases: tuple[int, ...] = (0, 1, 2, 3, 4, 5)) -> DataFrame:
    """Raw changes of public.orders, from one pass over orders."""
    k, s0, s1, s2, p0, p2, r = (F.col(c) for c in ("k", "s0", "s1", "s2", "p0", "p2", "r"))
    g, i, oid = F.floor(k / 100), k % 100, F.array(F.lit(ORDERS).cast("long"))
    kept = F.when(k % 6 == 0, unchanged()).otherwise(text(r))
    key_only = lambda key: [text(key), *[F.struct(F.lit("n").alias("kind"), F.lit(None).cast("string").alias("value"))] * 3]
    change = {
        0: [(k % 10 != 9, "insert", [text(k), text(s0), text(p0), text(r)], None)],
        1: [(k % 3 == 0, "update", [text(k), text(F.lit("X")), text(p0), kept], None)],
        2: [
            (k % 5 == 0, "update", [text(k), text(s1), text(p2), text(r)], None),
            ((k % 7 == 3) & (k % 5 != 0), "update", [text(k), text(F.lit("Y")), text(p0), unchanged()], None),
        ],
        3: [(k % 50 == 7, "update", [text(k + MOVED), text(s2), text(p2), unchanged()], key_only(k))],
        4: [((k % 11 == 5) & (k % 50 != 7), "delete", None, key_only(k))],
        5: [(k % 100 == 7, "update", [text(k + 2 * MOVED), text(s2), text(p2), unchanged()], key_only(k + MOVED))],
    }
    rows = [F.when(when, _row(p, g, i, oid, op, new, old)) for p in phases for when, op, new, old in change[p]]
    return order_state(orders).select(F.inline(F.filter(F.array(*rows), lambda x: x.isNotNull())))


def state_log(orders: DataFrame) -> DataFrame:
    """The engine's own bookkeeping, inside phase 0 transactions; it must leave no trace in the events."""
    g = F.floor(F.col("o_orderkey") / 100)
    return orders.where((F.col("o_orderkey") % 100 == 0) & (g % 10 == 0)).select(
        F.inline(F.array(_row(0, g, F.lit(50), F.array(F.lit(SLOTS).cast("long")), "update", [text(F.lit("slot"))], None, 32)))
    )


def truncate_log(spark: SparkSession) -> DataFrame:
    zero = F.lit(0)
    return spark.range(1).select(F.inline(F.array(_row(6, zero, zero, F.array(F.lit(PART).cast("long"), F.lit(SUPPLIER).cast("long")), "truncate"))))


def part_log(part: DataFrame) -> DataFrame:
    k = F.col("p_partkey")
    row = _row(7, F.floor(k / 100), k % 100, F.array(F.lit(PART).cast("long")), "insert", [text(k), text(F.col("p_name"))])
    return part.where(k % 2 == 0).select(F.inline(F.array(row)))


def whole_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    read = lambda t: spark.read.parquet(f"{sf_dir}/{t}.parquet")
    out = orders_log(read("orders"))
    for part in (state_log(read("orders")), truncate_log(spark), part_log(read("part"))):
        out = out.unionByName(part)
    return out


def empty_log(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], RAW_CHANGE)
