"""Control-plane decisions and tables as expressions and joins."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def slot_action(exists: Column, known: Column, generation: Column, requested: Column) -> Column:
    """keep, adopt, create, recreate (only if the next generation is named exactly) or refuse."""
    return F.when(exists & known, "keep").when(exists, "adopt").when(~known, "create").when(requested == generation + 1, "recreate").otherwise("refuse")


def qualified(tables: Column) -> Column:
    return F.array_sort(F.transform(tables, lambda t: F.when(F.instr(t, ".") == 0, F.concat(F.lit("public."), t)).otherwise(t)))


def publication_drifted(publishes_all: Column, wanted: Column, published: Column) -> Column:
    """Scope first: all tables against a list is drift even if both lists are empty."""
    wants_all = F.size(wanted) == 0
    return F.when(publishes_all | wants_all, publishes_all != wants_all).otherwise(qualified(wanted) != F.array_sort(published))


def upsert_progress(stored: DataFrame, registered: DataFrame) -> DataFrame:
    """Backfill progress after registration: a row starts anew if its table or its slot's generation is another; others stay."""
    s, r = stored.alias("s"), registered.alias("r")
    j = s.join(r, ["slot_name", "table_name"], "full_outer")
    anew = F.col("s.table_oid").isNull() | (F.col("s.table_oid") != F.col("r.table_oid")) | (F.col("s.slot_generation") != F.col("r.slot_generation"))
    anew = F.coalesce(anew & F.col("r.table_oid").isNotNull(), F.lit(False))
    pick = lambda c: F.when(anew, F.col(f"r.{c}")).otherwise(F.col(f"s.{c}")).alias(c)
    blank = lambda c: F.when(~anew, F.col(f"s.{c}")).alias(c)
    return j.select(
        "slot_name", "table_name", pick("table_oid"), pick("slot_generation"), F.when(anew, "running").otherwise(F.col("s.status")).alias("status"),
        blank("upper_key"), blank("last_key"), blank("pending_keys"), F.when(anew, 0).otherwise(F.col("s.rows_emitted")).cast("long").alias("rows_emitted"),
    )


def park(progress: DataFrame, parked: DataFrame) -> DataFrame:
    """Adds keys (slot_name, table_name, key, ord) to rows that aren't done; keys of tables without a row change nothing."""
    keys = parked.groupBy("slot_name", "table_name").agg(F.transform(F.sort_array(F.collect_list(F.struct("ord", "key"))), lambda x: x["key"]).alias("__new"))
    both = F.concat(F.coalesce("pending_keys", F.array().cast("array<string>")), F.col("__new"))
    put = F.col("__new").isNotNull() & (F.col("status") != "done")
    return progress.join(keys, ["slot_name", "table_name"], "left").withColumn("pending_keys", F.when(put, both).otherwise(F.col("pending_keys"))).drop("__new")


def slot_health(current: Column, restart: Column, confirmed: Column, safe: Column) -> dict[str, Column]:
    """Bytes that a slot retains and lags; null where a position isn't known."""
    return {"retained_bytes": current - restart, "lag_bytes": current - confirmed, "safe_bytes": safe}
