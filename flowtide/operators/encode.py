"""Raw changes to events: relation lookup, filters, key-change split, truncate fan-out, sequence numbers, keys, JSON."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, Row, Window
from pyspark.sql import functions as F

from ..functions import codec


def with_relation(changes: DataFrame, relations: DataFrame) -> DataFrame:
    """A row for each relation that a change names, joined to the relation as it was at the change.

    Relation versions of one table follow each other in valid_from_lsn, so the join is by key and range and finds one
    version at most. A change of a relation that isn't known keeps a null table.
    """
    w = Window.partitionBy("rel_oid").orderBy("valid_from_lsn")
    versions = relations.withColumn("valid_to_lsn", F.lead("valid_from_lsn").over(w))
    versions = versions.withColumn("keyed", (F.col("replica_identity") != "f") & F.exists("columns", lambda c: c["is_key"]))
    one = changes.select("*", F.posexplode("rel_oids").alias("half", "rel_oid")).drop("rel_oids")
    c, v = one.alias("c"), versions.alias("v")
    at = (F.col("c.rel_oid") == F.col("v.rel_oid")) & (F.col("c.lsn") >= F.col("v.valid_from_lsn")) & (F.col("v.valid_to_lsn").isNull() | (F.col("c.lsn") < F.col("v.valid_to_lsn")))
    return c.join(v, at, "left").select("c.*", "v.valid_from_lsn", "v.schema_name", "v.table_name", "v.columns", "v.keyed")


def unknown_relations(changes: DataFrame, relations: DataFrame) -> DataFrame:
    """Changes of relations that were never described: an error in a stream."""
    one = changes.select("lsn", "op", F.explode("rel_oids").alias("rel_oid"))
    return one.join(relations.select("rel_oid").distinct(), "rel_oid", "left_anti")


def ignore_tables(changes: DataFrame, schema: str, tables: Iterable[str]) -> DataFrame:
    """Drops the engine's own tables, never a whole schema."""
    own = (F.col("schema_name") == schema) & F.col("table_name").isin(list(tables))
    return changes.where(~F.coalesce(own, F.lit(False)))


def published(changes: DataFrame, tables: Iterable[str] | None) -> DataFrame:
    """Only tables of the publication; names without a schema are public's. None publishes all. Changes of unknown relations stay, to be found."""
    if tables is None:
        return changes
    names = [t if "." in t else f"public.{t}" for t in tables]
    return changes.where(F.col("table_name").isNull() | F.concat("schema_name", F.lit("."), "table_name").isin(names))


#: Relations with expressions of their own; beyond that, cells are walked by lambdas.
FEW = 40


def by_relation(known: list[Row], one, other: Column) -> Column:
    """one(relation) where a change has that relation version, else `other`."""
    out = other
    for r in known:
        out = F.when((F.col("rel_oid") == r.rel_oid) & (F.col("valid_from_lsn") == r.valid_from_lsn), one(r)).otherwise(out)
    return out


def key_changed(known: list[Row] | None = None) -> Column:
    """An update whose old key was sent and differs in a key column, byte for byte."""
    pairs = F.zip_with("columns", F.zip_with("old", "new", lambda a, b: F.struct(a.alias("a"), b.alias("b"))), lambda c, p: F.struct(c.alias("c"), p.alias("p")))
    differs = F.exists(pairs, lambda x: x["c"]["is_key"] & (x["p"]["b"]["kind"] == "t") & ~x["p"]["a"]["value"].eqNullSafe(x["p"]["b"]["value"]))

    def one(r: Row) -> Column:
        out = F.lit(False)
        for i, c in enumerate(r["columns"]):
            if c.is_key:
                a, b = F.get("old", F.lit(i)), F.get("new", F.lit(i))
                out = out | ((b["kind"] == "t") & ~a["value"].eqNullSafe(b["value"]))
        return out

    moved = (F.col("op") == "update") & F.col("keyed") & (F.col("old_kind") == "K")
    return F.coalesce(F.when(moved, by_relation(known, one, F.lit(False)) if known else differs), F.lit(False))


def split_key_changes(changes: DataFrame, known: list[Row] | None = None) -> DataFrame:
    """An update that changes the key becomes a delete under the old key and an insert under the new one."""
    none = F.lit(None).cast("array<struct<kind:string,value:string>>")

    def half(n: Column, op: Column, origin, old: Column, new: Column, previous: Column) -> Column:
        return F.struct(n.cast("int").alias("half"), op.alias("op"), F.lit(origin).cast("string").alias("origin"), old.alias("old"), new.alias("new"), previous.alias("previous"))

    both = F.array(half(F.lit(0), F.lit("delete"), "update", F.col("old"), none, none), half(F.lit(1), F.lit("insert"), "update", none, F.col("new"), F.col("old")))
    same = F.array(half(F.col("half"), F.col("op"), None, F.col("old"), F.col("new"), F.col("old")))
    rest = [c for c in changes.columns if c not in ("half", "op", "old", "new")]
    return changes.select(*rest, F.inline(F.when(key_changed(known), both).otherwise(same)))


def number(events: DataFrame) -> DataFrame:
    """seq counts the events of a transaction from 0, after filters and splits. Transactions at one position are numbered together; of their equal places, the older's comes first."""
    w = Window.partitionBy("commit_lsn").orderBy("lsn", "half", "xid")
    return events.withColumn("seq", (F.row_number().over(w) - 1).cast("long"))


def _width_checked(cells: Column, width: Column) -> Column:
    wrong = F.raise_error(F.lit("a tuple has not as many columns as its relation")).cast("array<struct<kind:string,value:string>>")
    return F.when(cells.isNull() | (F.size(cells) == width), cells).otherwise(wrong)


def _generic() -> dict[str, Column]:
    """unsent names, key, old and new image of any relation, by lambdas over its columns."""
    columns, key_only = F.col("columns"), F.col("old_kind") == "K"
    unsent = lambda cells: F.transform(F.filter(F.zip_with(columns, cells, lambda c, v: F.struct(c["name"].alias("n"), v["kind"].alias("k"))), lambda p: p["k"] == "u"), lambda p: p["n"])
    empty = F.array().cast("array<string>")
    identity = F.coalesce("new", "old")
    return {
        "unchanged": F.concat(F.coalesce(F.when(key_only, empty).otherwise(unsent(F.col("old"))), empty), F.coalesce(unsent(F.col("new")), empty)),
        "key_json": codec.key_json(columns, identity, F.when(F.col("new").isNotNull(), F.col("previous"))),
        "old_json": codec.json_object(columns, F.col("old"), lambda c: ~F.coalesce(key_only, F.lit(False)) | c["is_key"]),
        "new_json": codec.json_object(columns, F.col("new")), "quoted": codec.json_quote(F.col("table")), "width": F.size(columns), "names": F.array_join(F.transform("unchanged", codec.json_quote), ","),
    }


def _straight(r: Row) -> dict[str, Column]:
    """The same for one relation, cell by cell, which Spark compiles."""
    key_only = F.coalesce(F.col("old_kind") == "K", F.lit(False))
    cells = lambda of: [(c, F.get(of, F.lit(i))) for i, c in enumerate(r["columns"])]
    none = F.lit("")

    def unsent(of: str) -> Column:
        return F.array_remove(F.array(*(F.when(v["kind"] == "u", F.lit(c.name)).otherwise(none) for c, v in cells(of))), "")

    def image(of: str, only_keys: Column | None = None) -> Column:
        parts = []
        for c, v in cells(of):
            there = v["kind"] != "u"
            if only_keys is not None and not c.is_key:
                there = there & ~only_keys
            parts.append(F.when(there, F.concat(F.lit(codec.quoted(c.name) + ":"), codec.typed_json(c.oid, v["value"]))))
        return F.concat(F.lit("{"), F.concat_ws(",", *parts), F.lit("}"))

    def key() -> Column:
        parts = []
        for i, c in enumerate(r["columns"]):
            if c.is_key:
                new, old, before = (F.get(x, F.lit(i)) for x in ("new", "old", "previous"))
                v = F.when(F.col("new").isNull(), F.when(old["kind"] == "t", old["value"])).when(new["kind"] == "t", new["value"]).when(before["kind"] == "t", before["value"])
                missing = F.raise_error(F.lit("a key column has no value in the change")).cast("string")
                parts.append(F.concat(F.lit(codec.quoted(c.name) + ":"), F.when(v.isNull(), missing).otherwise(codec.typed_json(c.oid, v))))
        return F.concat(F.lit("{"), F.concat_ws(",", *parts), F.lit("}"))

    empty = F.array().cast("array<string>")
    return {
        "unchanged": F.concat(F.when(key_only | F.col("old").isNull(), empty).otherwise(unsent("old")), F.when(F.col("new").isNull(), empty).otherwise(unsent("new"))),
        "key_json": key(), "old_json": image("old", key_only), "new_json": image("new"), "quoted": F.lit(codec.quoted(f"{r.schema_name}.{r.table_name}")),
        "width": F.lit(len(r["columns"])), "names": F.concat_ws(",", *(F.when(~key_only & F.col("old").isNotNull() & (v["kind"] == "u"), F.lit(codec.quoted(c.name))) for c, v in cells("old")), *(F.when(v["kind"] == "u", F.lit(codec.quoted(c.name))) for c, v in cells("new"))),
    }


def render(events: DataFrame, known: list[Row] | None = None) -> DataFrame:
    """Adds table, unchanged, is_partial, key_json, old_json, new_json and value_json, the event as one line of JSON.

    known: the relation versions, whose expressions then are straight lines over their own cells.
    """
    table = F.concat("schema_name", F.lit("."), "table_name")
    identity = F.coalesce("new", "old")
    if known:
        each = [(r, _straight(r)) for r in known]
        pick = lambda name: by_relation(known, lambda r: next(x[name] for s, x in each if s is r), F.lit(None))
        made = {name: pick(name) for name in each[0][1]}
    else:
        made = _generic()
    e = events.withColumns({c: _width_checked(F.col(c), made["width"]) for c in ("old", "new")}).withColumn("table", table)
    e = e.withColumns({
        "unchanged": made["unchanged"], "key_json": F.when(F.col("keyed") & identity.isNotNull(), made["key_json"]).otherwise(made["quoted"]),
        "old_json": F.when(F.col("old").isNotNull(), made["old_json"]), "new_json": F.when(F.col("new").isNotNull(), made["new_json"]),
    })
    part = lambda name, value: F.coalesce(F.concat(F.lit(f',"{name}":'), value), F.lit(""))
    names = F.when(F.size("unchanged") > 0, F.concat(F.lit("["), made["names"], F.lit("]")))
    value = F.concat(
        F.lit('{"table":'), made["quoted"], F.lit(',"op":"'), "op", F.lit('","lsn":"'), codec.lsn_text(F.col("lsn")), F.lit('","commit_lsn":"'), codec.lsn_text(F.col("commit_lsn")),
        F.lit('","seq":'), F.col("seq").cast("string"), F.lit(',"txid":'), F.col("xid").cast("string"), F.lit(',"ts":"'), codec.rfc3339(F.col("commit_ts")), F.lit('"'),
        part("origin", F.concat(F.lit('"'), F.col("origin"), F.lit('"'))), part("old", F.col("old_json")), part("new", F.col("new_json")), part("unchanged", names), F.lit("}"),
    )
    return e.withColumn("value_json", value).withColumn("is_partial", F.size("unchanged") > 0)


def render_reads(rows: DataFrame, relation: Row, lsn: Column, backfill: Column, seq: Column, ts: Column) -> DataFrame:
    """Rows of a chunk (each of the relation's columns in text form, null for null) as read events: adds table, op, key_json, new_json, value_json.

    A read has a backfill id in place of a commit position and transaction, as its marker's position may equal the next commit's.
    """
    table = f"{relation.schema_name}.{relation.table_name}"
    text = lambda c: F.concat(F.lit(codec.quoted(c.name) + ":"), codec.typed_json(c.oid, F.col(f"`{c.name}`").cast("string")))
    missing = F.raise_error(F.lit("a key column has no value in the row")).cast("string")
    keys = [F.when(F.col(f"`{c.name}`").isNull(), missing).otherwise(text(c)) for c in relation["columns"] if c.is_key]
    new = F.concat(F.lit("{"), F.concat_ws(",", *(text(c) for c in relation["columns"])), F.lit("}"))
    key = F.concat(F.lit("{"), F.concat_ws(",", *keys), F.lit("}")) if keys and relation.replica_identity != "f" else F.lit(codec.quoted(table))
    value = F.concat(
        F.lit('{"table":' + codec.quoted(table) + ',"op":"read","lsn":"'), codec.lsn_text(lsn), F.lit('","backfill":'), codec.json_quote(backfill), F.lit(',"seq":'), seq.cast("string"),
        F.lit(',"ts":"'), codec.rfc3339(ts), F.lit('","new":'), F.col("new_json"), F.lit("}"),
    )
    return rows.withColumns({"table": F.lit(table), "op": F.lit("read"), "key_json": key, "new_json": new}).withColumn("value_json", value)


def encode(changes: DataFrame, relations: DataFrame, ignore: tuple[str, Iterable[str]] | None = None, tables: Iterable[str] | None = None) -> DataFrame:
    """Raw changes to numbered, rendered events. A change of a relation that was never described is an error, whatever is published."""
    known = relations.limit(FEW + 1).collect()
    known = known if len(known) <= FEW else None
    c = published(with_relation(changes, relations), tables)
    if ignore:
        c = ignore_tables(c, *ignore)
    unknown = F.raise_error(F.concat(F.lit("unknown relation id "), F.col("rel_oid").cast("string"))).cast("string")
    c = c.withColumn("table_name", F.when(F.col("table_name").isNull(), unknown).otherwise(F.col("table_name")))
    c = split_key_changes(c, known)
    return render(number(c.drop("columns") if known else c), known)  # descriptions need not go through the shuffle


def cell(cells: str, index: int) -> Column:
    """The value of a cell by its column's place."""
    return F.col(cells)[index]["value"]


def sent(cells: str, index: int) -> Column:
    return F.coalesce(F.col(cells)[index]["kind"] != "u", F.lit(False))
