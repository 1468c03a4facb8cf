"""Schemas of the change stream and the type OIDs that change its rendering."""

from __future__ import annotations

# PostgreSQL type OIDs.
BOOL, INT8, INT2, INT4, TEXT, OID, JSON, FLOAT4, FLOAT8, NUMERIC, JSONB = 16, 20, 21, 23, 25, 26, 114, 700, 701, 1700, 3802
INTEGERS, FLOATS = (INT2, INT4, INT8, OID), (FLOAT4, FLOAT8)

#: A cell is text ('t'), null ('n') or unchanged and not sent ('u').
CELLS = "array<struct<kind:string,value:string>>"
COLUMNS = "array<struct<name:string,oid:long,is_key:boolean>>"
#: One change as decoded, before it knows its table: a truncate names several relations, other changes one.
RAW_CHANGE = f"lsn long, xid long, commit_lsn long, end_lsn long, commit_ts timestamp, rel_oids array<long>, op string, old_kind string, old {CELLS}, new {CELLS}"
RELATION = f"rel_oid long, valid_from_lsn long, schema_name string, table_name string, replica_identity string, columns {COLUMNS}"
OPS = ("insert", "update", "delete", "truncate", "read")
