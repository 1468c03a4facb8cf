"""Column expressions for the values, keys and positions of change events; all run inside the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..schema import BOOL, FLOATS, INTEGERS, JSON, JSONB, NUMERIC

EPOCH = 1 << 32


def lsn_text(lsn: Column) -> Column:
    """Upper-case hex halves around a slash, without padding."""
    return F.concat(F.hex(F.shiftrightunsigned(lsn, 32)), F.lit("/"), F.hex(lsn.bitwiseAND(F.lit(EPOCH - 1))))


def rfc3339(ts: Column) -> Column:
    """UTC, without the fraction's trailing zeros; the session's time zone must be UTC."""
    return F.regexp_replace(F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'"), r"\.?0+Z$", "Z")


def widen_xid(xid: Column, ref: Column) -> Column:
    """A 32-bit transaction id as the 64-bit one nearest to ref."""
    xid, ref = xid.cast("long"), ref.cast("long")
    wide = (ref - F.pmod(ref, F.lit(EPOCH))) + xid
    return F.when((wide - ref > EPOCH // 2) & (wide >= EPOCH), wide - EPOCH).when(ref - wide > EPOCH // 2, wide + EPOCH).otherwise(wide)


#: Escapes of common characters; the backslash comes first.
COMMON = {"\\": "\\\\", '"': '\\"', "\n": "\\n", "\r": "\\r", "\t": "\\t"}
#: Escapes of the other controls, and of what some readers take for the end of a line.
RARE = {chr(c): f"\\u{c:04x}" for c in [*range(0x20), 0x85, 0x2028, 0x2029] if chr(c) not in COMMON}


def json_quote(text: Column) -> Column:
    """A JSON string on one line: controls and the three Unicode line separators are escaped, all else is as it is.

    Rare characters are looked at one by one, and only in texts that have any, which keeps plans small.
    """
    out = text
    for c, e in COMMON.items():
        out = F.replace(out, F.lit(c), F.lit(e))
    rare = r"[\x00-\x08\x0b\x0c\x0e-\x1f\x85\x{2028}\x{2029}]"
    code = lambda c: F.concat(F.lit("\\u"), F.lpad(F.lower(F.hex(F.ascii(c))), 4, "0"))
    each = F.array_join(F.transform(F.split(out, ""), lambda c: F.when(c.rlike(rare), code(c)).otherwise(c)), "")
    return F.concat(F.lit('"'), F.when(out.rlike(rare), each).otherwise(out), F.lit('"'))


def quoted(text: str) -> str:
    """The same for a name that is known when a plan is made."""
    return '"' + "".join((COMMON | RARE).get(c, c) for c in text) + '"'


#: What needs a look before it is quoted.
SPECIAL = r'["\\\x00-\x1f\x85\x{2028}\x{2029}]'


def typed_json(oid: int, value: Column) -> Column:
    """value_json for a type that is known when a plan is made."""
    plain = F.concat(F.lit('"'), value, F.lit('"'))
    if oid == BOOL:
        out = F.when(value == "t", "true").otherwise("false")
    elif oid in FLOATS:
        out = F.when(value.isin("NaN", "Infinity", "-Infinity"), plain).otherwise(value)
    elif oid in (*INTEGERS, JSONB):
        out = value
    elif oid == JSON:
        out = single_line(value)
    elif oid == NUMERIC:
        out = plain  # digits, or a word of letters
    else:
        out = F.when(value.rlike(SPECIAL), json_quote(value)).otherwise(plain)
    return F.when(value.isNull(), "null").otherwise(out)


def single_line(json: Column) -> Column:
    return F.translate(json, "\r\n", "")


def value_json(oid: Column, value: Column) -> Column:
    """A value in text form as JSON, by its type; numerics stay strings to keep their precision."""
    special = oid.isin(*FLOATS) & value.isin("NaN", "Infinity", "-Infinity")
    return (
        F.when(value.isNull(), "null").when(oid == BOOL, F.when(value == "t", "true").otherwise("false"))
        .when(oid.isin(*INTEGERS, *FLOATS, JSONB) & ~special, value).when(oid == JSON, single_line(value)).otherwise(json_quote(value))
    )


def valid_utf8(raw: Column) -> Column:
    """Bytes as text, with U+FFFD for what is not UTF-8."""
    return F.make_valid_utf8(raw.cast("string"))


def json_object(columns: Column, cells: Column, keep=None) -> Column:
    """An object of the cells that were sent, in column order; keep(column) may choose columns."""
    pairs = F.filter(F.zip_with(columns, cells, lambda c, v: F.struct(c.alias("c"), v.alias("v"))), lambda p: (p["v"]["kind"] != "u") & (keep(p["c"]) if keep else F.lit(True)))
    return F.concat(F.lit("{"), F.array_join(F.transform(pairs, lambda p: F.concat(json_quote(p["c"]["name"]), F.lit(":"), value_json(p["c"]["oid"], p["v"]["value"]))), ","), F.lit("}"))


def key_json(columns: Column, cells: Column, previous: Column) -> Column:
    """The row's identity; a key cell that was not sent is taken from the previous image, and never invented."""
    old = F.coalesce(previous, F.transform(columns, lambda c: F.lit(None).cast("struct<kind:string,value:string>")))
    pairs = F.zip_with(columns, F.zip_with(cells, old, lambda a, b: F.when(a["kind"] == "t", a["value"]).when(b["kind"] == "t", b["value"])), lambda c, v: F.struct(c.alias("c"), v.alias("v")))
    keys = F.filter(pairs, lambda p: p["c"]["is_key"])
    part = lambda p: F.concat(json_quote(p["c"]["name"]), F.lit(":"), F.when(p["v"].isNull(), F.raise_error(F.lit("a key column has no value in the change")).cast("string")).otherwise(value_json(p["c"]["oid"], p["v"])))
    return F.concat(F.lit("{"), F.array_join(F.transform(keys, part), ","), F.lit("}"))


def hmac_sha256(secret: bytes, message: Column) -> Column:
    """HMAC (RFC 2104) from the built-in hash; hex."""
    import hashlib

    key = (hashlib.sha256(secret).digest() if len(secret) > 64 else secret).ljust(64, b"\0")
    pad = lambda x: F.unhex(F.lit(bytes(b ^ x for b in key).hex()))
    inner = F.sha2(F.concat(pad(0x36), message.cast("binary")), 256)
    return F.sha2(F.concat(pad(0x5C), F.unhex(inner)), 256)


def signature(secret: bytes, unix: Column, body: Column) -> Column:
    """t=<seconds>,v1=<hex HMAC of "<seconds>.<body>">."""
    t = unix.cast("string")
    return F.concat(F.lit("t="), t, F.lit(",v1="), hmac_sha256(secret, F.concat(t, F.lit("."), body)))


def signature_valid(secret: bytes, given: Column, body: Column, now: Column, tolerance: int = 300) -> Column:
    t = F.regexp_extract(given, r"^t=(\d+),v1=", 1).try_cast("long")
    return F.coalesce((signature(secret, t, body) == given) & (F.abs(now - t) <= tolerance), F.lit(False))


def idempotency_key(body: Column) -> Column:
    return F.substring(F.sha2(body.cast("binary"), 256), 1, 32)


def event_locator(value: Column) -> Column:
    """The event's leading fields, which locate it without its data."""
    return F.when(F.instr(value, ',"ts":') > 1, F.concat(F.substring_index(value, ',"ts":', 1), F.lit("}"))).otherwise("{}")


def status_class(status: Column) -> Column:
    return F.when((status >= 200) & (status < 300), "ok").when((status >= 500) | status.isin(408, 429), "retry").otherwise("rejected")


def backoff_bounds(attempt: Column, least_ms: int, most_ms: int) -> tuple[Column, Column]:
    """The range that a jittered exponential delay is drawn from."""
    d = F.least(F.lit(float(most_ms)), F.lit(float(least_ms)) * F.pow(F.lit(2.0), F.least(attempt, F.lit(62))))
    return d / 2, d


def quote_ident(name: Column) -> Column:
    return F.concat(F.lit('"'), F.replace(name, F.lit('"'), F.lit('""')), F.lit('"'))


def topic_name(prefix: str, schema: Column, name: Column) -> Column:
    """prefix + schema.table where that is unambiguous, else made legal byte by byte with a hash of the exact pair behind.

    Bytes are worked on as their hex digits, so a character of two bytes becomes two underscores.
    """
    full = F.concat(F.lit(prefix), schema, F.lit("."), name)
    legal = full.rlike(r"^[a-zA-Z0-9._-]*\z")
    plain = legal & (F.octet_length(full) <= 249) & ~full.rlike(r"-[0-9a-f]{8}\z") & (schema != "") & (name != "") & ~schema.contains(".") & ~name.contains(".")
    digest = F.sha2(F.concat(F.encode(F.lit(prefix), "UTF-8"), F.unhex(F.lit("00")), F.encode(schema, "UTF-8"), F.unhex(F.lit("00")), F.encode(name, "UTF-8")), 256)
    # every byte outside the legal set, ASCII or not, as one underscore
    ascii_ = F.decode(F.encode(full, "UTF-8"), "ISO-8859-1")
    clean = F.regexp_replace(ascii_, r"[^a-zA-Z0-9._-]", "_")
    return F.when(plain, full).otherwise(F.concat(F.substring(clean, 1, 249 - 9), F.lit("-"), F.substring(digest, 1, 8)))
