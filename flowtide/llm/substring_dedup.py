"""Operator 4, substring dedup by level-wise doubling.

A word is removed if a window of WINDOW consecutive words covers it whose word sequence starts earlier somewhere (smaller doc_id, or
the same document and an earlier start), judged on the input. Windows of five words are looked at first, then of ten, then of twenty
(a window is halved while it is even and its half has five words or more): a window is a candidate at one length only if both its halves
were repeated at the length before. At the last length the earliest occurrence of each window stays and the others are copies.

At each length, texts are read a slice at a time (some 1,000 texts). A slice asks about each of its distinct candidates once, in
the bucket that the window's hash names: a row for each slice and bucket holds the hashes as bytes. A bucket answers with a bit
for each, and the answers come back to the slice, whose candidates' buckets say which bit is whose. So a window that occurs in
millions of places is asked for once a slice, buckets grow in number and not in size, and no table has a row for each window. What is
repeated in a document is kept as a few ranges until the document is read for the next length.

Lengths below the last compare 32 bits and the bucket's, so a few windows that aren't repeated go on; the last compares 80 bits. Reading the same slices twice at each length is what links answers to documents; if a table isn't the same when it is read
again, that is found and raised.

Defined cases: null and empty texts have no words; texts shorter than the window lose nothing. doc_id is an integer column. Rows that
repeat both doc_id and text count as one document and have the same result; of rows that share a doc_id but not the text the one with
the smaller hash comes first; a null doc_id comes before all others. An empty table gives an empty result. Other columns are kept, but one
called like the output is replaced; those that begin with "__sd_" are taken.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import scratch, slices, small, stash
from .text_arrays import Words, give_back, ranges, signed, window_hashes, within

WINDOW, LEAST = 20, 5
#: Bytes of text whose windows one bucket takes on average.
BUCKET_BYTES = 8 << 20
NO_ID = -(1 << 63)
#: Seed of a second window hash.
SECOND = 0xA0761D6478BD642F


def levels(window: int) -> list[int]:
    out = [window]
    while out[0] % 2 == 0 and out[0] // 2 >= LEAST:
        out.insert(0, out[0] // 2)
    return out


@dataclass
class Slice:
    """Candidates of some documents in order of doc_id and text hash: their window hashes, and which are the first of their kind here."""

    key: int
    o: np.ndarray
    t: np.ndarray
    at: np.ndarray  # each document's first word
    place: np.ndarray  # of each candidate, among all words
    k: np.ndarray
    more: np.ndarray  # 16 bits of another hash
    first: np.ndarray
    twice: np.ndarray  # of the first ones, whether another equals it here
    bucket: np.ndarray

    def owner(self) -> np.ndarray:
        return np.searchsorted(self.at, self.place, side="right") - 1


def _candidates(words: Words, length: int, look: pa.ListArray | None) -> np.ndarray:
    if look is None:
        return within(words.at, length)[0]
    n, half = int(words.at[-1]), length // 2
    size = np.diff(look.offsets.to_numpy()) // 2
    edge = look.flatten().to_numpy() + np.repeat(words.at[:-1], size * 2)
    mark = np.zeros(n + 1, dtype=np.int32)
    np.add.at(mark, edge[::2], 1)
    np.add.at(mark, edge[1::2], -1)
    repeated = np.cumsum(mark)[:n] > 0
    stop = np.repeat(words.at[1:], np.diff(words.at))
    place = np.flatnonzero(repeated)
    place = place[place + length <= stop[place]]
    return place[repeated[place + half]]


def _slices(batches: Iterator[pa.RecordBatch], length: int, buckets: int, last: bool = False) -> Iterator[Slice]:
    """Rows o, t, text (and look, from the second length on)."""
    for b in batches:
        start = 0
        for text in slices(b.column("text")):
            part = b.slice(start, len(text))
            start += len(text)
            o, t = (part.column(c).to_numpy() for c in ("o", "t"))
            order = np.lexsort((t, o))
            o, t = o[order], t[order]
            once = np.concatenate([[True], (o[1:] != o[:-1]) | (t[1:] != t[:-1])])
            order, o, t = pa.array(order[once]), o[once], t[once]
            words = Words(text.take(order))
            look = part.column("look").take(order) if "look" in part.schema.names else None
            place = _candidates(words, length, look)
            if not len(place):
                continue
            h = words.hashes()
            k, more = window_hashes(h, length)[place], window_hashes(h, length, SECOND)[place].astype(np.uint16) if last else None
            by = np.argsort(k, kind="stable")  # equal windows stay in order
            new = np.concatenate([[True], k[by][1:] != k[by][:-1]])
            first, twice = np.zeros(len(k), dtype=bool), np.zeros(len(k), dtype=bool)
            first[by[new]] = True
            twice[by[new]] = np.diff(np.append(np.flatnonzero(new), len(k))) > 1
            bucket = ((k >> np.uint64(40)) % np.uint64(buckets)).astype(np.int64)
            yield Slice(xxhash.xxh3_64_intdigest(o.tobytes() + t.tobytes()) >> 1, o, t, words.at, place, k, more, first, twice, bucket)


def _code(buckets: int) -> np.dtype:
    return np.dtype(np.uint8 if buckets < 255 else np.uint32)


def _batch(columns: dict) -> pa.RecordBatch:
    return pa.RecordBatch.from_pydict({k: v if isinstance(v, pa.Array) else pa.array(v) for k, v in columns.items()})


def _asks(docs: DataFrame, length: int, buckets: int, last: bool) -> DataFrame:
    """bucket, slice, a (32 bits of each hash, or 64 at the last length), b (bits: repeated in the slice; at the last length 16 more bits of each hash), and there o, t, n: whose they are."""

    def rows(batches):
        for s in _slices(batches, length, buckets, last):
            mine = np.flatnonzero(s.first)
            mine = mine[np.argsort(s.bucket[mine], kind="stable")]
            cuts = np.append(np.flatnonzero(np.concatenate([[True], np.diff(s.bucket[mine]) > 0])), len(mine))
            out = {"bucket": s.bucket[mine[cuts[:-1]]], "slice": np.full(len(cuts) - 1, s.key), "a": [], "b": [], "o": [], "t": [], "n": []}
            owner = s.owner() if last else None
            for lo, hi in zip(cuts, cuts[1:]):
                m = mine[lo:hi]
                k = s.k[m]
                if last:
                    out["a"].append(k.tobytes())
                    who, n = np.unique(owner[m], return_counts=True)
                    out["o"].append(s.o[who])
                    out["t"].append(s.t[who])
                    out["n"].append(n.astype(np.int32))
                    out["b"].append(s.more[m].tobytes())
                else:
                    out["a"].append(k.astype(np.uint32).tobytes())
                    out["b"].append(np.packbits(s.twice[m]).tobytes())
                    for c in "otn":
                        out[c].append(None)
            kinds = {"a": pa.binary(), "b": pa.binary(), "o": pa.list_(pa.int64()), "t": pa.list_(pa.int64()), "n": pa.list_(pa.int32())}
            yield _batch({c: pa.array(v, kinds[c]) if c in kinds else v for c, v in out.items()})
        give_back()

    return docs.mapInArrow(rows, "bucket long, slice long, a binary, b binary, o array<long>, t array<long>, n array<int>")


def _joined(column: pa.ChunkedArray, kind) -> tuple[np.ndarray, np.ndarray]:
    """The values of binary cells, one after another, and how many each has."""
    cells = column.to_pylist()
    values = np.frombuffer(b"".join(cells), dtype=kind)
    return values, np.array([len(c) for c in cells]) // np.dtype(kind).itemsize


def _bits(flags: np.ndarray, size: np.ndarray) -> list[bytes]:
    stop = np.cumsum(size)
    return [np.packbits(flags[z - n : z]).tobytes() for n, z in zip(size.tolist(), stop.tolist())]


def _repeated(group: pa.Table) -> pa.Table:
    """Of a bucket's asks, which hashes come in two slices, or twice in one."""
    keys, size = _joined(group.column("a"), np.uint32)
    twice = np.concatenate([np.unpackbits(np.frombuffer(b, np.uint8), count=n) for b, n in zip(group.column("b").to_pylist(), size.tolist())])
    by = np.argsort(keys, kind="stable")
    new = np.flatnonzero(np.concatenate([[True], keys[by][1:] != keys[by][:-1]]))
    often = np.add.reduceat(1 + twice[by].astype(np.int64), new) > 1
    flags = np.zeros(len(keys), dtype=bool)
    flags[by] = np.repeat(often, np.diff(np.append(new, len(keys))))
    return pa.table({"slice": group.column("slice"), "bucket": group.column("bucket"), "bits": pa.array(_bits(flags, size), pa.binary())})


def _earliest(group: pa.Table) -> pa.Table:
    """Of a bucket's asks at the last length, which are by the first document that has the window."""
    keys, size = _joined(group.column("a"), np.uint64)
    more, _ = _joined(group.column("b"), np.uint16)
    o, t, n = (group.column(c).combine_chunks() for c in "otn")
    o, t, n = (x.flatten().to_numpy() if not isinstance(x, pa.ChunkedArray) else pa.chunked_array([c.flatten() for c in x.chunks]).to_numpy() for x in (o, t, n))
    order = np.lexsort((t, o))
    new = np.concatenate([[False], (o[order][1:] != o[order][:-1]) | (t[order][1:] != t[order][:-1])])
    rank = np.zeros(len(o), dtype=np.int64)
    rank[order] = np.cumsum(new)
    rank = np.repeat(rank, n)
    by = np.lexsort((more, keys))
    start = np.flatnonzero(np.concatenate([[True], (keys[by][1:] != keys[by][:-1]) | (more[by][1:] != more[by][:-1])]))
    least = np.repeat(np.minimum.reduceat(rank[by], start), np.diff(np.append(start, len(keys))))
    flags = np.zeros(len(keys), dtype=bool)
    flags[by] = rank[by] == least
    return pa.table({"slice": group.column("slice"), "bucket": group.column("bucket"), "bits": pa.array(_bits(flags, size), pa.binary())})


def _maps(docs: DataFrame, length: int, buckets: int) -> DataFrame:
    """slice, o, t, r (ranges of the candidates' places in their document), m (how many ranges each document has), code (each candidate's bucket, `buckets` if it isn't the first of its kind)."""

    def rows(batches):
        for s in _slices(batches, length, buckets):
            owner = s.owner()
            flags = np.zeros(int(s.at[-1]) + len(s.o) + 1, dtype=bool)
            flags[s.place + owner] = True  # a gap between documents keeps their ranges apart
            lo, hi = ranges(flags)
            whose = np.searchsorted(s.at + np.arange(len(s.at)), lo, side="right") - 1
            base = s.at[whose] + whose
            r = np.stack([lo - base, hi - base], axis=1).reshape(-1).astype(np.int32)
            m = np.bincount(whose, minlength=len(s.o)).astype(np.int32)
            code = np.where(s.first, s.bucket, buckets).astype(_code(buckets))
            one = lambda x, kind: pa.array([x], pa.list_(kind))
            yield _batch({"slice": [s.key], "o": one(s.o, pa.int64()), "t": one(s.t, pa.int64()), "r": one(r, pa.int32()), "m": one(m, pa.int32()), "code": pa.array([code.tobytes()], pa.binary())})
        give_back()

    return docs.mapInArrow(rows, "slice long, o array<long>, t array<long>, r array<int>, m array<int>, code binary")


def _spread(lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
    """All places of the ranges, in order."""
    size = hi - lo
    return np.repeat(lo - (np.cumsum(size) - size), size) + np.arange(size.sum())


def _found(joined: DataFrame, length: int, buckets: int, last: bool) -> DataFrame:
    """o, t, found: ranges of the repeated windows of a document, or at the last length of the words to remove."""

    def rows(batches):
        for b in batches:
            for row in range(b.num_rows):
                if not b.column("answers")[row].is_valid:
                    raise RuntimeError("the table was not the same when it was read again")
                o, t, r, m = (b.column(c)[row].values.to_numpy() for c in ("o", "t", "r", "m"))
                code = np.frombuffer(b.column("code")[row].as_buffer(), dtype=_code(buckets)).astype(np.int64)
                by = np.argsort(code, kind="stable")
                cuts = np.searchsorted(code[by], np.arange(buckets + 1))
                flags = np.ones(len(code), dtype=bool)
                heard = 0
                for a in b.column("answers")[row].as_py():
                    x, z = cuts[a["bucket"]], cuts[a["bucket"] + 1]
                    flags[by[x:z]] = np.unpackbits(np.frombuffer(a["bits"], np.uint8), count=z - x).astype(bool) != last
                    heard += z - x
                if heard != cuts[buckets]:
                    raise RuntimeError("the table was not the same when it was read again")
                whose = np.repeat(np.repeat(np.arange(len(o)), m), r[1::2] - r[::2])
                place = _spread(r[::2].astype(np.int64), r[1::2].astype(np.int64))
                whose, place = whose[flags], place[flags]
                if not len(place):
                    continue
                size = np.zeros(len(o), dtype=np.int64)
                width = length if last else 1
                np.maximum.at(size, whose, place + width + 1)  # a gap keeps documents apart
                base = np.cumsum(size) - size
                mark = np.zeros(int(size.sum()) + 1, dtype=np.int32)
                np.add.at(mark, base[whose] + place, 1)
                np.add.at(mark, base[whose] + place + width, -1)
                lo, hi = ranges(np.cumsum(mark) > 0)
                mine = np.searchsorted(base + size, lo, side="right")
                edges = np.stack([lo - base[mine], hi - base[mine]], axis=1).reshape(-1).astype(np.int32)
                have, n = np.unique(mine, return_counts=True)
                stop = np.concatenate([[0], np.cumsum(2 * n)]).astype(np.int32)
                yield _batch({"o": o[have], "t": t[have], "found": pa.ListArray.from_arrays(pa.array(stop), pa.array(edges))})
        give_back()

    return joined.mapInArrow(rows, "o long, t long, found array<int>")


def _sized(df: DataFrame, lists: str) -> DataFrame:
    """df, to be broadcast if it is small by the count of rows and of what is in its lists."""
    n, items = df.agg(F.count("*"), F.coalesce(F.sum(F.size(lists)), F.lit(0))).first()
    return small(df, row_bytes=100 + 4 * math.ceil(items / max(1, n)))


def spans(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", window: int = WINDOW, bucket_bytes: int = BUCKET_BYTES) -> DataFrame:
    """o (doc_id, the smallest long for null), t (the text's hash), found (starts and ends, in words, of what to remove), for documents that lose any."""
    if docs.schema[doc_id].dataType.typeName() not in ("byte", "short", "integer", "long"):
        raise ValueError(f"{doc_id} is not an integer column")
    d = docs.select(F.coalesce(F.col(doc_id).cast("long"), F.lit(NO_ID)).alias("o"), F.xxhash64(text).alias("t"), F.col(text).alias("text"))
    buckets = math.ceil((d.agg(F.sum(F.octet_length("text"))).first()[0] or 1) / bucket_bytes)
    found = None
    for length in levels(window):
        last, look = length == window, found
        with scratch() as keep:
            read = d if look is None else d.alias("d").join(_sized(look, "found").alias("k"), ["o", "t"]).select("o", "t", "text", F.col("found").alias("look"))
            asks = _asks(read, length, buckets, last)
            answers = asks.groupBy("bucket").applyInArrow(_earliest if last else _repeated, "slice long, bucket long, bits binary")
            # slices of the same documents, where rows repeat, have the same answers
            answers = stash(answers.groupBy("slice").agg(F.collect_set(F.struct("bucket", "bits")).alias("answers")), "answers")
            both = _maps(read, length, buckets).join(answers.hint("merge"), "slice", "left")
            found = keep(stash(_found(both, length, buckets, last).dropDuplicates(["o", "t"]), "found"))
    return found


def remove(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", window: int = WINDOW, out: str = "substring_dedup", bucket_bytes: int = BUCKET_BYTES) -> DataFrame:
    """docs with the struct `out` added: n_words, n_removed, kept (the words that stay, with one space between)."""
    s = spans(docs, doc_id, text, window, bucket_bytes).select(F.col("o").alias("__sd_o"), F.col("t").alias("__sd_t"), F.col("found").alias("__sd_s"))
    kind = pa.struct([("n_words", pa.int64()), ("n_removed", pa.int64()), ("kept", pa.string())])

    @F.arrow_udf("struct<n_words:long,n_removed:long,kept:string>")
    def cut(columns: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for texts, gone in columns:
            start, out = 0, []
            for part in slices(texts):
                rows = []
                for x, edges in zip(part.to_pylist(), gone.slice(start, len(part)).to_pylist()):
                    words, n = (x or "").encode().split(), 0
                    total = len(words)
                    for lo, hi in zip(reversed((edges or [])[::2]), reversed((edges or [])[1::2])):
                        del words[lo:hi]
                        n += hi - lo
                    rows.append((total, n, b" ".join(words).decode()))
                start += len(part)
                out.append(pa.array([dict(zip(("n_words", "n_removed", "kept"), r)) for r in rows], kind))
            yield pa.concat_arrays(out or [pa.array([], kind)])
        give_back()

    same = (F.coalesce(F.col(doc_id).cast("long"), F.lit(NO_ID)) == F.col("__sd_o")) & (F.xxhash64(text) == F.col("__sd_t"))
    d = docs.join(_sized(s, "__sd_s"), same, "left")
    return d.withColumn(out, cut(F.col(text), F.col("__sd_s"))).drop("__sd_o", "__sd_t", "__sd_s")


ORACLE = rf"""
with d as (select doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') as w from documents),
win as (select doc_id, p, array_to_string(w[p:p + {WINDOW - 1}], ' ') as k from d, unnest(range(1, len(w) - {WINDOW - 2})) as u(p)),
g as (select doc_id, p, row_number() over (partition by k order by doc_id, p) > 1 as gone from win),
x as (select d.doc_id, u.i, w[u.i] as word from d, unnest(range(1, len(w) + 1)) as u(i)),
c as (select x.*, coalesce(max(g.gone) over (partition by x.doc_id order by i rows between {WINDOW - 1} preceding and current row), false) as gone
      from x left join g on g.doc_id = x.doc_id and g.p = x.i),
a as (select doc_id, count(*) as n_words, count(*) filter (where gone) as n_removed, string_agg(word, ' ' order by i) filter (where not gone) as kept from c group by doc_id)
select d.doc_id, coalesce(n_words, 0) as n_words, coalesce(n_removed, 0) as n_removed, sha256(coalesce(kept, '')) as kept_sha256 from d left join a using (doc_id)
"""
