"""Operator 7, n-gram Jaccard join by chosen paths.

A document is its set of hashed word n-grams. Documents with the same set are one class. A class is
embedded as the minima of RUNS * DEPTH hash functions over its set: each is a token sampled from the set,
and two sets share it with a probability of their Jaccard similarity. A run's path starts with one sampled
token; classes that share it form a bucket. A bucket above LIMIT is split by a second token, and one still
above it by a third. What a path ends in is searched by brute force: the embedded sets first (pairs that
agree on fewer tokens than similar ones could are left), then the whole sets, exactly. The number of runs
follows from the target recall at the threshold, for a path of full depth.

No bucket is capped. Buckets with the same members are searched once. One above BLOCK members or BLOCK_TOKENS
tokens is searched block against block, each pair of blocks in a task of its own, so no task holds more than two blocks. A pair found in
several buckets is counted in the one with the smallest key, so links are counted where they are found and
no list of pairs is ever written: rows grow with the documents.

Linked classes make up groups by label propagation with pointer jumping over checkpointed tables.

Defined cases: null and empty texts, and texts without words, have no set: each is alone, with no links. A
text of fewer than n words has one n-gram, all its words. Rows that repeat both doc_id and text count as one
document; a null doc_id comes before all others. Only doc_id and text are read. An empty table gives an
empty result.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import checkpoint, slices, small, stash
from .text_arrays import Words, give_back, mix, signed, window_hashes

N, THRESHOLD, RECALL = 5, 0.8, 0.999
DEPTH, LIMIT, BLOCK = 3, 64, 384
#: Tokens of the sets that a block holds on average, 8 bytes each.
BLOCK_TOKENS = 1 << 20


def runs_for(threshold: float, recall: float, depth: int = DEPTH) -> int:
    return math.ceil(math.log(1 - recall) / math.log(1 - threshold**depth))


def least_agreement(size: int, threshold: float, miss: float = 1e-5) -> int:
    """The most tokens that all but `miss` of pairs at the threshold agree on."""
    below, k = 0.0, 0
    while True:
        below += math.comb(size, k) * threshold**k * (1 - threshold) ** (size - k)
        if below > miss:
            return k
        k += 1


def sets_of(texts, n: int = N) -> list[np.ndarray]:
    """Sorted distinct n-gram hashes of each text."""
    words = Words(texts)
    h = words.hashes()
    grams, out = window_hashes(h, n), []
    for a, z in zip(words.at.tolist(), words.at[1:].tolist()):
        out.append(np.unique(grams[a : z - n + 1] if z - a >= n else window_hashes(h[a:z], z - a)) if z > a else h[:0])
    return out


def shingles(text: str | None, n: int = N) -> np.ndarray:
    return sets_of([text], n)[0]


def _embed(s: np.ndarray, multipliers: np.ndarray) -> np.ndarray:
    if len(s) * len(multipliers) <= 1 << 20:
        return mix(s[None, :] * multipliers[:, None]).min(axis=1)
    return np.array([mix(s * m).min() for m in multipliers], dtype=np.uint64)


def _multipliers(size: int) -> np.ndarray:
    return mix(np.arange(1, size + 1, dtype=np.uint64)) | np.uint64(1)


def _set_key(s: np.ndarray) -> tuple[int, int]:
    d = xxhash.xxh3_128_digest(s.tobytes())
    return int.from_bytes(d[:8], "little", signed=True), int.from_bytes(d[8:], "little", signed=True)


def _embedded(docs: DataFrame, n: int, size: int) -> DataFrame:
    """i, t, hi, lo (the set), n, mins: a row for each row of docs (i, t, text)."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        multipliers = _multipliers(size)
        for b in batches:
            start = 0
            for text in slices(b.column("text")):
                sets = sets_of(text, n)
                keys = np.array([_set_key(s) for s in sets], dtype=np.int64).reshape(-1, 2)
                mins = np.array([_embed(s, multipliers) if len(s) else np.zeros(size, np.uint64) for s in sets], dtype=np.uint64).reshape(-1)
                ends = pa.array(np.arange(0, size * len(sets) + 1, size, dtype=np.int32))
                i, t = (b.column(x).slice(start, len(text)) for x in ("i", "t"))
                yield pa.RecordBatch.from_arrays(
                    [i, t, pa.array(keys[:, 0]), pa.array(keys[:, 1]), pa.array([len(s) for s in sets], pa.int64()), pa.ListArray.from_arrays(ends, pa.array(signed(mins)))],
                    names=["i", "t", "hi", "lo", "n", "mins"],
                )
                start += len(text)
        give_back()

    return docs.mapInArrow(rows, f"i {docs.schema['i'].dataType.simpleString()}, t long, hi long, lo long, n long, mins array<long>")


def _sets(docs: DataFrame, n: int) -> DataFrame:
    """hi, lo, s: the set of each row of docs (text)."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for text in slices(b.column("text")):
                sets = sets_of(text, n)
                keys = np.array([_set_key(s) for s in sets], dtype=np.int64).reshape(-1, 2)
                ends = pa.array(np.cumsum([0, *map(len, sets)]).astype(np.int32))
                yield pa.RecordBatch.from_arrays([pa.array(keys[:, 0]), pa.array(keys[:, 1]), pa.ListArray.from_arrays(ends, pa.array(signed(np.concatenate(sets))))], names=["hi", "lo", "s"])
        give_back()

    return docs.mapInArrow(rows, "hi long, lo long, s array<long>")


def _groups(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """Consecutive rows with equal keys, from batches sorted by them."""
    left: pa.Table | None = None
    for b in batches:
        t = pa.Table.from_batches([b])
        t = t if left is None else pa.concat_tables([left, t])
        k = np.stack([t.column(x).to_numpy() for x in keys])
        cuts = [0, *(np.flatnonzero((k[:, 1:] != k[:, :-1]).any(axis=0)) + 1).tolist()]
        t = t.combine_chunks()
        for a, e in zip(cuts, cuts[1:]):
            yield t.slice(a, e - a)
        left = t.slice(cuts[-1])
    if left is not None and left.num_rows:
        yield left


def _blocks(members: DataFrame, block: int) -> DataFrame:
    """Deals members (bucket, c, n, ...) to pairs of blocks (x, y), a block for every `block` members or BLOCK_TOKENS tokens; side tells the member's block."""
    sizes = stash(members.groupBy("bucket").agg(F.count("*").alias("size"), F.sum("n").alias("tokens")), "sizes")
    nb = F.ceil(F.greatest(F.col("size") / block, F.least(F.col("tokens") / BLOCK_TOKENS, F.col("size")))).cast("int")
    d = members.join(small(sizes), "bucket").withColumn("side", F.pmod(F.xxhash64("c"), nb).cast("int"))
    d = d.withColumn("other", F.explode(F.sequence(F.lit(0), nb - 1))).drop("size", "tokens", "n")
    d = d.withColumn("x", F.least("side", "other")).withColumn("y", F.greatest("side", "other")).drop("other")
    return d.repartition("bucket", "x", "y").sortWithinPartitions("bucket", "x", "y")


def _apart(t: pa.Table) -> np.ndarray | None:
    """Where two blocks meet, which pairs lie across them; None within a block."""
    if t.column("x")[0] == t.column("y")[0]:
        return None
    side = t.column("side").to_numpy()
    return side[:, None] != side[None, :]


def _flat(t: pa.Table, name: str) -> tuple[np.ndarray, np.ndarray]:
    a = t.column(name).combine_chunks()
    a = a.chunk(0) if isinstance(a, pa.ChunkedArray) else a
    ends = a.offsets.to_numpy()
    return a.flatten().to_numpy().view(np.uint64), np.diff(ends)


def _alike(members: DataFrame, agree: int) -> DataFrame:
    """bucket, c of members whose embedding agrees with another's on `agree` tokens."""

    def rows(batches):
        for t in _groups(batches, ["bucket", "x", "y"]):
            if t.num_rows < 2:
                continue
            values, lengths = _flat(t, "mins")
            m = values.reshape(len(lengths), -1)
            same = np.zeros((len(m), len(m)), dtype=np.int16)
            for j in range(m.shape[1]):
                same += m[:, None, j] == m[None, :, j]
            near = same >= agree
            np.fill_diagonal(near, False)
            across = _apart(t)
            keep = (near if across is None else near & across).any(axis=1)
            if keep.any():
                yield pa.RecordBatch.from_pydict({"bucket": t.column("bucket").to_numpy()[keep], "c": t.column("c").to_numpy()[keep]})

    return members.mapInArrow(rows, "bucket long, c long")


def similar_pairs(values: np.ndarray, lengths: np.ndarray, threshold: float) -> np.ndarray:
    """A matrix of which of the sets are similar, from their concatenated members."""
    owner = np.repeat(np.arange(len(lengths)), lengths)
    _, token, count = np.unique(values, return_inverse=True, return_counts=True)
    shared = count[token] > 1
    owner, token = owner[shared], token[shared]
    token = np.unique(token, return_inverse=True)[1] if len(token) else token
    common = np.zeros((len(lengths), len(lengths)), dtype=np.float64)
    order = np.argsort(token, kind="stable")
    owner, token = owner[order], token[order]
    width = 2048
    for start in range(0, int(token[-1]) + 1 if len(token) else 0, width):
        a, b = np.searchsorted(token, (start, start + width))
        x = np.zeros((len(lengths), width), dtype=np.float32)
        x[owner[a:b], token[a:b] - start] = 1
        common += x @ x.T
    union = lengths[:, None] + lengths[None, :] - common
    near = common >= threshold * union - 1e-9
    np.fill_diagonal(near, False)
    return near


def _first_meeting(keys: np.ndarray, i: np.ndarray, j: np.ndarray, bucket: int) -> np.ndarray:
    """Of pairs, which have `bucket` as the smallest bucket that both are in. keys: buckets of each, filled up with the largest long."""
    out, top = np.zeros(len(i), dtype=bool), np.iinfo(np.int64).max
    for k in range(0, len(i), 20_000):
        a, b = keys[i[k : k + 20_000]], keys[j[k : k + 20_000]]
        both = (a[:, :, None] == b[:, None, :]).any(axis=2)
        out[k : k + 20_000] = np.where(both, a, top).min(axis=1) == bucket
    return out


def _linked(members: DataFrame, threshold: float) -> DataFrame:
    """c, links, root: the new links of each class in a bucket, and the smallest class that it hangs together with there."""

    def rows(batches):
        top = np.iinfo(np.int64).max
        for t in _groups(batches, ["bucket", "x", "y"]):
            if t.num_rows < 2:
                continue
            near = similar_pairs(*_flat(t, "s"), threshold)
            across = _apart(t)
            near = near if across is None else near & across
            i, j = np.nonzero(np.triu(near))
            if not len(i):
                continue
            values, lengths = _flat(t, "keys")
            keys = np.full((len(lengths), lengths.max()), top, dtype=np.int64)
            keys[np.repeat(np.arange(len(lengths)), lengths), np.concatenate([np.arange(x) for x in lengths])] = values.view(np.int64)
            new = _first_meeting(keys, i, j, t.column("bucket")[0].as_py())
            links = np.bincount(np.concatenate([i[new], j[new]]), minlength=len(near))
            c = t.column("c").to_numpy()
            root = c.copy()
            while True:
                least = np.minimum(root, np.where(near, root[None, :], top).min(axis=1))
                if (least == root).all():
                    break
                root = least
            keep = near.any(axis=1)
            yield pa.RecordBatch.from_pydict({"c": c[keep], "links": links[keep].astype(np.int64), "root": root[keep]})

    return members.mapInArrow(rows, "c long, links long, root long")


def components(edges: DataFrame) -> DataFrame:
    """u, label for every end of edges (u, v) of longs: label is the smallest u that hangs together with it."""
    e = stash(edges.where("u <> v").select("u", "v").union(edges.where("u <> v").select(F.col("v").alias("u"), F.col("u").alias("v"))).distinct(), "edges")
    labels = stash(e.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("label")), "labels")
    while True:
        at = labels.select(F.col("u").alias("v"), "label")
        low = e.join(small(at), "v").groupBy("u").agg(F.min("label").alias("low"))
        now = labels.join(small(checkpoint(low)), "u").select("u", F.least("label", "low").alias("new"), F.col("label").alias("old"))
        now = stash(now, "labels")
        jump = now.select(F.col("u").alias("new"), F.col("new").alias("further"))
        moved = stash(now.join(small(jump), "new").select("u", F.col("further").alias("label"), "old"), "labels")
        labels = moved.select("u", "label")
        if moved.where("label <> old").isEmpty():
            return labels


def join(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", n: int = N, threshold: float = THRESHOLD, recall: float = RECALL, depth: int = DEPTH, limit: int = LIMIT, block: int = BLOCK) -> DataFrame:
    """A row for each row of docs: doc_id, class_id (smallest doc_id of its group), copy_id (smallest of the documents with
    its set), copies (documents with its set), n_links (other sets that are similar), t (the text's hash), keep (whether it stands for its group)."""
    runs = runs_for(threshold, recall, depth)
    size = runs * depth
    rows = docs.select(F.col(doc_id).alias("i"), F.xxhash64(text).alias("t"), F.col(text).alias("text"))
    all_rows = stash(_embedded(rows, n, size), "sets")
    classes = all_rows.where("n > 0").groupBy("hi", "lo").agg(F.min(F.struct("i", "t")).alias("first"), F.count("*").alias("copies"), F.any_value("mins").alias("mins"), F.any_value("n").alias("n"))
    classes = stash(classes.withColumn("c", F.monotonically_increasing_id()), "classes")

    paths = [F.struct(*(F.xxhash64(F.lit(r), *(F.col("mins")[r * depth + d] for d in range(k + 1))).alias(f"k{k}") for k in range(depth))) for r in range(runs)]
    left = classes.select("c", F.inline(F.array(*paths)))
    buckets = []
    for k in range(depth):
        sizes = stash(left.groupBy(f"k{k}").agg(F.count("*").alias("size")).where("size > 1"), "sizes")
        left = stash(left.join(small(sizes), f"k{k}"), "paths")
        ends = F.lit(True) if k == depth - 1 else F.col("size") <= limit
        buckets.append(left.where(ends).select("c", F.col(f"k{k}").alias("bucket")))
        left = left.where(~ends).drop("size")
    found = buckets[0]
    for b in buckets[1:]:
        found = found.union(b)
    members = F.struct(F.count("*").alias("size"), F.bit_xor(F.xxhash64("c")).alias("a"), F.bit_xor(F.xxhash64(F.lit(7), "c")).alias("b"))
    once = stash(found.groupBy("bucket").agg(members.alias("m")).groupBy("m").agg(F.min("bucket").alias("bucket")).select("bucket"), "buckets")
    found = stash(found.join(small(once), "bucket", "left_semi"), "members")

    alike = _alike(_blocks(found.join(classes.select("c", "mins", F.lit(size).alias("n")), "c"), block), least_agreement(size, threshold))
    alike = stash(alike.distinct(), "alike")
    keys = alike.groupBy("c").agg(F.sort_array(F.collect_set("bucket")).alias("keys"))
    wanted = stash(keys.join(classes.select("c", "n", "hi", "lo", F.col("first.i").alias("i"), F.col("first.t").alias("t")), "c"), "wanted")
    d = rows.alias("d").join(small(wanted.select("i", "t")).alias("w"), F.expr("d.i <=> w.i and d.t = w.t"), "left_semi").select("text")
    sets = _sets(d, n).dropDuplicates(["hi", "lo"]).join(wanted, ["hi", "lo"])
    linked = stash(_linked(_blocks(stash(sets.select("c", "n", "keys", "s", F.explode("keys").alias("bucket")), "searched"), block), threshold), "linked")

    links = linked.groupBy("c").agg(F.sum("links").alias("n_links"))
    groups = components(linked.select(F.col("c").alias("u"), F.col("root").alias("v")))
    named = stash(groups.join(classes.select(F.col("c").alias("u"), "first"), "u"), "named")
    least = stash(named.groupBy("label").agg(F.min("first").alias("group")), "groups")
    named = named.join(small(least), "label").select(F.col("u").alias("c"), "group")
    about = stash(classes.drop("mins", "n").join(links, "c", "left").join(named, "c", "left").where("copies > 1 or n_links is not null").select("hi", "lo", "first", "copies", "n_links", F.coalesce("group", "first").alias("group")), "about")
    out = all_rows.where("n > 0").select("i", "t", "hi", "lo").join(small(about, row_bytes=160), ["hi", "lo"], "left").drop("hi", "lo")
    out = out.unionByName(all_rows.where("n = 0").select("i", "t"), allowMissingColumns=True)
    own = F.struct("i", "t")
    return out.select(
        F.col("i").alias("doc_id"), F.when(F.col("group").isNull(), F.col("i")).otherwise(F.col("group.i")).alias("class_id"), F.when(F.col("first").isNull(), F.col("i")).otherwise(F.col("first.i")).alias("copy_id"),
        F.coalesce("copies", F.lit(1)).cast("long").alias("copies"), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), "t", F.coalesce(F.col("group").eqNullSafe(own) | F.col("group").isNull(), F.lit(True)).alias("keep"),
    )


def drop_near_copies(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """docs without those for which another of the group stands."""
    gone = stash(join(docs, doc_id, text, **options).where("not keep").select(F.col("doc_id").alias("__nj_i"), F.col("t").alias("__nj_t")), "gone")
    return docs.join(small(gone), F.col(doc_id).eqNullSafe(F.col("__nj_i")) & (F.xxhash64(text) == F.col("__nj_t")), "left_anti")
