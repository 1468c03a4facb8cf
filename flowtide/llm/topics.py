"""Topics of documents: clusters of word use, learned from all texts and assigned to whole texts.

A text is a vector of its word counts in WIDTH hash buckets, as 1 + log of the count times the bucket's rarity among the texts, of
length 1. Spherical k-means starts from the text nearest their mean and takes the text that is least like those chosen as the
next start, so training has no chance in it. All distinct whole texts are learned from (equal hashes of 64 bits are taken for equal
texts): their counts are written once, and each round is a pass over them that sends back sums by bucket. Sums are of whole
numbers, so that no partitioning changes them.

Defined cases: null texts, and texts without words, have the topic "none". With fewer distinct texts than topics, there are fewer.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import slices, stash
from .text_arrays import Words, give_back

#: WIDTH is a power of two.
WIDTH, ROUNDS = 1024, 20
NONE = "none"
#: Vectors' entries are summed as whole numbers of this unit; rows that a pass takes at once, and rows and bytes of texts that are counted at once.
UNIT, ROWS = float(1 << 30), 500
TEXTS, TEXT_BYTES = 250, 1 << 20
#: 1 + log of small counts; 0 of 0.
DAMPED = np.concatenate(([0.0], 1 + np.log(np.arange(1, 256))))


def damped(n: np.ndarray) -> np.ndarray:
    """1 + log of each count, 0 of 0."""
    out = DAMPED.take(np.minimum(n, len(DAMPED) - 1))
    large = n >= len(DAMPED)
    if large.any():
        out[large] = 1 + np.log(n[large])
    return out


def counts(texts) -> tuple[np.ndarray, np.ndarray]:
    """Words of each text in each bucket, and words of each text."""
    w = Words(texts)
    n = np.diff(w.at)
    bucket = (w.hashes() & np.uint64(WIDTH - 1)).astype(np.int64)
    owner = np.repeat(np.arange(len(n)), n)
    return np.bincount(owner * WIDTH + bucket, minlength=len(n) * WIDTH).reshape(len(n), WIDTH), n


@dataclass(frozen=True)
class Topics:
    rarity: np.ndarray
    centres: np.ndarray

    def vectors(self, table: np.ndarray) -> np.ndarray:
        v = damped(table) * self.rarity
        size = np.sqrt((v * v).sum(axis=1, keepdims=True))
        return np.divide(v, size, out=np.zeros_like(v), where=size > 0)

    def names(self) -> list[str]:
        return [f"topic{k}" for k in range(len(self.centres))]

    def of(self, texts) -> tuple[list[str], np.ndarray]:
        """Topic and number of words of each text."""
        table, n = counts(texts)
        if not len(self.centres):
            return [NONE] * len(n), n
        best = (self.vectors(table) @ self.centres.T).argmax(axis=1)
        names = self.names()
        return [names[b] if k else NONE for b, k in zip(best.tolist(), n.tolist())], n


def fit(texts: list[str], topics: int) -> Topics:
    """What learn gives for a few distinct texts, in memory."""
    table, n = counts(texts)
    table = table[n > 0]
    rarity = np.log((1 + len(table)) / (1 + (table > 0).sum(axis=0)))
    v = Topics(rarity, np.zeros((0, WIDTH))).vectors(table)
    v = v[(v * v).sum(axis=1) > 0]
    if not len(v):
        return Topics(rarity, np.zeros((0, WIDTH)))
    chosen = [int((v @ v.mean(axis=0)).argmax())]
    while len(chosen) < min(topics, len(v)):
        likest = (v @ v[chosen].T).max(axis=1)
        if likest.min() > 1 - 1e-9:
            break
        chosen.append(int(likest.argmin()))
    centres = v[chosen]
    for _ in range(ROUNDS):
        own = (v @ centres.T).argmax(axis=1)
        new = np.array([v[own == k].sum(axis=0) if (own == k).any() else centres[k] for k in range(len(centres))])
        new /= np.maximum(np.sqrt((new * new).sum(axis=1, keepdims=True)), 1e-300)
        if np.allclose(new, centres):
            break
        centres = new
    return Topics(rarity, centres)


def packed(docs: DataFrame, text: str = "text") -> DataFrame:
    """h, at, n: hash, buckets and counts of each distinct text with words; some 6 bytes a bucket that it has."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            start = 0
            for part in slices(b["t"], TEXTS, TEXT_BYTES):
                table, n = counts(part)
                row, at = np.nonzero(table)
                ends = np.searchsorted(row, np.arange(len(n) + 1))
                cells = [(table[row, at].astype("<u4"), 4), (at.astype("<u2"), 2)]
                n_, at_ = (pa.Array.from_buffers(pa.binary(), len(n), [None, pa.py_buffer((ends * k).astype(np.int32)), pa.py_buffer(c.tobytes())]) for c, k in cells)
                out = pa.RecordBatch.from_arrays([b["h"].slice(start, len(n)), at_, n_], names=["h", "at", "n"])
                start += len(n)
                yield out.filter(pa.array(n > 0))
        give_back()

    t = docs.select(F.col(text).alias("t")).where("t is not null").select(F.xxhash64("t").alias("h"), "t")
    return stash(t.mapInArrow(pack, "h long, at binary, n binary").dropDuplicates(["h"]), "topics")


def _cells(column: pa.Array, kind: str) -> tuple[np.ndarray, np.ndarray]:
    """Where each row's numbers begin (one more at the end), and the numbers of all rows, in place."""
    offset = np.int64 if pa.types.is_large_binary(column.type) else np.int32
    ends = np.frombuffer(column.buffers()[1], offset)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    body = np.frombuffer(column.buffers()[2], np.uint8)[ends[0] : ends[-1]].view(kind)
    return (ends - ends[0]) // body.itemsize, body


def entries(b: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First entry of every row (each has one at least), and bucket and count of every entry."""
    ends, at = _cells(b["at"], "<u2")
    return ends[:-1], at.astype(np.intp), _cells(b["n"], "<u4")[1]


def _few(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        for k in range(0, b.num_rows, ROWS):
            yield b.slice(k, ROWS)


def _table(texts: DataFrame, add, k: int) -> np.ndarray:
    """The sum over all texts of add(batch), a table of k rows of WIDTH whole numbers."""

    def one(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((k, WIDTH))
        for b in _few(batches):
            total += add(b)
        row, at = np.nonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(row), pa.array(at), pa.array(total[row, at].astype(np.int64))], names=["k", "b", "s"])
        give_back()

    out = np.zeros((k, WIDTH))
    for r in texts.mapInArrow(one, "k long, b long, s long").groupBy("k", "b").agg(F.sum("s").alias("s")).collect():  # at most k * WIDTH rows
        out[r.k, r.b] = r.s
    return out


def _unit(b: pa.RecordBatch, rarity: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """First entry of every row, bucket and value of every entry of the texts' vectors, and which texts have one."""
    first, at, n = entries(b)
    v = damped(n) * rarity.take(at)
    size = np.sqrt(np.add.reduceat(v * v, first))
    there = size > 0
    v /= np.repeat(np.where(there, size, 1.0), _lengths(first, at))
    return first, at, v, there


def _lengths(first: np.ndarray, at: np.ndarray) -> np.ndarray:
    return np.diff(first, append=len(at))


def _likeness(first: np.ndarray, at: np.ndarray, v: np.ndarray, centres: np.ndarray) -> np.ndarray:
    return np.stack([np.add.reduceat(v * c.take(at), first) for c in centres], axis=1)


def _start(texts: DataFrame, rarity: np.ndarray, others: np.ndarray, sign: int) -> tuple[float, np.ndarray] | None:
    """The text least (sign 1) or most (-1) like any of `others`, the smaller hash of equal ones: likeness and vector."""

    def one(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = None
        for b in _few(batches):
            first, at, v, there = _unit(b, rarity)
            like = np.where(there, sign * _likeness(first, at, v, others).max(axis=1), np.inf)
            i = int(np.lexsort((b["h"].to_numpy(), like))[0])
            if there[i] and (best is None or (like[i], b["h"][i].as_py()) < best[:2]):
                best = (float(like[i]), b["h"][i].as_py(), b.slice(i, 1).select(["h", "at", "n"]))
        if best:
            yield best[2].append_column("like", pa.array([best[0]]))
        give_back()

    found = texts.mapInArrow(one, "h long, at binary, n binary, like double").orderBy("like", "h").limit(1).collect()
    if not found:
        return None
    at, n = np.frombuffer(bytes(found[0].at), "<u2"), np.frombuffer(bytes(found[0].n), "<u4")
    table = np.zeros((1, WIDTH), np.int64)
    table[0, at] = n
    return sign * found[0].like, Topics(rarity, np.zeros((0, WIDTH))).vectors(table)[0]


def learn(docs: DataFrame, text: str = "text", topics: int = 6) -> Topics:
    t = packed(docs, text)
    has = _table(t, lambda b: np.bincount(entries(b)[1], minlength=WIDTH).reshape(1, WIDTH), 1)[0]
    rarity = np.log((1 + t.count()) / (1 + has))

    def sums(centres: np.ndarray) -> np.ndarray:
        def add(b: pa.RecordBatch) -> np.ndarray:
            first, at, v, _ = _unit(b, rarity)
            own = _likeness(first, at, v, centres).argmax(axis=1)
            return np.bincount(np.repeat(own * WIDTH, _lengths(first, at)) + at, np.rint(v * UNIT), len(centres) * WIDTH).reshape(len(centres), WIDTH)

        return _table(t, add, len(centres))

    first = _start(t, rarity, sums(np.zeros((1, WIDTH))) / UNIT, -1)
    if not first:
        return Topics(rarity, np.zeros((0, WIDTH)))
    centres = first[1][None]
    while len(centres) < topics:
        like, v = _start(t, rarity, centres, 1)
        if like > 1 - 1e-9:
            break
        centres = np.concatenate((centres, v[None]))
    for _ in range(ROUNDS):
        new = sums(centres)
        size = np.sqrt((new * new).sum(axis=1, keepdims=True))
        new = np.divide(new, size, out=centres.copy(), where=size > 0)
        if np.allclose(new, centres):
            break
        centres = new
    return Topics(rarity, centres)


def assigner(docs: DataFrame, model: Topics, counter=None):
    """A Column function: text to its topic and number of words, and, with a unigram.Counter, n_tokens.

    The counter works in the same Python worker: of two such columns each would have a worker of its own in every task.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    names = ["topic", "n_words", *(["n_tokens"] if counter else [])]

    @F.arrow_udf("struct<topic:string,n_words:long" + (",n_tokens:long>" if counter else ">"))
    def assign(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            for part in slices(texts, TEXTS, TEXT_BYTES):
                topic, n = shared.value.of(part)
                more = [counter(part)] if counter else []
                yield pa.StructArray.from_arrays([pa.array(topic, pa.string()), pa.array(n.astype(np.int64)), *more], names=names)
        if counter:
            counter.rest()
        give_back()

    return assign.asNondeterministic()  # or each use of it would compute it again
