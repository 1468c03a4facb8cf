"""Unigram segmentation by an Aho-Corasick automaton and a single Viterbi pass.

Operators 1 (count only) and 5 (encode and decode) stand on the same scan. The vocabulary is read from a
SentencePiece model file whose path is a parameter; its ordinary pieces and scores are taken as a unigram
language model, whatever algorithm the file was made for, and its byte pieces spell what no piece covers.

Text is normalised as the file asks: spaces become U+2581 and one U+2581 goes in front. No piece has
U+2581 after another character, so the best segmentation falls apart before every run of U+2581, and each
such stretch is segmented once and remembered, in a memory of fixed size. A vocabulary without that
property is scanned text by text.

Ties: the segmentation that reaches a position first keeps it unless another scores strictly more, and the
longest piece reaches it first. A character that starts no one-character piece may stand alone at the
lowest piece score less 10 and is then spelled in bytes. Scores are added as doubles.

Defined cases: null text encodes to null and counts null; an empty text has no pieces; no text is too long. Rows that
repeat have equal results, an empty table gives an empty one. All columns are kept, but one that has the name of an output
(n_tokens, ids, decoded or the name asked for) is replaced.
"""

from __future__ import annotations

import functools
import hashlib
import re
from array import array
from collections.abc import Iterator
from dataclasses import dataclass

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import slices
from .text_arrays import give_back

SPACE = "▁"
UNKNOWN_PENALTY = 10.0
NONE = float("-inf")
#: Stretches remembered by each Python worker, and the longest stretch that is remembered.
MEMO_ENTRIES, MEMO_CHARS = 200_000, 64


@dataclass(frozen=True)
class Vocabulary:
    """pieces: (piece, score, id) of ordinary pieces; bytes_: ids of the 256 byte pieces, or none; unk: the unknown id."""

    pieces: tuple[tuple[str, float, int], ...]
    bytes_: tuple[int, ...]
    unk: int

    @functools.cached_property
    def key(self) -> str:
        """A digest of every piece, score and id."""
        return hashlib.sha256(repr((self.pieces, self.bytes_, self.unk)).encode()).hexdigest()

    @staticmethod
    def read(model_path: str) -> "Vocabulary":
        """From a SentencePiece model file that the driver can open."""
        from sentencepiece import sentencepiece_model_pb2 as pb

        with open(model_path, "rb") as f:
            model = pb.ModelProto.FromString(f.read())
        ordinary = [(p.piece, float(p.score), i) for i, p in enumerate(model.pieces) if p.type in (1, 4)]
        spelled = {p.piece: i for i, p in enumerate(model.pieces) if p.type == 6}
        unk = next((i for i, p in enumerate(model.pieces) if p.type == 2), 0)
        return Vocabulary(tuple(ordinary), tuple(spelled[f"<0x{b:02X}>"] for b in range(256)) if len(spelled) == 256 else (), unk)


class Scanner:
    """The automaton of one vocabulary, built once in each Python worker."""

    def __init__(self, vocabulary: Vocabulary):
        self.v = vocabulary
        self.scan = ahocorasick.Automaton()
        for piece, score, i in vocabulary.pieces:
            self.scan.add_word(piece, (len(piece), score, i))
        self.scan.make_automaton()
        self.unknown = min((s for _, s, _ in vocabulary.pieces), default=0.0) - UNKNOWN_PENALTY
        self.apart = all(SPACE not in p.lstrip(SPACE) for p, _, _ in vocabulary.pieces)
        self.counts, self.codes = Memo(self._count), Memo(self._code)
        self.single = {p for p, _, _ in vocabulary.pieces if len(p) == 1}
        surface = {i: p.encode() for p, _, i in vocabulary.pieces} | {i: bytes([b]) for b, i in enumerate(vocabulary.bytes_)}
        surface.setdefault(vocabulary.unk, " ⁇ ".encode())
        self.surface = pa.array([surface.get(i, b"") for i in range(max(surface) + 1)], pa.large_binary())

    def stretches(self, text: str) -> list[str]:
        """The independent stretches of a non-empty text, each without the space it starts with."""
        text = text.replace(SPACE, " ")
        if not self.apart:
            return [text]
        if "  " not in text and text[0] != " " and text[-1] != " ":
            return text.split(" ")
        return [s[1:] for s in re.findall(r" +[^ ]*", " " + text)]

    def _matches(self, stretch: str):
        """Yields, end by end, the matches that end there, longest first."""
        found, k = list(self.scan.iter(stretch)), 0
        for end in range(len(stretch)):
            first = k
            while k < len(found) and found[k][0] == end:
                k += 1
            yield end + 1, found[first:k]

    def _spelled(self, char: str) -> int:
        return len(char.encode("utf-8", "replace")) if self.v.bytes_ else 1

    def _count(self, stretch: str) -> int:
        """Pieces of the best segmentation: only the best score and its piece count are carried.

        Adjacent unknown characters without byte pieces make one unknown piece, so a flag is carried too.
        """
        s = SPACE + stretch.replace(" ", SPACE)
        count = [0] * (len(s) + 1)
        if self.single.issuperset(s):  # no character is unknown
            best = [0.0] + [NONE] * len(s)
            for end, (n, score, _) in self.scan.iter(s):
                if best[end + 1 - n] + score > best[end + 1]:
                    best[end + 1] = best[end + 1 - n] + score
                    count[end + 1] = count[end + 1 - n] + 1
            return count[-1]
        best, loose = [0.0] * (len(s) + 1), [False] * (len(s) + 1)
        for end, matches in self._matches(s):
            top = NONE
            for _, (n, score, _) in matches:
                if best[end - n] + score > top:
                    top, count[end] = best[end - n] + score, count[end - n] + 1
            if s[end - 1] not in self.single and best[end - 1] + self.unknown > top:
                top, loose[end] = best[end - 1] + self.unknown, True
                count[end] = count[end - 1] + (0 if loose[end - 1] and not self.v.bytes_ else self._spelled(s[end - 1]))
            best[end] = top
        return count[-1]

    def _code(self, stretch: str) -> bytes:
        """Ids of the best segmentation as native int32s."""
        s = SPACE + stretch.replace(" ", SPACE)
        back = [(0, -1)] * (len(s) + 1)
        if self.single.issuperset(s):
            best = [0.0] + [NONE] * len(s)
            for end, (n, score, i) in self.scan.iter(s):
                if best[end + 1 - n] + score > best[end + 1]:
                    best[end + 1] = best[end + 1 - n] + score
                    back[end + 1] = (end + 1 - n, i)
        else:
            best = [0.0] * (len(s) + 1)
            for end, matches in self._matches(s):
                top = NONE
                for _, (n, score, i) in matches:
                    if best[end - n] + score > top:
                        top, back[end] = best[end - n] + score, (end - n, i)
                if s[end - 1] not in self.single and best[end - 1] + self.unknown > top:
                    top, back[end] = best[end - 1] + self.unknown, (end - 1, -1)
                best[end] = top
        ids, end = [], len(s)
        while end:
            start, i = back[end]
            if i >= 0:
                ids.append(i)
            elif self.v.bytes_:
                ids.extend(self.v.bytes_[b] for b in reversed(s[start:end].encode("utf-8", "replace")))
            elif not ids or ids[-1] != self.v.unk:
                ids.append(self.v.unk)
            end = start
        return array("i", reversed(ids)).tobytes()

    def count(self, text: str | None) -> int | None:
        return None if text is None else sum(map(self.counts.__getitem__, self.stretches(text))) if text else 0

    def encode(self, text: str) -> bytes:
        return b"".join(map(self.codes.__getitem__, self.stretches(text))) if text else b""

    def decode(self, ids: pa.ListArray) -> list[str | None]:
        """The text of each list of ids, null for null.

        Pieces are joined, bytes put back together (U+FFFD where they are not UTF-8), U+2581 is a space, the first is dropped.
        """
        ends = ids.offsets.to_numpy()
        spelled = self.surface.take(ids.values.slice(ends[0], ends[-1] - ends[0]))
        at = np.frombuffer(spelled.buffers()[1], dtype=np.int64, count=len(spelled) + 1)[ends - ends[0]] if len(spelled) else np.zeros(len(ends), np.int64)
        raw, out = spelled.buffers()[2], []
        for a, b, there in zip(at.tolist(), at[1:].tolist(), ids.is_valid().to_pylist()):
            text = bytes(raw[a:b]).decode("utf-8", "replace").replace(SPACE, " ") if b > a else ""
            out.append((text[1:] if text[:1] == " " else text) if there else None)
        return out


class Memo(dict):
    """Results of a function, forgotten all at once when there are too many."""

    def __init__(self, f):
        super().__init__()
        self.f = f

    def __missing__(self, key):
        value = self.f(key)
        if len(key) <= MEMO_CHARS:
            if len(self) >= MEMO_ENTRIES:
                self.clear()
            self[key] = value
        return value


_scanners: dict[str, Scanner] = {}


def scanner(vocabulary: Vocabulary) -> Scanner:
    if vocabulary.key not in _scanners:
        _scanners.clear()
        _scanners[vocabulary.key] = Scanner(vocabulary)
    return _scanners[vocabulary.key]


def _rest() -> None:
    """What a worker does at the end of a task: it lets go of automaton and memory, as it may stay idle beside those that need the room."""
    _scanners.clear()
    give_back()


class Counter:
    """Numbers of pieces of an array of texts, for use in Python workers; rest() at the end of a task."""

    def __init__(self, spark: SparkSession, vocabulary: Vocabulary):
        self.shared = spark.sparkContext.broadcast(vocabulary)

    def __call__(self, texts: pa.Array) -> pa.Array:
        s = scanner(self.shared.value)
        return pa.array([s.count(x) for x in texts.to_pylist()], pa.int64())

    def rest(self) -> None:
        _rest()


def token_count(spark: SparkSession, vocabulary: Vocabulary):
    """A Column function: text to its number of pieces (long)."""
    counter = Counter(spark, vocabulary)

    @F.arrow_udf("long")
    def count(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in texts:
            for text in slices(batch):
                yield counter(text)
        counter.rest()

    return count


def encoder(spark: SparkSession, vocabulary: Vocabulary):
    """A Column function: text to its array of ids."""
    shared = spark.sparkContext.broadcast(vocabulary)

    @F.arrow_udf("array<int>")
    def encode(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        s = scanner(shared.value)
        for batch in texts:
            for text in slices(batch):
                yield _ids(s, text)
        _rest()

    return encode


def _ids(s: Scanner, text: pa.Array) -> pa.ListArray:
    codes = [None if x is None else s.encode(x) for x in text.to_pylist()]
    ends = np.cumsum([0, *(len(c or b"") // 4 for c in codes)])
    flat = pa.array(np.frombuffer(b"".join(c or b"" for c in codes), dtype=np.int32))
    return pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), flat, mask=pa.array([c is None for c in codes]))


def _texts(s: Scanner, ids: pa.ListArray) -> pa.Array:
    out = []
    for k in range(0, len(ids), 500):
        out += s.decode(ids.slice(k, 500))
    return pa.array(out, pa.string())


def decoder(spark: SparkSession, vocabulary: Vocabulary):
    """A Column function: array of ids to the text they spell."""
    shared = spark.sparkContext.broadcast(vocabulary)

    @F.arrow_udf("string")
    def decode(ids: pa.Array) -> pa.Array:
        return _texts(scanner(shared.value), ids)

    return decode


def count_tokens(docs: DataFrame, vocabulary: Vocabulary, text: str = "text", out: str = "n_tokens") -> DataFrame:
    """docs with the column `out` added; a column of that name is replaced. Null text: null."""
    return docs.withColumn(out, token_count(docs.sparkSession, vocabulary)(F.col(text)))


def encode(docs: DataFrame, vocabulary: Vocabulary, text: str = "text", out: str = "ids") -> DataFrame:
    """docs with the ids added as `out`."""
    return docs.withColumn(out, encoder(docs.sparkSession, vocabulary)(F.col(text)))


def decode(docs: DataFrame, vocabulary: Vocabulary, ids: str = "ids", out: str = "text") -> DataFrame:
    """docs with the text that `ids` spell added as `out`."""
    return docs.withColumn(out, decoder(docs.sparkSession, vocabulary)(F.col(ids)))


def encode_and_decode(docs: DataFrame, vocabulary: Vocabulary, text: str = "text", ids: str = "ids", back: str = "decoded") -> DataFrame:
    """docs with the ids, and with the text that these ids spell, from one visit to Python."""
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)

    @F.arrow_udf("struct<ids:array<int>,back:string>")
    def code(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        s = scanner(shared.value)
        for batch in texts:
            for text in slices(batch):
                found = _ids(s, text)
                yield pa.StructArray.from_arrays([found, _texts(s, found)], names=["ids", "back"])
        _rest()

    # computed once, however often it is used; the nested name meets no column of docs
    d = docs.select(F.struct("*").alias("row"), code.asNondeterministic()(F.col(text)).alias("coded"))
    return d.select(*(F.col("row")[c].alias(c) for c in docs.columns if c not in (ids, back)), F.col("coded.ids").alias(ids), F.col("coded.back").alias(back))


def normalised(text: Column) -> Column:
    """What decoding gives back: the text with U+2581 as a space."""
    return F.translate(text, SPACE, " ")
