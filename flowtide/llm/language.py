"""Operator 10, language ID by compression.

Each language has a zstandard raw-content dictionary made of a bounded sample of its texts. Only letters
tell a language: text is lower-cased and every run of other characters becomes one space. It is then cut
into blocks of BLOCK bytes so that the dictionary counts as much in a long text as in a short one; every
block is compressed with every dictionary, and the language with the smallest total is chosen (of equal
ones, the first in the alphabet). The margin is the saving against the second best, as a share of the best
total without frame overhead; a text whose margin is below `margin` is rejected as too close to call.

Training: the sample takes, for each language, distinct texts with letters that have the smallest hashes, `per_text` characters from
a hash-chosen place in each (a head that texts share fills no dictionary), up to `dictionary` bytes. Every label with a text that has a
letter is learned; with so many that their dictionaries would take more than `together` bytes, each gets an equal share of that, 512
bytes at least. Prediction reads the text alone, all of it.

Defined cases: a letter is a character of Unicode's category L. Null text, or text without a letter, is "und" with score 0 and
rejected. With no labelled text every prediction is "und". With a single language it is chosen with score 1. Rows that repeat have
equal results; copies of a text count once in training. An empty table gives an empty result. All columns are kept, but one that
has the name of the output is replaced.
"""

from __future__ import annotations

import functools
import math
import re
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import slices
from .text_arrays import give_back

BLOCK, LEVEL = 4096, 6
UND = "und"
#: A letter, for Spark.
LETTER = r"\p{L}"
#: Compressed bits a byte of text in the margin to log-odds; fitted once so that scores spread over 0 to 1.
SHARPNESS = 60.0


#: Python's word characters but for decimal digits and the underscore: letters, and other numbers such as fractions.
OTHER = re.compile(r"[\W\d_]+")


@functools.cache
def _numbers() -> dict[int, str]:
    """Those other numbers, each to a space."""
    return {ord(c): " " for c in map(chr, range(0x80, 0x110000)) if c.isnumeric() and not c.isalpha() and not c.isdecimal()}


def letters(text: str | None) -> bytes:
    """The text's words of letters alone, between single spaces; nothing if it has no letter."""
    found = OTHER.sub(" ", (text or "").lower()).strip()
    if not found.isascii() and not _numbers().keys().isdisjoint(map(ord, found)):
        found = " ".join(found.translate(_numbers()).split())
    return f" {found} ".encode("utf-8", "replace") if found else b""


class Classifier:
    """Dictionaries by language; the compressors are made where they are used."""

    def __init__(self, dictionaries: dict[str, bytes]):
        self.dictionaries = dict(sorted(dictionaries.items()))
        self._compress = None

    def __getstate__(self):
        return {"dictionaries": self.dictionaries, "_compress": None}

    def sizes(self, raw: bytes) -> list[int]:
        """Compressed size of a text under each language's dictionary."""
        if self._compress is None:
            self._compress = []
            for d in self.dictionaries.values():
                data = zstandard.ZstdCompressionDict(d, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
                data.precompute_compress(level=LEVEL)
                self._compress.append(zstandard.ZstdCompressor(level=LEVEL, dict_data=data, write_checksum=False, write_content_size=False, write_dict_id=False))
        blocks = [raw[k : k + BLOCK] for k in range(0, len(raw), BLOCK)]
        return [sum(len(c.compress(b)) for b in blocks) for c in self._compress]

    def predict(self, text: str | None) -> tuple[str, float, float]:
        """Language, score from 0 to 1, margin."""
        raw = letters(text)
        if not raw or not self.dictionaries:
            return UND, 0.0, 0.0
        names = list(self.dictionaries)
        if len(names) == 1:
            return names[0], 1.0, 1.0
        sizes = self.sizes(raw)
        order = sorted(range(len(names)), key=lambda i: (sizes[i], i))
        best, second = sizes[order[0]], sizes[order[1]]
        margin = (second - best) / best
        score = 1 / sum(math.exp(-SHARPNESS * (s - best) / best) for s in sizes)
        return names[order[0]], score, margin


def _piece(text: Column, size: int) -> Column:
    """`size` characters from a place that the text's hash chooses, from its first letter on if those have none; a shorter text whole."""
    place = F.pmod(F.xxhash64(text), F.greatest(F.length(text) - size + 1, F.lit(1))).cast("int") + 1
    piece = F.substring(text, place, size)
    return F.when(piece.rlike(LETTER), piece).otherwise(F.substring(F.regexp_extract(text, f"(?s){LETTER}.*", 0), 1, size))


def train(docs: DataFrame, text: str = "text", lang: str = "lang", where: Column | None = None, dictionary: int = 32_768, per_text: int = 1024, together: int = 4 << 20) -> Classifier:
    """One dictionary for each label, from the texts where `where` holds."""
    rows = docs.select(F.col(lang).cast("string").alias("l"), F.col(text).alias("t"), (F.lit(True) if where is None else where).alias("w"))
    rows = rows.where("w and l is not null and t is not null").where(F.col("t").rlike(LETTER))
    rows = rows.select("l", _piece(F.col("t"), per_text).alias("t")).withColumn("h", F.xxhash64("t"))  # only texts that can fill a dictionary
    # Distinct texts are counted, as copies count once below; equal hashes are taken for equal texts here, in the count alone.
    counts = rows.select("l", "h").distinct().groupBy("l").agg(F.count("*").alias("n")).collect()  # a row for each label
    size = max(512, min(dictionary, together // max(1, len(counts))))
    need = 2 * max(1, size // per_text) + 16
    # The texts with the smallest hashes: a cut that lets about twice `need` distinct texts of each language pass, then an exact top of those.
    span = 1 << 63
    cuts = [(r.l, int(-span + min(2 * span - 1, min(1.0, 2.0 * need / r.n) * 2 * span))) for r in counts]
    near = rows.join(F.broadcast(docs.sparkSession.createDataFrame(cuts, "l string, cut long")), "l").where("h <= cut").select("l", "h", "t").distinct()
    rank = F.row_number().over(Window.partitionBy("l").orderBy("h", "t"))  # over about twice `need` rows of a label
    top = near.withColumn("k", rank).where(F.col("k") <= need).collect()  # at most `need` texts of per_text characters a label
    out: dict[str, bytes] = {}
    for r in sorted(top, key=lambda r: (r.l, r.k)):
        out[r.l] = out.get(r.l, b"") + letters(r.t)
    return Classifier({k: v[:size] for k, v in out.items() if v})


PREDICTION = "struct<lang_pred:string,score:double,margin:double>"


def predictor(docs: DataFrame, classifier: Classifier):
    """A Column function: text to its prediction."""
    shared = docs.sparkSession.sparkContext.broadcast(classifier)
    kind = pa.struct([("lang_pred", pa.string()), ("score", pa.float64()), ("margin", pa.float64())])

    @F.arrow_udf(PREDICTION)
    def predict(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        c = shared.value
        for batch in texts:
            for text in slices(batch):
                yield pa.array([dict(zip(("lang_pred", "score", "margin"), c.predict(x))) for x in text.to_pylist()], kind)
        give_back()

    return predict.asNondeterministic()  # or a filter on the prediction would compute it a second time


def identify(docs: DataFrame, classifier: Classifier, text: str = "text", margin: float = 0.005, out: str = "language") -> DataFrame:
    """docs with the struct `out` (lang_pred, score, margin, rejected) added."""
    p = predictor(docs, classifier)(F.col(text))
    return docs.withColumn(out, p).withColumn(out, F.struct(f"{out}.*", ((F.col(f"{out}.lang_pred") == UND) | (F.col(f"{out}.margin") < margin)).alias("rejected")))
