"""What the operators share: word rules, the shared scratch folder, size-checked broadcasts."""

from __future__ import annotations

import atexit
import contextlib
import tempfile
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: A word is a run of anything but space, tab, line feed, vertical tab, form feed and carriage return.
SPACES = r"[\x20\x09-\x0D]+"
#: Most bytes that a broadcast side may take, by row count times BROADCAST_ROW_BYTES.
BROADCAST_BYTES = 64 << 20
#: What an entry of a broadcast hash relation on one or two longs takes, with slack.
BROADCAST_ROW_BYTES = 64

_made: list[tuple[SparkSession, str]] = []


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share. Where the session names none, one of our own if everything runs in this process, else an error."""
    at = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not at:
        master = spark.sparkContext.master
        if not (master == "local" or master.startswith("local[")):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        at = tempfile.mkdtemp(prefix="flowtide-")
        spark.sparkContext.setCheckpointDir(at)
    return at


def checkpoint(df: DataFrame) -> DataFrame:
    """Cuts lineage through the shared folder; Spark removes the files once nothing refers to them."""
    shared_dir(df.sparkSession)
    return df.checkpoint()


def stash(df: DataFrame, tag: str) -> DataFrame:
    """Writes a table to the shared folder and reads it back: columnar, and safe from lost executors."""
    spark = df.sparkSession
    at = f"{shared_dir(spark)}/flowtide-{tag}-{uuid.uuid4().hex}"
    df.write.parquet(at)
    _made.append((spark, at))
    return spark.read.schema(df.schema).parquet(at)


@contextlib.contextmanager
def scratch():
    """Removes the tables that were stashed inside, but for those passed to the function it gives: what a finished stage leaves."""
    before, kept = len(_made), set()
    yield lambda df: (kept.update(df.inputFiles()), df)[1]
    for spark, at in _made[before:]:
        name = at.rstrip("/").rsplit("/", 1)[-1]
        if not any(f"/{name}/" in f for f in kept):
            _remove(spark, at)
            _made.remove((spark, at))


def _remove(spark: SparkSession, at: str) -> None:
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(at)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


@atexit.register
def _remove_all() -> None:
    for spark, at in _made:
        try:
            _remove(spark, at)
        except Exception:  # the session may be gone by now
            pass
    _made.clear()


def small(df: DataFrame, row_bytes: int = BROADCAST_ROW_BYTES, limit: int = BROADCAST_BYTES) -> DataFrame:
    """df with a broadcast hint if its counted rows fit the limit, else df as it is, for a shuffled join.

    df should be a stashed table, or the count computes it twice.
    """
    return F.broadcast(df) if df.count() * row_bytes <= limit else df.hint("merge")


def words(text: Column) -> Column:
    """The words of a text as an array, empty for null."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), SPACES), lambda w: w != "")


def slices(texts: pa.Array, rows: int = 1000, size: int = 4 << 20) -> Iterator[pa.Array]:
    """An array of texts in order, at most `rows` rows and `size` bytes at a time (or a single row), so that a worker's memory hangs on neither batch nor text sizes."""
    ends = np.concatenate([[0], np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False))])
    start = 0
    while start < len(texts):
        fits = int(np.searchsorted(ends, ends[start] + size, side="right")) - 1
        stop = min(max(fits, start + 1), start + rows, len(texts))
        yield texts.slice(start, stop - start)
        start = stop


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
