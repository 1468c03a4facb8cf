"""A folder for intermediate and streaming state that driver and executors share."""

from __future__ import annotations

import atexit
import tempfile
import uuid

from pyspark.sql import SparkSession


_made: list[tuple[SparkSession, str]] = []


def shared_folder(spark: SparkSession, tag: str) -> str:
    """A new path below spark.checkpoint.dir; a temporary folder only where the session names none and all runs in this process. Removed when the program ends."""
    top = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not top:
        master = spark.sparkContext.master
        if not (master == "local" or master.startswith("local[")):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        top = tempfile.mkdtemp(prefix="flowtide-")
    at = f"{top}/{tag}-{uuid.uuid4().hex}"
    _made.append((spark, at))
    return at


def remove(spark: SparkSession, at: str) -> None:
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(at)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


@atexit.register
def _remove_all() -> None:
    for spark, at in _made:
        try:
            remove(spark, at)
        except Exception:  # the session may be gone by now
            pass


def settle(df, tag: str = "table"):
    """Writes a table there and reads it back: its plan is cut, and losing an executor loses none of it."""
    at = shared_folder(df.sparkSession, tag)
    df.write.parquet(at)
    return df.sparkSession.read.schema(df.schema).parquet(at)
