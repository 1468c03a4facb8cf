"""The change log as a Spark data source: format "changelog", batch and streaming.

A log is a folder of Parquet segments with columns lsn (long), kind (first byte of the frame) and frame (binary), in order
of lsn, each with whole transactions. Names sort like positions. Options: path; maxBytesPerTrigger (segments are admitted
until their sizes reach it, one at least); ackPath (a folder that is told the acknowledged position).

Offsets are {"lsn": n}, n being the end of the last admitted segment that ends in a commit, a marker or an idle position:
a batch never ends inside a transaction, and one that holds no change still moves the offset. Files are reached through
pyarrow's file systems, by the path's scheme.
"""

from __future__ import annotations

import json

import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.fs as pafs
import pyarrow.parquet as pq
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, InputPartition

SCHEMA = "lsn long, kind string, frame binary"
ARROW = pa.schema([("lsn", pa.int64()), ("kind", pa.string()), ("frame", pa.binary())])


def _at(path: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (pafs.LocalFileSystem(), path)


def write_segment(path: str, name: str, frames: list[tuple[int, bytes]]) -> None:
    """Frames (lsn, message) of whole transactions as one segment, put in place by a rename."""
    fs, folder = _at(path)
    fs.create_dir(folder, recursive=True)
    t = pa.table({"lsn": [n for n, _ in frames], "kind": [chr(f[0]) for _, f in frames], "frame": [f for _, f in frames]}, ARROW)
    with fs.open_output_stream(f"{folder}/.{name}.tmp") as f:
        pq.write_table(t, f)
    fs.move(f"{folder}/.{name}.tmp", f"{folder}/{name}.parquet")


class Segment(InputPartition):
    def __init__(self, file: str, start: int, end: int):
        self.file, self.start, self.end = file, start, end


def _segments(path: str) -> list[tuple[str, int, int, int]]:
    """file, first and last lsn, bytes: from names and footers alone."""
    fs, folder = _at(path)
    out = []
    for info in sorted(fs.get_file_info(pafs.FileSelector(folder, allow_not_found=True)), key=lambda i: i.base_name):
        if info.base_name.startswith(".") or not info.base_name.endswith(".parquet"):
            continue
        with fs.open_input_file(info.path) as f:
            meta = pq.ParquetFile(f).metadata
        stats = [meta.row_group(g).column(0).statistics for g in range(meta.num_row_groups)]
        if meta.num_rows:
            out.append((info.path, min(s.min for s in stats), max(s.max for s in stats), info.size))
    return out


def _read(path: str, part: Segment):
    fs, _ = _at(path)
    with fs.open_input_file(part.file) as f:
        for b in pq.ParquetFile(f).iter_batches(batch_size=8192):
            lsn = b.column("lsn")
            yield b.filter(pc.and_(pc.greater(lsn, part.start), pc.less_equal(lsn, part.end)))


class _Batch(DataSourceReader):
    def __init__(self, options):
        self.path = options["path"]

    def partitions(self):
        return [Segment(f, -1, hi) for f, _, hi, _ in _segments(self.path)] or [Segment("", 0, -1)]

    def read(self, partition):
        if partition.file:
            yield from _read(self.path, partition)


class _Stream(DataSourceStreamReader):
    def __init__(self, options):
        self.path, self.limit = options["path"], int(options.get("maxbytespertrigger", options.get("maxBytesPerTrigger", 1 << 62)))
        self.acks, self.admitted = options.get("ackpath", options.get("ackPath")), -1

    def initialOffset(self):
        return {"lsn": -1}

    def latestOffset(self):
        size = 0
        for _, _, hi, n in _segments(self.path):
            if hi > self.admitted:
                if size and size + n > self.limit:
                    break
                size, self.admitted = size + n, hi
        return {"lsn": self.admitted}

    def partitions(self, start, end):
        self.admitted = max(self.admitted, end["lsn"])
        return [Segment(f, start["lsn"], end["lsn"]) for f, lo, hi, _ in _segments(self.path) if hi > start["lsn"] and lo <= end["lsn"]] or [Segment("", 0, -1)]

    def read(self, partition):
        if partition.file:
            yield from _read(self.path, partition)

    def commit(self, end):
        """Told when the next batch is planned, so this lags one batch behind what is delivered."""
        if self.acks:
            fs, folder = _at(self.acks)
            fs.create_dir(folder, recursive=True)
            with fs.open_output_stream(f"{folder}/.ack.tmp") as f:
                f.write(json.dumps(end).encode())
            fs.move(f"{folder}/.ack.tmp", f"{folder}/ack.json")


class ChangelogSource(DataSource):
    @classmethod
    def name(cls):
        return "changelog"

    def schema(self):
        return SCHEMA

    def reader(self, schema):
        return _Batch(self.options)

    def streamReader(self, schema):
        return _Stream(self.options)
