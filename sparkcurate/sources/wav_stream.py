"""Long 16 kHz mono 16-bit WAV clips as a data source: each partition is a range of a clip's samples."""

from __future__ import annotations

import struct
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from .audio import RATE

#: Samples of a partition, and of a row.
PART, ROW = 1 << 22, 1_600


@dataclass(frozen=True)
class Clip:
    """Where a clip's samples are: path, first byte, number."""

    path: str
    first: int
    samples: int


def _open(path: str):
    from pyarrow import fs

    store, inside = fs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (fs.LocalFileSystem(), path)
    return store.open_input_file(inside)


def located(path: str) -> Clip:
    """Reads the headers of a RIFF file, not its samples; other rates, channels, widths and codings are an error, and so is a file without samples' chunk."""
    with _open(path) as f:
        size = f.size()
        head = f.read_at(12, 0)
        if head[:4] != b"RIFF" or head[8:12] != b"WAVE":
            raise ValueError(f"{path}: no WAV file")
        at, known = 12, False
        while at + 8 <= size:
            name, length = struct.unpack("<4sI", f.read_at(8, at))
            if name == b"fmt ":
                coding, channels, rate, _, _, bits = struct.unpack("<HHIIHH", f.read_at(16, at + 8))
                if (coding, channels, rate, bits) != (1, 1, RATE, 16):
                    raise ValueError(f"{path}: not 16 kHz mono 16-bit")
                known = True
            elif name == b"data":
                if not known:
                    raise ValueError(f"{path}: samples come before their format")
                return Clip(path, at + 8, min(length, size - at - 8) // 2)
            at += 8 + length + length % 2
    raise ValueError(f"{path}: no samples")


@dataclass
class SampleRange(InputPartition):
    clip: Clip
    begin: int
    end: int


class WavSource(DataSource):
    """Rows (clip, position, samples): a clip's name, the place of a run of samples in it, and the samples, from -1 up to 1.

    Options: path, a file or a folder's pattern; part, samples of a partition; row, samples of a row. Runs are as long as row but for a
    clip's last. A clip without samples gives no rows.
    """

    @classmethod
    def name(cls) -> str:
        return "wav16k"

    def schema(self) -> str:
        return "clip string, position long, samples array<float>"

    def reader(self, schema) -> WavReader:
        return WavReader(self.options)


class WavReader(DataSourceReader):
    def __init__(self, options) -> None:
        self.paths = [p for p in options.get("paths", "").split("\n") if p]
        self.row = int(options.get("row", ROW))
        # partitions begin where rows do
        self.part = max(1, int(options.get("part", PART)) // self.row) * self.row

    def partitions(self) -> list[SampleRange]:
        out = []
        for path in self.paths:
            clip = located(path)
            out += [SampleRange(clip, at, min(at + self.part, clip.samples)) for at in range(0, clip.samples, self.part)]
        return out or [SampleRange(Clip("", 0, 0), 0, 0)]

    def read(self, partition: SampleRange) -> Iterator[pa.RecordBatch]:
        if partition.begin >= partition.end:
            return
        clip = partition.clip.path.rsplit("/", 1)[-1].rsplit(".", 1)[0]
        step = max(1, (1 << 18) // self.row) * self.row
        with _open(partition.clip.path) as f:
            for at in range(partition.begin, partition.end, step):
                end = min(at + step, partition.end)
                found = np.frombuffer(f.read_at(2 * (end - at), partition.clip.first + 2 * at), "<i2")
                samples = (found / 32768.0).astype(np.float32)
                starts = np.arange(0, len(samples), self.row)
                rows = pa.ListArray.from_arrays(pa.array(np.append(starts, len(samples)), pa.int32()), pa.array(samples))
                yield pa.RecordBatch.from_arrays([pa.array([clip] * len(starts)), pa.array(at + starts), rows], ["clip", "position", "samples"])


def long_clips(spark: SparkSession, path: str, part: int = PART, row: int = ROW):
    """(clip, position, samples) of WAV files, by ranges; path may have patterns. The driver lists files and the source reads their headers, a few bytes each."""
    spark.dataSource.register(WavSource)
    hadoop = spark._jvm.org.apache.hadoop.fs
    p = hadoop.Path(path)
    found = p.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(p)
    paths = sorted(s.getPath().toString() for s in found or [] if s.isFile())
    plain = [x.removeprefix("file:") if x.startswith("file:/") and not x.startswith("file://") else x for x in paths]
    return spark.read.format("wav16k").options(paths="\n".join(plain), part=part, row=row).load()
