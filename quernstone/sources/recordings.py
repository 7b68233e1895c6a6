"""Recordings as a DataFrame source: chunks of samples with seek, trim and resampling.

    spark.dataSource.register(Recordings)
    spark.read.format("recordings").option("rate", 16000).option("start_s", 5).load("s3://bucket/folder")

The driver lists the files and cuts them into byte ranges; a task reads a header and then only the bytes of the chunks
that begin in its range, with the few samples around them that the resampling filter needs. So an hour of sound is many
tasks, none of which has more than a chunk in memory, and chunks are the same wherever the ranges are cut.

Options: path (a file or a folder, of any store that Arrow reads), rate (of the samples, 16000), chunk_s (30), start_s
and dur_s (what of each file to read), range_bytes (16 MB).

Rows: path, chunk (from 0), start_s (from what start_s names), duration_s, rate (the file's own), samples. A file
without samples, or with start_s beyond its end, is one row with null samples and 0 s; one that can't be read is the
same with a null rate.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from quernstone.functions import resampling

SCHEMA = "path string, chunk int, start_s double, duration_s double, rate int, samples array<float>"
ARROW = pa.schema([("path", pa.string()), ("chunk", pa.int32()), ("start_s", pa.float64()), ("duration_s", pa.float64()), ("rate", pa.int32()), ("samples", pa.list_(pa.float32()))])
PCM, FLOAT, EXTENSIBLE = 1, 3, 0xFFFE


@dataclass
class Header:
    rate: int
    channels: int
    width: int
    floats: bool
    data: int
    frames: int


def read_header(file, size: int) -> Header:
    """Where the samples of a RIFF file are and what they are. A data chunk that claims more than the file has, as streams do, ends with it."""
    file.seek(0)
    top = file.read(12)
    if len(top) < 12 or top[:4] not in (b"RIFF", b"RF64") or top[8:] != b"WAVE":
        raise ValueError("no wave file")
    at, form = 12, None
    while at + 8 <= size:
        file.seek(at)
        name, length = struct.unpack("<4sI", file.read(8))
        if name == b"fmt ":
            body = file.read(min(length, 40))
            kind, channels, rate, _, _, bits = struct.unpack("<HHIIHH", body[:16])
            if kind == EXTENSIBLE and len(body) >= 26:
                kind = struct.unpack("<H", body[24:26])[0]
            if kind not in (PCM, FLOAT) or not channels or not rate or bits not in ((8, 16, 24, 32) if kind == PCM else (32, 64)):
                raise ValueError("unknown sample format")
            form = kind, channels, rate, bits // 8
        elif name == b"data":
            if not form:
                raise ValueError("no format before the samples")
            kind, channels, rate, width = form
            return Header(rate, channels, width, kind == FLOAT, at + 8, min(length, size - at - 8) // (channels * width))
        at += 8 + length + (length & 1)
    raise ValueError("no samples")


def decoded(raw: bytes, h: Header) -> np.ndarray:
    """Samples between -1 and 1, channels averaged."""
    if h.floats:
        y = np.frombuffer(raw, f"<f{h.width}").astype(np.float64)
    elif h.width == 1:
        y = (np.frombuffer(raw, np.uint8).astype(np.float64) - 128) / 128
    elif h.width == 3:
        b = np.frombuffer(raw, np.uint8).reshape(-1, 3).astype(np.int32)
        y = ((b[:, 0] << 8 | b[:, 1] << 16 | b[:, 2] << 24) >> 8) / float(1 << 23)
    else:
        y = np.frombuffer(raw, f"<i{h.width}") / float(1 << (8 * h.width - 1))
    return np.nan_to_num(y.reshape(-1, h.channels).mean(axis=1))


@dataclass
class Range(InputPartition):
    path: str
    size: int
    low: int
    high: int


class Reader(DataSourceReader):
    def __init__(self, options: dict[str, str]) -> None:
        self.path = options.get("path", "")
        self.rate = int(options.get("rate", 16000))
        self.chunk_s, self.start_s = float(options.get("chunk_s", 30)), float(options.get("start_s", 0))
        self.dur_s = float(options["dur_s"]) if options.get("dur_s") else None
        self.range_bytes = int(options.get("range_bytes", 16 << 20))
        if self.rate <= 0 or self.chunk_s * self.rate < 1 or self.range_bytes <= 0 or self.start_s < 0:
            raise ValueError("rate, chunk_s and range_bytes must be positive, start_s not negative")

    def store(self) -> tuple[fs.FileSystem, str]:
        return fs.FileSystem.from_uri(self.path) if "://" in self.path or self.path.startswith("file:") else (fs.LocalFileSystem(), self.path)

    def partitions(self) -> list[Range]:
        files, root = self.store()
        info = files.get_file_info(root)
        found = [info] if info.type == fs.FileType.File else files.get_file_info(fs.FileSelector(root, recursive=True))
        found = [f for f in found if f.type == fs.FileType.File and (f.path == root or f.extension.lower() in ("wav", "wave"))]
        return [Range(f.path, f.size, low, low + self.range_bytes) for f in sorted(found, key=lambda f: f.path) for low in range(0, max(f.size, 1), self.range_bytes)]

    def read(self, part: Range) -> Iterator[pa.RecordBatch]:
        files, _ = self.store()
        try:
            with files.open_input_file(part.path) as file:
                h = read_header(file, part.size)
                yield from self.chunks(file, h, part)
        except (ValueError, struct.error, OSError, pa.ArrowInvalid):
            if part.low == 0:
                yield self.row(part.path, 0, 0.0, None, None)

    def chunks(self, file, h: Header, part: Range) -> Iterator[pa.RecordBatch]:
        begin = min(round(self.start_s * h.rate), h.frames)
        n = h.frames - begin if self.dur_s is None else min(h.frames - begin, round(self.dur_s * h.rate))
        if n <= 0:
            if part.low == 0:
                yield self.row(part.path, 0, 0.0, h.rate, None)
            return
        up, down = resampling.ratio(h.rate, self.rate)
        total, block = resampling.length(n, up, down), round(self.chunk_s * self.rate)
        width = h.channels * h.width
        for k in range(-(-total // block)):
            first, last = k * block, min((k + 1) * block, total)
            # a chunk belongs to the range that has its first byte; what comes before the samples is the first range's
            at = h.data + (begin + first * down // up) * width
            if not part.low <= at < part.high:
                continue
            a, b = (first, last) if up == down else resampling.span(first, last, up, down)
            file.seek(h.data + (begin + max(a, 0)) * width)
            y = decoded(file.read((min(b, n) - max(a, 0)) * width), h)
            if up != down:
                y = np.clip(resampling.outputs(np.pad(y, (max(-a, 0), max(b - n, 0))), first, last, up, down), -1, 1)
            yield self.row(part.path, k, first / self.rate, h.rate, y.astype(np.float32))

    def row(self, path: str, k: int, start: float, rate: int | None, y: np.ndarray | None) -> pa.RecordBatch:
        return pa.RecordBatch.from_pylist([{"path": path, "chunk": k, "start_s": start, "duration_s": 0.0 if y is None else len(y) / self.rate, "rate": rate, "samples": y}], ARROW)


class Recordings(DataSource):
    @classmethod
    def name(cls) -> str:
        return "recordings"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> Reader:
        return Reader(dict(self.options))
