"""Spark data source ``capture``: receiver captures read by byte ranges, in batch or as they grow, and written
so that files appear only when the whole job has succeeded.

Read options: ``path`` (a folder), ``glob`` (file names), ``rangeBytes`` (bytes of a task), ``counts`` (one row a
range with its number of records instead of the records). A file of any size is read in ranges
(``records``); nothing is read as a whole. Files whose names begin with ``_`` or ``.`` are no captures.

As a stream the offset is a byte position for each file. A micro-batch ends at a record's start or at
a complete frame; an unfinished tail stays for the next one and is read again with what has been added.

Files are reached through ``pyarrow.fs`` (local, HDFS, object stores).
"""

from __future__ import annotations

import fnmatch
import hashlib
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql.datasource import (DataSource, DataSourceArrowWriter, DataSourceReader, DataSourceStreamReader, InputPartition,
                                    WriterCommitMessage)

from . import records as R

RANGE_BYTES = 32 << 20
SCHEMA = "capture_id string, file_key long, range_start long, nth long, offset long, ts_us long, raw binary"
COUNTS = "file_key long, range_start long, records long"


def _files(path: str, glob: str) -> list[tuple[str, int]]:
    fs, root = pafs.FileSystem.from_uri(path)
    found = fs.get_file_info(pafs.FileSelector(root, allow_not_found=True))
    return sorted((f.path, f.size) for f in found
                  if f.is_file and f.base_name[:1] not in "_." and fnmatch.fnmatch(f.base_name, glob))


def file_key(path: str) -> int:
    return int.from_bytes(hashlib.blake2b(path.encode(), digest_size=8).digest(), "little", signed=True)


class Range(InputPartition):
    """Records that start in [start, stop) of a file that counts as finished at ``end``; ``base``: a known record start."""

    def __init__(self, path: str, start: int, stop: int, end: int, base: int):
        self.path, self.start, self.stop, self.end, self.base = path, start, stop, end, base


def _ranges(path: str, start: int, end: int, size: int) -> list[Range]:
    return [Range(path, s, min(s + size, end), end, start) for s in range(start, end, size)]


class Group(InputPartition):
    """Ranges that one task reads: one large, or many small ones."""

    def __init__(self, ranges: list[Range]):
        self.ranges = ranges


def _grouped(ranges: list[Range], size: int) -> list[Group]:
    """Neighbouring ranges together up to ``size`` bytes, less where that would leave few tasks."""
    total = sum(r.stop - r.start for r in ranges)
    most = max(1 << 18, min(size, total // 32))
    groups, held = [], most
    for r in ranges:
        if held + r.stop - r.start > most:
            groups.append([])
            held = 0
        groups[-1].append(r)
        held += r.stop - r.start
    return [Group(g) for g in groups]


def _batches(folder: str, part: Range) -> Iterator[pa.RecordBatch]:
    fs, _ = pafs.FileSystem.from_uri(folder)
    name, done = part.path.rsplit("/", 1)[-1].rsplit(".", 1)[0], 0
    for data, heads, ends, at in R.records(R.Capture(fs, part.path, part.end), part.start, part.stop, part.base):
        inside = np.zeros(len(data) + 1, np.int8)
        inside[heads + R.HEADER] += 1
        inside[ends] -= 1
        raw = data[np.cumsum(inside[:-1], dtype=np.int8).astype(bool)]
        cut = np.append(0, np.cumsum(ends - heads - R.HEADER)).astype(np.int32)
        n = len(heads)
        raw = pa.Array.from_buffers(pa.binary(), n, [None, pa.py_buffer(cut), pa.py_buffer(np.ascontiguousarray(raw))])
        yield pa.RecordBatch.from_arrays(
            [pa.array([name] * n, pa.string()), pa.array(np.full(n, file_key(part.path))), pa.array(np.full(n, part.start)),
             pa.array(np.arange(done, done + n)), pa.array(heads + at), pa.array(R.times(data, heads)), raw],
            names=["capture_id", "file_key", "range_start", "nth", "offset", "ts_us", "raw"])
        done += n


class CaptureReader(DataSourceReader):
    def __init__(self, options: dict):
        self.folder, self.glob = options["path"], options.get("glob", "*.cap")
        self.size = int(options.get("rangeBytes", RANGE_BYTES))
        self.counts = options.get("counts", "false").lower() == "true"

    def partitions(self) -> list[Group]:
        return _grouped([r for path, size in _files(self.folder, self.glob) for r in _ranges(path, 0, size, self.size)], self.size)

    def read(self, partition: Group | None) -> Iterator[pa.RecordBatch]:
        for part in partition.ranges if partition else []:  # None: no files
            if not self.counts:
                yield from _batches(self.folder, part)
                continue
            fs, _ = pafs.FileSystem.from_uri(self.folder)
            n = sum(len(heads) for _, heads, _, _ in R.records(R.Capture(fs, part.path, part.end), part.start, part.stop, part.base))
            yield pa.RecordBatch.from_arrays([pa.array([file_key(part.path)]), pa.array([part.start]), pa.array([n])],
                                             names=["file_key", "range_start", "records"])


class CaptureStreamReader(DataSourceStreamReader):
    """Offsets: {file: bytes delivered}, one entry for each capture of the folder."""

    def __init__(self, options: dict):
        self.folder, self.glob = options["path"], options.get("glob", "*.cap")
        self.size = int(options.get("rangeBytes", RANGE_BYTES))
        self.known: dict[str, int] = {}

    def initialOffset(self) -> dict:
        return {}

    def latestOffset(self) -> dict:
        fs, _ = pafs.FileSystem.from_uri(self.folder)
        for path, size in _files(self.folder, self.glob):
            base = self.known.get(path, 0)
            if size > base:
                self.known[path] = R.finished_end(R.Capture(fs, path, size), base)
        return {p: e for p, e in self.known.items() if e}

    def partitions(self, start: dict, end: dict) -> list[Group]:
        for path, stop in end.items():
            self.known[path] = max(stop, self.known.get(path, 0))  # after a restart: what was planned before
        return _grouped([r for path, stop in sorted(end.items()) if stop > start.get(path, 0)
                         for r in _ranges(path, start.get(path, 0), stop, self.size)], self.size)

    def read(self, partition: Group | None) -> Iterator[pa.RecordBatch]:
        for part in partition.ranges if partition else []:
            yield from _batches(self.folder, part)


class Written(WriterCommitMessage):
    def __init__(self, files: list[str]):
        self.files = files


class CaptureWriter(DataSourceArrowWriter):
    """Tasks write below ``_attempt-...``; ``commit`` moves the files of the tasks that succeeded into place."""

    def __init__(self, options: dict):
        self.folder = options["path"].rstrip("/")
        self.attempt = f"_attempt-{uuid.uuid4().hex[:12]}"

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        from pyspark import TaskContext

        fs, root = pafs.FileSystem.from_uri(self.folder)
        own = f"{self.attempt}/{TaskContext.get().taskAttemptId()}"
        fs.create_dir(f"{root}/{own}", recursive=True)
        files, name, stream = [], None, None
        for b in iterator:
            ids, records = b.column(b.schema.get_field_index("capture_id")), b.column(b.schema.get_field_index("record"))
            for capture_id, record in zip(ids.to_pylist(), records.to_pylist(), strict=True):
                if capture_id != name:
                    if stream is not None:
                        stream.close()
                    name = capture_id
                    files.append(f"{own}/{name}.cap")
                    stream = fs.open_output_stream(f"{root}/{files[-1]}")
                stream.write(record)
        if stream is not None:
            stream.close()
        return Written(files)

    def commit(self, messages: list) -> None:
        fs, root = pafs.FileSystem.from_uri(self.folder)
        fs.create_dir(root, recursive=True)
        for m in messages:
            for f in m.files if m else []:
                fs.move(f"{root}/{f}", f"{root}/{f.rsplit('/', 1)[-1]}")
        self._clear(fs, root)

    def abort(self, messages: list) -> None:
        fs, root = pafs.FileSystem.from_uri(self.folder)
        self._clear(fs, root)

    def _clear(self, fs, root: str) -> None:
        if fs.get_file_info(f"{root}/{self.attempt}").type == pafs.FileType.Directory:
            fs.delete_dir(f"{root}/{self.attempt}")


class CaptureSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "capture"

    def schema(self) -> str:
        return COUNTS if self.options.get("counts", "false").lower() == "true" else SCHEMA

    def reader(self, schema) -> CaptureReader:
        return CaptureReader(dict(self.options))

    def streamReader(self, schema) -> CaptureStreamReader:
        return CaptureStreamReader(dict(self.options))

    def writer(self, schema, overwrite: bool) -> CaptureWriter:
        return CaptureWriter(dict(self.options))
