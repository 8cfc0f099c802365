"""Media columns: a data source for archives of lossless 8-bit images, written and read as byte ranges.

``media_archive`` writes each row's samples as a PNG (grey, 8 bit, 64 samples a line) into archive files, one series per
task; each commit adds a manifest that names the files of the attempts that counted, and a commit that overwrites names the
manifests it replaces. Reading plans byte ranges over the files of all manifests that stand; a range reads its own slice of
the index at the file's end, checks each member against its checksum, reads a member that fails again, alone, by its offset
and through a newly opened file, and streams Arrow batches.

Defined cases: null and empty texts are 64 zero bytes with n_bytes 0; texts whose length is a multiple of 64 are not
padded; long texts are one member of any length; null ids stay null; repeated rows are a member each; extra columns are
never read; an empty table gives no rows; equal texts give equal values.
"""

from __future__ import annotations

import bisect
import contextlib
import hashlib
import json
import struct
import time
import uuid
import zlib

import numpy as np
import pyarrow as pa
from pyarrow.fs import FileSelector
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceReader, InputPartition, WriterCommitMessage

from tierflow.llm.base import Workspace, filesystem, rows_of

WIDTH = 64
MEMBERS = "doc_id long, n_bytes long, media binary"
_MEMBERS = pa.schema([("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("media", pa.binary())])
_ENTRY = np.dtype([("offset", "<i8"), ("size", "<i8"), ("crc", "<u4"), ("null", "u1"), ("doc", "<i8"), ("n", "<i8")])
PNG = b"\x89PNG\r\n\x1a\n"


def _chunk(kind: bytes, data: bytes) -> bytes:
    return struct.pack(">I", len(data)) + kind + data + struct.pack(">I", zlib.crc32(kind + data))


def to_png(samples: bytes, level: int = 2) -> bytes:
    """A grey 8-bit PNG of samples whose number is a multiple of 64."""
    lines = np.zeros((len(samples) // WIDTH, WIDTH + 1), np.uint8)
    lines[:, 1:] = np.frombuffer(samples, np.uint8).reshape(-1, WIDTH)
    head = struct.pack(">IIBBBBB", WIDTH, len(lines), 8, 0, 0, 0, 0)
    return PNG + _chunk(b"IHDR", head) + _chunk(b"IDAT", zlib.compress(lines.tobytes(), level)) + _chunk(b"IEND", b"")


def from_png(raw: bytes) -> bytes:
    if raw[:8] != PNG:
        raise ValueError("not a PNG")
    at, data, size = 8, [], None
    while at < len(raw):
        (n,) = struct.unpack(">I", raw[at : at + 4])
        kind, body = raw[at + 4 : at + 8], raw[at + 8 : at + 8 + n]
        if zlib.crc32(kind + body) != struct.unpack(">I", raw[at + 8 + n : at + 12 + n])[0]:
            raise ValueError("a PNG chunk does not match its checksum")
        if kind == b"IHDR":
            size = struct.unpack(">IIBBBBB", body)
        elif kind == b"IDAT":
            data.append(body)
        at += 12 + n
    if size is None or size[0] != WIDTH or size[2:] != (8, 0, 0, 0, 0):
        raise ValueError("not of the kind written here")
    lines = np.frombuffer(zlib.decompress(b"".join(data)), np.uint8).reshape(size[1], WIDTH + 1)
    if lines[:, 0].any():
        raise ValueError("filtered lines")
    return lines[:, 1:].tobytes()


def padded(text: bytes) -> bytes:
    return text.ljust(max(WIDTH, -(-len(text) // WIDTH) * WIDTH), b"\0")


def feature(samples: np.ndarray) -> str:
    """Mean, deviation, entropy in bits and mean absolute step of the samples."""
    n = len(samples)
    hist = np.bincount(samples, minlength=256)
    level = np.arange(256)
    total, square = int((hist * level).sum()), int((hist * level * level).sum())
    p = hist[hist > 0] / n
    step = int(np.abs(np.diff(samples.astype(np.int16))).sum(dtype=np.int64))
    return f"mean={total / n:.4f};dev={max(square / n - (total / n) ** 2, 0) ** 0.5:.4f};bits={-(p * np.log2(p)).sum():.4f};step={step / max(n - 1, 1):.4f}"


class Files(WriterCommitMessage):
    """Of each file: name, number of members, and a mark (offset, member) for each ``MARK`` bytes of data, the end last."""

    def __init__(self, files: list[tuple[str, int, list[tuple[int, int]]]]):
        self.files = files


MARK = 8 << 20


def manifests(uri: str) -> dict[str, dict]:
    """The manifests that stand under ``uri``, by path."""
    fs, path = filesystem(f"{uri}/_manifests")
    found = {}
    for info in fs.get_file_info(FileSelector(path, allow_not_found=True)):
        if info.path.endswith(".json"):
            with fs.open_input_stream(info.path) as f:
                found[info.base_name] = json.loads(f.read())
    gone = {x for m in found.values() for x in m["replaces"]}
    return {k: m for k, m in found.items() if k not in gone}


class ArchiveWriter(DataSourceArrowWriter):
    def __init__(self, uri: str, file_bytes: int, overwrite: bool):
        self.uri, self.file_bytes, self.overwrite = uri, file_bytes, overwrite

    def write(self, iterator) -> Files:
        files, out, entries, marks, at = [], None, [], [], 0

        def close():
            index = np.array(entries, _ENTRY).tobytes()
            out.write(index + struct.pack("<Q", len(entries)))
            out.close()
            files.append((name, len(entries), [*marks, (at, len(entries))]))

        for batch in iterator:
            for doc, n, media in zip(*(batch.column(k).to_pylist() for k in ("doc_id", "n_bytes", "media")), strict=True):
                if out is None:
                    name = f"{uuid.uuid4().hex}.arc"
                    fs, path = filesystem(f"{self.uri}/{name}")
                    out, entries, marks, at = fs.open_output_stream(path), [], [], 0
                if at >= len(marks) * MARK:
                    marks.append((at, len(entries)))
                out.write(media)
                entries.append((at, len(media), zlib.crc32(media), doc is None, doc or 0, n))
                at += len(media)
                if at >= self.file_bytes:
                    close()
                    out = None
        if out is not None:
            close()
        return Files(files)

    def commit(self, messages) -> None:
        """One manifest a commit, in place by a rename: readers see all of a commit or nothing."""
        manifest = {"replaces": list(manifests(self.uri)) if self.overwrite else [], "files": [x for m in messages if m for x in m.files]}
        name = uuid.uuid4().hex
        fs, path = filesystem(f"{self.uri}/_manifests")
        fs.create_dir(path, recursive=True)
        with fs.open_output_stream(f"{path}/{name}.part") as f:
            f.write(json.dumps(manifest).encode())
        fs.move(f"{path}/{name}.part", f"{path}/{name}.json")

    def abort(self, messages) -> None:
        """Files of a failed write stay unlisted and are never read."""


class Range(InputPartition):
    """The members of a file that begin in [lo, hi), among the entries [first, last) of its index."""

    def __init__(self, name: str, data_end: int, lo: int, hi: int, first: int, last: int):
        self.name, self.data_end, self.lo, self.hi, self.first, self.last = name, data_end, lo, hi, first, last


def ranges(name: str, marks: list[tuple[int, int]], size: int) -> list[Range]:
    """Byte ranges of ``size`` over a file, each with the entries between the marks around it."""
    offsets, members = zip(*marks, strict=True)
    end, out = offsets[-1], []
    for lo in range(0, end, size):
        hi = min(lo + size, end)
        first = members[bisect.bisect_right(offsets, lo) - 1]
        out.append(Range(name, end, lo, hi, first, members[min(bisect.bisect_left(offsets, hi), len(members) - 1)]))
    return out


def with_retries(read, attempts: int, pause: float = 0.05):
    """The result of ``read``, tried again after an error or a checksum that does not match."""
    for k in range(attempts):
        try:
            return read()
        except (OSError, ValueError):
            if k == attempts - 1:
                raise
            time.sleep(pause * 2**k)


class Members:
    """Reads a file by offsets. A failed read drops the open file, so that the next attempt has a new one."""

    def __init__(self, open_file, name: str, attempts: int):
        self.open_file, self.name, self.attempts, self.file = open_file, name, attempts, None

    def close(self) -> None:
        file, self.file = self.file, None
        if file is not None:
            with contextlib.suppress(OSError):
                file.close()

    def at(self, offset: int, size: int, crc: int | None = None) -> bytes:
        def once() -> bytes:
            try:
                self.file = self.file or self.open_file()
                self.file.seek(offset)
                raw = self.file.read(size)
                if len(raw) != size or crc is not None and zlib.crc32(raw) != crc:
                    raise ValueError(f"{self.name} at {offset}: not as written")
                return raw
            except (OSError, ValueError):
                self.close()
                raise

        return with_retries(once, self.attempts)


class ArchiveReader(DataSourceReader):
    def __init__(self, uri: str, range_bytes: int, attempts: int, batch_bytes: int = 4 << 20):
        self.uri, self.range_bytes, self.attempts, self.batch_bytes = uri, range_bytes, attempts, batch_bytes

    def partitions(self):
        found = [r for m in manifests(self.uri).values() for name, _, marks in m["files"] for r in ranges(name, marks, self.range_bytes)]
        return found or [Range("", 0, 0, 0, 0, 0)]

    def read(self, partition):
        if not partition.name:
            return
        fs, path = filesystem(f"{self.uri}/{partition.name}")
        members = Members(lambda: fs.open_input_file(path), partition.name, self.attempts)
        try:
            step = _ENTRY.itemsize
            index = np.frombuffer(members.at(partition.data_end + partition.first * step, (partition.last - partition.first) * step), _ENTRY)
            first, last = np.searchsorted(index["offset"], [partition.lo, partition.hi])
            rows, size = [], 0
            for x in index[first:last]:
                media = members.at(int(x["offset"]), int(x["size"]), int(x["crc"]))
                rows.append((None if x["null"] else int(x["doc"]), int(x["n"]), media))
                size += len(media)
                if size >= self.batch_bytes:
                    yield _batch(rows)
                    rows, size = [], 0
            if rows:
                yield _batch(rows)
        finally:
            members.close()


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip(zip(*rows, strict=True), _MEMBERS, strict=True)], schema=_MEMBERS)


class MediaArchive(DataSource):
    """Options: path; ``rangeBytes`` of a partition, ``fileBytes`` of an archive, ``attempts`` for a member."""

    @classmethod
    def name(cls) -> str:
        return "media_archive"

    def schema(self) -> str:
        return MEMBERS

    def reader(self, schema) -> ArchiveReader:
        return ArchiveReader(self.options["path"], int(self.options.get("rangeBytes", 8 << 20)), int(self.options.get("attempts", 4)))

    def writer(self, schema, overwrite: bool) -> ArchiveWriter:
        return ArchiveWriter(self.options["path"], int(self.options.get("fileBytes", 32 << 20)), overwrite)


def _to_media(batches):
    for batch in batches:
        texts = batch.column("text")
        for i in range(0, len(batch), 256):
            rows = [(x or "").encode() for x in texts.slice(i, 256).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id").slice(i, 256), pa.array(map(len, rows), pa.int64()), pa.array([to_png(padded(x)) for x in rows], pa.binary())], schema=_MEMBERS)


FEATURES = "doc_id long, n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string"


def _features(batches):
    for batch in batches:
        rows = []
        for media in batch.column("media"):
            media = media.as_py()
            payload = from_png(media)
            rows.append((len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-WIDTH:]), len(media), hashlib.sha256(media).hexdigest(), feature(np.frombuffer(payload, np.uint8))))
        kinds = (pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string())
        columns = zip(*rows, strict=True) if rows else [()] * 6
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("n_bytes"), *(pa.array(x, k) for x, k in zip(columns, kinds, strict=True))], [x.split()[0] for x in FEATURES.split(", ")])


def store(docs: DataFrame, uri: str, mode: str = "append") -> None:
    """Writes ``docs`` (doc_id, text) as archives under ``uri``; ``mode`` is append or overwrite."""
    spark = docs.sparkSession
    spark.dataSource.register(MediaArchive)
    fs, path = filesystem(uri)
    fs.create_dir(path, recursive=True)
    docs = rows_of(docs)
    docs.mapInArrow(_to_media, MEMBERS).write.format("media_archive").mode(mode).save(uri)


def load(spark: SparkSession, uri: str) -> DataFrame:
    """(doc_id, n_bytes, media) of every member under ``uri``."""
    spark.dataSource.register(MediaArchive)
    return spark.read.format("media_archive").load(uri)


def media_features(docs: DataFrame) -> DataFrame:
    uri = Workspace(docs.sparkSession, "media").path("archives")
    store(docs, uri)
    return load(docs.sparkSession, uri).mapInArrow(_features, FEATURES)
