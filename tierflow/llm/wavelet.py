"""Token ids in wavelet-matrix shards: rank and select over succinct bit-planes, one compressed file per shard.

File: magic, header length, JSON header, then zstd frames: document ids, a null mask, document lengths and, from the highest
bit to the lowest, the rank directory of each bit-plane (ones before each block of 512 bits) and the plane itself in pieces
of ``PIECE`` bytes. The header tells where every frame lies, so a token, a count or an occurrence is answered from the
directories and the pieces that hold the bits asked for; the rest of the file is neither read nor decompressed.

Reading back a range of tokens follows it down the levels as the intervals it takes there, one for each prefix of ids that
occurs in it, by the ranks of their two ends; the bits in the intervals then put the ids in order. The query gets its
documents so.

Defined cases: null texts are empty (their end id alone); null doc_ids come first; rows that share a doc_id are ordered by
text; extra columns are never read; an empty table gives no shard and no rows.
"""

from __future__ import annotations

import json
import struct
import zlib

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F

from tierflow.llm.base import Workspace, filesystem, parts, row_chunks, rows_of, text_buffers
from tierflow.llm.word_bpe import encoder, vocabulary, with_end

MAGIC, LEVELS = b"WVMX0002", 16
PIECE, BLOCK = 1 << 15, 64  # bytes of a compressed piece of a plane; bytes of a block of the rank directory
STEP = 1 << 15  # tokens of a level that are moved at once


def _places(bit: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of zeros and of ones: numpy takes and puts by them faster than by a mask."""
    return (~bit).nonzero()[0], bit.nonzero()[0]


def build(ids: np.ndarray, step: int = STEP) -> list[tuple[int, np.ndarray]]:
    """(zeros, packed bits) per level, highest bit first. A level is dealt out in steps that stay in the processor's cache."""
    planes, cur = [], ids.astype(np.uint16)
    for level in range(LEVELS):
        bit = (cur & np.uint16(1 << (LEVELS - 1 - level))) != 0
        a, b = 0, len(cur) - int(np.count_nonzero(bit))
        planes.append((b, np.packbits(bit, bitorder="little")))
        down = np.empty_like(cur)
        for k in range(0, len(cur), step):
            some, (zeros, ones) = cur[k : k + step], _places(bit[k : k + step])
            some.take(zeros, out=down[a : a + len(zeros)], mode="clip")  # no place is outside; only this mode needs no copy of ``out``
            some.take(ones, out=down[b : b + len(ones)], mode="clip")
            a, b = a + len(zeros), b + len(ones)
        cur = down
    return planes


def _undeal(bit: np.ndarray, down: np.ndarray, step: int = STEP) -> np.ndarray:
    """What ``build`` dealt out by ``bit`` (zeros first), in its order again; both halves are read in steps, front to back."""
    up, a, b = np.empty_like(down), 0, len(down) - int(np.count_nonzero(bit))
    for k in range(0, len(down), step):
        some, (zeros, ones) = up[k : k + step], _places(bit[k : k + step])
        some[zeros], some[ones] = down[a : a + len(zeros)], down[b : b + len(ones)]
        a, b = a + len(zeros), b + len(ones)
    return up


def directory(plane: np.ndarray) -> np.ndarray:
    """Ones before each block of a plane, and in all."""
    ones = np.bitwise_count(np.pad(plane, (0, -len(plane) % BLOCK))).reshape(-1, BLOCK).sum(axis=1, dtype=np.uint32)
    return np.concatenate((np.zeros(1, np.uint32), np.cumsum(ones, dtype=np.uint32)))


def _within(bits: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """The bits of all intervals, one after the other."""
    if (starts[1:] == ends[:-1]).all():  # one stretch: all of a shard takes a level whole
        return bits[starts[0] : ends[-1]]
    size = ends - starts
    total = int(size.sum())
    if 64 * len(size) < total:  # long intervals: slices
        return np.concatenate([bits[a:b] for a, b in zip(starts.tolist(), ends.tolist(), strict=True)])
    return bits[np.repeat(starts - (np.cumsum(size) - size), size) + np.arange(total)]


def dump(doc_ids: list, lengths: np.ndarray, ids: np.ndarray) -> bytes:
    planes = build(ids)
    press = zstandard.ZstdCompressor(level=1).compress
    null = np.array([x is None for x in doc_ids], bool)
    frames = [press(np.array([x or 0 for x in doc_ids], np.int64).tobytes()), press(np.packbits(null).tobytes()), press(lengths.astype(np.int64).tobytes())]
    for _, plane in planes:
        frames.append(press(directory(plane).tobytes()))
        raw = plane.tobytes()
        frames += [press(raw[k : k + PIECE]) for k in range(0, len(raw), PIECE)]
    head = json.dumps({"tokens": len(ids), "docs": len(doc_ids), "zeros": [z for z, _ in planes], "frames": [len(x) for x in frames]}).encode()
    return b"".join([MAGIC, struct.pack("<I", len(head)), head, *frames])


class Shard:
    """An opened shard. ``read`` (offset, size) -> bytes serves its file; bytes are a file in memory."""

    def __init__(self, read):
        if isinstance(read, bytes):
            raw = read
            read = lambda at, size: raw[at : at + size]
        start = read(0, 12)
        if start[:8] != MAGIC:
            raise ValueError("not a wavelet shard")
        (size,) = struct.unpack("<I", start[8:12])
        head = json.loads(read(12, size))
        self.read, self.n, self.zeros = read, head["tokens"], head["zeros"]
        self.sizes = head["frames"]
        self.places = np.concatenate(([0], np.cumsum(self.sizes))) + 12 + size
        self.pieces = -(-(-(-self.n // 8)) // PIECE)  # of a plane
        null = np.unpackbits(np.frombuffer(self._frame(1), np.uint8), count=head["docs"]).astype(bool)
        self.doc_ids = [None if x else y for x, y in zip(null.tolist(), np.frombuffer(self._frame(0), np.int64).tolist(), strict=True)]
        self.lengths = np.frombuffer(self._frame(2), np.int64)
        self._ranks: dict[int, np.ndarray] = {}
        self._held: dict[tuple[int, int], bytes] = {}
        self._whole: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]] = {}

    def _frame(self, k: int) -> bytes:
        return zstandard.ZstdDecompressor().decompress(self.read(int(self.places[k]), self.sizes[k]))

    def _first(self, level: int) -> int:
        return 3 + level * (1 + self.pieces)

    def _directory(self, level: int) -> np.ndarray:
        if level not in self._ranks:
            self._ranks[level] = np.frombuffer(self._frame(self._first(level)), np.uint32)
        return self._ranks[level]

    def _piece(self, level: int, k: int) -> bytes:
        if (level, k) not in self._held:
            self._held[level, k] = self._frame(self._first(level) + 1 + k)
        return self._held[level, k]

    def _plane(self, level: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """A plane's bits, its words of 64 bits and the ones before each word: what many positions at once are looked up in."""
        if level not in self._whole:
            raw = b"".join(self._piece(level, k) for k in range(self.pieces))
            words = np.frombuffer(raw.ljust((len(raw) // BLOCK + 1) * BLOCK, b"\0"), np.uint64).reshape(-1, BLOCK // 8)
            ones = np.bitwise_count(words)
            before = self._directory(level)[: len(words), None] + np.cumsum(ones, axis=1, dtype=np.int64) - ones
            bits = np.unpackbits(np.frombuffer(raw, np.uint8), count=self.n, bitorder="little").view(bool)
            self._whole[level] = bits, words.ravel(), before.ravel()
        return self._whole[level]

    def tokens(self, lo: int = 0, hi: int | None = None) -> np.ndarray:
        """The tokens at positions [lo, hi): the range's intervals of every level by rank, then its bits from the last level up."""
        starts, ends = np.array([lo], np.int64), np.array([self.n if hi is None else hi], np.int64)
        if ends[0] <= lo:
            return np.zeros(0, np.uint16)
        values, inside = np.zeros(1, np.uint16), []
        for level in range(LEVELS):
            bits, words, before = self._plane(level)
            inside.append(_within(bits, starts, ends))
            at = np.concatenate((starts, ends))
            place, rest = at >> 6, (at & 63).astype(np.uint64)
            ones = before[place] + np.bitwise_count(words[place] & ((np.uint64(1) << rest) - np.uint64(1)))
            a, b = ones[: len(starts)], ones[len(starts) :]
            zero, one = np.flatnonzero(ends - b > starts - a), np.flatnonzero(b > a)
            starts = np.concatenate(((starts - a)[zero], self.zeros[level] + a[one]))
            ends = np.concatenate(((ends - b)[zero], self.zeros[level] + b[one]))
            values = np.concatenate((values[zero], values[one] | np.uint16(1 << (LEVELS - 1 - level))))
        out = np.repeat(values, ends - starts)
        while inside:
            out = _undeal(inside.pop(), out)
        return out

    def all_tokens(self) -> np.ndarray:
        return self.tokens()

    def _rank1(self, level: int, i: int) -> int:
        """Ones before position i of a level: an entry of the directory and at most ``BLOCK`` bytes of one piece."""
        block, rest = divmod(i, 8 * BLOCK)
        ones = int(self._directory(level)[block])
        if not rest:
            return ones
        k, at = divmod(block * BLOCK, PIECE)
        tail = np.frombuffer(self._piece(level, k)[at : at + (rest + 7) // 8], np.uint8)
        return ones + int(np.unpackbits(tail, bitorder="little")[:rest].sum())

    def access(self, i: int) -> int:
        if not 0 <= i < self.n:
            raise IndexError(i)
        value = 0
        for level in range(LEVELS):
            k, at = divmod(i >> 3, PIECE)
            bit = self._piece(level, k)[at] >> (i & 7) & 1
            ones = self._rank1(level, i)
            i = self.zeros[level] + ones if bit else i - ones
            value = value << 1 | int(bit)
        return value

    def _range(self, token: int, lo: int, hi: int) -> tuple[int, int]:
        for level in range(LEVELS):
            a, b = self._rank1(level, lo), self._rank1(level, hi)
            lo, hi = (self.zeros[level] + a, self.zeros[level] + b) if token >> (LEVELS - 1 - level) & 1 else (lo - a, hi - b)
        return lo, hi

    def count(self, token: int, lo: int = 0, hi: int | None = None) -> int:
        """Occurrences of a token in positions [lo, hi)."""
        a, b = self._range(token, lo, self.n if hi is None else hi)
        return b - a

    def _select(self, level: int, bit: int, k: int) -> int:
        """Position of the k-th (from 0) given bit of a level: its block from the directory, then inside the block."""
        ones = self._directory(level).astype(np.int64)
        ranks = ones if bit else np.minimum(np.arange(len(ones)) * 8 * BLOCK, self.n) - ones
        block = int(np.searchsorted(ranks, k, "right")) - 1
        piece, at = divmod(block * BLOCK, PIECE)
        bits = np.unpackbits(np.frombuffer(self._piece(level, piece)[at : at + BLOCK], np.uint8), bitorder="little")
        return block * 8 * BLOCK + int(np.flatnonzero(bits == bit)[k - int(ranks[block])])

    def find(self, token: int, k: int) -> int:
        """Position of the k-th (from 0) occurrence of a token."""
        a, b = self._range(token, 0, self.n)
        if not 0 <= k < b - a:
            raise IndexError(k)
        i = a + k
        for level in range(LEVELS - 1, -1, -1):
            bit = token >> (LEVELS - 1 - level) & 1
            i = self._select(level, bit, i - self.zeros[level] if bit else i)
        return i


def _writer(uri: str, vocab: str, shard_tokens: int):
    def write(batches):
        import uuid

        pid, seq, held = TaskContext.get().partitionId(), 0, []

        def flush():
            ids, per, docs = (np.concatenate([x[0] for x in held]), np.concatenate([x[1] for x in held]), [y for x in held for y in x[2]])
            held.clear()
            name = f"{uri}/{pid:06d}-{seq:06d}-{uuid.uuid4().hex}.wvm"  # a repeated task leaves its own files; the manifest names one
            fs, path = filesystem(name)
            with fs.open_output_stream(path) as f:
                f.write(dump(docs, per, ids))
            return pa.RecordBatch.from_pydict({"pid": [pid], "seq": [seq], "uri": [name], "docs": [len(docs)], "tokens": [len(ids)]}, schema=pa.schema([("pid", pa.int32()), ("seq", pa.int32()), ("uri", pa.string()), ("docs", pa.int64()), ("tokens", pa.int64())]))

        for batch in batches:
            b, offs = text_buffers(batch.column("text"))
            docs = batch.column("doc_id").to_pylist()
            for i, j in row_chunks(offs):
                held.append((*with_end(*encoder(vocab).encode(b[offs[i] : offs[j]], offs[i : j + 1] - offs[i])), docs[i:j]))
                if sum(len(x[0]) for x in held) >= shard_tokens:
                    yield flush()
                    seq += 1
        if held:
            yield flush()

    return write


def open_shard(file) -> Shard:
    """A shard over an open file that can be read at any place."""

    def read(at: int, size: int) -> bytes:
        file.seek(at)
        return file.read(size)

    return Shard(read)


def _reader(batches, run: int = 1 << 22):
    """Documents are read back in runs of about ``run`` tokens: a usual shard in one, whose ranks and stretches are the fewest."""
    for batch in batches:
        for uri, base in zip(batch.column("uri").to_pylist(), batch.column("base").to_pylist(), strict=True):
            fs, path = filesystem(uri)
            with fs.open_input_file(path) as f:
                shard = open_shard(f)
                ends = np.cumsum(shard.lengths)
                starts, crc = ends - shard.lengths, []
                for i, j in row_chunks(np.concatenate(([0], ends)), run):
                    ids, lo = shard.tokens(int(starts[i]), int(ends[j - 1])).astype("<u4"), int(starts[i])
                    crc += [zlib.crc32(ids[s - lo : e - lo]) for s, e in zip(starts[i:j].tolist(), ends[i:j].tolist(), strict=True)]
            yield pa.RecordBatch.from_arrays([pa.array(shard.doc_ids, pa.int64()), pa.array(base + starts), pa.array(shard.lengths), pa.array(crc, pa.int64())], ["doc_id", "start", "n_tokens", "ids_crc32"])


def find_token(manifest: DataFrame, token: int) -> DataFrame:
    """(doc_id, position) of every occurrence of a token id, position counted over all documents: select in each shard."""

    def run(batches):
        for batch in batches:
            for uri, base in zip(batch.column("uri").to_pylist(), batch.column("base").to_pylist(), strict=True):
                fs, path = filesystem(uri)
                with fs.open_input_file(path) as f:
                    shard = open_shard(f)
                    at = np.array([shard.find(token, k) for k in range(shard.count(token))], np.int64)
                    ends = np.cumsum(shard.lengths)
                    docs = [shard.doc_ids[k] for k in np.searchsorted(ends, at, "right").tolist()]
                yield pa.RecordBatch.from_arrays([pa.array(docs, pa.int64()), pa.array(base + at)], ["doc_id", "position"])

    return manifest.select("uri", "base").mapInArrow(run, "doc_id long, position long")


def write_shards(docs: DataFrame, ws: Workspace, vocab: str | None = None, shard_tokens: int = 2_000_000) -> DataFrame:
    """Writes the ids of ``docs`` (doc_id, text) in ascending doc_id order; the manifest (pid, seq, uri, docs, tokens, base).

    An empty table gives an empty manifest.
    """
    docs = rows_of(docs)
    docs = docs.repartitionByRange(parts(docs.sparkSession), "doc_id").sortWithinPartitions("doc_id", "text")
    write = _writer(ws.path("shards"), vocab or vocabulary(), shard_tokens)
    fs, path = filesystem(ws.path("shards"))
    fs.create_dir(path, recursive=True)
    manifest = ws.keep(docs.mapInArrow(write, "pid int, seq int, uri string, docs long, tokens long"), "manifest")
    # One total per partition, whose number is set and not grown by the data, then running sums inside partitions.
    total = manifest.groupBy("pid").agg(F.sum("tokens").alias("t"))
    total = total.select("pid", (F.sum("t").over(Window.orderBy("pid")) - F.col("t")).alias("before"))
    inside = F.sum("tokens").over(Window.partitionBy("pid").orderBy("seq")) - F.col("tokens")
    return manifest.withColumn("inside", inside).join(F.broadcast(total), "pid").withColumn("base", F.col("inside") + F.col("before")).drop("inside", "before")


def read_shards(manifest: DataFrame) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document, from the files."""
    spread = manifest.select("uri", "base").repartition(4 * parts(manifest.sparkSession))
    return spread.mapInArrow(_reader, "doc_id long, start long, n_tokens long, ids_crc32 long")


def store_tokens(docs: DataFrame, vocab: str | None = None, shard_tokens: int = 2_000_000) -> DataFrame:
    return read_shards(write_shards(docs, Workspace(docs.sparkSession, "wavelet"), vocab, shard_tokens))
