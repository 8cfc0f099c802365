"""WARC archives with segmented records: writing, reading, reassembly and de-duplication by payload.

Write: of the records with equal payloads of at least ``least`` bytes the one with the largest page_id is a response, the
others are revisits without payload; smaller payloads are always responses. A block longer than ``segment_bytes`` is cut
into a first segment and continuation records. Bodies use chunked transfer framing. Each record is a gzip member of its
own; each task writes its own files, and the manifest names the files of the attempts that counted.

Read: whole records are decoded where they are read; segments are grouped by the identifier of their origin, ordered by
number and checked (numbers gapless from 1, total length as stated) before the framing is decoded.

Scale: the holder of each payload comes from a pre-aggregated maximum over digests. The pages meet their digest's holder by
(digest, page_id), which spreads copies of one payload over all tasks; every html moves once there, and no other exchange
carries html. Revisits are joined by digest without their html; adaptive execution splits that join where one digest is hot.
One reassembled group is one record.

Defined cases: a null html is an empty payload; a null page_id is smaller than any other; a repeated page row (same id and
payload) repeats its record; null urls are written as empty; an empty table gives no rows. Extra columns are never read.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from tierflow.llm.base import Workspace, filesystem, parts

HEAD = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
CHUNK = 8192
RECORDS = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, origin string, segment int, total long, block binary"
_SCHEMA = pa.schema([("page_id", pa.int64()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64()), ("origin", pa.string()), ("segment", pa.int32()), ("total", pa.int64()), ("block", pa.binary())])


class WarcError(ValueError):
    pass


def chunked(payload: bytes, size: int = CHUNK) -> bytes:
    out = []
    for i in range(0, len(payload), size):
        part = payload[i : i + size]
        out += [b"%x\r\n" % len(part), part, b"\r\n"]
    return b"".join([*out, b"0\r\n\r\n"])


def dechunked(body: bytes) -> bytes:
    """The payload of a chunked body; chunk extensions and trailers are skipped."""
    out, at = [], 0
    while True:
        end = body.find(b"\r\n", at)
        if end < 0:
            raise WarcError("chunk size expected")
        try:
            size = int(body[at:end].split(b";")[0].strip(), 16)
        except ValueError as e:
            raise WarcError("bad chunk size") from e
        at = end + 2
        if not size:
            return b"".join(out)
        if body[at + size : at + size + 2] != b"\r\n":
            raise WarcError("chunk ends early")
        out.append(body[at : at + size])
        at += size + 2


def payload_of(block: bytes) -> bytes:
    head, found, body = block.partition(b"\r\n\r\n")
    if not found:
        raise WarcError("no HTTP header")
    fields = {k.strip().lower(): v.strip().lower() for k, _, v in (x.partition(b":") for x in head.split(b"\r\n")[1:])}
    return dechunked(body) if b"chunked" in fields.get(b"transfer-encoding", b"") else body


def record(kind: str, rid: str, block: bytes, **fields) -> bytes:
    lines = [f"WARC-Type: {kind}", f"WARC-Record-ID: {rid}", "WARC-Date: 1970-01-01T00:00:00Z", *(f"{k.replace('_', '-')}: {v}" for k, v in fields.items() if v is not None), f"Content-Length: {len(block)}"]
    return b"WARC/1.1\r\n" + "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def base32(sha1_hex: str) -> str:
    return base64.b32encode(bytes.fromhex(sha1_hex)).decode()


def records_of(rid: str, page_id, url: str, html: str | None, sha1_hex: str, size: int, refers_to, response: bool, segment_bytes: int):
    """The records of one page, each as bytes."""
    common = {"WARC_Page_ID": page_id, "WARC_Target_URI": "".join((url or "").split()), "WARC_Payload_Digest": f"sha1:{base32(sha1_hex)}", "Content_Type": "application/http; msgtype=response"}
    if not response:
        yield record("revisit", rid, HEAD + b"Content-Length: %d\r\n\r\n" % size, WARC_Profile="http://netpreserve.org/warc/1.1/revisit/identical-payload-digest", WARC_Refers_To_Page_ID=refers_to, **common)
        return
    block = HEAD + b"Transfer-Encoding: chunked\r\n\r\n" + chunked((html or "").encode())
    if len(block) <= segment_bytes:
        yield record("response", rid, block, **common)
        return
    cuts = range(0, len(block), segment_bytes)
    for k, at in enumerate(cuts, 1):
        part = block[at : at + segment_bytes]
        if k == 1:
            yield record("response", rid, part, WARC_Segment_Number=1, **common)
        else:
            yield record("continuation", f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{rid}#{k}')}>", part, WARC_Segment_Number=k, WARC_Segment_Origin_ID=rid, WARC_Segment_Total_Length=len(block) if k == len(cuts) else None)


def parse(raw: bytes) -> tuple[dict[str, str], bytes]:
    head, found, rest = raw.partition(b"\r\n\r\n")
    lines = head.decode("utf-8", "replace").split("\r\n")
    if not found or not lines[0].startswith("WARC/"):
        raise WarcError("no WARC header")
    fields = {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines[1:])}
    size = int(fields["content-length"])
    if len(rest) < size:
        raise WarcError("record ends early")
    return fields, rest[:size]


def _writer(uri: str, segment_bytes: int, file_bytes: int):
    def write(batches):
        pid, seq, n, out, size = TaskContext.get().partitionId(), 0, 0, None, 0
        done = []
        for batch in batches:
            for row in batch.to_pylist():
                rid = f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{row["page_id"]}/{row["sha1"]}/{pid}/{n}')}>"
                n += 1
                if out is None:
                    name = f"{uri}/{pid:06d}-{seq:06d}-{uuid.uuid4().hex}.warc.gz"
                    fs, path = filesystem(name)
                    out, size = fs.open_output_stream(path, compression=None), 0
                for raw in records_of(rid, row["page_id"], row["url"], row["html"], row["sha1"], row["size"], row["refers_to"], row["response"], segment_bytes):
                    z = zlib.compressobj(4, zlib.DEFLATED, 31)
                    member = z.compress(raw) + z.flush()
                    out.write(member)
                    size += len(member)
                if size >= file_bytes:
                    out.close()
                    done.append(name)
                    out, seq = None, seq + 1
        if out is not None:
            out.close()
            done.append(name)
        yield pa.RecordBatch.from_pydict({"uri": done}, schema=pa.schema([("uri", pa.string())]))

    return write


def members(stream, block: int = 1 << 18):
    """The decompressed gzip members of a stream, one after the other."""
    z, got, rest = None, [], b""
    while True:
        data = rest or stream.read(block)
        if not data:
            if z is not None:
                raise WarcError("archive ends inside a record")
            return
        if z is None:
            z, got = zlib.decompressobj(31), []
        got.append(z.decompress(data))
        rest = z.unused_data
        if z.eof:
            yield b"".join(got)
            z = None


def _whole(page, block: bytes, stated: str | None) -> dict:
    payload = payload_of(block)
    digest = base64.b32encode(hashlib.sha1(payload).digest()).decode()
    if stated and digest != stated.removeprefix("sha1:"):
        raise WarcError(f"page {page}: payload does not match its digest")
    return {"page_id": page, "payload_bytes": len(payload), "payload_digest": digest, "record_type": "response"}


def _reader(batches):
    for batch in batches:
        for uri in batch.column("uri").to_pylist():
            fs, path = filesystem(uri)
            rows = []
            with fs.open_input_stream(path, compression=None) as f:
                for raw in members(f):
                    h, block = parse(raw)
                    page = int(h["warc-page-id"]) if "warc-page-id" in h else None
                    if "warc-segment-number" in h:
                        rows.append({"page_id": page, "payload_digest": h.get("warc-payload-digest"), "origin": h.get("warc-segment-origin-id", h["warc-record-id"]), "segment": int(h["warc-segment-number"]), "total": int(h["warc-segment-total-length"]) if "warc-segment-total-length" in h else None, "block": block})
                    elif h["warc-type"] == "revisit":
                        size = next(int(v) for k, _, v in (x.partition(b":") for x in block.split(b"\r\n")) if k.lower() == b"content-length")
                        to = h.get("warc-refers-to-page-id")
                        rows.append({"page_id": page, "payload_bytes": size, "payload_digest": h["warc-payload-digest"].removeprefix("sha1:"), "record_type": "revisit", "refers_to": int(to) if to else None})
                    else:
                        rows.append(_whole(page, block, h.get("warc-payload-digest")))
                    if len(rows) >= 512:
                        yield pa.RecordBatch.from_pylist(rows, schema=_SCHEMA)
                        rows = []
            yield pa.RecordBatch.from_pylist(rows, schema=_SCHEMA)


def assemble(segments: list[dict]) -> dict:
    """The record of one origin from its segments (segment, total, block, page_id, payload_digest)."""
    by = {s["segment"]: s for s in segments}
    total = next((s["total"] for s in segments if s["total"] is not None), None)
    if sorted(by) != list(range(1, len(by) + 1)) or total is None:
        raise WarcError("segments are missing")
    block = b"".join(by[k]["block"] for k in range(1, len(by) + 1))
    if len(block) != total:
        raise WarcError(f"{len(block)} bytes in the segments, {total} stated")
    return _whole(by[1]["page_id"], block, by[1]["payload_digest"])


def _assembler(batches):
    for batch in batches:
        yield pa.RecordBatch.from_pylist([assemble(row) for row in batch.column("segments").to_pylist()], schema=pa.schema(list(_SCHEMA)[:5]))


def write_archives(pages: DataFrame, ws: Workspace, least: int = 0, segment_bytes: int = 32768, file_bytes: int = 1 << 24) -> DataFrame:
    """Writes ``pages`` (page_id, url, html); returns the manifest (uri)."""
    payload = F.encode(F.coalesce(F.col("html").cast("string"), F.lit("")), "UTF-8")
    pages = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.col("html").cast("string").alias("html"), F.sha1(payload).alias("sha1"), F.octet_length(payload).cast("long").alias("size"))
    large = F.col("size") >= least
    narrow = pages.select("page_id", "url", "sha1", "size")
    holders = ws.keep(narrow.where(large).groupBy("sha1").agg(F.max("page_id").alias("holder")), "holders")
    is_holder = [pages["sha1"] == holders["sha1"], pages["page_id"].eqNullSafe(holders["holder"])]
    response = pages.where(large).join(holders, is_holder, "left_semi").unionByName(pages.where(~large))
    response = response.select("page_id", "url", "html", "sha1", "size", F.lit(None).cast("long").alias("refers_to"), F.lit(True).alias("response"))
    revisit = narrow.where(large).join(holders, "sha1").where(~F.col("page_id").eqNullSafe(F.col("holder")))
    revisit = revisit.select("page_id", "url", F.lit(None).cast("string").alias("html"), "sha1", "size", F.col("holder").alias("refers_to"), F.lit(False).alias("response"))
    fs, path = filesystem(ws.path("archives"))
    fs.create_dir(path, recursive=True)
    return ws.keep(response.unionByName(revisit).mapInArrow(_writer(ws.path("archives"), segment_bytes, file_bytes), "uri string"), "manifest")


def read_archives(manifest: DataFrame, ws: Workspace) -> DataFrame:
    """(page_id, payload_bytes, payload_digest, record_type, refers_to) of every record in the archives."""
    found = ws.keep(manifest.repartition(4 * parts(manifest.sparkSession)).mapInArrow(_reader, RECORDS), "records")
    keep = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    parted = found.where("origin is not null").groupBy("origin").agg(F.collect_list(F.struct("segment", "total", "block", "page_id", "payload_digest")).alias("segments"))
    whole = parted.select("segments").mapInArrow(_assembler, ", ".join(RECORDS.split(", ")[:5]))
    return found.where("origin is null").select(*keep).unionByName(whole.select(*keep))


def roundtrip(pages: DataFrame, least: int = 0, segment_bytes: int = 32768) -> DataFrame:
    ws = Workspace(pages.sparkSession, "warc")
    return read_archives(write_archives(pages, ws, least, segment_bytes), ws)
