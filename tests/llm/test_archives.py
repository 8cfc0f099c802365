import base64
import hashlib
import zlib

import numpy as np
import pytest

from tierflow.llm import media, warc
from tierflow.llm.base import Workspace, filesystem

PAGES = "page_id long, url string, html string, sha1 string, size long, holder string"


def test_chunked_framing():
    for n in (0, 1, warc.CHUNK, warc.CHUNK + 1, 50_000):
        payload = bytes(k % 251 for k in range(n))
        assert warc.dechunked(warc.chunked(payload)) == payload
    assert warc.dechunked(b"3;ext=1\r\nabc\r\n0\r\nTrailer: x\r\n\r\n") == b"abc"
    for bad in (b"5\r\nabc\r\n0\r\n\r\n", b"zz\r\n", b""):
        with pytest.raises(warc.WarcError):
            warc.dechunked(bad)


def test_segments_are_checked():
    html = "x" * 5000
    sha = hashlib.sha1(html.encode()).hexdigest()
    records = [warc.parse(r) for r in warc.records_of("<urn:uuid:1>", 4, "u", html, sha, 5000, None, True, 700)]
    rows = [{"segment": int(h["warc-segment-number"]), "total": int(h["warc-segment-total-length"]) if "warc-segment-total-length" in h else None, "block": b, "page_id": 4, "payload_digest": h.get("warc-payload-digest")} for h, b in records]
    assert len(rows) > 5 and all(h["warc-segment-origin-id"] == "<urn:uuid:1>" for h, _ in records[1:])
    assert warc.assemble(rows[::-1])["payload_bytes"] == 5000
    for broken in (rows[:-1], rows[:2] + rows[3:], [{**rows[0], "block": b"HTTP/1.1 200 OK\r\n\r\n"}, *rows[1:]]):
        with pytest.raises(warc.WarcError):
            warc.assemble(broken)


@pytest.mark.parametrize("least", [0, 100])
def test_roundtrip_against_brute_force(spark, least):
    big = "".join(chr(32 + k % 90) for k in range(90_000))
    html = {1: "a", 2: "a", 3: None, 4: "", 5: big, 6: big, 7: "é" * 40_000, 8: "same" * 50, 9: "same" * 50, 10: "b"}
    rows = [(i, None if i == 2 else f"http://h/{i}", t, "x", 1, "y") for i, t in html.items()] + [(None, "u", "b", "x", 1, "y")]
    got = {r.page_id: r for r in warc.roundtrip(spark.createDataFrame(rows, PAGES).repartition(2), least, 20_000).collect()}
    assert set(got) == {*html, None}
    for i, t in {**html, None: "b"}.items():
        payload = (t or "").encode()
        group = [j for j, x in html.items() if (x or "").encode() == payload] if len(payload) >= least else [i]
        to = None if i in group and i == max(x for x in group if x is not None or len(group) == 1) else max(group) if group else None
        r = got[i]
        assert r.payload_bytes == len(payload)
        assert r.payload_digest == base64.b32encode(hashlib.sha1(payload).digest()).decode()
        assert (r.record_type, r.refers_to) == (("response", None) if to is None else ("revisit", to)), i


def test_repeated_pages_and_empty_tables(spark):
    rows = [(1, "u", "a", "", 1, "")] * 2
    assert [r.record_type for r in warc.roundtrip(spark.createDataFrame(rows, PAGES)).collect()] == ["response"] * 2
    assert warc.roundtrip(spark.createDataFrame([], PAGES)).count() == 0


def test_png():
    for n in (64, 128, 6400):
        samples = bytes(k * 7 % 256 for k in range(n))
        assert media.from_png(media.to_png(samples)) == samples
    raw = bytearray(media.to_png(bytes(64)))
    raw[45] ^= 1
    with pytest.raises(ValueError):
        media.from_png(bytes(raw))


def test_members_are_read_again_by_offset():
    calls = []

    def flaky():
        calls.append(1)
        if len(calls) < 3:
            raise OSError("lost")
        return b"x"

    assert media.with_retries(flaky, 4, 0) == b"x" and len(calls) == 3
    with pytest.raises(OSError):
        media.with_retries(lambda: (_ for _ in ()).throw(OSError()), 2, 0)


def test_media_query(spark, documents, empty, by_id):
    got = media.media_features(documents).collect()
    assert len(got) == len(by_id) + 1
    for r in got:
        text = (by_id[r.doc_id] or "").encode()
        payload = text.ljust(max(64, -(-len(text) // 64) * 64), b"\0")
        stored = media.to_png(payload)
        assert (r.n_bytes, r.payload_bytes, r.payload_sha256, r.tail_crc32) == (len(text), len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-64:]))
        assert (r.media_bytes, r.media_sha256) == (len(stored), hashlib.sha256(stored).hexdigest())
        assert r.feature == media.feature(np.frombuffer(payload, np.uint8))
    assert media.media_features(empty).count() == 0


def test_ranges_cover_an_archive_once(spark, documents, by_id):
    uri = Workspace(spark, "t").path("archives")
    media.store(documents, uri)
    spark.dataSource.register(media.MediaArchive)
    read = spark.read.format("media_archive").option("rangeBytes", 3000).load(uri)
    assert read.rdd.getNumPartitions() > 5
    assert sorted(r.doc_id for r in read.select("doc_id").collect()) == sorted([*by_id, 0])
    fs, path = filesystem(uri)
    with fs.open_output_stream(f"{path}/unlisted.arc") as f:
        f.write(b"an attempt that was lost")
    assert read.count() == len(by_id) + 1


def test_appending_keeps_what_was_there(spark):
    uri = Workspace(spark, "t").path("archives")
    rows = lambda *ids: spark.createDataFrame([(i, f"text {i}") for i in ids], "doc_id long, text string").coalesce(1)
    for k in (1, 2, 3):
        media.store(rows(k), uri)
    assert sorted(r.doc_id for r in media.load(spark, uri).collect()) == [1, 2, 3]
    media.store(rows(7, 8), uri, "overwrite")
    assert sorted(r.doc_id for r in media.load(spark, uri).collect()) == [7, 8]
    media.store(rows(9), uri)
    assert sorted(r.doc_id for r in media.load(spark, uri).collect()) == [7, 8, 9]
    media.store(rows(), uri)
    assert media.load(spark, uri).count() == 3


def test_a_lost_file_is_opened_anew():
    data, opened = b"abcdefgh", []

    class Dying:
        """A handle that fails once and for ever after its second read."""

        def __init__(self):
            self.reads, self.at = 0, 0
            opened.append(self)

        def seek(self, at):
            self.at = at

        def read(self, n):
            self.reads += 1
            if self.reads > 1:
                raise OSError("connection lost")
            return data[self.at : self.at + n]

        def close(self):
            raise OSError("lost")

    members = media.Members(Dying, "x", 3)
    assert [members.at(k, 2, zlib.crc32(data[k : k + 2])) for k in (0, 2, 4)] == [b"ab", b"cd", b"ef"] and len(opened) == 3
    with pytest.raises(ValueError):
        members.at(0, 2, 1)


def test_ranges_know_their_entries():
    marks = [(0, 0), (100, 7), (230, 9), (300, 20)]
    for size in (1, 30, 99, 100, 1000):
        got = media.ranges("a", marks, size)
        assert [(r.lo, r.hi) for r in got] == [(k, min(k + size, 300)) for k in range(0, 300, size)]
        for r in got:
            assert r.first == max(m for o, m in marks if o <= r.lo) and r.last == min(m for o, m in marks if o >= r.hi)


def independent_png(raw):
    """A reader of PNG written from its specification: all filters, any width, grey 8 bit."""
    import struct

    assert raw[:8] == bytes([137, 80, 78, 71, 13, 10, 26, 10])
    at, idat = 8, b""
    while at < len(raw):
        n, kind = struct.unpack(">I4s", raw[at : at + 8])
        body, at = raw[at + 8 : at + 8 + n], at + 12 + n
        if kind == b"IHDR":
            width, height, depth, colour, *rest = struct.unpack(">IIBBBBB", body)
            assert (depth, colour, *rest) == (8, 0, 0, 0, 0)
        idat += body if kind == b"IDAT" else b""
    flat, out, up = zlib.decompress(idat), b"", bytes(width)
    assert len(flat) == height * (width + 1)
    for y in range(height):
        kind, line = flat[y * (width + 1)], bytearray(flat[y * (width + 1) + 1 : (y + 1) * (width + 1)])
        for x in range(width):
            a, b, c = line[x - 1] if x else 0, up[x], up[x - 1] if x else 0
            p = a + b - c
            paeth = a if abs(p - a) <= abs(p - b) and abs(p - a) <= abs(p - c) else b if abs(p - b) <= abs(p - c) else c
            line[x] = (line[x] + (0, a, b, (a + b) // 2, paeth)[kind]) % 256
        up = bytes(line)
        out += up
    return out


def test_stored_images_by_another_reader(spark, documents, by_id):
    uri = Workspace(spark, "t").path("archives")
    media.store(documents, uri)
    got = media.load(spark, uri).where("n_bytes < 20000").collect()
    for r in got:
        text = (by_id[r.doc_id] or "").encode()
        assert r.n_bytes == len(text) and independent_png(bytes(r.media)) == text.ljust(max(64, -(-len(text) // 64) * 64), b"\0")
    features = {r.doc_id: r.feature for r in media.media_features(documents).collect()}
    for i, text in by_id.items():
        raw = (text or "").encode()
        x = list(raw) + [0] * (max(64, -(-len(raw) // 64) * 64) - len(raw))
        mean = sum(x) / len(x)
        entropy = -sum(x.count(v) / len(x) * np.log2(x.count(v) / len(x)) for v in set(x))
        want = [mean, np.sqrt(sum((v - mean) ** 2 for v in x) / len(x)), entropy, sum(abs(a - b) for a, b in zip(x, x[1:], strict=False)) / (len(x) - 1)]
        assert [float(f.split("=")[1]) for f in features[i].split(";")] == pytest.approx(want, abs=2e-4)
