import base64
import hashlib
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

from tierflow.llm import byte_bpe, packing, wavelet, word_bpe
from tests.llm.conftest import thue_morse
from tierflow.llm.base import Workspace, text_buffers
from tierflow.llm.piececache import PieceCache
from tierflow.llm.textscan import span_keys

tiktoken = pytest.importorskip("tiktoken")
P = pytest.importorskip("public_tokenizers")


@pytest.fixture(scope="module")
def reference():
    with open(byte_bpe.ranks_file(), "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(word_bpe.vocabulary())


def ids_of(library, text):
    return [*library.encode(text or "", add_special_tokens=False).ids, 1]


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


def fuzz(n, letters, seed):
    rng = random.Random(seed)
    return ["".join(rng.choice(letters) for _ in range(rng.randrange(40))) for _ in range(n)]


def test_byte_bpe_equals_tiktoken(reference):
    rows = [*fuzz(3000, [*"ab 'stremvl\n\t 　\r1２Ⅷé中̀!.,İ🎉 ", "'re", "'s", " '"], 3), "a" * 3000, "ab" * 500 + " " * 300, "", None, *thue_morse(1024), *thue_morse(4096)]
    b, o = text_buffers(pa.array(rows))
    ids, per, starts, per_row, lens = byte_bpe.coder(byte_bpe.ranks_file()).encode(b, o)
    ends = np.cumsum(per)
    for k, t in enumerate(rows):
        assert ids[ends[k] - per[k] : ends[k]].tolist() == reference.encode_ordinary(t or "")
    assert byte_bpe.coder(byte_bpe.ranks_file()).decode(ids) == b.tobytes()
    assert lens.sum() == len(ids) and per_row.sum() == len(starts)


def test_ranges_decode_to_their_place():
    coder = byte_bpe.coder(byte_bpe.ranks_file())
    text = "Ünder the 12,345 trees — they're \n\n  talking! 🎉🎉 ok"
    b, o = text_buffers(pa.array([text]))
    ids, _, starts, _, lens = coder.encode(b, o)
    whole = text.encode()
    for lo in range(len(ids) + 1):
        for hi in range(lo, len(ids) + 1):
            at, raw = coder.decode_range(ids, starts, lens, lo, hi)
            assert at == len(coder.decode(ids[:lo])) and whole[at : at + len(raw)] == raw == coder.decode(ids[lo:hi])
    assert coder.decode_pieces(ids, starts, lens) == whole
    for bad in (starts + 1, starts[::-1]):
        with pytest.raises(ValueError):
            coder.decode_pieces(ids, bad, lens)
    assert coder.decode_range(ids[:0], starts[:0], lens[:0], 0, 0) == (0, b"")


def test_hashes_tell_spans_apart():
    rng = random.Random(8)
    words = {*thue_morse(64), *thue_morse(1024), *thue_morse(4096), *("a" * k for k in range(1, 200)), *("".join(rng.choice("ab") for _ in range(rng.randrange(1, 130))) for _ in range(20000))}
    words = sorted(words)
    b = np.frombuffer(" ".join(words).encode(), np.uint8)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = ends - np.array([len(w) for w in words])
    for lane in span_keys(b, starts, ends):
        assert len(np.unique(lane)) == len(words)
    upper = np.frombuffer(" ".join(words).upper().encode(), np.uint8)
    assert all((x == y).all() for x, y in zip(span_keys(b, starts, ends), span_keys(upper, starts, ends), strict=True))


def test_a_second_hash_guards_the_cache():
    cache = PieceCache(lambda ps: (np.array([p[0] for p in ps], np.uint16), np.ones(len(ps), np.int64)))
    same = np.zeros(3, np.uint64)
    for _ in range(2):
        ids, lens = cache.tokens(b"xyx", [same, np.array([1, 2, 1], np.uint64)], np.arange(3), np.arange(1, 4))
        assert ids.tolist() == [120, 121, 120] and lens.tolist() == [1, 1, 1]


def test_byte_bpe_query(documents, empty, by_id, reference):
    got = byte_bpe.digest(byte_bpe.encode_documents(documents)).collect()
    assert len(got) == len(by_id) + 1
    for r in got:
        text = by_id[r.doc_id] or ""
        ids = reference.encode_ordinary(text)
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(text.encode()).hexdigest()
    assert byte_bpe.digest(byte_bpe.encode_documents(empty)).count() == 0


def test_word_bpe_equals_the_library(library):
    rows = [*fuzz(2000, [*"aB é.,;!'s\n ̀<|>İßﬁ１中-", "<|endoftext|>", "'re", "thing", "(x)"], 4), None, *thue_morse(1024), *thue_morse(4096)]
    b, o = text_buffers(pa.array(rows))
    ids, per = word_bpe.WordEncoder(word_bpe.vocabulary()).encode(b, o)
    ends = np.cumsum(per)
    for k, t in enumerate(rows):
        assert ids[ends[k] - per[k] : ends[k]].tolist() == ids_of(library, t)[:-1], t


def test_known_pieces_are_looked_up_without_sorting(monkeypatch):
    rng = np.random.default_rng(9)
    raw = bytes(range(256)) * 4
    cache = PieceCache(lambda ps: (np.concatenate([np.frombuffer(p, np.uint8) for p in ps]).astype(np.uint16), np.array([len(p) for p in ps])), most=300_000)
    hashes = np.unique(np.concatenate((rng.integers(0, 1 << 63, 50_000, np.uint64), np.arange(2000, dtype=np.uint64) << np.uint64(40), np.arange(500, dtype=np.uint64))))
    starts = rng.integers(0, 1000, len(hashes))
    ends = starts + 1 + rng.integers(0, 9, len(hashes))

    def ask(which):
        got, lens = cache.tokens(raw, [hashes[which], ~hashes[which]], starts[which], ends[which])
        assert (lens == (ends - starts)[which]).all()
        assert got.tolist() == [x for k in which.tolist() for x in raw[starts[k] : ends[k]]]

    for _ in range(4):  # grows more than once; many hashes want one slot
        ask(rng.integers(0, len(hashes), 20_000))
    ask(np.arange(len(hashes)))
    assert cache.n == len(hashes)  # each was encoded once
    sorts, unique = [], np.unique
    monkeypatch.setattr(np, "unique", lambda x, **k: sorts.append(len(x)) or unique(x, **k))
    ask(rng.integers(0, len(hashes), 20_000))
    assert not sorts and cache.n == len(hashes)
    cache.most = 10_000  # starts anew
    ask(np.arange(9000, -1, -1))
    assert cache.n == 9001


def zipf_shard(n, seed=2):
    ids = np.minimum(np.random.default_rng(seed).zipf(1.4, n), 49000).astype(np.uint16)
    return ids, wavelet.dump([3, None], np.array([n - n // 2, n // 2]), ids)


def test_wavelet_matrix():
    for n in (1, 511, 512, 513, 5000):
        ids, raw = zipf_shard(n)
        shard = wavelet.Shard(raw)
        assert shard.doc_ids == [3, None] and (shard.all_tokens() == ids).all()
        for i in {0, 511, 512, 1234, n - 1} & set(range(n)):
            assert shard.access(i) == ids[i]
        for lo, hi in ((0, 0), (n // 3, n // 2), (n - 1, n)):
            assert (shard.tokens(lo, hi) == ids[lo:hi]).all()
        for token in (1, 2, 17, 49001):
            where = np.flatnonzero(ids == token)
            assert shard.count(token) == len(where)
            assert shard.count(token, n // 5, n - n // 6) == ((where >= n // 5) & (where < n - n // 6)).sum()
            for k in {0, len(where) // 2, len(where) - 1} if len(where) else ():
                assert shard.find(token, k) == where[k]
        with pytest.raises(IndexError):
            shard.find(49001, 0)
        with pytest.raises(IndexError):
            shard.access(n)
    empty = wavelet.Shard(wavelet.dump([], np.zeros(0, np.int64), np.zeros(0, np.uint16)))
    assert empty.doc_ids == [] and len(empty.all_tokens()) == 0 and empty.count(5) == 0


def test_wavelet_lookups_read_only_a_part():
    ids, raw = zipf_shard(900_000)
    got = []

    def read(at, size):
        got.append(size)
        return raw[at : at + size]

    shard = wavelet.Shard(read)
    rare = int(ids[np.flatnonzero(ids > 2000)[5]])
    before = sum(got)
    assert shard.access(450_000) == ids[450_000] and shard.find(rare, 0) == np.flatnonzero(ids == rare)[0]
    assert shard.count(7, 10, 800_000) == (ids[10:800_000] == 7).sum()
    assert sum(got) < 0.75 * len(raw) and before < 0.05 * len(raw)
    assert (shard.tokens(100, 700) == ids[100:700]).all()


def test_wavelet_ranges_cost_ranks_by_prefix_not_by_token(monkeypatch):
    rng = np.random.default_rng(5)
    for ids in (zipf_shard(200_000)[0], rng.integers(0, 1 << 16, 70_000).astype(np.uint16), np.full(66_000, 49_151, np.uint16), np.arange(65_536).astype(np.uint16)):
        n = len(ids)
        shard = wavelet.Shard(wavelet.dump([1], np.array([n]), ids))
        for lo, hi in ((0, n), (0, 0), (n, n), (7, 8), (511, 513), *np.sort(rng.integers(0, n + 1, (20, 2))).tolist()):
            got = shard.tokens(lo, hi)
            assert got.dtype == np.uint16 and (got == ids[lo:hi]).all()
    ids, raw = zipf_shard(200_000)
    shard = wavelet.Shard(raw)
    shard.tokens(0, 1)  # reads the planes
    counted, count = [], np.bitwise_count
    monkeypatch.setattr(np, "bitwise_count", lambda x: counted.append(np.size(x)) or count(x))
    assert (shard.tokens(1000, 190_000) == ids[1000:190_000]).all()
    prefixes = sum(len(np.unique(ids[1000:190_000] >> (wavelet.LEVELS - k))) for k in range(wavelet.LEVELS))
    assert len(counted) == wavelet.LEVELS and sum(counted) == 2 * prefixes < 189_000


def test_wavelet_reader_takes_a_shard_in_one_run(tmp_path, monkeypatch):
    ids, _ = zipf_shard(600_000)
    per = np.array([250_000, 0, 1, 349_999])
    (tmp_path / "a.wvm").write_bytes(wavelet.dump([4, 7, None, 9], per, ids))
    runs, shared, within, tokens = [], [], wavelet._within, wavelet.Shard.tokens

    def watched(bits, *at):
        got = within(bits, *at)
        shared.append(np.shares_memory(got, bits))
        return got

    monkeypatch.setattr(wavelet.Shard, "tokens", lambda self, lo, hi: runs.append((lo, hi)) or tokens(self, lo, hi))
    monkeypatch.setattr(wavelet, "_within", watched)
    batch = pa.RecordBatch.from_pydict({"uri": [f"file://{tmp_path}/a.wvm"], "base": [10]})
    (got,) = wavelet._reader([batch])
    assert runs == [(0, 600_000)] and shared == [True] * wavelet.LEVELS  # every level whole, none copied
    ends = np.cumsum(per)
    want = [(d, 10 + e - n, n, crc(ids[e - n : e])) for d, e, n in zip([4, 7, None, 9], ends.tolist(), per.tolist())]
    assert [tuple(r.values()) for r in got.to_pylist()] == want
    runs.clear()
    (got,) = wavelet._reader([batch], 100_000)
    assert len(runs) > 1 and all(hi - lo < 600_000 for lo, hi in runs)


def test_wavelet_deal_and_back_in_steps():
    rng = np.random.default_rng(8)
    for n in (1, 7, 64, 5000):
        for bit in (np.zeros(n, bool), np.ones(n, bool), rng.random(n) < 0.3):
            values = rng.integers(0, 1 << 16, n).astype(np.uint16)
            down = np.concatenate((values[~bit], values[bit]))
            for step in (1, 7, 4999, 5000, 1 << 15):
                assert (wavelet._undeal(bit, down, step) == values).all()


def test_wavelet_build_in_steps():
    ids, _ = zipf_shard(5000)
    for step in (1, 7, 4999, 5000, 5001):
        for (zeros, plane), (z, p) in zip(wavelet.build(ids), wavelet.build(ids, step), strict=True):
            assert zeros == z and (plane == p).all()
    cur = ids
    for level, (zeros, plane) in enumerate(wavelet.build(ids)):
        bit = cur >> (wavelet.LEVELS - 1 - level) & 1
        assert zeros == (bit == 0).sum() and (np.unpackbits(plane, bitorder="little")[: len(ids)] == bit).all()
        cur = np.concatenate((cur[bit == 0], cur[bit == 1]))


def test_occurrences_over_all_shards(spark, documents, by_id, library):
    manifest = wavelet.write_shards(documents, Workspace(spark, "t"), shard_tokens=5000)
    rows = sorted([*by_id.items(), (0, by_id[0])], key=lambda r: r[0])
    flat = [(i, t) for i, text in rows for t in ids_of(library, text)]
    for token in (1, flat[100][1], 48_000):
        got = sorted((r.position, r.doc_id) for r in wavelet.find_token(manifest, token).collect())
        assert got == [(k, i) for k, (i, t) in enumerate(flat) if t == token]


def test_wavelet_query(spark, documents, empty, by_id, library):
    got = sorted(wavelet.read_shards(wavelet.write_shards(documents, Workspace(spark, "t"), shard_tokens=5000)).collect(), key=lambda r: r.start)
    at = 0
    assert [r.doc_id for r in got] == sorted([*by_id, 0])
    for r in got:
        ids = ids_of(library, by_id[r.doc_id])
        assert (r.start, r.n_tokens, r.ids_crc32) == (at, len(ids), crc(ids))
        at += len(ids)
    assert wavelet.store_tokens(empty).count() == 0


def test_packing(documents, empty, by_id, library):
    got = packing.pack_documents(documents).collect()
    pieces, sequences = defaultdict(list), defaultdict(list)
    for r in got:
        pieces[r.doc_id].append(r)
        sequences[r.sequence_id].append(r)
    for doc, text in by_id.items():
        ids, seen = ids_of(library, text), Counter()
        for r in pieces[doc]:
            assert r.doc_tokens == len(ids) and r.ids_crc32 == crc(ids[r.start : r.start + r.length])
            seen.update(range(r.start, r.start + r.length))
        assert seen == Counter({k: 2 if doc == 0 else 1 for k in range(len(ids))})
    full = 0
    for rows in sequences.values():
        at = 0
        for r in sorted(rows, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= 2048
        full += at == 2048
    assert len(sequences) - full <= 3  # one open sequence a shard, one shard a partition
    assert packing.pack_documents(empty).count() == 0


def test_neighbours_are_lexical():
    ids = np.array([5, 6, 7, 8, 9, 5, 6, 7, 8, 9, 20, 21, 22, 23, 24], np.uint16)
    index = packing.Bm25(ids, np.array([5, 5, 5]))
    assert list(index.neighbours(0, np.array([False, True, True]))) == [1]
    assert packing.pack(np.arange(0, dtype=np.uint16), np.zeros(0, np.int64)).shape == (0, 5)


def brute_bm25(docs, seed):
    """The BM25 score of every document for all distinct terms of the seed, term by term."""
    n, mean, score = len(docs), sum(map(len, docs)) / len(docs), [0.0] * len(docs)
    counts = [Counter(d) for d in docs]
    for t in counts[seed]:
        df = sum(t in c for c in counts)
        idf = np.log(1 + (n - df + 0.5) / (df + 0.5))
        for k, c in enumerate(counts):
            query = idf * c[t] * 2.2 / (c[t] + 1.2 * (0.25 + 0.75 * len(docs[k]) / mean))
            score[k] += query
    return np.array(score)


def test_neighbours_have_the_recall_of_brute_force():
    rng = np.random.default_rng(3)
    docs = [np.minimum(rng.zipf(1.3, rng.integers(60, 300)), 3000).tolist() for _ in range(200)]
    per = np.array([len(d) for d in docs])
    index, found, first = packing.Bm25(np.concatenate(docs).astype(np.uint16), per), 0, 0
    assert np.median([len(set(d)) for d in docs]) > 24
    for seed in range(20):
        unused = np.arange(200) != seed
        score = np.where(unused, brute_bm25(docs, seed), -1)
        want = np.argsort(-score, kind="stable")[:10]
        got = list(index.neighbours(seed, unused))[:10]
        found, first = found + len(set(want.tolist()) & set(got)), first + int(want[0] == got[0])
    assert found >= 0.9 * 200 and first >= 18


def test_every_neighbour_comes_before_a_stranger():
    """Thousands of tiny rows: a window takes all that share a term with its seed, however many, by falling score."""
    rng = np.random.default_rng(5)
    docs = [[1, 7 + k % 2, 100 + int(rng.integers(40))] if k % 2 else [8 + k % 2 + 20, 200 + int(rng.integers(40))] for k in range(1600)]
    per = np.array([len(d) for d in docs])
    ids = np.concatenate(docs).astype(np.uint16)
    got = packing.pack(ids, per)
    first = got[got[:, 3] == 0]
    seed = int(first[0, 0])
    score = brute_bm25(docs, seed)
    order = first[1:, 0]
    assert (score[order[:799]] > 0).all() and not score[order[799:]].any()  # all 799 of its kind, then the others
    assert (np.diff(score[order[:799]]) < 1e-4).all()


def test_pruning_changes_nothing(monkeypatch):
    rng = np.random.default_rng(6)
    per = rng.integers(5, 400, 300)
    ids = np.minimum(rng.zipf(1.3, int(per.sum())), 900).astype(np.uint16)
    want = packing.pack(ids, per)
    calls = []
    prune = packing.Bm25.prune
    monkeypatch.setattr(packing.Bm25, "prune", lambda self, unused: calls.append(1))
    assert (packing.pack(ids, per) == want).all() and calls
    monkeypatch.setattr(packing.Bm25, "prune", prune)
    index, unused = packing.Bm25(ids, per), rng.random(300) < 0.3
    before = list(index.neighbours(int(np.flatnonzero(unused)[0]), unused))
    index.prune(unused)
    assert list(index.neighbours(int(np.flatnonzero(unused)[0]), unused)) == before
