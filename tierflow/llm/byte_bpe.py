"""Byte-level BPE encoding and decoding without regex or tokeniser library.

Pre-tokenisation: a class array over code points (with one character of lookahead, two for contractions) drives an
automaton of eight states. The automaton runs as an associative scan: each block of characters composes its transition
functions, block functions are composed by doubling, and the states found mark the piece boundaries. The slices feed a
cache of merged pieces; missing pieces are merged together, lowest rank and leftmost first. Byte offsets of the pieces
stay beside the ids, so that a token range decodes to its place in the text.

Defined cases: null and empty texts have no ids (the digests are those of the empty string); long texts and long pieces
are processed whole; null ids stay null; repeated rows give a row each; extra columns are never read; an empty table gives
no rows.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
import unicodedata
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tierflow.llm.base import row_chunks, rows_of, text_buffers
from tierflow.llm.piececache import PieceCache
from tierflow.llm.textscan import span_keys

# The code points with the property White_Space, and the contractions' letters.
WHITE_SPACE = (*range(0x09, 0x0E), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000)
ONE_LETTER, TWO_LETTERS = "stmd", ("re", "ve", "ll")

LETTER, NUMBER, OTHER, SPACE = range(4)
# Symbols: letter, number, other, apostrophe of a contraction of one or two letters, white space inside a run, a blank
# that joins what follows, another white space before text.
SYM_L, SYM_N, SYM_O, SYM_A1, SYM_A2, SYM_W, SYM_J, SYM_S = range(8)
# States: a piece has ended; in letters; in numbers; in other signs; in white space; after a joining blank; one or two
# letters of a contraction to come.
ENDED, IN_L, IN_N, IN_O, IN_W, JOIN, ONE, TWO = range(8)


def _automaton() -> tuple[np.ndarray, np.ndarray]:
    """(next state, boundary before) by symbol and state; symbols from 8 on start a row."""
    step, cut = np.zeros((16, 8), np.uint8), np.ones((16, 8), bool)
    for sym in range(8):
        for state in range(8):
            run = {SYM_L: IN_L, SYM_N: IN_N, SYM_O: IN_O, SYM_A1: IN_O, SYM_A2: IN_O, SYM_W: IN_W}.get(sym)
            joined = run is not None and (state == run or state == JOIN and run != IN_W)
            fresh = {SYM_A1: ONE, SYM_A2: TWO, SYM_J: JOIN, SYM_S: ENDED}.get(sym, run)
            step[sym, state], cut[sym, state] = (run, False) if joined else (fresh, True)
    step[SYM_L, ONE], cut[SYM_L, ONE] = ENDED, False
    step[SYM_L, TWO], cut[SYM_L, TWO] = ONE, False
    step[8:] = step[:8, [ENDED]]
    return step, cut


STEP, CUT = _automaton()
BLOCK = 48


@cache
def _classes() -> np.ndarray:
    by = {"L": LETTER, "N": NUMBER}
    table = np.fromiter((by.get(unicodedata.category(chr(c))[0], OTHER) for c in range(0x110000)), np.uint8, 0x110000)
    table[list(WHITE_SPACE)] = SPACE
    return table


def symbols(points: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """The symbol of each code point; ``rows``: first position of each non-empty row."""
    n, cls = len(points), _classes()[points]
    last = np.zeros(n, bool)
    last[rows[1:] - 1] = last[-1:] = True
    sym = cls.copy()  # letters, numbers and others keep their numbers
    after = np.empty(n, np.uint8)  # class of what follows, white space at a row's end
    after[:-1], after[-1] = cls[1:], SPACE
    after[last] = SPACE
    space = cls == SPACE
    before_text = space & (after != SPACE)
    sym[space] = SYM_W
    sym[before_text] = SYM_S
    sym[before_text & (points == 0x20)] = SYM_J
    quote = np.flatnonzero((points == 0x27) & ~last)
    if len(quote):
        one = points[quote + 1]
        two = np.where(last[quote + 1], 0, points[np.minimum(quote + 2, n - 1)])
        sym[quote[np.isin(one, [ord(c) for c in ONE_LETTER])]] = SYM_A1
        pairs = np.array([ord(p[0]) << 21 | ord(p[1]) for p in TWO_LETTERS])
        sym[quote[np.isin(one.astype(np.int64) << 21 | two, pairs)]] = SYM_A2
    sym[rows] += 8
    return sym


def boundaries(sym: np.ndarray) -> np.ndarray:
    """Whether a piece begins at each position, by the scan."""
    n = len(sym)
    wide = np.full(-(-n // BLOCK) * BLOCK, SYM_W, np.uint8)
    wide[:n] = sym
    cols = np.ascontiguousarray(wide.reshape(-1, BLOCK).T)
    fun = np.broadcast_to(np.arange(8, dtype=np.uint8), (cols.shape[1], 8))
    flat = STEP.ravel()
    for col in cols:
        fun = flat[(col[:, None].astype(np.int16) << 3) + fun]
    reach, hop = fun.copy(), 1
    while hop < len(reach):  # after this, reach[k] composes blocks 0 to k
        nxt = reach.copy()
        nxt[hop:] = np.take_along_axis(reach[hop:], reach[:-hop].astype(np.intp), axis=1)
        reach, hop = nxt, hop * 2
    state = np.concatenate(([ENDED], reach[:-1, ENDED])).astype(np.int16)
    cut, out = CUT.ravel(), np.empty(cols.shape, bool)
    for k, col in enumerate(cols):
        at = (col.astype(np.int16) << 3) + state
        out[k] = cut[at]
        state = flat[at].astype(np.int16)
    return out.T.ravel()[:n]


def pieces(b: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(byte offset of each piece, pieces per row)."""
    if not len(b):
        return np.zeros(0, np.int64), np.zeros(len(offs) - 1, np.int64)
    if (b < 0x80).all():
        points, place = b.astype(np.int32), None
    else:
        points = np.frombuffer(b.tobytes().decode("utf-8", "replace").encode("utf-32-le"), np.int32)
        place = np.flatnonzero((b & 0xC0) != 0x80)
        if len(place) != len(points):
            raise ValueError("not UTF-8")
    rows = np.unique(offs[:-1][np.diff(offs) > 0])
    first = rows if place is None else np.searchsorted(place, rows)
    at = np.flatnonzero(boundaries(symbols(points, first)))
    starts = at if place is None else place[at]
    return starts, np.diff(np.searchsorted(starts, offs))


class ByteBpe:
    """Ranks of a file in tiktoken's format: merges, cache and decoder."""

    def __init__(self, path: str):
        with open(path, "rb") as f:
            self.ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self.vocab = [b""] * (max(self.ranks.values()) + 1)
        for k, v in self.ranks.items():
            self.vocab[v] = k
        self.sizes = np.fromiter(map(len, self.vocab), np.int64, len(self.vocab))
        self.single = np.array([self.ranks[bytes([x])] for x in range(256)], np.int64)
        made = [(self.ranks[t[:i]] << 17 | self.ranks[t[i:]], r) for t, r in self.ranks.items() for i in range(1, len(t)) if t[:i] in self.ranks and t[i:] in self.ranks]
        pairs = np.array(sorted(made), np.int64)
        # An open hash table of the pairs, for lookups of whole arrays.
        self.size = 1 << 21
        self.keys, self.made = np.full(self.size, -1, np.int64), np.full(self.size, 1 << 30, np.int64)
        left, slot = np.arange(len(pairs)), self._slot(pairs[:, 0])
        self.probes = 0
        while len(left):
            free = self.keys[slot[left]] < 0
            take, where = left[free], slot[left[free]]
            _, one = np.unique(where, return_index=True)
            self.keys[where[one]], self.made[where[one]] = pairs[take[one], 0], pairs[take[one], 1]
            left = np.setdiff1d(left, take[one], assume_unique=True)
            slot[left] = (slot[left] + 1) & (self.size - 1)
            self.probes += 1
        self.digits = np.array([b"%d " % i for i in range(len(self.vocab))], "S8").view(np.uint8).reshape(-1, 8)
        self.cache = PieceCache(self._encode)

    def _slot(self, key: np.ndarray) -> np.ndarray:
        return ((key.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(43)).astype(np.int64)

    def _pair(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Rank of the merge of a and b, 1 << 30 for none (a or b below 0: none)."""
        key = np.where((a < 0) | (b < 0), -2, a << 17 | b)
        slot, out = self._slot(key), np.full(len(key), 1 << 30, np.int64)
        left = np.flatnonzero(key >= 0)
        for _ in range(self.probes):
            if not len(left):
                break
            there = self.keys[slot[left]]
            hit = there == key[left]
            out[left[hit]] = self.made[slot[left[hit]]]
            left = left[~hit & (there >= 0)]
            slot[left] = (slot[left] + 1) & (self.size - 1)
        return out

    def _encode(self, todo: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        out: list = [None] * len(todo)
        hard: dict[int, list[int]] = {}
        for k, p in enumerate(todo):
            r = self.ranks.get(p)
            if r is not None:
                out[k] = (r,)
            elif len(p) > 64:
                out[k] = self._long(p)
            else:
                hard.setdefault(-(-len(p) // 8), []).append(k)
        for width, ks in hard.items():
            for i in range(0, len(ks), 8192):
                self._merge([todo[k] for k in ks[i : i + 8192]], width * 8, ks[i : i + 8192], out)
        lens = np.fromiter(map(len, out), np.int64, len(out))
        return np.fromiter((x for y in out for x in y), np.uint16, int(lens.sum())), lens

    def _merge(self, todo: list[bytes], width: int, ks: list[int], out: list) -> None:
        """Merges many pieces of at most ``width`` bytes at once, one pair of each piece per turn."""
        m = len(todo)
        size = np.fromiter(map(len, todo), np.int64, m)
        raw = np.frombuffer(b"".join(p.ljust(width, b"\0") for p in todo), np.uint8).reshape(m, width)
        tok = np.where(np.arange(width) < size[:, None], self.single[raw], -1)
        rank = np.full((m, width), 1 << 30, np.int64)
        rank[:, :-1] = self._pair(tok[:, :-1].ravel(), tok[:, 1:].ravel()).reshape(m, -1)
        live, cols = np.arange(m), np.arange(width)
        while len(live):
            t, r = tok[live], rank[live]
            j = r.argmin(axis=1)
            best = r[np.arange(len(live)), j]
            go = best < 1 << 30
            live, t, r, j, best = live[go], t[go], r[go], j[go], best[go]
            if not len(live):
                break
            rows = np.arange(len(live))
            src = np.minimum(cols + (cols > j[:, None]), width - 1)
            t, r = np.take_along_axis(t, src, 1), np.take_along_axis(r, src, 1)
            t[:, -1], r[:, -1] = -1, 1 << 30
            t[rows, j] = best
            after = np.where(j + 1 < width, t[rows, np.minimum(j + 1, width - 1)], -1)
            r[rows, j] = self._pair(best, after)
            prev = np.maximum(j - 1, 0)
            r[rows, prev] = np.where(j > 0, self._pair(t[rows, prev], best), r[rows, prev])
            tok[live], rank[live] = t, r
        for k, row in zip(ks, tok.tolist(), strict=True):
            out[k] = row[: row.index(-1)] if row[-1] == -1 else row

    def _long(self, p: bytes) -> list[int]:
        """One long piece, with a heap over its linked tokens."""
        tok, nxt = [int(self.single[x]) for x in p], [*range(1, len(p)), -1]
        prev, alive = [*range(-1, len(p) - 1)], [True] * len(p)
        text = [bytes([x]) for x in p]
        heap = [(r, i, 2) for i in range(len(p) - 1) if (r := self.ranks.get(p[i : i + 2])) is not None]
        heapq.heapify(heap)
        while heap:
            r, i, size = heapq.heappop(heap)
            j = nxt[i]
            if not alive[i] or j < 0 or len(text[i]) + len(text[j]) != size or self.ranks.get(text[i] + text[j]) != r:
                continue
            text[i] += text[j]
            tok[i], alive[j], nxt[i] = r, False, nxt[j]
            if nxt[j] >= 0:
                prev[nxt[j]] = i
            for a, c in ((prev[i], i), (i, nxt[i])):
                if a >= 0 and c >= 0 and (q := self.ranks.get(text[a] + text[c])) is not None:
                    heapq.heappush(heap, (q, a, len(text[a]) + len(text[c])))
        return [t for t, x in zip(tok, alive, strict=True) if x]

    def encode(self, b: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(ids, ids per row, byte offset of each piece, pieces per row, ids per piece)."""
        starts, per_row = pieces(b, offs)
        ends = np.append(starts[1:], len(b))
        ids, lens = self.cache.tokens(b.tobytes(), span_keys(b, starts, ends, lower=False), starts, ends)
        total = np.concatenate(([0], np.cumsum(lens)))
        return ids, np.diff(total[np.concatenate(([0], np.cumsum(per_row)))]), starts, per_row, lens

    def decode(self, ids: np.ndarray) -> bytes:
        return b"".join(map(self.vocab.__getitem__, ids.tolist()))

    def spelled(self, ids: np.ndarray) -> bytes:
        """Decimal ids joined by one blank."""
        wide = self.digits[ids].ravel()
        return wide[wide != 0].tobytes()[:-1]

    def decode_range(self, ids: np.ndarray, offsets: np.ndarray, tokens: np.ndarray, lo: int, hi: int) -> tuple[int, bytes]:
        """(byte offset in the text, bytes) of the ids [lo, hi) of a row: the piece's offset gives the place, not the ids before."""
        bounds = np.concatenate(([0], np.cumsum(tokens)))
        piece = max(int(np.searchsorted(bounds, lo, "right")) - 1, 0)
        if lo >= bounds[-1]:
            return int(offsets[-1]) + int(self.sizes[ids[bounds[-2] :]].sum()) if len(offsets) else 0, b""
        return int(offsets[piece]) + int(self.sizes[ids[bounds[piece] : lo]].sum()), self.decode(ids[lo:hi])

    def decode_pieces(self, ids: np.ndarray, offsets: np.ndarray, tokens: np.ndarray) -> bytes:
        """The text of a row. Each piece must lie where its offset says and hold the ids counted for it."""
        bounds = np.concatenate(([0], np.cumsum(tokens)))
        at = np.concatenate(([0], np.cumsum(self.sizes[ids])))
        if bounds[-1] != len(ids) or (at[bounds[:-1]] != offsets).any():
            raise ValueError("the pieces do not lie where their offsets say")
        return self.decode(ids)


@cache
def coder(path: str) -> ByteBpe:
    return ByteBpe(path)


def ranks_file(name: str = "byte_bpe_50k.tiktoken") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def _encoded(path: str):
    def run(batches):
        for batch in batches:
            b, offs = text_buffers(batch.column("text"))
            for i, j in row_chunks(offs):
                ids, per, starts, per_row, lens = coder(path).encode(b[offs[i] : offs[j]], offs[i : j + 1] - offs[i])
                lists = [pa.ListArray.from_arrays(pa.array(np.concatenate(([0], np.cumsum(n))).astype(np.int32)), pa.array(v.astype(np.int32))) for v, n in ((ids, per), (starts - np.repeat(offs[i:j] - offs[i], per_row), per_row), (lens, per_row))]
                yield pa.RecordBatch.from_arrays([batch.column("doc_id").slice(i, j - i).cast(pa.int64()), *lists], ["doc_id", "ids", "piece_offsets", "piece_tokens"])

    return run


def encode_documents(docs: DataFrame, path: str | None = None) -> DataFrame:
    """(doc_id, ids, piece_offsets, piece_tokens): the ids, the byte offset of each piece and how many ids it has."""
    docs = rows_of(docs)
    return docs.mapInArrow(_encoded(path or ranks_file()), "doc_id long, ids array<int>, piece_offsets array<int>, piece_tokens array<int>")


def _digest(path: str):
    def run(batches):
        for batch in batches:
            bpe, rows = coder(path), []
            lists = [batch.column(k) for k in ("ids", "piece_offsets", "piece_tokens")]
            values = [(x.values.to_numpy(), x.offsets.to_numpy()) for x in lists]
            for i in range(len(batch)):
                ids, offsets, tokens = (v[o[i] : o[i + 1]] for v, o in values)
                rows.append((len(ids), hashlib.sha256(bpe.spelled(ids)).hexdigest(), hashlib.sha256(bpe.decode_pieces(ids, offsets, tokens)).hexdigest()))
            n, a, d = zip(*rows, strict=True) if rows else ((), (), ())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(n, pa.int64()), pa.array(a, pa.string()), pa.array(d, pa.string())], ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return run


def digest(encoded: DataFrame, path: str | None = None) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256) of encoded documents, decoding their pieces."""
    columns = ["doc_id", "ids", "piece_offsets", "piece_tokens"]
    return encoded.select(*columns).mapInArrow(_digest(path or ranks_file()), "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
