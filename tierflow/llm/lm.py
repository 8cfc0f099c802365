"""A gated recurrent language model in numpy with a class-factored output, and its score of every whole document.

Words are runs of non-blanks, A-Z lower-cased, with one end token a document. Corpus counts of all training words come from
a pre-aggregated group-by. The ``head`` most frequent words (a bounded number) are known to every task; the others go by
hash through a join. Output classes: the ``LEARNED`` most frequent words in groups with a softmax of their own inside, the
rest of the head in frequency bins and all other words by length, with the smoothed counts inside. P(word) is
P(class | state) * P(word | class, state); each class of other words keeps one place for unknown words, so that all sums to 1.

Training: truncated backpropagation over windows, carrying the state; all training documents train, one replica in each
task, and the replicas are averaged by a group-by over parameter positions, ``rounds`` times. With ``thin`` over 1 a share
``1 / thin`` of them, chosen by hash, trains instead. Everything counted covers all training documents.

Scoring: documents run in lockstep, longest first, and carry their state from the first to the last token.

Defined cases: null, empty and blank texts are one end token; a null doc_id counts as the empty text in the folds; repeated
rows are scored each; without any training document all counts are 0; extra columns are never read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from tierflow.llm.base import Workspace, crc_mod, one_thread, parts, ragged, row_chunks, rows_of, text_buffers
from tierflow.llm.textscan import span_hash, word_spans

H, GROUPS, GROUP, BINS = 16, 16, 32, 24
LEARNED = GROUPS * GROUP
LENGTHS = np.array([3, 5, 7, 9, 11, 14, 19])  # last byte length of each class of other words but the last
LENGTH_CLASS = np.searchsorted(LENGTHS, np.arange(LENGTHS[-1] + 2)).astype(np.int8)
C = GROUPS + BINS + len(LENGTHS) + 1
START = LEARNED + C
INPUTS = START + 1
END = np.int64(0x7E4D)
SHAPES = {"wx": (INPUTS, 3 * H), "u": (H, 3 * H), "wc": (H, C), "bc": (C,), "wv": (GROUPS, H, GROUP), "bv": (GROUPS, GROUP)}


def row_words(b: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(signed word hashes with an end token after each row, length class of each, tokens per row)."""
    starts, ends, per_row = word_spans(b, offs)
    n = per_row + 1
    h, lc = np.full(int(n.sum()), END, np.int64), np.zeros(int(n.sum()), np.int8)
    words = np.ones(len(h), bool)
    words[np.cumsum(n) - 1] = False
    h[words] = span_hash(b, starts, ends).view(np.int64)
    lc[words] = LENGTH_CLASS[np.minimum(ends - starts, len(LENGTH_CLASS) - 1)]
    return h, lc, n


def _count(batches, most: int = 1 << 20):
    """(h, lc, c) pre-aggregated within the task."""
    held: list = []

    def merged():
        h, lc, c = (np.concatenate([x[k] for x in held]) for k in range(3))
        u, first, back = np.unique(h, return_index=True, return_inverse=True)
        return u, lc[first], np.bincount(back, c, len(u)).astype(np.int64)

    for batch in batches:
        b, offs = text_buffers(batch.column("text"))
        for i, j in row_chunks(offs):
            h, lc, _ = row_words(b[offs[i] : offs[j]], offs[i : j + 1] - offs[i])
            held.append((h, lc, np.ones(len(h), np.int64)))
            if sum(len(x[0]) for x in held) > 2 * most:
                held = [merged()]
                if len(held[0][0]) > most:
                    yield _counts(*held.pop())
    if held:
        yield _counts(*merged())


def _counts(h, lc, c):
    return pa.RecordBatch.from_arrays([pa.array(h), pa.array(lc.astype(np.int32)), pa.array(c)], ["h", "lc", "c"])


class Vocabulary:
    """The head's hashes and counts with their classes, and the totals of the classes of other words."""

    def __init__(self, head_h: np.ndarray, head_c: np.ndarray, rest: dict[int, tuple[int, int]], total: int, distinct: int):
        self.total, self.distinct = total, distinct
        rank = np.arange(len(head_h))
        mass = np.cumsum(head_c[LEARNED:]) / max(head_c[LEARNED:].sum(), 1)
        cls = np.where(rank < LEARNED, rank // GROUP, 0)
        cls[LEARNED:] = GROUPS + np.minimum((mass * BINS).astype(int), BINS - 1)
        self.place = np.argsort(head_h, kind="stable")
        self.keys, self.c, self.cls = head_h[self.place], head_c, cls.astype(np.int8)
        self.slots, self.probes = self._table(head_h)
        sums = np.bincount(cls, head_c, C)
        for k, (n, _) in rest.items():
            sums[GROUPS + BINS + k] = n
        self.class_mass = sums
        # log10 of P(word | class) of the binned words; the others keep their numerator for the join.
        with np.errstate(divide="ignore"):
            self.inside = np.where(rank < LEARNED, 0.0, np.log10(np.maximum(head_c, 1)) - np.log10(np.maximum(sums[cls], 1)))
        self.rest_norm = np.array([np.log10(rest.get(k, (0, 0))[0] + 0.1 * (rest.get(k, (0, 0))[1] + 1)) for k in range(len(LENGTHS) + 1)])

    def _table(self, head_h: np.ndarray) -> tuple[np.ndarray, int]:
        """An open hash table of ranks: a word lies in the slot of its hash or one of the next ``probes`` - 1."""
        self.hashes, self.bits = head_h, max(4, int(4 * len(head_h)).bit_length())
        slots, left, probes = np.full(1 << self.bits, -1, np.int32), np.arange(len(head_h)), 0
        at = self._slot(head_h)
        while len(left):
            free = slots[at[left]] < 0
            take = left[free]
            _, one = np.unique(at[take], return_index=True)
            slots[at[take[one]]] = take[one]
            left = np.setdiff1d(left, take[one], assume_unique=True)
            at[left] = (at[left] + 1) & ((1 << self.bits) - 1)
            probes += 1
        return slots, probes

    def _slot(self, h: np.ndarray) -> np.ndarray:
        return (h.view(np.uint64) >> np.uint64(64 - self.bits)).astype(np.int64)

    def look(self, h: np.ndarray) -> np.ndarray:
        """Rank in the head, -1 for other words."""
        h = np.ascontiguousarray(h)
        out = np.full(len(h), -1, np.int64)
        at, left = self._slot(h), None
        for _ in range(self.probes):
            rank = self.slots[at if left is None else at[left]]
            there = rank >= 0
            hit = there & (self.hashes[rank] == (h if left is None else h[left]))
            where = np.flatnonzero(hit) if left is None else left[hit]
            out[where] = rank[hit]
            left = np.flatnonzero(there & ~hit) if left is None else left[there & ~hit]
            if not len(left):
                break
            at[left] = (at[left] + 1) & ((1 << self.bits) - 1)
        return out

    def encode(self, h: np.ndarray, lc: np.ndarray):
        """(rank, class, input id) of each token."""
        rank = self.look(h)
        safe = np.maximum(rank, 0)
        cls = np.where(rank >= 0, self.cls[safe] if len(self.cls) else 0, GROUPS + BINS + lc).astype(np.int16)
        return rank, cls, np.where((rank >= 0) & (rank < LEARNED), rank, LEARNED + cls).astype(np.int16)


def initial(vocab: Vocabulary) -> dict[str, np.ndarray]:
    """Small random weights; the output starts at the counts."""
    rng = np.random.Generator(np.random.PCG64(8))
    p = {k: (rng.standard_normal(s) * 0.1).astype(np.float32) for k, s in SHAPES.items()}
    mass = vocab.class_mass + 0.5
    p["bc"] = np.log(mass / mass.sum()).astype(np.float32)
    own = np.zeros(LEARNED)
    own[: min(LEARNED, len(vocab.c))] = vocab.c[:LEARNED]
    own = own.reshape(GROUPS, GROUP) + 0.5
    p["bv"] = np.log(own / own.sum(axis=1, keepdims=True)).astype(np.float32)
    p["wv"] *= 0.1
    p["wc"] *= 0.1
    return p


def flat(p: dict[str, np.ndarray]) -> np.ndarray:
    return np.concatenate([p[k].ravel() for k in SHAPES])


def views(v: np.ndarray) -> dict[str, np.ndarray]:
    """The parameters as parts of one vector, sharing its memory."""
    out, at = {}, 0
    for k, s in SHAPES.items():
        n = int(np.prod(s))
        out[k] = v[at : at + n].reshape(s)
        at += n
    return out


def unflat(v: np.ndarray) -> dict[str, np.ndarray]:
    return {k: x.astype(np.float32) for k, x in views(v).items()}


def exps(logit: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(exponentials, their sums by row, the shift that was taken off). One shift serves all rows unless a row's sum vanishes;
    none is needed where the largest logit is small."""
    shift = logit.max() if logit.size else logit.dtype.type(0)
    if 0 <= shift <= 60:
        shift, e = logit.dtype.type(0), np.exp(logit)
    else:
        e = np.subtract(logit, shift)
        np.exp(e, out=e)
    total = e @ np.ones(e.shape[1], e.dtype)
    if total.all():
        return e, total, np.broadcast_to(shift, len(logit))
    shift = logit.max(axis=1)
    e = np.exp(logit - shift[:, None])
    return e, e.sum(axis=1), shift


def by_group(cls: np.ndarray):
    """(places of the words in learned groups, sorted by group; [(group, from, to)] among these)."""
    order = np.argsort(cls.astype(np.uint8), kind="stable")
    bounds = np.searchsorted(cls[order], np.arange(GROUPS + 1))
    return order[: bounds[-1]], [(g, bounds[g], bounds[g + 1]) for g in range(GROUPS) if bounds[g] < bounds[g + 1]]


def inner_logits(p, hs: np.ndarray, groups) -> np.ndarray:
    """The logits inside the own group of each state; ``hs`` is sorted by group."""
    out = np.empty((len(hs), GROUP), hs.dtype)
    for g, lo, hi in groups:
        np.matmul(hs[lo:hi], p["wv"][g], out=out[lo:hi])
        out[lo:hi] += p["bv"][g]
    return out


def log_probs(p, hs: np.ndarray, cls: np.ndarray, rank: np.ndarray) -> np.ndarray:
    """Natural log of P(class | state), and of P(word | class, state) for the learned groups."""
    logit = hs @ p["wc"]
    logit += p["bc"]
    _, total, shift = exps(logit)
    out = logit.take(np.arange(len(hs)) * C + cls) - shift - np.log(total)
    at, groups = by_group(cls)
    if len(at):
        inner = inner_logits(p, hs.take(at, axis=0), groups)
        _, total, shift = exps(inner)
        out[at] += inner.take(np.arange(len(at)) * GROUP + rank.take(at) % GROUP) - shift - np.log(total)
    return out


def score_rows(p, rank, cls, ids, lens: np.ndarray, window: int = 8192) -> np.ndarray:
    """Natural-log likelihood of each row's tokens, with the state carried from its first to its last token."""
    order = np.argsort(-lens, kind="stable")
    starts = (np.cumsum(lens) - lens)[order]
    length = lens[order]
    inputs = np.concatenate(([START], ids[:-1])).astype(np.int32)
    inputs[starts] = START
    out, h = np.zeros(len(ids), np.float64), np.zeros((H, len(lens)), p["u"].dtype)
    ut = np.ascontiguousarray(p["u"].T)
    active = len(lens) - np.searchsorted(length[::-1], np.arange(int(length[0]) if len(length) else 0), "right")
    hs, at, held = [], [], 0
    for t, n in enumerate(active.tolist()):
        place = starts[:n] + t
        before = np.ascontiguousarray(h[:, :n])
        h = gates(np.ascontiguousarray(p["wx"].take(inputs.take(place), axis=0).T), ut @ before, before, np.empty_like(before))
        hs.append(h.T)
        at.append(place)
        held += n
        if held >= window or t == len(active) - 1:
            where = np.concatenate(at)
            out[where] = log_probs(p, np.concatenate(hs), cls.take(where), rank.take(where))
            hs, at, held = [], [], 0
    return np.add.reduceat(out, np.cumsum(lens) - lens) if len(lens) else np.zeros(0)


def gates(a: np.ndarray, g: np.ndarray, h: np.ndarray, new: np.ndarray) -> np.ndarray:
    """One step of the gated unit from the parts of its inputs and of its state, with units in rows and streams in columns, so
    that each gate is one block of memory. Leaves the update gate, the reset gate and the candidate in ``a`` and the new state
    in ``new``."""
    zr = a[: 2 * H]
    zr += g[: 2 * H]
    np.negative(zr, out=zr)
    np.exp(zr, out=zr)
    zr += 1
    np.reciprocal(zr, out=zr)
    z, r, n = a[:H], a[H : 2 * H], a[2 * H :]
    n += np.multiply(r, g[2 * H :], out=new)
    np.tanh(n, out=n)
    np.subtract(h, n, out=new)
    new *= z
    new += n
    return new


def classes(v: np.ndarray) -> np.ndarray:
    """The class weights of a parameter vector with their biases as the last row; they lie side by side in it."""
    at = sum(int(np.prod(SHAPES[k])) for k in ("wx", "u"))
    return v[at : at + (H + 1) * C].reshape(H + 1, C)


def softmax_error(logit: np.ndarray, own: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """The gradient of the weighted loss in the logits, ``own`` being the right column of each row."""
    err, total, _ = exps(logit)
    err *= (weight / total)[:, None]
    err.reshape(-1)[np.arange(len(own)) * err.shape[1] + own] -= weight
    return err


def train_replica(p, rank, cls, ids, lens, streams: int = 128, span: int = 16, rate: float = 0.01):
    """Truncated backpropagation with Adam over one pass of the rows, laid end to end in streams."""
    first = np.zeros(len(ids), bool)
    first[np.cumsum(lens) - lens] = True
    inputs = np.where(first, START, np.concatenate(([START], ids[:-1]))).astype(np.uint16)
    group, place = np.minimum(cls, GROUPS).astype(np.uint8), (rank % GROUP).astype(np.int64)
    streams = max(1, min(streams, len(ids) // (2 * span)))
    width = -(-len(ids) // streams)
    grid = np.minimum(np.arange(streams)[:, None] * width + np.arange(width), len(ids) - 1)
    real = (np.arange(streams)[:, None] * width + np.arange(width)) < len(ids)
    h = np.zeros((H, streams), np.float32)
    whole = flat(p)
    p, (m, v, grad) = views(whole), np.zeros((3, len(whole)), np.float32)
    g = views(grad)
    # Biases are the last row of the weights: the state gets a column of ones.
    wv, gv, rows = np.empty((GROUPS, H + 1, GROUP), np.float32), np.empty((GROUPS, H + 1, GROUP), np.float32), np.ones((streams * span, H + 1), np.float32)
    befores, recurrents, news, backs = (np.empty((span, k * H, streams), np.float32) for k in (1, 3, 1, 4))
    for turn, lo in enumerate(range(0, width, span), 1):
        cols = grid[:, lo : lo + span].T
        steps = len(cols)
        use = real[:, lo : lo + span].T.astype(np.float32)
        where, weight = cols.ravel(), use.ravel() / max(use.sum(), 1)
        fed, goes_on = inputs.take(where), (~first.take(where)).astype(np.float32).reshape(steps, streams)
        a = np.ascontiguousarray(p["wx"].take(fed, axis=0).reshape(steps, streams, 3 * H).transpose(0, 2, 1))
        ut, before, recurrent, states = np.ascontiguousarray(p["u"].T), befores[:steps], recurrents[:steps], news[:steps]
        for t in range(steps):
            np.multiply(h, goes_on[t], out=before[t])
            np.matmul(ut, before[t], out=recurrent[t])
            h = gates(a[t], recurrent[t], before[t], states[t])
        h = h.copy()
        # Words sorted by learned group, those outside the learned groups last.
        groups = group.take(where)
        order = np.argsort(groups, kind="stable")
        bounds = np.concatenate(([0], np.cumsum(np.bincount(groups, minlength=GROUPS + 1)[:GROUPS]))).tolist()
        groups, learned = [(k, bounds[k], bounds[k + 1]) for k in range(GROUPS) if bounds[k] < bounds[k + 1]], bounds[-1]
        rows[: len(where)].reshape(steps, streams, H + 1)[:, :, :H] = states.transpose(0, 2, 1)
        hs, where, weight = rows[: len(where)].take(order, axis=0), where.take(order), weight.take(order)
        grad[:] = 0
        err = softmax_error(hs @ classes(whole), cls.take(where), weight)
        np.matmul(hs.T, err, out=classes(grad))
        dhs = err @ p["wc"].T
        if learned:
            wv[:, :H], wv[:, H], gv[:] = p["wv"], p["bv"], 0
            inner, back = np.empty((learned, GROUP), np.float32), np.empty((learned, H), np.float32)
            for k, lo, hi in groups:
                np.matmul(hs[lo:hi], wv[k], out=inner[lo:hi])
            inner = softmax_error(inner, place.take(where[:learned]), weight[:learned])
            for k, lo, hi in groups:
                np.matmul(hs[lo:hi].T, inner[lo:hi], out=gv[k])
                np.matmul(inner[lo:hi], p["wv"][k].T, out=back[lo:hi])
            g["wv"][:], g["bv"][:] = gv[:, :H], gv[:, H]
            dhs[:learned] += back
        unsorted = np.empty_like(order)
        unsorted[order] = np.arange(len(order))
        dhs, dh = np.ascontiguousarray(dhs.take(unsorted, axis=0).reshape(steps, streams, H).transpose(0, 2, 1)), np.zeros((H, streams), np.float32)
        # The factors that do not depend on what flows back, for all steps at once.
        z, r, n = a[:, :H], a[:, H : 2 * H], a[:, 2 * H :]
        rest, dn = 1 - z, n * n
        np.subtract(1, dn, out=dn)
        dn *= rest
        rest *= z
        rest *= before - n
        dr = 1 - r
        dr *= r
        dr *= recurrent[:, 2 * H :]
        # Of each step: candidate, update gate, reset gate, the candidate's recurrent part. The first three belong to the inputs, the last three to the state.
        das = backs[:steps]
        for t in range(steps - 1, -1, -1):
            dh += dhs[t]
            da = das[t]
            own = da[:H]
            np.multiply(dh, dn[t], out=own)
            np.multiply(dh, rest[t], out=da[H : 2 * H])
            np.multiply(own, dr[t], out=da[2 * H : 3 * H])
            np.multiply(own, r[t], out=da[3 * H :])
            dh *= z[t]
            dh += p["u"] @ da[H:]
            dh *= goes_on[t]
        # Every step's share at once: inputs are sorted, so that those that occur several times are summed, two numbers at a time.
        order = np.argsort(fed, kind="stable")
        fed = fed.take(order)
        new = np.flatnonzero(np.concatenate(([True], fed[1:] != fed[:-1])))
        share = np.take(das[:, : 3 * H].transpose(0, 2, 1).reshape(-1, 3 * H), order, axis=0)
        share = np.add.reduceat(share.view(np.complex64), new, axis=0).view(np.float32)
        g["wx"][fed[new]] = np.concatenate((share[:, H:], share[:, :H]), axis=1)
        g["u"][:] = np.matmul(before, das[:, H:].transpose(0, 2, 1)).sum(axis=0)
        norm = float(np.sqrt(grad @ grad))
        grad *= np.float32(min(1.0, 1.0 / max(norm, 1e-9)))
        m *= np.float32(0.9)
        m += np.float32(0.1) * grad
        v *= np.float32(0.999)
        grad *= grad
        grad *= np.float32(0.001)
        v += grad
        size, root = np.float32(rate / (1 - 0.9**turn)), np.float32(1 / np.sqrt(1 - 0.999**turn))
        step_size = np.sqrt(v)
        step_size *= root
        step_size += np.float32(1e-6)
        np.divide(m, step_size, out=step_size)
        step_size *= size
        whole -= step_size
    return p


def _tokens(batches, vocab: Vocabulary, most: int):
    """Groups of whole rows of about ``most`` tokens: (ids, tokens per row, hashes, ranks, classes, inputs)."""
    held, size = [], 0
    for batch in batches:
        b, offs = text_buffers(batch.column("text"))
        for i, j in row_chunks(offs):
            h, lc, n = row_words(b[offs[i] : offs[j]], offs[i : j + 1] - offs[i])
            rank, cls, ids = vocab.encode(h, lc)
            held.append((batch.column("doc_id").slice(i, j - i), n, np.where(rank < 0, h, 0), rank.astype(np.int32), cls, ids))
            size += len(h)
            if size >= most:
                yield held
                held, size = [], 0
    if held:
        yield held


def _trainer(vocab: Vocabulary, weights: np.ndarray):
    def run(batches):
        one_thread()
        p, seen = unflat(weights), 0
        for held in _tokens(batches, vocab, 2_000_000):
            n, rank, cls, ids = (np.concatenate([x[k] for x in held]) for k in (1, 3, 4, 5))
            p, seen = train_replica(p, rank, cls.astype(np.int64), ids, n), seen + len(ids)
        if seen:
            v = flat(p)
            yield pa.RecordBatch.from_arrays([pa.array([seen], pa.int64()), ragged(v, np.array([len(v)]), pa.float32())], ["seen", "params"])

    return run


PARTIAL = "row long, doc_id long, n_tokens long, head_known long, head_base double, model double, tail array<struct<h:bigint,k:int>>"


def _scorer(vocab: Vocabulary, weights: np.ndarray):
    def run(batches):
        one_thread()
        p, row = unflat(weights), TaskContext.get().partitionId() << 40
        logs = np.log10(vocab.c + 0.1) if len(vocab.c) else np.zeros(1)
        inside = vocab.inside if len(vocab.c) else np.zeros(1)
        for held in _tokens(batches, vocab, 2_000_000):
            n, tail, rank, cls, ids = (np.concatenate([x[k] for x in held]) for k in (1, 2, 3, 4, 5))
            docs = pa.concat_arrays([x[0].cast(pa.int64()) for x in held])
            starts, safe, known = np.cumsum(n) - n, np.maximum(rank, 0), rank >= 0
            model = score_rows(p, rank, cls.astype(np.int64), ids, n) / np.log(10)
            extra = np.where(known, inside[safe], -vocab.rest_norm[np.clip(cls - GROUPS - BINS, 0, None)])
            model += np.add.reduceat(extra, starts)
            doc = np.repeat(np.arange(len(n)), n)[~known]
            h = tail[~known]
            order = np.lexsort((h, doc))
            doc, h = doc[order], h[order]
            new = np.ones(len(h), bool)
            new[1:] = (doc[1:] != doc[:-1]) | (h[1:] != h[:-1])
            at = np.flatnonzero(new)
            struct = pa.StructArray.from_arrays([pa.array(h[at]), pa.array(np.diff(np.append(at, len(h))).astype(np.int32))], ["h", "k"])
            per = np.bincount(doc[at], minlength=len(n))
            lists = pa.ListArray.from_arrays(pa.array(np.concatenate(([0], np.cumsum(per))).astype(np.int32)), struct)
            yield pa.RecordBatch.from_arrays(
                [pa.array(row + np.arange(len(n))), docs, pa.array(n.astype(np.int64)), pa.array(np.add.reduceat(known.astype(np.int64), starts)), pa.array(np.add.reduceat(np.where(known, logs[safe], 0.0), starts)), pa.array(model), lists],
                ["row", "doc_id", "n_tokens", "head_known", "head_base", "model", "tail"],
            )
            row += len(n)

    return run


def fit(docs: DataFrame, ws: Workspace, head: int, thin: int, rounds: int) -> tuple[Vocabulary, np.ndarray, DataFrame]:
    """(vocabulary, weights, counts of all training words) from the training documents."""
    train = docs.where(crc_mod(F.col("doc_id"), 10) != 0)
    counts = ws.keep(train.select("doc_id", "text").mapInArrow(_count, "h long, lc int, c long").groupBy("h", "lc").agg(F.sum("c").alias("c")), "counts")
    top = counts.orderBy(F.desc("c"), "h").limit(head).select("h", "lc", "c").toArrow()  # at most ``head`` rows of 20 bytes
    head_h, head_lc, head_c = (top.column(k).to_numpy() for k in ("h", "lc", "c"))
    per = {r["lc"]: (r["n"], r["v"]) for r in counts.groupBy("lc").agg(F.sum("c").alias("n"), F.count("*").alias("v")).collect()}
    total, distinct = sum(n for n, _ in per.values()), sum(v for _, v in per.values())
    rest = {k: (n - int(head_c[head_lc == k].sum()), v - int((head_lc == k).sum())) for k, (n, v) in per.items()}
    vocab = Vocabulary(head_h, head_c, rest, total, distinct)
    weights = flat(initial(vocab))
    share = train
    if thin > 1:
        share = ws.keep(train.where(F.pmod(F.xxhash64("doc_id"), F.lit(thin)) == 0).repartition(parts(docs.sparkSession)), "share")
    for k in range(rounds):
        replicas = ws.keep(share.mapInArrow(_trainer(vocab, weights), "seen long, params array<float>"), f"replicas{k}")
        mean = replicas.select("seen", F.posexplode("params")).groupBy("pos").agg((F.sum(F.col("col").cast("double") * F.col("seen")) / F.sum("seen")).alias("v"))
        got = mean.orderBy("pos").toArrow().column("v").to_numpy()  # as many rows as the model has parameters
        if len(got):
            weights = got.astype(np.float32)
    return vocab, weights, counts


def score(docs: DataFrame, head: int = 131_072, thin: int = 1, rounds: int = 2) -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score) of every row."""
    ws = Workspace(docs.sparkSession, "lm")
    docs = rows_of(docs)
    vocab, weights, counts = fit(docs, ws, head, thin, rounds)
    partial = ws.keep(docs.mapInArrow(_scorer(vocab, weights), PARTIAL), "partial")
    tail = partial.select("row", F.inline("tail")).join(counts.select("h", "c"), "h", "left")
    c = F.coalesce(F.col("c"), F.lit(0))
    tail = tail.groupBy("row").agg(F.sum(F.when(c > 0, F.col("k")).otherwise(0)).alias("tail_known"), F.sum(F.col("k") * F.log10(c + 0.1)).alias("tail_log"))
    out = partial.drop("tail").join(tail, "row", "left").withColumn("tail_log", F.coalesce("tail_log", F.lit(0.0)))
    norm = float(np.log10(vocab.total + 0.1 * (vocab.distinct + 1)))
    return out.select(
        "doc_id",
        (crc_mod(F.col("doc_id"), 10) == 0).alias("held_out"),
        "n_tokens",
        (F.col("head_known") + F.coalesce("tail_known", F.lit(0))).cast("long").alias("n_known"),
        F.lit(vocab.total).cast("long").alias("train_tokens"),
        (F.col("head_base") + F.col("tail_log") - F.col("n_tokens") * F.lit(norm)).alias("base_score"),
        (F.col("model") + F.col("tail_log")).alias("score"),
    )
