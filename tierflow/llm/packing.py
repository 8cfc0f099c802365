"""Packing by lexical retrieval: a sharded BM25 inverted index gives each seed its unused neighbours, which fill its window.

Every input partition is cut into shards of about ``shard_tokens`` ids in row order. A shard's index maps token ids to
postings (document, BM25 weight). Windows that one document fills alone are emitted first; the remainder of each document
goes into the pool. The next unused pool entry seeds a window, the index ranks unused entries by BM25 against the seed's
distinct terms, all of them, and they fill the window in that order; the last one is cut where the window ends and its rest
stays in the pool. So every sequence but the last of a shard is exactly full. Postings of used documents are dropped whenever
a quarter of the index is used. Nothing is shuffled: shards see one partition each,
hot sources spread over shards, and memory is bounded by the shard and the longest document.

Defined cases: null and blank texts hold the end id alone; repeated rows are packed once each; a document is named by its
row, so equal or null doc_ids stay apart; an empty table gives no piece. Extra columns are never read.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from tierflow.llm.base import row_chunks, rows_of, text_buffers
from tierflow.llm.word_bpe import encoder, vocabulary, with_end

PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"
K1, B = 1.2, 0.75


class Bm25:
    """An inverted index over the documents of one shard; terms are token ids."""

    def __init__(self, ids: np.ndarray, per_doc: np.ndarray):
        n, doc = len(per_doc), np.repeat(np.arange(len(per_doc), dtype=np.uint32), per_doc)
        order = np.argsort(ids, kind="stable")  # by term, then by document
        term, doc = ids[order], doc[order]
        first = np.ones(len(term), bool)
        first[1:] = (term[1:] != term[:-1]) | (doc[1:] != doc[:-1])
        at = np.flatnonzero(first)
        tf = np.diff(np.append(at, len(term))).astype(np.float32)
        term, doc = term[at], doc[at].astype(np.int64)
        df = np.bincount(term, minlength=1 << 16)
        idf = np.log1p((n - df + 0.5) / (df + 0.5)).astype(np.float32)
        norm = (K1 * (1 - B + B * per_doc / max(per_doc.mean(), 1))).astype(np.float32)
        self._index(term, doc, idf[term] * tf * np.float32(K1 + 1) / (tf + norm[doc]), n)

    def neighbours(self, seed: int, unused: np.ndarray, first: int = 256):
        """Unused documents by falling score against all distinct terms of the seed, ties by document: an iterator.

        The ``first`` are sorted at once and the others, all of them, only when these run out.
        """
        own = self.by_doc[self.doc_bounds[seed] : self.doc_bounds[seed + 1]]
        spans = [slice(self.bounds[t], self.bounds[t + 1]) for t in self.term[own].tolist()]
        if not spans:
            return
        docs, weight = (np.concatenate([x[s] for s in spans]) for x in (self.doc, self.weight))
        score = np.bincount(docs, weight, len(unused))
        u = np.flatnonzero((score > 0) & unused)
        score = score[u]
        if len(u) > first:
            edge = np.partition(score, len(u) - first)[len(u) - first]
            above = score >= edge  # ties at the edge come along, so that the order is that of all
            yield from u[above][np.lexsort((u[above], -score[above]))].tolist()
            u, score = u[~above], score[~above]
        yield from u[np.lexsort((u, -score))].tolist()

    def prune(self, unused: np.ndarray) -> None:
        """Drops the postings of used documents; weights stay those of the whole shard."""
        keep = unused[self.doc]
        self._index(self.term[keep], self.doc[keep], self.weight[keep], len(unused))

    def _index(self, term: np.ndarray, doc: np.ndarray, weight: np.ndarray, n: int) -> None:
        self.term, self.doc, self.weight = term, doc, weight
        self.bounds = np.searchsorted(term, np.arange((1 << 16) + 1))
        self.by_doc = np.argsort(doc.astype(np.uint16) if n <= 1 << 16 else doc, kind="stable")
        self.doc_bounds = np.searchsorted(doc[self.by_doc], np.arange(n + 1))


def pack(ids: np.ndarray, per_doc: np.ndarray, window: int = 2048) -> np.ndarray:
    """Rows (document, start, length, sequence, offset) that hold each id once."""
    out, seq = [], 0
    whole = per_doc // window
    for d in np.flatnonzero(whole).tolist():
        for k in range(int(whole[d])):
            out.append((d, k * window, window, seq, 0))
            seq += 1
    start, left = whole * window, per_doc % window
    unused = left > 0
    live = indexed = int(unused.sum())
    index = Bm25(ids, per_doc) if live > 1 else None
    cursor, n = 0, len(per_doc)
    while True:
        while cursor < n and not unused[cursor]:
            cursor += 1
        if cursor == n:
            return np.array(out, np.int64).reshape(-1, 5)
        if index is not None and 4 * live < 3 * indexed:
            index.prune(unused)  # so that a shard's work is not the square of its documents
            indexed = live
        space, current = window, cursor
        ranked = index.neighbours(cursor, unused) if index is not None else iter(())
        while space and current is not None:
            take = min(space, int(left[current]))
            out.append((current, int(start[current]), take, seq, window - space))
            space -= take
            start[current] += take
            left[current] -= take
            if not left[current]:
                unused[current], live = False, live - 1
            if not space:
                break
            current = next((d for d in ranked if unused[d]), None)
            if current is None:  # no unused document shares a term with the seed: the next one in order
                while cursor < n and not unused[cursor]:
                    cursor += 1
                current = cursor if cursor < n else None
        seq += 1


def _packer(vocab: str, window: int, shard_tokens: int):
    def run(batches):
        pid, base, held, size = TaskContext.get().partitionId(), 0, [], 0

        def flush():
            nonlocal base
            ids, per, docs = (np.concatenate([x[0] for x in held]), np.concatenate([x[1] for x in held]), pa.chunked_array([x[2] for x in held]).combine_chunks())
            held.clear()
            p = pack(ids, per, window)
            first = (np.cumsum(per) - per)[p[:, 0]] + p[:, 1]
            wide = ids.astype("<u4")
            crc = [zlib.crc32(wide[s : s + k]) for s, k in zip(first.tolist(), p[:, 2].tolist(), strict=True)]
            sequence = (np.int64(pid) << 40) + base + p[:, 3]
            base += int(p[-1, 3]) + 1
            columns = [docs.take(pa.array(p[:, 0])), pa.array(p[:, 1]), pa.array(p[:, 2]), pa.array(crc, pa.int64()), pa.array(per[p[:, 0]]), pa.array(sequence), pa.array(p[:, 4])]
            return pa.RecordBatch.from_arrays(columns, ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"])

        for batch in batches:
            b, offs = text_buffers(batch.column("text"))
            ids = batch.column("doc_id")
            for i, j in row_chunks(offs):
                held.append((*with_end(*encoder(vocab).encode(b[offs[i] : offs[j]], offs[i : j + 1] - offs[i])), ids.slice(i, j - i)))
                size += len(held[-1][0])
                if size >= shard_tokens:
                    yield flush()
                    size = 0
        if held:
            yield flush()

    return run


def pack_documents(docs: DataFrame, vocab: str | None = None, window: int = 2048, shard_tokens: int = 3_000_000) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset."""
    docs = rows_of(docs)
    return docs.mapInArrow(_packer(vocab or vocabulary(), window, shard_tokens), PIECES)
