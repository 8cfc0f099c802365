"""Near-duplicate documents by HyperMinHash registers, banding, estimation and confirmation on the full sets.

A document's set holds the 64-bit hashes of its distinct 5-word shingles (A-Z lower-cased). One hash per shingle picks one
of 256 buckets; a register keeps the leading-zero count and ten mantissa bits of the smallest hash of its bucket. Bands of
registers propose candidates (empty registers borrow their value for banding only), the collision-corrected estimate sorts
them out, and links are confirmed on the full sets. ``band_rows`` chooses the registers of a band by the threshold, so that
a pair at the threshold itself stays without a shared band with a probability of at most ``MISS``.

Scale: equal sets collapse to one node before banding; a band bucket of any size first proposes one partner per member, so
that large groups of copies become one component in linear work; then the members outside a bucket's largest component are
paired with those of other components, at most twice as many pairs as there are across components. Buckets in which even
these would be many are compared block against block inside tasks, which emit links alone; blocks are bounded by members
and by bytes. Nothing is capped or dropped.

Defined cases: null, empty or blank texts have the empty set (n_shingles 0), are kept and linked with nothing; rows that
share a doc_id are one document; rows with a null doc_id form classes by equal sets only and are not kept unless their
set is empty. Extra columns are never read.
"""

from __future__ import annotations

from functools import partial

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from tierflow.llm.base import Workspace, ragged, row_chunks, rows_of, text_buffers
from tierflow.llm.components import components
from tierflow.llm.textscan import U, mix, shingles, span_hash, word_spans

BUCKETS, MANTISSA, MISS = 256, 10, 1e-5
_EDGES = np.arange(BUCKETS, dtype=np.uint64) << U(56)
_BORROW = np.random.Generator(np.random.PCG64(11)).permuted(np.tile(np.arange(BUCKETS), (BUCKETS, 1)), axis=1)
_SALT = np.random.Generator(np.random.PCG64(12)).integers(1, 1 << 62, BUCKETS, dtype=np.uint64) * U(2) + U(1)
SKETCH = "doc_id long, n_shingles long, fp1 long, fp2 long, registers binary, bands array<long>"


def sets_of(b: np.ndarray, offs: np.ndarray) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of each row."""
    starts, ends, counts = word_spans(b, offs)
    h, row = shingles(span_hash(b, starts, ends), counts)
    at = np.searchsorted(row, np.arange(len(counts) + 1))
    out = []
    for i in range(len(counts)):
        s = np.sort(h[at[i] : at[i + 1]])
        out.append(s[np.concatenate(([True], s[1:] != s[:-1]))] if len(s) > 1 else s)
    return out


def registers_of(s: np.ndarray) -> np.ndarray:
    """uint16 registers of a sorted set: 0 is empty, else 1 + (leading zeros << MANTISSA | mantissa bits), capped."""
    first = np.searchsorted(s, _EDGES)
    full = first < np.append(first[1:], len(s))
    rest = (s[np.minimum(first, len(s) - 1)] & U((1 << 56) - 1)) >> U(3)  # 53 bits, exact as a float
    frac, exp = np.frexp(rest.astype(np.float64))
    zeros = np.minimum(53 - exp, 62)
    mantissa = ((frac * 2 - 1) * (1 << MANTISSA)).astype(np.int64).clip(0)
    return np.where(full, 1 + (zeros << MANTISSA | mantissa), 0).astype(np.uint16)


def band_rows(percent: int) -> int:
    """The most registers a band may have so that a pair of this similarity misses all bands at most with ``MISS``."""
    j = percent / 100
    return max((r for r in range(1, 33) if (1 - j**r) ** (BUCKETS // r) <= MISS), default=1)


def bands_of(reg: np.ndarray, rows: int) -> np.ndarray:
    """One signed 64-bit key per band. An empty register borrows that of a full bucket in an order fixed for it."""
    empty, bands = np.flatnonzero(reg == 0), BUCKETS // rows
    dense = reg.astype(np.uint64)
    if len(empty):
        order = _BORROW[empty]
        pick = order[np.arange(len(empty)), np.argmax(reg[order] != 0, axis=1)]
        dense[empty] = reg[pick].astype(np.uint64) | (pick.astype(np.uint64) << U(16))
    mixed = mix(dense[: bands * rows] * _SALT[: bands * rows]).reshape(bands, rows)
    return mix(mixed.sum(axis=1, dtype=np.uint64) + np.arange(bands, dtype=np.uint64)).view(np.int64)


def _sketch(rows: int):
    def run(batches):
        for batch in batches:
            b, offs = text_buffers(batch.column("text"))
            ids = batch.column("doc_id")
            for i, j in row_chunks(offs):
                n, fps, regs, bands = [], [], [], []
                for s in sets_of(b[offs[i] : offs[j]], offs[i : j + 1] - offs[i]):
                    n.append(len(s))
                    if len(s):
                        d = xxhash.xxh3_128_intdigest(s.tobytes())
                        fps.append((d >> 64, d & (1 << 64) - 1))
                        reg = registers_of(s)
                        regs.append(reg.tobytes())
                        bands.append(bands_of(reg, rows))
                    else:
                        fps.append((0, 0))
                        regs.append(b"")
                        bands.append(np.zeros(0, np.int64))
                fp = np.array(fps, np.uint64).view(np.int64)
                keys = ragged(np.concatenate(bands), np.array([len(x) for x in bands]), pa.int64())
                columns = [ids.slice(i, j - i).cast(pa.int64()), pa.array(n, pa.int64()), pa.array(fp[:, 0]), pa.array(fp[:, 1]), pa.array(regs, pa.binary()), keys]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n_shingles", "fp1", "fp2", "registers", "bands"])

    return run


def _full_sets(batches):
    for batch in batches:
        b, offs = text_buffers(batch.column("text"))
        for i, j in row_chunks(offs):
            sets = sets_of(b[offs[i] : offs[j]], offs[i : j + 1] - offs[i])
            yield pa.RecordBatch.from_arrays([batch.column("id").slice(i, j - i), pa.array([s.tobytes() for s in sets], pa.binary())], ["id", "members"])


def estimate(x: np.ndarray, y: np.ndarray, n: np.ndarray, m: np.ndarray) -> np.ndarray:
    """Jaccard estimates of register rows with cardinalities n and m, corrected for chance collisions."""
    full = np.maximum(((x != 0) | (y != 0)).sum(axis=1), 1)
    same = ((x == y) & (x != 0)).sum(axis=1)
    a, c = n[:, None] / BUCKETS, m[:, None] / BUCKETS
    level = np.arange(1, 58)
    lo, hi, width = 0.5**level, 0.5 ** (level - 1), 0.5 ** (level + MANTISSA)
    chance = (width * a * c / (a + c) * (np.exp(-(a + c) * lo) - np.exp(-(a + c) * hi))).sum(axis=1) * BUCKETS
    return np.maximum(same - chance, 0) / np.maximum(full - chance, 1e-9)


def likely(x: np.ndarray, y: np.ndarray, n: np.ndarray, m: np.ndarray, least: float) -> np.ndarray:
    """Whether the estimate comes within five deviations of ``least``. Registers that hold most of a union deviate little."""
    union = (n + m) / (1 + least)
    full = np.maximum(((x != 0) | (y != 0)).sum(axis=1), 1)
    sigma = np.sqrt(least * (1 - least) / full * np.clip(1 - full / union, 0.02, 1))
    return (np.minimum(n, m) >= least * np.maximum(n, m) - 1e-9) & (estimate(x, y, n, m) >= least - 5 * sigma - 1 / full)


def overlaps(p: np.ndarray, q: np.ndarray, percent: int) -> bool:
    """Whether two sorted sets reach the threshold."""
    if 100 * min(len(p), len(q)) < percent * max(len(p), len(q)):
        return False
    at = np.searchsorted(q, p)
    both = int((q[np.minimum(at, len(q) - 1)] == p).sum())
    return 100 * both >= percent * (len(p) + len(q) - both)


def _registers(column) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint16).reshape(-1, BUCKETS)


def _estimated(batches, least: float):
    for batch in batches:
        if len(batch):
            n, m = (batch.column(k).to_numpy().astype(float) for k in ("na", "nb"))
            yield batch.filter(pa.array(likely(_registers(batch.column("ra")), _registers(batch.column("rb")), n, m, least))).select(["a", "b"])


def _block_links(percent: int):
    return lambda key, table: block_links(key, table, percent)


def block_links(key, table: pa.Table, percent: int) -> pa.Table:
    """The links of one block pair of a bucket, across components; a pair belongs to the first large bucket that it shares."""
    ids, comp, n, own = (table.column(k).to_numpy() for k in ("id", "comp", "n", "own"))
    reg = _registers(table.column("registers"))
    sets = [np.frombuffer(x.as_buffer(), np.uint64) for x in table.column("members")]
    keys = [set(x) for x in table.column("keys").to_pylist()]
    this, lo, hi = (x.as_py() for x in key)
    earlier = [{k for k in x if k < this} for x in keys]
    left, right = np.flatnonzero(own == lo), np.flatnonzero(own == hi)
    a, b = [], []
    for i in left.tolist():
        js = right[(comp[right] != comp[i]) & ((ids[right] > ids[i]) if lo == hi else True)]
        if earlier[i]:
            js = js[[earlier[i].isdisjoint(earlier[j]) for j in js.tolist()]] if len(js) else js
        if len(js):
            js = js[likely(np.broadcast_to(reg[i], (len(js), BUCKETS)), reg[js], np.full(len(js), float(n[i])), n[js].astype(float), percent / 100)]
        for j in js.tolist():
            if overlaps(sets[i], sets[j], percent):
                a.append(int(ids[i]))
                b.append(int(ids[j]))
    return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})


def _confirmed(batches, percent: int):
    for batch in batches:
        pairs = zip(batch.column("sa"), batch.column("sb"), strict=True)
        keep = np.array([overlaps(np.frombuffer(p.as_buffer(), np.uint64), np.frombuffer(q.as_buffer(), np.uint64), percent) for p, q in pairs], bool)
        yield batch.filter(pa.array(keep)).select(["a", "b"])


class NearDup:
    """The operator. ``threshold_percent``: least Jaccard similarity of a link, in hundredths.

    ``turns``: most turns of one partner per member; they end once the pairs left across components are at most ``linear``
    for each member. Buckets with more such pairs than that are compared in blocks of about ``block`` members and
    ``block_shingles`` shingles (of eight bytes). These choose the way to a link, not which links are found.
    """

    def __init__(self, threshold_percent: int = 80, turns: int = 1, linear: int = 16, block: int = 512, block_shingles: int = 1 << 20):
        self.percent, self.turns, self.linear, self.block, self.block_shingles = threshold_percent, turns, linear, block, block_shingles

    def run(self, docs: DataFrame) -> DataFrame:
        """(doc_id, n_shingles, component_id, kept) of every row of ``docs`` (doc_id, text)."""
        ws = Workspace(docs.sparkSession, "neardup")
        docs = rows_of(docs)
        sketch = ws.keep(docs.mapInArrow(_sketch(band_rows(self.percent)), SKETCH), "sketch")
        some = sketch.where("n_shingles > 0")
        classes = some.groupBy("fp1", "fp2").agg(F.min("doc_id").alias("rep"))
        classes = ws.keep(classes.where("rep is not null"), "classes")
        nodes = sketch.join(classes.select("fp1", "fp2", F.col("rep").alias("doc_id")), ["fp1", "fp2", "doc_id"]).dropDuplicates(["fp1", "fp2"])
        nodes = ws.keep(nodes.select(F.col("doc_id").alias("id"), F.col("n_shingles").alias("n"), "registers", "bands"), "nodes")
        links = self._links(ws, docs, nodes)
        same_id = some.where("doc_id is not null").select("doc_id", "fp1", "fp2").join(classes, ["fp1", "fp2"]).where("doc_id <> rep").select(F.col("doc_id").alias("u"), F.col("rep").alias("v"))
        shared = some.groupBy("doc_id").agg(F.count("*").alias("k")).where("k > 1").select("doc_id")
        same_id = same_id.join(shared, same_id["u"] == shared["doc_id"], "left_semi")  # rows of one doc_id in several classes
        comp = ws.keep(components(ws, links.select(F.col("a").alias("u"), F.col("b").alias("v")).unionByName(same_id), "cc"), "comp")
        member = classes.join(comp, classes["rep"] == comp["id"], "left").select("fp1", "fp2", F.coalesce("comp", "rep").alias("component_id"))
        out = sketch.select("doc_id", "n_shingles", "fp1", "fp2").join(member, ["fp1", "fp2"], "left")
        root = F.when(F.col("n_shingles") == 0, F.col("doc_id")).otherwise(F.col("component_id"))
        out = out.select("doc_id", "n_shingles", root.alias("component_id"))
        return out.withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.col("n_shingles") == 0))

    def _links(self, ws: Workspace, docs: DataFrame, nodes: DataFrame) -> DataFrame:
        keys = nodes.select("id", F.explode("bands").alias("key"))
        shared = keys.groupBy("key").agg(F.count("*").alias("size")).where("size > 1").select("key")
        members = ws.keep(keys.join(shared, "key"), "members")
        involved = members.select("id").distinct()
        some = nodes.join(involved, "id").select("id", "n", "registers")
        # The ids are hashed, so that the texts stream past them unsorted.
        sets = docs.withColumnRenamed("doc_id", "id").join(involved.hint("shuffle_hash"), "id", "left_semi").mapInArrow(_full_sets, "id long, members binary")
        sketches, sets = ws.keep(some, "involved"), ws.keep(sets, "sets")
        labelled = members.select("key", "id", F.col("id").alias("comp"))
        links = None
        for turn in range(self.turns):
            # One partner for each node: the hub of another component that shares most bands with it.
            hubs = labelled.groupBy("key").agg(F.min(F.struct(F.xxhash64("id", F.lit(turn)).alias("order"), "id", "comp")).alias("hub"))
            stars = labelled.join(hubs, "key").where(F.col("comp") != F.col("hub.comp")).groupBy("id", F.col("hub.id").alias("hub")).agg(F.count("*").alias("k"))
            stars = stars.groupBy("id").agg(F.max(F.struct("k", "hub")).alias("best"))
            found = self._confirm(ws, stars.select(F.col("id").alias("a"), F.col("best.hub").alias("b")), sketches, sets, f"stars{turn}")
            links = found if links is None else links.unionByName(found)
            comp = components(ws, links.select(F.col("a").alias("u"), F.col("b").alias("v")), f"star{turn}")
            labelled = members.select("key", "id").join(comp, "id", "left").select("key", "id", F.coalesce("comp", "id").alias("comp"))
            labelled = ws.keep(labelled, f"labelled{turn}")
            n, across = self._mixed(labelled).agg(F.coalesce(F.sum("n"), F.lit(0)), F.coalesce(F.sum("across"), F.lit(0))).first()
            if across <= self.linear * n:
                break
        mixed = ws.keep(self._mixed(labelled).withColumn("large", F.col("across") > self.linear * F.col("n")), "mixed")
        links = links.unionByName(self._confirm(ws, self._across(labelled, mixed), sketches, sets, "rest"))
        if mixed.where("large").limit(1).count():
            links = links.unionByName(self._blocks(ws, labelled, mixed, sketches, sets))
        ws.drop("members", "sets", "involved", *(f"labelled{k}" for k in range(turn + 1)))
        return links

    @staticmethod
    def _mixed(labelled: DataFrame) -> DataFrame:
        """(key, n, across, main): members of buckets with several components, the pairs across these, the largest one."""
        per = labelled.groupBy("key", "comp").agg(F.count("*").alias("k"))
        sums = [F.sum("k").alias("n"), F.sum(F.col("k") * F.col("k")).alias("sq"), F.count("*").alias("comps"), F.max(F.struct("k", "comp"))["comp"].alias("main")]
        mixed = per.groupBy("key").agg(*sums).where("comps > 1")
        return mixed.select("key", "n", ((F.col("n") * F.col("n") - F.col("sq")) / 2).alias("across"), "main")

    @staticmethod
    def _across(labelled: DataFrame, mixed: DataFrame) -> DataFrame:
        """Distinct pairs that share a small bucket but not yet a component: one side is always outside the largest one."""
        every = labelled.join(mixed.where("not large").select("key", "main"), "key")
        x = every.where("comp <> main").select("key", F.col("id").alias("x"), F.col("comp").alias("cx"))
        y = every.select("key", F.col("id").alias("y"), F.col("comp").alias("cy"))
        return x.join(y, "key").where("cx <> cy").select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct()

    def _blocks(self, ws: Workspace, labelled: DataFrame, mixed: DataFrame, sketches: DataFrame, sets: DataFrame) -> DataFrame:
        """Links across components of the large buckets, block against block: a task emits links alone, never pairs."""
        held = labelled.join(mixed.where("large").select("key"), "key").join(sketches.select("id", F.col("n").alias("size")), "id")
        number = F.ceil(F.greatest(F.count("*") / self.block, F.sum("size") / self.block_shingles)).cast("int")
        every = labelled.join(held.groupBy("key").agg(number.alias("blocks")), "key")
        nodes = every.groupBy("id", "comp").agg(F.sort_array(F.collect_list(F.struct("key", "blocks"))).alias("at"))  # at most one key a band
        nodes = nodes.join(sketches, "id").join(sets, "id").withColumn("keys", F.col("at.key"))
        rows = nodes.select("id", "comp", "n", "registers", "members", "keys", F.inline("at"))
        own = F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int")
        rows = rows.withColumn("own", own).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).drop("blocks")
        rows = rows.withColumn("lo", F.least("own", "other")).withColumn("hi", F.greatest("own", "other"))
        found = rows.groupBy("key", "lo", "hi").applyInArrow(_block_links(self.percent), "a long, b long")
        return ws.keep(found, "block-links")

    def _confirm(self, ws: Workspace, pairs: DataFrame, sketches: DataFrame, sets: DataFrame, name: str) -> DataFrame:
        """The pairs (a, b) whose sets reach the threshold; the estimate goes first."""
        for side in "ab":
            pairs = pairs.join(sketches.select(F.col("id").alias(side), F.col("n").alias(f"n{side}"), F.col("registers").alias(f"r{side}")), side)
        pairs = ws.keep(pairs.mapInArrow(partial(_estimated, least=self.percent / 100), "a long, b long"), f"{name}-likely")
        for side in "ab":
            pairs = pairs.join(sets.select(F.col("id").alias(side), F.col("members").alias(f"s{side}")), side)
        return ws.keep(pairs.mapInArrow(partial(_confirmed, percent=self.percent), "a long, b long"), f"{name}-links")


def near_dup(docs: DataFrame, threshold_percent: int = 80) -> DataFrame:
    return NearDup(threshold_percent).run(docs)
