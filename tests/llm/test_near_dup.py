import random
import re
from collections import defaultdict

import numpy as np
import pytest

from tierflow.llm import near_dup as nd

LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def brute(rows, percent):
    sets = {}
    for i, t in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", (t or "").translate(LOWER))
        sets[i] = {tuple(w[k : k + 5]) for k in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set()
    parent = {i: i for i in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in sets:
        for j in sets:
            if i < j and sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= percent * len(sets[i] | sets[j]):
                a, b = find(i), find(j)
                parent[max(a, b)] = min(a, b)
    return {i: (len(sets[i]), find(i)) for i in sets}


@pytest.mark.parametrize("percent", [80, 85])
def test_against_all_pairs(documents, by_id, percent):
    want = brute(by_id.items(), percent)
    got = nd.near_dup(documents, percent).collect()
    assert len(got) == len(by_id) + 1
    for r in got:
        assert (r.n_shingles, r.component_id) == want[r.doc_id]
        assert r.kept == (r.doc_id == r.component_id)


def test_large_group_of_copies_below_the_threshold(spark):
    """Copies that resemble each other without linking: the blocks find the links there are."""
    rng = random.Random(1)
    base = [f"w{k}" for k in range(90)]
    rows = []
    for i in range(160):
        t = list(base)
        for _ in range(rng.choice([1, 2, 3])):
            t[rng.randrange(90)] = f"z{rng.randrange(10**6)}"
        rows.append((i, " ".join(t)))
    op = nd.NearDup(85, turns=1, linear=0, block=16)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in op.run(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == brute(rows, 85)


def family(n, seed=1):
    rng = random.Random(seed)
    base, rows = [f"w{k}" for k in range(90)], []
    for i in range(n):
        t = list(base)
        for _ in range(rng.choice([1, 2, 3])):
            t[rng.randrange(90)] = f"z{rng.randrange(10**6)}"
        rows.append((i, " ".join(t)))
    return rows


@pytest.mark.parametrize("linear, turns, shingles", [(0, 1, 200), (0, 2, 1 << 20), (10**9, 1, 1 << 20), (10**9, 3, 1 << 20)])
def test_both_routes_find_the_same(spark, linear, turns, shingles):
    rows = family(120, 3) + [(1000 + i, t + " tail") for i, t in family(40, 4)]
    op = nd.NearDup(85, turns=turns, linear=linear, block=16, block_shingles=shingles)
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in op.run(spark.createDataFrame(rows, "doc_id long, text string")).collect()} == brute(rows, 85)


def test_a_large_component_and_a_stranger(spark):
    """20,000 members of one component and a stranger in a bucket give 20,000 pairs, not their square."""
    labelled = spark.range(20_000).selectExpr("1L as key", "id", "0L as comp").unionAll(spark.sql("select 1L, 99999L, 99999L"))
    mixed = nd.NearDup._mixed(labelled)
    r = mixed.first()
    assert (r.n, r.across, r.main) == (20_001, 20_000, 0)
    pairs = nd.NearDup._across(labelled, mixed.selectExpr("*", "false as large"))
    assert pairs.where("b = 99999").count() == pairs.count() == 20_000
    made = {p: sum(1 for i in range(60) for j in range(i) if i % p != j % p) for p in (2, 3, 7)}
    for p, want in made.items():
        some = spark.range(60).selectExpr("1L as key", "id", f"id % {p} as comp")
        assert nd.NearDup._across(some, nd.NearDup._mixed(some).selectExpr("*", "false as large")).count() == want


@pytest.mark.parametrize("percent", [80, 85])
def test_recall_of_the_bands(percent):
    """Planted pairs at the threshold: at least 0.999 share a band and pass the estimate."""
    rng, rows, found, n = np.random.default_rng(percent), nd.band_rows(percent), 0, 3000
    assert (1 - (percent / 100) ** rows) ** (nd.BUCKETS // rows) <= nd.MISS
    for _ in range(n):
        union = int(rng.integers(60, 1500))
        both = -(-percent * union // 100)
        own = int(rng.integers(0, union - both + 1))
        h = rng.integers(0, 2**63, union, dtype=np.uint64) * 2
        x, y = np.sort(h[: both + own]), np.sort(np.concatenate((h[:both], h[both + own :])))
        r, q = nd.registers_of(x), nd.registers_of(y)
        shared = (nd.bands_of(r, rows) == nd.bands_of(q, rows)).any()
        found += bool(shared and nd.likely(r[None], q[None], np.array([float(len(x))]), np.array([float(len(y))]), percent / 100)[0])
    assert found >= 0.999 * n


def test_nulls_and_empty_tables(spark, empty):
    assert nd.near_dup(empty).count() == 0
    rows = [(None, "a b c d e f"), (None, None), (7, "a b c d e f"), (3, None)]
    got = {(r.doc_id, r.n_shingles): (r.component_id, r.kept) for r in nd.near_dup(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {(None, 2): (7, False), (None, 0): (None, True), (7, 2): (7, True), (3, 0): (3, True)}


def test_estimate_is_near_the_truth():
    rng = np.random.default_rng(3)
    for size in (60, 2000):
        both = rng.integers(0, 2**63, size, dtype=np.uint64)
        x, y = (np.unique(np.concatenate((both, rng.integers(0, 2**63, size // 10, dtype=np.uint64)))) for _ in range(2))
        true = len(np.intersect1d(x, y)) / len(np.union1d(x, y))
        x, y = nd.mix(x), nd.mix(y)
        x.sort(), y.sort()
        got = nd.estimate(nd.registers_of(x)[None], nd.registers_of(y)[None], np.array([float(len(x))]), np.array([float(len(y))]))[0]
        assert abs(got - true) < 0.12


def test_components(spark):
    from tierflow.llm.base import Workspace
    from tierflow.llm.components import components

    edges = [(i, i + 1) for i in range(1, 60)] + [(100, 200), (200, 300), (5, 5)]
    got = {r.id: r.comp for r in components(Workspace(spark, "t"), spark.createDataFrame(edges, "u long, v long"), "cc").collect()}
    want = defaultdict(int, {i: 1 for i in range(1, 61)} | {100: 100, 200: 100, 300: 100})
    assert got == want
