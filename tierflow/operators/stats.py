"""Statistics of sizes and costs: percentiles, log histogram, correlation, strata, bootstrap."""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

LEVELS = (0.01, 0.05, 0.1, 0.25, 0.5, 0.75, 0.9, 0.95, 0.99, 0.999)


def exact_percentiles(df: DataFrame, column: str, levels: tuple[float, ...] | list[float], bins: int = 4096, most: int = 4096) -> list[float | None]:
    """Interpolated percentiles of a numeric column, exact, in a few bounded passes.

    Each pass counts the rows in ``bins`` slices of the ranges in which the wanted ranks lie and keeps the slices that hold
    them, until a slice holds one value, or at most ``most`` rows, which are read. Nothing gathers the values of the column.
    """
    x = df.where(F.col(column).isNotNull()).select(F.col(column).cast("double").alias("x"))
    n, low, high = x.agg(F.count("*"), F.min("x"), F.max("x")).first()
    if not n:
        return [None] * len(levels)
    places = [(n - 1) * p for p in levels]
    wanted = sorted({int(k) for k in places} | {min(int(k) + 1, n - 1) for k in places})
    found: dict[int, float] = {}
    ranges = [(low, high, 0, wanted)]  # from, to (inclusive), rows before, ranks
    while ranges:
        slices = None
        for k, (lo, hi, _, _) in enumerate(ranges):
            width = (hi - lo) / bins
            place = F.least(F.floor((F.col("x") - lo) / width), F.lit(bins - 1)) if width > 0 else F.lit(0)
            inside = F.col("x").between(lo, hi)
            value = F.struct(F.lit(k).alias("range"), place.cast("int").alias("slice"))
            slices = F.when(inside, value) if slices is None else slices.when(inside, value)
        counted = x.select("x", slices.alias("s")).where(F.col("s").isNotNull()).groupBy("s").agg(F.count("*").alias("n"), F.min("x").alias("lo"), F.max("x").alias("hi"))
        by: dict[int, list] = {}
        for r in counted.collect():  # at most ``bins`` rows a range
            by.setdefault(r["s"]["range"], []).append((r["s"]["slice"], r["n"], r["lo"], r["hi"]))
        following, small = [], []
        for k, (_, _, before, ranks) in enumerate(ranges):
            left = list(ranks)
            for _, rows, lo, hi in sorted(by[k]):
                mine = [r for r in left if r < before + rows]
                left = left[len(mine) :]
                if mine and lo == hi:
                    found |= dict.fromkeys(mine, lo)
                elif mine:
                    (small if rows <= most else following).append((lo, hi, before, mine))
                before += rows
        if small:
            within = None
            for lo, hi, _, _ in small:
                within = F.col("x").between(lo, hi) if within is None else within | F.col("x").between(lo, hi)
            values = sorted(r["x"] for r in x.where(within).collect())
            for lo, hi, before, mine in small:
                own = [v for v in values if lo <= v <= hi]
                found |= {r: own[r - before] for r in mine}
        ranges = following
    out = []
    for k in places:
        a, b = found[int(k)], found[min(int(k) + 1, n - 1)]
        out.append(a + (b - a) * (k - int(k)))
    return out


def describe(df: DataFrame, column: str, digits: int = 3) -> DataFrame:
    """Count, extremes, mean, deviation and interpolated percentiles."""
    c = F.col(column)
    q = exact_percentiles(df, column, LEVELS)
    names = [f"p{p * 100:g}".replace(".", "_") for p in LEVELS]
    return df.agg(
        F.count(c).alias("n"),
        F.min(c).alias("min"),
        F.max(c).alias("max"),
        F.round(F.avg(c), digits).alias("mean"),
        F.round(F.stddev_samp(c), digits).alias("std"),
        *(F.round(F.lit(v).cast("double"), digits).alias(k) for k, v in zip(names, q, strict=True)),
    )


def log_histogram(df: DataFrame, column: str, bins: int = 29) -> DataFrame:
    """``bins`` bins of equal ratio between the extremes: edges, middle, count, cumulative percentage. Empty bins have 0."""
    x = df.where(F.col(column) > 0).select(F.col(column).alias("x"))
    edge = x.agg(F.min("x").alias("lo"), F.max("x").alias("hi"))
    placed = x.crossJoin(F.broadcast(edge))  # one row
    ratio = F.ln(F.col("hi") / F.col("lo")) / bins
    k = F.when(ratio > 0, F.least(F.floor(F.ln(F.col("x") / F.col("lo")) / ratio + F.lit(1e-9)), F.lit(bins - 1))).otherwise(0)
    counted = placed.groupBy(k.cast("int").alias("bin")).agg(F.count("*").alias("n"))
    every = edge.where("lo is not null").select("lo", "hi", F.explode(F.sequence(F.lit(0), F.lit(bins - 1))).alias("bin"))
    g = every.join(F.broadcast(counted), "bin", "left").withColumn("n", F.coalesce("n", F.lit(0)))  # at most ``bins`` rows
    low = F.col("lo") * F.exp(F.ln(F.col("hi") / F.col("lo")) / bins * F.col("bin"))
    high = F.col("lo") * F.exp(F.ln(F.col("hi") / F.col("lo")) / bins * (F.col("bin") + 1))
    w = Window.orderBy("bin")  # ``bins`` rows
    share = F.sum("n").over(w) / F.sum("n").over(w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)) * 100
    return g.select("bin", F.round(low, 2).alias("bin_lo"), F.round(high, 2).alias("bin_hi"), F.round((low + high) / 2, 2).alias("bin_mid"), "n", F.round(share, 4).alias("cumulative_pct"))


def per_bucket(df: DataFrame, bucket: str, *measures: str) -> DataFrame:
    aggs = []
    for m in measures:
        aggs += [F.round(F.avg(m), 4).alias(f"{m}_mean"), F.round(F.median(m), 4).alias(f"{m}_median")]
    return df.groupBy(bucket).agg(F.count("*").alias("n"), *aggs)


def per_run(df: DataFrame, run: str, value: str, over: float) -> DataFrame:
    c = F.col(value)
    return df.groupBy(run).agg(F.round(F.avg(c), 4).alias("mean"), F.round(F.median(c), 4).alias("median"), F.round(F.percentile(c, 0.9), 4).alias("p90"), F.round(F.percentile(c, 0.99), 4).alias("p99"), F.max(c).alias("max"), F.count_if(c > over).alias("runaways"))


def pearson(df: DataFrame, x: str, y: str) -> DataFrame:
    return df.agg(F.round(F.corr(x, y), 6).alias("r"))


def stratified_total(df: DataFrame, value: str, top, n: int, share: float = 0.9) -> DataFrame:
    """n * (share * mean of the low stratum + (1 - share) * mean of the top stratum); ``top`` is a condition."""
    low, high = F.avg(F.when(~top, F.col(value))), F.avg(F.when(top, F.col(value)))
    return df.agg(F.round(low, 6).alias("mean_low"), F.round(high, 6).alias("mean_top"), F.round(n * (share * low + (1 - share) * high), 4).alias("total"))


def projection(df: DataFrame, value: str, n: int, batch: float = 0.5) -> DataFrame:
    """The corpus total by mean and by median, and at the price of a batch."""
    (median,) = exact_percentiles(df, value, [0.5])
    mean = F.avg(value)
    return df.agg(F.round(mean * n, 4).alias("by_mean"), F.round(F.lit(median).cast("double") * n, 4).alias("by_median"), F.round(mean * n * batch, 4).alias("batch"))


PRIME = 2**31 - 1
#: Poisson weights with mean 1 for a draw u below PRIME: the number of these edges that u reaches.
POISSON = tuple(math.ceil(sum(math.exp(-1) / math.factorial(j) for j in range(k + 1)) * PRIME) for k in range(9))


def _weighted(iterations: int):
    """Partial sums of weights and weighted values, low and top stratum, for each iteration of one task."""

    def run(batches):
        sums = np.zeros((4, iterations))
        turn, edges = np.arange(iterations, dtype=np.int64), np.array(POISSON)
        for batch in batches:
            a, b, x, top = (batch.column(k).to_numpy(zero_copy_only=False) for k in ("a", "b", "x", "top"))
            for i in range(0, len(a), 256):
                draw = (a[i : i + 256, None] * turn + b[i : i + 256, None]) % PRIME
                w = np.searchsorted(edges, draw.ravel(), "right").reshape(draw.shape).astype(float)
                for k, mine in ((0, ~top[i : i + 256]), (2, top[i : i + 256])):
                    sums[k] += w[mine].sum(axis=0)
                    sums[k + 1] += (w[mine] * x[i : i + 256][mine, None]).sum(axis=0)
        yield pa.RecordBatch.from_arrays([pa.array(turn), *map(pa.array, sums)], ["iteration", "n_low", "s_low", "n_top", "s_top"])

    return run


def bootstrap(df: DataFrame, key: str, value: str, iterations: int = 2000, seed: int = 0, low: float = 0.1, high: float = 0.9, top: Column | None = None, total: int = 1, share: float = 0.9) -> DataFrame:
    """Interval of the stratified total by a Poisson bootstrap; without ``top`` (a condition) of ``total`` times the mean.

    A row weighs in iteration k by the Poisson quantile of (a * k + b) mod 2^31 - 1, with a and b from a hash of key and
    seed. Each task keeps four vectors of ``iterations`` sums; that is all that is shuffled. An iteration that draws nothing
    from a stratum counts that stratum as 0.
    """
    digest = F.sha2(F.concat_ws("/", F.col(key).cast("string"), F.lit(str(seed))), 256)
    part = lambda at: F.conv(F.substring(digest, at, 8), 16, 10).cast("long") % PRIME
    rows = df.where(F.col(value).isNotNull()).select(part(1).alias("a"), part(9).alias("b"), F.col(value).cast("double").alias("x"), (F.lit(False) if top is None else F.coalesce(top, F.lit(False))).alias("top"))
    sums = rows.mapInArrow(_weighted(iterations), "iteration long, n_low double, s_low double, n_top double, s_top double").groupBy("iteration").agg(*(F.sum(c).alias(c) for c in ("n_low", "s_low", "n_top", "s_top")))
    mean = lambda k: F.coalesce(F.col(f"s_{k}") / F.nullif(F.col(f"n_{k}"), F.lit(0.0)), F.lit(0.0))
    if top is None:
        drawn = sums.where("n_low > 0").select((total * mean("low")).alias("t"))
    else:
        drawn = sums.select((total * (share * mean("low") + (1 - share) * mean("top"))).alias("t"))
    # At most ``iterations`` values.
    return drawn.agg(F.round(F.percentile("t", low), 4).alias("low"), F.round(F.percentile("t", high), 4).alias("high"), F.count("*").alias("iterations"))


def compare_runs(a: DataFrame, b: DataFrame, key: str, tokens: str, cost: str) -> DataFrame:
    """Two runs matched by key with their differences."""
    a = a.select(key, F.col(tokens).alias("n_a"), F.col(cost).alias("cost_a"))
    b = b.select(key, F.col(tokens).alias("n_b"), F.col(cost).alias("cost_b"))
    return a.join(b, key).select(key, "n_a", "n_b", (F.col("n_b") - F.col("n_a")).alias("delta"), F.round(F.col("cost_a") - F.col("cost_b"), 4).alias("cost_savings"))


def agreement(a: DataFrame, b: DataFrame, key: str, value: str) -> DataFrame:
    both = a.select(key, F.col(value).alias("a")).join(b.select(key, F.col(value).alias("b")), key)
    return both.agg(F.count_if(F.col("a").eqNullSafe(F.col("b"))).alias("same"), F.count("*").alias("n"))
