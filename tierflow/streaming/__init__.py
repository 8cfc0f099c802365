"""Incremental processing: the same operators over streams, with checkpoints, idempotent writes and timers."""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from tierflow.operators.upsert import Conflict, current, last_write, swap, upsert, version


def read(spark: SparkSession, path: str, schema, files_per_batch: int | None = None) -> DataFrame:
    """A stream of Parquet files; ``files_per_batch`` is the back-pressure."""
    reader = spark.readStream.schema(schema)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(path)


def upsert_stream(stream: DataFrame, path: str, checkpoint: str, key: tuple[str, ...], updated: tuple[str, ...], order: str, every: str | None = None) -> StreamingQuery:
    """Applies each micro-batch to the table at ``path`` (see ``swap``). A batch that comes twice changes nothing: keys are
    natural, the last write of a key wins. A batch is based on the version it read: if another writer has committed since,
    it is applied anew to what that one left. ``every``: a processing-time trigger; None takes what is there and ends."""
    spark = stream.sparkSession

    def apply(batch: DataFrame, number: int) -> None:
        batch = last_write(batch, key, order).drop(order)
        while True:
            base = version(spark, path)
            try:
                swap(spark, upsert(current(spark, path, base), batch, key, updated), path, base)
                return
            except Conflict:
                continue

    writer = stream.writeStream.foreachBatch(apply).option("checkpointLocation", checkpoint)
    return (writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)).start()


BUCKET = "_bucket"


def bucketed(df: DataFrame, key: tuple[str, ...], buckets: int) -> DataFrame:
    return df.withColumn(BUCKET, F.pmod(F.xxhash64(*key), F.lit(buckets)).cast("int"))


def write_buckets(df: DataFrame, path: str, key: tuple[str, ...], buckets: int) -> None:
    """A table in ``buckets`` folders by key, for ``upsert_buckets``."""
    bucketed(df, key, buckets).repartition(BUCKET).write.partitionBy(BUCKET).parquet(path)


def upsert_buckets(batch: DataFrame, path: str, key: tuple[str, ...], updated: tuple[str, ...], order: str, buckets: int) -> int:
    """Applies a batch to a table of ``write_buckets`` and rewrites the buckets it touches, no others; returns their number.

    Folders are replaced one by one as the write commits: unlike ``swap`` this is for one writer and readers between writes.
    """
    spark = batch.sparkSession
    source = bucketed(last_write(batch, key, order).drop(order), key, buckets)
    touched = [r[0] for r in source.select(BUCKET).distinct().collect()]  # at most ``buckets`` numbers
    if touched:
        table = spark.read.parquet(path).where(F.col(BUCKET).isin(touched))
        new = upsert(table.drop(BUCKET), source.drop(BUCKET), key, updated)
        staged = f"{path.rstrip('/')}-staged"
        new.write.mode("overwrite").parquet(staged)  # the buckets read are those written
        out = bucketed(spark.read.parquet(staged), key, buckets).repartition(BUCKET)
        out.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(BUCKET).parquet(path)
    return len(touched)


def wait_for_space(size: Callable[[], int], most: int = 1000, every: float = 5.0, timeout: float | None = None, sleep: Callable[[float], None] = time.sleep, clock: Callable[[], float] = time.monotonic) -> bool:
    """Waits until ``size`` is below ``most``; false if ``timeout`` seconds pass before."""
    began = clock()
    while size() >= most:
        if timeout is not None and clock() - began >= timeout:
            return False
        sleep(every)
    return True


def backlog(query: StreamingQuery) -> dict[str, int]:
    """Rows that each source of a running query had in its last batch, by source: the gauge that back-pressure reads."""
    last = query.lastProgress
    return {s["description"]: int(s["numInputRows"]) for s in last["sources"]} if last else {}


def windowed_counts(events: DataFrame, ts: str, by: str, width: str, late: str) -> DataFrame:
    """Counts of event-time windows; rows later than ``late`` behind the newest are dropped by the watermark."""
    df = events.withColumn(ts, F.col(ts).cast("timestamp")).withWatermark(ts, late)
    return df.groupBy(F.window(ts, width).alias("w"), by).agg(F.count("*").alias("n")).select(F.col("w.start").alias("start"), by, "n")


def first_of_key(events: DataFrame, key: str, ts: str, late: str) -> DataFrame:
    """The first event of each key within the watermark."""
    return events.withColumn(ts, F.col(ts).cast("timestamp")).withWatermark(ts, late).dropDuplicatesWithinWatermark([key])


def stuck_stream(events: DataFrame, minutes: int, late: str = "0 seconds") -> DataFrame:
    """Rows (id, ts, status) in; (id, since) out for an id that stays DOWNLOADING for ``minutes`` of event time."""

    def watch(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            (since,) = state.get
            state.remove()
            yield pd.DataFrame({"id": [key[0]], "since": [pd.Timestamp(since, unit="ms", tz="UTC")]})
            return
        rows = pd.concat(list(batches)).sort_values("ts")
        last = rows.iloc[-1]
        if last["status"] == "DOWNLOADING":
            at = int(last["ts"].timestamp() * 1000)
            state.update((at,))
            state.setTimeoutTimestamp(max(at + minutes * 60_000, state.getCurrentWatermarkMs() + 1))
        elif state.exists:
            state.remove()

    df = events.withColumn("ts", F.col("ts").cast("timestamp")).withWatermark("ts", late)
    return df.groupBy("id").applyInPandasWithState(watch, "id string, since timestamp", "since long", "append", GroupStateTimeout.EventTimeTimeout)


def drain(status: Callable[[], dict[str, int]], work: Callable[[int], int], batch: int = 100, most: int = 10_000) -> int:
    """Runs batches until nothing waits and nothing is under way, or a batch finds nothing while nothing is under way.

    ``status`` gives pending, errors and in_progress; ``work`` takes a batch size and returns how many it took. Returns the
    number of batches.
    """
    for k in range(most):
        s = status()
        if s["pending"] + s.get("errors", 0) == 0 and s["in_progress"] == 0:
            return k
        if work(batch) == 0 and s["in_progress"] == 0:
            return k
    raise RuntimeError(f"not drained after {most} batches")
