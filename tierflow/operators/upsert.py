"""Idempotent upserts and state transitions as pure functions from tables to tables."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from tierflow import schemas


def last_write(source: DataFrame, key: tuple[str, ...], order: str) -> DataFrame:
    """The last row of each key, as a sequence of single upserts leaves it. Pre-aggregates; no group meets in one task.

    A null ``order`` comes before every other; rows of equal order are compared column by column, nulls first.
    """
    rest = [c for c in source.columns if c not in key and c != order]
    best = source.groupBy(*key).agg(F.max(F.struct(F.col(order), *rest)).alias("_row"))
    return best.select(*key, *(F.col(f"_row.{c}").alias(c) for c in (order, *rest)))


def upsert(target: DataFrame, source: DataFrame, key: tuple[str, ...], updated: tuple[str, ...], order: str | None = None) -> DataFrame:
    """``target`` after ``source``: new keys are inserted whole; known ones take the ``updated`` columns (null too) and
    keep the others."""
    if order:
        source = last_write(source, key, order).drop(order)
    t = target.select(*(F.col(c).alias(f"t_{c}") for c in target.columns), F.lit(True).alias("_t"))
    s = source.select(*(F.col(c).alias(f"s_{c}") for c in source.columns), F.lit(True).alias("_s"))
    same = [F.col(f"t_{k}") == F.col(f"s_{k}") for k in key]
    out = []
    for c in target.columns:
        new = F.col(f"s_{c}") if c in source.columns else F.lit(None)
        if c in updated and c in source.columns:
            value = F.when(F.col("_s"), new).otherwise(F.col(f"t_{c}"))
        else:
            value = F.when(F.col("_t"), F.col(f"t_{c}")).otherwise(new)
        out.append(value.cast(target.schema[c].dataType).alias(c))
    return t.join(s, same, "full_outer").select(*out)


def upsert_table(name: str, target: DataFrame, source: DataFrame, order: str | None = None) -> DataFrame:
    key, updated = schemas.UPSERTS[name]
    return upsert(target, source, key, updated, order)


def on(**values: Column) -> tuple[Column, Column]:
    """(condition, value) of what the named actions set."""
    value = None
    for action, v in values.items():
        value = F.when(F.col("action") == action, v) if value is None else value.when(F.col("action") == action, v)
    return F.col("action").isin(*values), value


def apply_events(table: DataFrame, events: DataFrame, sets: dict[str, tuple[Column, Column]], adds: dict[str, str] | None = None, create: tuple[str, dict[str, Column]] | None = None) -> DataFrame:
    """``table`` after ``events`` (id, action, ts and what the actions carry), in the order of ts.

    ``sets``: for each column which events set it, and to what: the last of these events counts.
    ``adds``: for each counter the action that adds one. ``create``: the action that makes a row where there is none, and
    the columns of a new row; events of an id without row and without that action change nothing.

    Defined cases: an event that comes twice counts once; of events of one time the larger (action, value) is the later
    one; a null ts is before every other. One aggregate of the events and one join, whatever the number of events an id has.
    """
    types = {f.name: f.dataType for f in table.schema.fields}
    e = events.distinct()
    aggs = []
    for column, (which, value) in sets.items():
        seen = F.when(which, F.struct("ts", "action", value.cast(types[column]).alias("v")))
        aggs.append(F.max(seen).alias(f"_s_{column}"))
    for column, action in (adds or {}).items():
        aggs.append(F.count_if(F.col("action") == action).alias(f"_a_{column}"))
    if create:
        action, row = create
        aggs += [F.min(F.when(F.col("action") == action, v.cast(types[c]))).alias(f"_c_{c}") for c, v in row.items()]
        aggs.append(F.count_if(F.col("action") == action).alias("_made"))
    e = e.groupBy("id").agg(*aggs).withColumnRenamed("id", "_id")
    t = table.withColumn("_there", F.lit(True))
    joined = t.join(e, t["id"] == e["_id"], "full_outer" if create else "left")
    if create:
        joined = joined.where(F.col("_there") | (F.col("_made") > 0))
    new = {}
    for c in table.columns:
        value = F.col(c)
        if create and c in create[1]:
            value = F.when(F.col("_there"), value).otherwise(F.col(f"_c_{c}"))
        if c == "id":
            value = F.coalesce("id", "_id")
        if c in sets:
            value = F.when(F.col(f"_s_{c}").isNotNull(), F.col(f"_s_{c}.v")).otherwise(value)
        if c in (adds or {}):
            value = (value + F.coalesce(F.col(f"_a_{c}"), F.lit(0))).cast(types[c])
        new[c] = value.alias(c)
    return joined.select(*(new[c] for c in table.columns))


def transition(table: DataFrame, events: DataFrame, status: str = "status", retry: str = "retry_count", message: str = "error_message", at: str = "last_processed_at", silent: tuple[str, ...] = (), scraped: str | None = None) -> DataFrame:
    """Applies events (id, to, message, ts): ERROR adds a retry and keeps the message; all but ``silent`` ones stamp the time.

    ``scraped`` names a counter that DONE sets from the events' column of the same name. See ``apply_events`` for
    events that come twice or together.
    """
    known, done = F.col("action").isNotNull(), F.col("action") == "DONE"
    sets = {status: (known, F.col("action")), message: on(ERROR=F.col("message")), at: (known & ~F.col("action").isin(*silent), F.col("ts"))}
    if scraped:
        sets[scraped] = (done, F.col(scraped))
    return apply_events(table, events.withColumnRenamed("to", "action"), sets, {retry: "ERROR"})


def district_events(districts: DataFrame, events: DataFrame) -> DataFrame:
    """IN_PROGRESS, DONE and ERROR of districts; the claim leaves the time."""
    return transition(districts, events, silent=("IN_PROGRESS",))


def body_events(bodies: DataFrame, events: DataFrame) -> DataFrame:
    """IN_PROGRESS, DONE (with scraped_projects) and ERROR of bodies; the claim leaves the time."""
    return transition(bodies, events, at="last_scraped_at", silent=("IN_PROGRESS",), scraped="scraped_projects")


def project_events(projects: DataFrame, events: DataFrame) -> DataFrame:
    """DOWNLOADING, DOWNLOADED, MISSING and ERROR of projects; all stamp the time."""
    return transition(projects, events, "pdf_status", "pdf_retry_count", "pdf_error_message", "pdf_last_attempt_at")


def run_events(runs: DataFrame, events: DataFrame) -> DataFrame:
    """Life of runs: events (id, action, phase, message, ts) of create, start, complete, fail and phase."""
    sets = {
        "status": on(create=F.lit("PENDING"), start=F.lit("RUNNING"), complete=F.lit("COMPLETED"), fail=F.lit("FAILED")),
        "started_at": on(start=F.col("ts")),
        "completed_at": on(complete=F.col("ts"), fail=F.col("ts")),
        "error_message": on(fail=F.col("message")),
        "current_phase": on(phase=F.col("phase")),
    }
    known = runs.select("id", F.lit(True).alias("_known"))
    events = events.join(known, "id", "left").where(~((F.col("action") == "create") & F.col("_known").isNotNull())).drop("_known")  # a run is made once
    return apply_events(runs, events, sets, create=("create", {"current_phase": F.lit(1), "status": F.lit("PENDING"), "created_at": F.col("ts")}))


def pdf_events(pdfs: DataFrame, events: DataFrame) -> DataFrame:
    """Life of documents: events (id, action, ts, ...) of insert, uploaded and failed.

    insert makes a waiting row (project_id, original_url, original_filename, redirect_url); uploaded sets bucket, path, size,
    hash and time; failed keeps these and sets the error (message).
    """
    uploaded = ("gcs_bucket", "gcs_path", "file_size_bytes", "content_hash")
    sets = {
        "status": on(uploaded=F.lit("UPLOADED"), failed=F.lit("FAILED")),
        "upload_error": on(failed=F.col("message")),
        "uploaded_at": on(uploaded=F.col("ts")),
        **{c: on(uploaded=F.col(c)) for c in uploaded},
    }
    inserted = {c: F.col(c) for c in ("project_id", "original_url", "original_filename", "redirect_url")}
    return apply_events(pdfs, events, sets, create=("insert", inserted | {"status": F.lit("PENDING")}))


def set_progress(bodies: DataFrame, progress: DataFrame) -> DataFrame:
    """Applies (id, page, scraped[, pages, ts]): counters and time move, the status stays. Of several rows of a body the
    largest (ts, page, scraped) counts; a null ``pages`` leaves the number of pages."""
    moved = {"last_page_scraped": "page", "scraped_projects": "scraped", "total_pages": "pages", "last_scraped_at": "ts"}
    moved = {c: v for c, v in moved.items() if v in progress.columns}
    order = [c for c in ("ts", "page", "scraped", "pages") if c in progress.columns]
    p = progress.groupBy(F.col("id").alias("_id")).agg(F.max(F.struct(*order)).alias("_p"))
    new = {c: F.coalesce(F.col(f"_p.{v}"), F.col(c)).alias(c) for c, v in moved.items()}
    return bodies.join(p, bodies["id"] == p["_id"], "left").select(*(new.get(c, F.col(c)) for c in bodies.columns))


def mark_children(projects: DataFrame, parents: DataFrame, of: tuple[str, ...], to: str) -> tuple[DataFrame, DataFrame]:
    """(projects with the children of ``parents`` (id) in a status of ``of`` marked, one row with how many)."""
    p = parents.select(F.col("id").alias("local_body_id")).distinct().withColumn("_hit", F.lit(True))
    hit = F.col("_hit") & F.col("pdf_status").isin(*of)
    joined = projects.join(p, "local_body_id", "left")
    marked = joined.withColumn("pdf_status", F.when(hit, to).otherwise(F.col("pdf_status"))).select(*projects.columns)
    return marked, joined.agg(F.count_if(hit).alias("marked"))


def stuck(as_of: Column, minutes: int | None) -> Column:
    """Under way for longer than ``minutes``, or without a time; None: all under way."""
    under_way = F.col("pdf_status") == "DOWNLOADING"
    if minutes is None:
        return under_way
    return under_way & (F.col("pdf_last_attempt_at").isNull() | (F.col("pdf_last_attempt_at") < as_of - F.make_dt_interval(mins=F.lit(minutes))))


def reset_stuck(projects: DataFrame, as_of: Column, minutes: int | None = 60) -> DataFrame:
    """Stuck rows wait again; their time and retries stay."""
    return projects.withColumn("pdf_status", F.when(stuck(as_of, minutes), "PENDING").otherwise(F.col("pdf_status")))


def count_stuck(projects: DataFrame, as_of: Column, minutes: int | None = 60) -> DataFrame:
    """What a reset would change: the dry run."""
    return projects.agg(F.count_if(stuck(as_of, minutes)).alias("stuck"))


def circuit_breaker(attempts: DataFrame, parent: str = "local_body_id", order: tuple[str, ...] = ("page_number", "project_no"), status: str = "pdf_status", run: int = 5) -> DataFrame:
    """The attempts of each parent up to the end of its first ``run`` errors in a row.

    The length of the errors up to a row is its number less that of the last row that is no error; all windows share one
    shuffle and one sort.
    """
    w = Window.partitionBy(parent).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    number = F.row_number().over(Window.partitionBy(parent).orderBy(*order))
    df = attempts.withColumn("_n", number)
    df = df.withColumn("_run", F.col("_n") - F.coalesce(F.max(F.when(F.coalesce(F.col(status) != "ERROR", F.lit(True)), F.col("_n"))).over(w), F.lit(0)))
    broke = F.max(F.col("_run")).over(w.rowsBetween(Window.unboundedPreceding, -1))
    return df.withColumn("_most", broke).where(F.coalesce(F.col("_most"), F.lit(0)) < run).drop("_n", "_run", "_most")


class Conflict(RuntimeError):
    """Another writer has committed since the version that a change was based on."""


def _versions(spark: SparkSession, path: str):
    hadoop = spark._jvm.org.apache.hadoop.fs
    at = hadoop.Path(f"{path}/versions")
    fs = at.getFileSystem(spark._jsc.hadoopConfiguration())
    return [s.getPath().getName() for s in fs.listStatus(at)] if fs.exists(at) else []


def version(spark: SparkSession, path: str) -> int:
    """The number of the newest committed snapshot; 0 before the first."""
    return max((int(n) for n in _versions(spark, path) if n.isdigit()), default=0)


def swap(spark: SparkSession, df: DataFrame, path: str, base: int | None = None) -> str:
    """Writes a snapshot beside the others and commits it as the next version; returns its path.

    A commit is the rename of a pointer to a name that must not exist: readers see the old version or the new one, whole, a
    crash leaves the old one, and of two writers of one version one fails. ``base``: the version that the change was made
    from; if another has been committed since, nothing changes and ``Conflict`` is raised. None: the last writer wins.
    """
    at = f"{path}/v-{uuid.uuid4().hex}"
    df.write.parquet(at)
    hadoop, gateway = spark._jvm.org.apache.hadoop.fs, spark.sparkContext._gateway
    files = hadoop.FileContext.getFileContext(hadoop.Path(path).toUri(), spark._jsc.hadoopConfiguration())
    plain = gateway.new_array(hadoop.Options.Rename, 0)
    tmp = hadoop.Path(f"{path}/versions/.{uuid.uuid4().hex}")
    fs = hadoop.Path(path).getFileSystem(spark._jsc.hadoopConfiguration())
    out = fs.create(tmp, True)
    out.write(bytearray(at.encode()))
    out.close()
    while True:
        number = (version(spark, path) if base is None else base) + 1
        try:
            files.rename(files.makeQualified(tmp), files.makeQualified(hadoop.Path(f"{path}/versions/{number:020d}")), plain)
            return at
        except Exception as e:
            if "FileAlreadyExists" not in str(e):
                raise
            if base is not None:
                fs.delete(tmp, False)
                raise Conflict(f"{path}: version {number} is there already") from e


def current(spark: SparkSession, path: str, number: int | None = None) -> DataFrame:
    """The newest snapshot, or that of a version."""
    number = version(spark, path) if number is None else number
    at = spark.read.text(f"{path}/versions/{number:020d}", wholetext=True).first()[0]
    return spark.read.parquet(at)
