"""Status reports over the model: counts, completeness, trailing windows, errors.

Each report is one scan of its largest table with all of its counters in one aggregate; small levels join by the size that
the planner sees. ``as_of`` is a parameter of every trailing window.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from tierflow.model import Model
from tierflow.plans import bodies_with_district, chain, counts, preagg_left_join, ratio

FOUR = {"done": "DONE", "in_progress": "IN_PROGRESS", "pending": "PENDING"}


def count_by(df: DataFrame, column: str) -> DataFrame:
    return df.groupBy(F.col(column).alias("status")).agg(F.count("*").alias("n"))


def table_counts(model: Model) -> DataFrame:
    each = [df.agg(F.count("*").alias("n")).select(F.lit(name).alias("table_name"), "n") for name, df in model.tables().items()]
    out = each[0]
    for df in each[1:]:
        out = out.unionByName(df)
    return out


def districts_by_year(model: Model) -> DataFrame:
    return model.districts.groupBy("year_label").agg(F.count("*").alias("total"), *counts("status", {"done": "DONE"}))


def bodies_by_year(model: Model) -> DataFrame:
    return bodies_with_district(model).groupBy(F.col("d_year_label").alias("year_label")).agg(F.count("*").alias("total"), *counts("lb_status", FOUR))


def districts_by_year_district(model: Model) -> DataFrame:
    return model.districts.groupBy("year_label", "district_name").agg(F.count("*").alias("total"), *counts("status", FOUR))


def bodies_by_year_district(model: Model) -> DataFrame:
    by = [F.col("d_year_label").alias("year_label"), F.col("d_district_name").alias("district_name")]
    return bodies_with_district(model).groupBy(*by).agg(F.count("*").alias("total"), *counts("lb_status", FOUR))


PDF_COUNTERS = {"downloaded": "DOWNLOADED", "missing": "MISSING", "pending": "PENDING", "errors": "ERROR"}


def pdfs_by_year(model: Model) -> DataFrame:
    return chain(model).groupBy(F.col("d_year_label").alias("year_label")).agg(F.count("*").alias("total"), *counts("p_pdf_status", PDF_COUNTERS))


def pdfs_by_year_district(model: Model) -> DataFrame:
    by = [F.col("d_year_label").alias("year_label"), F.col("d_district_name").alias("district_name")]
    return chain(model).groupBy(*by).agg(F.count("*").alias("total"), *counts("p_pdf_status", PDF_COUNTERS))


def year_rollup(model: Model) -> DataFrame:
    """Bodies done by district, year and in all, with percentages: subtotals by rollup, in one pass."""
    return progress_detail(model, 3).select("year_label", "district_name", "total", "done", "in_progress", "pct", "level")


def progress_detail(model: Model, phase: int) -> DataFrame:
    """Phase 2 (districts), 3 (bodies) or 4 (projects) by year and district: total, done, in_progress, percentage.

    ``level`` is 0 for a district of a year, 1 for a year, 3 for all. A project is done once its document is there or missing.
    """
    if phase == 2:
        df, status, words = model.districts, "status", FOUR
        by = [F.col("year_label"), F.col("district_name")]
    else:
        df, status = (bodies_with_district(model), "lb_status") if phase == 3 else (chain(model), "p_pdf_status")
        words = FOUR if phase == 3 else {"done": ("DOWNLOADED", "MISSING"), "in_progress": "DOWNLOADING", "pending": "PENDING"}
        by = [F.col("d_year_label").alias("year_label"), F.col("d_district_name").alias("district_name")]
    df = df.rollup(*by).agg(F.count("*").alias("total"), *counts(status, words), F.grouping_id().cast("int").alias("level"))
    return df.withColumn("pct", ratio(F.col("done"), F.col("total"))).select("year_label", "district_name", "total", "done", "in_progress", "pending", "pct", "level")


def nested(df: DataFrame, outer: str, inner: str, value: str) -> DataFrame:
    """One row per ``outer`` with a map from ``inner`` to ``value``: the nested view of a flat report."""
    return df.groupBy(outer).agg(F.map_from_entries(F.sort_array(F.collect_list(F.struct(inner, value)))).alias(value))


def by_name(model: Model, key: str) -> DataFrame:
    """Status counters, expected projects and projects found, by one column of the districts.

    ``key``: district_name, year_label or lb_type_label. The count of projects is aggregated before its join.
    """
    d = model.districts.groupBy(key).agg(F.count("*").alias("total"), *counts("status", {"done": "DONE", "pending": "PENDING", "errors": "ERROR"}), F.sum(F.coalesce("num_local_bodies", F.lit(0))).alias("local_bodies"), F.sum("num_projects").alias("expected"))
    found = chain(model, f"d_{key}").select(F.col(f"d_{key}").alias(key))
    return preagg_left_join(d, found, key, "projects")


def body_progress(model: Model) -> DataFrame:
    """Expected against scraped projects over all bodies, with averages of what is left."""
    lb = model.bodies
    left = F.col("expected_projects") - F.col("scraped_projects")
    return lb.agg(F.coalesce(F.sum("expected_projects"), F.lit(0)).alias("expected"), F.coalesce(F.sum("scraped_projects"), F.lit(0)).alias("scraped"), F.count_if(left > 0).alias("behind"), F.max(left).alias("most_behind"), F.round(F.avg(left), 4).alias("mean_behind"))


def upload_summary(model: Model) -> DataFrame:
    """Documents, bytes and mean size of each upload status."""
    return model.pdfs.groupBy("status").agg(F.count("*").alias("n"), F.coalesce(F.sum("file_size_bytes"), F.lit(0)).alias("bytes"), F.round(F.avg("file_size_bytes"), 2).alias("mean_bytes"), F.count_distinct("content_hash").alias("contents"))


def pending_bodies_with_pdfs(model: Model, cap: int = 3) -> DataFrame:
    """Bodies that have projects waiting for a document, with their number."""
    wait = model.projects.where(F.col("pdf_status").isin("PENDING", "DOWNLOADING", "ERROR") & (F.col("pdf_retry_count") < cap))
    return wait.groupBy("local_body_id").agg(F.count("*").alias("waiting"))


def _since(column: str, as_of: Column, minutes: int, inclusive: bool) -> Column:
    edge = as_of - F.make_dt_interval(mins=F.lit(minutes))
    return F.col(column) >= edge if inclusive else F.col(column) > edge


def fail_rates(model: Model, as_of: Column, minutes: tuple[int, ...] = (5, 10, 15)) -> DataFrame:
    """Failed and attempted projects of each trailing window (its edge included), in one scan."""
    aggs = []
    for m in minutes:
        inside = _since("pdf_last_attempt_at", as_of, m, True)
        aggs += [F.count_if(inside & F.col("pdf_status").isin("MISSING", "ERROR")).alias(f"failed_{m}"), F.count_if(inside & F.col("pdf_status").isin("DOWNLOADED", "MISSING", "ERROR")).alias(f"attempted_{m}")]
    out = model.projects.agg(*aggs)
    for m in minutes:
        out = out.withColumn(f"rate_{m}", ratio(F.col(f"failed_{m}"), F.col(f"attempted_{m}"), 2))
    return out


def upload_rates(model: Model, as_of: Column, minutes: tuple[int, ...] = (5, 10, 15, 30, 60)) -> DataFrame:
    """Uploads of each trailing window (its edge excluded) with the bytes of the longest, in one scan."""
    up = model.pdfs.where(F.col("status") == "UPLOADED")
    aggs = [F.count_if(_since("uploaded_at", as_of, m, False)).alias(f"uploads_{m}") for m in minutes]
    last = _since("uploaded_at", as_of, max(minutes), False)
    return up.agg(F.count("*").alias("uploaded"), F.coalesce(F.sum("file_size_bytes"), F.lit(0)).alias("bytes"), *aggs, F.coalesce(F.sum(F.when(last, F.col("file_size_bytes"))), F.lit(0)).alias("bytes_last"))


def kpis(model: Model, as_of: Column, minutes: int = 30) -> DataFrame:
    """Uploads, rate, what remains and the hours it takes at that rate (null: no end in sight)."""
    up = upload_rates(model, as_of, (minutes,))
    left = model.projects.agg(F.count_if(F.col("pdf_status").isin("PENDING", "DOWNLOADING", "ERROR")).alias("remaining"), F.count("*").alias("projects"))
    both = up.crossJoin(left)  # one row by one row
    rate = F.col(f"uploads_{minutes}")
    return both.select("uploaded", "bytes", rate.alias("uploads"), "remaining", "projects", F.when(rate > 0, F.round(F.col("remaining") / (rate / float(minutes) * 60), 2)).alias("hours_remaining"))


def by_year_failure(model: Model) -> DataFrame:
    """Per year and in total: attempted and failed projects and their shares."""
    df = chain(model).withColumn("y", F.col("d_year_label")).rollup("y")
    df = df.agg(F.count("*").alias("total"), *counts("p_pdf_status", {"downloaded": "DOWNLOADED", "failed": ("MISSING", "ERROR"), "attempted": ("DOWNLOADED", "MISSING", "ERROR")}), F.grouping("y").alias("g"))
    return df.select(F.when(F.col("g") == 1, "TOTAL").otherwise(F.col("y")).alias("year_label"), "total", "downloaded", "failed", "attempted", ratio(F.col("failed"), F.col("attempted")).alias("fail_pct"), ratio(F.col("attempted"), F.col("total")).alias("attempted_pct"))


def recent_errors(model: Model, each: int = 3, most: int = 5) -> DataFrame:
    """The latest errors of each level (nulls first, as its branch sorts), then of all (nulls last)."""
    d, lb, p = model.districts, model.bodies, model.projects
    branch = [
        d.where("status = 'ERROR'").select(F.lit("District").alias("type"), F.col("district_name").alias("name"), F.col("error_message").alias("error"), F.col("last_processed_at").alias("at"), "id"),
        lb.where("status = 'ERROR'").select(F.lit("LocalBody").alias("type"), F.col("lb_name").alias("name"), F.col("error_message").alias("error"), F.col("last_scraped_at").alias("at"), "id"),
        p.where("pdf_status = 'ERROR'").select(F.lit("Project").alias("type"), F.col("project_name").alias("name"), F.col("pdf_error_message").alias("error"), F.col("pdf_last_attempt_at").alias("at"), "id"),
    ]
    top = [b.orderBy(F.desc_nulls_first("at"), "id").limit(each) for b in branch]
    return top[0].unionByName(top[1]).unionByName(top[2]).orderBy(F.desc_nulls_last("at"), "type", "id").limit(most)


def phase_status(model: Model) -> DataFrame:
    """The four phases with total, pending, in_progress, done, errors, completeness and percentage."""

    def phase(k: int, df: DataFrame, column: str, pending, progress, done) -> DataFrame:
        return df.agg(F.count("*").alias("total"), *counts(column, {"pending": pending, "in_progress": progress, "done": done, "errors": "ERROR"})).withColumn("phase", F.lit(k))

    lb = (model.bodies, "status", ("PENDING", "PARTIAL"), "IN_PROGRESS", "DONE")
    out = phase(1, model.districts, "status", "PENDING", "IN_PROGRESS", "DONE").unionByName(phase(2, *lb)).unionByName(phase(3, *lb))
    out = out.unionByName(phase(4, model.projects, "pdf_status", "PENDING", "DOWNLOADING", ("DOWNLOADED", "MISSING")))
    complete = (F.col("total") > 0) & (F.col("pending") == 0) & (F.col("in_progress") == 0)
    return out.select("phase", "total", "pending", "in_progress", "done", "errors", complete.alias("is_complete"), ratio(F.col("done"), F.col("total")).alias("progress_pct"))


def level_totals(model: Model, *levels: str) -> DataFrame:
    """One row with the counters that the definitions of completeness read, of the ``levels`` asked for: d, b, p and u."""
    each = {
        "d": lambda: model.districts.agg(F.count("*").alias("d"), *counts("status", {"d_done": "DONE", "d_pending": "PENDING", "d_progress": "IN_PROGRESS"})),
        "b": lambda: model.bodies.agg(F.count("*").alias("b"), *counts("status", {"b_done": "DONE", "b_pending": "PENDING", "b_progress": "IN_PROGRESS", "b_partial": "PARTIAL", "b_error": "ERROR"})),
        "p": lambda: model.projects.agg(F.count("*").alias("p"), *counts("pdf_status", {"p_downloaded": "DOWNLOADED", "p_missing": "MISSING", "p_pending": "PENDING", "p_progress": "DOWNLOADING"})),
        "u": lambda: model.pdfs.agg(F.count("*").alias("u"), *counts("status", {"u_done": "UPLOADED"})),
    }
    rows = [each[k]() for k in levels]
    out = rows[0]
    for row in rows[1:]:
        out = out.crossJoin(row)  # one row each
    return out


def pipeline_status(model: Model) -> DataFrame:
    t = level_totals(model, "d", "b", "p")
    return t.select(((F.col("d_done") > 0) & (F.col("d_pending") == 0)).alias("phase1"), ((F.col("b_done") > 0) & (F.col("b_pending") == 0)).alias("phase2"), ((F.col("p_pending") == 0) & (F.col("p_downloaded") > 0)).alias("phase3"))


#: Names of the phases in the progress report, fixed values.
PHASES = ("Discover Districts", "Discover Local Bodies", "Scrape Projects", "Download PDFs")


def progress_report(model: Model) -> DataFrame:
    """The progress report, a row a phase: name, complete, total, done, missing, percent, rows by status.

    Its first phase is done with its rows; its third flag looks at documents, its fourth phase has none. ``progress_detail``
    has the breakdowns by year and district.
    """
    by = lambda df, column: df.groupBy(F.col(column).alias("status")).agg(F.count("*").alias("n"))

    def one(df: DataFrame, column: str, done: str) -> DataFrame:
        grouped = by(df, column)  # one row a status
        n = lambda *s: F.coalesce(F.sum(F.when(F.col("status").isin(*s), F.col("n"))), F.lit(0))
        status = F.map_from_entries(F.sort_array(F.collect_list(F.struct("status", "n"))))
        return grouped.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("total"), n(done).alias("done"), n("PENDING").alias("pending"), n("MISSING").alias("missing"), status.alias("status"))

    d, b, p = one(model.districts, "status", "DONE"), one(model.bodies, "status", "DONE"), one(model.projects, "pdf_status", "DOWNLOADED")
    named = lambda t, k: t.select(*(F.col(c).alias(f"{k}_{c}") for c in t.columns))
    t = named(d, "d").crossJoin(named(b, "b")).crossJoin(named(p, "p"))  # one row each
    some = F.col("d_total") > 0
    none = F.lit(None)
    rows = [
        (1, some, F.col("d_total"), F.col("d_total"), none, F.when(some, 100.0).otherwise(0.0), none),
        (2, (F.col("d_done") > 0) & (F.col("d_pending") == 0), F.col("d_total"), F.col("d_done"), none, ratio(F.col("d_done"), F.col("d_total")), F.col("d_status")),
        (3, (F.col("p_pending") == 0) & (F.col("p_done") > 0), F.col("b_total"), F.col("b_done"), none, ratio(F.col("b_done"), F.col("b_total")), F.col("b_status")),
        (4, none, F.col("p_total"), F.col("p_done"), F.col("p_missing"), ratio(F.col("p_done") + F.col("p_missing"), F.col("p_total")), F.col("p_status")),
    ]
    kinds = {"phase": "int", "complete": "boolean", "total": "long", "done": "long", "missing": "long", "percent": "double", "status": "map<string,bigint>"}
    cell = lambda row: F.struct(*((F.lit(v) if isinstance(v, int) else v).cast(k).alias(c) for v, (c, k) in zip(row, kinds.items(), strict=True)))
    out = t.select(F.explode(F.array(*map(cell, rows))).alias("r")).select("r.*")
    return out.withColumn("name", F.element_at(F.array(*map(F.lit, PHASES)), F.col("phase"))).select("phase", "name", *list(kinds)[1:])


def completeness(model: Model) -> DataFrame:
    """Completeness as each level's own check defines it."""
    t = level_totals(model, "d", "b", "p")
    return t.select(
        ((F.col("d") > 0) & (F.col("d_pending") == 0) & (F.col("d_progress") == 0)).alias("districts_complete"),
        ((F.col("b") > 0) & (F.col("b_pending") == 0) & (F.col("b_progress") == 0) & (F.col("b_partial") == 0)).alias("bodies_complete"),
        ((F.col("p_pending") == 0) & (F.col("p_progress") == 0)).alias("projects_complete"),
    )


def summary(model: Model) -> DataFrame:
    """The status report's four words."""
    t = level_totals(model, "d", "b", "p", "u")
    word = lambda done, some: F.when(done, "Complete").when(some, "In Progress").otherwise("Not Started")
    return t.select(
        word((F.col("d") > 0) & (F.col("d_done") == F.col("d")), F.col("d") > 0).alias("phase1"),
        word((F.col("b") > 0) & (F.col("b_done") == F.col("b")), F.col("b") > 0).alias("phase2"),
        word((F.col("p") > 0) & (F.col("b_done") + F.col("b_error") == F.col("b")), F.col("p") > 0).alias("phase3"),
        word((F.col("u") > 0) & (F.col("u_done") == F.col("u")), F.col("u") > 0).alias("phase4"),
    )


def gating(model: Model) -> DataFrame:
    """Which phases may run (the level before has rows) and which are skipped as complete."""
    w = Window.orderBy("phase")  # four rows
    df = phase_status(model)
    return df.select("phase", (F.coalesce(F.lag("total").over(w), F.lit(1)) > 0).alias("may_run"), F.col("is_complete").alias("skip"))


def scheduler_status(queues: DataFrame, most: int = 1000) -> DataFrame:
    """Queue sizes, whether each accepts work, and the total, from rows (queue, size)."""
    total = queues.agg(F.coalesce(F.sum("size"), F.lit(0)).alias("total"))
    return queues.crossJoin(total).select("queue", "size", (F.col("size") < most).alias("accepts"), "total")


def latest_runs(model: Model, n: int = 1) -> DataFrame:
    return model.runs.orderBy(F.desc("created_at"), "id").limit(n)


def pdfs_by_group(model: Model, chunk: int | None = 10_000) -> DataFrame:
    """Documents of each (district_name, lb_type_label) as lists of (id, path), in parts of about ``chunk``.

    A part is a share of its group by the hash of the id, so no list grows with its group: a group has as many parts as its
    count needs, and ``part`` numbers them from 0. Without ``chunk`` each group is one list, part 0, however long it gets.
    """
    above = chain(model, "p_id", "d_district_name", "d_lb_type_label")
    df = model.pdfs.join(above, F.col("project_id") == F.col("p_id"))
    df = df.select(F.col("d_district_name").alias("district_name"), F.col("d_lb_type_label").alias("lb_type_label"), "id", F.col("gcs_path").alias("path"))
    keys = ["district_name", "lb_type_label"]
    if chunk is None:
        df = df.withColumn("part", F.lit(0))
    else:
        parts = df.groupBy(*keys).agg(F.ceil(F.count("*") / chunk).cast("int").alias("parts"))
        df = df.join(parts, keys).withColumn("part", F.pmod(F.xxhash64("id"), F.col("parts")).cast("int"))
    return df.groupBy(*keys, "part").agg(F.count("*").alias("n"), F.sort_array(F.collect_list(F.struct("id", "path"))).alias("pdfs"))


#: Counters of a run's outcomes: name and the (step, result) that it counts.
OUTCOMES = {
    "districts_sampled": ("district", "sampled"),
    "local_bodies_discovered": ("local_body", "discovered"),
    "local_bodies_sampled": ("local_body", "sampled"),
    "projects_scraped": ("project", "scraped"),
    "projects_sampled": ("project", "sampled"),
    "pdfs_downloaded": ("pdf", "downloaded"),
    "pdfs_missing": ("pdf", "missing"),
    "pdfs_error": ("pdf", "error"),
}


def run_statistics(outcomes: DataFrame, errors: int = 10) -> DataFrame:
    """Counters, seconds from the first to the last outcome, errors and the first of their messages, of rows
    (step, result, message, ts). ``errors``: most messages that are listed; their number is never cut."""
    counted = outcomes.agg(
        *(F.count_if((F.col("step") == s) & (F.col("result") == r)).alias(k) for k, (s, r) in OUTCOMES.items()),
        F.count("message").alias("n_errors"),
        F.coalesce(F.round(F.timestamp_diff("MILLISECOND", F.min("ts"), F.max("ts")) / 1000.0, 1), F.lit(0.0)).alias("duration_seconds"),
    )
    first = outcomes.where("message is not null").orderBy(F.asc_nulls_last("ts"), "message").limit(errors)
    first = first.agg(F.transform(F.sort_array(F.collect_list(F.struct(F.col("ts").isNull().alias("late"), "ts", "message"))), lambda x: x["message"]).alias("errors"))
    return counted.crossJoin(first)  # one row each


def schedule_due(schedule: DataFrame, as_of: Column) -> DataFrame:
    """Jobs of rows (name, every_seconds, last_run) that are due, with the time they have been due since.

    A job that never ran is due at once (since null); one that missed several turns is due once.
    """
    since = F.col("last_run") + F.make_dt_interval(secs=F.col("every_seconds"))
    return schedule.withColumn("since", since).where(F.col("last_run").isNull() | (F.col("since") <= as_of)).select("name", "every_seconds", "since")


# The periodic jobs and their seconds.
SCHEDULE = {"full_pipeline": 86_400, "progress": 3_600, "reset_stuck": 900}
