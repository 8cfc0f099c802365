"""Operators on small fixtures: upserts, transitions, queues, sinks, scalars."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tierflow import functions as fn, registry, schemas
from tierflow.config import Settings
from tierflow.model import Model, create_empty, derive, read_model, write_model
from tierflow.operators import exports, reports, sampling, stats, upsert, workqueue as wq

NOW = dt.datetime(2024, 5, 1, 12)


def project(n, status="PENDING", retry=0, at=None, page=1, body="b"):
    return (str(n), body, f"PRJ{n:03}", f"name {n}", "50000", None, page, f"Select${n}", status, retry, None, at, NOW)


def projects(spark, rows):
    return spark.createDataFrame(rows, schemas.PROJECTS)


@pytest.fixture(scope="module")
def empty(spark):
    return Model(*(spark.createDataFrame([], s) for s in schemas.TABLES.values()))


def test_upsert_is_idempotent_and_keeps_what_it_must(spark):
    target = projects(spark, [project(1, "DOWNLOADED", 2, page=3), project(2)])
    source = projects(spark, [project(1)[:3] + ("new", None, "9", 8, "Select$9", "PENDING", 0, None, None, NOW), project(3)])
    once = upsert.upsert_table("projects", target, source)
    rows = {r.id: r for r in once.collect()}
    assert set(rows) == {"1", "2", "3"}
    assert (rows["1"].project_name, rows["1"].formulation, rows["1"].expense, rows["1"].select_argument) == ("new", None, "9", "Select$9")
    assert (rows["1"].pdf_status, rows["1"].pdf_retry_count, rows["1"].page_number) == ("DOWNLOADED", 2, 3)
    assert sorted(upsert.upsert_table("projects", once, source).collect()) == sorted(once.collect())
    assert once.dtypes == target.dtypes


def test_last_write_wins(spark):
    df = spark.createDataFrame([("k", 1, "a"), ("k", 3, None), ("k", 2, "c"), ("l", 1, "d")], "k string, seq int, v string")
    assert {(r.k, r.v) for r in upsert.last_write(df, ("k",), "seq").collect()} == {("k", None), ("l", "d")}


def test_last_write_of_nulls_and_ties(spark):
    schema = "k string, seq int, v string"
    df = spark.createDataFrame([("n", None, "a"), ("n", None, None), ("m", None, "z"), ("m", 0, None), ("t", 5, "b"), ("t", 5, "c"), ("t", 5, "a")], schema)
    for parts in (1, 3):
        assert {(r.k, r.v) for r in upsert.last_write(df.repartition(parts), ("k",), "seq").collect()} == {("n", "a"), ("m", None), ("t", "c")}
    target = spark.createDataFrame([("n", "old")], "k string, v string")
    got = upsert.upsert(target, df, ("k",), ("v",), "seq")
    assert {(r.k, r.v) for r in got.collect()} == {("n", "a"), ("m", None), ("t", "c")}


def test_events_that_come_twice_or_together(spark):
    later = NOW + dt.timedelta(minutes=1)
    events = [("1", "ERROR", "a", NOW), ("1", "ERROR", "a", NOW), ("1", "ERROR", "b", later), ("1", "IN_PROGRESS", None, NOW), ("9", "DONE", None, NOW), ("2", None, None, NOW), ("3", "DONE", None, NOW), ("3", "ERROR", "e", NOW)]
    d = [(str(k), None, 1, "y", 1, "t", k, "d", 1, 1, "t", "a", "PENDING", 0, None, NOW, None) for k in (1, 2, 3, 4)]
    t = spark.createDataFrame(d, schemas.DISTRICTS)
    got = upsert.district_events(t, spark.createDataFrame(events, "id string, to string, message string, ts timestamp_ntz"))
    rows = {r.id: (r.status, r.retry_count, r.error_message, r.last_processed_at) for r in got.collect()}
    assert rows == {"1": ("ERROR", 2, "b", later), "2": ("PENDING", 0, None, None), "3": ("ERROR", 1, "e", NOW), "4": ("PENDING", 0, None, None)}
    assert got.dtypes == t.dtypes


def test_document_life(spark):
    """A document is made, its upload fails, then succeeds; the error stays as history."""
    fields = "id string, action string, ts timestamp_ntz, project_id string, original_url string, original_filename string, redirect_url string, gcs_bucket string, gcs_path string, file_size_bytes long, content_hash string, message string"
    at = [NOW + dt.timedelta(minutes=k) for k in range(4)]
    none = [None] * 4
    events = [("x", "insert", at[0], "p", "u", "f", None, *none, None), ("x", "failed", at[1], None, None, None, None, *none, "lost"), ("x", "uploaded", at[2], None, None, None, None, "b", "k", 7, "h", None), ("y", "uploaded", at[3], None, None, None, None, "b", "k", 7, "h", None)]
    t = spark.createDataFrame([], schemas.PDFS)
    step = t
    for e in events:
        step = upsert.pdf_events(step, spark.createDataFrame([e], fields))
    whole = upsert.pdf_events(t, spark.createDataFrame(events + events[:1], fields))
    assert step.collect() == whole.collect() and whole.count() == 1
    r = whole.first()
    assert (r.id, r.project_id, r.status, r.upload_error, r.gcs_path, r.file_size_bytes, r.uploaded_at, r.downloaded_at) == ("x", "p", "UPLOADED", "lost", "k", 7, at[2], None)


def test_progress_moves_without_status(spark):
    b = spark.createDataFrame([("b", "d", 1, "n", 9, 2, 1, None, "t", "a", "IN_PROGRESS", 0, None, NOW, None)], schemas.BODIES)
    p = spark.createDataFrame([("b", 3, 30, None, NOW), ("b", 4, 40, 5, NOW), ("c", 1, 1, 1, NOW)], "id string, page int, scraped int, pages int, ts timestamp_ntz")
    r = upsert.set_progress(b, p).collect()
    assert [(x.last_page_scraped, x.scraped_projects, x.total_pages, x.status, x.last_scraped_at) for x in r] == [(4, 40, 5, "IN_PROGRESS", NOW)]


def test_transitions_count_errors(spark):
    t = projects(spark, [project(1), project(2)])
    names = {"status": "pdf_status", "retry": "pdf_retry_count", "message": "pdf_error_message", "at": "pdf_last_attempt_at"}
    for k in (1, 2):
        t = upsert.transition(t, spark.createDataFrame([("1", "ERROR", f"e{k}", NOW)], "id string, to string, message string, ts timestamp_ntz"), **names)
    rows = {r.id: r for r in t.collect()}
    assert (rows["1"].pdf_status, rows["1"].pdf_retry_count, rows["1"].pdf_error_message, rows["1"].pdf_last_attempt_at) == ("ERROR", 2, "e2", NOW)
    assert rows["2"].pdf_retry_count == 0 and rows["2"].pdf_last_attempt_at is None


def test_retry_cap_and_limits(spark, empty):
    rows = [project(1), project(2, "DOWNLOADED"), project(3, "ERROR"), project(4, "MISSING"), project(5, "ERROR", 10), project(6, "DOWNLOADING")]
    m = Model(empty.runs, empty.districts, empty.bodies, projects(spark, rows), empty.pdfs)
    assert [r.id for r in wq.pending_projects_of(m, "b").collect()] == ["1", "3", "6"]
    assert wq.take(m.projects, 0).count() == 6 and wq.take(m.projects, None).count() == 6 and wq.take(m.projects, 2).count() == 2
    ids, marked = wq.claim(m.projects, m.projects.where("id = '1'"), "pdf_status", "DOWNLOADING")
    assert ids.count() == 1 and marked.where("pdf_status = 'DOWNLOADING'").count() == 2
    with pytest.raises(ValueError):
        wq.exactly_one(wq.by_key(m.projects, local_body_id="b"))


def test_stuck_edges(spark):
    late, edge = NOW - dt.timedelta(minutes=61), NOW - dt.timedelta(minutes=60)
    t = projects(spark, [project(1, "DOWNLOADING", 1, late), project(2, "DOWNLOADING", 0, edge), project(3, "DOWNLOADING"), project(4, "ERROR", 0, late)])
    as_of = F.lit(NOW).cast("timestamp_ntz")
    got = {r.id: (r.pdf_status, r.pdf_retry_count, r.pdf_last_attempt_at) for r in upsert.reset_stuck(t, as_of, 60).collect()}
    assert got["1"] == ("PENDING", 1, late) and got["2"][0] == "DOWNLOADING" and got["3"][0] == "PENDING" and got["4"][0] == "ERROR"
    assert upsert.count_stuck(t, as_of, None).first().stuck == 3


def test_circuit_breaker(spark):
    status = ["ERROR"] * 4 + ["DOWNLOADED"] + ["ERROR"] * 5 + ["PENDING"] * 3
    t = projects(spark, [project(k, s) for k, s in enumerate(status)])
    assert sorted(int(r.id) for r in upsert.circuit_breaker(t).collect()) == list(range(10))


def test_circuit_breaker_of_several_parents(spark):
    import random

    rng, rows, want = random.Random(4), [], set()
    for body in "abcdef":
        run = 0
        for k in range(40):
            status, keep = rng.choice(["ERROR", "ERROR", "DOWNLOADED", "PENDING"]), run < 3
            if keep:
                want.add(f"{body}{k}")
                run = run + 1 if status == "ERROR" else 0
            rows.append((f"{body}{k}", body, f"{k:03}", "n", None, None, 1, "s", status, 0, None, None, NOW))
    rng.shuffle(rows)
    assert {r.id for r in upsert.circuit_breaker(projects(spark, rows), run=3).collect()} == want


def test_exact_percentiles(spark):
    import numpy as np

    rng = np.random.default_rng(3)
    levels = [0.0, 0.01, 0.25, 0.5, 0.9, 0.999, 1.0]
    for values in (rng.integers(0, 10**6, 5000), np.repeat(7, 4000), rng.lognormal(0, 9, 3000), np.array([5.0]), np.r_[np.zeros(3000), 1e9, np.arange(50)], rng.normal(size=2001)):
        df = spark.createDataFrame([(float(v),) for v in values], "v double")
        got = stats.exact_percentiles(df, "v", levels, bins=16, most=20)
        assert got == pytest.approx(np.quantile(values, levels).tolist(), rel=1e-9, abs=1e-12)
    assert stats.exact_percentiles(spark.createDataFrame([(None,)], "v double"), "v", [0.5]) == [None]


def test_histogram_shows_empty_bins(spark):
    df = spark.createDataFrame([(1.0,), (1.0,), (2.0**29,)], "v double")
    rows = stats.log_histogram(df, "v").collect()
    assert [r.bin for r in rows] == list(range(29)) and [r.n for r in rows] == [2] + [0] * 27 + [1] and rows[-1].cumulative_pct == 100
    assert stats.log_histogram(df.where("v < 0"), "v").count() == 0


def test_groups_of_documents_in_parts(spark, sf):
    m = derive(spark, sf)
    got = reports.pdfs_by_group(m, chunk=2).collect()
    assert max(r.n for r in got) < 20 and sum(r.n for r in got) == m.pdfs.count() and any(r.part > 0 for r in got)
    assert len({p.id for r in got for p in r.pdfs}) == m.pdfs.count()


def test_query_of_groups_keeps_a_large_group_whole(spark, sf):
    m = derive(spark, sf)
    project = m.projects.orderBy("id").first().id
    pdfs = spark.range(10_500).select(F.concat(F.lit("pdf-"), "id").alias("id"), F.lit(project).alias("project_id"), F.concat(F.lit("pdfs/"), "id").alias("gcs_path"))
    (r,) = registry.ON_MODEL["D24_pdfs_by_group"](Model(m.runs, m.districts, m.bodies, m.projects, pdfs)).collect()
    assert (r.part, r.n) == (0, 10_500) and r.pdfs == ",".join(sorted(f"pdf-{k} pdfs/{k}" for k in range(10_500)))


def test_run_statistics(spark, empty):
    rows = [("district", "sampled", None, NOW)] * 2 + [("pdf", "error", f"e{k}", NOW + dt.timedelta(seconds=k)) for k in range(12)] + [("pdf", "downloaded", None, None)]
    r = reports.run_statistics(spark.createDataFrame(rows, "step string, result string, message string, ts timestamp_ntz")).first()
    assert (r.districts_sampled, r.pdfs_error, r.pdfs_downloaded, r.n_errors, r.duration_seconds, r.errors) == (2, 12, 1, 12, 11.0, [f"e{k}" for k in range(10)])
    none = reports.run_statistics(spark.createDataFrame([], "step string, result string, message string, ts timestamp_ntz")).first()
    assert none.duration_seconds == 0 and none.errors == [] and none.pdfs_error == 0


def test_schedule(spark):
    rows = [(n, s, None if n == "progress" else NOW - dt.timedelta(seconds=s - 1 if n == "full_pipeline" else 5 * s)) for n, s in reports.SCHEDULE.items()]
    due = reports.schedule_due(spark.createDataFrame(rows, "name string, every_seconds int, last_run timestamp_ntz"), F.lit(NOW).cast("timestamp_ntz"))
    assert {r.name: r.since for r in due.collect()} == {"progress": None, "reset_stuck": NOW - dt.timedelta(seconds=4 * 900)}


def test_progress_report_of_empty_tables(empty):
    assert [(r.phase, r.complete, r.total, r.percent) for r in reports.progress_report(empty).collect()] == [(1, False, 0, 0.0), (2, False, 0, 0.0), (3, False, 0, 0.0), (4, None, 0, 0.0)]


def test_totals_read_only_their_levels(spark, sf):
    """A count of districts and bodies does not read line items."""
    plan = reports.level_totals(derive(spark, sf), "d", "b")._jdf.queryExecution().executedPlan().toString()
    assert "lineitem" not in plan and "lineitem" in reports.level_totals(derive(spark, sf), "u")._jdf.queryExecution().executedPlan().toString()


def test_schema_versions(spark, tmp_path):
    from tierflow.model import drop, migrate

    path = str(tmp_path / "m")
    (tmp_path / "m").mkdir()
    (tmp_path / "m" / "other").mkdir()
    assert migrate(spark, path, 0) == 1 and read_model(spark, path).pdfs.count() == 0
    assert migrate(spark, path, 1, 0) == 0 and sorted(x.name for x in (tmp_path / "m").iterdir()) == ["other"]
    assert drop(spark, path) == [] and migrate(spark, path, 1, 1) == 1
    with pytest.raises(ValueError):
        migrate(spark, path, 0, 7)


def test_layout_prunes(spark, sf, tmp_path):
    m = derive(spark, sf)
    write_model(m, str(tmp_path / "m"), clustered=True)
    back = read_model(spark, str(tmp_path / "m"))
    assert all(df.count() == m.tables()[name].count() for name, df in back.tables().items())
    one = back.projects.where("local_body_id = '1998-899'")
    assert "PushedFilters: [IsNotNull(local_body_id), EqualTo(local_body_id,1998-899)]" in one._jdf.queryExecution().executedPlan().toString()


def test_key_ranges_cover_every_key_once(spark):
    from tierflow.model import key_ranges

    df = spark.createDataFrame([(x,) for x in ("", "a", "b", "b'c", "m", "z", None)], "id string")
    ranges = key_ranges("id", ["m", "b", "b'c", "b"])
    assert sum(df.where(r).count() for r in ranges) == 7 and len(ranges) == 4
    assert key_ranges("id", []) == ["1 = 1"]


def test_empty_tables_report_zeros(empty):
    assert {r.n for r in reports.table_counts(empty).collect()} == {0}
    assert [r.progress_pct for r in reports.phase_status(empty).collect()] == [0.0] * 4
    assert reports.summary(empty).first().phase1 == "Not Started"
    assert reports.by_year_failure(empty).count() == 0  # a rollup of no rows has no total
    assert reports.body_progress(empty).first().expected == 0
    assert not reports.completeness(empty).first().districts_complete
    assert reports.recent_errors(empty).count() == 0


def test_tables_roundtrip(spark, sf, tmp_path):
    m = derive(spark, sf)
    write_model(m, str(tmp_path / "m"))
    back = read_model(spark, str(tmp_path / "m"))
    for name, df in back.tables().items():
        assert df.count() == m.tables()[name].count()
    assert wq.duplicates(back.bodies, "district_id", "lb_index").count() == 0
    create_empty(spark, str(tmp_path / "e"))
    assert read_model(spark, str(tmp_path / "e")).districts.count() == 0


def test_csv_sinks(spark, sf, tmp_path):
    m = derive(spark, sf)
    counted = {r.file: r.rows for r in exports.write_flat(m, str(tmp_path)).collect()}
    years = {r.year_label for r in exports.years(m).collect()}
    assert set(counted) == {f"pdfs_flat_{y}.csv" for y in years} and sum(counted.values()) == exports.flat(m).count()
    for name, rows in counted.items():
        parts = sorted((tmp_path / name).glob("part-*.csv"))
        lines = [next_line for p in parts for next_line in p.read_text().splitlines()[1:]]
        assert len(lines) == rows and parts[0].read_text().splitlines()[0].split(",") == list(exports.FLAT)
        keys = [(int(r.lb_type_val), int(r.district_index), int(r.local_body_index), r.project_no) for p in parts for r in spark.read.option("header", True).csv(str(p)).collect()]
        assert keys == sorted(keys)
    only = exports.write_flat(m, str(tmp_path / "one"), 1997).collect()
    assert [r.file for r in only] == ["pdfs_flat_1997-1998.csv"] and [x.name for x in (tmp_path / "one").iterdir() if x.is_dir()] == ["pdfs_flat_1997-1998.csv"]
    paths = exports.write_raw(m, str(tmp_path))
    for name, df in (("projects", m.projects), ("districts", m.districts)):
        back = spark.read.option("header", True).csv(paths[name])
        assert back.count() == df.count() and back.columns == exports.RAW[name](m).columns
    years = [int(r.year_val) for p in sorted((tmp_path / "districts.csv").glob("part-*.csv")) for r in spark.read.option("header", True).csv(str(p)).collect()]
    assert years == sorted(years, reverse=True)


def test_headers_of_the_exports(spark, empty):
    assert exports.flat(empty).columns == "year_val year_label lb_type_val lb_type_label district_index district_name local_body_index local_body_name project_no project_name formulation expense pdf_status pdf_downloaded pdf_gcs_path pdf_gcs_bucket pdf_original_url pdf_file_size_bytes pdf_content_hash project_scraped_at pdf_downloaded_at pdf_uploaded_at".split()
    assert [len(make(empty).columns) for make in exports.RAW.values()] == [16, 18, 17, 18]


def test_upload_of_an_export(spark, empty, tmp_path):
    exports.write_raw(empty, str(tmp_path / "a"))
    (tmp_path / "a" / "notes.txt").write_text("not exported")
    (tmp_path / "b").mkdir()
    (tmp_path / "b" / "pdfs.csv").write_text("in the way")
    got = {r.file: r for r in exports.upload(spark, str(tmp_path / "a"), str(tmp_path / "b")).collect()}
    assert set(got) == {"districts.csv", "local_bodies.csv", "projects.csv", "pdfs.csv"}
    assert got["projects.csv"].ok and (tmp_path / "b" / "projects.csv").exists()
    total = exports.outcome(spark.createDataFrame(list(got.values()), "file string, ok boolean, bytes long, error string")).first()
    assert total.succeeded == sum(r.ok for r in got.values()) and total.failed + total.succeeded == 4
    assert exports.export_dir("x", dt.datetime(2026, 2, 15, 13, 38, 9)) == "x/20260215_133809"


def test_swap_shows_whole_tables(spark, tmp_path):
    path = str(tmp_path / "t")
    upsert.swap(spark, spark.range(3), path)
    old = upsert.current(spark, path)
    upsert.swap(spark, spark.range(5), path)
    assert old.count() == 3 and upsert.current(spark, path).count() == 5
    with pytest.raises(upsert.Conflict):  # made from a version that is no longer the newest
        upsert.swap(spark, spark.range(9), path, base=1)
    assert upsert.version(spark, path) == 2 and upsert.current(spark, path).count() == 5
    upsert.swap(spark, spark.range(6), path, base=2)
    assert upsert.current(spark, path).count() == 6 and upsert.current(spark, path, 1).count() == 3


def test_a_reader_beside_a_writer_sees_whole_tables(spark, tmp_path):
    import threading

    path, seen, stop = str(tmp_path / "t"), set(), threading.Event()
    upsert.swap(spark, spark.range(1), path)

    def look():
        while not stop.is_set():
            seen.add(upsert.current(spark, path).count())

    reader = threading.Thread(target=look)
    reader.start()
    for n in range(2, 6):
        upsert.swap(spark, spark.range(n), path)
    stop.set()
    reader.join()
    assert seen <= {1, 2, 3, 4, 5} and seen


def test_failed_writers_leave_the_old_table(spark, tmp_path):
    path = str(tmp_path / "t")
    upsert.swap(spark, spark.range(3), path)
    with pytest.raises(Exception, match="DIVIDE_BY_ZERO|divide"):
        upsert.swap(spark, spark.range(3).selectExpr("cast(1 / (id - 1) as int) as id").selectExpr("raise_error('divide') as id"), path)
    assert upsert.version(spark, path) == 1 and upsert.current(spark, path).count() == 3


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first().x


@pytest.mark.parametrize(
    ("text", "want"),
    [("Hello World", "Hello_World"), ("a   b", "a_b"), ('File<>:"/\\|?*Name', "File_Name"), ("A" * 100, "A" * 50), ("  ", "unnamed"), ("___", "unnamed"), (" x ", "x")],
)
def test_slug(spark, text, want):
    assert one(spark, fn.slugify(F.lit(text))) == want


def test_scalars(spark):
    lit = F.lit
    assert one(spark, fn.storage_path(lit("2024-2025"), lit("District Panchayat"), lit("D x"), lit("B"), lit("PRJ001"))) == "pdfs/2024-2025/District_Panchayat/D_x/B/PRJ001.pdf"
    assert [one(spark, fn.safe_int(lit(x))) for x in (" 1,166 ", "12.5", "")] == [1166, None, None]
    assert one(spark, fn.safe_float(lit("1,234.5"))) == 1234.5
    assert one(spark, fn.postback(lit("javascript:__doPostBack('gv','Select$3')"), lit(None).cast("string"))).argument == "Select$3"
    assert one(spark, fn.postback(lit("#"), lit("__doPostBack('t','a')"))).target == "t"
    assert one(spark, fn.disposition_filename(lit('attachment; filename="A b.PDF"'))) == "a b.pdf"
    assert one(spark, fn.is_pdf_response(lit("text/html"), lit("inline; filename=x.pdf")))
    assert [one(spark, fn.format_bytes(lit(n))) for n in (10, 2048, 5 * 1024**2, 3 * 1024**3)] == ["10 B", "2.0 KB", "5.0 MB", "3.0 GB"]
    assert one(spark, fn.format_pct(lit(1), lit(3))) == "33.3%" and one(spark, fn.format_pct(lit(0), lit(0))) == "0%"
    assert one(spark, fn.format_currency(lit("50,000"))) == "₹0" and one(spark, fn.format_currency(lit("50000"))) == "₹50,000"
    assert one(spark, fn.truncate(lit("abcdefghij"), 8)) == "abcde..." and one(spark, fn.truncate(lit(None).cast("string"))) == ""
    assert [one(spark, fn.format_bytes(lit(n))) for n in (1023, 1024, 2 * 1024**4)] == ["1023 B", "1.0 KB", "2048.0 GB"]
    assert [one(spark, fn.status_icon(lit(x), k)) for x, k in (("PARTIAL", "body"), ("MISSING", "project"), ("UPLOADING", "pdf"), ("DONE", "run"), ("FAILED", "run"))] == ["📊", "⚠️", "❓", "❓", "❌"]
    assert [one(spark, fn.safe_int(lit(x))) for x in ("\u00a0 7\n", "\t+1,0 ", "1 0", "0x1", "9" * 12, "-3")] == [7, 10, None, None, None, -3]
    assert [one(spark, fn.safe_float(lit(x))) for x in (" 1,5.25\u2003", ".5", "5.", "1e3", "d", "1d", "")] == [15.25, 0.5, 5.0, 1000.0, None, None, None]
    assert one(spark, fn.slugify(lit("\u00a0x y\n"))) == "x_y"
    assert one(spark, fn.prefix(lit("abcdef"), 3, dots=True)) == "abc..."
    assert one(spark, fn.progress_text(lit(3), lit(0))) == "3/?"
    assert one(spark, fn.hours_remaining(lit(600), lit(300))) == 1.0 and one(spark, fn.hours_remaining(lit(6), lit(0))) is None
    pages = F.create_map(lit(2), F.struct(lit("t").alias("target"), lit("Page$2").alias("argument")))
    dots = F.array(F.struct(lit("t").alias("target"), lit("Page$11").alias("argument")))
    assert one(spark, fn.next_page(lit(1), pages, dots)).argument == "Page$2"
    assert one(spark, fn.next_page(lit(2), pages, dots)).argument == "Page$11"
    assert one(spark, fn.next_page(lit(None).cast("int"), pages, dots)) is None
    assert one(spark, fn.district_icon(lit(1), lit(0), lit(2))) == "❌" and one(spark, fn.status_icon(lit("what"))) == "❓"
    assert one(spark, fn.natural_id(lit(1), lit("a"))) == one(spark, fn.natural_id(lit(1), lit("a")))
    assert one(spark, fn.elapsed_ms(F.expr("timestamp'2024-01-01 00:00:00'"), F.expr("timestamp'2024-01-01 00:00:01.5'"))) == 1500


def test_samples_repeat(spark, sf):
    m = derive(spark, sf)
    a, b = ([r.id for r in sampling.sample(m.projects.repartition(k), 20, 3).collect()] for k in (1, 5))
    assert a == b and len(a) == 20
    assert sampling.per_group(m.bodies, 1, ("district_id",)).count() == m.bodies.select("district_id").distinct().count()


def test_bootstrap_covers_the_mean(spark):
    df = spark.range(300).select("id", (F.col("id") % 50).cast("double").alias("v"))
    r = stats.bootstrap(df, "id", "v", 300).first()
    assert r.low < 24.5 < r.high and r.high - r.low < 6 and r.iterations == 300


def test_settings():
    assert Settings.from_env({"TIERFLOW_BATCH_SIZE": "7"}).batch_size == 7
    for bad in ({"max_retries": 99}, {"delay_min": 2.0}, {"log_level": "LOUD"}, {"max_queue": 9}, {"storage_backend": "tape"}):
        with pytest.raises(ValueError):
            Settings(**bad)
    assert Settings.from_env({"TIERFLOW_LIMIT_ENABLED": "no", "TIERFLOW_DELAY_MIN": "0.2"}).limit_enabled is False
    with pytest.raises(ValueError):
        Settings.from_env({"TIERFLOW_LIMIT_ENABLED": "perhaps"})


def test_command_line(spark, sf, tmp_path, capsys):
    from tierflow import cli

    data = str(tmp_path / "m")
    write_model(derive(spark, sf), data)
    for argv in (["progress", "-d"], ["status"], ["dashboard", "--as-of", "2001-07-25"], ["sample", "-c", "2"], ["sample", "--phase", "3"], ["pending", "--level", "projects"], ["queue-status"], ["run-discovery"]):
        cli.main(["--data", data, *argv])
    out = capsys.readouterr().out
    assert "Discover Local Bodies" in out and "Not Started" not in out and "project-tables" in out
    cli.main(["--data", data, "run-phase", "3", "--batch-size", "40", "--max-queue", "100000"])
    claimed = int(capsys.readouterr().out.split(":")[1].split()[0])
    after = upsert.current(spark, f"{data}/snapshots/bodies")
    m = read_model(spark, data)
    assert claimed == wq.pending_bodies(m).count() > 0 and after.where("status = 'IN_PROGRESS'").count() == claimed + m.bodies.where("status = 'IN_PROGRESS'").count()
    cli.main(["--data", data, "reset-stuck-pdfs", "--as-of", "2030-01-01", "--yes"])
    assert upsert.current(spark, f"{data}/snapshots/projects").where("pdf_status = 'DOWNLOADING'").count() == 0
    cli.main(["--data", data, "export", "--output-dir", str(tmp_path / "e"), "--at", "2026-02-15 13:38:09", "--year", "1997", "--upload", str(tmp_path / "u")])
    assert (tmp_path / "u" / "20260215_133809" / "pdfs_flat_1997-1998.csv").is_dir()
    cli.main(["--data", data, "drop-db"])
    assert "projects" in capsys.readouterr().out


def test_claims_stop_at_the_limit(spark, sf, tmp_path):
    from tierflow import cli

    m = derive(spark, sf)
    before = m.projects.where("pdf_status = 'DOWNLOADING'").count()
    path = str(tmp_path / "p")
    assert cli.claim_phase(m, "pdfs", 10, before + 25, 3, path) == 25
    assert upsert.current(spark, path).where("pdf_status = 'DOWNLOADING'").count() == before + 25
    assert cli.claim_phase(m, "pdfs", 10, before + 25, 3, path) == 0


def test_nested_view(spark, sf):
    m = derive(spark, sf)
    r = reports.nested(reports.districts_by_year_district(m), "year_label", "district_name", "total").first()
    assert sum(r.total.values()) == m.districts.where(F.col("year_label") == r.year_label).count()


def test_registered_bootstrap_runs_every_iteration(spark):
    from tierflow import registry

    r = registry.QUERIES["D33_bootstrap"](spark, "/root/testdata/sf0.001").first()
    assert r.iterations == 2000 and r.low < r.high
