"""Grid pages, files, documents and streams on small fixtures."""

import json

import pytest
from pyspark.sql import functions as F

from tierflow import sources
from tierflow.operators.upsert import current, swap
from tierflow.sources import htmlgrid as hg
from tierflow.streaming import drain, first_of_key, read, stuck_stream, upsert_stream, windowed_counts


def link(target, arg, label="go", attr="href"):
    return f"""<a {attr}="javascript:__doPostBack('{target}','{arg}')">{label}</a>"""


def row(*cells):
    return "<tr>" + "".join(f"<td> {c} </td>" for c in cells) + "</tr>"


HEAD, FOOT = "<tr><th>No</th><th>Name</th><th>n</th><th>m</th><th></th></tr>", row("", "Total", "3", "2,916", "")
DISTRICTS = f"<form><table id='gvState'>{HEAD}{row(1, 'First', 1, '1,166', link('gvState', 'Select$0'))}{row('x', 'no serial', 1, 1, link('gvState', 'Select$9'))}{row(2, 'Second', 1, 950, link('gvState', 'Select$1', attr='onclick'))}{row(3, 'no link', 1, 800, '')}{FOOT}</table></form>"
PAGER = "<tr><td colspan=5><table><tr><td><span>1</span></td><td>" + link("gvProjects", "Page$2", "2") + "</td><td>" + link("gvProjects", "Page$11", "...") + "</td></tr></table></td></tr>"
PROJECTS = f"<table id='gvProjects'>{HEAD}{row('PRJ001', 'Road', '50000', '45000', link('gvProjects', 'Select$0'))}{row('9', '1,234 5', '1', '2', link('gvProjects', 'Select$1'))}{row('PRJ002', 'Well', '', '', link('gvProjects', 'Select$2'))}{row('PRJ003', 'short', 1)}{PAGER}</table>"
BASE = "<form><input type=hidden name=__VS value=abc><select id=drpYear name=drpYear><option value=0>-<option value=28 selected>2024-2025<option value=27>2023-2024</select><select id='drpType'><option value=''>x</option><option value='1'>One</option></select></form>"


@pytest.fixture(scope="module")
def pages(spark):
    rows = [("d", DISTRICTS), ("p", PROJECTS), ("b", BASE), ("none", "<p>nothing</p>"), ("null", None), ("empty", "<table id='gvState'><tr><td>No data</td></tr></table>")]
    return spark.createDataFrame(rows, "page_id string, html string")


def test_district_grid(pages):
    got = [(r.page_id, r["index"], r.district_name, r.num_projects, r.postback_argument, r.productive) for r in hg.read(pages, "districts").collect()]
    assert got == [("d", 1, "First", 1166, "Select$0", None), ("d", 2, "Second", 950, "Select$1", None)]


def test_project_grid_and_pager(pages):
    got = [(r.project_no, r.formulation, r.select_argument) for r in hg.read(pages, "projects").collect()]
    assert got == [("PRJ001", "50000", "Select$0"), ("PRJ002", "", "Select$2")]
    p = {r.page_id: r for r in hg.read(pages, "pager").collect()}
    assert (p["p"].current_page, set(p["p"].pages), p["p"].has_more, p["p"].next.argument) == (1, {2}, True, "Page$2")
    assert p["none"].current_page is None and p["none"].next is None


def test_links_and_cells_that_count():
    """The link is the first anchor of the last cell; header cells are not data; a project's link posts to its grid."""
    plain, good = "<a href='#'>x</a>", link("gvState", "Select$4")
    def names(*rows):
        return [r["district_name"] for r in hg.district_rows(hg.parse(f"<table id='gvState'>{HEAD}{''.join(rows)}{FOOT}</table>"))]

    assert names(row(1, "earlier" + good, 1, 2, plain)) == []  # a link of another cell does not count
    assert names(row(1, "first", 1, 2, plain + good)) == []  # nor does the cell's second anchor
    assert names(row(1, "ok", 1, 2, good + link("t", "a"))) == ["ok"]
    assert [r["postback_argument"] for r in hg.district_rows(hg.parse(f"<table id='gvState'>{HEAD}{row(1, link('t', 'other') + 'n', 1, 2, good)}{FOOT}</table>"))] == ["Select$4"]
    assert names(f"<tr><th>1</th><td>a</td><td>1</td><td>2</td><td>{good}</td></tr>") == []  # four data cells
    projects = lambda *rows: [(r["project_no"], r["select_argument"]) for r in hg.project_rows(hg.parse(f"<table id='gvProjects'>{HEAD}{''.join(rows)}</table>"))]
    assert projects(row("P1", "n", "1", "2", link("other", "Select$1")), row("P2", "n", "1", "2", link("other", "Select$1") + link("gvProjects", "Select$2"))) == [("P2", "Select$2")]
    nested = lambda no: f"<tr><td>{no}</td><td>n<table><tr><td>x</td></tr></table></td><td>1</td><td>2</td><td>{link('gvProjects', 'Select$' + no)}</td></tr>"
    assert projects(nested("1"), nested("2")) == [("2", "Select$2")]  # only the first is the pager
    assert projects(row("P3", "", "1", "2", link("gvProjects", "Select$3"))) == [("P3", "Select$3")]  # an empty name is no total


def test_amounts_of_grids(spark):
    cells = (2, "B", "1,234", "10.5", "x", "3,000", "7")
    html = f"<table id='gvStat'>{HEAD}{row(*cells, link('gvStat', 'Select$0'))}{row('n', 'no number', 1, link('gvStat', 'a'))}{FOOT}</table>"
    got = hg.read(spark.createDataFrame([(1, html)], "page_id int, html string"), "bodies").collect()
    assert [(r["index"], r.lb_name, r.num_projects, r.productive, r.service, r.infrastructure, r.total) for r in got] == [(2, "B", 1234, 10.5, None, 3000.0, 7.0)]


def test_pager_without_ellipsis(spark):
    html = f"<table id='gvProjects'>{HEAD}<tr><td><table><tr><td><span>x</span><span>2</span><span>3</span></td><td>{link('gvProjects', 'Page$1', '1')}</td><td><a href='#'>9</a></td></tr></table></td></tr></table>"
    p = hg.pager(hg.parse(html))
    assert (p["current_page"], list(p["pages"]), p["ellipsis"], p["has_more"], p["next"]) == (2, [1], [], False, None)


def test_options_and_form(pages):
    assert [(r.value, r.label) for r in hg.read(pages, "years").collect()] == [("28", "2024-2025"), ("27", "2023-2024")]
    assert [(r.value, r.label) for r in hg.read(pages, "types").collect()] == [("1", "One")]
    assert {r.page_id: r.state for r in hg.read(pages, "form").collect()}["b"] == {"__VS": "abc", "drpYear": "28"}


def test_body_grid_and_rows_in_a_body_element():
    html = f"<table id='gvStat'>{HEAD}{row(1, 'B', 7, link('gvStat', 'Select$0'))}{FOOT}</table>"
    assert [r["lb_name"] for r in hg.body_rows(hg.parse(html))] == ["B"]
    assert not list(hg.body_rows(hg.parse(html.replace("<table id='gvStat'>", "<table id='gvStat'><tbody>"))))


def test_pdf_addresses(spark):
    rows = [(1, "http://h/a/", "<a href='x.html'>a</a><a href='d/y.PDF'>b</a>"), (2, "http://h/", "<iframe src='/show?type=pdf&i=1'>"), (3, "http://h/", "<a href='z.html'>"), (4, None, None)]
    got = {r.page_id: r.pdf_url for r in hg.pdf_urls(spark.createDataFrame(rows, "page_id int, url string, html string")).collect()}
    assert got == {1: "http://h/a/d/y.PDF", 2: "http://h/show?type=pdf&i=1", 3: None, 4: None}


def test_pages_are_read_until_the_end():
    data = {1: (["a", "b"], 2), 2: (["c"], 3), 3: (["d"], 1)}
    fetch = lambda parent, page: data[page]
    assert [p for p, _ in sources.paginated(fetch, None)] == [1, 2, 3]
    assert [p for p, _ in sources.paginated(fetch, None, expected=3)] == [1, 2]
    assert [p for p, _ in sources.paginated(fetch, None, first=2, expected=3, have=2)] == [2]


def test_scraping_resumes_at_its_checkpoint(spark):
    import datetime as dt

    from tierflow import schemas
    from tierflow.operators.upsert import set_progress

    def fetch(body, page):  # three pages of two rows
        return [{"project_no": f"{body}-{page}-{k}"} for k in range(2)], page + 1 if page < 3 else None

    now = dt.datetime(2024, 1, 1)
    rows = [(i, "d", 1, "n", e, s, p, None, "t", "a", "IN_PROGRESS", 0, None, now, None) for i, e, s, p in (("new", None, 0, 0), ("half", None, 4, 2), ("few", 3, 0, 0))]
    bodies = spark.createDataFrame(rows, schemas.BODIES)
    pages = sources.scrape(bodies, fetch, "project_no: string", parallel=2)
    got = sorted((r.local_body_id, r.page, r.scraped) for r in pages.collect())
    assert got == [("few", 1, 2), ("few", 2, 4), ("half", 2, 6), ("half", 3, 8), ("new", 1, 2), ("new", 2, 4), ("new", 3, 6)]  # the page read again counts again
    after = {r.id: (r.last_page_scraped, r.scraped_projects, r.status) for r in set_progress(bodies, sources.checkpoints(pages)).collect()}
    assert after == {"new": (3, 6, "IN_PROGRESS"), "half": (3, 8, "IN_PROGRESS"), "few": (2, 4, "IN_PROGRESS")}


def test_retries_double_their_pauses():
    slept, calls = [], []

    def flaky():
        calls.append(1)
        if len(calls) < 9:
            raise OSError("busy")
        return 7

    with pytest.raises(OSError):
        sources.retrying(flaky, sleep=slept.append)
    assert slept == [2, 4, 8, 16, 32, 64, 128]
    assert sources.retrying(flaky, attempts=20, sleep=slept.append) == 7


def test_back_pressure():
    from tierflow.streaming import wait_for_space

    sizes, now = iter([1200, 1000, 999]), [0.0]
    assert wait_for_space(lambda: next(sizes), sleep=lambda s: now.__setitem__(0, now[0] + s), clock=lambda: now[0]) and now[0] == 10
    assert not wait_for_space(lambda: 5000, timeout=12, sleep=lambda s: now.__setitem__(0, now[0] + s), clock=lambda: now[0]) and now[0] == 25


def test_buckets_rewrite_only_what_a_batch_touches(spark, tmp_path):
    from tierflow.streaming import upsert_buckets, write_buckets

    path = str(tmp_path / "t")
    write_buckets(spark.range(200).selectExpr("id as k", "'old' as v"), path, ("k",), 8)
    before = {f: f.stat().st_mtime_ns for f in (tmp_path / "t").rglob("part-*.parquet")}
    batch = spark.createDataFrame([(5, "a", 1), (5, "b", 2), (999, "new", 1)], "k long, v string, seq int")
    n = upsert_buckets(batch, path, ("k",), ("v",), "seq", 8)
    for _ in range(2):
        got = {r.k: r.v for r in spark.read.parquet(path).collect()}
        assert len(got) == 201 and got[5] == "b" and got[999] == "new" and sum(v == "old" for v in got.values()) == 199
        kept = [f for f in before if f.exists()]
        assert n in (1, 2) and len(kept) >= len(before) - 2
        upsert_buckets(batch, path, ("k",), ("v",), "seq", 8)  # the same batch again changes nothing
    assert upsert_buckets(batch.limit(0), path, ("k",), ("v",), "seq", 8) == 0


def test_blobs(spark, tmp_path):
    rows = [("2024", "T", "D", "B", "1", b"%PDF-1"), ("2024", "T", "D", "B", "2", b"%PDF-2")]
    df = sources.upload_columns(spark.createDataFrame(rows, "year_label string, lb_type_label string, district_name string, lb_name string, project_no string, content binary"))
    for _ in range(2):  # the second time skips
        got = sources.materialise(df, str(tmp_path)).collect()
        assert sorted((r.name, r.ok, r.bytes) for r in got) == [("pdfs/2024/T/D/B/1.pdf", True, 6), ("pdfs/2024/T/D/B/2.pdf", True, 6)]
    by = lambda *a: [r.path.rpartition("pdfs/")[2] for r in sources.blobs(spark, str(tmp_path), *a).collect()]
    assert len(by()) == 2 and by("pdfs/20") == by("pdfs/2024/T/D/B/") == sorted(by()) and by("pdfs/2024/T/D/B/1") == ["2024/T/D/B/1.pdf"]
    assert by("pdfs/", 1) == ["2024/T/D/B/1.pdf"] and by("1") == by("none/") == by("pdfs/[2]") == []
    keys = spark.createDataFrame([("pdfs/2024/T/D/B/1.pdf",), ("pdfs/2024/T/D/B/9.pdf",), ("pdfs",), (None,)], "key string")
    assert {r.key: r.exists for r in sources.exists(spark, str(tmp_path), keys).collect()} == {"pdfs/2024/T/D/B/1.pdf": True, "pdfs/2024/T/D/B/9.pdf": False, "pdfs": False, None: False}
    assert sources.delete(spark, str(tmp_path), ["pdfs/2024/T/D/B/2.pdf", "pdfs/none"]) == {"pdfs/2024/T/D/B/2.pdf": True, "pdfs/none": False}
    assert len(by()) == 1
    with pytest.raises(ValueError):
        sources.delete(spark, str(tmp_path), ["../x"])
    assert df.first().file_size_bytes == 6


def test_extraction_documents(spark, tmp_path):
    doc = {"extraction_date": "d", "model_used": "m", "results": [{"total_pages": 4, "projects": [{"project_name": "a", "project_cost": 1.5}, {"project_name": "b"}], "source_file": "f.pdf", "llm_usage": {"total_cost_usd": 0.5, "latency_ms": 7}}, {"projects": []}]}
    (tmp_path / "x.json").write_text(json.dumps(doc))
    got = sources.extraction(spark, str(tmp_path / "x.json")).collect()
    assert [(r.source_file, r.project_name, r.cost_usd) for r in got] == [("f.pdf", "a", 0.5), ("f.pdf", "b", 0.5), (None, None, None)]
    (tmp_path / "h.csv").write_text("bin_lo,bin_hi,bin_mid,count,cumulative_pct\n1,2,1,5,50.0\n")
    assert sources.csv(spark, str(tmp_path / "h.csv"), "histogram").first()["count"] == 5
    (tmp_path / "m.csv").write_text("model,$/1M in,$/1M out,cost / PDF,sample $,corpus Standard $,corpus Batch $\nx,0.1,0.4,0.00276,0.276,5392.0,2696.0\n")
    r = sources.csv(spark, str(tmp_path / "m.csv"), "models").first()
    assert (r.model, r.price_in, r.corpus_batch) == ("x", 0.1, 2696.0)
    (tmp_path / "r.csv").write_text('run+schema,schema,n\n"a, ON",v1,100,0,100 docs,15991,15022,0.05,0.04,0.07,0.23,0.25,15,144.7,5.3,103554.0,51777.0,95384.0\n')
    r = sources.csv(spark, str(tmp_path / "r.csv"), "runs").first()
    assert (r.run, r.n_pdfs, r.runaways, r.corpus_std_median) == ("a, ON", 100, 15, 95384.0)


def test_stream_upserts_equal_batches(spark, tmp_path):
    schema = "k int, v string, seq int"
    swap(spark, spark.createDataFrame([(1, "old"), (2, "old")], "k int, v string"), str(tmp_path / "t"))
    for n, rows in enumerate([[(1, "a", 1), (1, "b", 2)], [(3, "c", 3)]]):
        spark.createDataFrame(rows, schema).coalesce(1).write.parquet(str(tmp_path / "in" / str(n)))
    stream = read(spark, str(tmp_path / "in" / "*"), spark.createDataFrame([], schema).schema, 1)
    for _ in range(2):  # a restart finds nothing new
        upsert_stream(stream, str(tmp_path / "t"), str(tmp_path / "c"), ("k",), ("v",), "seq").awaitTermination(120)
    assert {(r.k, r.v) for r in current(spark, str(tmp_path / "t")).collect()} == {(1, "b"), (2, "old"), (3, "c")}


def collect(spark, df, name, tmp_path, mode="append"):
    q = df.writeStream.format("memory").queryName(name).outputMode(mode).option("checkpointLocation", str(tmp_path / name)).trigger(availableNow=True).start()
    q.awaitTermination(180)
    return spark.table(name)


def test_windowed_counts_equal_batch(spark, sf, tmp_path):
    events = spark.read.parquet(f"{sf}/events.parquet")
    stream = spark.readStream.schema(events.schema).option("pathGlobFilter", "events.parquet").parquet(sf)
    got = collect(spark, windowed_counts(stream, "ts", "event_type", "1 day", "1 hour"), "daily", tmp_path, "complete")
    want = events.groupBy(F.date_trunc("day", "ts").alias("d"), "event_type").count()
    assert got.agg(F.sum("n")).first()[0] == events.count() and got.count() == want.count()
    first = collect(spark, first_of_key(stream.withColumn("ts", F.col("ts").cast("timestamp")), "user_id", "ts", "365 days"), "firsts", tmp_path)
    assert first.count() == events.select("user_id").distinct().count()


def test_stuck_timer(spark, tmp_path):
    schema = "id string, ts timestamp, status string"
    rows = [[("a", "2024-01-01 00:00:00", "DOWNLOADING"), ("b", "2024-01-01 00:00:00", "DOWNLOADING")], [("b", "2024-01-01 00:10:00", "DOWNLOADED")], [("z", "2024-01-01 03:00:00", "PENDING")], [("z", "2024-01-01 04:00:00", "PENDING")]]
    for n, r in enumerate(rows):
        spark.createDataFrame(r, "id string, ts string, status string").withColumn("ts", F.col("ts").cast("timestamp")).coalesce(1).write.parquet(str(tmp_path / "s" / str(n)))
    stream = read(spark, str(tmp_path / "s" / "*"), spark.createDataFrame([], schema).schema, 1)
    got = collect(spark, stuck_stream(stream, 60), "stuck", tmp_path)
    assert [r.id for r in got.collect()] == ["a"]


def test_drain():
    left = [250]

    def work(n):
        done = min(n, left[0])
        left[0] -= done
        return done

    assert drain(lambda: {"pending": left[0], "in_progress": 0}, work) == 3
    assert drain(lambda: {"pending": 5, "errors": 0, "in_progress": 0}, lambda n: 0) == 0
