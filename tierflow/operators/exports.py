"""Flat and per-table exports as DataFrames, and their CSV sinks."""

from __future__ import annotations

import datetime as dt
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tierflow.functions import file_year
from tierflow.model import Model
from tierflow.plans import bodies_with_district, chain

# The headers of the flat export, in order, and the column of the joined levels that each shows.
FLAT = {
    "year_val": "d_year_val",
    "year_label": "d_year_label",
    "lb_type_val": "d_lb_type_val",
    "lb_type_label": "d_lb_type_label",
    "district_index": "d_district_index",
    "district_name": "d_district_name",
    "local_body_index": "lb_lb_index",
    "local_body_name": "lb_lb_name",
    "project_no": "p_project_no",
    "project_name": "p_project_name",
    "formulation": "p_formulation",
    "expense": "p_expense",
    "pdf_status": "p_pdf_status",
    "pdf_downloaded": "p_downloaded",
    "pdf_gcs_path": "pdf_gcs_path",
    "pdf_gcs_bucket": "pdf_gcs_bucket",
    "pdf_original_url": "pdf_original_url",
    "pdf_file_size_bytes": "pdf_file_size_bytes",
    "pdf_content_hash": "pdf_content_hash",
    "project_scraped_at": "p_scraped_at",
    "pdf_downloaded_at": "pdf_downloaded_at",
    "pdf_uploaded_at": "pdf_uploaded_at",
}
FLAT_ORDER = ("lb_type_val", "district_index", "local_body_index", "project_no")

# The headers of the exports by table, after those of the table itself.
DISTRICTS = """id year_val year_label lb_type_val lb_type_label district_index district_name num_local_bodies num_projects
    postback_target postback_argument status retry_count error_message discovered_at last_processed_at""".split()
BODIES = """id district_id district_name year_label lb_type_label lb_index lb_name expected_projects scraped_projects
    last_page_scraped total_pages postback_target postback_argument status retry_count error_message discovered_at
    last_scraped_at""".split()
PROJECTS = """id local_body_id local_body_name district_name year_label lb_type_label project_no project_name formulation
    expense page_number select_argument pdf_status pdf_retry_count pdf_error_message pdf_last_attempt_at scraped_at""".split()
PDFS = """id project_id project_no project_name local_body_name district_name year_label gcs_path gcs_bucket original_url
    original_filename redirect_url file_size_bytes content_hash status upload_error downloaded_at uploaded_at""".split()
#: What headers show that belong to a level above the exported one.
ABOVE = {
    "district_name": "d_district_name",
    "year_label": "d_year_label",
    "lb_type_label": "d_lb_type_label",
    "local_body_name": "lb_lb_name",
}


def flat(model: Model, year: int | None = None, district: str | None = None) -> DataFrame:
    """Projects with all levels above and their document, if any. ``year`` of None or 0 means all; ``district`` is a
    contains-pattern in which ``%`` and ``_`` stay wildcards."""
    df = chain(model)
    if year:
        df = df.where(F.col("d_year_val") == year)
    if district:
        df = df.where(F.col("d_district_name").ilike(f"%{district}%"))
    pdf = model.pdfs.select(*(F.col(c).alias(f"pdf_{c}") for c in model.pdfs.columns))
    df = df.join(pdf, F.col("p_id") == F.col("pdf_project_id"), "left").withColumn("p_downloaded", F.col("p_pdf_status") == "DOWNLOADED")
    return df.select(*(F.col(v).alias(k) for k, v in FLAT.items()))


def flat_order(df: DataFrame) -> DataFrame:
    return df.orderBy(*FLAT_ORDER)


def _order(*body: str) -> list[Column]:
    """Newest years first, then type, district and what follows."""
    return [F.desc("d_year_val"), F.col("d_lb_type_val"), F.col("d_district_index"), *map(F.col, body)]


def districts(model: Model) -> DataFrame:
    return model.districts.select(*DISTRICTS).orderBy(F.desc("year_val"), "lb_type_val", "district_index")


def bodies(model: Model) -> DataFrame:
    df = bodies_with_district(model).orderBy(*_order("lb_lb_index"))
    return df.select(*(F.col(ABOVE.get(c, f"lb_{c}")).alias(c) for c in BODIES))


def projects(model: Model) -> DataFrame:
    df = chain(model).orderBy(*_order("lb_lb_index", "p_project_no"))
    return df.select(*(F.col(ABOVE.get(c, f"p_{c}")).alias(c) for c in PROJECTS))


def pdfs(model: Model) -> DataFrame:
    above = chain(model, "p_id", "p_project_no", "p_project_name", "lb_lb_name", "lb_lb_index", "d_district_name", "d_year_label", "d_year_val", "d_lb_type_val", "d_district_index")
    pdf = model.pdfs.select(*(F.col(c).alias(f"pdf_{c}") for c in model.pdfs.columns))
    df = pdf.join(above, F.col("pdf_project_id") == F.col("p_id")).orderBy(*_order("lb_lb_index", "p_project_no"))
    of_project = {"project_no": "p_project_no", "project_name": "p_project_name"}
    return df.select(*(F.col((ABOVE | of_project).get(c, f"pdf_{c}")).alias(c) for c in PDFS))


RAW = {"districts": districts, "local_bodies": bodies, "projects": projects, "pdfs": pdfs}


def years(model: Model) -> DataFrame:
    """(year_val, year_label) of every year, newest first: what the flat export is divided by."""
    return model.districts.select("year_val", "year_label").distinct().orderBy(F.desc("year_val"))


def export_dir(base: str, at: dt.datetime) -> str:
    """The folder of an export that began at ``at``."""
    return f"{base}/{at:%Y%m%d_%H%M%S}"


def write_flat(model: Model, path: str, year: int | None = None, district: str | None = None) -> DataFrame:
    """One folder ``pdfs_flat_<year>.csv`` a year under ``path``, sorted over its part files; (file, rows) of each.

    All years are one plan and one write: ranges of (year, order) over the tasks, so a large year spreads over many part
    files that follow one another.
    """
    spark, keys = model.projects.sparkSession, ["year", *FLAT_ORDER]
    df = flat(model, year, district).withColumn("year", file_year(F.col("year_label")))
    df = df.repartitionByRange(*keys).sortWithinPartitions(*keys)
    staged = f"{path}/.pdfs_flat"
    df.write.mode("overwrite").option("header", True).option("emptyValue", "").option("nullValue", "").partitionBy("year").csv(staged)
    for status in _list(spark, staged):
        if status.isDirectory():
            name = unquote(status.getPath().getName().removeprefix("year="))
            _move(spark, status.getPath().toString(), f"{path}/pdfs_flat_{name}.csv")
    _delete(spark, staged)
    counted = flat(model, year, district).groupBy(file_year(F.col("year_label")).alias("year")).agg(F.count("*").alias("rows"))
    return counted.select(F.concat(F.lit("pdfs_flat_"), "year", F.lit(".csv")).alias("file"), "rows")


def write_raw(model: Model, path: str) -> dict[str, str]:
    """The per-table exports, each sorted over its part files; returns their paths."""
    out = {}
    for name, make in RAW.items():
        out[name] = f"{path}/{name}.csv"
        make(model).write.mode("overwrite").option("header", True).option("emptyValue", "").option("nullValue", "").csv(out[name])
    return out


def _path(spark: SparkSession, path: str):
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at, at.getFileSystem(spark._jsc.hadoopConfiguration())


def _list(spark: SparkSession, path: str):
    at, fs = _path(spark, path)
    return list(fs.listStatus(at)) if fs.exists(at) else []


def _delete(spark: SparkSession, path: str) -> None:
    at, fs = _path(spark, path)
    fs.delete(at, True)


def _move(spark: SparkSession, source: str, to: str) -> None:
    a, fs = _path(spark, source)
    b, _ = _path(spark, to)
    fs.delete(b, True)
    if not fs.rename(a, b):
        raise OSError(f"{source} could not be moved to {to}")


def upload(spark: SparkSession, path: str, uri: str) -> DataFrame:
    """Copies the CSV files of an export to ``uri``; (file, ok, bytes, error) of each. One file's failure leaves the others."""
    conf, copy = spark._jsc.hadoopConfiguration(), spark._jvm.org.apache.hadoop.fs.FileUtil.copy
    done = []
    for status in sorted(_list(spark, path), key=lambda s: s.getPath().getName()):
        name = status.getPath().getName()
        if not name.endswith(".csv"):
            continue
        _, fs = _path(spark, path)
        size = fs.getContentSummary(status.getPath()).getLength()
        try:
            to, there = _path(spark, f"{uri}/{name}")
            there.mkdirs(to.getParent())
            ok = bool(copy(fs, status.getPath(), there, to, False, True, conf))
            done.append((name, ok, size if ok else 0, None if ok else "not copied"))
        except Exception as e:  # noqa: BLE001 - whatever the store raises is this file's outcome
            done.append((name, False, 0, str(e).splitlines()[0]))
    return spark.createDataFrame(done, "file string, ok boolean, bytes long, error string")


def outcome(files: DataFrame) -> DataFrame:
    """Successes, failures and bytes of rows (ok, bytes)."""
    return files.agg(F.count_if("ok").alias("succeeded"), F.count_if(~F.col("ok")).alias("failed"), F.coalesce(F.sum(F.when(F.col("ok"), F.col("bytes"))), F.lit(0)).alias("bytes"))


def export_summary(counted: DataFrame) -> DataFrame:
    """(file, rows) of each file and a last row TOTAL, from rows (file, rows[, bytes]); bytes are shown in MB if there."""
    sums = [F.sum("rows").alias("rows")]
    if "bytes" in counted.columns:
        sums.append(F.round(F.sum("bytes") / 1024.0**2, 2).alias("mb"))
    df = counted.rollup("file").agg(*sums, F.grouping("file").alias("g"))
    return df.select(F.when(F.col("g") == 1, "TOTAL").otherwise(F.col("file")).alias("file"), *df.columns[1:-1])
