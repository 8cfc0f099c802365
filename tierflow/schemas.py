"""The five-level model: run, district, local body, project, document."""

from __future__ import annotations

from pyspark.sql import types as T

RUN_STATUS = ("PENDING", "RUNNING", "COMPLETED", "FAILED", "CANCELLED")
DISTRICT_STATUS = ("PENDING", "IN_PROGRESS", "DONE", "ERROR")
BODY_STATUS = ("PENDING", "IN_PROGRESS", "PARTIAL", "DONE", "ERROR")
PDF_STATUS = ("PENDING", "DOWNLOADING", "DOWNLOADED", "MISSING", "ERROR")
UPLOAD_STATUS = ("PENDING", "UPLOADING", "UPLOADED", "FAILED")

S, I, L, TS = T.StringType(), T.IntegerType(), T.LongType(), T.TimestampNTZType()

# The columns of the five tables, in order, and whether they may be null.
RUNS = T.StructType(
    [
        T.StructField("id", S, False),
        T.StructField("current_phase", I, False),
        T.StructField("status", S, False),
        T.StructField("started_at", TS, True),
        T.StructField("completed_at", TS, True),
        T.StructField("error_message", S, True),
        T.StructField("created_at", TS, False),
    ]
)
DISTRICTS = T.StructType(
    [
        T.StructField("id", S, False),
        T.StructField("scrape_run_id", S, True),
        T.StructField("year_val", I, False),
        T.StructField("year_label", S, False),
        T.StructField("lb_type_val", I, False),
        T.StructField("lb_type_label", S, False),
        T.StructField("district_index", I, False),
        T.StructField("district_name", S, False),
        T.StructField("num_local_bodies", I, True),
        T.StructField("num_projects", I, True),
        T.StructField("postback_target", S, False),
        T.StructField("postback_argument", S, False),
        T.StructField("status", S, False),
        T.StructField("retry_count", I, False),
        T.StructField("error_message", S, True),
        T.StructField("discovered_at", TS, False),
        T.StructField("last_processed_at", TS, True),
    ]
)
BODIES = T.StructType(
    [
        T.StructField("id", S, False),
        T.StructField("district_id", S, False),
        T.StructField("lb_index", I, False),
        T.StructField("lb_name", S, False),
        T.StructField("expected_projects", I, True),
        T.StructField("scraped_projects", I, False),
        T.StructField("last_page_scraped", I, False),
        T.StructField("total_pages", I, True),
        T.StructField("postback_target", S, False),
        T.StructField("postback_argument", S, False),
        T.StructField("status", S, False),
        T.StructField("retry_count", I, False),
        T.StructField("error_message", S, True),
        T.StructField("discovered_at", TS, False),
        T.StructField("last_scraped_at", TS, True),
    ]
)
PROJECTS = T.StructType(
    [
        T.StructField("id", S, False),
        T.StructField("local_body_id", S, False),
        T.StructField("project_no", S, False),
        T.StructField("project_name", S, False),
        T.StructField("formulation", S, True),
        T.StructField("expense", S, True),
        T.StructField("page_number", I, False),
        T.StructField("select_argument", S, False),
        T.StructField("pdf_status", S, False),
        T.StructField("pdf_retry_count", I, False),
        T.StructField("pdf_error_message", S, True),
        T.StructField("pdf_last_attempt_at", TS, True),
        T.StructField("scraped_at", TS, False),
    ]
)
PDFS = T.StructType(
    [
        T.StructField("id", S, False),
        T.StructField("project_id", S, False),
        T.StructField("gcs_path", S, True),
        T.StructField("gcs_bucket", S, True),
        T.StructField("original_url", S, True),
        T.StructField("original_filename", S, True),
        T.StructField("redirect_url", S, True),
        T.StructField("file_size_bytes", L, True),
        T.StructField("content_hash", S, True),
        T.StructField("status", S, False),
        T.StructField("upload_error", S, True),
        T.StructField("downloaded_at", TS, True),
        T.StructField("uploaded_at", TS, True),
    ]
)
TABLES = {"scrape_runs": RUNS, "districts": DISTRICTS, "local_bodies": BODIES, "projects": PROJECTS, "pdfs": PDFS}

#: Natural keys, and what a conflict updates; every other column keeps the value of the stored row.
UPSERTS = {
    "districts": (("year_val", "lb_type_val", "district_index"), ("district_name", "num_local_bodies", "num_projects", "postback_argument")),
    "local_bodies": (("district_id", "lb_index"), ("lb_name", "expected_projects", "postback_argument")),
    "projects": (("local_body_id", "project_no"), ("project_name", "formulation", "expense", "select_argument")),
}

#: How tables are written, in place of indexes: ranges of the first columns over files, rows sorted by all of them, so that
#: the statistics of files and row groups prune lookups by parent, identity, status and hash.
LAYOUT = {
    "scrape_runs": ("created_at",),
    "districts": ("year_val", "lb_type_val", "district_index"),
    "local_bodies": ("district_id", "lb_index"),
    "projects": ("local_body_id", "project_no"),
    "pdfs": ("project_id", "content_hash"),
}
