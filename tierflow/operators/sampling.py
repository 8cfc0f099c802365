"""Repeatable samples: the order is that of a hash of id and seed, the same on every cluster."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from tierflow.functions import format_currency, prefix, progress_text, status_icon, truncate
from tierflow.model import Model
from tierflow.operators.stats import exact_percentiles
from tierflow.plans import bodies_with_district, chain


def lot(seed: int, key: str = "id") -> Column:
    return F.sha2(F.concat_ws("/", F.col(key), F.lit(str(seed))), 256)


def sample(df: DataFrame, n: int, seed: int = 0, key: str = "id") -> DataFrame:
    """n rows: a top-k over the hash, not a sort of the table."""
    return df.orderBy(lot(seed, key), key).limit(n)


def per_group(df: DataFrame, n: int, by: tuple[str, ...], seed: int = 0, key: str = "id") -> DataFrame:
    """At most n rows of each group. Spark cuts groups to n rows before the shuffle (rank pushed below it)."""
    w = Window.partitionBy(*by).orderBy(lot(seed, key), key)
    return df.withColumn("_rank", F.row_number().over(w)).where(F.col("_rank") <= n).drop("_rank")


def children(df: DataFrame, parent: str, value: str, n: int, seed: int = 0) -> DataFrame:
    return sample(df.where(F.col(parent) == value), n, seed)


def uploaded_strata(model: Model, year_label: str, n: int, seed: int = 0) -> DataFrame:
    """n uploaded documents of each (district, type) of a year."""
    up = model.pdfs.where((F.col("status") == "UPLOADED") & F.col("gcs_path").isNotNull())
    df = up.join(chain(model, "p_id", "d_year_label", "d_district_name", "d_lb_type_label"), F.col("project_id") == F.col("p_id")).where(F.col("d_year_label") == year_label)
    df = df.select("id", "gcs_path", F.col("d_district_name").alias("district_name"), F.col("d_lb_type_label").alias("lb_type_label"))
    return per_group(df, n, ("district_name", "lb_type_label"), seed)


def cascade(model: Model, n: int, seed: int = 0) -> DataFrame:
    """n districts, n bodies of each, n projects of each of these."""
    d = sample(model.districts, n, seed).select(F.col("id").alias("district_id"))
    b = per_group(model.bodies.join(d, "district_id"), n, ("district_id",), seed).select("district_id", F.col("id").alias("local_body_id"))
    p = per_group(model.projects.join(b, "local_body_id"), n, ("local_body_id",), seed)
    return p.select("district_id", "local_body_id", F.col("id").alias("project_id"))


def by_size(model: Model, n: int, seed: int = 0) -> DataFrame:
    """n documents of the band around the median and n above the 95th percentile, the largest band first."""
    q = [F.lit(v) for v in exact_percentiles(model.pdfs, "file_size_bytes", (0.45, 0.55, 0.95, 0.99))]
    df, size = model.pdfs, F.col("file_size_bytes")
    band = F.when(size.between(q[0], q[1]), "median").when(size > q[3], "top99").when(size > q[2], "top95")
    df = df.withColumn("band", band).where("band is not null")
    top = df.where("band <> 'median'").orderBy(F.desc("band"), lot(seed), "id").limit(n)
    return df.where("band = 'median'").orderBy(lot(seed), "id").limit(n).unionByName(top).select("id", "band", "file_size_bytes")


def district_records(model: Model, n: int, seed: int = 0) -> DataFrame:
    """n districts as the sample report shows them."""
    d = sample(model.districts, n, seed)
    return d.select(
        status_icon(F.col("status"), "district").alias("icon"),
        *("id year_label lb_type_label district_name".split()),
        F.coalesce("num_local_bodies", F.lit(0)).alias("num_local_bodies"),
        *("num_projects status postback_target postback_argument discovered_at last_processed_at".split()),
    )


def body_records(model: Model, n: int, seed: int = 0) -> DataFrame:
    """n bodies with their district. The sample is taken before the join."""
    df = bodies_with_district(Model(model.runs, model.districts, sample(model.bodies, n, seed), model.projects, model.pdfs))
    return df.select(
        status_icon(F.col("lb_status"), "body").alias("icon"),
        *(F.col(f"lb_{c}").alias(c) for c in ("id", "lb_name", "lb_index")),
        F.concat("d_district_name", F.lit(" ("), "d_lb_type_label", F.lit(", "), "d_year_label", F.lit(")")).alias("parent"),
        progress_text(F.col("lb_scraped_projects"), F.col("lb_expected_projects")).alias("projects"),
        progress_text(F.col("lb_last_page_scraped"), F.col("lb_total_pages")).alias("pages"),
        F.col("lb_status").alias("status"),
        F.when(F.coalesce("lb_error_message", F.lit("")) == "", "None").otherwise(truncate(F.col("lb_error_message"), 50)).alias("error"),
        *(F.col(f"lb_{c}").alias(c) for c in ("discovered_at", "last_scraped_at")),
    )


def project_records(model: Model, n: int, seed: int = 0) -> DataFrame:
    """n projects with their body and district."""
    df = chain(Model(model.runs, model.districts, model.bodies, sample(model.projects, n, seed), model.pdfs))
    return df.select(
        status_icon(F.col("p_pdf_status"), "project").alias("icon"),
        *(F.col(f"p_{c}").alias(c) for c in ("id", "project_no")),
        truncate(F.col("p_project_name"), 60).alias("name"),
        format_currency(F.col("p_formulation")).alias("formulation"),
        format_currency(F.col("p_expense")).alias("expense"),
        *(F.col(f"p_{c}").alias(c) for c in ("page_number", "select_argument")),
        F.col("lb_lb_name").alias("lb_name"),
        F.concat("d_district_name", F.lit(" ("), "d_lb_type_label", F.lit(", "), "d_year_label", F.lit(")")).alias("location"),
        *(F.col(f"p_{c}").alias(c) for c in ("pdf_status", "pdf_retry_count")),
        F.when(F.coalesce("p_pdf_error_message", F.lit("")) == "", "None").otherwise(truncate(F.col("p_pdf_error_message"), 50)).alias("pdf_error"),
        F.col("p_scraped_at").alias("scraped_at"),
    )


def pdf_records(model: Model, n: int, seed: int = 0) -> DataFrame:
    """n documents with their project, body and district."""
    pdf = sample(model.pdfs, n, seed)
    above = chain(model, "p_id", "p_project_name", "p_project_no", "lb_lb_name", "d_district_name", "d_year_label")
    df = pdf.join(above, F.col("project_id") == F.col("p_id"))
    return df.select(
        status_icon(F.col("status"), "pdf").alias("icon"),
        "id",
        F.concat("p_project_no", F.lit(" - "), truncate(F.col("p_project_name"), 40)).alias("project"),
        F.col("lb_lb_name").alias("lb_name"),
        F.concat("d_district_name", F.lit(" ("), "d_year_label", F.lit(")")).alias("location"),
        F.coalesce("gcs_path", F.lit("Not uploaded")).alias("gcs_path"),
        F.coalesce("gcs_bucket", F.lit("N/A")).alias("gcs_bucket"),
        F.coalesce("original_filename", F.lit("N/A")).alias("filename"),
        F.format_string("%.1f KB", F.bround(F.coalesce("file_size_bytes", F.lit(0)) / 1024.0, 1)).alias("size"),
        F.coalesce(prefix(F.col("content_hash"), 16, dots=True), F.lit("N/A")).alias("hash"),
        "status",
        F.when(F.coalesce("upload_error", F.lit("")) == "", "None").otherwise(truncate(F.col("upload_error"), 50)).alias("error"),
        "downloaded_at",
        "uploaded_at",
    )


RECORDS = {"districts": district_records, "bodies": body_records, "projects": project_records, "pdfs": pdf_records}
