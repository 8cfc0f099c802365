"""Work-queue selections: rows to process, in order, and the claim of a batch."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tierflow.model import Model
from tierflow.plans import bodies_with_district, chain


def take(df: DataFrame, limit: int | None) -> DataFrame:
    """``limit`` of None or 0 takes all rows."""
    return df.limit(limit) if limit else df


def waiting(status: str, retry: str, statuses: tuple[str, ...], cap: int) -> Column:
    return F.col(status).isin(*statuses) & (F.col(retry) < cap)


def pending_districts(model: Model, limit: int | None = None, cap: int = 3) -> DataFrame:
    df = model.districts.where(waiting("status", "retry_count", ("PENDING", "ERROR"), cap))
    return take(df.orderBy(F.desc("year_val"), "lb_type_val", "district_index"), limit)


def pending_bodies(model: Model, limit: int | None = None, cap: int = 3) -> DataFrame:
    df = bodies_with_district(model).where(waiting("lb_status", "lb_retry_count", ("PENDING", "PARTIAL", "ERROR"), cap))
    df = take(df.orderBy(F.desc("d_year_val"), "d_id", "lb_lb_index"), limit)
    return df.select(*(F.col(f"lb_{c}").alias(c) for c in model.bodies.columns))


def pending_projects(model: Model, limit: int | None = None, cap: int = 3) -> DataFrame:
    df = chain(model).where(waiting("p_pdf_status", "p_pdf_retry_count", ("PENDING", "ERROR"), cap))
    df = take(df.orderBy(F.desc("d_year_val"), "lb_id", "p_project_no"), limit)
    return df.select(*(F.col(f"p_{c}").alias(c) for c in model.projects.columns))


def pending_projects_of(model: Model, body: str, cap: int = 3) -> DataFrame:
    """One body's projects; those under way count as waiting."""
    df = model.projects.where(F.col("local_body_id") == body).where(waiting("pdf_status", "pdf_retry_count", ("PENDING", "DOWNLOADING", "ERROR"), cap))
    return df.orderBy("page_number", "project_no")


def bodies_with_pending_pdfs(model: Model, limit: int | None = None, cap: int = 3) -> DataFrame:
    """(local_body_id, year_val), newest years first."""
    df = chain(model).where(waiting("p_pdf_status", "p_pdf_retry_count", ("PENDING", "DOWNLOADING", "ERROR"), cap))
    df = df.select(F.col("p_local_body_id").alias("local_body_id"), F.col("d_year_val").alias("year_val")).distinct()
    return take(df.orderBy(F.desc("year_val"), "local_body_id"), limit)


def claim(table: DataFrame, batch: DataFrame, status: str = "status", to: str = "IN_PROGRESS") -> tuple[DataFrame, DataFrame]:
    """(claimed ids, table with them marked) for a batch of rows with ids."""
    ids = batch.select("id").distinct()
    marked = table.join(ids.withColumn("_claimed", F.lit(True)), "id", "left")
    marked = marked.withColumn(status, F.when(F.col("_claimed"), to).otherwise(F.col(status))).drop("_claimed")
    return ids, marked.select(*table.columns)


def undiscovered(years: DataFrame, types: DataFrame, districts: DataFrame) -> DataFrame:
    """The (year_val, lb_type_val) of the two option lists that have no district yet.

    The product of two option lists is wanted here; both hold a handful of rows.
    """
    return years.select("year_val").crossJoin(types.select("lb_type_val")).join(districts.select("year_val", "lb_type_val").distinct(), ["year_val", "lb_type_val"], "left_anti")


def without_upload(model: Model) -> DataFrame:
    done = model.pdfs.where(F.col("status") == "UPLOADED").select(F.col("project_id").alias("id"))
    return model.projects.join(done, "id", "left_anti")


def with_upload(model: Model) -> DataFrame:
    done = model.pdfs.where(F.col("status") == "UPLOADED").select(F.col("project_id").alias("id"))
    return model.projects.join(done, "id", "left_semi")


def by_key(df: DataFrame, **key) -> DataFrame:
    """Rows of a natural key."""
    for name, value in key.items():
        df = df.where(F.col(name) == value)
    return df


def children_of(df: DataFrame, parent: str, value: str, *order: str) -> DataFrame:
    """The rows of one parent, in their order."""
    return df.where(F.col(parent) == value).orderBy(*order)


def exactly_one(df: DataFrame) -> DataFrame:
    """Fails where a key names several rows; reads two rows at most."""
    if len(df.limit(2).collect()) > 1:
        raise ValueError("several rows for one key")
    return df


def by_hash(model: Model, digest: str) -> DataFrame:
    """The document with the smallest id that has the content."""
    return model.pdfs.where(F.col("content_hash") == digest).orderBy("id").limit(1)


def duplicates(df: DataFrame, *key: str) -> DataFrame:
    """Keys that break uniqueness."""
    return df.groupBy(*key).agg(F.count("*").alias("n")).where("n > 1")
