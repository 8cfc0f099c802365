"""Sources and sinks: files of blobs, extraction documents, CSV artifacts, paginated readers."""

from __future__ import annotations

import re
import time
from collections.abc import Callable, Iterator
from typing import TypeVar

from pyspark.sql import DataFrame, SparkSession, functions as F

from tierflow.functions import content_hash, storage_path

T = TypeVar("T")
PROJECT = "struct<project_name:string,project_cost:double,cost_unit:string,cost_raw:string,source_page:int,project_category:string,main_area:string,sector:string,sub_sector:string,micro_sector:string>"
USAGE = "struct<input_tokens:bigint,output_tokens:bigint,total_tokens:bigint,input_cost_usd:double,output_cost_usd:double,total_cost_usd:double,latency_ms:bigint,model:string>"
RESULT = f"struct<total_pages:int,total_projects:int,document_title:string,document_date:string,issuing_authority:string,projects:array<{PROJECT}>,extraction_summary:string,warnings:array<string>,total_cost:double,cost_breakdown_by_category:map<string,double>,source_file:string,processed_at:string,llm_usage:{USAGE}>"
BATCH = f"extraction_date string, model_used string, results array<{RESULT}>"
CSV = {
    "manifest": "pdf_id string, gcs_path string, gcs_bucket string, file_size_bytes int, bucket string, year_label string, lb_type_label string, district_name string, local_body_name string, project_no string, era string",
    "quality": "pdf_id string, page_count int, tiles int, bucket string, n_t int, cost_t double, n_n int, cost_n double, out_n int, delta int, cost_savings double",
    "models": "model string, price_in double, price_out double, cost_per_pdf double, sample_cost double, corpus_standard double, corpus_batch double",
    "runs": "run string, schema string, n_pdfs int, n_errors int, notes string, mean_in double, mean_out double, mean_cost double, median_cost double, p90_cost double, p99_cost double, max_cost double, runaways int, mean_latency_sec double, sample_total double, corpus_std double, corpus_batch double, corpus_std_median double",
    "histogram": "bin_lo long, bin_hi long, bin_mid long, count long, cumulative_pct double",
}


def blobs(spark: SparkSession, root: str, prefix: str = "", most: int | None = None) -> DataFrame:
    """(path, modificationTime, length, content) of the files under ``root`` whose key, the path from there on, begins with
    ``prefix``; in the order of keys the first ``most``. Nothing there gives no rows.

    A prefix may end inside a folder's name. Characters with a meaning in patterns stand for themselves.
    """
    plain = re.sub(r"([\[\]{}*?\\^])", r"\\\1", prefix)
    pattern = f"{root.rstrip('/')}/{plain}*"
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(pattern)
    if not hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(hadoop):
        return spark.createDataFrame([], "path string, modificationTime timestamp, length long, content binary")
    df = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(pattern)
    return df.orderBy("path").limit(most) if most else df


def exists(spark: SparkSession, root: str, keys: DataFrame, key: str = "key") -> DataFrame:
    """``keys`` with a column ``exists``: whether there is a file of that key under ``root``. Lists once, joins once."""
    found = blobs(spark, root).select(F.col("path").alias("_path"))  # only names are read: the content is pruned
    at = spark._jvm.org.apache.hadoop.fs.Path(root)
    base = at.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(at).toString().rstrip("/")
    strip = lambda c: F.regexp_replace(c, "^[a-z0-9]+:/+", "/")  # noqa: E731 - file:/ and file:/// name one place
    found = found.select(F.substr(strip(F.col("_path")), F.length(strip(F.lit(base))) + 2).alias("_key"), F.lit(True).alias("_there"))
    return keys.join(found, keys[key] == found["_key"], "left").withColumn("exists", F.coalesce("_there", F.lit(False))).drop("_key", "_there")


def delete(spark: SparkSession, root: str, keys: list[str]) -> dict[str, bool]:
    """Deletes the files of the named keys; whether each was there."""
    out = {}
    for key in keys:
        if ".." in key.split("/") or not key.strip("/"):
            raise ValueError(f"not a key: {key!r}")
        at = spark._jvm.org.apache.hadoop.fs.Path(f"{root}/{key}")
        out[key] = bool(at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, False))
    return out


def upload_columns(df: DataFrame, data: str = "content") -> DataFrame:
    """Path, hash and size that an upload of a project's document records."""
    path = storage_path(*(F.col(c) for c in ("year_label", "lb_type_label", "district_name", "lb_name", "project_no")))
    return df.withColumn("gcs_path", path).withColumn("content_hash", content_hash(F.col(data))).withColumn("file_size_bytes", F.octet_length(data).cast("long"))


def materialise(df: DataFrame, folder: str, name: str = "gcs_path", data: str = "content") -> DataFrame:
    """Writes each row's bytes to ``folder``/name unless the file is there with the same size; (name, ok, bytes).

    Each partition writes its own rows through a temporary name, so a repeated task leaves whole files.
    """
    uri = folder if "://" in folder else f"file://{folder}"

    def run(batches) -> Iterator:
        import pandas as pd
        from pyarrow import fs

        store, root = fs.FileSystem.from_uri(uri)
        for pdf in batches:
            done = []
            for n, b in zip(pdf[name], pdf[data], strict=True):
                if n is None or b is None or ".." in n.split("/"):
                    done.append((n, False, 0))
                    continue
                path = f"{root}/{n}"
                info = store.get_file_info(path)
                if info.type == fs.FileType.NotFound or info.size != len(b):
                    store.create_dir(path.rpartition("/")[0], recursive=True)
                    with store.open_output_stream(f"{path}.part") as f:
                        f.write(bytes(b))
                    store.move(f"{path}.part", path)
                done.append((n, True, len(b)))
            yield pd.DataFrame(done, columns=["name", "ok", "bytes"])

    return df.select(name, data).mapInPandas(run, "name string, ok boolean, bytes long")


def extraction(spark: SparkSession, path: str) -> DataFrame:
    """One row per extracted project of a batch document, beside its result's file, pages, cost and latency."""
    df = spark.read.schema(BATCH).option("multiLine", True).json(path).select("extraction_date", "model_used", F.explode("results").alias("r"))
    df = df.select("extraction_date", "model_used", F.col("r.source_file").alias("source_file"), F.col("r.total_pages").alias("total_pages"), F.col("r.llm_usage.total_cost_usd").alias("cost_usd"), F.col("r.llm_usage.latency_ms").alias("latency_ms"), F.explode_outer("r.projects").alias("p"))
    return df.select("*", "p.*").drop("p")


#: Tables whose headers are no column names: read by position.
BY_POSITION = ("models", "runs")


def csv(spark: SparkSession, path: str, kind: str) -> DataFrame:
    """A table of a kind in CSV; its header must match unless the kind is read by position."""
    return spark.read.schema(CSV[kind]).option("header", True).option("enforceSchema", kind in BY_POSITION).csv(path)


def retrying(read: Callable[[], T], attempts: int = 8, first: float = 2.0, most: float = 180.0, errors: tuple[type[Exception], ...] = (OSError,), sleep: Callable[[float], None] = time.sleep) -> T:
    """The result of ``read``, tried again after one of ``errors`` with pauses that double from ``first`` to ``most`` seconds."""
    for k in range(attempts):
        try:
            return read()
        except errors:
            if k == attempts - 1:
                raise
            sleep(min(first * 2**k, most))
    raise ValueError("no attempt")


def paginated(fetch: Callable[[object, int], tuple[list[dict], int | None]], parent: object, first: int = 1, expected: int | None = None, have: int = 0) -> Iterator[tuple[int, list[dict]]]:
    """(page, rows) from a fetching function (parent, page) -> (rows, next page or None): stops at the last page, at a page
    seen before, and once ``expected`` distinct rows have come. For use inside ``mapInPandas`` over parents."""
    seen: set[int] = set()
    page: int | None = first
    while page is not None and page not in seen:
        seen.add(page)
        rows, following = fetch(parent, page)
        have += len(rows)
        yield page, rows
        if expected and have >= expected:
            return
        page = following


def scrape(bodies: DataFrame, fetch: Callable[[object, int], tuple[list[dict], int | None]], row_schema: str, parallel: int | None = None) -> DataFrame:
    """(local_body_id, page, scraped, row) of the bodies' pages, each from its stored checkpoint on.

    A body begins at its last page, which is read again, and counts on from its stored number, so a resumed body counts that
    page's rows twice; rows are upserted by their natural key, so they are stored once. ``parallel``: most bodies read at a
    time; one body is one task's work, page after page.
    """
    cols = bodies.select("id", "last_page_scraped", "scraped_projects", "expected_projects")
    cols = cols.repartition(parallel) if parallel else cols

    def run(batches):
        import pandas as pd

        for pdf in batches:
            for b, page, have, expected in zip(*(pdf[c] for c in pdf.columns), strict=True):
                have = int(have or 0)
                for number, rows in paginated(fetch, b, max(int(page or 0), 1), None if expected != expected or expected is None else int(expected), have):
                    have += len(rows)
                    yield pd.DataFrame({"local_body_id": [b], "page": [number], "scraped": [have], "rows": [rows]})

    return cols.mapInPandas(run, f"local_body_id string, page int, scraped int, rows array<struct<{row_schema}>>")


def checkpoints(pages: DataFrame) -> DataFrame:
    """(id, page, scraped) of scraped pages (local_body_id, page, scraped): what ``set_progress`` stores after each batch."""
    last = F.max(F.struct("scraped", "page"))
    return pages.groupBy(F.col("local_body_id").alias("id")).agg(last.alias("_l")).select("id", F.col("_l.page").alias("page"), F.col("_l.scraped").alias("scraped"))
