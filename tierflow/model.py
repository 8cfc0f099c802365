"""The model's tables as DataFrames: from a directory of Parquet tables, from JDBC, or derived from the star schema."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F

from tierflow import schemas


@dataclass(frozen=True)
class Model:
    runs: DataFrame
    districts: DataFrame
    bodies: DataFrame
    projects: DataFrame
    pdfs: DataFrame

    def tables(self) -> dict[str, DataFrame]:
        return dict(zip(schemas.TABLES, (self.runs, self.districts, self.bodies, self.projects, self.pdfs), strict=True))


def read_model(spark: SparkSession, path: str) -> Model:
    """Tables written by ``write_model``, with the declared schemas: nothing is inferred."""
    return Model(*(spark.read.schema(s).parquet(f"{path}/{t}") for t, s in schemas.TABLES.items()))


def write_model(model: Model, path: str, mode: str = "errorifexists", clustered: bool = False) -> None:
    """Writes the tables; ``clustered`` lays them out by ``schemas.LAYOUT``, at the price of a shuffle and a sort."""
    for name, df in model.tables().items():
        if clustered:
            keys = schemas.LAYOUT[name]
            df = df.repartitionByRange(*keys).sortWithinPartitions(*keys)
        df.write.mode(mode).parquet(f"{path}/{name}")


def create_empty(spark: SparkSession, path: str) -> None:
    """Empty tables of the declared schemas."""
    write_model(Model(*(spark.createDataFrame([], s) for s in schemas.TABLES.values())), path)


def drop(spark: SparkSession, path: str) -> list[str]:
    """Deletes the tables under ``path`` and returns the names of those that were there; nothing else is touched."""
    hadoop, gone = spark._jvm.org.apache.hadoop.fs, []
    for name in schemas.TABLES:
        at = hadoop.Path(f"{path}/{name}")
        if at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True):
            gone.append(name)
    return gone


#: Versions of the stored schema: what each step up does, and what undoes it.
MIGRATIONS = [(create_empty, drop)]


def migrate(spark: SparkSession, path: str, have: int, to: int | None = None) -> int:
    """Brings the tables from version ``have`` to ``to`` (None: the newest), step by step up or down; returns the version."""
    to = len(MIGRATIONS) if to is None else to
    if not 0 <= to <= len(MIGRATIONS) or not 0 <= have <= len(MIGRATIONS):
        raise ValueError(f"versions go from 0 to {len(MIGRATIONS)}")
    for k in range(have, to):
        MIGRATIONS[k][0](spark, path)
    for k in range(have, to, -1):
        MIGRATIONS[k - 1][1](spark, path)
    return to


def key_ranges(column: str, keys: list[str]) -> list[str]:
    """Predicates that split a text key at the sorted ``keys``: half-open ranges, the first one with the nulls."""
    quoted = ["'" + k.replace("'", "''") + "'" for k in sorted(set(keys))]
    if not quoted:
        return ["1 = 1"]
    inner = [f"{column} >= {a} AND {column} < {b}" for a, b in zip(quoted, quoted[1:], strict=False)]
    return [f"{column} < {quoted[0]} OR {column} IS NULL", *inner, f"{column} >= {quoted[-1]}"]


def read_jdbc(spark: SparkSession, url: str, properties: dict[str, str], splits: list[str] | None = None) -> Model:
    """Tables of a relational database, read in ranges of the primary key that its index serves.

    ``splits``: keys at which the ranges part; None cuts ids that begin with a hexadecimal digit into sixteen ranges.
    """
    ranges = key_ranges("id", [f"{k:x}" for k in range(1, 16)] if splits is None else splits)
    return Model(*(spark.read.jdbc(url, t, predicates=ranges, properties=properties) for t in schemas.TABLES))


def _pick(number, values) -> F.Column:
    return F.element_at(F.array(*map(F.lit, values)), (F.pmod(number, F.lit(len(values))) + 1).cast("int"))


def derive(spark: SparkSession, sf_dir: str) -> Model:
    """The model over customers, orders and line items: a district is a (year, segment, nation), a body a (year, customer),
    a project an order and a document the lines of an order of medium priority."""
    read = lambda t: spark.read.parquet(f"{sf_dir}/{t}.parquet")
    customer, nation = read("customer"), read("nation")
    orders = read("orders").withColumn("y", F.year("o_orderdate"))
    segment = F.array_position(F.array(*map(F.lit, ("AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"))), F.col("c_mktsegment"))
    joined = orders.join(customer, orders["o_custkey"] == customer["c_custkey"]).join(nation, customer["c_nationkey"] == nation["n_nationkey"]).withColumn("seg", segment.cast("int"))
    district_id = F.concat_ws("-", "y", "seg", "c_nationkey")
    districts = joined.groupBy("y", "seg", "c_mktsegment", "c_nationkey", "n_name").agg(F.count_distinct("c_custkey").cast("int").alias("num_local_bodies"), F.count("*").cast("int").alias("num_projects"), F.max("o_orderdate").alias("last"), F.min("o_orderdate").alias("first"))
    status = _pick(F.col("y") + F.col("c_nationkey"), schemas.DISTRICT_STATUS)
    districts = districts.select(
        district_id.alias("id"),
        F.lit("run-0").alias("scrape_run_id"),
        F.col("y").alias("year_val"),
        F.concat_ws("-", "y", F.col("y") + 1).alias("year_label"),
        F.col("seg").alias("lb_type_val"),
        F.col("c_mktsegment").alias("lb_type_label"),
        (F.col("c_nationkey") + 1).cast("int").alias("district_index"),
        F.col("n_name").alias("district_name"),
        "num_local_bodies",
        "num_projects",
        F.lit("gvState").alias("postback_target"),
        F.concat(F.lit("Select$"), F.col("c_nationkey")).alias("postback_argument"),
        status.alias("status"),
        F.pmod(F.col("y") + F.col("c_nationkey"), F.lit(5)).cast("int").alias("retry_count"),
        F.when(status == "ERROR", F.concat(F.lit("no answer for "), F.col("n_name"))).alias("error_message"),
        F.col("first").alias("discovered_at"),
        F.when(F.col("c_nationkey") % 11 != 0, F.col("last")).alias("last_processed_at"),
    )
    bodies = joined.groupBy("y", "seg", "c_nationkey", "c_custkey", "c_name").agg(F.count("*").cast("int").alias("n"), F.max("o_orderdate").alias("last"), F.min("o_orderdate").alias("first"))
    status = _pick(F.col("c_custkey") + F.col("y"), schemas.BODY_STATUS)
    bodies = bodies.select(
        F.concat_ws("-", "y", "c_custkey").alias("id"),
        district_id.alias("district_id"),
        F.col("c_custkey").cast("int").alias("lb_index"),
        F.col("c_name").alias("lb_name"),
        F.col("n").alias("expected_projects"),
        (F.col("n") - F.col("c_custkey") % 2).cast("int").alias("scraped_projects"),
        (F.col("c_custkey") % 7).cast("int").alias("last_page_scraped"),
        F.lit(None).cast("int").alias("total_pages"),
        F.lit("gvStat").alias("postback_target"),
        F.concat(F.lit("Select$"), F.col("c_custkey") % 100).alias("postback_argument"),
        status.alias("status"),
        F.pmod(F.col("c_custkey") + F.col("y"), F.lit(4)).cast("int").alias("retry_count"),
        F.when(status == "ERROR", F.concat(F.lit("no table for "), F.col("c_name"))).alias("error_message"),
        F.col("first").alias("discovered_at"),
        F.when(F.col("c_custkey") % 11 != 0, F.col("last")).alias("last_scraped_at"),
    )
    key = F.col("o_orderkey")
    pdf_status = F.element_at(F.array(*map(F.lit, schemas.PDF_STATUS)), F.substring("o_orderpriority", 1, 1).cast("int"))
    projects = orders.select(
        key.cast("string").alias("id"),
        F.concat_ws("-", "y", "o_custkey").alias("local_body_id"),
        key.cast("string").alias("project_no"),
        F.concat(F.lit("Project "), key).alias("project_name"),
        F.round(F.col("o_totalprice")).cast("long").cast("string").alias("formulation"),
        F.when(key % 13 != 0, F.round(F.col("o_totalprice") / 2).cast("long").cast("string")).alias("expense"),
        (1 + key % 7).cast("int").alias("page_number"),
        F.concat(F.lit("Select$"), key % 20).alias("select_argument"),
        pdf_status.alias("pdf_status"),
        (key % 5).cast("int").alias("pdf_retry_count"),
        F.when(pdf_status == "ERROR", F.concat(F.lit("no file for "), key)).alias("pdf_error_message"),
        F.when(key % 11 != 0, F.col("o_orderdate")).alias("pdf_last_attempt_at"),
        F.col("o_orderdate").alias("scraped_at"),
    )
    medium = read("orders").where(F.col("o_orderpriority").startswith("3")).select("o_orderkey", "o_orderdate")
    lines = read("lineitem").join(medium, F.col("l_orderkey") == F.col("o_orderkey")).groupBy("o_orderkey", "o_orderdate")
    lines = lines.agg((F.sum("l_quantity").cast("long") * 1000).alias("size"), F.min("l_returnflag").alias("flag"), F.max("l_shipdate").alias("shipped"))
    status = F.when(F.col("flag") == "A", "PENDING").when(F.col("flag") == "N", "FAILED").otherwise("UPLOADED")
    pdfs = lines.select(
        F.concat(F.lit("pdf-"), key).alias("id"),
        key.cast("string").alias("project_id"),
        F.concat(F.lit("pdfs/"), key, F.lit(".pdf")).alias("gcs_path"),
        F.lit("archive").alias("gcs_bucket"),
        F.lit(None).cast("string").alias("original_url"),
        F.concat(key, F.lit(".pdf")).alias("original_filename"),
        F.lit(None).cast("string").alias("redirect_url"),
        F.col("size").alias("file_size_bytes"),
        F.sha2(key.cast("string"), 256).alias("content_hash"),
        status.alias("status"),
        F.when(status == "FAILED", "refused").alias("upload_error"),
        F.col("o_orderdate").alias("downloaded_at"),
        F.when(status == "UPLOADED", F.col("shipped")).alias("uploaded_at"),
    )
    k = F.col("r_regionkey")
    created = F.expr("timestamp_ntz '2024-01-01 00:00:00' + make_dt_interval(r_regionkey)")
    runs = read("region").select(
        F.concat(F.lit("run-"), k).alias("id"),
        (1 + k % 4).cast("int").alias("current_phase"),
        _pick(k, schemas.RUN_STATUS).alias("status"),
        F.when(k > 0, created).alias("started_at"),
        F.when(k == 2, created).alias("completed_at"),
        F.when(k == 3, "stopped").alias("error_message"),
        created.alias("created_at"),
    )
    return Model(runs, districts, bodies, projects, pdfs)


#: The same derivation in DuckDB's SQL, as common table expressions.
ORACLE = """
WITH o AS (SELECT *, year(o_orderdate) AS y FROM orders),
j AS (SELECT o.*, c_custkey, c_name, c_nationkey, c_mktsegment, n_name,
        list_position(['AUTOMOBILE','BUILDING','FURNITURE','HOUSEHOLD','MACHINERY'], c_mktsegment) AS seg
      FROM o JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey),
D AS (SELECT y || '-' || seg || '-' || c_nationkey AS id, 'run-0' AS scrape_run_id, y AS year_val, y || '-' || (y + 1) AS year_label,
        seg AS lb_type_val, c_mktsegment AS lb_type_label, c_nationkey + 1 AS district_index, n_name AS district_name,
        count(DISTINCT c_custkey) AS num_local_bodies, count(*) AS num_projects, 'gvState' AS postback_target,
        'Select$' || c_nationkey AS postback_argument, ['PENDING','IN_PROGRESS','DONE','ERROR'][1 + (y + c_nationkey) % 4] AS status,
        (y + c_nationkey) % 5 AS retry_count, CASE WHEN (y + c_nationkey) % 4 = 3 THEN 'no answer for ' || n_name END AS error_message,
        min(o_orderdate) AS discovered_at, CASE WHEN c_nationkey % 11 <> 0 THEN max(o_orderdate) END AS last_processed_at
      FROM j GROUP BY y, seg, c_mktsegment, c_nationkey, n_name),
LB AS (SELECT y || '-' || c_custkey AS id, y || '-' || seg || '-' || c_nationkey AS district_id, c_custkey AS lb_index, c_name AS lb_name,
        count(*) AS expected_projects, count(*) - c_custkey % 2 AS scraped_projects, c_custkey % 7 AS last_page_scraped, CAST(NULL AS INT) AS total_pages, 'gvStat' AS postback_target,
        ['PENDING','IN_PROGRESS','PARTIAL','DONE','ERROR'][1 + (c_custkey + y) % 5] AS status, (c_custkey + y) % 4 AS retry_count,
        CASE WHEN (c_custkey + y) % 5 = 4 THEN 'no table for ' || c_name END AS error_message, 'Select$' || (c_custkey % 100) AS postback_argument,
        min(o_orderdate) AS discovered_at, CASE WHEN c_custkey % 11 <> 0 THEN max(o_orderdate) END AS last_scraped_at
      FROM j GROUP BY y, seg, c_nationkey, c_custkey, c_name),
P AS (SELECT CAST(o_orderkey AS VARCHAR) AS id, y || '-' || o_custkey AS local_body_id, CAST(o_orderkey AS VARCHAR) AS project_no,
        'Project ' || o_orderkey AS project_name, CAST(CAST(round(o_totalprice) AS BIGINT) AS VARCHAR) AS formulation,
        CASE WHEN o_orderkey % 13 <> 0 THEN CAST(CAST(round(o_totalprice / 2) AS BIGINT) AS VARCHAR) END AS expense,
        1 + o_orderkey % 7 AS page_number, 'Select$' || (o_orderkey % 20) AS select_argument,
        ['PENDING','DOWNLOADING','DOWNLOADED','MISSING','ERROR'][CAST(substr(o_orderpriority, 1, 1) AS INT)] AS pdf_status,
        o_orderkey % 5 AS pdf_retry_count, CASE WHEN substr(o_orderpriority, 1, 1) = '5' THEN 'no file for ' || o_orderkey END AS pdf_error_message, CASE WHEN o_orderkey % 11 <> 0 THEN o_orderdate END AS pdf_last_attempt_at, o_orderdate AS scraped_at
      FROM o),
PDF AS (SELECT 'pdf-' || o_orderkey AS id, CAST(o_orderkey AS VARCHAR) AS project_id, 'pdfs/' || o_orderkey || '.pdf' AS gcs_path,
        'archive' AS gcs_bucket, CAST(NULL AS VARCHAR) AS original_url, CAST(NULL AS VARCHAR) AS redirect_url, o_orderdate AS downloaded_at,
        CASE WHEN min(l_returnflag) = 'N' THEN 'refused' END AS upload_error,
        o_orderkey || '.pdf' AS original_filename, CAST(sum(l_quantity) AS BIGINT) * 1000 AS file_size_bytes,
        sha256(CAST(o_orderkey AS VARCHAR)) AS content_hash,
        CASE min(l_returnflag) WHEN 'A' THEN 'PENDING' WHEN 'N' THEN 'FAILED' ELSE 'UPLOADED' END AS status,
        CASE WHEN min(l_returnflag) = 'R' THEN max(l_shipdate) END AS uploaded_at
      FROM lineitem JOIN orders ON l_orderkey = o_orderkey WHERE o_orderpriority LIKE '3%' GROUP BY o_orderkey, o_orderdate),
R AS (SELECT 'run-' || r_regionkey AS id, 1 + r_regionkey % 4 AS current_phase,
        ['PENDING','RUNNING','COMPLETED','FAILED','CANCELLED'][1 + r_regionkey % 5] AS status,
        TIMESTAMP '2024-01-01 00:00:00' + to_days(CAST(r_regionkey AS INT)) AS created_at,
        CASE WHEN r_regionkey > 0 THEN TIMESTAMP '2024-01-01 00:00:00' + to_days(CAST(r_regionkey AS INT)) END AS started_at,
        CASE WHEN r_regionkey = 2 THEN TIMESTAMP '2024-01-01 00:00:00' + to_days(CAST(r_regionkey AS INT)) END AS completed_at,
        CASE WHEN r_regionkey = 3 THEN 'stopped' END AS error_message FROM region)
"""
