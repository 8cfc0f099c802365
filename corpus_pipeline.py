"""The corpus pipeline: toxicity, quality rules, near-duplicates, packing, each stage over what the one before kept.

Rows whose text is null or blank are clean, fail the base quality rule and go there. Extra columns are dropped on entry.
Rows that repeat a doc_id are one document: the near-duplicate stage keeps the one with the largest text, and of equal texts
that with the largest lang, source and n_chars. Rows without a doc_id name no document and go there too.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tierflow.llm.base import Workspace, table
from tierflow.llm.near_dup import near_dup
from tierflow.llm.packing import pack_documents
from tierflow.llm.quality import judge
from tierflow.llm.toxicity import without_toxic

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the pattern grammar scores at 0.5 or more go."""
    return without_toxic(docs.select(*COLUMNS), table(spark, sf_dir, "labels"))


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that fail the base rule or whose posterior quality is under one half go."""
    return judge(docs.select(*COLUMNS)).where("_q_kept").select(*COLUMNS)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near-duplicates (five words, similarity 0.8) the document with the smallest id stays."""
    ws, docs = Workspace(spark, "pipeline-dedup"), docs.select(*COLUMNS)
    kept = near_dup(docs).where("kept and doc_id is not null").groupBy("doc_id").agg(F.count("*").alias("rows"))
    kept = ws.keep(kept, "kept")
    # The ids are hashed, so that the texts stream past them unsorted; only repeated rows are brought together.
    named = docs.join(kept.where("rows = 1").hint("shuffle_hash"), "doc_id", "left_semi")
    if kept.where("rows > 1").limit(1).count():
        named = named.unionByName(docs.join(kept.where("rows > 1").hint("shuffle_hash"), "doc_id", "left_semi").groupBy("doc_id").agg(F.max(F.struct(*COLUMNS[1:])).alias("r")).select("doc_id", "r.*"))
    return named.select(*COLUMNS)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row per piece of the packed sequences."""
    return pack_documents(docs)


STAGES = [("toxicity", toxicity), ("quality", quality), ("near_dedup", near_dedup), ("packing", packing)]

#: DuckDB has no words for the trained stages; tests hold every stage, and run(), against plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    ws, docs = Workspace(spark, "pipeline"), table(spark, sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = ws.keep(docs, name)
    return docs
