"""The queries opN_<name> and pipeline, and the SQL that some of them can be held against."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tierflow.llm.base import table
from tierflow.llm import byte_bpe, chat, lm, quality as weak
from tierflow.llm.media import media_features
from tierflow.llm.near_dup import near_dup
from tierflow.llm.packing import pack_documents
from tierflow.llm.toxicity import toxicity
from tierflow.llm.warc import roundtrip
from tierflow.llm.wavelet import store_tokens


def op1_warc_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    return roundtrip(table(spark, sf_dir, "pages"))


def op2_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dup(table(spark, sf_dir, "documents"), 85)


def op3_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return byte_bpe.digest(byte_bpe.encode_documents(table(spark, sf_dir, "documents")))


def op4_media_archive(spark: SparkSession, sf_dir: str) -> DataFrame:
    return media_features(table(spark, sf_dir, "documents"))


def op5_bm25_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(table(spark, sf_dir, "documents"))


def op6_weak_supervision(spark: SparkSession, sf_dir: str) -> DataFrame:
    return weak.quality(table(spark, sf_dir, "documents"))


def op7_typed_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.chat_digests(table(spark, sf_dir, "conversations"))


def op8_gated_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm.score(table(spark, sf_dir, "documents"))


def op9_fst_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op10_wavelet_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    return store_tokens(table(spark, sf_dir, "documents"))


QUERIES = {f.__name__: f for f in (op1_warc_segments, op2_minhash_dedup, op3_byte_bpe, op4_media_archive, op5_bm25_packing, op6_weak_supervision, op7_typed_chat, op8_gated_lm, op9_fst_toxicity, op10_wavelet_tokens)}
_BASE32 = " || ".join(f"substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', CAST((v // {32**k}) % 32 + 1 AS INT), 1)" for k in (3, 2, 1, 0))
ORACLE: dict[str, str] = {
    "op1_warc_segments": f"""
WITH d AS (SELECT page_id, octet_length(encode(coalesce(html, ''))) AS n, sha1(coalesce(html, '')) AS s FROM pages),
m AS (SELECT s, max(page_id) AS top FROM d GROUP BY s),
v AS (SELECT s, g, CAST('0x' || substr(s, CAST(5 * g + 1 AS INT), 5) AS BIGINT) AS v FROM m, range(8) AS r(g)),
b AS (SELECT s, string_agg({_BASE32}, '' ORDER BY g) AS digest FROM v GROUP BY s)
SELECT page_id, CAST(n AS BIGINT) AS payload_bytes, digest AS payload_digest, CASE WHEN page_id = top THEN 'response' ELSE 'revisit' END AS record_type, CASE WHEN page_id <> top THEN top END AS refers_to
FROM d JOIN m USING (s) JOIN b USING (s)
""",
    "op2_minhash_dedup": r"""
WITH RECURSIVE w AS (SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents),
s AS (SELECT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')] ELSE list_distinct(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))) END) AS g FROM w),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM s AS a JOIN s AS b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY 1, 2),
e AS (SELECT a, b FROM p JOIN n AS x ON x.doc_id = a JOIN n AS y ON y.doc_id = b WHERE 100 * c >= 85 * (x.n + y.n - c)),
r(id, root) AS (SELECT doc_id, doc_id FROM w UNION SELECT e.b, r.root FROM r JOIN e ON e.a = r.id),
m AS (SELECT id, min(root) AS component_id FROM r GROUP BY id)
SELECT w.doc_id, CAST(coalesce(n.n, 0) AS BIGINT) AS n_shingles, m.component_id, w.doc_id = m.component_id AS kept FROM w JOIN m ON m.id = w.doc_id LEFT JOIN n ON n.doc_id = w.doc_id
""",
    "op6_weak_supervision": weak.ORACLE,
    "op7_typed_chat": chat.ORACLE,
}
