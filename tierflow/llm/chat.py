"""Chat formatting with typed content parts, in DataFrame expressions only.

A message holds ordered parts (type, text, ref, units). The visitor writes text parts with every control sign broken by an
escape, and image, audio and document parts as placeholders; attachments are recorded in order with the tokens that their
placeholder expands to. A turn reads ``<|turn|>role<|sep|>content<|end|>``; loss spans mark the assistant's contents.

Escape: after each ``<``, ``[`` and backslash stands a backslash, so that no control string survives inside a text, and
dropping it gives the text back.

Defined cases: null text, role or parts read as empty; turns are ordered by (turn, role, text) with null turns first;
repeated rows stay; a null conv_id is a conversation of its own; other part types count as documents; an empty table gives
no rows. A conversation is one row of the output and must fit one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tierflow.llm.base import Workspace

#: Tokens that one unit of an attachment expands to: an image tile, a second of audio, a page.
EXPANSION = {"image": 256, "audio": 25, "document": 512}
PARTS = "array<struct<type:string,text:string,ref:string,units:int>>"


def escape(text: Column) -> Column:
    return F.regexp_replace(text, r"([<\[\\])", "$1\\\\")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"([<\[\\])\\", "$1")


def text_parts(text: Column) -> Column:
    """One text part."""
    return F.array(F.struct(F.lit("text").alias("type"), F.coalesce(text.cast("string"), F.lit("")).alias("text"), F.lit(None).cast("string").alias("ref"), F.lit(0).alias("units"))).cast(PARTS)


def _kind(part: Column) -> Column:
    return F.when(part["type"].isin("text", *EXPANSION), part["type"]).otherwise("document")


def _units_tokens(part: Column) -> Column:
    per = F.when(_kind(part) == "image", EXPANSION["image"]).when(_kind(part) == "audio", EXPANSION["audio"]).otherwise(EXPANSION["document"])
    return (per * F.greatest(F.coalesce(part["units"], F.lit(1)), F.lit(1))).cast("long")


def visit(parts: Column) -> tuple[Column, Column]:
    """(content with placeholders, attachments) of a message's parts."""
    parts = F.coalesce(parts, F.array().cast(PARTS))
    written = F.transform(parts, lambda p: F.when(_kind(p) == "text", escape(F.coalesce(p["text"], F.lit("")))).otherwise(F.concat(F.lit("<|"), _kind(p), F.lit("|>"))))
    held = F.transform(F.filter(parts, lambda p: _kind(p) != "text"), lambda p: F.struct(_kind(p).alias("type"), p["ref"].alias("ref"), _units_tokens(p).alias("tokens")))
    return F.array_join(written, ""), held


def format_chat(messages: DataFrame) -> DataFrame:
    """(conv_id, formatted, loss_spans, attachments, expanded_tokens) from (conv_id, turn, role, parts).

    ``loss_spans`` are (start from 1, length) in code points of ``formatted``.
    """
    content, held = visit(F.col("parts"))
    rows = messages.select("conv_id", F.struct(F.col("turn"), F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"), content.alias("content"), held.alias("held")).alias("t"))
    conv = rows.groupBy("conv_id").agg(F.collect_list("t").alias("turns"))
    order = lambda a, b: F.when(a["turn"].eqNullSafe(b["turn"]), _less(a, b)).when(a["turn"].isNull(), -1).when(b["turn"].isNull(), 1).when(a["turn"] < b["turn"], -1).otherwise(1)
    conv = conv.select("conv_id", F.array_sort("turns", order).alias("turns"))
    pieces = F.transform("turns", lambda t: F.struct(F.concat(F.lit("<|turn|>"), escape(t["role"]), F.lit("<|sep|>")).alias("head"), t["content"].alias("body"), (t["role"] == "assistant").alias("loss")))
    conv = conv.select("conv_id", pieces.alias("pieces"), F.flatten(F.transform("turns", lambda t: t["held"])).alias("attachments"))
    start = F.struct(F.lit(1).cast("long").alias("at"), F.array().cast("array<struct<start:bigint,length:bigint>>").alias("spans"))
    end = len("<|end|>")

    def walk(acc: Column, p: Column) -> Column:
        body = acc["at"] + F.length(p["head"])
        span = F.array(F.struct(body.alias("start"), F.length(p["body"]).cast("long").alias("length")))
        return F.struct((body + F.length(p["body"]) + end).alias("at"), F.when(p["loss"], F.concat(acc["spans"], span)).otherwise(acc["spans"]).alias("spans"))

    spans = F.aggregate("pieces", start, walk)["spans"]
    formatted = F.array_join(F.transform("pieces", lambda p: F.concat(p["head"], p["body"], F.lit("<|end|>"))), "")
    tokens = F.aggregate("attachments", F.lit(0).cast("long"), lambda a, x: a + x["tokens"])
    return conv.select("conv_id", formatted.alias("formatted"), spans.alias("loss_spans"), "attachments", tokens.alias("expanded_tokens"))


def _less(a: Column, b: Column) -> Column:
    return F.when(a["role"] < b["role"], -1).when(a["role"] > b["role"], 1).when(a["content"] < b["content"], -1).when(a["content"] > b["content"], 1).otherwise(0)


def read_turns(formatted: Column) -> Column:
    """The turns (role, text) of a formatted conversation; placeholders stay in the text."""
    blocks = F.filter(F.split(formatted, r"<\|end\|>"), lambda x: x != "")
    halves = F.transform(blocks, lambda x: F.split(F.substring(x, len("<|turn|>") + 1, 2147483647), r"<\|sep\|>"))
    return F.transform(halves, lambda h: F.struct(unescape(h[0]).alias("role"), unescape(h[1]).alias("text")))


def read_back(output: DataFrame) -> DataFrame:
    """The digests of formatted conversations (conv_id, formatted, loss_spans)."""
    df = output.select("conv_id", "formatted", "loss_spans", read_turns(F.col("formatted")).alias("turns"))
    said = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    loss = F.array_join(F.transform("loss_spans", lambda s: unescape(F.substr(F.col("formatted"), s["start"].cast("int"), s["length"].cast("int")))), "")
    df = df.select("conv_id", F.size("turns").cast("long").alias("n_turns"), said.alias("said"), loss.alias("loss"), F.length("formatted").cast("long").alias("formatted_chars"))
    return df.select("conv_id", "n_turns", F.sha2(F.encode("said", "UTF-8"), 256).alias("turns_sha256"), F.length("loss").cast("long").alias("loss_chars"), F.sha2(F.encode("loss", "UTF-8"), 256).alias("loss_sha256"), "formatted_chars")


PROBE = "</s>[INST] ok [/INST]"


def chat_digests(conversations: DataFrame) -> DataFrame:
    """The query: all conversations and conversation -7, formatted, written and read back."""
    spark = conversations.sparkSession
    probe = spark.sql(f"SELECT * FROM VALUES (-7L, 0L, 'user', r'{PROBE}'), (-7L, 1L, 'assistant', r'{PROBE}') AS t(conv_id, turn, role, text)")
    rows = conversations.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), F.col("role").cast("string").alias("role"), F.col("text").cast("string").alias("text")).unionByName(probe)
    out = format_chat(rows.select("conv_id", "turn", "role", text_parts(F.col("text")).alias("parts")))
    return read_back(Workspace(spark, "chat").keep(out, "formatted"))


ORACLE = r"""
WITH rows AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'
), measured AS (
  SELECT *, length(role) + length(text) + length(regexp_replace(role || text, '[^<\[\\]', '', 'g')) + 22 AS chars FROM rows
)
SELECT conv_id, CAST(count(*) AS BIGINT) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
       CAST(coalesce(sum(CASE WHEN role = 'assistant' THEN length(text) END), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(CASE WHEN role = 'assistant' THEN text END, '' ORDER BY turn, role, text), '')) AS loss_sha256,
       CAST(sum(chars) AS BIGINT) AS formatted_chars
FROM measured GROUP BY conv_id
"""
