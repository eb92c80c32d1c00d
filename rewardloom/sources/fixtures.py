"""Input tables derived by Spark from the driver's parquet files.

The chat system stores one JSON document per chat; ``chat_table`` writes the
``conversations`` table into exactly that shape (real JSON text, so every
extraction query goes through the JSON path).  All derivations read whole
tables and whole texts.  Definitions are documented in FIXTURES.md; the one
deviation is that answers are whole document texts (no 400-character cut) and
every rated row gets a duplicate in ``rated_dup_table``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

BASE_EPOCH = 1704067200  # 2024-01-01 00:00:00 UTC


def _read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def user_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = _read(spark, sf_dir, "customer")
    return c.select(F.col("c_custkey").alias("id"),
                    F.concat(F.lower("c_name"), F.lit("@example.com")).alias("email"))


def message_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Relational view of the messages that go into the chat documents."""
    cv = _read(spark, sf_dir, "conversations")
    cid, turn = F.col("conv_id"), F.col("turn")
    return cv.select(
        cid.alias("chat_id"), turn, "role",
        F.when(cid % 11 == 0, F.lit(-1).cast("bigint")).otherwise(cid).alias("user_id"),
        F.when((cid + turn) % 17 == 0, F.lit("   "))
         .when(turn % 4 == 1, F.concat(F.lit("  "), "text", F.lit("\t")))
         .otherwise(F.col("text")).alias("content"),
        F.when((cid + turn) % 13 == 0, F.lit(None).cast("bigint"))
         .otherwise(F.lit(BASE_EPOCH) + (cid % 7) * 86400 + turn * 60 + cid).alias("epoch"),
        ((cid * 7 + turn * 3) % 10).alias("h"))


def _annotation_json(h, chat_id):
    """Annotation JSON text by variant ``h`` (NULL = key absent)."""
    return (F.when(h <= 4, F.concat(F.lit('{"rating":'), (h + 1).cast("string"),
                                    F.lit(',"reason":"r'), h.cast("string"), F.lit('"}')))
             .when((h == 5) & (chat_id % 2 == 0), F.lit('{"rating":"10","comment":"c"}'))
             .when(h == 5, F.lit('{"rating":"-1","comment":"c"}'))
             .when(h == 6, F.lit('{"rating":"n/a"}'))
             .when(h == 7, F.lit("null")))


def chat_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``id, user_id, chat, updated_at`` with chat =
    {"history":{"messages":{"m0":{..},..}}} and updated_at = the chat's newest
    message time (as a chat system bumps it on every message)."""
    m = message_rows(spark, sf_dir)
    body = F.to_json(F.struct(
        F.col("role"),
        F.when(F.col("turn") > 0, F.concat(F.lit("m"), (F.col("turn") - 1).cast("string"))).alias("parentId"),
        F.when(F.col("role") == "assistant",
               F.concat(F.lit("model-"), (F.col("chat_id") % 3).cast("string"))).alias("model"),
        F.col("content"),
        F.col("epoch").alias("timestamp")))
    ann = _annotation_json(F.col("h"), F.col("chat_id"))
    entry = F.when(ann.isNull(), body).otherwise(
        F.concat(body.substr(F.lit(1), F.length(body) - 1), F.lit(',"annotation":'), ann, F.lit("}")))
    kv = F.concat(F.lit('"m'), F.col("turn").cast("string"), F.lit('":'), entry)
    docs = (m.select("chat_id", "user_id", "turn", "epoch", kv.alias("kv"))
             .groupBy("chat_id", "user_id")
             .agg(F.sort_array(F.collect_list(F.struct("turn", "kv"))).alias("items"),
                  F.max("epoch").alias("updated_at")))
    return docs.select(
        F.col("chat_id").alias("id"), "user_id",
        F.concat(F.lit('{"history":{"messages":{'),
                 F.array_join(F.transform("items", lambda e: e["kv"]), ","),
                 F.lit("}}}")).alias("chat"),
        "updated_at")


def rated_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cleaned feedback stand-in: doc_id, question, answer, rating, epoch."""
    d = _read(spark, sf_dir, "documents")
    lab = _read(spark, sf_dir, "labels")
    return (d.join(lab, "doc_id")
             .select("doc_id",
                     F.concat(F.lit("Q "), "lang", F.lit(" "), "source").alias("question"),
                     F.col("text").alias("answer"),
                     (F.lit(1) + F.col("quality") * 3 + F.col("toxic") + F.col("doc_id") % 2)
                     .cast("double").alias("rating"),
                     (F.lit(BASE_EPOCH) + (F.col("doc_id") * 37) % 100000).alias("epoch")))


def rated_dup_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_duplicates(rated_table(spark, sf_dir))


def with_duplicates(r: DataFrame) -> DataFrame:
    """Every rated row plus a second rating of the same reward key (case and
    padding changed) that is newer, older or undated."""
    did = F.col("doc_id")
    dup = r.select((did + 1_000_000).alias("doc_id"), F.upper("question").alias("question"),
                   F.concat(F.lit(" "), "answer", F.lit("  ")).alias("answer"),
                   (F.lit(6.0) - F.col("rating")).alias("rating"),
                   F.when(did % 5 == 0, F.lit(None).cast("bigint"))
                    .when(did % 2 == 0, F.col("epoch") + 500)
                    .otherwise(F.col("epoch") - 500).alias("epoch"))
    return r.unionByName(dup)


def responses_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return responses_from(rated_table(spark, sf_dir))


def responses_from(r: DataFrame) -> DataFrame:
    """Generated responses to score: some new, some extended, some verbatim."""
    did = F.col("doc_id")
    return r.select(
        "doc_id", (did % 3).alias("epoch_no"), F.floor(did / 8).cast("bigint").alias("batch_idx"),
        "question",
        F.when(did % 4 == 0, F.concat(F.lit("new "), "answer"))
         .when(did % 4 == 1, F.concat("answer", F.lit(" tail")))
         .otherwise(F.col("answer")).alias("response"))


def prompt_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Prompt corpus: every document text, plus one blank prompt."""
    d = _read(spark, sf_dir, "documents").select(F.col("doc_id").alias("prompt_id"),
                                                 F.col("text").alias("prompt"))
    blank = spark.createDataFrame([(-1, "   ")], "prompt_id bigint, prompt string")
    return d.unionByName(blank)


def user_turns(spark: SparkSession, sf_dir: str) -> DataFrame:
    cv = _read(spark, sf_dir, "conversations")
    return cv.where(F.col("role") == "user").select("conv_id", "turn", "text")
