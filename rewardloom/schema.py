"""Explicit schemas for the data model (no inference anywhere)."""

from pyspark.sql import types as T

# chat table: one row per chat, the whole conversation as JSON text, plus the
# optional last-update time (epoch seconds; NULL when the source lacks it).
# Ids are kept as found (text or integer) where the source has a type for them
# (parquet, JDBC); the types here are what untyped sources (JSON lines) are
# read with, unless the caller gives another schema.
CHAT = T.StructType([
    T.StructField("id", T.LongType()),
    T.StructField("user_id", T.LongType()),
    T.StructField("chat", T.StringType()),
    T.StructField("updated_at", T.LongType()),
])
OPTIONAL_COLUMNS = {"updated_at"}
ID_COLUMNS = {"id", "user_id"}

USER = T.StructType([
    T.StructField("id", T.LongType()),
    T.StructField("email", T.StringType()),
])

# chat -> history -> messages: JSON object keyed by message id; values kept
# as raw JSON text so each message is parsed once, later, and only if needed.
CHAT_DOC_DDL = "history struct<messages: map<string, string>>"

ANNOTATION = T.StructType([
    T.StructField("rating", T.StringType()),
    T.StructField("reason", T.StringType()),
    T.StructField("comment", T.StringType()),
])

MESSAGE = T.StructType([
    T.StructField("role", T.StringType()),
    T.StructField("model", T.StringType()),
    T.StructField("timestamp", T.StringType()),
    T.StructField("parentId", T.StringType()),
    T.StructField("content", T.StringType()),
    # raw JSON text of the annotation: parsed separately so that a
    # non-object annotation (e.g. ``false``) never nulls the whole message
    T.StructField("annotation", T.StringType()),
])

PARENT_DDL = "content string"

# the scored-response table fed back from generation (epoch, batch, q, r)
RESPONSES = T.StructType([
    T.StructField("doc_id", T.LongType()),
    T.StructField("epoch_no", T.LongType()),
    T.StructField("batch_idx", T.LongType()),
    T.StructField("question", T.StringType()),
    T.StructField("response", T.StringType()),
])
