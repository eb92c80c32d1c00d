"""Message extraction from chat JSON documents.

Plan shape (one narrow stage per chat partition, then one shuffle):

    scan chat
      -> from_json(chat) once
      -> keep the messages asked for (key-presence test) inside the message array, and only for
         those find the parent: a binary search in the chat's sorted message ids
      -> posexplode -> from_json(message), from_json(annotation), from_json(parent) -> project small columns
      -> cutoff on the message time
      -> join users (broadcast when small, else shuffle of extracted rows only)
      -> sort on ``seq`` only at the very end (E9) or top-k (E10).

Exploded rows carry their own and their parent's JSON, never the chat's
message map; the user join happens after extraction, so chat documents are
never shuffled.  A chat of n messages costs n log n.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame, functions as F

from rewardloom import schema as S
from rewardloom.config import DEFAULT_SETTINGS
from rewardloom.functions.jsonx import has_key
from rewardloom.functions.order import seq_col

FEEDBACK_COLUMNS = ["email", "model", "datetime", "rating", "reason", "comment", "question", "answer"]
UNRATED_COLUMNS = ["chat_id", "message_id", "email", "model", "datetime", "question", "answer"]


# -- E1 / E4 -----------------------------------------------------------------
def _chat_messages(chat: DataFrame) -> DataFrame:
    doc = F.from_json(F.col("chat"), S.CHAT_DOC_DDL)
    return chat.select(F.col("id").alias("chat_id"), "user_id", doc["history"]["messages"].alias("msgs"))


def explode_messages(chat: DataFrame) -> DataFrame:
    """One row per message in document order: chat_id, user_id, msg_pos,
    message_id, raw (message JSON text).

    Chats whose ``history.messages`` is missing, not an object or malformed
    give no rows (see ``extract_profile`` for the count).
    ``posexplode_outer`` + ``message_id IS NOT NULL`` keeps the chat document
    parsed exactly once in the optimized plan.
    """
    out = _chat_messages(chat).select("chat_id", "user_id", F.posexplode_outer("msgs").alias("msg_pos", "message_id", "raw"))
    return out.where(F.col("message_id").isNotNull())


def explode_with_parent(chat: DataFrame, keep=None, outer: bool = False) -> DataFrame:
    """``explode_messages`` of the messages whose JSON text ``keep`` accepts
    (all, if None), with parent_raw: the JSON text of the message that
    ``parentId`` names in the same chat, NULL if none does.  Of messages with
    one id the first in the document counts.

    Ids are sorted once per chat, and a parent is found by binary search, so
    neither a scan of the chat per message nor a shuffle of messages is
    needed.  ``outer`` keeps a chat without such messages as one row of NULLs.  ``ids`` is used twice below so that the optimizer keeps it as a
    column of its own instead of sorting again for every step of a search.
    """
    entries = F.transform(F.map_entries("msgs"), lambda e, i: F.struct(
        i.alias("pos"), e["key"].alias("message_id"), e["value"].alias("raw")))
    rows = _chat_messages(chat).select("chat_id", "user_id", entries.alias("entries"))
    rows = rows.select("*", F.array_sort(F.transform("entries", lambda e: F.struct(e["message_id"].alias("message_id"), e["pos"].alias("pos")))).alias("ids"))
    steps = F.sequence(F.lit(1), F.ceil(F.log2(F.size("ids") + 1)).cast("int") + 1)

    def found(parent):
        # least place whose id is not below the parent's id
        def half(s, _):
            mid = ((s["low"] + s["high"]) / 2).cast("int")
            below = F.get("ids", mid)["message_id"] < parent
            return F.when(s["low"] >= s["high"], s).otherwise(F.struct(
                F.when(below, mid + 1).otherwise(s["low"]).alias("low"), F.when(below, s["high"]).otherwise(mid).alias("high")))

        place = F.aggregate(steps, F.struct(F.lit(0).alias("low"), F.size("ids").alias("high")), half, lambda s: s["low"])
        return F.transform(F.array(place), lambda p: F.when(F.get("ids", p)["message_id"] == parent,
                                                            F.get("entries", F.get("ids", p)["pos"])["raw"]))[0]

    kept = F.filter("entries", lambda e: keep(e["raw"])) if keep else F.col("entries")
    asked = F.transform(kept, lambda e: F.struct(e.alias("e"), F.get_json_object(e["raw"], "$.parentId").alias("parent")))
    looked = F.transform(asked, lambda a: F.struct(a["e"].alias("e"), F.when(a["parent"].isNotNull(), found(a["parent"])).alias("parent_raw")))
    # explode_outer and a test of its result: a plain explode would add a filter that parses the chat again
    out = rows.select("chat_id", "user_id", F.explode_outer(looked).alias("x"))
    out = out if outer else out.where(F.col("x").isNotNull())
    return out.select("chat_id", "user_id", F.col("x.e.pos").alias("msg_pos"), F.col("x.e.message_id").alias("message_id"),
                      F.col("x.e.raw").alias("raw"), F.col("x.parent_raw").alias("parent_raw"))


# -- E2 / E3 / E4 ------------------------------------------------------------
def _message_struct(raw: Column) -> Column:
    return F.from_json(raw, S.MESSAGE)


# seconds that a TIMESTAMP (microseconds in 64 bits) can hold
MIN_SECONDS, MAX_SECONDS = -(2**63) // 1_000_000 + 1, (2**63 - 1) // 1_000_000


def epoch_seconds(ts_text: Column) -> Column:
    """Epoch seconds of a timestamp text; NULL for non-integer text and for
    seconds that no TIMESTAMP holds."""
    n = ts_text.try_cast("bigint")
    return F.when(n.between(MIN_SECONDS, MAX_SECONDS), n)


def message_time(ts_text: Column) -> Column:
    """Epoch seconds text -> TIMESTAMP; bad times -> NULL (counted by
    ``extract_profile``)."""
    return F.timestamp_seconds(epoch_seconds(ts_text))


def message_fields(exploded: DataFrame) -> DataFrame:
    """E2–E4 over exploded messages: one ``from_json`` each for the message,
    its annotation and, where the rows carry it, its parent (question is NULL
    otherwise).  Each gets its own projection so the optimizer keeps one per
    value instead of one per extracted field.  (The key-presence and
    ``parentId`` tests before it walk the message text too.)"""
    staged = exploded.select("*", _message_struct(F.col("raw")).alias("m"))
    parent = F.from_json(F.col("parent_raw"), S.PARENT_DDL) if "parent_raw" in exploded.columns \
        else F.lit(None).cast(f"struct<{S.PARENT_DDL.replace(' ', ':')}>")
    staged = staged.select("*", F.from_json(F.col("m.annotation"), S.ANNOTATION).alias("a"), parent.alias("p"))
    return staged.select(
        "chat_id", "user_id", "msg_pos", "message_id",
        F.col("m.role").alias("role"), F.col("m.model").alias("model"),
        F.col("m.timestamp").alias("timestamp_text"),
        message_time(F.col("m.timestamp")).alias("datetime"),
        F.col("m.parentId").alias("parent_id"),
        F.col("a.rating").alias("rating"), F.col("a.reason").alias("reason"),
        F.col("a.comment").alias("comment"),
        F.col("p.content").alias("question"),
        F.col("m.content").alias("answer"))


# -- E5 ----------------------------------------------------------------------
def join_user(rows: DataFrame, users: DataFrame) -> DataFrame:
    """Inner join on ``user_id = users.id``; rows without a user drop out.
    The planner/AQE picks broadcast-hash when the user side is small and a
    skew-split sort-merge join otherwise."""
    u = users.select(F.col("id").alias("user_id"), "email")
    return rows.join(u, "user_id", "inner")


# -- E6 / E7 -----------------------------------------------------------------
def is_rated(raw: Column) -> Column:
    """The message JSON has an ``annotation`` key (a JSON null counts)."""
    return has_key(raw, "annotation")


def is_unrated(raw: Column) -> Column:
    """No ``annotation`` key and role = 'assistant'."""
    return ~has_key(raw, "annotation") & F.coalesce(F.get_json_object(raw, "$.role") == F.lit("assistant"), F.lit(False))


def rated_filter(exploded: DataFrame) -> DataFrame:
    return exploded.where(is_rated(F.col("raw")))


def unrated_filter(exploded: DataFrame) -> DataFrame:
    return exploded.where(is_unrated(F.col("raw")))


# -- E8 ----------------------------------------------------------------------
def as_of_col(as_of) -> Column:
    if as_of is None:
        return F.current_timestamp()
    if isinstance(as_of, Column):
        return as_of
    if isinstance(as_of, _dt.datetime):
        if as_of.tzinfo is None:
            as_of = as_of.replace(tzinfo=_dt.timezone.utc)
        return F.timestamp_seconds(F.lit(int(as_of.timestamp())))
    return F.timestamp_seconds(F.lit(int(as_of)))


def _cutoff(days_back: int, as_of) -> Column:
    return as_of_col(as_of) - F.make_dt_interval(F.lit(int(days_back)))


def recency_filter(df: DataFrame, days_back: int | None, as_of=None,
                   ts_col: str = "datetime") -> DataFrame:
    """Keep ``datetime > as_of - days_back days``; a falsy ``days_back``
    (None or 0) means no cutoff, so undated rows stay."""
    if not days_back:
        return df
    return df.where(F.col(ts_col) > _cutoff(days_back, as_of))


def recent_chats(chat: DataFrame, days_back: int | None, as_of=None, updated_col: str = "updated_at") -> DataFrame:
    """Chat-level pre-filter for a cutoff, for sources that promise that
    ``updated_col`` (epoch seconds) is never older than the chat's newest
    message time: ``updated_col IS NULL OR updated_col > cutoff`` then keeps
    every chat that can contribute.  Unlike the message time (inside the JSON)
    this column reaches the scan: row groups and partitions of old chats are
    skipped.  Never applied unless the caller asks: on a source that breaks
    the promise it would lose rows."""
    if not days_back:
        return chat
    cut = F.unix_seconds(_cutoff(days_back, as_of))
    return chat.where(F.col(updated_col).isNull() | (F.col(updated_col) > cut))


# -- ordering helpers (E9 / E10) ---------------------------------------------
def with_seq(df: DataFrame) -> DataFrame:
    return df.withColumn("seq", seq_col(F.unix_seconds("datetime"), "chat_id", "msg_pos"))


def newest_first(df: DataFrame) -> DataFrame:
    """``datetime DESC NULLS FIRST`` with a total tie-break."""
    return df.orderBy("seq")


def top_n(df: DataFrame, n: int) -> DataFrame:
    """First ``n`` in source order (plans as TakeOrderedAndProject)."""
    return df.orderBy("seq").limit(int(n))


# -- E11 / E12 ---------------------------------------------------------------
def feedback_rows(chat: DataFrame, users: DataFrame, days_back: int | None = None,
                  as_of=None, updated_col: str | None = None) -> DataFrame:
    """Unsorted feedback rows with identity and ``seq`` columns.
    ``updated_col`` opts in to the chat-level pre-filter (``recent_chats``)."""
    if updated_col:
        chat = recent_chats(chat, days_back, as_of, updated_col)
    rows = message_fields(explode_with_parent(chat, is_rated))
    rows = recency_filter(rows, days_back, as_of)
    rows = join_user(rows, users)
    rows = with_seq(rows)
    return rows.select("chat_id", "msg_pos", "message_id", "role", *FEEDBACK_COLUMNS, "seq")


def extract_feedback(chat: DataFrame, users: DataFrame, days_back: int | None = None,
                     as_of=None, sort: bool = True, updated_col: str | None = None) -> DataFrame:
    """Rated messages with email, model, datetime, rating, reason,
    comment, question (parent content) and answer, newest first."""
    rows = feedback_rows(chat, users, days_back, as_of, updated_col)
    return newest_first(rows) if sort else rows


def unrated_rows(chat: DataFrame, users: DataFrame) -> DataFrame:
    rows = message_fields(explode_with_parent(chat, is_unrated))
    rows = with_seq(join_user(rows, users))
    return rows.select("msg_pos", *UNRATED_COLUMNS, "seq")


def extract_unrated(chat: DataFrame, users: DataFrame,
                    limit: int = DEFAULT_SETTINGS.unrated_limit) -> DataFrame:
    """Assistant messages without an annotation, newest first, top ``limit``."""
    return top_n(unrated_rows(chat, users), limit)


# -- E13 / E14 ---------------------------------------------------------------
def extract_profile(chat: DataFrame) -> DataFrame:
    """E13 in one aggregation pass (no user join, as in the source):
    chats, annotated messages (JSON-null annotations among them), chats whose
    message map could not be read, and timestamps that are not integers or out of
    range.
    The bad-chat flag is computed per chat before the explode, so exploded
    rows carry a boolean rather than the chat text or its message map."""
    doc = F.from_json(F.col("chat"), S.CHAT_DOC_DDL)
    per_chat = chat.select(doc["history"]["messages"].alias("msgs"), F.col("chat").isNotNull().alias("has_doc"))
    per_chat = per_chat.select("msgs", (F.col("msgs").isNull() & F.col("has_doc")).alias("bad"))
    ex = per_chat.select("bad", F.posexplode_outer("msgs").alias("msg_pos", "message_id", "raw"))
    annotated = has_key(F.col("raw"), "annotation")
    parsed = F.from_json(F.col("raw"), "annotation string, timestamp string")
    ex = ex.select("bad", "msg_pos", annotated.alias("annotated"), parsed.alias("p"))
    return ex.agg(
        F.count_if(F.coalesce(F.col("msg_pos") == 0, F.lit(True))).alias("chats"),
        F.count_if("annotated").alias("annotated"),
        F.count_if(F.col("annotated") & F.col("p.annotation").isNull()).alias("annotated_json_null"),
        F.count_if(F.col("msg_pos").isNull() & F.col("bad")).alias("bad_chats"),
        F.count_if(F.col("p.timestamp").isNotNull()
                   & epoch_seconds(F.col("p.timestamp")).isNull()).alias("bad_timestamps"))


def feedback_preview(feedback: DataFrame, n: int = DEFAULT_SETTINGS.preview_rows,
                     chars: int = DEFAULT_SETTINGS.preview_chars) -> DataFrame:
    """First ``n`` feedback rows in source order, texts cut to ``chars``."""
    return (top_n(feedback, n)
            .select("chat_id", "msg_pos", "rating",
                    F.left("question", F.lit(chars)).alias("question_preview"),
                    F.left("answer", F.lit(chars)).alias("answer_preview")))


def raw_message_sample(chat: DataFrame, chars: int = DEFAULT_SETTINGS.raw_preview_chars) -> DataFrame:
    """E14 (raw): one annotated message's JSON text cut to ``chars``; the first
    by (chat id, position) so the sample is deterministic."""
    ex = rated_filter(explode_messages(chat))
    return (ex.orderBy("chat_id", "msg_pos").limit(1)
              .select("chat_id", "msg_pos", F.left("raw", F.lit(chars)).alias("raw_preview")))
