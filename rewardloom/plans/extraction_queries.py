"""Registered extraction queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from rewardloom import schema as S
from rewardloom.operators import extract as E
from rewardloom.plans.inputs import chat_and_users, epoch_of
from rewardloom.plans.registry import query
from rewardloom.sources.tables import even_splits, split_predicates

AS_OF_EPOCH = 1704067200 + 7 * 86400   # 2024-01-08 00:00:00 UTC
DAYS_BACK = 3
TOPN = 20

FEEDBACK_OUT = ["chat_id", "msg_pos", "message_id", "role", "email", "model",
                "rating", "reason", "comment", "question", "answer"]
FEEDBACK_SQL = ", ".join(FEEDBACK_OUT[:-1]) + ", content AS answer"


def _feedback_out(df):
    return df.select(*FEEDBACK_OUT, epoch_of("datetime", "epoch"))


@query("src_chat", """
SELECT chat_id AS id, max(user_id) AS user_id, count(*) AS n_messages
FROM fx_messages GROUP BY chat_id""")
def src_chat(spark, sf):
    chat, _ = chat_and_users(spark, sf)
    msgs = F.from_json("chat", S.CHAT_DOC_DDL)["history"]["messages"]
    return chat.select("id", "user_id", F.size(msgs).cast("bigint").alias("n_messages"))


@query("src_even_slices", """
SELECT count(*) AS n_rows, CAST(count_if(chat_id % 50 = 0) AS BIGINT) AS n_null, true AS none_twice_the_mean
FROM (SELECT DISTINCT chat_id FROM fx_messages)""")
def src_even_slices(spark, sf):
    """The slices that a JDBC read of text ids would be split into, by counting each: all rows, the NULL slice, and whether
    no other holds more than twice the mean."""
    chat, _ = chat_and_users(spark, sf)
    ids = chat.select(F.when(F.col("id") % 50 != 0, F.concat(F.lit("chat-"), F.col("id").cast("string"))).alias("id"))
    slices = split_predicates(even_splits(ids, 8))
    counts = ids.agg(*[F.count_if(F.expr(p)).alias(f"s{i}") for i, p in enumerate(slices)])
    sizes = [F.col(f"s{i}") for i in range(len(slices))]
    filled = sum(sizes[:-1], F.lit(0))
    return counts.select((filled + sizes[-1]).alias("n_rows"), sizes[-1].alias("n_null"),
                         (F.greatest(*sizes[:-1], F.lit(0)) * (len(slices) - 1) <= 2 * filled).alias("none_twice_the_mean"))


@query("explode_messages", """
SELECT chat_id, user_id, msg_pos, message_id FROM fx_msg""")
def explode_messages(spark, sf):
    chat, _ = chat_and_users(spark, sf)
    return E.explode_messages(chat).select("chat_id", "user_id", "msg_pos", "message_id")


@query("message_fields", """
SELECT chat_id, msg_pos, role, model, CAST(epoch AS VARCHAR) AS timestamp_text,
       rating, reason, comment, content AS answer FROM fx_msg""")
def message_fields(spark, sf):
    chat, _ = chat_and_users(spark, sf)
    f = E.message_fields(E.explode_messages(chat))
    return f.select("chat_id", "msg_pos", "role", "model", "timestamp_text",
                    "rating", "reason", "comment", "answer")


@query("message_time", """
SELECT chat_id, msg_pos, CAST(epoch AS DOUBLE) AS epoch,
       strftime(make_timestamp(fx_msg.epoch * CAST(1000000 AS BIGINT)), '%Y-%m-%d %H:%M:%S') AS utc_text
FROM fx_msg""")
def message_time(spark, sf):
    chat, _ = chat_and_users(spark, sf)
    ex = E.explode_messages(chat)
    ts = E.message_time(F.from_json("raw", "timestamp string")["timestamp"])
    epoch = F.unix_seconds(ts)
    # rendered from the epoch on a zone-free timestamp: independent of the session zone
    utc = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz") + F.make_dt_interval(secs=epoch)
    return ex.select("chat_id", "msg_pos", epoch.cast("double").alias("epoch"),
                     F.date_format(utc, "yyyy-MM-dd HH:mm:ss").alias("utc_text"))


@query("parent_question", """
SELECT chat_id, msg_pos, parent_id, question FROM fx_msg""")
def parent_question(spark, sf):
    chat, _ = chat_and_users(spark, sf)
    f = E.message_fields(E.explode_with_parent(chat))
    return f.select("chat_id", "msg_pos", "parent_id", "question")


@query("join_user", """
SELECT c.chat_id, c.user_id, u.email
FROM (SELECT DISTINCT chat_id, user_id FROM fx_messages) c JOIN fx_user u ON u.id = c.user_id""")
def join_user(spark, sf):
    chat, users = chat_and_users(spark, sf)
    return E.join_user(chat.select(F.col("id").alias("chat_id"), "user_id"), users) \
            .select("chat_id", "user_id", "email")


@query("rated_messages", """
SELECT chat_id, msg_pos, message_id, rating FROM fx_msg WHERE rated""")
def rated_messages(spark, sf):
    chat, _ = chat_and_users(spark, sf)
    f = E.message_fields(E.rated_filter(E.explode_messages(chat)))
    return f.select("chat_id", "msg_pos", "message_id", "rating")


@query("unrated_messages", """
SELECT chat_id, msg_pos, message_id FROM fx_msg WHERE NOT rated AND role = 'assistant'""")
def unrated_messages(spark, sf):
    chat, _ = chat_and_users(spark, sf)
    return E.unrated_filter(E.explode_messages(chat)) \
            .select("chat_id", "msg_pos", "message_id")


@query("recent_feedback", f"""
SELECT {FEEDBACK_SQL}, CAST(epoch AS DOUBLE) AS epoch FROM fx_feedback
WHERE epoch > {AS_OF_EPOCH} - {DAYS_BACK} * 86400""")
def recent_feedback(spark, sf):
    chat, users = chat_and_users(spark, sf)
    return _feedback_out(E.extract_feedback(chat, users, days_back=DAYS_BACK, as_of=AS_OF_EPOCH,
                                            sort=False))


@query("feedback_sorted", """
SELECT chat_id, msg_pos, CAST(epoch AS DOUBLE) AS epoch FROM fx_feedback
ORDER BY epoch DESC NULLS FIRST, chat_id, turn""")
def feedback_sorted(spark, sf):
    chat, users = chat_and_users(spark, sf)
    return E.extract_feedback(chat, users).select("chat_id", "msg_pos", epoch_of("datetime", "epoch"))


def _unrated_sql(n: int) -> str:
    return f"""
SELECT chat_id, msg_pos, message_id, email, model, CAST(epoch AS DOUBLE) AS epoch, question,
       content AS answer
FROM fx_unrated ORDER BY fx_unrated.epoch DESC NULLS FIRST, chat_id, turn LIMIT {n}"""


def _unrated_out(df):
    return df.select("chat_id", "msg_pos", "message_id", "email", "model",
                     epoch_of("datetime", "epoch"), "question", "answer")


@query("unrated_topn", _unrated_sql(TOPN))
def unrated_topn(spark, sf):
    chat, users = chat_and_users(spark, sf)
    return _unrated_out(E.extract_unrated(chat, users, limit=TOPN))


@query("extract_feedback", f"""
SELECT {FEEDBACK_SQL}, CAST(epoch AS DOUBLE) AS epoch FROM fx_feedback""")
def extract_feedback(spark, sf):
    chat, users = chat_and_users(spark, sf)
    return _feedback_out(E.extract_feedback(chat, users))


@query("extract_unrated", _unrated_sql(1000))
def extract_unrated(spark, sf):
    chat, users = chat_and_users(spark, sf)
    return _unrated_out(E.extract_unrated(chat, users))


@query("extract_profile", """
SELECT count(DISTINCT chat_id) AS chats, CAST(count_if(h <= 7) AS BIGINT) AS annotated,
       CAST(count_if(h = 7) AS BIGINT) AS annotated_json_null, CAST(0 AS BIGINT) AS bad_chats,
       CAST(0 AS BIGINT) AS bad_timestamps
FROM fx_messages""")
def extract_profile(spark, sf):
    chat, _ = chat_and_users(spark, sf)
    return E.extract_profile(chat)


@query("feedback_preview", """
SELECT chat_id, msg_pos, rating, left(question, 80) AS question_preview,
       left(content, 80) AS answer_preview
FROM fx_feedback ORDER BY epoch DESC NULLS FIRST, chat_id, turn LIMIT 3""")
def feedback_preview(spark, sf):
    chat, users = chat_and_users(spark, sf)
    return E.feedback_preview(E.extract_feedback(chat, users, sort=False))


_RAW_SQL = """
SELECT chat_id, msg_pos, left(raw, 300) AS raw_preview FROM (
  SELECT chat_id, msg_pos,
    '{' || concat_ws(',',
       '"role":' || to_json(role),
       CASE WHEN parent_id IS NOT NULL THEN '"parentId":' || to_json(parent_id) END,
       CASE WHEN model IS NOT NULL THEN '"model":' || to_json(model) END,
       '"content":' || to_json(content),
       CASE WHEN epoch IS NOT NULL THEN '"timestamp":' || CAST(epoch AS VARCHAR) END,
       '"annotation":' || CASE WHEN h <= 4 THEN '{"rating":' || CAST(h + 1 AS VARCHAR) || ',"reason":"r' || CAST(h AS VARCHAR) || '"}'
                              WHEN h = 5 AND chat_id % 2 = 0 THEN '{"rating":"10","comment":"c"}'
                              WHEN h = 5 THEN '{"rating":"-1","comment":"c"}'
                              WHEN h = 6 THEN '{"rating":"n/a"}' ELSE 'null' END) || '}' AS raw
  FROM fx_msg WHERE rated ORDER BY chat_id, msg_pos LIMIT 1)"""


@query("raw_message_preview", _RAW_SQL)
def raw_message_preview(spark, sf):
    chat, _ = chat_and_users(spark, sf)
    return E.raw_message_sample(chat)
