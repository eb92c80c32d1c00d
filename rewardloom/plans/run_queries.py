"""Registered run, sink and streaming queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from rewardloom.config import Settings
from rewardloom.operators import runs as O
from rewardloom.plans.inputs import chat_and_users, epoch_of
from rewardloom.plans.oracle import coerce, key as okey
from rewardloom.plans.registry import query
from rewardloom.session import path_exists, scratch_path
from rewardloom.sources.snapshot import read_cards, read_snapshot, write_snapshot
from rewardloom.streaming import incremental as ST, reward_state as RS

RUN_ID = "20240108_000000"
AS_OF_EPOCH = 1704067200 + 7 * 86400
WINDOWS = [0, 1, 3, 7]
MIN = 50


def _run(spark, sf):
    chat, users = chat_and_users(spark, sf)
    return O.feedback_run(chat, users, run_id=RUN_ID)


@query("feedback_run", f"""
SELECT '{RUN_ID}' AS run_id, count(*) AS extracted, (SELECT count(*) FROM fx_clean) AS cleaned,
       (SELECT count(*) FROM fx_samples) AS samples,
       CASE WHEN count(*) = 0 THEN 'no_feedback'
            WHEN (SELECT count(*) FROM fx_samples) < {MIN} THEN 'not_enough' ELSE 'ready' END AS status
FROM fx_feedback""")
def feedback_run(spark, sf):
    return _run(spark, sf).status


_WIN_SQL = " UNION ALL ".join(
    f"""SELECT {d} AS days_back,
  (SELECT count(*) FROM fx_feedback WHERE {'true' if not d else f'epoch > {AS_OF_EPOCH - d * 86400}'}) AS extracted,
  (SELECT count(*) FROM fx_clean WHERE {'true' if not d else f'epoch > {AS_OF_EPOCH - d * 86400}'}) AS cleaned"""
    for d in WINDOWS)


@query("run_status", f"""
SELECT days_back, extracted, cleaned, cleaned AS samples,
       CASE WHEN extracted = 0 THEN 'no_feedback' WHEN cleaned < {MIN} THEN 'not_enough'
            ELSE 'ready' END AS status
FROM ({_WIN_SQL})""")
def run_status(spark, sf):
    from rewardloom.operators import extract as E
    chat, users = chat_and_users(spark, sf)
    fb = E.extract_feedback(chat, users, sort=False)
    return O.window_gates(fb, WINDOWS, AS_OF_EPOCH)


@query("snapshot_roundtrip", f"""
SELECT chat_id, msg_pos, question, answer, rating, reward, '{RUN_ID}' AS run_id FROM fx_samples""")
def snapshot_roundtrip(spark, sf):
    run = _run(spark, sf)
    path = scratch_path(spark, "snapshot")
    write_snapshot(run.samples.drop("seq"), path, run.run_id)
    return read_snapshot(spark, path, run.run_id).select(
        "chat_id", "msg_pos", "question", "answer", "rating", "reward", "run_id")


@query("dataset_card", f"""
SELECT '{RUN_ID}' AS run_id, count(*) AS rows, count(DISTINCT question) AS distinct_prompts,
       avg(rating) AS mean_rating, min(rating) AS min_rating, max(rating) AS max_rating,
       avg(reward) AS mean_reward, max(epoch) AS max_epoch
FROM fx_samples""")
def dataset_card(spark, sf):
    from rewardloom.operators import clean as C, extract as E, rewards as R
    chat, users = chat_and_users(spark, sf)
    clean = C.clean_feedback(E.extract_feedback(chat, users, sort=False))
    return O.dataset_card(clean.withColumn("reward", R.reward_expr("rating")), RUN_ID)


@query("run_dry", f"""
SELECT '{RUN_ID}' AS run_id, (SELECT count(*) FROM fx_feedback) AS extracted, count(*) AS cleaned, count(*) AS samples,
       CASE WHEN (SELECT count(*) FROM fx_feedback) = 0 THEN 'no_feedback'
            WHEN count(*) < {MIN} THEN 'not_enough' ELSE 'ready' END AS status, CAST(0 AS BIGINT) AS files_written
FROM fx_clean""")
def run_dry(spark, sf):
    """O3: the gate of a dry run, and that nothing was written where a real run publishes."""
    path = scratch_path(spark, "dry")
    st = O.execute_run(_run(spark, sf), sink_path=path, dry_run=True)
    written = int(path_exists(spark, path))
    return spark.createDataFrame([(st["run_id"], st["extracted"], st["cleaned"], st["samples"], st["status"], written)],
                                 "run_id string, extracted bigint, cleaned bigint, samples bigint, status string, files_written bigint")


@query("published_card", f"""
SELECT '{RUN_ID}' AS run_id, count(*) AS rows, count(DISTINCT question) AS distinct_prompts,
       avg(rating) AS mean_rating, min(rating) AS min_rating, max(rating) AS max_rating,
       avg(reward) AS mean_reward, max(epoch) AS max_epoch
FROM fx_samples""")
def published_card(spark, sf):
    """S4 as a real run writes it next to its snapshot."""
    path = scratch_path(spark, "published")
    chat, users = chat_and_users(spark, sf)
    O.execute_run(O.feedback_run(chat, users, run_id=RUN_ID, settings=Settings(min_feedback_samples=1)), sink_path=path)
    return read_cards(spark, path, RUN_ID).select("run_id", "rows", "distinct_prompts", "mean_rating", "min_rating", "max_rating",
                                                  "mean_reward", "max_epoch")


@query("card_rollup", """
SELECT 3::BIGINT AS runs, count(*) AS "rows", count(DISTINCT question) AS distinct_prompts, round(avg(rating), 9) AS mean_rating, min(rating) AS min_rating,
       max(rating) AS max_rating, round(avg(reward), 9) AS mean_reward, max(epoch) AS max_epoch
FROM fx_samples""")
def card_rollup(spark, sf):
    """S4 over three published runs, each of a third of the chats, from their cards alone."""
    path = scratch_path(spark, "rolled")
    chat, users = chat_and_users(spark, sf)
    for k in range(3):
        part = chat.where(F.pmod("id", F.lit(3)) == k)
        O.execute_run(O.feedback_run(part, users, run_id=f"third-{k}", settings=Settings(min_feedback_samples=1)), sink_path=path)
    return O.card_rollup(read_cards(spark, path)).select("runs", "rows", "distinct_prompts", F.round("mean_rating", 9).alias("mean_rating"), "min_rating", "max_rating",
                                                         F.round("mean_reward", 9).alias("mean_reward"), "max_epoch")


def _landed(spark, sf, name, *changes):
    """The staged chats landed and drained, then each change landed and drained; (sink, users)."""
    chat, users = chat_and_users(spark, sf)
    base = scratch_path(spark, name)
    for k, rows in enumerate([chat, *[change(chat) for change in changes]]):
        rows.write.parquet(f"{base}/landing/part={k}")
        ST.start_extract(ST.chat_stream(spark, f"{base}/landing/part=*"), f"{base}/out", f"{base}/ckpt").awaitTermination()
    return f"{base}/out", users


_STREAM_COLS = ("chat_id", "msg_pos", "message_id", "role", "email", "model", "rating", "reason", "comment", "question", "answer")
_STREAM_SQL = """SELECT chat_id, msg_pos, message_id, role, email, model, rating, reason, comment, question,
       content AS answer, CAST(epoch AS DOUBLE) AS epoch FROM """


def _stream_out(df):
    return df.select(*_STREAM_COLS, epoch_of("datetime", "epoch"))


@query("stream_extract", _STREAM_SQL + "fx_feedback")
def stream_extract(spark, sf):
    sink, users = _landed(spark, sf, "stream-extract")
    return _stream_out(ST.current_feedback(spark, sink, users))


@query("stream_rerun_updated", """, upd AS (SELECT * REPLACE (CASE WHEN chat_id % 3 = 0 AND rating IN ('1', '2') THEN '5' ELSE rating END AS rating)
FROM fx_feedback)
""" + _STREAM_SQL + "upd")
def stream_rerun_updated(spark, sf):
    """A third of the chats land again with low ratings changed: the later version replaces the earlier one."""
    def changed(chat):
        again = F.regexp_replace("chat", '"rating":[12],', '"rating":5,')
        return chat.where(F.col("id") % 3 == 0).withColumn("chat", again)

    sink, users = _landed(spark, sf, "stream-updated", changed)
    return _stream_out(ST.current_feedback(spark, sink, users))


@query("stream_late_user", _STREAM_SQL + "fx_feedback")
def stream_late_user(spark, sf):
    """Half of the users arrive after their chats were drained; the reader finds them all the same."""
    sink, users = _landed(spark, sf, "stream-late")
    ST.current_feedback(spark, sink, users.where(F.col("id") % 2 == 0)).count()
    return _stream_out(ST.current_feedback(spark, sink, users))


@query("stream_reward_cache", f"""
SELECT key, reward, n_ratings FROM (
  SELECT key, reward, count(*) OVER (PARTITION BY key) AS n_ratings,
    row_number() OVER (PARTITION BY key ORDER BY epoch ASC NULLS LAST, chat_id DESC, turn DESC) AS rn
  FROM (SELECT *, {okey('question', 'answer')} AS key FROM fx_samples))
WHERE rn = 1""")
def stream_reward_cache(spark, sf):
    sink, users = _landed(spark, sf, "stream-cache")
    ST.compact(spark, sink)
    return ST.current_reward_table(spark, sink, users)


@query("stream_reward_state", f"""
, upd AS (SELECT * REPLACE (CASE WHEN chat_id % 4 = 0 THEN (CASE WHEN rating = '3' THEN '1' ELSE rating END)
                                 WHEN chat_id % 3 = 0 AND rating IN ('1', '2') THEN '5' ELSE rating END AS rating) FROM fx_samples_text)
, s AS (SELECT chat_id, turn, epoch, {okey('question', 'answer')} AS key, greatest(-1.0, least(1.0, ({coerce('rating')} - 3.0) / 2.0)) AS reward FROM upd)
SELECT key, reward, n_ratings FROM (
  SELECT key, reward, count(*) OVER (PARTITION BY key) AS n_ratings,
    row_number() OVER (PARTITION BY key ORDER BY epoch ASC NULLS LAST, chat_id DESC, turn DESC) AS rn FROM s)
WHERE rn = 1""", extra_ctes=(("fx_samples_text", """
SELECT c.chat_id, c.turn, c.epoch, f.rating, c.question, c.answer FROM fx_clean c JOIN fx_feedback f ON f.chat_id = c.chat_id AND f.turn = c.turn"""),))
def stream_reward_state(spark, sf):
    """The reward table kept as streaming state over three landings, each by a restarted job: all chats, then a third re-rated,
    then a quarter re-rated from what they were at first (a chat in both takes back its second rating)."""
    chat, users = chat_and_users(spark, sf)
    base = scratch_path(spark, "reward-state")

    def again(rest, was, now):
        return chat.where(F.col("id") % rest == 0).withColumn("chat", F.regexp_replace("chat", f'"rating":{was},', f'"rating":{now},'))

    for k, rows in enumerate([chat, again(3, "[12]", 5), again(4, "3", 1)]):
        rows.write.parquet(f"{base}/landing/part={k}")
        RS.drain(ST.chat_stream(spark, f"{base}/landing/part=*"), f"{base}/state")
    return RS.reward_table(spark, f"{base}/state", users)
