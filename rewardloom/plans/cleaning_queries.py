"""Registered cleaning (C1–C7) and reward (R1–R9) queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from rewardloom.operators import clean as C, extract as E, reward_layout as RL, rewards as R
from rewardloom.plans.inputs import chat_and_users, epoch_of, rated, responses
from rewardloom.plans.oracle import key as okey, ustrip
from rewardloom.plans.registry import query


def feedback(spark, sf):
    chat, users = chat_and_users(spark, sf)
    return E.extract_feedback(chat, users, sort=False)


def cleaned(spark, sf):
    return C.clean_feedback(feedback(spark, sf))


@query("coerce_rating", """
SELECT chat_id, msg_pos, rating_text, rating FROM fx_coerced""")
def coerce_rating(spark, sf):
    fb = feedback(spark, sf).withColumn("rating_text", F.col("rating"))
    return C.coerce_rating(fb).select("chat_id", "msg_pos", "rating_text", "rating")


@query("drop_missing", """
SELECT chat_id, msg_pos, rating FROM fx_coerced
WHERE rating IS NOT NULL AND NOT isnan(rating) AND question IS NOT NULL AND answer IS NOT NULL""")
def drop_missing(spark, sf):
    return C.drop_missing(C.coerce_rating(feedback(spark, sf))).select("chat_id", "msg_pos", "rating")


@query("strip_blank", f"""
SELECT chat_id, msg_pos, {ustrip('question')} AS question, {ustrip('content')} AS answer
FROM fx_feedback
WHERE coalesce({ustrip('question')} <> '', true) AND coalesce({ustrip('content')} <> '', true)""")
def strip_blank(spark, sf):
    return C.strip_blank(feedback(spark, sf)).select("chat_id", "msg_pos", "question", "answer")


@query("clean_feedback", """
SELECT chat_id, msg_pos, email, model, CAST(epoch AS DOUBLE) AS epoch, rating, reason, comment, question, answer
FROM fx_clean""")
def clean_feedback(spark, sf):
    return cleaned(spark, sf).select("chat_id", "msg_pos", "email", "model", epoch_of("datetime", "epoch"),
                                     "rating", "reason", "comment", "question", "answer")


@query("rating_histogram", """
SELECT rating, count(*) AS n FROM fx_clean GROUP BY rating ORDER BY rating""")
def rating_histogram(spark, sf):
    return C.rating_histogram(cleaned(spark, sf))


@query("rating_mean", """
SELECT avg(rating) AS mean_rating, count(rating) AS n FROM fx_clean""")
def rating_mean(spark, sf):
    return C.rating_mean(cleaned(spark, sf))


_SHAPE_COLS = [("email", "string"), ("model", "string"), ("datetime", "timestamp"),
               ("rating", "string"), ("reason", "string"), ("comment", "string"),
               ("question", "string"), ("answer", "string")]
_SHAPE_SRC = {"datetime": "epoch", "answer": "content"}


def _shape_sql() -> str:
    first = "(SELECT * FROM fx_feedback ORDER BY epoch DESC NULLS FIRST, chat_id, turn LIMIT 1)"
    parts = []
    for i, (c, t) in enumerate(_SHAPE_COLS):
        src = _SHAPE_SRC.get(c, c)
        parts.append(
            f"SELECT '{c}' AS column_name, {i} AS position, '{t}' AS data_type, "
            f"(SELECT count({src}) FROM fx_feedback) AS non_null, "
            f"(SELECT count(*) FROM fx_feedback) AS n_rows, "
            f"(SELECT left(CAST({src} AS VARCHAR), 100) FROM {first}) AS first_value")
    return " UNION ALL ".join(parts)


@query("feedback_shape", _shape_sql())
def feedback_shape(spark, sf):
    fb = feedback(spark, sf).select([c for c, _ in _SHAPE_COLS] + ["seq"])
    return C.feedback_shape(fb, order_col="seq")


# -- rewards ------------------------------------------------------------------

@query("normalize_rating", """
SELECT chat_id, msg_pos, rating, reward FROM fx_samples""")
def normalize_rating(spark, sf):
    return R.normalize_rating(cleaned(spark, sf)).select("chat_id", "msg_pos", "rating", "reward")


@query("reward_samples", """
SELECT chat_id, msg_pos, question, answer, rating, reward FROM fx_samples""")
def reward_samples(spark, sf):
    return R.reward_samples(cleaned(spark, sf)).drop("seq")


@query("reward_sign_counts", """
SELECT CAST(count_if(reward > 0) AS BIGINT) AS positive, CAST(count_if(reward = 0) AS BIGINT) AS neutral,
       CAST(count_if(reward < 0) AS BIGINT) AS negative, count(*) AS total FROM fx_samples""")
def reward_sign_counts(spark, sf):
    return R.reward_sign_counts(R.reward_samples(cleaned(spark, sf)))


@query("unique_questions", """
SELECT question, chat_id AS first_chat_id, msg_pos AS first_msg_pos, n FROM (
  SELECT question, chat_id, msg_pos, epoch, turn, count(*) OVER (PARTITION BY question) AS n,
    row_number() OVER (PARTITION BY question ORDER BY epoch DESC NULLS FIRST, chat_id, turn) AS rn
  FROM fx_feedback) WHERE rn = 1 ORDER BY epoch DESC NULLS FIRST, chat_id, turn""")
def unique_questions(spark, sf):
    uq = R.unique_questions(feedback(spark, sf))
    return uq.select("question", F.col("first_seq.id").alias("first_chat_id"),
                     F.col("first_seq.pos").alias("first_msg_pos"), "n")


@query("reward_key", f"""
SELECT chat_id, msg_pos, {okey('question', 'answer')} AS key
FROM fx_samples""")
def reward_key(spark, sf):
    return R.with_reward_key(R.reward_samples(cleaned(spark, sf))).select("chat_id", "msg_pos", "key")


@query("reward_cache", """
SELECT key, reward, n_ratings FROM fx_cache""")
def reward_cache(spark, sf):
    return R.build_reward_cache(R.reward_samples(rated(spark, sf, dup=True)))


def _scored(spark, sf):
    cache = R.build_reward_cache(R.reward_samples(rated(spark, sf, dup=True)))
    return R.compute_rewards(responses(spark, sf), cache)


@query("compute_rewards", """
SELECT doc_id, epoch_no, batch_idx, reward, hit FROM fx_scored""")
def compute_rewards(spark, sf):
    return _scored(spark, sf).select("doc_id", "epoch_no", "batch_idx", "reward", "hit")


@query("cache_hit_rate", """
SELECT epoch_no, CAST(count_if(hit) AS BIGINT) AS hits, count(*) AS total,
       sum(CAST(reward AS DOUBLE)) AS reward_sum,
       100.0 * CAST(count_if(hit) AS BIGINT) / greatest(count(*), 1) AS hit_rate_pct
FROM fx_scored GROUP BY epoch_no""")
def cache_hit_rate(spark, sf):
    return R.cache_hit_rate(_scored(spark, sf))


@query("batch_mean_reward", """
SELECT epoch_no, batch_idx, avg(CAST(reward AS DOUBLE)) AS mean_reward, count(*) AS n,
       batch_idx % 10 = 0 AS logged
FROM fx_scored GROUP BY epoch_no, batch_idx""")
def batch_mean_reward(spark, sf):
    return R.batch_mean_reward(_scored(spark, sf))


@query("epoch_rewards", f"""
SELECT 0::INTEGER AS pass, doc_id, reward, hit FROM fx_scored
UNION ALL
SELECT 1::INTEGER, r.doc_id, CAST(coalesce(c.reward, 0.0) AS FLOAT), c.key IS NOT NULL
FROM (SELECT doc_id, {okey('question', 'response')} AS key FROM fx_responses) r
LEFT JOIN (SELECT * FROM fx_cache WHERE n_ratings > 1) c ON c.key = r.key""")
def epoch_rewards(spark, sf):
    """R7 over two passes with two reward tables (all ratings, then keys rated more than once), the responses laid out once."""
    laid = RL.write_responses(responses(spark, sf), buckets=16)
    cache = R.build_reward_cache(R.reward_samples(rated(spark, sf, dup=True)))
    passes = [RL.score_epoch(spark, laid, RL.write_rewards(c, laid)).select(F.lit(i).alias("pass"), "doc_id", "reward", "hit")
              for i, c in enumerate((cache, cache.where("n_ratings > 1")))]
    return passes[0].unionByName(passes[1])
