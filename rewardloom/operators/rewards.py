"""Reward labelling, the reward lookup table and its use.

The lookup table is a DataFrame unique on ``key``; "last write wins in source
order" is ``max_by(reward, seq)`` — an aggregate with map-side partial
combine, so a key holding a third of all rows is pre-reduced before the
shuffle and never gathered in one task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from rewardloom.config import DEFAULT_SETTINGS, Settings
from rewardloom.functions.text import reward_key as _key_expr
from rewardloom.operators.skew import skew_safe_join


def reward_expr(rating, settings: Settings = DEFAULT_SETTINGS):
    """clamp((r - mid) / (max - mid), -1, 1)."""
    r = F.col(rating) if isinstance(rating, str) else rating
    mid, top = settings.rating_mid, settings.rating_max
    return F.greatest(F.lit(-1.0), F.least(F.lit(1.0), (r - F.lit(mid)) / F.lit(top - mid)))


def normalize_rating(df: DataFrame, settings: Settings = DEFAULT_SETTINGS,
                     col: str = "rating", out: str = "reward") -> DataFrame:
    return df.withColumn(out, reward_expr(col, settings))


def reward_samples(clean: DataFrame, settings: Settings = DEFAULT_SETTINGS) -> DataFrame:
    """R2: question, answer, rating, reward (+ identity/order columns present)."""
    keep = [c for c in ("chat_id", "msg_pos", "doc_id", "seq") if c in clean.columns]
    return clean.select(*keep, "question", "answer", "rating",
                        reward_expr("rating", settings).alias("reward"))


def reward_sign_counts(samples: DataFrame) -> DataFrame:
    """Positive / neutral / negative rewards and the total."""
    r = F.col("reward")
    return samples.agg(F.count_if(r > 0).alias("positive"), F.count_if(r == 0).alias("neutral"),
                       F.count_if(r < 0).alias("negative"), F.count(F.lit(1)).alias("total"))


def unique_questions(df: DataFrame) -> DataFrame:
    """Distinct questions (one NULL group kept) in first-seen order.
    ``min(seq)`` replaces a row-order scan; output sorted by it."""
    agg = df.groupBy("question").agg(F.min("seq").alias("first_seq"),
                                     F.count(F.lit(1)).alias("n"))
    return agg.orderBy("first_seq")


def with_reward_key(df: DataFrame, q: str = "question", a: str = "answer",
                    out: str = "key") -> DataFrame:
    """Strip -> lower -> 200 code points per side, joined by '|||'."""
    return df.withColumn(out, _key_expr(q, a))


def build_reward_cache(samples: DataFrame) -> DataFrame:
    """Key -> reward where the last sample in source order wins.
    Samples must carry ``seq``; output is unique on ``key``."""
    keyed = with_reward_key(samples)
    return keyed.groupBy("key").agg(F.max_by("reward", "seq").alias("reward"),
                                    F.count(F.lit(1)).alias("n_ratings"))


def compute_rewards(responses: DataFrame, cache: DataFrame, q: str = "question",
                    r: str = "response") -> DataFrame:
    """Look every (question, response) up; a miss scores 0.0 (FLOAT) and
    ``hit`` tells a miss from a genuine neutral.  Left join on the key with
    hot response keys salted (the table side is an aggregate, which AQE's
    skew split does not cover); the planner still broadcasts a small table."""
    keyed = responses.withColumn("key", _key_expr(q, r))
    c = cache.select("key", F.col("reward").alias("_cached"), F.lit(True).alias("_hit"))
    j = skew_safe_join(keyed, c, "key", how="left")
    return (j.withColumn("reward", F.coalesce("_cached", F.lit(0.0)).cast("float"))
             .withColumn("hit", F.coalesce("_hit", F.lit(False)))
             .drop("_cached", "_hit"))


def cache_hit_rate(scored: DataFrame, by: str = "epoch_no") -> DataFrame:
    """Hits, total, reward sum and hit rate in percent per epoch."""
    agg = scored.groupBy(by).agg(F.count_if("hit").alias("hits"),
                                 F.count(F.lit(1)).alias("total"),
                                 F.sum(F.col("reward").cast("double")).alias("reward_sum"))
    return agg.withColumn("hit_rate_pct",
                          F.lit(100.0) * F.col("hits") / F.greatest(F.col("total"), F.lit(1)))


def batch_mean_reward(scored: DataFrame, every: int = DEFAULT_SETTINGS.batch_log_every,
                      epoch: str = "epoch_no", batch: str = "batch_idx") -> DataFrame:
    """Mean reward per (epoch, batch); ``logged`` marks the batches the
    training loop reports (every ``every``-th)."""
    agg = scored.groupBy(epoch, batch).agg(F.avg(F.col("reward").cast("double")).alias("mean_reward"),
                                           F.count(F.lit(1)).alias("n"))
    return agg.withColumn("logged", (F.col(batch) % F.lit(every)) == 0)
