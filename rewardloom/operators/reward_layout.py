"""R7/R8 epoch after epoch without moving the responses: bucketed tables.

``compute_rewards`` shuffles the responses by key every time.  A training loop scores the same responses once an epoch
while the reward table changes.  Here the responses are written once, bucketed and sorted by (key, salt); each epoch's
reward table is written in the same buckets, and the join reads bucket against bucket: no exchange on either side.

Keys that hold more than ``hot_share`` of the responses (at most 1 / hot_share of them) are spread over salts, so a key
with a third of all rows fills many buckets; its one reward row is repeated once a salt.  The list of hot keys is a small
table beside the responses.  Rows without a key match nothing and are spread by a hash of the row.

Bucketing needs a catalog; the tables' files lie under the shared folder (``spark.checkpoint.dir``) and their names are unique.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F

from rewardloom.functions.text import reward_key
from rewardloom.operators.skew import NULL_SALTS
from rewardloom.session import scratch_path

KEYS = ("key", "salt")


@dataclass(frozen=True)
class ResponseTable:
    name: str         # catalog table: the responses' columns, key, salt
    hot: str          # catalog table: key, salts of the hot keys
    buckets: int


def _bucketed(df: DataFrame, what: str, buckets: int) -> str:
    """Writes ``df`` in buckets, a file each, and returns the table's name."""
    name = f"rewardloom_{what}_{uuid.uuid4().hex[:12]}"
    (df.repartition(buckets, *KEYS).write.bucketBy(buckets, *KEYS).sortBy(*KEYS).format("parquet")
       .option("path", scratch_path(df.sparkSession, name)).saveAsTable(name))
    return name


def write_responses(responses: DataFrame, q: str = "question", r: str = "response", buckets: int = 64,
                    hot_share: float = 0.001) -> ResponseTable:
    """Lays the responses out once, for any number of ``score_epoch``."""
    spark = responses.sparkSession
    keyed = responses.withColumn("key", reward_key(q, r))
    counts = keyed.where(F.col("key").isNotNull()).groupBy("key").agg(F.count(F.lit(1)).alias("n"))
    total = counts.agg(F.sum("n")).first()[0] or 0
    least = max(total * hot_share, 1.0)
    hot = f"rewardloom_hot_{uuid.uuid4().hex[:12]}"
    (counts.where(F.col("n") > least).select("key", F.ceil(F.col("n") / F.lit(least)).cast("int").alias("salts")).coalesce(1)
           .write.format("parquet").option("path", scratch_path(spark, hot)).saveAsTable(hot))
    row = F.xxhash64(*[F.col(f"`{c}`") for c in keyed.columns])
    salt = F.when(F.col("key").isNull(), F.pmod(row, F.lit(NULL_SALTS))).otherwise(F.pmod(row, F.coalesce("salts", F.lit(1))))
    # at most 1 / hot_share rows
    salted = keyed.join(F.broadcast(spark.table(hot)), "key", "left").withColumn("salt", salt.cast("int")).drop("salts")
    return ResponseTable(_bucketed(salted, "responses", buckets), hot, buckets)


def write_rewards(cache: DataFrame, responses: ResponseTable) -> str:
    """The reward table (unique on key) of an epoch in the responses' layout; its name."""
    hot = F.broadcast(cache.sparkSession.table(responses.hot))
    salts = F.explode(F.sequence(F.lit(0), F.coalesce("salts", F.lit(1)) - 1))
    rows = cache.select("key", F.col("reward").cast("double").alias("reward")).join(hot, "key", "left")
    return _bucketed(rows.select("key", salts.alias("salt"), "reward"), "rewards", responses.buckets)


def score_epoch(spark: SparkSession, responses: ResponseTable, rewards: str) -> DataFrame:
    """What ``compute_rewards`` gives: the responses with key, reward (a miss: 0.0) and hit."""
    found = spark.table(rewards).select(*KEYS, F.col("reward").alias("_cached"), F.lit(True).alias("_hit"))
    j = spark.table(responses.name).join(found, list(KEYS), "left")
    return (j.withColumn("reward", F.coalesce("_cached", F.lit(0.0)).cast("float"))
             .withColumn("hit", F.coalesce("_hit", F.lit(False))).drop("_cached", "_hit", "salt"))


def drop(spark: SparkSession, responses: ResponseTable, *rewards: str) -> None:
    """Forgets the tables (their files stay in the shared folder, like all intermediate tables)."""
    for name in (responses.name, responses.hot, *rewards):
        spark.sql(f"DROP TABLE IF EXISTS {name}")
