"""Skew: one user owns a large share of all chats.  With broadcast off and
AQE's skew thresholds lowered to this data size, the user join must run as a
skew-split sort-merge join and give the same rows as the broadcast plan."""

from contextlib import contextmanager

from pyspark.sql import functions as F

from rewardloom.operators import extract as E
from rewardloom.plans.inputs import chat_and_users
from tests.conftest import SF01


@contextmanager
def conf(spark, **kv):
    old = {k: spark.conf.get(k, None) for k in kv}
    for k, v in kv.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def test_hot_user_join_is_split_and_exact(spark):
    chat, users = chat_and_users(spark, SF01)
    # a hot partition is split by the tasks that wrote it, so the chats come from several
    hot = chat.repartition(8).withColumn("user_id", F.when(F.col("id") % 3 != 0, F.lit(1)).otherwise(F.col("user_id")))
    want = sorted(E.extract_feedback(hot, users, sort=False).select("chat_id", "msg_pos", "email").collect())
    with conf(spark, **{
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "256",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
        "spark.sql.shuffle.partitions": "8",
    }):
        df = E.extract_feedback(hot, users, sort=False).select("chat_id", "msg_pos", "email")
        got = sorted(df.collect())
        plan = df._jdf.queryExecution().executedPlan().toString()
    assert got == want
    assert "SortMergeJoin(skew=true)" in plan, plan


SKEW_CONF = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "256",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256",
    "spark.sql.adaptive.coalescePartitions.enabled": "false",
    "spark.sql.shuffle.partitions": "8",
}


def test_hot_tokens_in_vocabulary_lookup(spark):
    from rewardloom.operators import prompts as D
    from rewardloom.sources import fixtures as fx
    up = D.unique_prompts(fx.user_turns(spark, SF01), "text")
    vocab = D.build_vocab(up, "prompt")
    want = sorted(D.tokenize_prompts(up, vocab).collect())
    # with many partitions (as on a cluster) the most frequent token's
    # partition stands far above the median one
    with conf(spark, **dict(SKEW_CONF, **{"spark.sql.shuffle.partitions": "64"})):
        df = D.tokenize_prompts(up, vocab)
        got = sorted(df.collect())
        plan = df._jdf.queryExecution().executedPlan().toString()
    assert got == want
    assert "(skew=true)" in plan, plan


def test_hot_prompt_in_pairs(spark):
    from rewardloom.operators import preference as P, rewards as R
    from rewardloom.plans.inputs import rated
    r = rated(spark, SF01, dup=True)
    hot = r.withColumn("question", F.when(F.col("doc_id") % 3 != 0, F.lit("HOT")).otherwise(F.col("question")))
    samples = R.reward_samples(hot)
    want = sorted(P.preference_pairs(samples).collect())
    with conf(spark, **SKEW_CONF):
        df = P.preference_pairs(samples)
        got = sorted(df.collect())
        plan = df._jdf.queryExecution().executedPlan().toString()
    assert got == want and len(got) > 0
    # the hot prompt is salted: its rows reach the join under many salt values
    assert "_salt" in plan and "xxhash64" in plan, plan


def test_skew_safe_join_spreads_hot_key_exactly(spark):
    from rewardloom.operators.skew import skew_safe_join
    big = spark.range(0, 3000).select(F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id")).alias("k"),
                                      F.col("id").alias("v"))
    small = spark.range(0, 3000, 2).select(F.col("id").alias("k"), (F.col("id") * 10).alias("w"))
    for how in ("inner", "left"):
        want = sorted(big.join(small, "k", how).collect())
        got = sorted(skew_safe_join(big, small, "k", how=how, hot_share=0.05).collect())
        assert got == want
    # rows without a key are spread over tasks too
    none = big.withColumn("k", F.when(F.col("v") % 3 != 0, F.col("k")))
    with conf(spark, **{**SKEW_CONF, "spark.sql.adaptive.enabled": "false"}):
        got = skew_safe_join(none, small, "k", how="left").withColumn("task", F.spark_partition_id()).where("k IS NULL")
        assert got.count() == 1000 and got.groupBy("task").count().agg(F.max("count")).first()[0] < 300
