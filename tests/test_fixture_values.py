"""Expected values at sf0.01 (FIXTURES.md §3), computed on the Spark side."""

from pyspark.sql import functions as F

from rewardloom.operators import clean as C, extract as E, prompts as D, rewards as R
from rewardloom.plans.inputs import chat_and_users, rated
from rewardloom.sources import fixtures as fx
from tests.conftest import SF01


def test_extraction_counts(spark):
    chat, users = chat_and_users(spark, SF01)
    prof = E.extract_profile(chat).first()
    assert (prof.chats, prof.annotated, prof.annotated_json_null) == (100, 433, 55)
    assert E.explode_messages(chat).count() == 536
    fb = E.extract_feedback(chat, users, sort=False).cache()
    assert fb.count() == 391
    assert {r.role: r["count"] for r in fb.groupBy("role").count().collect()} == \
        {"assistant": 169, "user": 205, "system": 17}
    assert fb.where(F.col("datetime").isNull()).count() == 28
    asof = 1704067200 + 7 * 86400
    assert E.extract_feedback(chat, users, days_back=3, as_of=asof, sort=False).count() == 161
    un = E.extract_unrated(chat, users)
    assert un.count() == 41 and un.where(F.col("datetime").isNull()).count() == 1
    clean = C.clean_feedback(fb)
    assert clean.count() == 216 and clean.where(F.col("datetime").isNull()).count() == 13
    hist = {r.rating: r.n for r in C.rating_histogram(clean).collect()}
    assert hist == {-1.0: 17, 1.0: 38, 2.0: 34, 3.0: 36, 4.0: 36, 5.0: 38, 10.0: 17}
    rewards = {r.rating: r.reward for r in R.normalize_rating(clean).select("rating", "reward").distinct().collect()}
    assert rewards == {-1.0: -1.0, 1.0: -1.0, 2.0: -0.5, 3.0: 0.0, 4.0: 0.5, 5.0: 1.0, 10.0: 1.0}
    fb.unpersist()


def test_rated_prompts_and_vocab_counts(spark):
    r = rated(spark, SF01)
    assert r.count() == 399 and r.select("question").distinct().count() == 73
    assert {x.rating: x["count"] for x in r.groupBy("rating").count().collect()} == \
        {1.0: 21, 2.0: 31, 3.0: 6, 4.0: 145, 5.0: 167, 6.0: 29}
    vocab = D.build_vocab(fx.user_turns(spark, SF01), "text")
    assert vocab.where(F.col("token_id") > 2).count() == 5167
    assert D.unique_prompts(fx.prompt_table(spark, SF01), "prompt").count() == 928
