"""Property checks on generated and fixture data."""

from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from rewardloom.operators import clean as C, preference as P, prompts as D, rewards as R
from rewardloom.plans.inputs import rated
from tests.conftest import SF01


@settings(max_examples=5, deadline=None)
@given(st.lists(st.floats(min_value=-50, max_value=50, allow_nan=False), min_size=2, max_size=30))
def test_reward_bounded_and_monotone(spark, ratings):
    df = spark.createDataFrame([(x,) for x in ratings], "rating double")
    rows = sorted((r.rating, r.reward) for r in R.normalize_rating(df).collect())
    assert all(-1.0 <= rw <= 1.0 for _, rw in rows)
    assert all(a[1] <= b[1] for a, b in zip(rows, rows[1:]))


@settings(max_examples=5, deadline=None)
@given(st.lists(st.lists(st.integers(min_value=3, max_value=50), min_size=1, max_size=12),
                min_size=1, max_size=9))
def test_unpad_inverts_left_pad(spark, id_lists):
    rows = [(f"{i:064x}", ids, [1] * len(ids)) for i, ids in enumerate(id_lists)]
    enc = spark.createDataFrame(rows, "prompt_key string, input_ids array<int>, attention_mask array<int>")
    padded = D.left_pad_batches(enc, batch_size=4)
    got = {r.prompt_key: r.input_ids for r in D.unpad(padded).collect()}
    assert got == {k: ids for k, ids, _ in rows}
    for r in padded.collect():                       # pads are on the left, mask marks them
        k = r.attention_mask.count(0)
        assert r.input_ids[:k] == [0] * k and all(m == 1 for m in r.attention_mask[k:])
    sizes = {}
    for r in padded.collect():
        sizes.setdefault(r.batch_no, set()).add(len(r.input_ids))
    assert all(len(s) == 1 for s in sizes.values())  # one length per batch
    assert all(sum(1 for r in padded.collect() if r.batch_no == b) <= 4 for b in sizes)


def test_clean_is_idempotent(spark):
    from rewardloom.plans.cleaning_queries import feedback
    once = C.clean_feedback(feedback(spark, SF01))
    twice = C.clean_feedback(once.withColumn("rating", F.col("rating").cast("string")))
    cols = ["chat_id", "msg_pos", "question", "answer", "rating"]
    assert sorted(once.select(cols).collect()) == sorted(twice.select(cols).collect())


def test_cache_unique_on_key(spark):
    cache = R.build_reward_cache(R.reward_samples(rated(spark, SF01, dup=True)))
    assert cache.count() == cache.select("key").distinct().count()


def test_split_disjoint_by_prompt(spark):
    s = P.train_test_split(rated(spark, SF01), "question")
    per_q = s.groupBy("question").agg(F.countDistinct("split").alias("k"))
    assert per_q.where("k > 1").count() == 0
    assert 0 < s.where("split = 'test'").count() < s.count()


def test_pairs_are_ordered_and_linear(spark):
    samples = R.reward_samples(rated(spark, SF01, dup=True))
    pairs = P.preference_pairs(samples)
    assert pairs.where("chosen_rating <= rejected_rating").count() == 0
    per_prompt = pairs.groupBy("prompt").agg(F.countDistinct("chosen").alias("c"),
                                             F.count("*").alias("n"))
    assert per_prompt.where("c <> 1").count() == 0          # one champion per prompt
    answers = P.dedup_by_key(samples).groupBy("question").count()
    joined = per_prompt.join(answers, per_prompt.prompt == answers.question)
    assert joined.where("n >= count").count() == 0          # at most n - 1 pairs


def test_sequential_index_is_consecutive_and_stable(spark):
    from rewardloom.operators.indexing import sequential_index
    from rewardloom.sources import fixtures as fx
    # input whose row order varies between evaluations: an aggregate's output
    counts = fx.user_turns(spark, SF01).select(F.explode(F.split("text", " ")).alias("t")) \
        .groupBy("t").agg(F.count("*").alias("n"))
    order = [F.col("n").desc(), F.col("t").asc()]
    a = sequential_index(counts, order, num_partitions=7)
    rows = a.orderBy("idx").collect()
    assert [r.idx for r in rows] == list(range(len(rows)))
    assert [(r.n, r.t) for r in rows] == sorted(((r.n, r.t) for r in rows), key=lambda x: (-x[0], x[1]))
    b = sequential_index(counts, order, num_partitions=13)
    assert sorted(a.collect()) == sorted(b.collect())
