"""Bucketed reward lookup, even id slices, gates, cards over many runs."""

import datetime as dt
import random

from pyspark.sql import functions as F

from rewardloom.config import Settings
from rewardloom.operators import extract as E, reward_layout as RL, rewards as R, runs as O
from rewardloom.plans.inputs import chat_and_users, rated, responses
from rewardloom.session import scratch_path
from rewardloom.sources import tables
from rewardloom.sources.snapshot import read_cards, read_snapshot
from tests.conftest import SF01
from tests.test_skew import conf

NO_BROADCAST = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1"}


def final_plan(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def test_epochs_move_no_responses(spark):
    """Two epochs over responses laid out once, a third of them one key: equal to ``compute_rewards``, and no exchange in the plan."""
    rows = responses(spark, SF01).select("doc_id", "question", "response")
    one = rows.orderBy("doc_id").first()
    hot = rows.withColumns({c: F.when(F.col("doc_id") % 3 == 0, F.lit(one[c])).when(F.col("doc_id") % 50 != 1, F.col(c)) for c in ("question", "response")})
    cache = R.build_reward_cache(R.reward_samples(rated(spark, SF01, dup=True)))
    laid = RL.write_responses(hot, buckets=6, hot_share=0.05)
    hottest = spark.table(laid.hot).orderBy(F.desc("salts")).first()
    assert hottest["salts"] >= 6 and spark.table(laid.hot).count() <= 20
    names = []
    with conf(spark, **NO_BROADCAST):
        for table in (cache, cache.where("reward > 0").withColumn("reward", -F.col("reward"))):
            names.append(RL.write_rewards(table, laid))
            scored = RL.score_epoch(spark, laid, names[-1])
            plan = final_plan(scored)
            assert "Exchange" not in plan and "SortMergeJoin" in plan, plan
            want = R.compute_rewards(hot, table)
            key = ["doc_id", "question", "response", "key", "reward", "hit"]
            assert sorted(scored.columns) == sorted(key)
            assert sorted(scored.select(key).collect(), key=str) == sorted(want.select(key).collect(), key=str)
    # the hot key fills several buckets
    at = spark.table(laid.name).where(F.col("key") == hottest["key"]).select(F.input_file_name()).distinct().count()
    assert at > 2
    RL.drop(spark, laid, *names)
    assert not spark.catalog.tableExists(laid.name)


def test_even_slices_of_skewed_ids(spark):
    rng = random.Random(1)
    ids = [None] * 300 + [f"{'a' * rng.randrange(1, 30)}{rng.randrange(10**6)}" for _ in range(9000)] + [f"zz'{i:05d}" for i in range(9000)]
    df = spark.createDataFrame([(i,) for i in ids], "id string").repartition(5)
    where = tables.split_predicates(tables.even_splits(df, 16))
    sizes = [df.where(p).count() for p in where]
    assert len(where) == 17 and sizes[-1] == 300 and sum(sizes) == len(ids)
    assert max(sizes[:-1]) <= 2 * sum(sizes[:-1]) / 16
    whole = spark.range(5000).select((F.col("id") * F.col("id") - 7).alias("id"))
    where = tables.split_predicates(tables.even_splits(whole, 10))
    sizes = [whole.where(p).count() for p in where]
    assert sum(sizes) == 5000 and max(sizes) <= 1000 and sizes[-1] == 0
    assert tables.even_splits(df.limit(0), 4) == [] and tables.even_splits(df.where("id IS NULL"), 4) == []
    same = spark.createDataFrame([("x",)] * 50, "id string")
    assert sum(same.where(p).count() for p in tables.split_predicates(tables.even_splits(same, 4))) == 50


def test_jdbc_finds_its_slices(spark, monkeypatch):
    """The reader asks for the ids, then reads by even slices in code point order (a stub stands for the database)."""
    rows = spark.createDataFrame([(f"id{i:04d}", "u", "{}") for i in range(2000)] + [(None, "u", "{}")], "id string, user_id string, chat string")
    asked = []

    def jdbc(self, url, table, predicates=None, properties=None, **kw):
        asked.append((table, predicates))
        return rows.select("id") if predicates is None else rows

    monkeypatch.setattr(type(spark.read), "jdbc", jdbc)
    got = tables.read_chat(spark, "jdbc:none", fmt="jdbc", num_slices=4, id_column='id COLLATE "C"')
    assert got.count() == 2001 and asked[0] == ("(SELECT id FROM chat) ids", None)
    assert len(asked[1][1]) == 5 and all(p.startswith('id COLLATE "C" ') for p in asked[1][1])


def test_gates_of_a_real_run(spark):
    chat, users = chat_and_users(spark, SF01)
    for min_samples, part in ((1, chat), (10**6, chat), (1, chat.limit(0))):
        run = O.feedback_run(part, users, run_id="g", settings=Settings(min_feedback_samples=min_samples))
        path = scratch_path(spark, "t-gates")
        st = O.execute_run(run, sink_path=path)
        assert {k: v for k, v in st.items() if k != "written"} == run.status.first().asDict()
        assert ("written" in st) == (st["status"] == "ready")


def test_published_card_is_the_exact_one(spark):
    chat, users = chat_and_users(spark, SF01)
    run, path = O.feedback_run(chat, users, run_id="c", settings=Settings(min_feedback_samples=1)), scratch_path(spark, "t-card")
    O.execute_run(run, sink_path=path)
    from rewardloom.operators import clean as C
    want = O.dataset_card(C.clean_feedback(run.feedback).withColumn("reward", R.reward_expr("rating")), "c").first().asDict()
    got = read_cards(spark, path, "c").first().asDict()
    assert all(got[k] == v or abs(got[k] - v) < 1e-12 for k, v in want.items())
    assert read_snapshot(spark, path, "c").count() == want["rows"]


def test_rollup_reads_cards_only(spark):
    """Five runs that share prompts: 60,000 distinct ones, found within 3 standard errors of 0.8 %."""
    cards = None
    for k in range(5):
        rows = spark.range(20_000).select(F.concat(F.lit("q"), F.col("id") + k * 10_000).alias("question"), (F.col("id") % 5 + 1).cast("double").alias("rating"),
                                          (F.col("id") % 3 - 1.0).cast("double").alias("reward"), F.timestamp_seconds(F.col("id") + k).alias("datetime"))
        card = O.finished_card(rows.agg(*O.card_metrics())).withColumn("run_id", F.lit(f"r{k}"))
        cards = card if cards is None else cards.unionByName(card)
    path = scratch_path(spark, "t-cards")
    cards.write.parquet(path)
    out = O.card_rollup(spark.read.parquet(path))
    got = out.first()
    assert got.runs == 5 and got["rows"] == 100_000 and got.mean_rating == 3.0 and got.max_epoch == 20_003
    assert abs(got.distinct_prompts / 60_000 - 1) < 3 * 0.008
    assert all("t-cards" in f for f in out.inputFiles())


def test_run_due(spark):
    at = dt.datetime(2024, 5, 10, tzinfo=dt.timezone.utc)
    cards = spark.createDataFrame([("20240501_000000",), ("20240503_120000",), ("by hand",)], "run_id string")
    assert not O.run_due(cards, at) and O.run_due(cards, at + dt.timedelta(hours=12)) and O.run_due(cards, at.timestamp() + 43200)
    assert O.run_due(cards.limit(0), at) and not O.run_due(cards, at, Settings(run_interval_days=30))
    assert O.run_due(cards, at, Settings(run_interval_days=6))
