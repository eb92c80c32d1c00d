"""The reward table as streaming state: equal to a rebuild over the current chats, whatever lands again."""

import random

import pandas as pd
import pytest

from rewardloom.operators import clean as C, extract as E, rewards as R
from rewardloom.session import scratch_path
from rewardloom.streaming import incremental as ST, reward_state as RS

SCHEMA = "id bigint, user_id bigint, chat string, updated_at bigint"


def doc(messages):
    """A chat of (question, answer, rating or None, time or None)."""
    parts = []
    for i, (q, a, rating, ts) in enumerate(messages):
        parts.append(f'"q{i}":{{"role":"user","content":"{q}"}}')
        extra = ("" if rating is None else f',"annotation":{{"rating":{rating}}}') + ("" if ts is None else f',"timestamp":{ts}')
        parts.append(f'"a{i}":{{"role":"assistant","parentId":"q{i}","content":"{a}"{extra}}}')
    return '{"history":{"messages":{' + ",".join(parts) + "}}}"


def rebuilt(spark, chats, users):
    """The batch table over each chat's latest version."""
    df = spark.createDataFrame([(i, *v) for i, v in chats.items()], SCHEMA)
    table = R.build_reward_cache(R.reward_samples(C.clean_feedback(E.extract_feedback(df, users, sort=False))))
    return sorted((r.key, r.reward, r.n_ratings) for r in table.collect())


def table(spark, base, users):
    return sorted((r.key, r.reward, r.n_ratings) for r in RS.reward_table(spark, base, users).collect())


def test_changed_chats_and_restarts(spark):
    """Four landings, a restarted job for each: re-rated, no longer rated, moved to another key, broken, another user; a user who comes late; compaction."""
    rng = random.Random(4)
    users = spark.createDataFrame([(1, "a@x"), (2, "b@x"), (3, "c@x")], "id bigint, email string")
    base, chats = scratch_path(spark, "t-state"), {}
    ask = lambda: [(f"Q {rng.randrange(3)}", f"A {rng.randrange(2)}", rng.choice([1, 2, 3, 4, 5, None, 10]), rng.choice([None, 1000, 2000, 3000]))
                   for _ in range(rng.randrange(4))]
    for turn in range(4):
        landed = {i: (rng.randrange(1, 5), doc(ask()) if rng.random() < 0.9 else "not json", turn) for i in rng.sample(range(30), 30 if turn == 0 else 12)}
        chats.update(landed)
        rows = [(i, *v) for i, v in landed.items()]
        spark.createDataFrame(rows, SCHEMA).repartition(2).write.mode("append").parquet(f"{base}/landing")
        RS.drain(ST.chat_stream(spark, f"{base}/landing", max_files_per_trigger=1 if turn == 0 else None), f"{base}/s")
        want = rebuilt(spark, chats, users)
        assert table(spark, f"{base}/s", users) == want and want
        if turn == 1:
            assert RS.compact(spark, f"{base}/s") == 1
            assert table(spark, f"{base}/s", users) == want
    late = users.union(spark.createDataFrame([(4, "d@x")], users.schema))
    assert table(spark, f"{base}/s", late) == rebuilt(spark, chats, late) != want
    # a run with nothing new changes nothing
    RS.drain(ST.chat_stream(spark, f"{base}/landing"), f"{base}/s")
    assert table(spark, f"{base}/s", users) == want


def test_versions_in_one_batch_and_text_ids(spark):
    schema = "id string, user_id string, chat string, updated_at bigint"
    users = spark.createDataFrame([("u", "u@x")], "id string, email string")
    base = scratch_path(spark, "t-state-text")
    rows = [("c", "u", doc([("Q", "A", 1, 5)]), 10), ("c", "u", doc([("Q", "A", 5, 5)]), 20), ("c", "u", doc([("Q", "A", 3, 5)]), None),
            ("d", "u", doc([("Q", "A", 2, 9)]), 1), (None, "u", doc([("Q", "A", 4, 1)]), 1)]
    spark.createDataFrame(rows, schema).coalesce(1).write.parquet(f"{base}/landing")
    RS.drain(ST.chat_stream(spark, f"{base}/landing", schema=schema), f"{base}/s")
    assert table(spark, f"{base}/s", users) == [("q|||a", 1.0, 2)]
    spark.createDataFrame([("c", "u", doc([]), 30)], schema).write.mode("append").parquet(f"{base}/landing")
    RS.drain(ST.chat_stream(spark, f"{base}/landing", schema=schema), f"{base}/s")
    assert table(spark, f"{base}/s", users) == [("q|||a", -0.5, 1)]
    spark.createDataFrame([("d", "u", doc([]), 30)], schema).write.mode("append").parquet(f"{base}/landing")
    RS.drain(ST.chat_stream(spark, f"{base}/landing", schema=schema), f"{base}/s")
    assert table(spark, f"{base}/s", users) == []


def test_differences_add_up_in_any_order():
    rng = random.Random(2)
    frame = lambda rows: pd.DataFrame(rows, columns=["updated_at", "doc", "key", "user", "msg_pos", "epoch", "reward"])
    old, sent, log = [], [], []
    for v in range(30):
        rows = [(v, f"d{v}", rng.choice(["k", None]), "u", p, rng.choice([None, 7.0, 9.0]), rng.choice([-1.0, 0.0, 1.0])) for p in range(rng.randrange(1, 4))]
        old, changed = RS.difference(old, frame(rows))
        log.append(rows)
        sent += [((1, what[2], what[3], what[4]), sign) for what, sign in changed]
    want = [(1, p, None if e is None else int(e), r) for _, _, k, _, p, e, r in log[-1] if k]
    for _ in range(5):
        rng.shuffle(sent)
        held = []
        for i in range(0, len(sent), 4):
            held = RS.applied(held, sent[i:i + 4])
        assert sorted(map(repr, (tuple(w) for w, n in held for _ in range(n)))) == sorted(map(repr, want))
        n, what = RS.last_write(held)
        assert n == len(want)
        if want:
            assert tuple(what) == max(want, key=lambda w: (w[2] is not None, -(w[2] or 0), w[0], w[1]))


def test_nothing_landed(spark):
    with pytest.raises(ValueError):
        RS.current_groups(spark, scratch_path(spark, "t-none"))


def test_state_is_in_rocksdb_and_settings_come_back(spark):
    spark.conf.set(RS._PROVIDER, "org.apache.spark.sql.execution.streaming.state.HDFSBackedStateStoreProvider")
    base = scratch_path(spark, "t-rocks")
    users = spark.createDataFrame([(1, "a@x")], "id bigint, email string")
    try:
        spark.createDataFrame([(7, 1, doc([("Q", "A", 4, 1)]), 1)], SCHEMA).write.parquet(f"{base}/landing")
        RS.drain(ST.chat_stream(spark, f"{base}/landing"), f"{base}/s")
        assert spark.conf.get(RS._PROVIDER).endswith("HDFSBackedStateStoreProvider")
    finally:
        spark.conf.set(RS._PROVIDER, RS.ROCKS)
    assert table(spark, f"{base}/s", users) == [("q|||a", 0.5, 1)]
    offsets = "".join(r.value for r in spark.read.text(f"{base}/s/by-key/offsets").collect())
    assert "RocksDBStateStoreProvider" in offsets
