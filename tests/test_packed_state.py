"""The state functions get and give one text column: every further column of a group is a series of its own."""

import json

import pandas as pd

from rewardloom.session import scratch_path
from rewardloom.streaming import incremental as ST, reward_state as RS
from tests.test_reward_state import SCHEMA, doc, rebuilt, table


def test_state_functions_take_one_column(spark):
    df = spark.createDataFrame([(1, 7, doc([("Q", "A", 4, 1)]), 1)], SCHEMA)
    plan = RS._differences(df, df.schema["id"].dataType)._jdf.queryExecution().optimizedPlan().toString()
    line = next(x for x in plan.splitlines() if "FlatMapGroupsInPandasWithState" in x)
    assert "chat_id" in line and "row" in line and "msg_pos" not in line, line


def test_odd_texts_come_through(spark):
    odd = ['quote \\" and \\\\', "tab \\t line \\n", "\\u0001 \U0001f642 \u00e9", "{}", "null"]
    users = spark.createDataFrame([(1, "a@x")], "id bigint, email string")
    chats = {i: (1, doc([(q, "A", 1 + i, None if i % 2 else 10**10 + i)]), i) for i, q in enumerate(odd)}
    base = scratch_path(spark, "t-state-odd")
    spark.createDataFrame([(i, *v) for i, v in chats.items()], SCHEMA).write.parquet(f"{base}/landing")
    RS.drain(ST.chat_stream(spark, f"{base}/landing"), f"{base}/s")
    want = rebuilt(spark, chats, users)
    assert table(spark, f"{base}/s", users) == want and len(want) == len(odd)


def test_a_frame_and_packed_rows_agree():
    rows = [(1, "a", "k", "u", 0, None, 0.5), (2, "b", None, "u", 1, 7, None), (2, "b", "k2", "u", 2, 7, -1.0)]
    frame = pd.DataFrame(rows, columns=RS._VERSION)
    packed = [pd.DataFrame({"row": [json.dumps({k: v for k, v in zip(RS._VERSION, r) if v is not None}) for r in rows]})]
    want = ([["k2", "u", 2, 7, -1.0]], [(("k2", "u", 2, 7, -1.0), 1)])
    assert RS.difference([], frame) == RS._difference([], RS._rows(packed, RS._VERSION)) == want
