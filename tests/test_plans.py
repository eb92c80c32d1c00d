"""Plan-shape checks."""

import pytest

from rewardloom.plans import QUERIES
from tests.conftest import SF01


def plan_text(df, mode="formatted"):
    return df._jdf.queryExecution().optimizedPlan().toString() if mode == "optimized" else \
        df._jdf.queryExecution().executedPlan().toString()


def test_chat_document_parsed_once(spark):
    from rewardloom.operators import extract as E
    spark.catalog.clearCache()
    from rewardloom.plans.inputs import chat_and_users
    chat, users = chat_and_users(spark, SF01)
    text = plan_text(E.extract_feedback(chat, users), "optimized")
    assert text.count("StructField(history") == 1
    # chat, message, annotation and parent: each parsed exactly once
    assert text.count("from_json(") == 4


def test_unrated_topn_is_take_ordered(spark):
    text = plan_text(QUERIES["extract_unrated"](spark, SF01))
    assert "TakeOrderedAndProject" in text


@pytest.mark.parametrize("name", sorted(n for n in QUERIES
                                        if n not in ("reward_model_fit", "score_batch", "score_unrated",
                                                     "pair_model_selection", "subword_responses")))
def test_no_python_in_plans(spark, name):
    if name.startswith("stream_") or name in ("snapshot_roundtrip", "run_dry", "published_card"):
        pytest.skip("executes a write while being built")
    text = plan_text(QUERIES[name](spark, SF01))
    assert "EvalPython" not in text and "PythonUDF" not in text and "MapInPandas" not in text


def test_scan_prunes_columns(spark):
    df = QUERIES["rating_histogram"](spark, SF01)
    text = plan_text(df)
    # conversations has conv_id, turn, role, text: all four are needed; customer only 2 of 5
    assert "c_acctbal" not in text and "c_mktsegment" not in text


def test_recency_cutoff_reaches_the_chat_scan(spark):
    """Only when the caller vouches for the chat's update time."""
    from rewardloom.operators import extract as E
    from rewardloom.plans.inputs import chat_and_users
    chat, users = chat_and_users(spark, SF01)
    with_time = plan_text(E.extract_feedback(chat, users, days_back=3, as_of=1704672000, updated_col="updated_at"))
    assert "Or(IsNull(updated_at),GreaterThan(updated_at," in with_time
    assert "updated_at" not in plan_text(E.extract_feedback(chat, users, days_back=3, as_of=1704672000))


def test_no_parent_lookup_where_no_parent_is_used(spark):
    for name in ("explode_messages", "message_time", "unrated_messages", "rated_messages"):
        assert "parentId" not in plan_text(QUERIES[name](spark, SF01), "optimized").replace("StructField(parentId", "")
