"""Hand-written edge tables; expectations derived by hand
from the source semantics, with Python/pandas as ground truth where the
source relies on them."""

import math

import pandas as pd
import pytest
from pyspark.sql import functions as F

from rewardloom.config import UNICODE_WS
from rewardloom.operators import clean as C, extract as E, prompts as D, rewards as R
from rewardloom.functions.order import seq_col


def chats(spark, rows):
    return spark.createDataFrame(rows, "id bigint, user_id bigint, chat string")


def users(spark):
    return spark.createDataFrame([(1, "a@x"), (2, "b@x")], "id bigint, email string")


def msgs(body):
    return '{"history":{"messages":{' + body + '}}}'


EDGE_CHATS = [
    # 1: JSON-null annotation -> rated with NULL rating
    (1, 1, msgs('"a":{"role":"user","content":"q1","timestamp":100},'
                '"b":{"role":"assistant","parentId":"a","content":"x","annotation":null,"timestamp":200}')),
    # 2: annotation false -> rated (key present), rating NULL; scalar message
    (2, 1, msgs('"a":{"role":"user","content":"q2"},'
                '"b":{"role":"assistant","parentId":"a","content":"y","annotation":false},"c":5')),
    # 3: missing parent -> NULL question; list content -> JSON text; bad timestamp
    (3, 2, msgs('"a":{"role":"assistant","parentId":"zz","content":["p",{"q":1}],'
                '"annotation":{"rating":"4"},"timestamp":"1.7e9"}')),
    # 4: duplicate keys -> two rows in document order
    (4, 2, msgs('"a":{"role":"user","content":"d1"},"a":{"role":"assistant","content":"d2"}')),
    # 5: array at messages, 6: malformed, 7: no user 99
    (5, 1, '{"history":{"messages":[1,2]}}'),
    (6, 1, '{"history":'),
    (7, 99, msgs('"a":{"role":"user","content":"z","annotation":{"rating":5}}')),
]


def test_json_null_and_key_presence(spark):
    fb = E.extract_feedback(chats(spark, EDGE_CHATS), users(spark), sort=False)
    got = {(r.chat_id, r.message_id): r for r in fb.collect()}
    assert set(got) == {(1, "b"), (2, "b"), (3, "a")}          # chat 7 has no user
    assert got[(1, "b")].rating is None and got[(1, "b")].question == "q1"
    assert got[(2, "b")].rating is None and got[(2, "b")].question == "q2"
    assert got[(3, "a")].question is None                      # unknown parent
    assert got[(3, "a")].answer == '["p",{"q":1}]'             # list content as JSON text
    assert got[(3, "a")].datetime is None                      # '1.7e9' is not an integer
    assert got[(1, "b")].datetime is not None


def test_unrated_excludes_json_null_and_scalars(spark):
    un = E.unrated_rows(chats(spark, EDGE_CHATS), users(spark))
    assert {(r.chat_id, r.message_id) for r in un.collect()} == {(4, "a")}


def test_duplicate_keys_and_bad_documents(spark):
    ex = E.explode_messages(chats(spark, EDGE_CHATS))
    rows = sorted((r.chat_id, r.msg_pos, r.message_id) for r in ex.collect())
    assert [r for r in rows if r[0] == 4] == [(4, 0, "a"), (4, 1, "a")]
    assert not [r for r in rows if r[0] in (5, 6)]
    prof = E.extract_profile(chats(spark, EDGE_CHATS)).first()
    assert prof.chats == 7
    assert prof.annotated == 4 and prof.annotated_json_null == 1
    assert prof.bad_chats == 2 and prof.bad_timestamps == 1


RATINGS = ["4", " 4 ", "4d", "4f", "1e400", "inf", "-inf", "nan", "", "1,000", ".5", "４",
           "Infinity", "+5", "1e5", " \t7\n", "0x10", "5.", None, "-1", "10", "n/a"]


def test_coerce_matches_pandas(spark):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(RATINGS)], "i int, rating string")
    got = {r.i: r.rating for r in C.coerce_rating(df).collect()}
    want = pd.to_numeric(pd.Series(RATINGS, dtype=object), errors="coerce")
    for i, w in enumerate(want):
        g = got[i]
        if isinstance(w, float) and math.isnan(w):
            assert g is None, (RATINGS[i], g)
        else:
            assert g == float(w), (RATINGS[i], g, w)


def test_strip_matches_python(spark):
    assert len(UNICODE_WS) == 29
    rows = [(i, f"{c}x{c}", f"{c}{c}") for i, c in enumerate(UNICODE_WS)]
    df = spark.createDataFrame(rows, "i int, question string, answer string")
    kept = C.strip_blank(df.select("i", "question", F.lit("a").alias("answer")))
    assert {r.question for r in kept.collect()} == {"x"}
    assert C.strip_blank(df).count() == 0                     # whitespace-only answers drop
    nulls = spark.createDataFrame([(1, None, "a")], "i int, question string, answer string")
    assert C.strip_blank(nulls).count() == 1                  # NULL kept, as pandas does


KEY_CASES = [("İstanbul", "ΟΔΟΣ"), ("  Q  ", "A" * 199 + "😀" + "tail"), ("é", "x"),
             ("a|||b", "c"), ("a", "b|||c"), (" Mixed Case　", "\tANSWER\n")]


def test_reward_key_matches_python(spark):
    df = spark.createDataFrame(KEY_CASES, "question string, answer string")
    got = [r.key for r in R.with_reward_key(df).collect()]
    want = [f"{q.strip().lower()[:200]}|||{a.strip().lower()[:200]}" for q, a in KEY_CASES]
    assert got == want
    assert got[3] == got[4]                                   # the '|||' collision is kept


def test_reward_clamp_and_midpoint(spark):
    df = spark.createDataFrame([(float(x),) for x in (-1, 1, 2, 3, 4, 5, 10)], "rating double")
    got = [r.reward for r in R.normalize_rating(df).collect()]
    assert got == [-1.0, -1.0, -0.5, 0.0, 0.5, 1.0, 1.0]
    inf = spark.createDataFrame([(float("inf"),), (float("-inf"),)], "rating double")
    assert [r.reward for r in R.normalize_rating(inf).collect()] == [1.0, -1.0]


def test_settings_reject_zero_range():
    from rewardloom.config import Settings
    with pytest.raises(ValueError):
        Settings(rating_min=3, rating_max=3)


def test_oldest_dated_rating_wins(spark):
    # same key rated 3 times: newest (t=300), oldest (t=100), undated; plus a
    # key rated only undated twice (then the later in source order wins)
    rows = [(1, "Q", "A", 5.0, 300), (2, " q", "a ", 1.0, 100), (3, "Q", "A", 3.0, None),
            (4, "P", "B", 2.0, None), (5, "P", "B", 4.0, None)]
    df = spark.createDataFrame(rows, "doc_id bigint, question string, answer string, rating double, epoch bigint")
    df = df.withColumn("seq", seq_col("epoch", "doc_id", F.lit(0)))
    cache = {r.key: r.reward for r in R.build_reward_cache(R.reward_samples(df)).collect()}
    assert cache == {"q|||a": -1.0, "p|||b": 0.5}


def test_source_order_nulls_first(spark):
    rows = [(1, None), (2, 50), (3, 100), (4, None), (5, 100)]
    df = spark.createDataFrame(rows, "chat_id bigint, epoch bigint").withColumn("msg_pos", F.lit(0))
    df = df.withColumn("seq", seq_col("epoch", "chat_id", "msg_pos"))
    assert [r.chat_id for r in df.orderBy("seq").collect()] == [1, 4, 3, 5, 2]


def test_unpad_removes_pad_values_everywhere(spark):
    df = spark.createDataFrame([([0, 0, 5, 0, 7],), ([3],)], "input_ids array<int>")
    assert [r.input_ids for r in D.unpad(df).collect()] == [[5, 7], [3]]
    assert [r.input_ids for r in D.unpad(df, pad_id=7).collect()] == [[0, 0, 5, 0], [3]]


def test_raw_message_sample_is_first_annotated(spark):
    s = E.raw_message_sample(chats(spark, EDGE_CHATS), chars=30).collect()
    assert len(s) == 1 and (s[0].chat_id, s[0].msg_pos) == (1, 1)
    assert s[0].raw_preview == '{"role":"assistant","parentId"'


def test_external_tokenizer_hook(spark):
    df = spark.createDataFrame([("k1", "a b c"), ("k2", "   "), ("k3", "x " * 300)],
                               "prompt_key string, prompt string")

    def factory():
        return lambda texts: [[len(w) for w in t.split()] for t in texts]

    got = {r.prompt_key: (r.input_ids, r.attention_mask)
           for r in D.tokenize_with(df, "prompt", factory).collect()}
    assert set(got) == {"k1", "k3"}                       # empty encoding dropped
    assert got["k1"] == ([1, 1, 1], [1, 1, 1])
    assert len(got["k3"][0]) == 128                       # truncated


def test_empty_inputs(spark):
    from rewardloom.operators import runs as O
    empty_texts = spark.createDataFrame([], "prompt string")
    up = D.unique_prompts(empty_texts, "prompt")
    vocab = D.build_vocab(up, "prompt")
    assert sorted(r.token_id for r in vocab.collect()) == [0, 1, 2]       # specials only
    enc = D.tokenize_prompts(up, vocab)
    assert enc.count() == 0 and D.left_pad_batches(enc).count() == 0
    run = O.feedback_run(chats(spark, []), users(spark), run_id="e")
    assert O.execute_run(run, dry_run=True)["status"] == "no_feedback"


def test_sql_views(spark):
    from rewardloom.plans.inputs import chat_and_users
    from rewardloom.plans.views import register_views
    from tests.conftest import SF01
    chat, users = chat_and_users(spark, SF01)
    names = register_views(chat, users, prefix="t_")
    assert names == ["t_feedback", "t_unrated", "t_clean_feedback", "t_samples", "t_reward_table"]
    got = spark.sql("SELECT count(*) AS n, count_if(datetime IS NULL) AS undated FROM t_feedback").first()
    assert (got.n, got.undated) == (391, 28)
    top = spark.sql("SELECT chat_id, message_id FROM t_unrated ORDER BY datetime DESC NULLS FIRST, "
                    "chat_id, msg_pos LIMIT 5").collect()
    assert len(top) == 5
    assert spark.sql("SELECT count(*) FROM t_samples").first()[0] == 216


def test_out_of_range_and_stale_times(spark):
    """A time that no timestamp holds is NULL and counted, and a stale chat time loses no message unless asked for."""
    def doc(ts):
        return '{"history":{"messages":{"a":{"role":"user","content":"x","timestamp":%s,"annotation":{"rating":1}}}}}' % ts
    df = spark.createDataFrame([(1, 1, doc("99999999999999999"), None), (2, 1, doc("-99999999999999999"), None), (3, 1, doc("1704067200"), 5)],
                               "id bigint, user_id bigint, chat string, updated_at bigint")
    u = spark.createDataFrame([(1, "e")], "id bigint, email string")
    got = {r.chat_id: r.datetime for r in E.extract_feedback(df, u).collect()}
    assert got[1] is None and got[2] is None and got[3] is not None
    assert E.extract_profile(df).first().bad_timestamps == 2
    assert [r.chat_id for r in E.extract_feedback(df, u, days_back=3, as_of=1704067300).collect()] == [3]
    assert E.extract_feedback(df, u, days_back=3, as_of=1704067300, updated_col="updated_at").count() == 0


def test_long_chat_finds_every_parent(spark):
    import json
    n = 3000
    messages = {f"m{i}": {"role": "user", "content": f"c{i}", "annotation": {"rating": 1}} for i in range(n)}
    for i in range(1, n):
        messages[f"m{i}"]["parentId"] = f"m{(i * 7) % n}" if i % 10 else "unknown"
    df = spark.createDataFrame([(1, 1, json.dumps({"history": {"messages": messages}}))], "id bigint, user_id bigint, chat string")
    got = {r.message_id: r.question for r in E.message_fields(E.explode_with_parent(df, E.is_rated)).select("message_id", "question").collect()}
    assert got == {f"m{i}": (f"c{(i * 7) % n}" if i and i % 10 else None) for i in range(n)}


def test_decode_keeps_every_row(spark):
    from rewardloom.operators import prompts as D
    rows = [(1, "q", "hello w"), (2, "q", None), (3, None, "hi"), (4, "", ""), (5, None, None), (6, "q", "hello w")]
    df = spark.createDataFrame(rows, "row int, question string, response string")
    vocab = D.build_vocab(df.selectExpr("concat_ws(' ', question, response) AS t"), "t")
    got = {r.row: r.response_text for r in D.decode_responses(D.generated_ids(df, vocab, "row"), vocab, "row").collect()}
    assert got == {1: "hello w", 2: "", 3: "hi", 4: "", 5: "", 6: "hello w"}


def test_template_is_a_parameter(spark):
    from rewardloom.operators import preference as P
    df = spark.createDataFrame([("a", "b"), (None, "c")], "question string, answer string")
    got = [r.text for r in P.format_qa(df, template="{{A}} {answer} / {question} / {answer}").collect()]
    assert got == ["{A} b / a / b", "{A} c / None / c"]
    import pytest as _pytest
    with _pytest.raises(ValueError):
        P.format_qa(df, template="{other}")
