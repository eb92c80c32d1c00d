"""The vocabulary lookup: frequent tokens where the rows lie, the rest through a join, with the same ids and texts."""

import pytest
from pyspark.sql import functions as F

from rewardloom.functions.text import corpus_tokens
from rewardloom.operators import prompts as D
from tests.test_skew import conf

TEXTS = ["a b a c", "a  b\td\u00a0 e", "\u00a0 x \u00a0 y", "   ", "", None, "a b a c", "z " * 300 + "a", "long" * 30 + " b a", "<unk> a </s>"]


@pytest.fixture(params=[3, 5, 1 << 18])
def head(request, monkeypatch):
    monkeypatch.setattr(D, "HEAD_IDS", request.param)


def words(text, most=None):
    return [] if text is None else text.strip().split()[:most] if text.isascii() else None


def test_first_tokens_are_the_slice(spark):
    df = spark.createDataFrame([(t,) for t in TEXTS], "t string")
    for most in (1, 2, 128):
        rows = df.select(corpus_tokens(F.col("t"), most).alias("got"), F.slice(corpus_tokens(F.col("t")), 1, most).alias("want")).collect()
        assert all(r.got == r.want for r in rows)


def test_heads_give_what_whole_prompts_give(spark, head):
    df = spark.createDataFrame([(t,) for t in TEXTS], "question string").repartition(3)
    up = D.unique_prompts(df)
    vocab = D.build_vocab(up, "prompt")
    ids = {r.token: r.token_id for r in vocab.collect()}
    for most in (2, 128):
        whole, heads = (sorted(D.tokenize_prompts(p, vocab, most).collect()) for p in (up, D.unique_heads(df, "question", most)))
        assert whole == heads and len(heads) == 6
        by_key = {r.prompt_key: r.prompt for r in up.collect()}
        for r in heads:
            want = words(by_key[r.prompt_key], most)
            assert want is None or r.input_ids == [ids[t] for t in want]
            assert r.attention_mask == [1] * len(r.input_ids)


def test_keys_may_repeat_or_be_missing(spark, head):
    """Rows of one key are one row, by place and then id or token; no key is a key as well."""
    vocab = spark.createDataFrame([(t, i, 1) for i, t in enumerate(["<pad>", "</s>", "<unk>", "a", "b", "c", "d"])], "token string, token_id bigint, n bigint")
    rows = [(1, ["d", "a"]), (1, ["b"]), (None, ["c", "new"]), (None, ["a"]), (2, []), (3, None)]
    df = spark.createDataFrame(rows, "k int, t array<string>").repartition(3)
    got = {r.k: r.input_ids for r in D.encode(df, "k", F.col("t"), vocab, keep_empty=True).collect()}
    assert got == {1: [4, 6, 3], None: [3, 5, 2], 2: [], 3: []}
    st = df.select(F.struct("k").alias("s"), "t")
    got = {r.s.k: r.input_ids for r in D.encode(st, "s", F.col("t"), vocab, keep_empty=True).collect()}
    assert got == {1: [4, 6, 3], None: [3, 5, 2], 2: [], 3: []}
    ids = spark.createDataFrame([(1, [6, 3]), (1, [4, 2]), (None, [5, 99]), (None, [3]), (2, []), (3, None), (4, [0, 1, 2])], "k int, i array<int>").repartition(3)
    got = {r.k: r.text for r in D.decode(ids, "k", "i", vocab).collect()}
    assert got == {1: "b d a", None: "a c", 2: "", 3: "", 4: ""}


def test_frequent_tokens_are_not_shuffled(spark):
    """However large the vocabulary, its frequent part is broadcast."""
    df = spark.createDataFrame([(f"a b w{i}",) for i in range(500)], "question string")
    vocab = D.build_vocab(D.unique_prompts(df), "prompt")
    with conf(spark, **{"spark.sql.autoBroadcastJoinThreshold": "1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "1"}):
        enc = D.tokenize_prompts(D.unique_heads(df), vocab)
        plan = enc._jdf.queryExecution().executedPlan().toString()
        assert "BroadcastHashJoin [token" in plan
        back = D.decode(enc, "prompt_key", "input_ids", vocab)
        assert "BroadcastHashJoin [tid" in back._jdf.queryExecution().executedPlan().toString()
        assert sorted(r.text for r in back.collect()) == sorted(r.question for r in df.collect())
