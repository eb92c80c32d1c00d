"""Prompts through a pretrained subword tokenizer: the library's own ids, lossless both ways."""

import public_tokenizers
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from rewardloom.operators import prompts as D

PATH = public_tokenizers.path("byte_bpe_50k.json")
TEXTS = ["Hello world, naïve 日本語 text", "", None, "  two  spaces\n\nand lines ", "x" * 3000, "🙂 end"]


def test_ids_and_texts(spark):
    own = Tokenizer.from_file(PATH)
    df = spark.createDataFrame(list(enumerate(TEXTS)), "row int, text string").repartition(3)
    got = {r.row: r for r in D.tokenize_with(df, "text", D.subword_encoder(PATH), key="row", max_tokens=16).collect()}
    want = {i: own.encode(t, add_special_tokens=False).ids[:16] for i, t in enumerate(TEXTS) if t}
    assert {i: r.input_ids for i, r in got.items()} == want
    assert all(r.attention_mask == [1] * len(r.input_ids) for r in got.values())
    whole = D.tokenize_with(df, "text", D.subword_encoder(PATH), key="row", max_tokens=10**6)
    back = {r.row: r.text for r in D.decode_with(whole, "input_ids", D.subword_decoder(PATH)).collect()}
    assert back == {i: t for i, t in enumerate(TEXTS) if t}
    none = D.decode_with(spark.range(1).select(F.lit(None).cast("array<int>").alias("ids")), "ids", D.subword_decoder(PATH)).first()
    assert none.text == ""


def test_batches_follow_the_key(spark):
    rows = [(f"k{i:03d}", list(range(1, 2 + i % 5)), [1] * (1 + i % 5)) for i in range(43)]
    df = spark.createDataFrame(rows, "prompt_key string, input_ids array<int>, attention_mask array<int>").repartition(7)
    got = sorted(D.left_pad_batches(df, batch_size=4).collect(), key=lambda r: r.prompt_key)
    for i, (r, (key, ids, _)) in enumerate(zip(got, rows)):
        wide = max(len(x[1]) for x in rows[i // 4 * 4:i // 4 * 4 + 4])
        assert (r.batch_no, r.prompt_key, r.input_ids) == (i // 4, key, [0] * (wide - len(ids)) + ids)
        assert r.attention_mask == [0] * (wide - len(ids)) + [1] * len(ids)


def test_calls_are_bounded_and_made_once(spark):
    """No call gets much more than MOST_CHARS characters (or MOST_IDS ids) of several rows, and a filter doesn't encode again."""
    calls = spark.sparkContext.accumulator(0)

    def counting(most):
        def factory():
            def fn(values):
                if len(values) > 1 and sum(map(len, values)) > most:
                    raise ValueError("too much in one call")
                calls.add(len(values))
                return [[len(x)] for x in values] if isinstance(values[0], str) else [str(sum(x)) for x in values]
            return fn
        return factory

    rows = [(i, "x" * (D.MOST_CHARS // 3 + i)) for i in range(10)] + [(10, "y" * (2 * D.MOST_CHARS)), (11, None), (12, "")]
    df = spark.createDataFrame(rows, "row int, text string").coalesce(1)
    got = {r.row: r.input_ids for r in D.tokenize_with(df, "text", counting(D.MOST_CHARS), key="row").collect()}
    assert got == {i: [len(t or "")] for i, t in rows} and calls.value == len(rows)
    ids = df.select("row", F.array_repeat(F.lit(1), (F.length(F.coalesce("text", F.lit(""))) / 2).cast("int")).alias("ids"))
    back = {r.row: r.text for r in D.decode_with(ids, "ids", counting(D.MOST_IDS)).select("row", "text").collect()}
    assert back == {i: str(len(t or "") // 2) for i, t in rows}
