"""Prompt corpus, vocabulary, tokenization, batching and decoding.

The source pipeline tokenizes each prompt with a pretrained tokenizer in one
process.  Here tokenization is a corpus job: whitespace tokens are exploded
with their positions (bounded by the truncation length), looked up in a
vocabulary DataFrame with an equi-join (its frequent tokens broadcast, the rest a
sort-merge join that AQE splits where a key is hot), and regrouped per
prompt.  A regroup holds at most ``max_tokens`` entries.
"""

from __future__ import annotations

import os
from typing import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window, functions as F
from pyspark.sql.functions import pandas_udf

from rewardloom.config import DEFAULT_SETTINGS, EOS_ID, PAD_ID, SPECIAL_TOKENS, UNK_ID
from rewardloom.functions.text import corpus_tokens
from rewardloom.operators.indexing import sequential_index
from rewardloom.session import ship


# -- D1 ----------------------------------------------------------------------
def unique_prompts(df: DataFrame, col: str = "question") -> DataFrame:
    """Distinct prompt texts (NULL excluded), each with a content key
    (SHA-256 hex).  Deduplicating on the key (map-side partial aggregate)
    leaves the output hash-partitioned by ``prompt_key``, so the per-prompt
    regroup after a broadcast vocabulary lookup needs no further shuffle."""
    p = df.where(F.col(col).isNotNull()).select(F.sha2(F.col(col), 256).alias("prompt_key"),
                                                F.col(col).alias("prompt"))
    return p.dropDuplicates(["prompt_key"]).select("prompt", "prompt_key")


def unique_heads(df: DataFrame, col: str = "question", max_tokens: int = DEFAULT_SETTINGS.prompt_max_tokens) -> DataFrame:
    """The first ``max_tokens`` tokens of each distinct text: prompt_hash (a struct of the bytes of ``unique_prompts``' key, so never NULL) and head (the tokens, a
    space between them).  For ``tokenize_prompts``, which needs no more of a text: whole texts aren't shuffled."""
    p = df.where(F.col(col).isNotNull()).select(F.struct(F.unhex(F.sha2(F.col(col), 256)).alias("bytes")).alias("prompt_hash"),
                                                F.array_join(corpus_tokens(F.col(col), max_tokens), " ").alias("head"))
    return p.dropDuplicates(["prompt_hash"])


# -- D2 ----------------------------------------------------------------------
def build_vocab(texts: DataFrame, col: str) -> DataFrame:
    """token, token_id, n: ids 0-2 are <pad>, </s>, <unk> (n = 0); corpus
    tokens follow by (count desc, token asc).  Counting is a partial aggregate, so
    frequent tokens are combined map-side."""
    toks = texts.select(F.explode(corpus_tokens(F.col(col))).alias("token"))
    counts = (toks.where(~F.col("token").isin(*SPECIAL_TOKENS))
                  .groupBy("token").agg(F.count(F.lit(1)).alias("n")))
    ranked = sequential_index(counts, [F.col("n").desc(), F.col("token").asc()],
                              name="token_id", start=len(SPECIAL_TOKENS))
    specials = texts.sparkSession.createDataFrame(
        [(t, i, 0) for i, t in enumerate(SPECIAL_TOKENS)], "token string, token_id bigint, n bigint")
    return ranked.select("token", "token_id", "n").unionByName(specials)


# -- D3 / D4 / D5 ------------------------------------------------------------
HEAD_IDS, HEAD_CHARS = 1 << 18, 64      # the part of a vocabulary that is broadcast: at most this many tokens, each at most this long


def _tasks(df: DataFrame) -> int:
    """As many as a shuffle has; given in numbers they aren't joined into fewer, whose exploded rows would be spilled."""
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def _near_and_far(ex: DataFrame, vocab: DataFrame, on: str, value: str) -> tuple[DataFrame, DataFrame | None]:
    """``ex`` left-joined with (token, tid) on one of them, in two parts: all rows, looked up where they are in a broadcast of the lowest
    ids (ids follow the count, so that finds most), and the rows missed, shuffled to the rest of the vocabulary.  All rows
    are shuffled, and there is no second part, if the session broadcasts nothing."""
    if ex.sparkSession.conf.get("spark.sql.autoBroadcastJoinThreshold").startswith("-"):
        return ex.join(vocab, on, "left").select(*ex.columns, value), None
    often = (F.col("tid") < HEAD_IDS) & (F.length("token") <= HEAD_CHARS)
    near = ex.join(F.broadcast(vocab.where(often)), on, "left").select(*ex.columns, value)
    missed = near.where(F.col(value).isNull() & F.col(on).isNotNull()).drop(value)
    return near, missed.join(vocab.where(~often), on, "left").select(*ex.columns, value)


def encode(df: DataFrame, key: str, tokens_col, vocab: DataFrame, carry: tuple = (),
           keep_empty: bool = False) -> DataFrame:
    """Map a token array column to ids (unknown -> <unk>); rows with no
    tokens drop out unless ``keep_empty``.  ``key`` identifies a row;
    ``carry`` columns must be constant per key.
    Output: key, *carry, input_ids ARRAY<INT>, attention_mask ARRAY<INT>."""
    each = F.posexplode_outer(tokens_col) if keep_empty else F.posexplode(tokens_col)
    ex = df.select(key, *carry, each.alias("pos", "token"))
    v = vocab.select("token", F.col("token_id").cast("int").alias("tid"))
    # place and id in one long: a regroup moves and sorts 8 bytes a token
    item = lambda tid: F.when(F.col("pos").isNotNull(), F.shiftleft(F.col("pos").cast("long"), 32) + tid)
    by, known = [key, *carry], F.coalesce("tid", F.lit(UNK_ID))
    near, far = _near_and_far(ex, v, "token", "tid")
    if far is None or any(df.schema[c].nullable for c in by):      # a join on the key would lose a NULL key
        j = near if far is None else near.where(F.col("tid").isNotNull() | F.col("token").isNull()).unionByName(far)
        g = j.groupBy(*by).agg(F.sort_array(F.collect_list(item(known))).alias("_p"))
    else:                                                          # near's rows stay where they are, if they lie by key
        more = far.groupBy(*by).agg(F.collect_list(item(known)).alias("_more"))
        g = near.groupBy(*by).agg(F.collect_list(item(F.col("tid"))).alias("_p")).join(more, by, "left")
        g = g.withColumn("_p", F.sort_array(F.when(F.col("_more").isNull(), F.col("_p")).otherwise(F.concat("_p", "_more"))))
    ids = F.transform("_p", lambda e: e.bitwiseAND(F.lit((1 << 32) - 1)).cast("int"))
    return g.select(key, *carry, ids.alias("input_ids"),
                    F.array_repeat(F.lit(1), F.size("_p")).alias("attention_mask"))


def tokenize_prompts(prompts: DataFrame, vocab: DataFrame,
                     max_tokens: int = DEFAULT_SETTINGS.prompt_max_tokens) -> DataFrame:
    """Truncate to ``max_tokens`` tokens, encode, drop empty encodings,
    keep only (prompt_key, input_ids, attention_mask).  ``prompts`` are ``unique_prompts`` or ``unique_heads`` of as many tokens."""
    if "head" in prompts.columns:
        toks = F.slice(F.filter(F.split("head", " "), lambda t: t != F.lit("")), 1, max_tokens)
        enc = encode(prompts.select("prompt_hash", toks.alias("_t")), "prompt_hash", F.col("_t"), vocab)
        return enc.select(F.lower(F.hex("prompt_hash.bytes")).alias("prompt_key"), "input_ids", "attention_mask")
    toks = corpus_tokens(F.col("prompt"), max_tokens)
    return encode(prompts.select("prompt_key", toks.alias("_t")), "prompt_key", F.col("_t"), vocab)


# -- D6 ----------------------------------------------------------------------
def left_pad_batches(encoded: DataFrame, batch_size: int = DEFAULT_SETTINGS.batch_size, pad_id: int = PAD_ID) -> DataFrame:
    """Group prompts, by ascending key, into batches of ``batch_size`` (the last may be smaller) and
    left-pad each to its batch's longest prompt (mask 0 on pads).

    Prompts are numbered by the distributed index (a range shuffle, no window over many rows); the window that finds the
    longest holds one batch."""
    df = sequential_index(encoded, ["prompt_key"], "_no").withColumn("batch_no", F.floor(F.col("_no") / F.lit(batch_size)))
    wb = Window.partitionBy("batch_no")
    df = df.withColumn("_k", F.max(F.size("input_ids")).over(wb) - F.size("input_ids"))
    return df.select(
        "batch_no", "prompt_key",
        F.concat(F.array_repeat(F.lit(pad_id), F.col("_k")), "input_ids").alias("input_ids"),
        F.concat(F.array_repeat(F.lit(0), F.col("_k")), "attention_mask").alias("attention_mask"))


# -- D7 ----------------------------------------------------------------------
def unpad(df: DataFrame, pad_id: int = PAD_ID, col: str = "input_ids") -> DataFrame:
    """Drop every ``pad_id`` value (by value, as the training loop does)."""
    return df.withColumn(col, F.filter(col, lambda x: x != F.lit(pad_id)))


# -- D8 ----------------------------------------------------------------------
def decode(df: DataFrame, key: str, ids_col: str, vocab: DataFrame, out: str = "text") -> DataFrame:
    """ids -> text, skipping special tokens; tokens joined by one space.
    Every input row is kept (nothing decodable -> empty string)."""
    inv = vocab.where(~F.col("token_id").isin(PAD_ID, EOS_ID, UNK_ID)).select(
        F.col("token_id").cast("int").alias("tid"), "token")
    # ids are shuffled, once, to where their texts will stand.  A key inside a struct is equal to itself, NULL or not
    rows = df.select(F.struct(F.col(key).alias("key")).alias("_k"), F.col(ids_col).alias("_ids")).repartition(_tasks(df), "_k")
    ex = rows.select("_k", F.posexplode_outer("_ids").alias("pos", "tid"))
    found = F.when(F.col("token").isNotNull(), F.struct("pos", "token"))
    near, far = _near_and_far(ex, inv, "tid", "token")
    g = near.groupBy("_k").agg(F.collect_list(found).alias("_p"))
    if far is not None:
        more = far.where(F.col("token").isNotNull()).groupBy("_k").agg(F.collect_list(found).alias("_more"))
        g = g.join(more, "_k", "left").withColumn("_p", F.when(F.col("_more").isNull(), F.col("_p")).otherwise(F.concat("_p", "_more")))
    return g.select(F.col("_k.key").alias(key), F.array_join(F.transform(F.sort_array("_p"), lambda e: e["token"]), " ").alias(out))


def generated_ids(responses: DataFrame, vocab: DataFrame, key: str,
                  max_prompt_tokens: int = DEFAULT_SETTINGS.prompt_max_tokens) -> DataFrame:
    """What a generator returns for (question, response) texts: ``sequence_ids`` = prompt ids followed by
    response ids, and ``prompt_len``.  One row per input row; ``key`` identifies a row.  A missing text has no ids."""
    none = F.array().cast("array<string>")
    q = F.coalesce(corpus_tokens(F.col("question"), max_prompt_tokens), none)
    # texts are shuffled, once, to where their ids will stand
    placed = responses.select(key, "question", "response", F.size(q).alias("prompt_len")).repartition(_tasks(responses), key, "prompt_len")
    staged = placed.select(key, F.concat(q, F.coalesce(corpus_tokens(F.col("response")), none)).alias("_t"), "prompt_len")
    enc = encode(staged, key, F.col("_t"), vocab, carry=("prompt_len",), keep_empty=True)
    return enc.select(key, "prompt_len", F.col("input_ids").alias("sequence_ids"))


def decode_responses(generated: DataFrame, vocab: DataFrame, key: str, ids_col: str = "sequence_ids",
                     prompt_len_col: str = "prompt_len") -> DataFrame:
    """``decode(r[len(q):])`` of every generated sequence, once: the ids after the prompt part, looked up in the
    inverse vocabulary.  ``key`` must identify a row (a document seen in several epochs is several rows); every row
    is kept, with an empty text where nothing decodes."""
    n = F.greatest(F.size(ids_col) - F.col(prompt_len_col), F.lit(0))
    sliced = generated.select(key, F.slice(ids_col, F.col(prompt_len_col) + 1, n).alias("response_ids"))
    return decode(sliced, key, "response_ids", vocab, out="response_text")


# -- external tokenizer hook (D3) --------------------------------------------
MOST_CHARS, MOST_IDS = 1_000_000, 500_000     # of one call: the library holds some hundred bytes a token until it returns


def _in_runs(values: list, fn, most: int) -> pd.Series:
    """``fn`` over runs of ``values`` that hold about ``most`` elements in all (one value may hold more by itself)."""
    out, start, held = [], 0, 0
    for i, value in enumerate(values):
        if i > start and held + len(value) > most:
            out += fn(values[start:i])
            start, held = i, 0
        held += len(value)
    if start < len(values):
        out += fn(values[start:])
    return pd.Series(out, dtype="object")


def tokenize_with(df: DataFrame, text_col: str, encoder_factory, key: str = "prompt_key",
                  max_tokens: int = DEFAULT_SETTINGS.prompt_max_tokens) -> DataFrame:
    """D3 with a pretrained tokenizer instead of the corpus vocabulary.

    ``encoder_factory()`` is called once per Arrow batch stream (i.e. per
    task) and must return ``fn(list[str]) -> list[list[int]]`` — e.g. a
    batch ``encode`` of a tokenizer loaded from a shared path.  The work is
    an iterator pandas UDF over Spark's partitions, which hands it texts of at
    most ``MOST_CHARS`` characters at a time; truncation, the empty
    filter and the mask stay Spark expressions."""
    ship(df.sparkSession)

    @pandas_udf("array<int>")
    def _encode(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        fn = encoder_factory()
        for texts in batches:
            yield _in_runs(texts.fillna("").tolist(), lambda run: [np.array(ids, np.int32) for ids in fn(run)], MOST_CHARS)

    # not deterministic to the optimizer: a filter on the ids would otherwise be pushed below and encode every text again
    ids = F.slice(_encode.asNondeterministic()(F.col(text_col)), 1, max_tokens)
    out = df.select(key, ids.alias("input_ids")).where(F.size("input_ids") > 0)
    return out.withColumn("attention_mask", F.array_repeat(F.lit(1), F.size("input_ids")))


def subword_encoder(path: str):
    """For ``tokenize_with``: a subword tokenizer from its JSON file, which every worker must reach by that path."""
    def factory():
        os.environ["TOKENIZERS_PARALLELISM"] = "false"     # one task, one core
        from tokenizers import Tokenizer
        tokenizer = Tokenizer.from_file(path)
        return lambda texts: [e.ids for e in tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
    return factory


def subword_decoder(path: str):
    """For ``decode_with``: ids back to text, special tokens skipped."""
    def factory():
        from tokenizers import Tokenizer
        tokenizer = Tokenizer.from_file(path)
        return lambda ids: tokenizer.decode_batch(ids, skip_special_tokens=True)
    return factory


def decode_with(df: DataFrame, ids_col: str, decoder_factory, out: str = "text") -> DataFrame:
    """D8 with a pretrained tokenizer: ``decoder_factory()`` is called once per task and returns
    ``fn(list[list[int]]) -> list[str]``.  A NULL array decodes to an empty text."""
    ship(df.sparkSession)

    @pandas_udf("string")
    def _decode(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        fn = decoder_factory()
        for ids in batches:
            yield _in_runs([() if x is None else x for x in ids], lambda run: fn([[int(i) for i in x] for x in run]), MOST_IDS)

    return df.withColumn(out, _decode(F.col(ids_col)))
