"""Registered prompt-dataset queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from rewardloom.operators import prompts as D
from rewardloom.plans.oracle import tokens, vocab_sql
from rewardloom.plans.registry import query
from rewardloom.plans.inputs import prompts, rated_base, responses
from rewardloom.session import materialize
from rewardloom.sources import fixtures as fx


def ids_text(c: str):
    """Comparable rendering of an integer array: comma-joined."""
    return F.array_join(F.transform(c, lambda x: x.cast("string")), ",").alias(c)


def _prompts(spark, sf):
    return D.unique_prompts(prompts(spark, sf), "prompt")


def _encoded(spark, sf):
    # the vocabulary counts whole texts and is written once, by its numbering; the encode needs no more of a text than its
    # first tokens
    vocab = D.build_vocab(_prompts(spark, sf), "prompt")
    return D.tokenize_prompts(D.unique_heads(prompts(spark, sf), "prompt"), vocab)


_UP = "up AS (SELECT DISTINCT prompt FROM fx_prompts WHERE prompt IS NOT NULL)"
_PV = f"pv AS ({vocab_sql('SELECT prompt AS txt FROM up')})"
_ENC = f"""enc AS (
  SELECT prompt_key, string_agg(CAST(coalesce(v.token_id, 2) AS VARCHAR), ',' ORDER BY pos) AS input_ids,
         count(*) AS n_tok
  FROM (SELECT prompt_key, unnest(t) AS token, unnest(range(1, len(t) + 1)) AS pos
        FROM (SELECT sha256(prompt) AS prompt_key, list_slice({tokens('prompt')}, 1, 128) AS t FROM up))
  LEFT JOIN pv v USING (token)
  GROUP BY prompt_key)"""


def _with(*parts: str) -> str:
    return ",\n".join(parts)


@query("unique_prompts", """
SELECT DISTINCT prompt, sha256(prompt) AS prompt_key FROM fx_prompts WHERE prompt IS NOT NULL""")
def unique_prompts(spark, sf):
    return _prompts(spark, sf)


@query("prompt_vocab", vocab_sql("SELECT text AS txt FROM conversations WHERE role = 'user'"))
def prompt_vocab(spark, sf):
    return D.build_vocab(fx.user_turns(spark, sf), "text")


@query("tokenize_prompts", f"""
, {_with(_UP, _PV, _ENC)}
SELECT prompt_key, input_ids, rtrim(repeat('1,', n_tok), ',') AS attention_mask FROM enc""")
def tokenize_prompts(spark, sf):
    e = _encoded(spark, sf)
    return e.select("prompt_key", ids_text("input_ids"), ids_text("attention_mask"))


_BATCH = f"""
, {_with(_UP, _PV, _ENC)},
b AS (SELECT *, (row_number() OVER (ORDER BY prompt_key) - 1) // 4 AS batch_no FROM enc),
p AS (SELECT *, max(n_tok) OVER (PARTITION BY batch_no) - n_tok AS k FROM b)"""


@query("left_pad_batches", _BATCH + """
SELECT CAST(batch_no AS BIGINT) AS batch_no, prompt_key,
       repeat('0,', CAST(k AS BIGINT)) || input_ids AS input_ids,
       repeat('0,', CAST(k AS BIGINT)) || rtrim(repeat('1,', n_tok), ',') AS attention_mask
FROM p""")
def left_pad_batches(spark, sf):
    b = D.left_pad_batches(_encoded(spark, sf))
    return b.select("batch_no", "prompt_key", ids_text("input_ids"), ids_text("attention_mask"))


@query("unpad_batches", f"""
, {_with(_UP, _PV, _ENC)}
SELECT prompt_key, input_ids FROM enc""")
def unpad_batches(spark, sf):
    b = D.unpad(D.left_pad_batches(_encoded(spark, sf)))
    return b.select("prompt_key", ids_text("input_ids"))


_RV = f"""rv AS ({vocab_sql("SELECT question AS txt FROM fx_rated UNION ALL SELECT answer FROM fx_rated")})"""


# generated rows: every response once, and again (a later epoch) with a missing, an empty or the same response,
# and with neither text
_GENERATED = """gr AS (
  SELECT doc_id, 0 AS epoch, question, response FROM fx_responses
  UNION ALL SELECT doc_id, 1, question, CASE WHEN doc_id % 3 = 0 THEN NULL WHEN doc_id % 3 = 1 THEN '' ELSE response END
            FROM fx_responses WHERE doc_id % 5 = 0
  UNION ALL SELECT doc_id, 2, NULL, NULL FROM fx_responses WHERE doc_id % 50 = 0)"""


def _generated(spark, sf):
    r = responses(spark, sf).select("doc_id", "question", "response")
    did, none = F.col("doc_id"), F.lit(None).cast("string")
    again = F.when(did % 3 == 0, none).when(did % 3 == 1, F.lit("")).otherwise(F.col("response"))
    rows = (r.withColumn("epoch", F.lit(0))
             .unionByName(r.where(did % 5 == 0).withColumn("response", again).withColumn("epoch", F.lit(1)))
             .unionByName(r.where(did % 50 == 0).withColumns({"question": none, "response": none, "epoch": F.lit(2)})))
    return rows.withColumn("row", F.struct("doc_id", "epoch"))


@query("decode_responses", f"""
, {_RV}, {_GENERATED},
rt AS (SELECT doc_id, epoch, coalesce({tokens('response')}, []) AS t FROM gr),
kept AS (SELECT doc_id, epoch, token, pos
         FROM (SELECT doc_id, epoch, unnest(t) AS token, unnest(range(1, len(t) + 1)) AS pos FROM rt)
         JOIN rv USING (token) WHERE rv.token_id > 2)
SELECT r.doc_id, r.epoch, coalesce(a.response_text, '') AS response_text
FROM rt r LEFT JOIN (SELECT doc_id, epoch, string_agg(token, ' ' ORDER BY pos) AS response_text
                     FROM kept GROUP BY ALL) a ON a.doc_id = r.doc_id AND a.epoch = r.epoch""")
def decode_responses(spark, sf):
    texts = rated_base(spark, sf).select(F.explode(F.array("question", "answer")).alias("txt"))
    vocab = D.build_vocab(texts, "txt")
    generated = materialize(D.generated_ids(_generated(spark, sf), vocab, "row"), "generated")
    return D.decode_responses(generated, vocab, "row").select("row.doc_id", "row.epoch", "response_text")


@query("subword_responses", """
SELECT doc_id, response AS response_text FROM fx_responses""")
def subword_responses(spark, sf):
    """D3 and D8 with a pretrained subword tokenizer: prompt ids (128 at most) and response ids in one sequence, what follows
    the prompt decoded.  Its bytes come back as they were, so the twin is the response itself."""
    import public_tokenizers
    path = public_tokenizers.path("byte_bpe_50k.json")
    r = responses(spark, sf).select("doc_id", "question", "response")
    prompt = D.tokenize_with(r, "question", D.subword_encoder(path), key="doc_id").select("doc_id", F.col("input_ids").alias("prompt_ids"))
    every = 1 << 30                                     # responses aren't cut
    answer = D.tokenize_with(r, "response", D.subword_encoder(path), key="doc_id", max_tokens=every).select("doc_id", F.col("input_ids").alias("answer_ids"))
    both = r.select("doc_id").join(prompt, "doc_id", "left").join(answer, "doc_id", "left")
    none = F.array().cast("array<int>")
    rows = both.select("doc_id", F.coalesce("prompt_ids", none).alias("p"), F.coalesce("answer_ids", none).alias("a"))
    rows = rows.select("doc_id", F.concat("p", "a").alias("sequence_ids"), F.size("p").alias("prompt_len"))
    after = F.slice("sequence_ids", F.col("prompt_len") + 1, F.greatest(F.size("sequence_ids") - F.col("prompt_len"), F.lit(0)))
    return D.decode_with(rows.select("doc_id", after.alias("ids")), "ids", D.subword_decoder(path), "response_text").select("doc_id", "response_text")
