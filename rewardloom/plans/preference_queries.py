"""Registered preference-pair and scorer queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from rewardloom.operators import exact_scorer as X, extract as E, preference as P, rewards as R
from rewardloom.plans.inputs import chat_and_users, rated
from rewardloom.plans.oracle import key as okey, tokens as otokens
from rewardloom.plans.registry import query

SEED = 42

_DEDUP = f"""
, d AS (SELECT * FROM (
    SELECT *, row_number() OVER (PARTITION BY key ORDER BY epoch ASC NULLS LAST, doc_id DESC) AS rn
    FROM (SELECT *, {okey('question', 'answer')} AS key FROM fx_rated_dup)) WHERE rn = 1),
c AS (SELECT * FROM (
    SELECT question, answer AS chosen, rating AS chosen_rating,
           row_number() OVER (PARTITION BY question ORDER BY rating DESC, epoch DESC NULLS FIRST, doc_id) AS rn
    FROM d) WHERE rn = 1),
pairs AS (SELECT d.question AS prompt, c.chosen, d.answer AS rejected, c.chosen_rating,
                 d.rating AS rejected_rating, c.chosen_rating - d.rating AS margin
          FROM d JOIN c USING (question) WHERE d.rating < c.chosen_rating)"""


def _bucket_sql(col: str) -> str:
    return f"('0x' || substr(md5(concat('{SEED}:', {col})), 1, 8))::UBIGINT % 10"


def pairs(spark, sf):
    return P.preference_pairs(R.reward_samples(rated(spark, sf, dup=True)))


@query("preference_pairs", _DEDUP + """
SELECT prompt, chosen, rejected, chosen_rating, rejected_rating, margin FROM pairs""")
def preference_pairs(spark, sf):
    return pairs(spark, sf)


CAP = 12


@query("preference_pairs_capped", _DEDUP + f"""
SELECT prompt, chosen, rejected, chosen_rating, rejected_rating, margin FROM (
  SELECT a.question AS prompt, a.answer AS chosen, b.answer AS rejected, a.rating AS chosen_rating, b.rating AS rejected_rating,
         a.rating - b.rating AS margin,
         row_number() OVER (PARTITION BY a.question ORDER BY a.rating - b.rating DESC, a.rating DESC, b.rating,
           a.epoch DESC NULLS FIRST, a.doc_id, b.epoch DESC NULLS FIRST, b.doc_id) AS rn
  FROM d a JOIN d b ON a.question = b.question AND a.rating > b.rating)
WHERE rn <= {CAP}""")
def preference_pairs_capped(spark, sf):
    """The widest pairs of every prompt, of all better/worse ones."""
    return P.preference_pairs_capped(R.reward_samples(rated(spark, sf, dup=True)), CAP)


@query("format_qa", """
SELECT doc_id, concat('Câu hỏi: ', coalesce(question, 'None'), chr(10) || chr(10) || 'Trả lời: ',
                      coalesce(answer, 'None')) AS text
FROM fx_rated""")
def format_qa(spark, sf):
    return P.format_qa(rated(spark, sf)).select("doc_id", "text")


@query("train_test_split", f"""
SELECT doc_id, question, CAST({_bucket_sql('question')} AS BIGINT) AS bucket,
       CASE WHEN {_bucket_sql('question')} = 0 THEN 'test' ELSE 'train' END AS split
FROM fx_rated""")
def train_test_split(spark, sf):
    return P.train_test_split(rated(spark, sf), "question", seed=SEED) \
            .select("doc_id", "question", "bucket", "split")


@query("pair_eval", _DEDUP + f"""
SELECT split, accuracy, round(loss, 9) AS loss, n_pairs FROM (
  SELECT CASE WHEN {_bucket_sql('prompt')} = 0 THEN 'test' ELSE 'train' END AS split,
         avg(CASE WHEN dd > 0 THEN 1.0 ELSE 0.0 END) AS accuracy,
         avg(greatest(-dd, 0.0) + ln(1 + exp(-abs(dd)))) AS loss, count(*) AS n_pairs
  FROM (SELECT *, (length(chosen) - length(rejected)) / 1000.0 AS dd FROM pairs) GROUP BY 1)""")
def pair_eval(spark, sf):
    """Pair metrics with a fixed, model-free score (text length / 1000) so the
    metric arithmetic itself is oracle-checked."""
    p = P.train_test_split(pairs(spark, sf), "prompt", seed=SEED)
    s = p.select("split", (F.length("chosen") / 1000.0).alias("score_chosen"),
                 (F.length("rejected") / 1000.0).alias("score_rejected"))
    m = P.pair_metrics(s)
    return m.select("split", "accuracy", F.round("loss", 9).alias("loss"), "n_pairs")


STEPS, REGS = 24, (0.0, 0.01, 0.1)


def _features_sql(name: str, keys: str, source: str) -> str:
    """(keys, j, x): the features of each question and answer of ``source``."""
    text = ("concat('Câu hỏi: ', coalesce(question, 'None'), chr(10) || chr(10) || 'Trả lời: ', coalesce(answer, 'None'))")
    return f"""
, {name} AS (
  SELECT {keys}, j, (1024 * count(*)) // n AS x
  FROM (SELECT {keys}, len(t) AS n, ('0x' || substr(md5(unnest(t)), 1, 8))::UBIGINT % 256 AS j
        FROM (SELECT {keys}, list_slice({otokens(text)}, 1, 512) AS t FROM {source}))
  GROUP BY {keys}, n, j)"""


def _fit_sql(regs: tuple) -> str:
    """Every step of the solver: steps(it, reg, j, w, y)."""
    return _DEDUP + _features_sql("xs", "key", "d") + f"""
, best AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY question ORDER BY rating DESC, epoch DESC NULLS FIRST, doc_id) AS place FROM d)
           WHERE place = 1)
, pair AS (SELECT d.key AS pid, best.key AS better, {_bucket_sql('d.question')} = 0 AS held_out
           FROM d JOIN best USING (question) WHERE d.rating < best.rating)
, diff AS (SELECT pid, held_out, j, sum(v)::BIGINT AS v
           FROM (SELECT pid, held_out, j, x AS v FROM pair JOIN xs ON xs.key = better
                 UNION ALL SELECT pid, held_out, j, -x FROM pair JOIN xs ON xs.key = pid)
           GROUP BY ALL HAVING sum(v) <> 0)
, learn AS (SELECT pid, j, v FROM diff WHERE NOT held_out)
, many AS (SELECT count(*)::DOUBLE AS n FROM pair WHERE NOT held_out)
, widths AS (SELECT pid, sum(abs(v)) AS l1 FROM learn GROUP BY pid)
, curves AS (SELECT j, sum(abs(v) * l1)::DOUBLE AS a FROM learn JOIN widths USING (pid) GROUP BY j)
, steps AS (
  SELECT 0 AS it, reg, j, 0::BIGINT AS w, 0::BIGINT AS y
  FROM (SELECT unnest([{', '.join(f'{r}::DOUBLE' for r in regs)}]) AS reg), (SELECT unnest(range(256)) AS j)
  UNION ALL
  SELECT it + 1, reg, j, new, new + floor((new - w) * ((it + 1)::DOUBLE / (it + 4)::DOUBLE) + 0.5::DOUBLE)::BIGINT
  FROM (
    SELECT s.it, s.reg, s.j, s.w,
      s.y + CASE WHEN coalesce(c.a, 0::DOUBLE) / (4::DOUBLE * n * 1048576::DOUBLE) + s.reg > 0
        THEN floor((coalesce(g.g, 0)::DOUBLE / (1024::DOUBLE * n) - s.reg * s.y)
                   / (coalesce(c.a, 0::DOUBLE) / (4::DOUBLE * n * 1048576::DOUBLE) + s.reg) + 0.5::DOUBLE)::BIGINT ELSE 0 END AS new
    FROM steps s CROSS JOIN many LEFT JOIN curves c ON c.j = s.j
    LEFT JOIN (
      SELECT m.reg, l.j, sum(floor(1048576::DOUBLE / (1::DOUBLE + exp(greatest(-700::DOUBLE, least(700::DOUBLE, m.t)))) + 0.5::DOUBLE)::BIGINT * l.v) AS g
      FROM (SELECT s.reg, l.pid, sum(s.y * l.v)::DOUBLE / 1073741824::DOUBLE AS t FROM steps s JOIN learn l ON l.j = s.j GROUP BY s.reg, l.pid) m
      JOIN learn l USING (pid) GROUP BY m.reg, l.j) g ON g.reg = s.reg AND g.j = s.j
    WHERE s.it < {STEPS}))
, fitted AS (SELECT reg, j, w FROM steps WHERE it = {STEPS})"""


def _pairs_of_features(spark, sf):
    return X.pair_differences(R.reward_samples(rated(spark, sf, dup=True)), seed=SEED)


def _model(spark, sf) -> X.ExactModel:
    return X.fit(_pairs_of_features(spark, sf).where("NOT held_out"), (0.01,), STEPS)[0]


@query("reward_model_fit", _fit_sql((0.01,)) + """
SELECT j::INTEGER AS feature_index, w::DOUBLE / 1048576::DOUBLE AS weight FROM fitted""")
def reward_model_fit(spark, sf):
    """The fitted weight per hashed feature, from the pairs of the train side."""
    w = _model(spark, sf).real_weights()
    return spark.createDataFrame(list(enumerate(w)), "feature_index int, weight double")


@query("score_batch", _fit_sql((0.01,)) + _features_sql("asked", "doc_id", "fx_rated") + """
SELECT doc_id, sum(w * x)::DOUBLE / 1073741824::DOUBLE AS score FROM asked JOIN fitted USING (j) GROUP BY doc_id""")
def score_batch(spark, sf):
    """Model score of every rated (question, answer)."""
    return X.score_batch(rated(spark, sf), _model(spark, sf), keep=("doc_id",))


@query("score_unrated", _fit_sql((0.01,)) + """
, unrated AS (SELECT chat_id, message_id, question, content AS answer FROM fx_unrated)""" + _features_sql("asked", "chat_id, message_id", "unrated") + """
SELECT chat_id, message_id, sum(w * x)::DOUBLE / 1073741824::DOUBLE AS score FROM asked JOIN fitted USING (j) GROUP BY chat_id, message_id""")
def score_unrated(spark, sf):
    """Every unrated assistant answer of the chats, scored."""
    chat, users = chat_and_users(spark, sf)
    return X.score_batch(E.unrated_rows(chat, users), _model(spark, sf), keep=("chat_id", "message_id"))


@query("pair_model_selection", _fit_sql(REGS) + f"""
, tested AS (
  SELECT reg, pid, greatest(-700::DOUBLE, least(700::DOUBLE, sum(w * v)::DOUBLE / 1073741824::DOUBLE)) AS t
  FROM (SELECT f.reg, p.pid, f.w, coalesce(x.v, 0) AS v
        FROM (SELECT pid FROM pair WHERE held_out) p CROSS JOIN fitted f LEFT JOIN diff x ON x.pid = p.pid AND x.j = f.j) GROUP BY reg, pid)
, rated_by AS (
  SELECT reg AS reg_param, sum((t > 0)::INTEGER)::DOUBLE / count(*) AS accuracy,
    sum(floor(1048576::DOUBLE * (greatest(-t, 0::DOUBLE) + ln(1::DOUBLE + exp(-abs(t)))) + 0.5::DOUBLE)::BIGINT)::DOUBLE / 1048576::DOUBLE / count(*) AS loss,
    count(*) AS n_pairs
  FROM tested GROUP BY reg)
SELECT c.reg AS reg_param, accuracy, loss, coalesce(n_pairs, 0) AS n_pairs, row_number() OVER (ORDER BY loss NULLS LAST, c.reg) = 1 AS selected
FROM (SELECT DISTINCT reg FROM fitted) c LEFT JOIN rated_by ON reg_param = c.reg""")
def pair_model_selection(spark, sf):
    """Held-out accuracy / pair loss per regularisation candidate (train side fitted, test side scored, all candidates in the
    same scans); the argmin is the kept model."""
    model, rows = X.select_reg_param(_pairs_of_features(spark, sf), REGS, STEPS)
    return spark.createDataFrame([(*r, r[0] == model.reg_param) for r in rows],
                                 "reg_param double, accuracy double, loss double, n_pairs bigint, selected boolean")
