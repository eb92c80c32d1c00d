"""A pairwise (Bradley–Terry) reward scorer in Spark ML.

Features: hashed term counts of the scorer input text ("question" template +
answer, truncated to ``scorer_max_tokens`` tokens).  A training row is a
pair's feature difference, chosen - rejected (label 1) or rejected - chosen
(label 0) by a hash of the pair; a logistic regression without intercept (for
which both orientations have the same loss) then gives a score ``w · x``
whose differences are pair log-odds.  Fitting is Spark ML's
distributed L-BFGS; scoring is a plain ``transform``.
"""

from __future__ import annotations

import warnings

from pyspark.ml import PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import HashingTF
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame, functions as F

from rewardloom.config import DEFAULT_SETTINGS
from rewardloom.functions.text import corpus_tokens, qa_text
from rewardloom.operators.preference import pair_metrics

TOKENS = "_scorer_tokens"


def scorer_tokens(q, a, max_tokens: int = DEFAULT_SETTINGS.scorer_max_tokens):
    return F.slice(corpus_tokens(qa_text(q, a)), 1, max_tokens)


def _htf(n_features: int, out: str = "features") -> HashingTF:
    return HashingTF(inputCol=TOKENS, outputCol=out, numFeatures=n_features)


def pair_training_rows(pairs: DataFrame, n_features: int = DEFAULT_SETTINGS.hashing_features,
                       max_tokens: int = DEFAULT_SETTINGS.scorer_max_tokens) -> DataFrame:
    """(features, label): x_chosen - x_rejected and 1, or x_rejected - x_chosen and 0, by a hash of the pair."""
    way = F.when(F.pmod(F.xxhash64("prompt", "chosen", "rejected"), F.lit(2)) == 0, 1.0).otherwise(-1.0)
    c = _htf(n_features, "fc").transform(
        pairs.withColumn(TOKENS, scorer_tokens("prompt", "chosen", max_tokens))).drop(TOKENS)
    r = _htf(n_features, "fr").transform(
        c.withColumn(TOKENS, scorer_tokens("prompt", "rejected", max_tokens)).withColumn("_way", way)).drop(TOKENS)
    diff = F.zip_with(vector_to_array("fc"), vector_to_array("fr"), lambda x, y: (x - y) * F.col("_way"))
    keep = [x for x in r.columns if x not in ("fc", "fr", "_way")]
    return r.select(*keep, array_to_vector(diff).alias("features"), ((F.col("_way") + 1) / 2).alias("label"))


def fit_reward_model(pairs: DataFrame, reg_param: float = 0.01, max_iter: int = 100,
                     n_features: int = DEFAULT_SETTINGS.hashing_features,
                     max_tokens: int = DEFAULT_SETTINGS.scorer_max_tokens) -> PipelineModel:
    """Fit on pairs; returns a PipelineModel (hashing + logistic).  Warns
    when ``max_iter`` ends the fit before it converged.

    Raw term counts are badly conditioned; with per-feature standardization
    L-BFGS converges (≈45 iterations at sf0.1) instead of running out of
    iterations, and every iteration is one distributed aggregation."""
    from pyspark import StorageLevel
    rows = pair_training_rows(pairs, n_features, max_tokens).select("features", "label")
    rows = rows.persist(StorageLevel.MEMORY_AND_DISK)   # iterative: scan the lineage once
    try:
        lr = LogisticRegression(featuresCol="features", labelCol="label", fitIntercept=False,
                                regParam=reg_param, maxIter=max_iter, standardization=True)
        fitted = lr.fit(rows)
        if fitted.hasSummary and fitted.summary.totalIterations >= max_iter:
            warnings.warn(f"the reward model did not converge in {max_iter} iterations", RuntimeWarning, stacklevel=2)
        return PipelineModel(stages=[_htf(n_features), fitted])
    finally:
        rows.unpersist()


def score_batch(df: DataFrame, model: PipelineModel, q: str = "question", a: str = "answer",
                out: str = "score", max_tokens: int = DEFAULT_SETTINGS.scorer_max_tokens) -> DataFrame:
    """P5: one score per (question, answer) row = the model's margin w · x."""
    staged = df.withColumn(TOKENS, scorer_tokens(q, a, max_tokens))
    scored = model.transform(staged)
    margin = vector_to_array("rawPrediction")[1]
    return scored.withColumn(out, margin).drop(TOKENS, "features", "rawPrediction",
                                               "probability", "prediction")


def score_pairs(pairs: DataFrame, model: PipelineModel) -> DataFrame:
    s = score_batch(pairs, model, "prompt", "chosen", out="score_chosen")
    return score_batch(s, model, "prompt", "rejected", out="score_rejected")


def weights(model: PipelineModel) -> list[float]:
    return list(model.stages[-1].coefficients.toArray())


def select_reg_param(pairs_with_split: DataFrame, candidates=(0.0, 0.01, 0.1), **kw):
    """Fit one model per candidate on the train side, keep the lowest
    held-out pair loss.  Returns (best model, metrics DataFrame)."""
    from pyspark import StorageLevel
    pairs_with_split = pairs_with_split.persist(StorageLevel.MEMORY_AND_DISK)  # one lineage for all fits
    train = pairs_with_split.where(F.col("split") == "train")
    test = pairs_with_split.where(F.col("split") == "test")
    results, best = [], None
    try:
        for reg in candidates:
            m = fit_reward_model(train, reg_param=reg, **kw)
            met = pair_metrics(score_pairs(test, m), by=()).first()
            row = (float(reg), met["accuracy"], met["loss"], int(met["n_pairs"]))
            results.append(row)
            if best is None or (row[2] is not None and (best[1][2] is None or row[2] < best[1][2])):
                best = (m, row)
    finally:
        pairs_with_split.unpersist()
    spark = pairs_with_split.sparkSession
    table = spark.createDataFrame(results, "reg_param double, accuracy double, loss double, n_pairs bigint")
    return best[0], table


def save_model(model: PipelineModel, path: str) -> None:
    """Persist (hashing params + coefficients) with Spark ML's writer."""
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)


def score_with(df: DataFrame, scorer_factory, q: str = "question", a: str = "answer",
               out: str = "score") -> DataFrame:
    """P5 with an external scorer (e.g. a neural reward model exported to a
    shared path).  ``scorer_factory()`` runs once per task and returns
    ``fn(list[str]) -> list[float]`` over the formatted scorer inputs; Spark
    partitions the rows and streams them as Arrow batches."""
    from rewardloom.operators._hooks import batch_score_udf
    return df.withColumn(out, batch_score_udf(scorer_factory)(qa_text(q, a)))
