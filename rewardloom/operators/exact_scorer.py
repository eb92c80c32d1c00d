"""P4–P8 in whole numbers: a pairwise (Bradley–Terry) scorer whose fit is the same to the last bit on any cluster.

A floating sum depends on the order of its terms, so a fit that adds up gradients in doubles gives other weights with
another number of partitions or after a retry.  Here everything that is added over rows is a whole number:

* a feature is a token's md5 bucket; its value is floor(1024 count / tokens) of the scorer input, 0 to 1024;
* weights are whole multiples of 2^-20, a margin is the whole number w · (x_chosen - x_rejected) (over 2^30);
* a pair's residual sigmoid(-margin) is rounded to a whole multiple of 2^-20.

The solver is accelerated gradient descent on the mean logistic loss plus lambda / 2 |w|^2 for a fixed number of steps.  Its
step is diagonal: feature j moves by its gradient over mean(|d_j| |d|_1) / 4 + lambda, a bound of the loss's curvature, so no
step size is searched for.  Each step is one scan that adds up a (features x lambdas) matrix: all candidate lambdas are
fitted and evaluated together, in as many scans as one of them would take.  Tasks hand on one row a feature and lambda.

Answers are hashed once each; a pair row is the difference of two answers' features.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from rewardloom.config import DEFAULT_SETTINGS
from rewardloom.operators.preference import against_best, dedup_by_key, split_bucket
from rewardloom.operators.scorer import scorer_tokens
from rewardloom.session import materialize, ship

SHARE, UNIT = 1024, 1 << 20          # fixed point of features and of weights
FAR = 700.0                          # margins beyond it count as it; exp stays finite


@dataclass(frozen=True)
class ExactModel:
    reg_param: float
    weights: tuple            # whole multiples of 2^-20

    def real_weights(self) -> list[float]:
        return [w / UNIT for w in self.weights]


def token_buckets(q, a, n_features: int = DEFAULT_SETTINGS.hashing_features,
                  max_tokens: int = DEFAULT_SETTINGS.scorer_max_tokens) -> Column:
    """Bucket of each token of the scorer input: the first 32 bits of its md5, modulo ``n_features``."""
    return F.transform(scorer_tokens(q, a, max_tokens),
                       lambda t: F.pmod(F.conv(F.substring(F.md5(t), 1, 8), 16, 10).cast("bigint"), F.lit(n_features)).cast("int"))


def _lists(column) -> tuple[np.ndarray, np.ndarray]:
    """(values, lengths) of an Arrow list column."""
    return (column.flatten().to_numpy(zero_copy_only=False).astype(np.int64),
            np.diff(column.offsets.to_numpy()).astype(np.int64))


def shares(column, n_features: int) -> np.ndarray:
    """(rows, features) of a list column of buckets: floor(1024 count / tokens)."""
    bucket, size = _lists(column)
    at = np.repeat(np.arange(len(size)), size) * n_features + bucket
    count = np.bincount(at, minlength=len(size) * n_features).reshape(len(size), n_features)
    return SHARE * count // np.maximum(size, 1)[:, None]


def _as_lists(x: np.ndarray):
    return pa.ListArray.from_arrays(pa.array(np.arange(len(x) + 1) * x.shape[1], pa.int32()), pa.array(x.ravel(), pa.int16()))


def with_features(df: DataFrame, q: str = "question", a: str = "answer", out: str = "x",
                  n_features: int = DEFAULT_SETTINGS.hashing_features,
                  max_tokens: int = DEFAULT_SETTINGS.scorer_max_tokens, keep: tuple | None = None) -> DataFrame:
    """``keep`` (all columns, if None) and the features as ``out``, an array of shorts."""
    ship(df.sparkSession)
    keep = list(df.columns if keep is None else keep)
    rows = df.select(*[F.col(f"`{c}`") for c in keep], token_buckets(q, a, n_features, max_tokens).alias("_buckets"))
    shape = T.StructType([*[df.schema[c] for c in keep], T.StructField(out, T.ArrayType(T.ShortType(), False))])

    def run(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays([*b.columns[:-1], _as_lists(shares(b.columns[-1], n_features))], names=[*keep, out])

    return rows.mapInArrow(run, shape)


def pair_differences(samples: DataFrame, seed: int = 42, buckets: int = DEFAULT_SETTINGS.test_share_buckets,
                     **features) -> DataFrame:
    """(held_out, d): each preference pair's x_chosen - x_rejected, written once; held_out by prompt, as P3 splits."""
    answers = with_features(dedup_by_key(samples), keep=("question", "rating", "seq"), **features)
    pairs = against_best(materialize(answers, "scorer-answers"), ("x",))
    d = F.zip_with("chosen_x", "rejected_x", lambda c, r: (c - r).cast("short"))
    return materialize(pairs.select((split_bucket("question", seed, buckets) == 0).alias("held_out"), d.alias("d")), "scorer-pairs")


def _matrix(column, n_features: int) -> np.ndarray:
    return _lists(column)[0].reshape(-1, n_features)


def _summed(rows: DataFrame, width: int, each) -> np.ndarray:
    """Sums of the whole-number vectors that ``each(matrix)`` gives for the batches of ``rows``: one row a task and place."""
    ship(rows.sparkSession)

    def run(batches):
        total = np.zeros(width, np.int64)
        for b in batches:
            if b.num_rows:
                total = total + each(b.column("d"))
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(width), pa.int32()), pa.array(total, pa.int64())], names=["at", "v"])

    got = rows.select("d").mapInArrow(run, "at int, v long").groupBy("at").agg(F.sum(F.col("v").cast("decimal(38,0)")).alias("v")).collect()
    out = [0] * width
    for r in got:
        out[r["at"]] = int(r["v"])
    return np.array(out, dtype=object)


def _margins(d: np.ndarray, weights: np.ndarray) -> np.ndarray:
    return np.clip((d @ weights) / (UNIT * SHARE), -FAR, FAR)


def fit(pairs: DataFrame, reg_params=(0.01,), steps: int = 30, n_features: int = DEFAULT_SETTINGS.hashing_features) -> list[ExactModel]:
    """A model for each of ``reg_params``, from ``steps`` scans of the (…, d) rows and one before."""
    f, lam = n_features, np.array(reg_params, float)

    def spread(column):
        d = np.abs(_matrix(column, f))
        return np.concatenate([[len(d)], (d * d.sum(axis=1, keepdims=True)).sum(axis=0)])

    first = _summed(pairs, f + 1, spread)
    n = int(first[0])
    w = y = np.zeros((f, len(lam)), np.int64)
    if n:
        curve = first[1:].astype(float)[:, None] / (4.0 * n * UNIT) + lam
        for step in range(steps):
            def gradient(column, y=y):
                d = _matrix(column, f)
                rest = np.floor(UNIT / (1.0 + np.exp(_margins(d, y))) + 0.5).astype(np.int64)
                return (d.T @ rest).ravel()

            g = _summed(pairs, f * len(lam), gradient).reshape(f, len(lam)).astype(float)
            moved = np.where(curve > 0, (g / (1024.0 * n) - lam * y) / np.where(curve > 0, curve, 1.0), 0.0)
            new = y + np.floor(moved + 0.5).astype(np.int64)
            y, w = new + np.floor((new - w) * ((step + 1) / (step + 4.0)) + 0.5).astype(np.int64), new
    return [ExactModel(float(reg), tuple(int(x) for x in w[:, i])) for i, reg in enumerate(lam)]


def evaluate(pairs: DataFrame, models: list[ExactModel]) -> list[tuple]:
    """(reg_param, accuracy, loss, pairs) of each model in one scan; None where there are no pairs."""
    f, k = len(models[0].weights), len(models)
    w = np.array([m.weights for m in models], np.int64).T

    def counts(column):
        t = _margins(_matrix(column, f), w)
        loss = np.floor(UNIT * (np.maximum(-t, 0.0) + np.log(1.0 + np.exp(-np.abs(t)))) + 0.5).astype(np.int64)
        return np.concatenate([[len(t)], (t > 0).sum(axis=0), loss.sum(axis=0)])

    sums = _summed(pairs, 1 + 2 * k, counts)
    n = int(sums[0])
    return [(m.reg_param, int(sums[1 + i]) / n if n else None, int(sums[1 + k + i]) / UNIT / n if n else None, n) for i, m in enumerate(models)]


def select_reg_param(pairs: DataFrame, candidates=(0.0, 0.01, 0.1), steps: int = 30,
                     n_features: int = DEFAULT_SETTINGS.hashing_features) -> tuple[ExactModel, list[tuple]]:
    """Every candidate fitted on the pairs that aren't held out, in the same scans, and the one of the lowest
    held-out loss (the first, if equal or without held-out pairs); (model, rows of ``evaluate``)."""
    models = fit(pairs.where(~F.col("held_out")), candidates, steps, n_features)
    rows = evaluate(pairs.where("held_out"), models)
    best = min(range(len(rows)), key=lambda i: (rows[i][2] is None, rows[i][2] or 0.0, i))
    return models[best], rows


def score_batch(df: DataFrame, model: ExactModel, q: str = "question", a: str = "answer", out: str = "score",
                max_tokens: int = DEFAULT_SETTINGS.scorer_max_tokens, keep: tuple | None = None) -> DataFrame:
    """P5: w · x of each row's scorer input, exact; ``keep`` (all columns, if None) and ``out``."""
    ship(df.sparkSession)
    keep = list(df.columns if keep is None else keep)
    f, w = len(model.weights), np.array(model.weights, np.int64)
    rows = df.select(*[F.col(f"`{c}`") for c in keep], token_buckets(q, a, f, max_tokens).alias("_buckets"))
    shape = T.StructType([*[df.schema[c] for c in keep], T.StructField(out, T.DoubleType())])

    def run(batches):
        for b in batches:
            score = (shares(b.columns[-1], f) @ w) / (UNIT * SHARE)
            yield pa.RecordBatch.from_arrays([*b.columns[:-1], pa.array(score, pa.float64())], names=[*keep, out])

    return rows.mapInArrow(run, shape)


def save_model(spark, model: ExactModel, path: str) -> None:
    """The weights as a table."""
    (spark.createDataFrame([(i, w, model.reg_param) for i, w in enumerate(model.weights)], "feature_index int, weight long, reg_param double")
     .coalesce(1).write.mode("overwrite").parquet(path))


def load_model(spark, path: str) -> ExactModel:
    rows = sorted(spark.read.parquet(path).collect())        # one row a feature
    return ExactModel(rows[0]["reg_param"], tuple(r["weight"] for r in rows))
