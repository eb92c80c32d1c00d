"""The whole-number scorer against a plain Python replay; its weights don't depend on how rows are dealt."""

import hashlib
import math
from collections import Counter

import pytest
from pyspark.sql import functions as F

from rewardloom.operators import exact_scorer as X, preference as P, rewards as R
from rewardloom.plans.inputs import rated
from rewardloom.session import scratch_path
from tests.conftest import SF001


@pytest.fixture(scope="module")
def samples(spark):
    return R.reward_samples(rated(spark, SF001, dup=True))


@pytest.fixture(scope="module")
def pairs(samples):
    return X.pair_differences(samples)


def features(q, a, n=256, most=512):
    tokens = f"Câu hỏi: {'None' if q is None else q}\n\nTrả lời: {'None' if a is None else a}".split()[:most]
    count = Counter(int(hashlib.md5(t.encode()).hexdigest()[:8], 16) % n for t in tokens)
    return [1024 * count[j] // len(tokens) for j in range(n)]


def replay(rows, lam, steps):
    n, f = len(rows), 256
    curve = [sum(abs(d[j]) * sum(map(abs, d)) for d in rows) / (4.0 * n * 2**20) + lam for j in range(f)]
    w, y = [0] * f, [0] * f
    for step in range(steps):
        g = [0] * f
        for d in rows:
            t = sum(a * b for a, b in zip(d, y)) / 2**30
            r = math.floor(2**20 / (1 + math.exp(max(-700.0, min(700.0, t)))) + 0.5)
            g = [x + r * v for x, v in zip(g, d)]
        new = [y[j] + (math.floor((g[j] / (1024.0 * n) - lam * y[j]) / curve[j] + 0.5) if curve[j] > 0 else 0) for j in range(f)]
        y = [b + math.floor((b - a) * ((step + 1) / (step + 4.0)) + 0.5) for a, b in zip(w, new)]
        w = new
    return tuple(w)


def test_differences(samples, pairs):
    want = Counter()
    for r in P.preference_pairs(samples).collect():
        held = int(hashlib.md5(f"42:{r.prompt}".encode()).hexdigest()[:8], 16) % 10 == 0
        want[held, tuple(a - b for a, b in zip(features(r.prompt, r.chosen), features(r.prompt, r.rejected)))] += 1
    assert Counter((r.held_out, tuple(r.d)) for r in pairs.collect()) == want


def test_fit_is_the_replay(pairs):
    rows = [r.d for r in pairs.collect()]
    models = X.fit(pairs, (0.0, 0.05), steps=6)
    assert [m.weights for m in models] == [replay(rows, 0.0, 6), replay(rows, 0.05, 6)]


def test_same_weights_however_rows_are_dealt(spark, pairs):
    want = X.fit(pairs, (0.01,), steps=8)
    assert X.fit(pairs.repartition(1), (0.01,), steps=8) == want == X.fit(pairs.repartition(13).union(pairs.limit(0)), (0.01,), steps=8)


def test_candidates_share_their_scans(spark, pairs):
    """Three candidates give what each gives alone, in the same number of jobs."""
    def jobs(group, regs):
        spark.sparkContext.setJobGroup(group, group)
        models = X.fit(pairs, regs, steps=5)
        spark.sparkContext.setJobGroup("", "")
        return models, len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))

    one, n_one = jobs("fit-one", (0.01,))
    three, n_three = jobs("fit-three", (0.0, 0.01, 0.1))
    assert three[1] == one[0] and n_one == n_three > 5
    assert [m.reg_param for m in three] == [0.0, 0.01, 0.1]


def test_loss_falls_and_selection_is_its_least(spark, pairs):
    short, long = X.fit(pairs, (0.0,), steps=2)[0], X.fit(pairs, (0.0,), steps=30)[0]
    zero = X.ExactModel(0.0, (0,) * 256)
    losses = [r[2] for r in X.evaluate(pairs, [zero, short, long])]
    assert abs(losses[0] - math.log(2)) < 1e-6 and losses[0] > losses[1] > losses[2]
    half = pairs.withColumn("held_out", F.abs(F.hash("d")) % 3 == 0)
    model, rows = X.select_reg_param(half, (0.0, 0.01, 0.1, 10.0), steps=10)
    assert model.reg_param == min(rows, key=lambda r: r[2])[0] and len({r[3] for r in rows}) == 1
    w = [m.weights for m in X.fit(half.where("NOT held_out"), (model.reg_param,), steps=10)]
    assert [model.weights] == w
    t = [sum(a * b for a, b in zip(r.d, model.weights)) / 2**30 for r in half.where("held_out").collect()]
    mine = next(r for r in rows if r[0] == model.reg_param)
    assert mine[1] == sum(x > 0 for x in t) / len(t) and abs(mine[2] - sum(math.log1p(math.exp(-x)) for x in t) / len(t)) < 1e-5


def test_scores_and_saved_models(spark, pairs):
    model = X.fit(pairs, (0.01,), steps=5)[0]
    rows = [(1, "What?", "some words of an answer, some more"), (2, None, None), (3, "", ""), (4, "q", "w " * 2000)]
    df = spark.createDataFrame(rows, "id long, question string, answer string")
    got = {r.id: r.score for r in X.score_batch(df, model).collect()}
    assert got == {i: sum(x * w for x, w in zip(features(q, a), model.weights)) / 2**30 for i, q, a in rows}
    assert X.score_batch(df.limit(0), model).count() == 0 and X.score_batch(df, model).columns == [*df.columns, "score"]
    path = scratch_path(spark, "t-exact")
    X.save_model(spark, model, path)
    assert X.load_model(spark, path) == model


def test_nothing_to_learn(spark, pairs):
    none = pairs.limit(0)
    model, rows = X.select_reg_param(none, (0.0, 0.1), steps=3)
    assert model == X.ExactModel(0.0, (0,) * 256) and [r[1:] for r in rows] == [(None, None, 0)] * 2
    # a feature that no pair has keeps weight 0, also without regularisation
    same = spark.createDataFrame([(False, [0] * 256)], "held_out boolean, d array<short>")
    assert X.fit(same, (0.0, 0.1), steps=3) == [X.ExactModel(0.0, (0,) * 256), X.ExactModel(0.1, (0,) * 256)]
