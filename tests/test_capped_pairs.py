"""The widest pairs of each prompt against all pairs ranked in Python, with a prompt that holds a third of all rows."""

import random

import pytest
from pyspark.sql import functions as F

from rewardloom.operators import preference as P

KIND = "question string, answer string, rating double, seq struct<a:int>"


def brute(rows, most):
    out = []
    for q in {r[0] for r in rows if r[0] is not None}:
        mine = [r for r in rows if r[0] == q and r[2] is not None and r[2] == r[2]]
        pairs = [(a, b) for a in mine for b in mine if a[2] > b[2]]
        pairs.sort(key=lambda p: (-(p[0][2] - p[1][2]), -p[0][2], p[1][2], p[0][3], p[1][3]))
        out += [(q, a[1], b[1], a[2], b[2], a[2] - b[2]) for a, b in pairs[:most]]
    return sorted(out)


def made(ratings, seed, n=300):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        q = "hot" if i % 3 == 0 else f"q{rng.randrange(40)}"
        rows.append((q, f"a{i}", ratings(rng), (rng.randrange(10**6) * 1000 + i,)))
    rng.shuffle(rows)
    return rows + [(None, "x", 1.0, (1,)), ("hot", "nan", float("nan"), (2,)), ("hot", "null", None, (3,))]


RATINGS = {"stars": lambda r: float(r.randrange(1, 6)), "odd": lambda r: r.choice([-1.0, 10.0, 0.1, 0.2, 0.3, 1e308, -1e308, float("inf"), float("-inf")]),
           "all different": lambda r: r.random(), "one": lambda r: 3.0}


@pytest.mark.parametrize("most", [1, 7, 400])
@pytest.mark.parametrize("kind", list(RATINGS))
def test_against_all_pairs(spark, kind, most):
    rows = made(RATINGS[kind], 5)
    df = spark.createDataFrame(rows, KIND).repartition(4)
    got = sorted(tuple(r) for r in P.preference_pairs_capped(df, most, dedup=False).collect())
    assert got == brute([(q, a, r, s[0]) for q, a, r, s in rows], most)


def test_a_prompt_with_a_third_of_all_rows(spark):
    """30,000 answers to one prompt have 180 million pairs; no step of the plan makes more than a few rows an answer."""
    df = spark.range(90_000).select(
        F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.concat(F.lit("q"), F.col("id") % 20_000)).alias("question"),
        F.concat(F.lit("a"), "id").alias("answer"), (F.pmod(F.xxhash64("id"), F.lit(5)) + 1).cast("double").alias("rating"),
        F.struct(F.col("id").cast("int").alias("a")).alias("seq"))
    out = P.preference_pairs_capped(df, 20, dedup=False)
    got = out.where("prompt = 'hot'").collect()
    first = {k: [r.answer for r in df.where(f"question = 'hot' AND rating = {k}").orderBy("seq").limit(20).collect()] for k in (1, 5)}
    assert sorted((r.chosen, r.rejected) for r in got) == sorted((first[5][0], b) for b in first[1])
    assert out.groupBy("prompt").count().agg(F.max("count")).first()[0] == 20
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Cartesian" not in plan and "NestedLoop" not in plan and "WindowGroupLimit" in plan


def test_no_rows(spark):
    assert P.preference_pairs_capped(spark.createDataFrame([], KIND), 5, dedup=False).count() == 0
