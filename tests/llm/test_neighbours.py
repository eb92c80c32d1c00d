import random
from collections import Counter

import numpy as np
import pytest

from rewardloom.llm.curves import hilbert_keys, nearest
from rewardloom.llm.ngram_join import bands_for, linked, one_of_each


def grams(x):
    w = (x or "").encode().lower().split()
    return frozenset(tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))) if w else frozenset()


def brute_links(rows):
    sets = [(i, grams(t)) for i, t in rows]
    n, root = [0] * len(sets), list(range(len(sets)))
    for a in range(len(sets)):
        for b in range(a):
            x, y = sets[a][1], sets[b][1]
            if x == y or len(x & y) >= 0.8 * len(x | y) - 1e-12:
                n[a] += 1
                n[b] += 1
                old, new = sorted((root[a], root[b]), reverse=True)
                root = [new if r == old else r for r in root]
    least = {}
    for k, (i, _) in enumerate(sets):
        if i is not None:
            least[root[k]] = min(least.get(root[k], i), i)
    return sorted([(i, least.get(root[k]), n[k]) for k, (i, _) in enumerate(sets)], key=repr)


def near_copies(count, words, seed, first):
    rng = random.Random(seed)
    base = [f"w{rng.randrange(500)}" for _ in range(words)]
    out = []
    for i in range(count):
        w = list(base)
        for _ in range(rng.randrange(0, 7)):
            del w[rng.randrange(len(w))]
        out.append((first + i, " ".join(w)))
    return out


@pytest.mark.parametrize("block", [256, 8])
def test_links_against_all_pairs(spark, block):
    rows = near_copies(60, 150, 1, 0) + near_copies(25, 60, 2, 100) + [(200, "short one"), (201, "Short  ONE"), (202, "another short one")]
    rows += [(300 + i, " ".join(f"u{i}_{k}" for k in range(50))) for i in range(20)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted([(r.doc_id, r.class_id, r.n_links) for r in linked(df, recall=0.99999, most_hashes=200, block=block).collect()], key=repr)
    assert got == brute_links(rows)


def test_links_of_documents(docs):
    rows = [tuple(r) for r in docs.select("doc_id", "text").collect()]
    got = sorted([(r.doc_id, r.class_id, r.n_links) for r in linked(docs).collect()], key=repr)
    assert got == brute_links(rows)


def test_bands_reach_recall():
    bands, rows = bands_for(0.8, 0.998, 128)
    assert bands * rows <= 128 and 1 - (1 - 0.8**rows) ** bands >= 0.998


def test_pairs_at_the_threshold_meet(spark):
    """4,000 pairs of exactly 0.8: the last 2 of 22 words differ, so 16 of 20 5-grams are in both."""
    rows = [(2 * i + j, " ".join([f"p{i}_{k}" for k in range(20)] + [f"e{i}_{j}_{k}" for k in range(2)])) for i in range(4000) for j in (0, 1)]
    got = linked(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert len(got) == 8000 and all(r.n_links == 1 and r.class_id == r.doc_id // 2 * 2 for r in got)


def test_join_edges(edge, empty):
    rows = [tuple(r) for r in edge.select("doc_id", "text").collect()]
    got = sorted([(r.doc_id, r.class_id, r.n_links) for r in linked(edge).collect()], key=repr)
    assert got == brute_links(rows)
    assert linked(empty).count() == 0
    kept = one_of_each(edge)
    assert kept.columns == edge.columns
    assert Counter(r.doc_id for r in kept.collect()) == Counter({1: 1, 3: 1, 6: 1, None: 1, 7: 1, 8: 1, 9: 1, 10: 1, 11: 1})


def test_hilbert_curve_visits_neighbours():
    side = np.array([(x, y, z) for x in range(8) for y in range(8) for z in range(8)])
    key = hilbert_keys(side, 3)
    assert sorted(key) == list(range(512))
    path = side[np.argsort(key)]
    assert (np.abs(np.diff(path, axis=0)).sum(axis=1) == 1).all()


def brute_nearest(rows, k=20):
    good = [(i, np.array(v, float)) for i, v in rows if i is not None and v is not None and None not in v and np.isfinite(v).all() and any(v)]
    for i, v in good:
        if i % 20 == 0:
            yield i, sorted(((-float(v @ w), j) for j, w in good if j != i))[:k]


def test_recall(spark):
    df = spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet")
    got = {}
    for r in nearest(df).collect():
        got.setdefault(r.query_id, {})[r["rank"]] = (r.vec_id, r.score)
    want = dict(brute_nearest([(r.vec_id, r.embedding) for r in df.collect()]))
    assert set(got) == set(want) and all(sorted(x) == list(range(1, 21)) for x in got.values())
    found = sum(len({v for v, _ in got[q].values()} & {j for _, j in want[q]}) for q in want)
    assert found >= 0.9 * 20 * len(want)


def test_vectors_edges(spark):
    rng = np.random.default_rng(0)
    rows = [(i, rng.normal(size=4).tolist()) for i in range(60)] + [(100 + i, [1.0, 2.0, 3.0, 4.0]) for i in range(61)]
    rows += [(200, None), (220, [0.0] * 4), (240, [1.0, None, 2.0, 3.0]), (260, [1.0, float("nan"), 0.0, 0.0]), (280, [float("inf"), 0.0, 0.0, 0.0]), (None, [1.0] * 4)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").selectExpr("*", "1 AS v", "2 AS cls", "3 AS rank")
    got = {}
    for r in sorted(nearest(df, recall=1.0).collect(), key=lambda r: (r.query_id, r["rank"])):
        got.setdefault(r.query_id, []).append(r.vec_id)
    assert got == {q: [j for _, j in best] for q, best in brute_nearest(rows)}
    assert nearest(df.limit(0)).count() == 0
    assert nearest(df.where("vec_id = 0")).count() == 0


def test_one_id_on_several_vectors(spark):
    """Each row is a neighbour of its own, with its own score, and a query of its own; ties between classes go by id."""
    rng = np.random.default_rng(2)
    rows = [(i, rng.normal(size=4).tolist()) for i in range(60)] + [(5, rng.normal(size=4).tolist()), (5, (9 * rng.normal(size=4)).tolist())]
    rows += [(i, [0.5, 0.5, 0.5, x]) for i, x in ((300, 0.0), (7, 0.0), (7, -0.0), (301, 2.0), (302, 2.0))]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = {}
    for r in sorted(nearest(df, recall=1.0).collect(), key=lambda r: (r.query_id, r["rank"])):
        got.setdefault(r.query_id, []).append((r.vec_id, r.score))
    for q, best in brute_nearest(rows):
        assert [i for i, _ in got[q]] == [i for _, i in best]
        assert all(abs(s + w) < 1e-12 for (_, s), (w, _) in zip(got[q], best))


def test_no_id_asks(spark):
    """Usable vectors, but no id divisible by 20."""
    df = spark.createDataFrame([(i, [1.0, float(i)]) for i in range(1, 20)], "vec_id long, embedding array<double>")
    got = nearest(df)
    assert got.count() == 0 and got.columns == ["query_id", "rank", "vec_id", "score"]


def test_join_matches_sql(spark):
    from rewardloom.llm.queries import op8_ngram_bands, oracle_sql
    from tests.conftest import SF001
    from tools.oracle_check import connect
    want = connect(SF001).execute(oracle_sql()["op8_ngram_bands"]).fetchall()
    got = op8_ngram_bands(spark, SF001).select("doc_id", "class_id", "text_class", "n_links").collect()
    assert sorted(tuple(r) for r in got) == sorted(want)


def test_salted_join_of_hot_keys(spark):
    """A third of the rows on one key, and equal rows: the same rows as the plain join, the hot key alone is repeated."""
    from pyspark.sql import functions as F
    from rewardloom.llm.common import salted_join
    big = spark.range(6000).select(F.when(F.col("id") % 3 == 0, 1).otherwise(F.col("id")).alias("k"), (F.col("id") % 2).alias("x"))
    small = spark.range(5000).select(F.col("id").alias("k"), (F.col("id") * 2).alias("y"))
    for how in ("inner", "left"):
        want = Counter(map(tuple, big.join(small, "k", how).collect()))
        for spread in (None, F.monotonically_increasing_id()):
            assert Counter(map(tuple, salted_join(big, small, "k", how, spread=spread, most=100).collect())) == want
    assert Counter(map(tuple, salted_join(big, small, ["k"], most=100).collect())) == Counter(map(tuple, big.join(small, "k").collect()))


def test_one_of_many_equal_rows(spark):
    rows = [(5, "the very same row of seven words", "a")] * 3000 + [(None, "another row without any id here", "b")] * 50 + [(9, "quite another text, of its own", None)]
    kept = one_of_each(spark.createDataFrame(rows, "doc_id long, text string, __row_hash string"))
    assert sorted(map(tuple, kept.collect()), key=repr) == sorted({*rows}, key=repr)
