from fractions import Fraction as Q
from math import floor

import numpy as np

from rewardloom.llm.whitening import deviations, squares, whiten


def brute(rows, k=8):
    """{row number: (vec_id, deviation, x - S/n)}, covariance, all in fractions."""
    good = [(i, v) for i, v in rows if v is not None and all(c is not None and np.isfinite(c) for c in v)]
    x = [[floor(1024 * Q(c)) + 100000 for c in v] for _, v in good]
    n, d = len(x), len(x[0])
    s = [sum(r[j] for r in x) for j in range(d)]
    dev = [sum((n * r[j] - s[j]) ** 2 for j in range(d)) for r in x]
    mid = [[Q(r[j]) - Q(s[j], n) for j in range(d)] for r in x]
    cov = np.array([[float(sum(m[a] * m[b] for m in mid) / n) for b in range(d)] for a in range(d)])
    return [i for i, _ in good], n, dev, np.array([[float(c) for c in m] for m in mid]), cov


def check(rows, got, k=8, bound=1e-9):
    ids, n, dev, mid, cov = brute(rows)
    e, v = np.linalg.eigh(cov)
    e, v = e[::-1][:k], v[:, ::-1][:, :k]
    assert {r.n for r in got} == {n} and len({r.identity_error for r in got}) == 1 and got[0].identity_error < 1e-9
    by = {}
    for r in got:
        by.setdefault(r.component, []).append(r)
    assert sorted(by) == list(range(1, len(e) + 1))
    for c, part in by.items():
        want = mid @ v[:, c - 1] / np.sqrt(e[c - 1])
        assert len({r.explained for r in part}) == 1 and abs(part[0].explained / (e[c - 1] / np.trace(cov)) - 1) < 1e-9
        key = lambda x: (str(x[0]), x[1], round(x[2], 6))
        mine = sorted(((r.vec_id, r.deviation, r.whitened) for r in part), key=key)
        fits = [max(abs(a[2] - b[2]) for a, b in zip(mine, sorted(zip(ids, dev, sign * want), key=key))) for sign in (1, -1)]
        assert min(fits) < bound
        assert [m[:2] for m in mine] == [m[:2] for m in sorted(zip(ids, dev, want * (1 if fits[0] < fits[1] else -1)), key=key)]


def test_against_fractions(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/embeddings.parquet")
    check([(r.vec_id, r.embedding) for r in df.collect()], whiten(df).collect())


def test_edges(spark):
    rng = np.random.default_rng(3)
    rows = [(i, (rng.normal(size=5) * [9, 5, 3, 2, 1] - 40).tolist()) for i in range(40)] + [(3, [1.0, 2.0, 3.0, 4.0, 5.0])] * 3
    rows += [(None, [0.0] * 5), (50, None), (51, [1.0, None, 2.0, 3.0, 4.0]), (52, [float("nan")] * 5), (53, [float("-inf"), 0.0, 0.0, 0.0, 0.0])]
    kind = "vec_id long, embedding array<double>"
    df = spark.createDataFrame(rows, kind).selectExpr("*", "1 AS v", "2 AS n", "3 AS white", "4 AS component")
    check(rows, whiten(df).collect())
    # another length than the most frequent one, and an entry whose x leaves a long no room
    more = spark.createDataFrame([(60, [1.0, 2.0]), (61, [1e300, 0.0, 0.0, 0.0, 0.0])], kind)
    check(rows, whiten(df.select("vec_id", "embedding").unionByName(more)).collect())


def test_no_spread(spark):
    kind = "vec_id long, embedding array<float>"
    shape = ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    for rows in ([], [(1, [1.0, 2.0])], [(1, [1.0, 2.0]), (2, [1.0, 2.0])], [(1, None)], [(1, []), (2, [])]):
        got = whiten(spark.createDataFrame(rows, kind))
        assert got.count() == 0 and got.columns == shape
    line = [(i, [float(i), 2.0 * i, 1.0]) for i in range(9)]                  # one component has spread
    got = whiten(spark.createDataFrame(line, kind)).collect()
    assert {r.component for r in got} == {1} and len(got) == 9 and got[0].explained == 1.0


def test_sums_are_exact_whatever_their_size(spark):
    rng = np.random.default_rng(5)
    for top in (3, 2**29, 2**31 + 7, 2**45):
        z = rng.integers(-top, top, (300, 4))
        want = [sum(int(r[a] + (r[b] if b > a else 0)) ** 2 for r in z.tolist()) for a in range(4) for b in range(a, 4)]
        got = squares(z)
        assert all(w == sum((r[a] if a == b else r[a] + r[b]) ** 2 for r in z.tolist()) for w, (a, b) in
                   zip(got, [(a, b) for a in range(4) for b in range(a, 4)])) and len(got) == len(want)
    z = rng.integers(-2000, 2000, (5, 4))
    for n in (10, 10**6, 10**9, 10**15):
        rest = [n // 3, -n // 4, 0, n // 2]
        want = [sum((n * a - b) ** 2 for a, b in zip(r, rest)) for r in z.tolist()]
        assert deviations(z, n, rest) == [x if x < 2**63 else None for x in want]
    wide = [(i, (rng.normal(size=3) * 1e12).tolist()) for i in range(12)]
    got = whiten(spark.createDataFrame(wide, "vec_id long, embedding array<double>")).collect()
    assert len(got) == 36 and got[0].identity_error < 1e-9 and all(r.deviation is None for r in got)
