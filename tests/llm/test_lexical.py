import math
import re
from collections import Counter

import pytest

from rewardloom.llm.lexical import TERM, Best, Terms, search


def terms(text):
    lower = (text or "").translate({c: c + 32 for c in range(65, 91)})
    return re.findall(TERM, lower)


def brute(docs, items, k=50):
    docs = [(i, Counter(terms(t))) for i, t in docs]
    docs = [(i, c) for i, c in docs if c]
    N, L = len(docs), sum(sum(c.values()) for _, c in docs)
    df = Counter(t for _, c in docs for t in c)
    out = []
    for item, text in items:
        found = []
        for i, c in docs:
            m = 50 + 50 * sum(c.values()) * N // L
            s = sum(math.floor(1000 * math.log((2 * N + 2) / (2 * df[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 20 * m))
                    for t in set(terms(text)) if t in c)
            if s > 0:
                found.append((-s, i is None, i))
        found.sort(key=lambda x: (x[0], x[1], x[2] or 0))
        out += [(item, r + 1, i, -s) for r, (s, _, i) in enumerate(found[:k])]
    return sorted(out, key=repr)


def run(docs, items, **kw):
    return sorted((tuple(r) for r in search(docs, items, **kw).collect()), key=repr)


@pytest.mark.parametrize("bounds", [{}, {"most_items": 7}, {"most_bytes": 300}, {"k": 3}])
def test_against_brute_force(spark, docs, bounds):
    items = spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet")
    want = brute([(r.doc_id, r.text) for r in docs.collect()], [(r.item_id, r.text) for r in items.collect()], bounds.get("k", 50))
    assert run(docs, items, **bounds) == want


def test_edges(spark, edge, empty):
    kind = "item_id long, text string, rank int, score int, item int"
    rows = [(1, "The cat, the door", 1, 1, 1), (1, "The cat, the door", 1, 1, 1), (2, None, 1, 1, 1), (3, " ,; ", 1, 1, 1), (None, "naïve TEXT word3", 1, 1, 1),
            (4, "word3 WORD30 word300 nothere é", 1, 1, 1), (5, "id", 1, 1, 1)]
    items = spark.createDataFrame(rows, kind)
    want = brute([(r.doc_id, r.text) for r in edge.collect()], [r[:2] for r in rows])
    assert want and run(edge, items) == want and run(edge.repartition(1), items, most_items=1) == want
    assert run(empty, items) == [] and run(edge, items.limit(0)) == []
    nothing = spark.createDataFrame([(1, " . "), (2, None)], "doc_id long, text string")
    assert run(nothing, items) == []
    assert search(empty, items).columns == ["item_id", "rank", "doc_id", "score"]


def test_ties_go_by_id(spark):
    docs = [(i % 90, f"alpha {'beta' * (i % 3)} {i}") for i in range(400, 0, -1)] + [(None, "alpha alpha"), (7, "gamma")] * 3
    items = [(1, "alpha"), (2, "beta 7 gamma")]
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(7)
    assert run(df, spark.createDataFrame(items, "item_id long, text string")) == brute(docs, items)


def test_guards(spark):
    """A term is found whole only, whatever letters and bytes stand around it."""
    t = Terms([["ab", "é", "b", "日本"], ["ab", "ébc"]])
    n, found, tf = t.found("Ab xab abx\tAB-é éb ébc,日本 日本語\x00ab")
    assert n == 10 and {t.names[i]: c for i, c in zip(found.tolist(), tf.tolist())} == {"ab": 3, "é": 1, "ébc": 1, "日本": 1}
    assert [t.items[t.begin[i]:t.begin[i + 1]].tolist() for i in range(len(t.names))] == [[0, 1] if x == "ab" else [1] if x == "ébc" else [0] for x in t.names]
    assert t.found(None)[0] == 0 and t.found("")[0] == 0


def test_best_of_many():
    import numpy as np
    rng = np.random.default_rng(1)
    best, rows = Best(3, 5), []
    for _ in range(200):
        part = rng.integers(0, [3, 40, 1000, 2], (1000, 4)).T
        part = part[:, part[1] >= best.least[part[0]]]
        rows += part.T.tolist()
        best.add(*part)
    got = sorted(zip(*(c.tolist() for c in best.kept())))
    want = [sorted((r for r in rows if r[0] == i), key=lambda r: (-r[1], r[3], r[2]))[:5] for i in range(3)]
    assert got == sorted(tuple(r) for w in want for r in w)


def test_matches_sql(spark):
    from rewardloom.llm.queries import op13_automaton_ranking, oracle_sql
    from tests.conftest import SF001
    from tools.oracle_check import connect
    want = connect(SF001).execute(oracle_sql()["op13_automaton_ranking"]).fetchall()
    got = op13_automaton_ranking(spark, SF001).select("item_id", "rank", "doc_id", "score").collect()
    assert sorted(tuple(r) for r in got) == sorted(want)
