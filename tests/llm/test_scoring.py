"""Prediction by partial matching against a direct trie, and the unigram base."""

import math
import zlib
from collections import Counter, defaultdict

from rewardloom.llm.ppm import score


def brute(docs, order):
    words = [(i, (t or "").encode().lower().split()) for i, t in docs]
    held = [zlib.crc32(b"" if i is None else str(i).encode()) % 10 == 0 for i, _ in words]
    count = Counter()
    for (_, w), h in zip(words, held):
        if not h:
            count.update(w + ["<end>"])
    total, different = sum(count.values()), len(count)
    seen = [defaultdict(Counter) for _ in range(order + 1)]
    text = [b" " * order + b" ".join(w) + b"\n" for _, w in words]
    for s, h in zip(text, held):
        if not h:
            for p in range(order, len(s)):
                for j in range(order + 1):
                    seen[j][s[p - j:p]][s[p]] += 1

    def log(context, symbol):
        out, gone = 0.0, set()
        for j in range(order, -1, -1):
            c = seen[j].get(context[order - j:])
            if not c:
                continue
            rest = {k: n for k, n in c.items() if k not in gone}
            t = sum(rest.values())
            if symbol in rest:
                return out + math.log10((2 * rest[symbol] - 1) / (2 * t))
            if t:
                out += math.log10(len(rest) / (2 * t))
            gone = set(c)
        return out - math.log10(256 - len(gone))

    for (i, w), s, h in zip(words, text, held):
        w = w + ["<end>"]
        base = sum(math.log10((count[x] + 0.1) / (total + 0.1 * (different + 1))) for x in w)
        yield i, h, len(w), sum(count[x] > 0 for x in w), total, base, sum(log(s[p - order:p], s[p]) for p in range(order, len(s)))


def compare(df, rows, order=3):
    want = sorted(brute(rows, order), key=repr)
    got = sorted([tuple(r) for r in df.collect()], key=repr)
    assert len(got) == len(want)
    want.sort(key=lambda r: (str(r[0]), r[2], r[5]))
    got.sort(key=lambda r: (str(r[0]), r[2], r[5]))
    for a, b in zip(got, want):
        assert a[:5] == b[:5]
        assert math.isclose(a[5], b[5], rel_tol=1e-9) and math.isclose(a[6], b[6], rel_tol=1e-5)


def test_against_trie(docs):
    few = docs.where("doc_id < 40")
    compare(score(few, order=3, block_bytes=5000, shard_bytes=4000), [tuple(r) for r in few.select("doc_id", "text").collect()])


def test_edges(edge):
    some = edge.where("doc_id IS NULL OR doc_id <> 6")
    compare(score(some, order=3), [tuple(r) for r in some.select("doc_id", "text").collect()])
    assert score(edge).count() == edge.count()


def test_empty(empty):
    assert score(empty).count() == 0


def test_nothing_to_learn(spark):
    held = [i for i in range(200) if zlib.crc32(str(i).encode()) % 10 == 0][:2]
    got = score(spark.createDataFrame([(i, "ab") for i in held], "doc_id long, text string")).collect()
    assert all(r.n_known == 0 and r.train_tokens == 0 and math.isclose(r.score, -3 * math.log10(256), rel_tol=1e-6) for r in got)
