import hashlib
import re

from pyspark.sql import functions as F

from rewardloom.llm.iblt import differences, fingerprint


def pieces(x):
    return set(re.split(r"\n|(?<=[.!?]) ", x))


def brute(rows):
    rows = sorted({(i, t or "") for i, t in rows})
    for (i, x), (_, y) in zip(rows, rows[1:] + rows[:1]):
        q = len(x) // 4
        e = x[:len(x) - q] + y[:q]
        like = lambda a, b: len(a & b) / len(a | b)
        yield i, len(x), hashlib.sha256(e.encode()).hexdigest(), like(pieces(x), pieces(e)), like(pieces(x), pieces(y))


def test_against_sets(docs):
    got = sorted((r.doc_id, r.n_chars, r.edited_sha256, r.near_edited, r.near_next) for r in fingerprint(docs).collect())
    want = sorted(brute([tuple(r) for r in docs.select("doc_id", "text").collect()]))
    assert [g[:3] for g in got] == [w[:3] for w in want]
    assert all(abs(a - b) < 1e-12 for g, w in zip(got, want) for a, b in zip(g[3:], w[3:]))


def test_one_rule_at_all_lengths(spark):
    """Texts of one line that differ in a last sentence, on either side of 2,000 code points, and a far longer one."""
    first = " ".join(f"Sentence {i} of the same line." for i in range(67))[:1990]
    rows = [(1, first + ". End it"), (2, first + ". End it here!"), (3, " ".join(f"Is {i} another one?" for i in range(900)))]
    assert len(rows[0][1]) < 2000 <= len(rows[1][1])
    cut = lambda x: set(re.split(r"\n|(?<=[.!?]) ", x))
    got = {r.doc_id: r for r in fingerprint(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    like = lambda a, b: len(a & b) / len(a | b)
    for (i, x), (_, y) in zip(rows, rows[1:] + rows[:1]):
        q = len(x) // 4
        edited = cut(x[:len(x) - q] + y[:q])
        assert abs(got[i].near_edited - like(cut(x), edited)) < 1e-12 and abs(got[i].near_next - like(cut(x), cut(y))) < 1e-12
    assert got[1].near_next > 0.9 and all(r.near_edited > 0.4 for r in got.values())


def test_equal_texts_equal_prints(edge):
    rows = fingerprint(edge).collect()
    assert len(rows) == edge.count()
    by = {}
    text = {r.doc_id: r.text or "" for r in edge.collect()}
    for r in rows:
        by.setdefault(text[r.doc_id], set()).add(r.fingerprint)
    assert all(len(x) == 1 for x in by.values())
    assert len({next(iter(x)) for x in by.values()}) == len(by)
    assert all(0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1 for r in rows)


def test_one_and_none(spark, empty):
    assert fingerprint(empty).count() == 0
    one = fingerprint(spark.createDataFrame([(5, "abcdefgh")], "doc_id long, text string")).first()
    assert one.n_chars == 8 and one.edited_sha256 == hashlib.sha256(b"abcdefab").hexdigest() and one.near_next == 1.0


def test_large_differences_are_tried_larger(spark):
    df = spark.range(3).select(F.col("id").alias("pair"),
                               F.transform(F.sequence(F.lit(0), F.lit(3000)), lambda i: F.xxhash64(i)).alias("a"),
                               F.transform(F.sequence(F.lit(10), F.lit(10) + 1000 * F.col("id").cast("int")), lambda i: F.xxhash64(i)).alias("b"))
    got = {r.pair: (r.only_a, r.only_b) for r in differences(df).collect()}
    assert got == {0: (3000, 0), 1: (2000, 0), 2: (1000, 0)}


def test_edges_against_sets(edge):
    """Null ids and texts, ties and repeated rows: (null, ...) first, then by id and text hash."""
    key = lambda r: (r.doc_id is not None, r.doc_id or 0, r.h)
    rows = edge.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).withColumn("h", F.xxhash64("text")).collect()
    order = sorted(set(rows), key=key)
    want = []
    for r, after in zip(order, order[1:] + order[:1]):
        q = len(r.text) // 4
        e = r.text[:len(r.text) - q] + after.text[:q]
        like = lambda a, b: len(a & b) / len(a | b)
        want += [(str(r.doc_id), len(r.text), hashlib.sha256(e.encode()).hexdigest(), round(like(pieces(r.text), pieces(e)), 12),
                  round(like(pieces(r.text), pieces(after.text)), 12))] * rows.count(r)
    got = [(str(r.doc_id), r.n_chars, r.edited_sha256, round(r.near_edited, 12), round(r.near_next, 12)) for r in fingerprint(edge).collect()]
    assert sorted(got) == sorted(want)


def test_peeling_gives_the_digests_back(spark):
    """Sets of up to 400 digests, empty and equal ones among them; a sketch that fails is tried larger, the last resort compares sets."""
    sets = [(i, [j * 7919 for j in range(i % 11 * 40)], [j * 7919 for j in range(i % 7 * 25, i % 11 * 40 + i % 3)]) for i in range(150)]
    df = spark.createDataFrame(sets, "pair long, a array<long>, b array<long>")
    for tries in (14, -1):
        got = {r.pair: (set(r.digests_a), set(r.digests_b), r.only_a, r.only_b) for r in differences(df, digests=True, tries=tries).collect()}
        assert got == {i: (set(a) - set(b), set(b) - set(a), len(set(a) - set(b)), len(set(b) - set(a))) for i, a, b in sets}


def test_plan_is_native(docs):
    plan = fingerprint(docs)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", plan)
