import random
import zlib

from rewardloom.llm.quality import accepted_rows, posteriors
from rewardloom.llm.toxicity import features, score
from tests.conftest import SF01


def auc(pairs):
    pairs = sorted(pairs)
    ones, zeros = sum(y for _, y in pairs), sum(1 - y for _, y in pairs)
    values, total, i = [p for p, _ in pairs], 0.0, 0
    while i < len(pairs):
        j = i
        while j < len(pairs) and values[j] == values[i]:
            j += 1
        total += (i + j + 1) / 2 * sum(y for _, y in pairs[i:j])
        i = j
    return (total - ones * (ones + 1) / 2) / (ones * zeros)


def test_toxicity_held_out(spark):
    docs, labels = (spark.read.parquet(f"{SF01}/{t}.parquet") for t in ("documents", "labels"))
    rows = score(docs, labels).join(labels, "doc_id").collect()
    held = [r for r in rows if r.held_out]
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) and 0 <= r.score <= 1 for r in rows)
    assert all(r.predicted == int(r.score >= 0.3) for r in rows)
    assert auc([(r.score, r.toxic) for r in held]) > 0.75
    assert sum(r.predicted == r.toxic for r in held) >= 0.85 * len(held)


def test_hidden_insults():
    lexicon = {"idiot": 3.0, "loser": 3.0}
    plain, hidden, clean = (features(t, lexicon) for t in ("you are an idiot", "you are an 1d1.ot and l*o.ser", "you are an angel"))
    assert plain[2] == 1 and plain[9] == 1.0 and hidden[6] == 2 and not clean[2] and not clean[6]


def test_toxicity_edges(edge, empty, labels, no_labels, spark):
    marks = spark.createDataFrame([(i, i % 2, i % 2) for i in (1, 2, 6, 8, 9, 10, 11, 1)], "doc_id long, quality int, toxic int")
    for m in (marks, no_labels):
        rows = score(edge, m).collect()
        assert len(rows) == edge.count() and all(0 <= r.score <= 1 for r in rows)
    assert score(empty, marks).count() == 0


def test_small_sample_keeps_the_share(spark):
    """Half of the sample is toxic, a tenth of the documents: the scores' mean stays near a tenth."""
    rng = random.Random(4)
    toxic = [int(i % 10 == 0) for i in range(3000)]
    words = lambda y: [f"w{rng.randrange(300)}" for _ in range(12)] + (["you", "idiot"] if rng.random() < (0.6 if y else 0.1) else [])
    docs = spark.createDataFrame([(i, " ".join(words(y))) for i, y in enumerate(toxic)], "doc_id long, text string")
    labels = spark.createDataFrame(list(enumerate(toxic)), "doc_id long, toxic int")
    rows = score(docs, labels, sample=400).collect()
    assert abs(sum(r.score for r in rows) / len(rows) - 0.1) < 0.05


def test_quality_held_out(spark):
    from pyspark.sql import functions as F
    docs, labels = (spark.read.parquet(f"{SF01}/{t}.parquet") for t in ("documents", "labels"))
    learn = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 != 0
    rows = posteriors(docs, labels, keep=learn).join(labels, "doc_id").where(~learn).collect()
    assert auc([(r.score, r.quality) for r in rows]) > 0.97
    clean = [r for r in rows if r.quality == 1]
    assert sum(r.accepted for r in clean) >= 0.98 * len(clean)


def test_sparse_site_shrinks(spark):
    """A path of one document takes its host's rate, a host of one the global rate; a large bad host speaks for itself."""
    good, bad = "A plain sentence of quite ordinary words, number {} in its row.", "BUY NOW!!! ### $$$ | WIN | {} !!!"
    rows = [(i, (bad if s == "bad" and i % 10 else good).format(i), s, "x") for i in range(300) for s in ["bad" if i % 3 == 0 else "good"]]
    rows.append((1000, good.format(7), "tiny", "y"))
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, lang string")
    labels = spark.createDataFrame([(i, int(not (s == "bad" and i % 10)), 0) for i, _, s, _ in rows], "doc_id long, quality int, toxic int")
    got = {r.doc_id: r for r in posteriors(docs, labels).collect()}
    glob = sum(r.text_score for r in got.values()) / len(got)
    assert abs(got[1000].host_rate - glob) < 0.2
    assert got[3].host_rate < 0.4 < got[1].host_rate


def test_quality_edges(edge, empty, no_labels, labels):
    rows = posteriors(edge, no_labels).collect()
    assert len(rows) == edge.count()
    assert not any(r.accepted for r in rows if r.doc_id in (3, 4, 5, 12))
    assert posteriors(empty, labels).count() == 0
    kept = accepted_rows(edge, no_labels)
    assert kept.columns == edge.columns and kept.count() == sum(r.accepted for r in rows)


def test_posteriors_by_hand(spark):
    """Host and path rates, strengths, and scores computed again from the text scores, on all of a table."""
    import math
    from collections import defaultdict
    docs, labels = (spark.read.parquet(f"{SF01}/{t}.parquet") for t in ("documents", "labels"))
    got = {r.doc_id: r for r in posteriors(docs, labels).collect()}
    from rewardloom.llm.quality import learn
    offset = learn(docs, labels)[2]
    place = {r.doc_id: (r.source, r.lang) for r in docs.select("doc_id", "source", "lang").collect()}
    hosts, paths = defaultdict(list), defaultdict(list)
    for i, r in got.items():
        hosts[place[i][0]].append(r.text_score)
        paths[place[i]].append(r.text_score)
    rate = sum(r.text_score for r in got.values()) / len(got)

    def strength(count, sizes, spread):
        chance, n = rate * (1 - rate), sum(sizes)
        left = n - sum(s * s for s in sizes) / n
        return min(max(chance / max((spread - (count - 1) * chance) / left, 1e-7) - 1, 1.0), 1e6)

    mean = lambda x: sum(x) / len(x)
    k_host = strength(len(hosts), [len(x) for x in hosts.values()], sum(len(x) * (mean(x) - rate) ** 2 for x in hosts.values()))
    k_path = strength(len(paths) - len(hosts) + 1, [len(x) for x in paths.values()],
                      sum(len(x) * (mean(x) - mean(hosts[s[0]])) ** 2 for s, x in paths.items()))
    keep = lambda x: min(max(x, 1e-6), 1 - 1e-6)
    for i, r in got.items():
        h, p, mine = hosts[place[i][0]], paths[place[i]], r.text_score
        host = keep((sum(h) - mine + k_host * rate) / (len(h) - 1 + k_host))
        path = keep((sum(p) - mine + k_path * host) / (len(p) - 1 + k_path))
        assert abs(r.host_rate - host) < 1e-6 and abs(r.path_rate - path) < 1e-6
        if 1e-9 < mine < 1 - 1e-9:
            odds = math.log(mine / (1 - mine)) - offset + math.log(path / (1 - path))
            assert abs(r.score - 1 / (1 + math.exp(-odds))) < 1e-5
        assert r.accepted == (r.score >= 0.5)


def test_one_id_on_many_rows(spark):
    """The samples are bounded by rows: an id of 3,000 texts doesn't bring them all, and rows alike in id and text count once."""
    from rewardloom.llm.common import bounded_sample, labelled_rows, sampled_texts
    from rewardloom.llm.toxicity import learning_rows
    from pyspark.sql import functions as F
    rows = [(7, f"text {i % 1500} of one id") for i in range(3000)] + [(i, f"text of {i}") for i in range(100, 400)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(7, 1, 1)] + [(i, i % 2, i % 2) for i in range(100, 400)], "doc_id long, quality int, toxic int")
    every = labelled_rows(docs, labels.select("doc_id", F.col("quality").alias("label")))
    assert every.count() == 1500 + 300
    assert sampled_texts(docs, bounded_sample(every, 200)).count() == 200
    got = learning_rows(docs, labels, "toxic", F.lit(True), 400).collect()
    assert len(got) == 350 and sum(r.weight for r in got if r.label) == 1650
