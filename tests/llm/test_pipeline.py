"""The stages on the smallest table, and each one's decisions."""

import pytest

import corpus_pipeline as C
from tests.llm.conftest import SF

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def results(spark, docs):
    out, df = [], docs
    from rewardloom.llm.common import materialize
    for name, stage in C.STAGES:
        df = materialize(stage(spark, df, SF), f"test-{name}")
        out.append((name, df))
    return out


def test_stages(results, docs):
    assert [n for n, _ in C.STAGES] == ["quality", "language", "near_copies", "mix", "pack"]
    before = docs
    for name, df in results[:3]:
        assert df.columns == COLUMNS
        assert df.exceptAll(before).count() == 0
        before = df


def test_clean_documents_stay(results, docs, labels):
    good = labels.where("quality = 1").count()
    kept = results[0][1].join(labels, "doc_id").where("quality = 1").count()
    assert kept >= 0.98 * good
    bad = labels.where("quality = 0").count()
    assert results[0][1].join(labels, "doc_id").where("quality = 0").count() <= 0.3 * bad
    assert results[1][1].count() >= 0.98 * results[0][1].count()


def test_one_of_each_group(results):
    from rewardloom.llm.ngram_join import linked
    before, after = results[1][1], results[2][1]
    assert after.count() == linked(before).select("class_id").distinct().count()
    assert linked(after).where("n_links > 0").count() == 0


def test_mix_repeats_whole_rows(results):
    counts = {r["count"] for r in results[3][1].groupBy("doc_id").count().collect()}
    assert counts <= {1, 2}
    assert results[3][1].columns == COLUMNS


def test_run_equals_stages(spark, results):
    """The same documents as often and as long; where a piece is cut depends on how rows lie in partitions."""
    def packed(df):
        total = {}
        for r in df.select("doc_id", "length", "doc_tokens").collect():
            key = r.doc_id, r.doc_tokens
            total[key] = total.get(key, 0) + r.length
        return total

    got = packed(C.run(spark, SF))
    assert got == packed(results[4][1]) and all(n in (size, 2 * size) for (_, size), n in got.items())


def test_registered():
    import __spark_entry__ as entry
    names = [n for n in entry.queries() if n.startswith("op")]
    assert [int(n[2:].split("_")[0]) for n in names] == list(range(1, 14))
    assert "pipeline" in entry.queries()
