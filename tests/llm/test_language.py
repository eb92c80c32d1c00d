import zlib

from rewardloom.llm.langid import UNKNOWN, identified_rows, identify


def test_held_out_accuracy(docs):
    rows = identify(docs).join(docs.select("doc_id", "lang"), "doc_id").collect()
    held = [r for r in rows if r.held_out]
    assert len(rows) == docs.count() and held
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in rows)
    assert sum(r.lang == r.lang_pred for r in held) >= 0.95 * len(held)
    assert all(0 <= r.score <= 1 for r in rows)


def test_edges(edge, empty):
    rows = identify(edge).collect()
    assert len(rows) == edge.count()
    assert {r.lang_pred for r in rows if r.doc_id in (3, 4, 5, 7, 12)} == {UNKNOWN}
    assert all(r.lang_pred != UNKNOWN for r in rows if r.doc_id in (1, 9, 10, 11))
    assert identify(empty).count() == 0
    kept = identified_rows(edge, least=0.0)
    assert kept.columns == edge.columns and kept.where("doc_id IN (3, 4, 5, 7, 12)").count() == 0
    assert kept.count() == sum(r.lang_pred != UNKNOWN for r in rows)


def test_nothing_learned(spark):
    df = spark.createDataFrame([(1, "some text", None)], "doc_id long, text string, lang string")
    assert [(r.lang_pred, r.score) for r in identify(df).collect()] == [(UNKNOWN, 0.0)]


def test_one_language(spark):
    df = spark.createDataFrame([(i, "some text", "xx") for i in range(9)], "doc_id long, text string, lang string")
    assert {(r.lang_pred, r.score) for r in identify(df).collect()} == {("xx", 1.0)}


def test_only_letters_count_as_text(spark):
    """Numerals and marks that aren't of category L are no letters: ½, ², ①, Roman numeral one, a combining accent."""
    learn = [(i, "the cat is on the table and the door", "en") for i in range(20)] + [(50 + i, "le chat est sur la table et la porte", "fr") for i in range(20)]
    odd = [(100, "½ ² ①", None), (101, "\u2160 \u0301 _ 7", None), (102, "", None), (103, "é", None), (104, "日本", None), (105, "ª", None)]
    got = {r.doc_id: r.lang_pred for r in identify(spark.createDataFrame(learn + odd, "doc_id long, text string, lang string")).collect()}
    assert [got[i] == UNKNOWN for i in range(100, 106)] == [True, True, True, False, False, False]


def test_one_id_on_many_rows(spark, docs):
    """An id that 30,000 rows share, of one text and of many, adds no more to the sample than its bound; the learning rows stay bounded."""
    from pyspark.sql import functions as F
    from rewardloom.llm.langid import learn
    kind = ["doc_id", "text", "lang"]
    hot, odd = [i for i in range(5000, 5100) if zlib.crc32(str(i).encode()) % 3 != 1][:2]       # not held out
    same = spark.range(20_000).select(F.lit(hot).cast("long").alias("doc_id"), F.lit("the cat is on the table").alias("text"), F.lit("en").alias("lang"))
    many = spark.range(10_000).select(F.lit(hot).cast("long").alias("doc_id"), F.concat(F.lit("a dog number "), F.col("id").cast("string")).alias("text"), F.lit("en").alias("lang"))
    fr = spark.createDataFrame([(i, f"le chat {i} est sur la table et la porte", "fr") for i in range(900)], kind)
    both = spark.createDataFrame([(odd, "der Hund und die Katze", x) for x in ("de", "de", "nl")], kind)
    df = same.unionByName(many).unionByName(fr).unionByName(both)
    model = learn(df, sample=400)
    assert sorted(model.langs) == ["de", "en", "fr", "nl"]
    got = {r.doc_id: r.lang_pred for r in identify(df.where("lang = 'fr'")).collect()}
    assert set(got.values()) == {"fr"}
