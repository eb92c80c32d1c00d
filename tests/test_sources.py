"""Source adapters.  JDBC cannot be exercised without a database (none may be
started here), so the reader is replaced by a stub that records how the read
is split and returns a chat-shaped frame."""

from rewardloom.sources import tables


class _Reader:
    def __init__(self, spark, calls):
        self.spark, self.calls = spark, calls

    def jdbc(self, url, table, **kw):
        self.calls.append((url, table, kw))
        return self.spark.createDataFrame([(1, 2, "{}")], "id bigint, user_id bigint, chat string")


class _Spark:
    def __init__(self, spark, calls):
        self.read = _Reader(spark, calls)


def test_jdbc_read_is_split(spark):
    calls = []
    fake = _Spark(spark, calls)
    df = tables.read_chat(fake, "jdbc:postgresql://db/x", fmt="jdbc", id_splits=[20, -5, 7],
                          jdbc_props={"user": "u"})
    url, table, kw = calls[0]
    assert (url, table) == ("jdbc:postgresql://db/x", "chat")
    assert kw["predicates"] == ["id < -5", "id >= -5 AND id < 7", "id >= 7 AND id < 20", "id >= 20", "id IS NULL"]
    assert kw["properties"] == {"user": "u"}
    # missing optional column -> NULL, fixed schema
    assert df.schema.simpleString() == "struct<id:bigint,user_id:bigint,chat:string,updated_at:bigint>"
    tables.read_chat(fake, "jdbc:postgresql://db/x", fmt="jdbc", num_partitions=8, id_bounds=(0, 10**6))
    _, _, kw = calls[1]
    assert (kw["column"], kw["lowerBound"], kw["upperBound"], kw["numPartitions"]) == ("id", 0, 10**6, 8)


def test_user_table_requires_its_columns(spark):
    import pytest
    bad = spark.createDataFrame([(1,)], "id bigint")
    with pytest.raises(ValueError):
        tables._conform(bad, tables.S.USER)


def test_slices_hold_every_row_once(spark):
    rows = [(i,) for i in (-3, -64, 0, 5, 7, 8, 100, None)]
    df = spark.createDataFrame(rows, "id bigint")
    parts = [[r.id for r in df.where(p).collect()] for p in tables.split_predicates([0, 7, 64])]
    assert sorted([x for p in parts for x in p], key=str) == sorted([r[0] for r in rows], key=str)
    text = spark.createDataFrame([("a'b",), ("m",), ("z",), (None,)], "id string")
    assert sum(text.where(p).count() for p in tables.split_predicates(["a'b", "n"])) == 4


def test_ids_are_kept_as_found(spark):
    from rewardloom.operators import extract as E
    from rewardloom.session import scratch_path
    path = scratch_path(spark, "t-ids")
    doc = '{"history":{"messages":{"a":{"role":"user","content":"x","annotation":{"rating":1}}}}}'
    spark.createDataFrame([("c-1", "u-1", doc), (None, "u-1", doc)], "id string, user_id string, chat string").write.parquet(path + "/c")
    spark.createDataFrame([("u-1", "e")], "id string, email string").write.parquet(path + "/u")
    chat, users = tables.read_sources(spark, path + "/c", path + "/u")
    assert chat.schema.simpleString() == "struct<id:string,user_id:string,chat:string,updated_at:bigint>"
    assert sorted(str(r.chat_id) for r in E.extract_feedback(chat, users).collect()) == ["None", "c-1"]


def test_changed_input_is_staged_again(spark):
    from rewardloom.plans.inputs import prompts
    from rewardloom.session import scratch_path
    base = "file://" + scratch_path(spark, "t-stage").split(":", 1)[-1]
    kind = "doc_id bigint, text string, lang string, source string, n_chars bigint"
    for n in (10, 50):
        rows = [(i, f"text {i}", "en", "s", 1) for i in range(n)]
        spark.createDataFrame(rows, kind).write.mode("overwrite").parquet(f"{base}/documents.parquet")
        assert prompts(spark, base).count() == n + 1


def test_cluster_needs_a_shared_folder():
    import pytest
    from rewardloom.session import shared_dir

    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

    class Session:
        sparkContext = Context()

        class conf:
            @staticmethod
            def get(key, default=None):
                return default

    with pytest.raises(RuntimeError):
        shared_dir(Session())
