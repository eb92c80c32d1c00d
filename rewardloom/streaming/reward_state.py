"""The reward table as streaming state with retraction.

``incremental`` keeps every landed version and rebuilds the table from the current ones.  Here the table itself is
kept: a chat that lands again takes back what it gave before, and only the keys it touches change.  Two queries, each with its
state in RocksDB, run one after the other (``drain``):

1. by chat: state is what the chat's latest version gives, (key, user, place, time, reward) of each clean rated message.  A new
   version puts out the difference: rows with sign -1 taken back, +1 given.  Unchanged messages put out nothing, a
   chat without rated messages takes everything back.  The differences are appended to a table by the file sink, exactly once.
2. by (key, user, slice of chats): state is the multiset of what is given now.  Signs just add up, so the order in which
   differences arrive doesn't matter.  A group that changed puts out its count and its last write (update mode); each
   batch is written to a folder of its own, so a repeated batch overwrites itself.

A key that holds a third of all ratings is thus many small states, by user and by ``SLICES`` slices of that user's chats, and a state
is read only when its group changes.  ``reward_table`` joins the users of now (a late user's ratings wait in the state) and merges a key's
groups: counts add, the last write of last writes wins, both map-side combined.

Of several versions of a chat in one batch the latest ``updated_at`` counts (then the greatest md5 of the document); otherwise the later
batch.  A chat without an id can't be replaced and takes no part.  ``compact`` (between runs) writes the current groups as a new
round; only the newest round is read.
"""

from __future__ import annotations

import json
from collections import Counter
from contextlib import contextmanager

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.streaming.state import GroupStateTimeout

from rewardloom.functions.order import seq_col
from rewardloom.functions.text import coerce_numeric, reward_key
from rewardloom.operators import clean as C, extract as E, rewards as R
from rewardloom.session import path_exists, ship

SLICES = 64
ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
_PROVIDER = "spark.sql.streaming.stateStore.providerClass"


@contextmanager
def _state_in_rocksdb(spark: SparkSession):
    """A query takes its settings when it starts; the session's own come back afterwards."""
    old = spark.conf.get(_PROVIDER, None)
    spark.conf.set(_PROVIDER, ROCKS)
    try:
        yield
    finally:
        if old is None:
            spark.conf.unset(_PROVIDER)
        else:
            spark.conf.set(_PROVIDER, old)


def given(chats: DataFrame) -> DataFrame:
    """Per rated message of every landed version: chat_id, updated_at, doc, key, user, msg_pos, epoch, reward; key is NULL where the
    message isn't clean, and a version without rated messages is one such row."""
    updated = F.col("updated_at") if "updated_at" in chats.columns else F.lit(None).cast("bigint")
    # the version travels with the messages inside the user's column
    version = F.struct(F.col("user_id").cast("string").alias("user"), updated.alias("updated_at"), F.md5("chat").alias("doc"))
    rows = E.message_fields(E.explode_with_parent(chats.where(F.col("id").isNotNull()).withColumn("user_id", version), E.is_rated, outer=True))
    clean = C.keep_after_cleaning() & F.col("user_id.user").isNotNull()
    return rows.select("chat_id", "user_id.updated_at", "user_id.doc", F.when(clean, reward_key("question", "answer")).alias("key"),
                       F.col("user_id.user").alias("user"), "msg_pos", F.unix_seconds("datetime").alias("epoch"),
                       R.reward_expr(coerce_numeric(F.col("rating"))).alias("reward"))


def _whole(x):
    return None if x is None or x != x else int(x)


_VERSION = ("updated_at", "doc", "key", "user", "msg_pos", "epoch", "reward")


def difference(old: list, versions: pd.DataFrame) -> tuple[list, list]:
    """(what the latest of ``versions`` gives, [(what, sign)] against ``old``); what is [key, user, place, time, reward]."""
    return _difference(old, list(zip(*(versions[c] for c in _VERSION))))


def _difference(old: list, versions: list) -> tuple[list, list]:
    rank = [(_whole(u) is not None, _whole(u) or 0, d or "", n or "") for u, d, _, n, *_ in versions]
    last = max(rank)
    new = [[k, u, int(p), _whole(e), float(r)] for at, (_, _, k, u, p, e, r) in zip(rank, versions) if at == last and isinstance(k, str)]
    count = Counter(map(tuple, new))
    count.subtract(map(tuple, old))
    return new, [(what, sign) for what, sign in count.items() if sign]


def _packed(*columns: str):
    """Columns as one JSON text: a group's cost in Python is mostly that of its columns, each a series of its own."""
    return F.to_json(F.struct(*columns)).alias("row")


def _rows(frames, columns: tuple) -> list:
    return [tuple(map(json.loads(text).get, columns)) for t in frames for text in t["row"]]


def _unpacked(df: DataFrame, shape: T.StructType) -> DataFrame:
    return df.select(F.from_json("row", shape).alias("row")).select("row.*")


def _id(x):
    return x if isinstance(x, str) else int(x)


def _differences(chats: DataFrame, id_type: T.DataType) -> DataFrame:
    shape = T.StructType().add("chat_id", id_type).add("key", "string").add("user", "string").add("msg_pos", "integer").add("epoch", "long") \
        .add("reward", "double").add("sign", "integer")
    names = shape.names

    def run(group, frames, state):
        old = json.loads(state.get[0]) if state.exists else []
        new, changed = _difference(old, _rows(frames, _VERSION))
        if new:
            state.update((json.dumps(new),))
        elif state.exists:
            state.remove()
        if changed:
            yield pd.DataFrame({"row": [json.dumps(dict(zip(names, (_id(group[0]), *what, sign)))) for what, sign in changed]})

    by = given(chats).select("chat_id", _packed(*_VERSION)).groupBy("chat_id")
    return _unpacked(by.applyInPandasWithState(run, "row string", T.StructType().add("given", "string"), "append", GroupStateTimeout.NoTimeout), shape)


def applied(held: list, changes) -> list:
    """The multiset [[what, count]] after changes (what, sign); what is (chat, place, time, reward)."""
    count = Counter({tuple(what): n for what, n in held})
    for what, sign in changes:
        count[what] += sign
    return [[list(what), n] for what, n in count.items() if n]


def last_write(held: list):
    """(count, what) of the ratings in force; what has the last place in source order."""
    live = [(what, n) for what, n in held if n > 0]
    if not live:
        return 0, None
    return sum(n for _, n in live), max((what for what, _ in live), key=lambda w: (w[2] is not None, -(w[2] or 0), w[0], w[1]))


def _groups(differences: DataFrame, id_type: T.DataType) -> DataFrame:
    shape = T.StructType().add("key", "string").add("user", "string").add("slice", "integer").add("n", "long").add("chat_id", id_type) \
        .add("msg_pos", "integer").add("epoch", "long").add("reward", "double")
    names = shape.names

    change = ("chat_id", "msg_pos", "epoch", "reward", "sign")

    def run(group, frames, state):
        held = json.loads(state.get[0]) if state.exists else []
        held = applied(held, [((c, p, e, float(r)), s) for c, p, e, r, s in _rows(frames, change)])
        if held:
            state.update((json.dumps(held),))
        elif state.exists:
            state.remove()
        n, what = last_write(held)
        key, user, part = group
        yield pd.DataFrame({"row": [json.dumps(dict(zip(names, (key, user, int(part), n, *(what or (None, None, None, None))))))]})

    by = differences.select("key", "user", F.pmod(F.xxhash64("chat_id"), F.lit(SLICES)).cast("int").alias("slice"), _packed(*change)).groupBy("key", "user", "slice")
    return _unpacked(by.applyInPandasWithState(run, "row string", T.StructType().add("held", "string"), "update", GroupStateTimeout.NoTimeout), shape)


def _rounds(spark: SparkSession, base: str) -> DataFrame | None:
    at = f"{base.rstrip('/')}/groups"
    return spark.read.option("basePath", at).parquet(at) if path_exists(spark, at) else None


def _round(spark: SparkSession, base: str) -> int:
    rows = _rounds(spark, base)
    return 0 if rows is None else int(rows.agg(F.max("round")).first()[0] or 0)


def drain(chats: DataFrame, base: str) -> None:
    """Takes in what has landed since the last run on ``base`` (state, checkpoints and tables lie there) and stops."""
    spark, base = chats.sparkSession, base.rstrip("/")
    id_type = chats.schema["id"].dataType
    ship(spark)
    with _state_in_rocksdb(spark):
        first = (_differences(chats, id_type).writeStream.format("parquet").outputMode("append").option("path", f"{base}/differences")
                 .option("checkpointLocation", f"{base}/by-chat").trigger(availableNow=True).start())
        first.awaitTermination()
        at = f"{base}/groups/round={_round(spark, base)}"

        def land(batch: DataFrame, batch_id: int):
            batch.write.mode("overwrite").parquet(f"{at}/batch_id={batch_id}")

        source = spark.readStream.schema(spark.read.parquet(f"{base}/differences").schema).parquet(f"{base}/differences")
        second = (_groups(source, id_type).writeStream.outputMode("update").foreachBatch(land)
                  .option("checkpointLocation", f"{base}/by-key").trigger(availableNow=True).start())
        second.awaitTermination()


def current_groups(spark: SparkSession, base: str) -> DataFrame:
    """Count and last write of every (key, user, slice) that has ratings now."""
    rows = _rounds(spark, base)
    if rows is None:
        raise ValueError(f"nothing has landed in {base}")
    rows = rows.where(F.col("round") == _round(spark, base))
    now = F.max_by(F.struct("n", "chat_id", "msg_pos", "epoch", "reward"), "batch_id")
    return rows.groupBy("key", "user", "slice").agg(now.alias("now")).select("key", "user", "slice", "now.*").where("n > 0")


def reward_table(spark: SparkSession, base: str, users: DataFrame) -> DataFrame:
    """key, reward, n_ratings, as ``rewards.build_reward_cache`` gives over all chats and the users of now."""
    rows = current_groups(spark, base).join(users.select(F.col("id").cast("string").alias("user")), "user")
    return rows.groupBy("key").agg(F.max_by("reward", seq_col("epoch", "chat_id", "msg_pos")).alias("reward"), F.sum("n").alias("n_ratings"))


def compact(spark: SparkSession, base: str) -> int:
    """Writes the current groups as a new round and returns its number; earlier rounds are read no more.  Not while ``drain`` runs."""
    new = _round(spark, base) + 1
    current_groups(spark, base).write.mode("overwrite").parquet(f"{base.rstrip('/')}/groups/round={new}/batch_id=-1")
    return new
