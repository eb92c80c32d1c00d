"""The periodic rerun as an incremental Structured Streaming job.

New chat files land in a folder; each trigger parses only the chats in new files.  A chat row is the chat as
it is now: it may land again, grown or re-rated, and then replaces what it held before.  A rerun of
everything must give the same result, so the job keeps, per landed version of a chat, its rated messages, and
readers take each chat's latest version:

* ``heads``: (chat_id, gen, batch_id), one row per landed version, also of a chat without rated messages;
* ``rows``: the version's rated messages, without the user (``user_id`` only).

A version's order is (gen, batch_id).  ``gen`` grows with every start of the job, so a new checkpoint on an old
sink, or a batch repeated after a failure, is newer than what it replaces.  Rows are written before heads, each in
a folder of its own batch, so a half-done batch is never read.

Users are joined when reading: a user that arrives after its chats is found like any other.  The feedback, the gates and
the reward table are the batch operators over the current rows.

Run with ``trigger(availableNow=True)`` from any scheduler: it drains what is there and stops, surviving
restarts through the checkpoint.  ``compact`` (between runs) writes the current rows as one new version.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from rewardloom import schema as S
from rewardloom.operators import clean as C, extract as E, rewards as R, runs as O
from rewardloom.session import path_exists


def chat_stream(spark: SparkSession, path: str, fmt: str = "parquet",
                max_files_per_trigger: int | None = None, schema=None) -> DataFrame:
    """The landing folder as a stream; ``schema`` where ids aren't integers."""
    r = spark.readStream.schema(schema or S.CHAT).format(fmt)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", int(max_files_per_trigger))
    return r.load(path)


def _versions(spark: SparkSession, sink: str, table: str) -> DataFrame | None:
    base = f"{sink.rstrip('/')}/{table}"
    return spark.read.option("basePath", base).parquet(base) if path_exists(spark, base) else None


def _next_gen(spark: SparkSession, sink: str) -> int:
    heads = _versions(spark, sink, "heads")
    last = heads.agg(F.max("gen")).first()[0] if heads is not None else None
    return 0 if last is None else int(last) + 1


def _latest_in_batch(chats: DataFrame) -> DataFrame:
    """One row per chat of a batch: the latest ``updated_at``, then the greatest document text, so that retries agree."""
    order = [F.col("updated_at").desc_nulls_last()] if "updated_at" in chats.columns else []
    w = Window.partitionBy("id").orderBy(*order, F.col("chat").desc_nulls_last(), F.col("user_id").desc_nulls_last())
    return chats.withColumn("_n", F.row_number().over(w)).where("_n = 1").drop("_n")


def start_extract(chats: DataFrame, sink: str, checkpoint: str, available_now: bool = True):
    """Start the job; ``current_feedback`` and the like read its sink."""
    spark = chats.sparkSession
    gen, base = _next_gen(spark, sink), sink.rstrip("/")

    def land(batch: DataFrame, batch_id: int):
        now = _latest_in_batch(batch)
        at = f"gen={gen}/batch_id={batch_id}"
        rows = E.message_fields(E.explode_with_parent(now, E.is_rated))
        rows.write.mode("overwrite").parquet(f"{base}/rows/{at}")
        now.select(F.col("id").alias("chat_id")).write.mode("overwrite").parquet(f"{base}/heads/{at}")

    w = chats.writeStream.foreachBatch(land).option("checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 hour")
    return w.start()


def current_rows(spark: SparkSession, sink: str) -> DataFrame:
    """The rated messages of every chat's latest version.  Heads are ids only; the latest one per chat is a
    map-side combined aggregate."""
    heads = _versions(spark, sink, "heads")
    if heads is None:
        raise ValueError(f"nothing has landed in {sink}")
    latest = heads.groupBy("chat_id").agg(F.max(F.struct("gen", "batch_id")).alias("v")).select("chat_id", "v.gen", "v.batch_id")
    return _versions(spark, sink, "rows").join(latest, ["chat_id", "gen", "batch_id"]).drop("gen", "batch_id")


def current_feedback(spark: SparkSession, sink: str, users: DataFrame, days_back: int | None = None, as_of=None) -> DataFrame:
    """What ``extract_feedback`` (unsorted) gives over all landed chats and the users of now."""
    rows = E.with_seq(E.join_user(E.recency_filter(current_rows(spark, sink), days_back, as_of), users))
    return rows.select("chat_id", "msg_pos", "message_id", "role", *E.FEEDBACK_COLUMNS, "seq")


def current_reward_table(spark: SparkSession, sink: str, users: DataFrame) -> DataFrame:
    return R.build_reward_cache(R.reward_samples(C.clean_feedback(current_feedback(spark, sink, users))))


def publish_current(spark: SparkSession, sink: str, users: DataFrame, publish_to: str, run_id: str | None = None,
                    days_back: int | None = None, as_of=None) -> dict:
    """The rest of the scheduled run: gates, labels, the published samples and their card."""
    return O.execute_run(O.run_of(current_feedback(spark, sink, users, days_back, as_of), run_id), sink_path=publish_to)


def compact(spark: SparkSession, sink: str) -> int:
    """Writes every chat's latest version as one new generation and returns its number; older ones are then
    read no more and may be removed.  Not while the job runs: its batches would count as older."""
    gen, base = _next_gen(spark, sink), sink.rstrip("/")
    current_rows(spark, sink).write.mode("overwrite").parquet(f"{base}/rows/gen={gen}/batch_id=0")
    (_versions(spark, sink, "heads").select("chat_id").distinct()
     .write.mode("overwrite").parquet(f"{base}/heads/gen={gen}/batch_id=0"))
    return gen
