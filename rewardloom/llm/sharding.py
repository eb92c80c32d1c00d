"""Sharding by a two-pass external shuffle.

Pass one scatters the records over memory-sized buckets: a record's bucket is a seeded hash of its every column.
Pass two takes one bucket at a time into memory, Fisher-Yates shuffles it and writes it.  The buckets in a row are one
random order of all records; it is cut into ``shards`` runs whose row counts are at most one apart (law ``rows``).

Where a bucket begins in that order must be known before it is written, so that records are written once, in their
place: a first look at the table keeps two hashes, the number of copies and the bytes of each distinct record, and bucket
sizes follow from these.  Bytes set the number of buckets, ``bucket_bytes`` each on average.

Copies of one record hash alike.  Where they fill more than an eighth of a bucket, they are counted first (partial
counts before the shuffle) and dealt out again, each copy with a number that the hash takes in; they are
made in many tasks, some thousand each.  There are at most eight such records a bucket, so their hashes are broadcast.

Written: Parquet, a folder ``shard=…`` each, columns slot and record (a struct of the table's columns, whatever their
names), rows by ascending slot.  Hashes, counts and the generator's seeds depend on the records alone, so a lost task is
redone alike and equal seeds give equal shards.

Defined cases: nulls hash as nulls; a null or empty text is a record like others; repeated rows are each written once;
an empty table writes no file and reads back empty; fewer rows than shards leave shards empty.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from rewardloom.llm.common import materialize
from rewardloom.session import scratch_path

COPIES_A_TASK = 4096


def _column(name: str) -> Column:
    return F.col("`" + name.replace("`", "``") + "`")


def _flat(field: T.StructField) -> Column:
    """A column's value as something that hashes and has a length: nested values as text."""
    nested = isinstance(field.dataType, (T.ArrayType, T.MapType, T.StructType))
    return _column(field.name).cast("string") if nested else _column(field.name)


def marked(rows: DataFrame, seed: int) -> DataFrame:
    """(h1, h2, bytes, record): two seeded hashes of every column, and about what the record takes in memory."""
    flat = [(_flat(f), f.dataType) for f in rows.schema]
    nulls = F.concat(F.lit(""), *[c.isNull().cast("string") for c, _ in flat])
    sizes = [F.lit(8) if isinstance(k, (T.NumericType, T.BooleanType, T.DateType, T.TimestampType))
             else F.coalesce(F.octet_length(c), F.lit(0)) + 8 for c, k in flat]
    hashes = [F.xxhash64(F.lit(seed), F.lit(i), nulls, *[c for c, _ in flat]).alias(f"h{i}") for i in (1, 2)]
    return rows.select(*hashes, sum(sizes, F.lit(16)).cast("long").alias("bytes"), F.struct(*[_column(c) for c in rows.columns]).alias("record"))


def _copies(groups: DataFrame) -> DataFrame:
    """A row (with ``copy`` from 0) for each of a group's ``n`` copies, made in many tasks."""
    last = F.floor((F.col("n") - 1) / COPIES_A_TASK).cast("long")
    some = groups.withColumn("some", F.explode(F.sequence(F.lit(0).cast("long"), last))).repartition("h1", "h2", "some")
    begin = F.col("some") * COPIES_A_TASK
    return some.withColumn("copy", F.explode(F.sequence(begin, F.least(begin + COPIES_A_TASK, F.col("n")) - 1))).drop("some")


def _bucket(buckets: int, copy: Column) -> Column:
    return F.pmod(F.xxhash64("h1", "h2", copy), F.lit(buckets)).cast("long")


def scattered(rows: DataFrame, seed: int, bucket_bytes: int) -> tuple[DataFrame | None, int, int]:
    """Pass one: (bucket, start, h1, h2, record) with the place where the bucket begins, the numbers of buckets and of rows."""
    all_rows, none = marked(rows, seed), F.lit(0).cast("long")
    groups = materialize(all_rows.groupBy("h1", "h2").agg(F.count(F.lit(1)).alias("n"), F.max("bytes").alias("bytes")), "shuffle-groups")
    total = groups.agg(F.sum("n").alias("n"), F.sum(F.col("n") * F.col("bytes")).alias("bytes")).first()
    if not total["n"]:
        return None, 0, 0
    buckets = max(1, -(-total["bytes"] // bucket_bytes))
    many = (F.col("n") > 1) & (F.col("n") * F.col("bytes") > bucket_bytes // 8)
    hot = groups.where(many).select("h1", "h2", "n")
    any_hot = not hot.isEmpty()
    counted = groups.where(~many).groupBy(_bucket(buckets, none).alias("bucket")).agg(F.sum("n").alias("rows"))
    if any_hot:
        dealt = _copies(hot).groupBy(_bucket(buckets, F.col("copy")).alias("bucket")).agg(F.count(F.lit(1)).alias("rows"))
        counted = counted.unionByName(dealt).groupBy("bucket").agg(F.sum("rows").alias("rows"))
    before = Window.orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)       # one row a bucket
    starts = materialize(counted.select("bucket", F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("start")), "shuffle-buckets")
    few = all_rows
    if any_hot:
        keys = F.broadcast(hot.select("h1", "h2"))         # at most eight a bucket
        few = all_rows.join(keys, ["h1", "h2"], "left_anti")
    out = few.select(_bucket(buckets, none).alias("bucket"), "h1", "h2", "record")
    if any_hot:
        again = (all_rows.join(keys, ["h1", "h2"], "left_semi").groupBy("h1", "h2")
                 .agg(F.first("record").alias("record"), F.count(F.lit(1)).alias("n")))
        out = out.unionByName(_copies(again).select(_bucket(buckets, F.col("copy")).alias("bucket"), "h1", "h2", "record"))
    # a bucket's row is 16 bytes for ``bucket_bytes`` of records
    return out.join(F.broadcast(starts), "bucket"), int(buckets), int(total["n"])


def _by_bucket(batches):
    """The rows of each bucket, one bucket at a time, from Arrow batches in which buckets follow each other."""
    held, now = [], None
    for batch in batches:
        bucket = batch.column("bucket").to_numpy()
        cuts = [0, *(np.flatnonzero(bucket[1:] != bucket[:-1]) + 1).tolist(), len(bucket)]
        for a, b in zip(cuts, cuts[1:]):
            if a == b:
                continue
            if held and bucket[a] != now:
                yield now, pa.Table.from_batches(held)
                held = []
            now = int(bucket[a])
            held.append(batch.slice(a, b - a))
    if held:
        yield now, pa.Table.from_batches(held)


def write_shards(rows: DataFrame, path: str, shards: int = 40, seed: int = 11, bucket_bytes: int = 32 << 20) -> None:
    """Writes all rows, shuffled, as ``shards`` folders under ``path``."""
    spark = rows.sparkSession
    shape = T.StructType([T.StructField("shard", T.IntegerType()), T.StructField("slot", T.LongType()), T.StructField("record", rows.schema)])
    dealt, buckets, n = scattered(rows, seed, bucket_bytes)
    if dealt is None:
        spark.createDataFrame([], shape).write.partitionBy("shard").parquet(path)
        return

    def shuffle(batches):
        for bucket, t in _by_bucket(batches):
            order = np.arange(t.num_rows)
            np.random.default_rng([seed, bucket]).shuffle(order)             # Fisher-Yates
            place = t.column("start")[0].as_py() + np.arange(t.num_rows)
            shard = place * shards // n
            slot = place - -(-shard * n // shards)
            out = pa.table({"shard": pa.array(shard, pa.int32()), "slot": pa.array(slot, pa.int64()), "record": t.column("record").take(order)})
            yield from out.to_batches(max_chunksize=4096)

    tasks = min(buckets, int(spark.conf.get("spark.sql.shuffle.partitions")))
    task = F.floor(F.col("bucket") * F.lit(tasks) / F.lit(buckets)).cast("int")      # neighbouring buckets, so few shards a task
    (dealt.repartitionById(tasks, task).sortWithinPartitions("bucket", "h1", "h2").select("bucket", "start", "record")
          .mapInArrow(shuffle, shape).sortWithinPartitions("shard", "slot")
          .write.partitionBy("shard").parquet(path))


def read_shards(spark, path: str, schema: T.StructType) -> DataFrame:
    """(shard, slot, record) of what ``write_shards`` wrote for a table of that schema."""
    shape = T.StructType([T.StructField("slot", T.LongType()), T.StructField("record", schema), T.StructField("shard", T.IntegerType())])
    return spark.read.schema(shape).parquet(path).select("shard", "slot", "record")


def shard_and_read(docs: DataFrame, shards: int = 40, seed: int = 11, bucket_bytes: int = 32 << 20) -> DataFrame:
    """Per row of the written shards: doc_id, size, text_crc32, law, shard, slot, grown_shard."""
    spark = docs.sparkSession
    path = scratch_path(spark, "shards")
    write_shards(docs, path, shards, seed, bucket_bytes)
    text = F.coalesce(F.col("record.text"), F.lit(""))
    return read_shards(spark, path, docs.schema).select(
        F.col("record.doc_id").alias("doc_id"), (F.octet_length(text) + 16).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"), F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))
