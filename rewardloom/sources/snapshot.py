"""S3: sample snapshots partitioned by run id, in the cluster-shared folder.

Writes go through Spark's output committer (all-or-nothing per job), so a
lost executor means a retried task, never a half-written run partition.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F


def write_snapshot(samples: DataFrame, path: str, run_id: str) -> str:
    (samples.withColumn("run_id", F.lit(run_id))
            .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
            .partitionBy("run_id").parquet(path))
    return path


def read_snapshot(spark: SparkSession, path: str, run_id: str | None = None) -> DataFrame:
    df = spark.read.parquet(path)
    return df.where(F.col("run_id") == run_id) if run_id is not None else df


def card_path(path: str) -> str:
    return path.rstrip("/") + "-cards"


def write_card(card: DataFrame, path: str, run_id: str) -> None:
    """The run's one-row card, in a folder of cards next to the snapshot's."""
    write_snapshot(card.drop("run_id"), card_path(path), run_id)


def read_cards(spark: SparkSession, path: str, run_id: str | None = None) -> DataFrame:
    return read_snapshot(spark, card_path(path), run_id)
