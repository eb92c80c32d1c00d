"""Input tables of the registered queries, derived by Spark from ``sf_dir``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from rewardloom.session import file_state, staged_path

from rewardloom.functions.order import seq_col
from rewardloom.sources import fixtures as fx


STAGE_VERSION = "v4"


def _fingerprint(spark: SparkSession, sf_dir: str, *tables: str) -> str:
    base = sf_dir.rstrip("/")
    return "|".join([STAGE_VERSION, base, *(f"{t}:{file_state(spark, f'{base}/{t}.parquet')}" for t in tables)])


def chat_path(spark: SparkSession, sf_dir: str) -> str:
    """The chat table as the source system holds it (JSON text per chat),
    derived from ``conversations`` once per input and written to the shared
    folder; queries scan (or stream) it like a source."""
    return staged_path(spark, "chat", _fingerprint(spark, sf_dir, "conversations"),
                       lambda: fx.chat_table(spark, sf_dir))


def chat_and_users(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    from rewardloom.sources.tables import read_chat
    return read_chat(spark, chat_path(spark, sf_dir)), fx.user_table(spark, sf_dir)


def _staged(spark: SparkSession, sf_dir: str, name: str, build, *tables: str) -> DataFrame:
    return spark.read.parquet(staged_path(spark, name, _fingerprint(spark, sf_dir, *tables), build))


def rated_base(spark: SparkSession, sf_dir: str) -> DataFrame:
    """fx_rated (documents joined with labels), staged once per input."""
    return _staged(spark, sf_dir, "rated", lambda: fx.rated_table(spark, sf_dir),
                   "documents", "labels")


def rated(spark: SparkSession, sf_dir: str, dup: bool = False) -> DataFrame:
    """fx_rated(_dup) with its source-order column (doc_id plays chat_id)."""
    base = rated_base(spark, sf_dir)
    df = fx.with_duplicates(base) if dup else base
    return df.withColumn("seq", seq_col("epoch", "doc_id", F.lit(0)))


def responses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fx.responses_from(rated_base(spark, sf_dir))


def prompts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The prompt corpus: every document text plus one blank, read where it lies."""
    return fx.prompt_table(spark, sf_dir)


def epoch_of(col: str, name: str | None = None):
    """Comparable rendering of a timestamp: epoch seconds as DOUBLE, so a
    NULL-bearing column has one type on both engines and in pandas."""
    return F.unix_seconds(col).cast("double").alias(name or f"{col}_epoch")
