"""Feedback cleaning, with pandas ``to_numeric`` / ``str.strip``
semantics expressed as built-in column expressions."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F, types as T

from rewardloom.functions.text import coerce_numeric, ustrip

TEXT_COLUMNS = ("question", "answer")


def coerce_rating(df: DataFrame, col: str = "rating") -> DataFrame:
    """Rating text -> DOUBLE; unparsable -> NULL (replaces the column)."""
    return df.withColumn(col, coerce_numeric(F.col(col)))


def drop_missing(df: DataFrame, subset=("rating",) + TEXT_COLUMNS) -> DataFrame:
    """Drop rows with NULL (or NaN) in any of ``subset``."""
    return df.dropna(subset=list(subset))


def strip_blank(df: DataFrame, cols=TEXT_COLUMNS) -> DataFrame:
    """Drop rows whose text is empty after a Unicode strip, then strip.
    NULL text is kept (as in pandas, where NaN != '' is true)."""
    for c in cols:
        df = df.where(F.coalesce(ustrip(F.col(c)) != F.lit(""), F.lit(True)))
    return df.select(*[ustrip(F.col(c)).alias(c) if c in cols else F.col(c) for c in df.columns])


def keep_after_cleaning():
    """The row predicate of C1–C3 as one boolean column (used by the gates,
    which count cleaned rows without materialising them)."""
    ok = coerce_numeric(F.col("rating")).isNotNull()
    for c in TEXT_COLUMNS:
        ok = ok & F.col(c).isNotNull() & (ustrip(F.col(c)) != F.lit(""))
    return ok


def clean_feedback(df: DataFrame) -> DataFrame:
    """C1 -> C2 -> C3; every input column is kept, order preserved."""
    return strip_blank(drop_missing(coerce_rating(df)))


def rating_histogram(df: DataFrame) -> DataFrame:
    """C4: distinct ratings with their counts, ascending (one hash aggregate)."""
    return df.groupBy("rating").agg(F.count(F.lit(1)).alias("n")).orderBy("rating")


def rating_mean(df: DataFrame) -> DataFrame:
    """Mean rating (raw double; formatting is the reader's business)."""
    return df.agg(F.avg("rating").alias("mean_rating"), F.count("rating").alias("n"))


def _as_text(c, dtype) -> "F.Column":
    if isinstance(dtype, (T.TimestampType, T.TimestampNTZType)):
        return F.unix_seconds(F.col(c)).cast("string")      # zone-free rendering
    return F.col(c).cast("string")


def feedback_shape(df: DataFrame, order_col: str | None = None,
                   preview_chars: int = 100) -> DataFrame:
    """One row per input column — position, type, non-null count, the
    total row count and (with ``order_col``) the first row's value in that
    order cut to ``preview_chars`` — all from a single aggregation pass."""
    fields = [f for f in df.schema.fields if f.name != order_col]
    aggs = [F.count(F.lit(1)).alias("__rows")]
    aggs += [F.count(F.col(f"`{f.name}`")).alias(f"__nn{i}") for i, f in enumerate(fields)]
    if order_col:
        # values are cut BEFORE the aggregate: each partition's partial result
        # then carries at most preview_chars per column into the final task
        first = F.struct(*[F.left(_as_text(f"`{f.name}`", f.dataType), F.lit(preview_chars)).alias(f"v{i}")
                           for i, f in enumerate(fields)])
        aggs.append(F.min_by(first, order_col).alias("__first"))
    counts = df.agg(*aggs)
    rows = F.array(*[F.struct(F.lit(f.name).alias("column_name"),
                              F.lit(i).alias("position"),
                              F.lit(f.dataType.simpleString()).alias("data_type"),
                              F.col(f"__nn{i}").alias("non_null"),
                              F.col("__rows").alias("n_rows"),
                              (F.col(f"__first.v{i}") if order_col
                               else F.lit(None).cast("string")).alias("first_value"))
                     for i, f in enumerate(fields)])
    return counts.select(F.inline(rows))
