"""Consecutive row numbers in a global order, without a single-partition window.

Range-partition on the order, sort inside each range, and write the rows once with their partition and place
in it; then add the count of all earlier partitions.  The offsets table has one row per partition: its size is
bounded by the partition count, not by the data, so it is safe to broadcast.

Range bounds come from a random sample that differs from one evaluation to the next, so the partition sizes and
the numbers must come from one evaluation: that is why the numbered rows, not the input, are written.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from rewardloom.session import materialize

_PLACE_BITS = 33      # monotonically_increasing_id: partition in the upper bits, place in it in the lower 33


def sequential_index(df: DataFrame, order_cols: list, name: str = "idx", start: int = 0,
                     num_partitions: int | None = None) -> DataFrame:
    spark = df.sparkSession
    n = num_partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    placed = materialize(df.repartitionByRange(n, *order_cols).sortWithinPartitions(*order_cols)
                           .withColumn("_at", F.monotonically_increasing_id()), "index-rows")
    pid = F.shiftright("_at", _PLACE_BITS)
    local = F.col("_at").bitwiseAND(F.lit((1 << _PLACE_BITS) - 1))
    sizes = placed.groupBy(pid.alias("_pid")).agg(F.count(F.lit(1)).alias("_n"))
    # single-partition window over one row per range partition (≤ n rows)
    before = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("_pid", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_off"))
    out = placed.withColumn("_pid", pid).join(F.broadcast(offsets), "_pid")
    return out.withColumn(name, F.col("_off") + local + F.lit(start)).drop("_pid", "_at", "_off")
