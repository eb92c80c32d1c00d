"""Joins against a one-row-per-key table when the other side has hot keys.

AQE splits skewed sort-merge joins only when both sides arrive straight from
a shuffle; a side that is an aggregate already partitioned by the key (a
champion per prompt, the reward table) does not qualify.  This join splits
hot keys explicitly:

1. hot keys = keys holding more than ``hot_share`` of the big side's rows;
   there are at most ``1 / hot_share`` of them (a proven bound), so the list
   is broadcast, each with its own number of salts: its rows over
   ``hot_share`` of all rows, rounded up.  A salt thus never holds much more than a
   key just under the bound, however large the hottest key is;
2. a hot key's rows on the big side get a salt from a hash of the whole row
   (deterministic: a retried task salts the same way); rows without a key match
   nothing and are spread by the same hash;
3. a hot key's single row on the small side is repeated once per salt
   (at most 2 / hot_share extra rows in all).

The join on (key, salt) returns exactly the rows of the plain join.
Identical copies of a whole row hash alike; pre-aggregate exact copies if
they can be a hot group.  Counting reads the big side's key once more; pass
``keys`` (a frame of the same keys, such as a staged projection) where the key
is dear to compute.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

NULL_SALTS = 1 << 20


def skew_safe_join(big: DataFrame, small: DataFrame, key: str, how: str = "inner",
                   hot_share: float = 0.001, keys: DataFrame | None = None) -> DataFrame:
    if how not in ("inner", "left"):
        raise ValueError("skew_safe_join supports inner and left joins (big side kept)")
    counts = (big if keys is None else keys).where(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("_n"))
    total = counts.select(F.sum("_n")).scalar()
    hot = (counts.where(F.col("_n") > total * F.lit(hot_share))
                 .select(key, F.ceil(F.col("_n") / (total * F.lit(hot_share))).cast("int").alias("_salts")))
    hot = F.broadcast(hot)      # at most 1 / hot_share rows
    row_hash = F.xxhash64(*[F.col(f"`{c}`") for c in big.columns])
    salt = (F.when(F.col(key).isNull(), F.pmod(row_hash, F.lit(NULL_SALTS)))
             .when(F.col("_salts").isNotNull(), F.pmod(row_hash, F.col("_salts"))).otherwise(F.lit(0)))
    b = big.join(hot, key, "left").withColumn("_salt", salt.cast("int")).drop("_salts")
    s = (small.join(hot, key, "left")
              .withColumn("_salt", F.explode(F.sequence(F.lit(0), F.coalesce("_salts", F.lit(1)) - 1)))
              .drop("_salts"))
    return b.join(s, [key, "_salt"], how).drop("_salt")
