"""Chat and user table adapters with a fixed schema.

``fmt`` is ``parquet``, ``json`` (JSON lines with the CHAT/USER schema),
``delta``/``orc``/any file format Spark knows, or ``jdbc``.  For JDBC the read
is split into ``num_partitions`` range slices of an integer ``id`` when
``id_bounds`` is given (one index range each; ids outside the bounds and NULL
ids come with the first and last slice), or into slices between the sorted
``id_splits`` of any comparable type plus one for NULL ids.  ``num_slices`` finds
even splits itself from one pass over the id column (``even_splits``).  Without any it
is one slice, which still loses no row.  Slices of text ids compare in code point order;
where the database's own order differs, ``id_column`` names the column so that it doesn't
(such as ``id COLLATE "C"``), or slices would overlap.

Ids keep the type that the source has (text or integer).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from rewardloom import schema as S


def _conform(df: DataFrame, struct) -> DataFrame:
    cols = []
    for f in struct.fields:
        if f.name in df.columns and f.name in S.ID_COLUMNS:
            found = df.schema[f.name].dataType
            kept = "bigint" if isinstance(found, (T.ByteType, T.ShortType, T.IntegerType)) else found
            cols.append(F.col(f.name).cast(kept).alias(f.name))
        elif f.name in df.columns:
            cols.append(F.col(f.name).cast(f.dataType).alias(f.name))
        elif f.name in S.OPTIONAL_COLUMNS:
            cols.append(F.lit(None).cast(f.dataType).alias(f.name))
        else:
            raise ValueError(f"source lacks required column {f.name}")
    return df.select(cols)


def split_predicates(splits: list, column: str = "id") -> list[str]:
    """Predicates that put every row in exactly one slice: below the first
    split, between neighbours, from the last on, and NULL."""
    def lit(v):
        return str(v) if isinstance(v, (int, float)) else "'" + str(v).replace("'", "''") + "'"

    cut = [lit(v) for v in sorted(set(splits))]
    if not cut:
        return ["1 = 1"]
    return ([f"{column} < {cut[0]}"] + [f"{column} >= {a} AND {column} < {b}" for a, b in zip(cut, cut[1:])]
            + [f"{column} >= {cut[-1]}", f"{column} IS NULL"])


def even_splits(ids: DataFrame, slices: int, column: str = "id", a_slice: int = 256, seed: int = 1) -> list:
    """At most ``slices`` - 1 values that cut the rows into slices of nearly equal size, however the ids lie.

    They are the quantiles of a uniform sample of ``a_slice`` rows a slice.  The sample is those rows with the smallest random number:
    samples of parts merge into the sample of the whole, so every task sends at most that many rows, and the driver holds
    no more.  A slice's size then scatters by about 1 / sqrt(a_slice) of the mean.  Rows of one id stay in one slice."""
    most = slices * a_slice
    some = ids.where(F.col(column).isNotNull()).select(F.col(column).alias("id"), F.rand(seed).alias("r")).orderBy("r").limit(most)
    got = sorted(r["id"] for r in some.select("id").collect())
    return sorted({got[i * len(got) // slices] for i in range(1, slices)}) if got else []


def read_table(spark: SparkSession, path: str, fmt: str = "parquet", struct=None,
               jdbc_table: str | None = None, jdbc_props: dict | None = None,
               num_partitions: int = 64, id_bounds: tuple[int, int] | None = None,
               id_splits: list | None = None, num_slices: int | None = None, id_column: str = "id") -> DataFrame:
    if fmt == "jdbc":
        props = dict(jdbc_props or {})
        url = props.pop("url", path)
        if num_slices and id_bounds is None and not id_splits:
            id_splits = even_splits(spark.read.jdbc(url, f"(SELECT id FROM {jdbc_table}) ids", properties=props), num_slices)
        if id_bounds is not None:
            # index-friendly range slices of the primary key
            df = spark.read.jdbc(url, jdbc_table, column="id", lowerBound=int(id_bounds[0]),
                                 upperBound=int(id_bounds[1]), numPartitions=num_partitions,
                                 properties=props)
        else:
            df = spark.read.jdbc(url, jdbc_table, predicates=split_predicates(id_splits or [], id_column), properties=props)
    elif fmt == "json" and struct is not None:
        df = spark.read.schema(struct).json(path)
    else:
        df = spark.read.format(fmt).load(path)
    return _conform(df, struct) if struct is not None else df


def read_chat(spark: SparkSession, path: str, fmt: str = "parquet", **kw) -> DataFrame:
    """The chat table: ``id, user_id`` (text or integer, as found), ``chat
    STRING`` (JSON) and the optional ``updated_at BIGINT`` (epoch seconds of
    the last change)."""
    return read_table(spark, path, fmt, S.CHAT, jdbc_table=kw.pop("jdbc_table", "chat"), **kw)


def read_users(spark: SparkSession, path: str, fmt: str = "parquet", **kw) -> DataFrame:
    """The user table: ``id`` (type of ``chat.user_id``), ``email STRING``."""
    return read_table(spark, path, fmt, S.USER, jdbc_table=kw.pop("jdbc_table", '"user"'), **kw)


def read_sources(spark: SparkSession, chat_path: str, user_path: str, fmt: str = "parquet",
                 **kw) -> tuple[DataFrame, DataFrame]:
    """The (chat, user) pair with fixed schemas, from one format."""
    return read_chat(spark, chat_path, fmt, **kw), read_users(spark, user_path, fmt, **kw)
