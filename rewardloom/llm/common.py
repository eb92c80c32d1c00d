"""Small helpers shared by the corpus operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from rewardloom.session import materialize, scratch_path, ship

WORD = r"[^\x20\x09-\x0D]+"      # a word: a run without the six ASCII white space characters

__all__ = ["WORD", "bounded_sample", "column_or_null", "components", "crc_of_id", "documents", "labelled_rows", "materialize", "sampled_texts", "free_name", "materialize_by",
           "row_hash", "row_marks", "rows_of", "salted_join", "ship", "table"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents")


def crc_of_id(col: str = "doc_id") -> Column:
    """crc32 of the id written as text; a null id counts as the empty text."""
    return F.crc32(F.coalesce(F.col(col).cast("string"), F.lit("")).cast("binary"))


def row_hash(df: DataFrame) -> Column:
    """A 64-bit hash of a row's every column; nulls take their place, so equal rows hash alike."""
    return F.xxhash64(*[F.col(f"`{c}`") for c in df.columns],
                      F.concat(*[F.col(f"`{c}`").isNull().cast("string") for c in df.columns]))


def column_or_null(df: DataFrame, name: str, kind: str) -> Column:
    return F.col(name).cast(kind) if name in df.columns else F.lit(None).cast(kind)


def materialize_by(df: DataFrame, name: str, column: str) -> DataFrame:
    """``materialize`` with a folder for each value of a column of few values, so a reader of one skips the rest."""
    path = scratch_path(df.sparkSession, name)
    df.write.partitionBy(column).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def labelled_rows(docs: DataFrame, marked: DataFrame) -> DataFrame:
    """(doc_id, h, label) of the distinct texts of each labelled id; ``marked``: (doc_id, label), unique on doc_id."""
    light = docs.select(column_or_null(docs, "doc_id", "long").alias("doc_id"), F.xxhash64(F.col("text").cast("string")).alias("h"))
    # both sides are shuffled as read, so the join splits an id that very many rows share
    return light.where("doc_id IS NOT NULL").join(materialize(marked, "labels-once"), "doc_id").distinct()


def bounded_sample(labelled: DataFrame, most: int) -> DataFrame:
    """At most ``most`` rows (doc_id, h, ...), those with the smallest hash of id and text: the bound of a classifier's
    training sample.  A top-k, so each task sends at most ``most`` rows."""
    return labelled.orderBy(F.xxhash64("doc_id", "h"), "doc_id", "h").limit(most)


def sampled_texts(docs: DataFrame, chosen: DataFrame) -> DataFrame:
    """``chosen`` (a bounded sample's rows, so it's sent to every task) with its texts; rows alike in id and text are one."""
    texts = docs.select(column_or_null(docs, "doc_id", "long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    found = texts.withColumn("h", F.xxhash64("text")).join(F.broadcast(chosen), ["doc_id", "h"])
    return found.dropDuplicates(["doc_id", "h"]).drop("h")


def salted_join(big: DataFrame, small: DataFrame, key: str | list[str], how: str = "inner", sizes: DataFrame | None = None,
                spread: Column | None = None, share: float = 0.001, most: int = 4096) -> DataFrame:
    """``big`` with the one row of ``small`` (unique on ``key``) for its key.  Only hot keys are salted, those with over
    ``share`` of the rows and over ``most``, so at most 1 / ``share`` keys: their rows of ``big`` are dealt over as many salts as there
    are such portions, and their row of ``small`` is repeated once a salt.

    ``sizes``: (key, rows) if known, or bounds from above; else ``big`` is counted.  ``spread``: what deals the rows, by default a hash of the row,
    which leaves equal rows together; monotonically_increasing_id() deals those too where ``big`` is read from files."""
    keys = [key] if isinstance(key, str) else key
    if sizes is None:
        sizes = materialize(big.groupBy(*keys).agg(F.count(F.lit(1)).alias("rows")), "join-sizes")
    total, top = sizes.agg(F.sum("rows"), F.max("rows")).first()
    bound = max((total or 0) * share, most)
    if (top or 0) <= bound:
        return big.join(small, keys, how)
    hot = sizes.where(F.col("rows") > bound).select(*keys, F.ceil(F.col("rows") / F.lit(bound)).cast("int").alias("__salts"))
    hot, dealt = F.broadcast(materialize(hot, "join-hot")), F.xxhash64(*[F.col(f"`{c}`") for c in big.columns]) if spread is None else spread
    b = (big.withColumn("__at", dealt).join(hot, keys, "left")
            .withColumn("__salt", F.coalesce(F.pmod("__at", "__salts"), F.lit(0)).cast("int")).drop("__at", "__salts"))
    s = (small.join(hot, keys, "left").withColumn("__salt", F.explode(F.sequence(F.lit(0), F.coalesce("__salts", F.lit(1)) - 1))).drop("__salts"))
    return b.join(s, [*keys, "__salt"], how).drop("__salt")


def free_name(df: DataFrame, name: str) -> str:
    """``name``, longer by as many underscores as it takes to be none of the columns'."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def row_marks(df: DataFrame) -> tuple[list[str], DataFrame]:
    """``df`` with two more columns that together tell different rows apart, under free names: the row's hash, and its id (the hash
    covers a missing id)."""
    names = [free_name(df, "__row_hash"), free_name(df, "__row_id")]
    mark = F.coalesce(column_or_null(df, "doc_id", "long"), F.lit(0))
    return names, df.select(*[F.col(f"`{c}`") for c in df.columns], row_hash(df).alias(names[0]), mark.alias(names[1]))


def rows_of(df: DataFrame, chosen: DataFrame, once: bool = False) -> DataFrame:
    """The rows of ``df`` whose (doc_id, h) ``chosen`` holds; with ``once``, one of several equal rows."""
    names, marked = row_marks(df)
    wanted = chosen.select(F.col("h").alias(names[0]), F.coalesce("doc_id", F.lit(0)).alias(names[1])).distinct()
    if once:      # equal rows meet in their own tasks before the shuffle
        marked = marked.dropDuplicates(names)
    return marked.join(wanted, names, "left_semi").select(*[F.col(f"`{c}`") for c in df.columns])


def components(edges: DataFrame, name: str = "components") -> DataFrame:
    """(a, b) links -> (node, root): root is the same for all nodes that links connect.  Each round every node
    points to its least neighbour, if less than itself, and links move to where their ends point; nodes that
    nothing links any more are roots.  Rounds are about the logarithm of the longest chain."""
    edges = materialize(edges.where("a <> b").distinct(), name)
    found = materialize(edges.select(F.col("a").alias("node")).union(edges.select("b")).distinct()
                        .select("node", F.col("node").alias("at")), name)
    while not edges.isEmpty():
        both = edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        to = materialize(both.groupBy("a").agg(F.min("b").alias("least"), F.count(F.lit(1)).alias("rows"))
                         .select("a", F.least("a", "least").alias("to"), "rows"), name)
        sizes, to = to.select("a", "rows"), to.select("a", "to")      # ``both`` holds a node at least as often as ``edges`` does
        found = materialize(salted_join(found.withColumnRenamed("at", "a"), to, "a", how="left")
                            .select("node", F.coalesce("to", "a").alias("at")), name)
        moved = salted_join(edges, to, "a", sizes=sizes).select(F.col("to").alias("x"), F.col("b").alias("a"))
        edges = materialize(salted_join(moved, to, "a", sizes=sizes).select(F.col("x").alias("a"), F.col("to").alias("b"))
                            .where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), name)
    return found.select("node", F.col("at").alias("root"))
