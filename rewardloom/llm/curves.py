"""Nearest vectors by inner product along shifted Hilbert curves.

Vectors get one coordinate more, sqrt(M^2 - |x|^2) with M the largest norm; then the nearest to a query
(scaled to M, that coordinate 0) are those of the largest inner product.  Each of ``curves`` orderings projects
on ``dims`` random orthonormal directions, shifts the grid at random and sorts by the Hilbert key of the grid
cell.  Spark range-partitions all orderings at once and numbers the places.  A query's window in an ordering
is the ``reach`` places either side; the rows of an ordering are cut into blocks of ``block`` places, a query goes to all
blocks that its window touches, and each block reranks its window by exact inner product in double precision.
A query's lists from all blocks merge into its nearest.

``reach`` follows the data: for at most ``sample`` queries the true nearest are found by brute force, and the
reach is the ``recall`` quantile of the places between a query and a true neighbour in the ordering where they
are closest.  So the share of pairs that is looked at grows where vectors have no structure to use.

Equal vectors are searched as one; each keeps its k + 1 smallest ids, which is all that a result can hold.

Defined cases: vectors null, zero, or with null or non-finite components take no part, nor do those whose
length is not the most frequent one (the shorter, if two are); a null id takes no part; repeated rows are rows of their own,
with equal ids both; an empty table gives no rows; other columns aren't read.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from rewardloom.llm.common import materialize
from rewardloom.llm.ngram_join import _groups
from rewardloom.operators.indexing import sequential_index
from rewardloom.operators.skew import skew_safe_join


def hilbert_keys(cells: np.ndarray, bits: int) -> np.ndarray:
    """Place on the Hilbert curve of each row of (n, dims) grid cells: Gray-code rotations, all rows at once."""
    x = cells.astype(np.int64).T.copy()
    q = 1 << (bits - 1)
    while q > 1:
        for i in range(len(x)):
            turned = (x[i] & q) != 0
            swap = np.where(turned, 0, (x[0] ^ x[i]) & (q - 1))
            x[0] = np.where(turned, x[0] ^ (q - 1), x[0]) ^ swap
            x[i] ^= swap
        q >>= 1
    for i in range(1, len(x)):
        x[i] ^= x[i - 1]
    t = np.zeros(x.shape[1], np.int64)
    q = 1 << (bits - 1)
    while q > 1:
        t = np.where((x[-1] & q) != 0, t ^ (q - 1), t)
        q >>= 1
    x ^= t
    key = np.zeros(x.shape[1], np.int64)
    for bit in range(bits - 1, -1, -1):
        for row in x:
            key = (key << 1) | ((row >> bit) & 1)
    return key


class Curves:
    """The orderings: directions, shifts and the grid's scale, from a bounded sample of vectors."""

    def __init__(self, sample: np.ndarray, largest: float, curves: int, dims: int, seed: int):
        rng, wide = np.random.default_rng(seed), sample.shape[1] + 1
        self.largest, self.dims = largest, min(dims, wide)
        self.bits = min(10, 60 // self.dims)
        lifted = self.lift(sample)
        self.mean = lifted.mean(axis=0)
        self.on = [np.linalg.qr(rng.normal(size=(wide, wide)))[0][:, :self.dims] for _ in range(curves)]
        self.shift = rng.random((curves, self.dims))
        self.scale = [np.maximum(((lifted - self.mean) @ p).std(axis=0), 1e-12) for p in self.on]

    def lift(self, x: np.ndarray) -> np.ndarray:
        return np.hstack([x, np.sqrt(np.maximum(self.largest**2 - (x * x).sum(axis=1, keepdims=True), 0))])

    def aim(self, q: np.ndarray) -> np.ndarray:
        return np.hstack([q * (self.largest / np.linalg.norm(q, axis=1, keepdims=True)), np.zeros((len(q), 1))])

    def keys(self, points: np.ndarray) -> np.ndarray:
        """(n, curves) keys."""
        side, out = 1 << self.bits, []
        for on, shift, scale in zip(self.on, self.shift, self.scale):
            z = ((points - self.mean) @ on) / (7 * scale) + 0.5        # 3.5 deviations either side
            out.append(hilbert_keys(np.clip((z + shift) / 2 * side, 0, side - 1), self.bits))
        return np.stack(out, axis=1)


def _vectors(column) -> np.ndarray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), -1)


def _best(query: np.ndarray, score: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Of one query's candidates: places of the k of the largest score, ties to the smaller id."""
    if len(score) > 4 * k:
        least = np.partition(score, len(score) - k)[len(score) - k]
        near = np.flatnonzero(score >= least)
    else:
        near = np.arange(len(score))
    return near[np.lexsort([ids[near], -score[near]])][:k]


_LISTS = pa.schema([("query", pa.int64()), ("ids", pa.list_(pa.int64())), ("scores", pa.list_(pa.float64()))])


def _lists(found: list) -> pa.RecordBatch:
    q, ids, scores = zip(*found) if found else ((), (), ())
    return pa.RecordBatch.from_arrays([pa.array(q, pa.int64()), pa.array(ids, _LISTS.field("ids").type),
                                       pa.array(scores, _LISTS.field("scores").type)], schema=_LISTS)


def _merge(pdf: pd.DataFrame, k: int) -> pd.DataFrame:
    ids, scores = np.concatenate(pdf["ids"].to_list()), np.concatenate(pdf["scores"].to_list())
    ids, first = np.unique(ids, return_index=True)
    best = _best(ids, scores[first], ids, k)
    return pd.DataFrame({"query": [pdf["query"].iloc[0]], "ids": [ids[best].tolist()], "scores": [scores[first][best].tolist()]})


def usable(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """(vec_id, v) of the rows that take part."""
    fits = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists("v", lambda x: x != 0)
    rows = (vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).cast("array<double>").alias("v"))
            .where(F.col("vec_id").isNotNull() & F.col("v").isNotNull() & fits))
    length = rows.groupBy(F.size("v").alias("s")).count().orderBy(F.desc("count"), "s").first()
    return rows.where(F.size("v") == (length["s"] if length else 0))


def nearest(vectors: DataFrame, k: int = 20, every: int = 20, id_col: str = "vec_id", vector_col: str = "embedding",
            curves: int = 16, dims: int = 8, recall: float = 0.95, sample: int = 256, block: int = 2048,
            seed: int = 9) -> DataFrame:
    """Rows (query_id, rank, vec_id, score): of each row whose id is divisible by ``every``, the ``k`` nearest others."""
    spark = vectors.sparkSession
    shape = "query_id long, rank int, vec_id long, score double"
    rows = usable(vectors, id_col, vector_col)
    # equal vectors are one class with its k + 1 smallest ids; the row limit is applied before the shuffle too.  A class is
    # known by 128 bits of hash of its vector, and numbered by its smallest id, so that ties between classes go by that
    rows = rows.withColumn("h", F.struct(F.xxhash64("v").alias("a"), F.xxhash64(F.lit(1), "v").alias("b")))
    place = F.row_number().over(Window.partitionBy("h").orderBy("vec_id"))
    kept = rows.withColumn("place", place).where(F.col("place") <= k + 1)
    classes = kept.groupBy("h").agg(F.first("v").alias("v"), F.sort_array(F.collect_list("vec_id")).alias("members"))
    classes = materialize(sequential_index(classes.withColumn("least", F.get("members", F.lit(0))), ["least", "h"], "cls")
                          .select("cls", "h", "v", "members"), "curve-classes")
    asking = materialize(skew_safe_join(rows.where(F.col("vec_id") % every == 0).select("h", F.col("vec_id").alias("query_id")),
                                        classes.select("h", "cls"), "h").select("query_id", "cls"), "curve-queries")
    queries = materialize(classes.select("cls", "v").join(asking.select("cls").distinct(), "cls", "left_semi"), "curve-asked")
    norm = F.sqrt(F.aggregate("v", F.lit(0.0), lambda s, x: s + x * x))
    largest = classes.agg(F.max(norm)).first()[0]
    if largest is None or queries.isEmpty():
        return spark.createDataFrame([], shape)
    some = classes.select("v").orderBy(F.xxhash64("v")).limit(4096).toPandas()["v"]       # at most 4096 vectors
    order = Curves(np.array(some.to_list()), largest, curves, dims, seed)

    def keyed(batches, role):
        for batch in batches:
            if batch.num_rows:
                x = _vectors(batch.column("v"))
                key = order.keys(order.aim(x) if role else order.lift(x))
                n = len(key)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.tile(np.arange(curves, dtype=np.int32), n)), pa.array(key.ravel()),
                     pa.array(np.full(n * curves, role, np.int32)), pa.array(np.repeat(batch.column("cls").to_numpy(), curves))],
                    names=["curve", "key", "role", "cls"])

    kind = "curve int, key long, role int, cls long"
    laid = (classes.select("cls", "v").mapInArrow(lambda b: keyed(b, 0), kind)
            .unionByName(queries.mapInArrow(lambda b: keyed(b, 1), kind)))
    at = materialize(sequential_index(laid, ["curve", "key", "cls", "role"], "at").select("curve", "role", "cls", "at"), "curve-order")
    width = at.agg(F.max("at")).first()[0] + 1
    width //= curves                          # every curve orders the same rows
    at = at.withColumn("at", F.col("at") - F.col("curve") * F.lit(width))
    reach = _reach(classes, queries, at, k, recall, sample)

    # a window may hold many queries: they are dealt into chunks, a group being a block and a chunk
    chunks = max(1, -(-(block + 2 * reach) // (every * 4096)))
    data = (at.where("role = 0").join(classes.select("cls", "v"), "cls")
            .select("curve", F.floor(F.col("at") / block).cast("long").alias("part"), F.explode(F.sequence(F.lit(0), F.lit(chunks - 1))).alias("chunk"),
                    F.lit(0).alias("role"), "cls", "at", "v"))
    to = F.explode(F.sequence(F.floor(F.greatest(F.col("at") - reach, F.lit(0)) / block).cast("long"),
                              F.floor(F.least(F.col("at") + reach, F.lit(width - 1)) / block).cast("long")))
    ask = (at.where("role = 1").join(queries, "cls")
           .select("curve", to.alias("part"), F.pmod(F.xxhash64("cls"), F.lit(chunks)).cast("int").alias("chunk"), F.lit(1).alias("role"), "cls", "at", "v"))
    together = (data.unionByName(ask).repartition("curve", "part", "chunk").sortWithinPartitions("curve", "part", "chunk", "role"))

    def rerank(batches):
        for t in _groups(batches, ["curve", "part", "chunk"]):
            role, ids, where = t.column("role").to_numpy(), t.column("cls").to_numpy(), t.column("at").to_numpy()
            x = _vectors(t.column("v"))
            d, found = role == 0, []
            if not d.any() or d.all():
                continue
            ids_d, where_d, x_d = ids[d], where[d], x[d]
            by = np.argsort(where_d)
            ids_d, where_d, x_d = ids_d[by], where_d[by], x_d[by]
            ids_q, where_q, x_q = ids[~d], where[~d], x[~d]
            for i in range(0, len(ids_q), 512):
                scores = x_q[i:i + 512] @ x_d.T
                low = np.searchsorted(where_d, where_q[i:i + 512] - reach, "left")
                high = np.searchsorted(where_d, where_q[i:i + 512] + reach, "right")
                for q, s, a, b in zip(ids_q[i:i + 512], scores, low, high):
                    if b > a:
                        best = _best(q, s[a:b], ids_d[a:b], k + 1)
                        found.append((q, ids_d[a:b][best], s[a:b][best]))
            yield _lists(found)

    lists = together.mapInArrow(rerank, "query long, ids array<long>, scores array<double>")
    merged = lists.groupBy("query").applyInPandas(lambda p: _merge(p, k + 1), "query long, ids array<long>, scores array<double>")
    # the classes of a list give their members; one query drops itself
    merged = materialize(merged, "curve-lists")
    near = merged.select("query", F.explode(F.arrays_zip("ids", "scores")).alias("x")).select("query", F.col("x.ids").alias("cls"), F.col("x.scores").alias("score"))
    near = skew_safe_join(near, classes.select("cls", "members"), "cls").groupBy("query").agg(
        F.collect_list(F.struct("score", "members")).alias("all"))
    flat = F.flatten(F.transform("all", lambda c: F.transform(c["members"], lambda m: F.struct((-c["score"]).alias("s"), m.alias("m")))))
    near = near.select(F.col("query").alias("cls"), F.slice(F.array_sort(flat), 1, 2 * (k + 1)).alias("best"))
    out = skew_safe_join(asking, near, "cls")
    mine = F.slice(F.filter("best", lambda b: b["m"] != F.col("query_id")), 1, k)
    return (out.select("query_id", F.posexplode(mine).alias("pos", "b"))
               .select("query_id", (F.col("pos") + 1).cast("int").alias("rank"), F.col("b.m").alias("vec_id"), (-F.col("b.s")).alias("score")))


def _reach(classes: DataFrame, queries: DataFrame, at: DataFrame, k: int, recall: float, sample: int) -> int:
    """Places either side that reach ``recall`` of the true neighbours of at most ``sample`` queries."""
    some = queries.orderBy(F.xxhash64("cls")).limit(sample).toPandas()
    names, q = some["cls"].to_numpy(), np.array(some["v"].to_list())

    def scan(batches):
        for batch in batches:
            if batch.num_rows:
                ids = batch.column("cls").to_numpy()
                scores = q @ _vectors(batch.column("v")).T
                found = []
                for name, s in zip(names, scores):
                    best = _best(name, s, ids, k + 1)
                    found.append((name, ids[best], s[best]))
                yield _lists(found)

    true = (classes.select("cls", "v").mapInArrow(scan, "query long, ids array<long>, scores array<double>")
            .groupBy("query").applyInPandas(lambda p: _merge(p, k + 1), "query long, ids array<long>, scores array<double>")
            .select("query", F.explode("ids").alias("cls")).where("query <> cls"))
    here = at.where("role = 1").select(F.col("cls").alias("query"), "curve", F.col("at").alias("from"))
    pairs = (F.broadcast(true).join(at.where("role = 0"), "cls")           # at most sample * (k + 1) rows
             .join(here, ["query", "curve"]).groupBy("query", "cls").agg(F.min(F.abs(F.col("at") - F.col("from"))).alias("far")))
    far = pairs.agg(F.percentile("far", F.lit(recall))).first()[0]
    return int(far or 0) + 1
