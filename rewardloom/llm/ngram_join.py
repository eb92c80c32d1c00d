"""Documents alike in their word n-grams: MinHash banding, then the whole n-gram sets.

Words are lower-cased (A-Z); a text's set holds a 64-bit hash of every run of ``n`` words (of all words, if
there are fewer).  Documents with the same set are one class, and only one of them goes on.  A class's MinHash
values are cut in bands; classes that agree in a whole band meet.  The number of rows in a band is the largest
with which ``recall`` of the pairs at the threshold meet in some band and the values stay under ``most_hashes``.

Classes of one band value are dealt into blocks of at most about ``block`` by hash, and every two blocks of it are a task's
group, so a value that a third of all rows share is many groups of bounded size.  A pair belongs to the
first band that it agrees in, and is verified there alone, on the sets; classes without such a pair don't send theirs.
A group returns a row per class (its links, and one class that it's connected with there), never its pairs.
Connected classes get one class id.

Returned per document: class_id, the least doc_id that links connect it with; text_class, the least doc_id with
the same set; n_links, how many other documents have a similarity of ``threshold`` or more with it.

Defined cases: a null text is the empty text; texts without words are alike among themselves and with nothing
else; a null id is returned and is never a class id unless no other is there; repeated rows are documents of their own;
an empty table gives no rows; other columns aren't read.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from rewardloom.llm.common import column_or_null, components, materialize, row_hash, rows_of, salted_join

_RNG = np.random.default_rng(808)
_BYTE = _RNG.integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = 0x9E3779B97F4A7C15
_BACK = pow(_BASE, -1, 2**64)
_LIGHT = "doc_id long, h long, text_hash long, cls binary, size long, bands array<long>"


def bands_for(threshold: float, recall: float, most_hashes: int) -> tuple[int, int]:
    """(bands, rows): the most rows whose bands reach the recall within that many hashes."""
    for rows in range(most_hashes, 0, -1):
        bands = math.ceil(math.log(1 - recall) / math.log1p(-(threshold**rows)))
        if bands * rows <= most_hashes:
            return bands, rows
    raise ValueError("too few hashes for this recall")


def _powers(base: int, count: int) -> np.ndarray:
    out = np.full(count, base, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


class Shingles:
    """The sorted distinct 64-bit hashes of a text's word n-grams: a polynomial over the n-gram's bytes, as a
    difference of two prefix sums, then mixed."""

    def __init__(self, n: int):
        self.n, self.up, self.down = n, _powers(_BASE, 1 << 16), _powers(_BACK, 1 << 16)

    def of(self, text: str | None) -> np.ndarray:
        words = (text or "").encode().lower().split()
        if not words:
            return np.zeros(0, np.uint64)
        b = np.frombuffer(b" ".join(words), np.uint8)
        if len(b) >= len(self.up):
            self.up, self.down = _powers(_BASE, 2 * len(b)), _powers(_BACK, 2 * len(b))
        total = np.zeros(len(b) + 1, np.uint64)
        np.cumsum(_BYTE[b] * self.up[:len(b)], out=total[1:])
        gaps = np.flatnonzero(b == 32)
        starts, ends = np.append(0, gaps + 1), np.append(gaps, len(b))
        k = min(self.n, len(starts))
        starts, ends = starts[:len(starts) - k + 1], ends[k - 1:]
        x = (total[ends] - total[starts]) * self.down[starts] + (ends - starts).astype(np.uint64)
        x ^= x >> np.uint64(31)
        x *= np.uint64(0xBF58476D1CE4E5B9)
        x ^= x >> np.uint64(29)
        x *= np.uint64(0x94D049BB133111EB)
        x ^= x >> np.uint64(32)
        return np.unique(x)


def _signature(shingles: np.ndarray, by: np.ndarray) -> np.ndarray:
    least = np.full(len(by), np.iinfo(np.uint64).max, np.uint64)
    for i in range(0, len(shingles), 1024):
        np.minimum(least, (shingles[i:i + 1024, None] * by).min(axis=0), out=least)
    return least


def _band_values(signature: np.ndarray, bands: int) -> np.ndarray:
    cut = signature.reshape(bands, -1)
    x = np.arange(1, bands + 1, dtype=np.uint64) * np.uint64(_BASE)
    for i in range(cut.shape[1]):
        x = (x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9) + (cut[:, i] ^ (cut[:, i] >> np.uint64(32)))
    return x.view(np.int64)


def _sketched(batches, n: int, bands: int, rows: int):
    by = np.random.default_rng(4711).integers(1, 2**62, bands * rows, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    shingles = Shingles(n)
    for batch in batches:
        cls, size, values = [], [], []
        for text in batch.column("text").to_pylist():
            s = shingles.of(text)
            cls.append(hashlib.blake2b(s.tobytes(), digest_size=16).digest())
            size.append(len(s))
            values.append(_band_values(_signature(s, by), bands).tolist() if len(s) else None)
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), batch.column("h"), batch.column("text_hash"), pa.array(cls, pa.binary()),
             pa.array(size, pa.int64()), pa.array(values, pa.list_(pa.int64()))],
            names=["doc_id", "h", "text_hash", "cls", "size", "bands"])


def _groups(batches, keys: list[str]):
    """Tables of rows with the same keys, from Arrow batches sorted by them."""
    held: pa.Table | None = None
    for batch in batches:
        if not batch.num_rows:
            continue
        t = pa.Table.from_batches([batch])
        t = pa.concat_tables([held, t]) if held is not None else t
        cols = [t.column(k).to_numpy() for k in keys]
        cut = np.flatnonzero(np.logical_or.reduce([c[1:] != c[:-1] for c in cols])) + 1
        at = 0
        for c in cut.tolist():
            yield t.slice(at, c - at)
            at = c
        held = t.slice(at).combine_chunks()
    if held is not None:
        yield held


def _owned(bands: np.ndarray, side: np.ndarray, band: int) -> np.ndarray:
    """Which pairs (row above column) belong to this group: of two blocks, if it has two, and agreeing first in ``band``."""
    m = len(bands)
    before = np.zeros((m, m), bool)
    for k in range(band):
        before |= bands[:, k][:, None] == bands[:, k][None, :]
    mine = np.triu(~before, 1)
    if side.any():
        mine &= side[:, None] != side[None, :]
    return mine


def _matrix(t: pa.Table) -> np.ndarray:
    values = t.column("bands").combine_chunks()
    return values.flatten().to_numpy(zero_copy_only=False).reshape(t.num_rows, -1)


_KEYS = ["band", "value", "i", "j"]


def _active(batches):
    for t in _groups(batches, _KEYS):
        if t.num_rows < 2:
            continue
        side = (t.column("mine").to_numpy() != t.column("i").to_numpy()) if t.column("i")[0] != t.column("j")[0] else np.zeros(t.num_rows, bool)
        mine = _owned(_matrix(t), side, t.column("band")[0].as_py())
        keep = mine.any(axis=0) | mine.any(axis=1)
        if keep.any():
            yield from t.filter(pa.array(keep)).to_batches()


def _common(sets: list[np.ndarray], mine: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, column, shared n-grams) of the group's pairs."""
    a, b = np.nonzero(mine)
    if len(a) <= 64:
        return a, b, np.array([len(np.intersect1d(sets[x], sets[y], assume_unique=True)) for x, y in zip(a, b)], np.int64)
    whole, where = np.unique(np.concatenate(sets), return_inverse=True)
    who = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    order = np.argsort(where, kind="stable")
    who, where = who[order], where[order]
    shared = np.zeros((len(sets), len(sets)), np.float32)
    for low in range(0, len(whole), 4096):
        i, j = np.searchsorted(where, [low, low + 4096])
        held = np.zeros((len(sets), min(4096, len(whole) - low)), np.float32)
        held[who[i:j], where[i:j] - low] = 1
        shared += held @ held.T
    return a, b, np.rint(shared[a, b]).astype(np.int64)


def _verified(batches, threshold: float):
    for t in _groups(batches, _KEYS):
        side = (t.column("mine").to_numpy() != t.column("i").to_numpy()) if t.column("i")[0] != t.column("j")[0] else np.zeros(t.num_rows, bool)
        sets = [np.frombuffer(x, np.uint64) for x in t.column("grams").to_pylist()]
        mine = _owned(_matrix(t), side, t.column("band")[0].as_py())
        a, b, shared = _common(sets, mine)
        size = np.array([len(s) for s in sets], np.int64)
        hit = shared >= threshold * (size[a] + size[b] - shared) - 1e-9
        a, b = a[hit], b[hit]
        if not len(a):
            continue
        copies = t.column("copies").to_numpy()
        links = np.bincount(a, copies[b], len(sets)) + np.bincount(b, copies[a], len(sets))
        root = np.arange(len(sets))
        while True:
            low = np.minimum(root[a], root[b])
            new = root.copy()
            np.minimum.at(new, a, low)
            np.minimum.at(new, b, low)
            new = new[new]
            if (new == root).all():
                break
            root = new
        keep = np.flatnonzero(links > 0)
        cls = t.column("cls").to_pylist()
        yield pa.RecordBatch.from_arrays([pa.array([cls[x] for x in keep], pa.binary()), pa.array(links[keep].astype(np.int64)),
                                          pa.array([cls[root[x]] for x in keep], pa.binary())], names=["cls", "links", "root"])


def _gram_sets(batches, n: int):
    shingles = Shingles(n)
    for batch in batches:
        grams = [shingles.of(x).tobytes() for x in batch.column("text").to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column("cls"), pa.array(grams, pa.binary())], names=["cls", "grams"])


def linked(docs: DataFrame, n: int = 5, threshold: float = 0.8, recall: float = 0.999999, most_hashes: int = 128,
           block: int = 256) -> DataFrame:
    """Rows (doc_id, class_id, text_class, n_links, h, keeper) of all documents; keeper: the hash of the row that its
    class would keep (least doc_id, then least h)."""
    bands, rows = bands_for(threshold, recall, most_hashes)
    texts = docs.select(column_or_null(docs, "doc_id", "long").alias("doc_id"), row_hash(docs).alias("h"),
                        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")).withColumn("text_hash", F.xxhash64("text"))
    light = materialize(texts.mapInArrow(lambda x: _sketched(x, n, bands, rows), _LIGHT), "ngram-sketches")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "h", "text_hash")).alias("first")
    classes = materialize(light.groupBy("cls").agg(first, F.count(F.lit(1)).alias("copies"), F.max("bands").alias("bands")), "ngram-classes")
    dealt = classes.select("cls", "copies", "bands", F.posexplode("bands").alias("band", "value"))
    met = dealt.select("band", "value").groupBy("band", "value").agg(F.count(F.lit(1)).alias("m")).where("m > 1")
    met = materialize(met.select(F.struct("band", "value").alias("key"), F.ceil(F.col("m") / F.lit(block)).cast("int").alias("blocks"), "m"), "ngram-met")
    dealt = salted_join(dealt.select(F.struct("band", "value").alias("key"), "cls"), met.drop("m"), "key", sizes=met.select("key", F.col("m").alias("rows")))
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    dealt = (dealt.withColumn("mine", F.pmod(F.xxhash64("cls"), F.col("blocks")).cast("int")).withColumn("other", other)
             .select(F.col("key.band").alias("band"), F.col("key.value").alias("value"), F.least("mine", "other").alias("i"),
                     F.greatest("mine", "other").alias("j"), "mine", "cls"))
    dealt = dealt.join(classes.select("cls", "copies", "bands"), "cls").select(*_KEYS, "mine", "cls", "copies", "bands")
    together = lambda df: df.repartition(*_KEYS).sortWithinPartitions(*_KEYS)
    kind = "band int, value long, i int, j int, mine int, cls binary, copies long, bands array<long>"
    active = materialize(together(dealt).mapInArrow(_active, kind), "ngram-active")
    wanted = (classes.join(active.select("cls").distinct(), "cls", "left_semi")
              .select("cls", F.col("first.doc_id").alias("doc_id"), F.col("first.h").alias("h")))
    chosen = (texts.alias("t").join(wanted.alias("w"), F.expr("t.h = w.h AND t.doc_id <=> w.doc_id"))
              .select("w.cls", "t.text"))
    grams = chosen.mapInArrow(lambda x: _gram_sets(x, n), "cls binary, grams binary").dropDuplicates(["cls"])
    found = materialize(together(active.join(grams, "cls").select(*_KEYS, "mine", "cls", "copies", "bands", "grams"))
                        .mapInArrow(lambda x: _verified(x, threshold), "cls binary, links long, root binary"), "ngram-links")
    joined = components(found.select(F.col("cls").alias("a"), F.col("root").alias("b")))
    links = found.groupBy("cls").agg(F.sum("links").alias("links"))
    of = (classes.join(links, "cls", "left").join(joined.withColumnRenamed("node", "cls"), "cls", "left")
          .select("cls", "copies", "first", "links", F.coalesce("root", "cls").alias("root")))
    top = of.groupBy("root").agg(F.min("first").alias("top"))
    of = salted_join(of, top, "root").select("cls", F.col("top.doc_id").alias("class_id"), F.col("first.doc_id").alias("text_class"),
                                             (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"), F.col("top.h").alias("keeper"))
    return salted_join(light.select("doc_id", "h", "cls"), of, "cls", sizes=classes.select("cls", F.col("copies").alias("rows")),
                       spread=F.monotonically_increasing_id()).select("doc_id", "class_id", "text_class", "n_links", "h", "keeper")


def one_of_each(docs: DataFrame, **how) -> DataFrame:
    """``docs`` with one row of each class of documents that links connect: the least doc_id."""
    return rows_of(docs, linked(docs, **how).where("h = keeper AND doc_id <=> class_id"), once=True)
