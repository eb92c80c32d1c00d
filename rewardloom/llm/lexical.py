"""Ranked lexical search by an Aho-Corasick scan of the documents.

The terms of all items make one automaton.  Every term stands in it with a guard on both sides, and a document is read
with each run of other characters turned into guards, so a term is found where it stands whole and nowhere
else; the number of times is its tf.  The automaton is broadcast, documents are read where they lie, and no index of them is kept:
one scan counts N, L and each term's df, a second one scores.  An automaton's outputs map to the items that hold
the term; a task keeps the best ``k`` documents of each item, and Spark ranks what the tasks keep.

With N documents that have a term, L terms in all, n terms in a document, df documents with the term:
w = floor(1000 ln((2N + 2) / (2 df + 1))), m = 50 + (50 n N div L), score = sum of w (10^9 tf div (1000 tf + 20 m)) over an
item's terms, once each.

The broadcast is bounded: items are dealt into rounds of at most ``most_items`` items and about ``most_bytes`` bytes of terms,
checked by counting, and each round scans anew.  One item is the least that a round can hold.

Defined cases: a null text has no terms; documents without a term count nowhere; every row is a document of its own, also if
rows repeat, and every row of items is an item, ranked under its id; equal scores go by ascending doc_id, null last; an
empty table on either side gives no rows; other columns aren't read.
"""

from __future__ import annotations

import math

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from rewardloom.operators.indexing import sequential_index

TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
GUARD = " "
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
# of each byte of UTF-8: lower-case letters, digits and all that isn't ASCII stay, the rest guards
READ_AS = bytes(b if b >= 128 or chr(b).isalnum() else ord(GUARD) for b in range(256)).translate(bytes.maketrans(UPPER.encode(), LOWER.encode()))


def read(text: str | None) -> bytes:
    """A text as the automaton reads it: guards between terms and at the ends."""
    return f"{GUARD}{text or ''}{GUARD}".encode().translate(READ_AS)


class Terms:
    """The automaton of some items' terms, and the items of each term (``items[begin[t]:begin[t + 1]]``)."""

    def __init__(self, of_items: list):
        held: dict = {}
        for item, terms in enumerate(of_items):
            for t in terms:
                held.setdefault(t, []).append(item)
        self.names = sorted(held)
        self.count = len(of_items)
        self.begin = np.cumsum([0] + [len(held[t]) for t in self.names])
        self.items = np.array([i for t in self.names for i in held[t]], np.int64)
        self.automaton = ahocorasick.Automaton()
        for number, t in enumerate(self.names):
            self.automaton.add_word(read(t).decode("latin-1"), number)           # a character a byte
        if self.names:
            self.automaton.make_automaton()

    def found(self, text: str | None) -> tuple[int, np.ndarray, np.ndarray]:
        """n, and the terms that stand in the text with their tf."""
        s = read(text)
        ends = self.automaton.iter(s.decode("latin-1")) if self.names else ()
        return len(s.split()), *np.unique(np.fromiter((t for _, t in ends), np.int64), return_counts=True)


class Best:
    """The best ``k`` documents of each item among those seen; ``least`` is the score that is needed to be one."""

    def __init__(self, items: int, k: int):
        self.k, self.least = k, np.ones(items, np.int64)
        self.held, self.size = [], 0

    def add(self, *columns) -> None:
        """Columns item, score, doc, null (1 where the id is)."""
        self.held.append(columns)
        self.size += len(columns[0])
        if self.size > max(4 * self.k * len(self.least), 1 << 16):
            self.kept()

    def kept(self) -> tuple:
        item, score, doc, null = (np.concatenate(c) for c in zip(*self.held)) if self.held else [np.zeros(0, np.int64)] * 4
        order = np.lexsort([doc, null, -score, item])
        by = item[order]
        first = np.flatnonzero(np.r_[True, by[1:] != by[:-1]][:len(by)])
        place = np.arange(len(by)) - np.repeat(first, np.diff(np.r_[first, len(by)]))
        last = order[place == self.k - 1]
        self.least[item[last]] = score[last]
        on = order[place < self.k]
        self.held, self.size = [(item[on], score[on], doc[on], null[on])], len(on)
        return self.held[0]


def numbered(items: DataFrame, most_items: int, most_bytes: int) -> tuple[DataFrame, int]:
    """(round, item_id, terms) of each item and the number of rounds, each within the bounds unless it is one item."""
    text = F.translate(F.coalesce(F.col("text").cast("string"), F.lit("")), UPPER, LOWER)
    rows = items.select(F.col("item_id").cast("long").alias("item_id"), F.array_distinct(F.regexp_extract_all(text, F.lit(TERM), F.lit(0))).alias("terms"))
    rows = sequential_index(rows.withColumn("bytes", F.octet_length(F.array_join("terms", GUARD))).withColumn("h", F.xxhash64("terms")),
                            ["item_id", "h"], "number")
    whole = rows.agg(F.count(F.lit(1)).alias("n"), F.sum("bytes").alias("bytes")).first()
    if not whole["n"]:
        return rows, 0
    rounds = max(-(-whole["n"] // most_items), -(-whole["bytes"] // most_bytes), 1)
    while rounds < whole["n"]:
        largest = rows.groupBy(F.col("number") % rounds).agg(F.sum("bytes").alias("bytes")).agg(F.max("bytes")).first()[0]
        if largest <= 2 * most_bytes:
            break
        rounds = min(2 * rounds, whole["n"])
    return rows.select((F.col("number") % rounds).alias("round"), "number", "item_id", "terms"), rounds


def counted(docs: DataFrame, shared) -> tuple[int, int, np.ndarray]:
    """N, L and the df of each term: the first scan."""
    def run(batches):
        terms = shared.value
        df, n_docs, n_terms = np.zeros(len(terms.names), np.int64), 0, 0
        for batch in batches:
            for text in batch.column("text"):
                n, found, _ = terms.found(text.as_py())
                df[found] += 1
                n_docs, n_terms = n_docs + (n > 0), n_terms + n
        seen = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays([pa.array(np.r_[-1, -2, seen], pa.int64()), pa.array(np.r_[n_docs, n_terms, df[seen]], pa.int64())], names=["term", "n"])

    got = docs.select("text").mapInArrow(run, "term long, n long").groupBy("term").agg(F.sum("n").alias("n")).toPandas()    # a row a term of the round
    by = dict(zip(got["term"], got["n"]))
    df = np.array([by.get(t, 0) for t in range(len(shared.value.names))], np.int64)
    return int(by.get(-1, 0)), int(by.get(-2, 0)), df


def weights(n_docs: int, df: np.ndarray) -> np.ndarray:
    return np.array([math.floor(1000 * math.log((2 * n_docs + 2) / (2 * d + 1))) for d in df.tolist()], np.int64)


def scored(docs: DataFrame, shared, n_docs: int, n_terms: int, weight: np.ndarray, k: int, at_once: int = 1 << 21) -> DataFrame:
    """(item, score, doc_id): each task's best ``k`` documents of each of the round's items, the second scan."""
    shape = pa.schema([("item", pa.int64()), ("score", pa.int64()), ("doc_id", pa.int64())])

    def run(batches):
        terms = shared.value
        best = Best(terms.count, k)
        held: list = []                                          # (doc, null, terms, what each adds)
        adds, most_docs = 0, max(1, at_once // max(1, terms.count))

        def flush():
            size = np.array([len(t) for _, _, t, _ in held])
            term, add = np.concatenate([t for _, _, t, _ in held]), np.concatenate([a for _, _, _, a in held])
            many = terms.begin[term + 1] - terms.begin[term]
            at = np.arange(many.sum()) + np.repeat(terms.begin[term] - np.r_[0, np.cumsum(many)[:-1]], many)
            total = np.zeros(len(held) * terms.count, np.int64)
            np.add.at(total, np.repeat(np.repeat(np.arange(len(held)), size) * terms.count, many) + terms.items[at], np.repeat(add, many))
            total = total.reshape(len(held), terms.count)
            d, item = np.nonzero(total >= best.least)
            doc, null = np.array([x for x, _, _, _ in held], np.int64), np.array([x for _, x, _, _ in held], np.int64)
            best.add(item, total[d, item], doc[d], null[d])

        for batch in batches:
            for doc, text in zip(batch.column("doc_id"), batch.column("text")):
                n, found, tf = terms.found(text.as_py())
                if not len(found):
                    continue
                m = 50 + 50 * n * n_docs // n_terms
                doc = doc.as_py()
                held.append((doc or 0, int(doc is None), found, weight[found] * (1_000_000_000 * tf // (1000 * tf + 20 * m))))
                adds += int((terms.begin[found + 1] - terms.begin[found]).sum())
                if adds > at_once or len(held) >= most_docs:
                    flush()
                    held, adds = [], 0
        if held:
            flush()
        item, score, doc, null = best.kept()
        yield pa.RecordBatch.from_arrays([pa.array(item), pa.array(score), pa.array(doc, mask=null.astype(bool))], schema=shape)

    return docs.select("doc_id", "text").mapInArrow(run, "item long, score long, doc_id long")


def search(docs: DataFrame, items: DataFrame, k: int = 50, most_items: int = 4096, most_bytes: int = 4 << 20) -> DataFrame:
    """Rows (item_id, rank, doc_id, score): the ``k`` best documents of each item."""
    spark = docs.sparkSession
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    rows, rounds = numbered(items, most_items, most_bytes)
    out = spark.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    place = F.row_number().over(Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id")))
    for r in range(rounds):
        of_round = rows.where(F.col("round") == r).orderBy("number").collect()          # bounded: one round's items
        terms = Terms([x["terms"] for x in of_round])
        shared = spark.sparkContext.broadcast(terms)
        n_docs, n_terms, df = counted(docs, shared)
        if not n_docs:
            return out
        kept = scored(docs, shared, n_docs, n_terms, weights(n_docs, df), k).withColumn("rank", place).where(F.col("rank") <= k)
        ids = F.array(*[F.lit(x["item_id"]).cast("long") for x in of_round])
        out = out.unionByName(kept.select(F.get(ids, F.col("item").cast("int")).alias("item_id"), "rank", "doc_id", "score"))
    return out
