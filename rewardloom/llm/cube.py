"""Mixing sources to target weights by balanced sampling, the cube method.

Targets: sources in code point order (null last) weigh 3, 1, 2 in turn and share 150 % of all words;
a target stops at twice its source's words, and the excess is shared again by weight until no target
is above.  A document of a source with target / words = r is taken floor(r) times, and once more with
probability r - floor(r), its inclusion probability.

Flight: the documents of a source go into groups of about ``group`` rows by a hash of the row, equal rows one after the other.  In a
group, the probabilities of three undecided documents at a time move along the direction that
leaves the sums of probabilities and of probability-weighted words as they are (the null space of
the two balancing constraints), either way with the odds that keep each expectation, until one is 0 or 1.
Each group leaves at most two undecided; these form the groups of the next round, a thousandth as
many, until one group per source is left.  Landing: ten documents of spread sizes stay out of this last
flight; they and its last two undecided are decided together, by the subset that comes nearest to the words
and then the documents that their probabilities ask.

Every random draw comes from a generator seeded by source, round and group, over rows in a fixed
order, so reruns agree.  Work is a shuffle of (key, size) rows; texts aren't moved.

Defined cases: a null text has size 0; a null source is a source of its own; a source without words has
target 0 and its documents are not taken; equal rows are separate documents; an empty table gives no rows.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from rewardloom.llm.common import WORD, column_or_null, free_name, materialize, row_hash, row_marks, salted_join
from rewardloom.operators.indexing import sequential_index

_EPS = 1e-12


def targets(sources: DataFrame, weights=(3, 1, 2), share: float = 1.5, cap: float = 2.0) -> DataFrame:
    """(source, source_size) -> the same with a target.  The loop sees one row of sums a turn."""
    ranked = sequential_index(sources, [F.col("source").asc_nulls_last()], "rank")
    turn = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.pmod("rank", F.lit(len(weights))) + 1).cast("int"))
    ranked = materialize(ranked.select("source", "source_size", "rank", turn.alias("weight"),
                                       (F.lit(float(cap)) * F.col("source_size")).alias("most")), "mix-sources")
    total = (ranked.agg(F.sum("source_size")).first()[0] or 0) * share
    level, capped = 0.0, -1
    while True:
        full = F.col("most") <= F.col("weight") * F.lit(level)
        n, used, free = ranked.agg(F.count_if(full), F.sum(F.when(full, F.col("most")).otherwise(0.0)),
                                   F.sum(F.when(full, 0.0).otherwise(F.col("weight")))).first()
        if n == capped or not free:
            break
        capped, level = n, (total - used) / free
    return ranked.select("source", "source_size", "rank",
                         F.least("most", F.col("weight") * F.lit(float(level))).alias("target"))


def _flight(size: list, p: list, draw) -> None:
    """Moves probabilities in place until at most two are left undecided (three, or two of equal size, always can)."""
    active: list[int] = []
    for i in range(len(p)):
        if not _EPS < p[i] < 1 - _EPS:
            p[i] = round(p[i])
            continue
        active.append(i)
        while len(active) == 3 or len(active) == 2 and size[active[0]] == size[active[1]]:
            if len(active) == 2:
                u = (1.0, -1.0)
            else:
                a, b, c = (size[k] for k in active)
                u = (b - c, c - a, a - b)
                if a == b == c:
                    u = (1.0, -1.0, 0.0)
            up = min(((1 - p[k]) / x if x > 0 else p[k] / -x) for k, x in zip(active, u) if x)
            down = min((p[k] / x if x > 0 else (1 - p[k]) / -x) for k, x in zip(active, u) if x)
            step = up if draw() * (up + down) < down else -down
            for k, x in zip(active, u):
                p[k] += step * x
                if p[k] < 1e-9 or p[k] > 1 - 1e-9:
                    p[k] = float(round(p[k]))
            active = [k for k in active if 0 < p[k] < 1]


def _hold(size: list, p: list, most: int) -> list[int]:
    """Up to ``most`` undecided documents of spread sizes, kept out of the last flight for the landing."""
    undecided = sorted((i for i in range(len(p)) if _EPS < p[i] < 1 - _EPS), key=lambda i: (size[i], i))
    if len(undecided) <= most:
        return undecided
    return [undecided[(2 * k + 1) * len(undecided) // (2 * most)] for k in range(most)]


def _land(size: list, p: list, held: list[int], draw) -> None:
    """Decides the held documents and the flight's last two: the subset whose words, then documents, come
    nearest to what their probabilities ask; the generator decides between equals."""
    left = sorted({*held, *(i for i in range(len(p)) if 0 < p[i] < 1)})
    if not left:
        return
    s, q = np.array([size[i] for i in left], float), np.array([p[i] for i in left])
    bits = (np.arange(1 << len(left))[:, None] >> np.arange(len(left))) & 1
    order = np.lexsort([[draw() for _ in bits], np.abs(bits.sum(axis=1) - q.sum()), np.round(np.abs(bits @ s - s @ q), 6)])
    for i, x in zip(left, bits[order[0]].tolist()):
        p[i] = float(x)


def _round(todo: DataFrame, level: int, seed: int, last: bool) -> DataFrame:
    def fly(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["h", "size", "p", "doc_id", "no"], kind="stable").reset_index(drop=True)
        rng = np.random.default_rng([seed, level, int(pdf["rank"].iloc[0]), int(pdf["bucket"].iloc[0])])
        size, p = pdf["size"].astype(float).tolist(), pdf["p"].tolist()
        draw = rng.random
        held = _hold(size, p, 10) if last else []
        rest = sorted(set(range(len(p))).difference(held))
        moved = [p[i] for i in rest]
        _flight([size[i] for i in rest], moved, draw)
        for i, x in zip(rest, moved):
            p[i] = x
        if last:
            _land(size, p, held, draw)
        pdf["p"] = p
        return pdf

    return todo.groupBy("rank", "bucket").applyInPandas(fly, todo.schema)


def _dealt(seed: int):
    """A row's group: by its hash, and equal rows one group after the other."""
    return F.pmod(F.pmod(F.xxhash64("h", "doc_id", F.lit(seed)), F.col("groups")) + F.col("no"), F.col("groups"))


def sized(docs: DataFrame) -> DataFrame:
    """(doc_id, source, size, h) of every row; h: a hash of the whole row."""
    return docs.select(column_or_null(docs, "doc_id", "long").alias("doc_id"),
                       column_or_null(docs, "source", "string").alias("source"),
                       F.regexp_count(F.coalesce(F.col("text"), F.lit("")), F.lit(WORD)).cast("long").alias("size"),
                       row_hash(docs).alias("h"))


def mix(docs: DataFrame, weights=(3, 1, 2), share: float = 1.5, cap: float = 2.0, group: int = 4096,
        seed: int = 20) -> DataFrame:
    """Rows (doc_id, size, source_size, target, taken, copies, h), one per row of ``docs``."""
    rows = materialize(sized(docs).groupBy("doc_id", "source", "size", "h").agg(F.count(F.lit(1)).alias("m")), "mix-sizes")
    per = rows.groupBy("source").agg(F.sum(F.col("size") * F.col("m")).alias("source_size"), F.sum("m").alias("n"))
    goal = materialize(targets(per.select("source", "source_size"), weights, share, cap).alias("t")
                       .join(per.alias("n"), F.expr("t.source <=> n.source"))
                       .select("t.source", "t.rank", "t.source_size", "t.target", "n"), "mix-targets")
    # a source's one row reaches all its documents, the largest source's too: one task's documents are split by a salt
    salts = 64
    salted = goal.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    # equal rows are one row with a count until here, then numbered, so that their numbers deal them over the groups
    rows = rows.withColumn("from", F.explode(F.sequence(F.lit(0), F.col("m") - 1, F.lit(group)))).withColumn("part", F.floor(F.col("from") / F.lit(group)))
    every = (rows.withColumn("salt", F.pmod(F.pmod(F.xxhash64("h", "doc_id"), F.lit(salts)) + F.col("part"), F.lit(salts)).cast("int")).alias("r")
             .join(salted.alias("t"), F.expr("r.source <=> t.source AND r.salt = t.salt"))
             .withColumn("no", F.explode(F.sequence("from", F.least(F.col("from") + F.lit(group), F.col("m")) - 1)))
             .select("doc_id", "size", "h", "no", "rank", "source_size", "target", "n"))
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    every = (every.withColumn("rate", rate).withColumn("base", F.floor("rate").cast("long"))
                  .withColumn("p", F.col("rate") - F.col("base"))
                  .withColumn("groups", F.ceil(F.col("n") / F.lit(group)).cast("long"))
                  .withColumn("bucket", _dealt(seed)))
    keep = ["doc_id", "size", "h", "no", "rank", "source_size", "target", "base", "bucket", "p"]
    todo, done, level = every.select(*keep), [], 0
    while True:
        biggest = (per if level == 0 else todo.groupBy("rank").agg(F.count(F.lit(1)).alias("n"))).agg(F.max("n")).first()[0]
        last = (biggest or 0) <= group
        if level and not last:
            counts = todo.groupBy("rank").agg(F.ceil(F.count(F.lit(1)) / F.lit(group)).cast("long").alias("groups"))
            todo = (todo.join(counts, "rank").withColumn("bucket", _dealt(seed + level)).select(*keep))
        elif level:
            todo = todo.withColumn("bucket", F.lit(0).cast("long"))
        flown = materialize(_round(todo, level, seed, last), f"mix-round{level}")
        if last:
            done.append(flown)
            break
        open_ = (F.col("p") > 0) & (F.col("p") < 1)
        done.append(flown.where(~open_))
        todo, level = flown.where(open_), level + 1
    out = done[0]
    for more in done[1:]:
        out = out.unionByName(more)
    copies = F.col("base") + F.round("p").cast("long")
    return out.select("doc_id", "size", "source_size", "target", (F.col("size") * copies).alias("taken"),
                      copies.alias("copies"), "h")


def mixed_rows(docs: DataFrame, **how) -> DataFrame:
    """The mix itself: every row of ``docs`` as often as it is taken.  Equal rows are one row, as often as they are taken together;
    a row that is taken very often is written by several tasks."""
    names, marked = row_marks(docs)
    portion, often = free_name(marked, "__row_portion"), free_name(marked, "__row_copies")
    taken = mix(docs, **how).groupBy(F.col("h").alias(names[0]), F.coalesce("doc_id", F.lit(0)).alias(names[1])).agg(F.sum("copies").alias(often))
    taken = materialize(taken.where(F.col(often) > 0), "mix-taken")
    some = F.explode(F.sequence(F.lit(0), F.col(often) - 1, F.lit(4096)))
    taken = taken.withColumn(portion, some).withColumn(often, F.least(F.col(often) - F.col(portion), F.lit(4096)).cast("int"))
    both = salted_join(taken, marked.dropDuplicates(names), names, most=16)
    return both.withColumn(portion, F.explode(F.array_repeat(F.lit(1), F.col(often)))).select(*[F.col(f"`{c}`") for c in docs.columns])
