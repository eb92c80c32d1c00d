"""Quality by hierarchical empirical Bayes: a text's own evidence, and what its site's other texts say.

A logistic regression over dense rates of the whole text (capitals, marks, symbols, bars, digits, repeated words and
lines, word and line lengths) gives each document a probability p of good quality; it learns from at most
``sample`` labelled rows (rows alike in id and text count once there).  Grouped sums of p give each path (part of a site) and each host a rate.  A host's rate
shrinks towards the global one, a path's towards its host's: (sum + k * prior) / (n + k), with k from the data by
moments, g (1 - g) / v - 1 for the variance v between groups beyond what chance gives; so a sparse site says
little.  A document is left out of its own site's sums.  Its posterior log odds are its evidence (its
log odds less those of the learning sample) plus the log odds of its path's rate.

Sums are light rows pre-aggregated before their shuffle, and the join back deals large sites alone over salts.

Defined cases: a null text is the empty text and is never accepted, nor is one without a word (score 0); a null host or path
is a value of its own; without both labels every evidence is 0; of several labels the largest counts; repeated
rows count each; an empty table gives no rows; other columns aren't read.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame, functions as F

from rewardloom.llm.common import bounded_sample, column_or_null, labelled_rows, materialize, row_hash, rows_of, salted_join, sampled_texts

_RUN = re.compile(rb"[!?*#$%&|=_~^-]{2,}")
_WORD = re.compile(rb"[A-Za-z\x80-\xff]+")


def features(text: str | None) -> list[float]:
    b = (text or "").encode("utf-8", "replace")
    n = max(len(b), 1)
    count = np.bincount(np.frombuffer(b, np.uint8), minlength=256)
    words = _WORD.findall(b)
    tokens, lines = b.split(), b.split(b"\n")
    upper, lower = int(count[65:91].sum()), int(count[97:123].sum())
    many = max(len(tokens), 1)
    # words of a text repeat more the longer it is; compare with the root of its length
    variety = min(1.0, len(set(words)) / max(len(words), 1) * max(len(words), 1) ** 0.15)
    return [upper / max(upper + lower, 1), np.log1p(200 * count[33] / n), np.log1p(200 * float(count[35:39].sum() + count[42]) / n),
            np.log1p(200 * count[124] / n), np.log1p(200 * count[48:58].sum() / n), np.log1p(200 * float(count[44] + count[46]) / n),
            np.log1p(200 * float(count[60] + count[62] + count[123] + count[125] + count[95] + count[61]) / n), variety,
            len(set(lines)) / len(lines), np.log1p(len(words)), np.log1p(float(np.mean([len(w) for w in tokens])) if tokens else 0.0),
            np.log1p(100 * len(_RUN.findall(b)) / many), np.log1p(len(b) / len(lines)), float(len(words) == 0)]


def _x(batches):
    for batch in batches:
        kept = [batch.column(i) for i in range(batch.num_columns - 1)]
        rows = [features(t) for t in batch.column("text").to_pylist()]
        yield pa.RecordBatch.from_arrays([*kept, pa.array(rows, pa.list_(pa.float64()))], names=[*batch.schema.names[:-1], "x"])


def learn(docs: DataFrame, labels: DataFrame, label: str = "quality", sample: int = 20000, keep: Column | None = None) -> tuple:
    """(weights, offset, log odds of the learning rows), from at most ``sample`` labelled documents."""
    marked = (labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(label).cast("int").alias("label"))
              .where("doc_id IS NOT NULL AND label IN (0, 1)").groupBy("doc_id").agg(F.max("label").alias("label")))
    if keep is not None:
        marked = marked.where(keep)
    chosen = bounded_sample(labelled_rows(docs, marked), sample)
    rows = sampled_texts(docs, chosen).select("label", "text").mapInArrow(_x, "label int, x array<double>")
    rows = materialize(rows.select(F.col("label").cast("double").alias("label"), "x"), "quality-sample")
    share, low, high = rows.agg(F.avg("label"), F.min("label"), F.max("label")).first()
    if low is None or low == high:
        return np.zeros(len(features(""))), 0.0, 0.0
    fit = LogisticRegression(regParam=1e-3, maxIter=60).fit(rows.select("label", array_to_vector("x").alias("features")))
    return fit.coefficients.toArray(), float(fit.intercept), float(np.log(share / (1 - share)))


def evidence(rows: DataFrame, model: tuple) -> DataFrame:
    """Rows with columns ..., text -> ..., odds (log odds of the text alone; null for a text without words)."""
    weights, offset, _ = model

    def run(batches):
        for batch in batches:
            texts = batch.column("text").to_pylist()
            odds = [float(np.clip(np.dot(features(t), weights) + offset, -30, 30)) if t and t.split() else None for t in texts]
            kept = [batch.column(i) for i in range(batch.num_columns - 1)]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(odds, pa.float64())], names=[*batch.schema.names[:-1], "odds"])

    shape = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema if f.name != "text")
    return rows.mapInArrow(run, f"{shape}, odds double")


def _strength(rate: float, groups: float, rows: float, squares: float, spread: float) -> float:
    """k by moments: groups of sizes whose sum is ``rows`` and sum of squares ``squares``; spread: sum of n (r - prior)^2."""
    chance = rate * (1 - rate)
    left = rows - squares / max(rows, 1)
    between = max((spread - (groups - 1) * chance) / left if left > 0 else 0.0, 1e-7)
    return float(np.clip(chance / between - 1, 1.0, 1e6))


def posteriors(docs: DataFrame, labels: DataFrame, host: str = "source", path: str = "lang", threshold: float = 0.5, **how) -> DataFrame:
    """Rows (doc_id, text_score, host_rate, path_rate, score, accepted, h)."""
    model = learn(docs, labels, **how)
    plain = docs.select(column_or_null(docs, "doc_id", "long").alias("doc_id"), row_hash(docs).alias("h"),
                        F.struct(column_or_null(docs, host, "string").isNull().alias("none"),
                                 F.coalesce(column_or_null(docs, host, "string"), F.lit("")).alias("name")).alias("host"),
                        F.struct(column_or_null(docs, path, "string").isNull().alias("none"),
                                 F.coalesce(column_or_null(docs, path, "string"), F.lit("")).alias("name")).alias("path"),
                        F.col("text").cast("string").alias("text"))
    rows = evidence(plain, model)
    rows = materialize(rows.withColumn("p", F.coalesce(1 / (1 + F.exp(-F.col("odds"))), F.lit(0.0))), "quality-evidence")
    paths = materialize(rows.groupBy("host", "path").agg(F.count(F.lit(1)).alias("n"), F.sum("p").alias("s")), "quality-paths")
    hosts = paths.groupBy("host").agg(F.sum("n").alias("hn"), F.sum("s").alias("hs"), F.count(F.lit(1)).alias("rows"))
    total = hosts.agg(F.sum("hn"), F.sum("hs"), F.count(F.lit(1)), F.sum(F.col("hn") ** 2)).first()
    if not total[0]:
        return rows.select("doc_id", F.lit(0.0).alias("text_score"), F.lit(0.0).alias("host_rate"), F.lit(0.0).alias("path_rate"),
                           F.lit(0.0).alias("score"), F.lit(False).alias("accepted"), "h")
    rate = float(np.clip(total[1] / total[0], 1e-6, 1 - 1e-6))
    spread = hosts.agg(F.sum(F.col("hn") * (F.col("hs") / F.col("hn") - rate) ** 2)).first()[0]
    k_host = _strength(rate, total[2], total[0], total[3], spread)
    both = materialize(salted_join(paths, hosts.drop("rows"), "host", sizes=hosts.select("host", "rows")), "quality-sites")
    inner = both.agg(F.sum(F.col("n") * (F.col("s") / F.col("n") - F.col("hs") / F.col("hn")) ** 2), F.count(F.lit(1)), F.sum(F.col("n") ** 2)).first()
    k_path = _strength(rate, inner[1] - total[2] + 1, total[0], inner[2], inner[0])
    site = both.select(F.struct("host", "path").alias("site"), "n", "s", "hn", "hs")
    out = salted_join(rows.withColumn("site", F.struct("host", "path")), site, "site",
                      sizes=site.select("site", F.col("n").alias("rows")), spread=F.monotonically_increasing_id())
    host_rate = (F.col("hs") - F.col("p") + k_host * rate) / (F.col("hn") - 1 + k_host)
    path_rate = (F.col("s") - F.col("p") + k_path * F.col("host_rate")) / (F.col("n") - 1 + k_path)
    keep = lambda c: F.least(F.greatest(c, F.lit(1e-6)), F.lit(1 - 1e-6))
    out = out.withColumn("host_rate", keep(host_rate)).withColumn("path_rate", keep(path_rate))
    odds = F.col("odds") - F.lit(model[2]) + F.log(F.col("path_rate") / (1 - F.col("path_rate")))
    score = F.coalesce(1 / (1 + F.exp(-odds)), F.lit(0.0))
    return (out.withColumn("score", score)
               .select("doc_id", F.col("p").alias("text_score"), "host_rate", "path_rate", "score", (F.col("score") >= threshold).alias("accepted"), "h"))


def accepted_rows(docs: DataFrame, labels: DataFrame, **how) -> DataFrame:
    """``docs`` without the rows whose posterior is under the threshold."""
    return rows_of(docs, posteriors(docs, labels, **how).where("accepted"))
