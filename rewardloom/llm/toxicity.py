"""Toxicity by gradient-boosted trees over dense features, calibrated by isotonic regression.

Features of a whole text: density, number, weight and spread of lexicon entries; entries that show only after
undoing look-alike characters and inserted marks; second person words, and the share of lexicon hits with one
within five words; capitals, words in capitals, exclamation and question marks, other punctuation, runs of
marks, digits inside words and symbols, each as a rate; number, length and variety of words.

The lexicon is a short list of insults and what labelled texts teach: words, and word beginnings of 4 to 6 letters
(languages that compound or inflect), in far more toxic texts than others.  It counts different texts, in Spark.
A text must not meet a lexicon that it taught, or training features would promise more than new texts hold; so
learning rows fall in two halves, each half's features come from the other half's lexicon, and the full lexicon
serves for scoring.  Trees are fitted on two thirds of the learning rows, the isotonic curve on the last third.

At most ``sample`` labelled rows are learned from (half of them, at most, of each label); every text is scored whole.
A row counts, for the trees and the curve, as many times as its label has labelled rows in the fold for each sampled
one, so a score is a chance among the labelled texts whatever part of a label is sampled.

Defined cases: a null text is the empty text and gets the score of its features like any other; without both labels
among the learning rows every score is the share of label 1 there (0 without any); of several labels of a document
the largest counts; a null id counts as the empty id for the split; repeated rows are scored each; an empty table gives
no rows; other columns aren't read.
"""

from __future__ import annotations

import re
from collections import Counter
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import IsotonicRegression
from pyspark.sql import DataFrame, functions as F

from rewardloom.llm.common import bounded_sample, column_or_null, crc_of_id, labelled_rows, materialize, sampled_texts

# Common insults, and second person words, of English, German, French and Spanish.
INSULTS = ("idiot moron stupid dumb loser pathetic worthless trash scum disgusting clown fool jerk ugly garbage imbecile "
           "dumm trottel depp abschaum versager arschloch crétin débile connard abruti salaud ordure "
           "estúpido imbécil basura asqueroso pendejo cabrón").split()
YOU = frozenset("you your yours yourself youre u ur du dich dir dein deine ihr euch euer tu te toi ton ta tes vous votre vos "
                "ti tú tus usted ustedes vosotros os".split())

_WORD = re.compile(r"[^\W\d_]+")
_LOOKS = str.maketrans({"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "@": "a", "$": "s", "!": "i", "|": "l",
                        "*": None, ".": None, "-": None, "_": None, "'": None})
_MIXED = re.compile(r"[^\W\d_][\d@$!|*]+[^\W\d_]")
_CAPITALS = re.compile(r"\b[^\W\d_a-zß-öø-ÿ]{2,}\b")
_RUN = re.compile(r"[!?*#$%&.]{2,}")
_SPACED = re.compile(r"\b(?:[^\W\d_] ){3,}[^\W\d_]\b")
STEMS = (4, 5, 6)
WIDTH = 21


def features(text: str | None, lexicon: dict[str, float]) -> list[float]:
    """``lexicon``: entry -> weight; a beginning is written with a hyphen behind it."""
    text = text or ""
    low = text.lower()
    words = _WORD.findall(low)
    n, chars = max(len(words), 1), max(len(text), 1)
    different = set(words)

    def hit(some):
        found = {w: lexicon[w] for w in some & lexicon.keys()}
        for k in STEMS:
            for w in some:
                weight = lexicon.get(w[:k] + "-")
                if weight is not None and weight > found.get(w, 0):
                    found[w] = weight
        return found

    found = hit(different)
    plain = low.translate(_LOOKS)
    if _SPACED.search(plain):
        plain = _SPACED.sub(lambda m: m.group().replace(" ", ""), plain)
    hidden = hit(set(_WORD.findall(plain)) - different)
    hits, near = 0, 0
    if found:
        count = Counter(words)
        hits = sum(count[w] for w in found)
        at = [i for i, w in enumerate(words) if w in found]
        near = sum(any(x in YOU for x in words[max(0, i - 5):i + 6]) for i in at)
    byte = np.bincount(np.frombuffer(text.encode("utf-8", "replace"), np.uint8), minlength=128)
    upper, lower, digit = int(byte[65:91].sum()), int(byte[97:123].sum()), int(byte[48:58].sum())
    symbols = int(byte[35:39].sum() + byte[42] + byte[124])
    punctuation = int(byte[33:48].sum() + byte[58:65].sum() + byte[91:97].sum() + byte[123:127].sum())
    return [hits / n, float(hits), float(len(found)), sum(found.values()), max(found.values(), default=0.0),
            sum(found.values()) / n, float(len(hidden)), sum(hidden.values()), len(different & YOU) / n,
            near / max(hits, 1), upper / max(upper + lower, 1), len(_CAPITALS.findall(text)) / n, byte[33] / chars,
            byte[63] / chars, punctuation / chars, len(_RUN.findall(text)) / n, len(_MIXED.findall(text)) / n,
            symbols / chars, digit / chars, len(different) / n, float(np.log1p(len(words)))]


def _featured(batches, lexicons: list[dict]):
    for batch in batches:
        half, text = batch.column("half").to_pylist(), batch.column("text").to_pylist()
        rows = [features(t, lexicons[h]) for h, t in zip(half, text)]
        kept = [batch.column(i) for i in range(batch.num_columns - 2)]
        yield pa.RecordBatch.from_arrays([*kept, pa.array(rows, pa.list_(pa.float64()))], names=[*batch.schema.names[:-2], "x"])


def with_features(rows: DataFrame, lexicons: list[dict]) -> DataFrame:
    """Rows with columns ..., half, text -> ..., x; the lexicon is the one at place ``half``."""
    sent = rows.sparkSession.sparkContext.broadcast(lexicons)      # at most ``entries`` words each
    shape = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema if f.name not in ("half", "text"))
    return rows.mapInArrow(lambda b: _featured(b, sent.value), f"{shape}, x array<double>")


def learned_lexicon(rows: DataFrame, entries: int = 2000, least: int = 4, odds: float = 15.0) -> dict[str, float]:
    """From (text, label): at most ``entries`` words and beginnings in ``odds`` times as many of label 1's texts."""
    def marks(batches):
        for batch in batches:
            out, label = [], []
            for text, y in zip(batch.column("text").to_pylist(), batch.column("label").to_pylist()):
                words = set(_WORD.findall((text or "").lower()))
                found = words | {w[:k] + "-" for k in STEMS for w in words if len(w) > k}
                out.extend(found)
                label.extend([y] * len(found))
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.string()), pa.array(label, pa.int64())], names=["mark", "label"])

    texts = rows.select("text", F.col("label").cast("long").alias("label")).dropDuplicates(["text"])
    texts = materialize(texts, "lexicon-texts")
    size = {r["label"]: r["count"] for r in texts.groupBy("label").count().collect()}      # one row a label
    if not size.get(1):
        return {}
    counted = (texts.mapInArrow(marks, "mark string, label long").groupBy("mark")
               .agg(F.sum("label").alias("one"), F.sum(1 - F.col("label")).alias("none")))
    rate = ((F.col("one") + 0.5) / (size[1] + 1)) / ((F.col("none") + 0.5) / (size.get(0, 0) + 1))
    top = (counted.where(F.col("one") >= F.lit(max(least, size[1] // 100))).withColumn("rate", rate).where(F.col("rate") >= odds)
           .orderBy(F.desc("one"), F.desc("rate"), "mark").limit(entries).select("mark", F.log("rate").alias("weight")).collect())
    return {r["mark"]: r["weight"] for r in top}


def _with_seed(learned: dict[str, float]) -> dict[str, float]:
    return {**dict.fromkeys(INSULTS, 3.0), **learned}


def learning_rows(docs: DataFrame, labels: DataFrame, label: str, keep, sample: int) -> DataFrame:
    """(doc_id, label, weight, text) of at most ``sample`` labelled rows for which ``keep`` holds, each label at
    most half of them; rows alike in id and text count once.  weight: the label's rows for each sampled one."""
    marked = (labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(label).cast("int").alias("label"))
              .where("doc_id IS NOT NULL AND label IN (0, 1)").groupBy("doc_id").agg(F.max("label").alias("label")).where(keep))
    marked, most = materialize(labelled_rows(docs, marked), "toxic-labelled"), sample // 2
    size = {r["label"]: r["count"] for r in marked.groupBy("label").count().collect()}      # one row a label
    chosen = reduce(DataFrame.unionByName, [bounded_sample(marked.where(F.col("label") == y), most).withColumn(
        "weight", F.lit(max(size.get(y, 0) / max(most, 1), 1.0))) for y in (1, 0)])
    return sampled_texts(docs, chosen).select("doc_id", "label", "weight", "text")


def score(docs: DataFrame, labels: DataFrame, label: str = "toxic", sample: int = 12000, fold: int = 4, held: int = 2,
          threshold: float = 0.3) -> DataFrame:
    """Rows (doc_id, held_out, score, predicted); learned from labels of rows whose crc32(doc_id as text) mod ``fold``
    is not ``held``."""
    rows = materialize(learning_rows(docs, labels, label, crc_of_id() % fold != held, sample)
                       .withColumn("half", F.pmod(F.xxhash64("doc_id", F.lit(1)), F.lit(2)).cast("int")), "toxic-sample")
    share = rows.agg(F.avg("label"), F.min("label"), F.max("label")).first()
    out = docs.select(column_or_null(docs, "doc_id", "long").alias("doc_id"), F.lit(0).alias("half"), F.col("text").cast("string").alias("text"))
    held_out = (crc_of_id() % fold == held).alias("held_out")
    if share[1] is None or share[1] == share[2]:
        return out.select("doc_id", held_out, F.lit(float(share[0] or 0)).alias("score"), F.lit(int((share[0] or 0) >= threshold)).alias("predicted"))
    lexicons = [_with_seed(learned_lexicon(rows.where(F.col("half") != h))) for h in (0, 1)]
    x = materialize(with_features(rows.select("doc_id", "label", "weight", "half", "text"), lexicons), "toxic-features")
    x = x.select(F.pmod(F.xxhash64("doc_id", F.lit(2)), F.lit(3)).alias("third"), F.col("label").cast("double").alias("label"),
                 "weight", array_to_vector("x").alias("features"))
    trees = GBTClassifier(maxIter=24, maxDepth=4, stepSize=0.25, minInstancesPerNode=4, seed=5, weightCol="weight").fit(x.where("third > 0"))
    chance = vector_to_array("probability")[1]
    curve = IsotonicRegression(featuresCol="raw", predictionCol="score", weightCol="weight").fit(
        trees.transform(x.where("third = 0")).select("label", "weight", chance.alias("raw")))
    full = _with_seed(learned_lexicon(rows))
    every = with_features(out, [full]).select("doc_id", array_to_vector("x").alias("features"))
    scored = curve.transform(trees.transform(every).select("doc_id", chance.alias("raw")))
    final = F.least(F.greatest("score", F.lit(0.0)), F.lit(1.0))
    return scored.select("doc_id", held_out, final.alias("score"), (final >= threshold).cast("int").alias("predicted"))
