"""Language identification in two steps: the family, then the language in it.

A text is lower-cased, everything that isn't a letter becomes one space, and its byte trigrams are hashed
to ``DIMS`` rates.  Families come from a table (a language that isn't in it is a family of its own).  Between every two
families, and between every two languages of a family, stands a linear support vector machine (squared
hinge, on standardised rates), so close languages are told apart by a plane that saw only them.  The most votes win,
then the larger sum of margins.  Margins become probabilities by a sigmoid fitted to each machine; the score is the
least of the winner's in its family's duels times the same in its language's duels.

The machines learn on the driver from a sample: as many documents of each language, at most ``sample`` in all or 20 a
language, whichever is more; so rows and duels on the driver grow with the number of values in lang.  All
texts are then scored whole in one pass without a shuffle.

Defined cases: a null text, or one without a letter, is ``und`` with score 0, as is every text if nothing could be learned;
with one language only, that is predicted with score 1; a null id counts as the empty id for the split; repeated rows are
predicted each; an empty table gives no rows; other columns aren't read.
"""

from __future__ import annotations


import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from rewardloom.llm.common import column_or_null, crc_of_id

DIMS = 4096
UNKNOWN = "und"

# ISO 639-1 codes of language families.
FAMILIES = {
    "germanic": "en de nl sv da no nb nn is af lb fy yi".split(),
    "romance": "fr es it pt ro ca gl oc la".split(),
    "slavic": "ru uk be pl cs sk bg mk sr hr bs sl".split(),
    "baltic": "lt lv".split(),
    "uralic": "fi et hu".split(),
    "turkic": "tr az kk ky uz tk tt".split(),
    "semitic": "ar he mt am".split(),
    "iranian": "fa ps ku tg".split(),
    "indic": "hi ur bn mr gu pa ne si".split(),
    "dravidian": "ta te kn ml".split(),
    "sinitic": "zh yue".split(),
    "austronesian": "id ms jv tl".split(),
}

_ONLY = bytes(b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


def has_letter(text: str) -> bool:
    """Whether a character of Unicode's category L is in the text, as ``\\p{L}`` finds it."""
    return any(map(str.isalpha, text))


def rates(texts: list[str]) -> np.ndarray:
    """(texts, DIMS) shares of hashed byte trigrams."""
    body = [b" " + b" ".join(x.lower().encode().translate(_ONLY).split()) + b"  " for x in texts]
    whole = np.frombuffer(b"".join(body), np.uint8).astype(np.uint32)
    size = np.array([len(x) for x in body])
    a, b, c = whole[:-2], whole[1:-1], whole[2:]
    code = ((a * np.uint32(0x9E3779B1)) ^ (b * np.uint32(0x85EBCA77)) ^ (c * np.uint32(0xC2B2AE3D))) * np.uint32(0x27D4EB2F) >> np.uint32(20)
    doc = np.repeat(np.arange(len(texts)), size)
    keep = np.ones(len(whole), bool)
    ends = np.cumsum(size)
    keep[ends - 1] = keep[ends - 2] = False           # trigrams that reach into the next text
    at = doc[keep] * DIMS + code[keep[:-2]]
    out = np.bincount(at, minlength=len(texts) * DIMS).reshape(len(texts), DIMS).astype(np.float32)
    return out / np.maximum(size - 2, 1)[:, None].astype(np.float32)


def svm(x: np.ndarray, y: np.ndarray, cost: float = 1.0, turns: int = 120) -> tuple[np.ndarray, float]:
    """Weights and offset of the plane that minimises |w|^2 / 2 + cost * mean squared hinge (accelerated descent).  The last
    column of ``x`` is 1."""
    share = np.where(y > 0, 0.5 / max((y > 0).sum(), 1), 0.5 / max((y < 0).sum(), 1)).astype(np.float32)
    v = np.random.default_rng(0).normal(size=x.shape[1]).astype(np.float32)
    for _ in range(20):                               # the largest curvature, for the step
        v = x.T @ (share * (x @ v))
        v /= np.linalg.norm(v)
    slope = 2 * cost * float(np.linalg.norm(x.T @ (share * (x @ v)))) + 1
    w = np.zeros(x.shape[1], np.float32)
    ahead, t = w, 1.0
    for _ in range(turns):
        miss = np.maximum(1 - y * (x @ ahead), 0)
        grad = ahead - 2 * cost * (x.T @ (share * y * miss))
        new = ahead - grad / slope
        t, before = (1 + (1 + 4 * t * t) ** 0.5) / 2, t
        ahead, w = new + (before - 1) / t * (new - w), new
    return w[:-1], float(w[-1])


def _slope(margin: np.ndarray, y: np.ndarray) -> float:
    """The steepness of the sigmoid that fits the margins best."""
    tried = np.geomspace(0.25, 16, 40)
    return float(tried[np.argmin([np.logaddexp(0, -a * y * margin).mean() + 1e-3 * a for a in tried])])


class Model:
    def __init__(self, x: np.ndarray, lang: np.ndarray, families: dict[str, list[str]]):
        of = {code: name for name, codes in families.items() for code in codes}
        self.langs = sorted(set(lang))
        family = np.array([of.get(code, "=" + code) for code in lang], dtype=object)
        self.families = sorted(set(family))
        self.members = {f: sorted(set(lang[family == f])) for f in self.families}
        self.duels: dict = {}
        planes, offsets = [], []
        # x is the one large array here (rates and a column of ones): it is standardised in place
        rates_ = x[:, :DIMS]
        mean = rates_.mean(axis=0) if len(x) else np.zeros(DIMS, np.float32)
        deviation = np.maximum(rates_.std(axis=0), 1e-5) if len(x) else np.ones(DIMS, np.float32)
        rates_ -= mean
        rates_ /= deviation
        for names, labels in [(self.families, family), *[(m, lang) for m in self.members.values()]]:
            for i, a in enumerate(names):
                for b in names[i + 1:]:
                    rows = (labels == a) | (labels == b)
                    part = x if rows.all() else x[rows]
                    y = np.where(labels[rows] == a, 1, -1).astype(np.float32)
                    w, c = svm(part, y)
                    self.duels[a, b] = (len(planes), _slope(part[:, :DIMS] @ w + c, y))
                    planes.append(w / deviation)
                    offsets.append(c - float((w / deviation) @ mean))
        self.planes = np.array(planes, np.float32).reshape(len(planes), DIMS)
        self.offsets = np.array(offsets, np.float32)

    def _winner(self, names: list[str], margins: np.ndarray) -> tuple[str, float]:
        if len(names) == 1:
            return names[0], 1.0
        votes, total = dict.fromkeys(names, 0), dict.fromkeys(names, 0.0)
        chance = dict.fromkeys(names, 1.0)
        for i, a in enumerate(names):
            for b in names[i + 1:]:
                at, slope = self.duels[a, b]
                m = float(margins[at])
                votes[a if m >= 0 else b] += 1
                total[a] += m
                total[b] -= m
                p = 1 / (1 + np.exp(-np.clip(slope * m, -30, 30)))
                chance[a], chance[b] = min(chance[a], p), min(chance[b], 1 - p)
        best = max(names, key=lambda n: (votes[n], total[n]))
        return best, float(chance[best])

    def predict(self, texts: list[str | None]) -> tuple[list[str], list[float]]:
        lang, score = [UNKNOWN] * len(texts), [0.0] * len(texts)
        at = [i for i, x in enumerate(texts) if x and has_letter(x)] if self.langs else []
        for k in range(0, len(at), 128):
            part = at[k:k + 128]
            margins = rates([texts[i] for i in part]) @ self.planes.T + self.offsets
            for i, m in zip(part, margins):
                family, p = self._winner(self.families, m)
                lang[i], q = self._winner(self.members[family], m)
                score[i] = p * q
        return lang, score


def learn(docs: DataFrame, sample: int = 4000, families: dict | None = None, fold: int = 3, held: int = 1) -> Model:
    """From at most ``sample`` rows with a lang, a letter in the text and crc32(doc_id as text) mod ``fold`` other than ``held``: of each
    language those with the smallest hashes of id and text.  Rows alike in all three count once, so an id that many rows
    share adds no more rows than others do."""
    rows = docs.select(column_or_null(docs, "doc_id", "long").alias("doc_id"), column_or_null(docs, "lang", "string").alias("lang"),
                       F.col("text").cast("string").alias("text"))
    rows = rows.where(F.col("lang").isNotNull() & F.col("doc_id").isNotNull() & (crc_of_id() % fold != held) & F.col("text").rlike(r"\p{L}"))
    light = rows.select("lang", F.xxhash64("doc_id", "text").alias("h"))
    langs = light.agg(F.count_distinct("lang")).first()[0]
    most = max(20, sample // max(langs, 1))
    # the smallest hashes spread evenly over 16 parts, so a language's last step reads about twice what it keeps
    part = Window.partitionBy("lang", F.pmod("h", F.lit(16))).orderBy("h")
    near = light.distinct().withColumn("place", F.row_number().over(part)).where(F.col("place") <= most // 8 + 20)
    place = F.row_number().over(Window.partitionBy("lang").orderBy("h"))
    chosen = near.select("lang", "h").withColumn("place", place).where(F.col("place") <= most).select("lang", "h")

    def featured(batches):
        for batch in batches:
            lang, text = batch.column("lang").to_pylist(), batch.column("text").to_pylist()
            for k in range(0, len(text), 128):
                x = rates(text[k:k + 128])
                places = [np.flatnonzero(r).astype(np.int32) for r in x]
                yield pa.RecordBatch.from_arrays([pa.array(lang[k:k + 128]), pa.array(places, pa.list_(pa.int32())),
                                                  pa.array([r[p] for r, p in zip(x, places)], pa.list_(pa.float32()))], names=["lang", "at", "rate"])

    # at most ``sample`` rows (20 a language at least), so their hashes are sent to every task
    rows = (rows.withColumn("h", F.xxhash64("doc_id", "text")).join(F.broadcast(chosen), ["lang", "h"]).groupBy("lang", "h").agg(F.first("text").alias("text"))
            .select("lang", "text").mapInArrow(featured, "lang string, at array<int>, rate array<float>").toArrow().combine_chunks())
    lang = np.array(rows.column("lang").to_pylist(), dtype=object)
    order = np.argsort(lang.astype(str), kind="stable")
    x = np.zeros((len(lang), DIMS + 1), np.float32)
    x[:, DIMS] = 1
    if len(lang):
        at, rate = (rows.column(c).chunk(0) for c in ("at", "rate"))
        sizes = np.diff(at.offsets.to_numpy())
        x[np.repeat(np.argsort(order), sizes), at.flatten().to_numpy()] = rate.flatten().to_numpy()
    return Model(x, lang[order], families or FAMILIES)


def predictions(docs: DataFrame, keep: list, model: Model) -> DataFrame:
    """``keep`` (columns of docs with aliases) and lang_pred, score."""
    chosen = docs.select(*keep, F.col("text").cast("string").alias("text"))
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        for batch in batches:
            lang, score = sent.value.predict(batch.column("text").to_pylist())
            kept = [batch.column(i) for i in range(batch.num_columns - 1)]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(lang, pa.string()), pa.array(score, pa.float64())],
                                             names=[*batch.schema.names[:-1], "lang_pred", "score"])

    shape = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in chosen.schema if f.name != "text")
    return chosen.mapInArrow(run, f"{shape}, lang_pred string, score double")


def identify(docs: DataFrame, **how) -> DataFrame:
    """Rows (doc_id, held_out, lang_pred, score)."""
    model = learn(docs, **how)
    keep = [column_or_null(docs, "doc_id", "long").alias("doc_id")]
    out = predictions(docs, keep, model)
    return out.select("doc_id", (crc_of_id() % how.get("fold", 3) == how.get("held", 1)).alias("held_out"), "lang_pred", "score")


def identified_rows(docs: DataFrame, least: float = 0.25, **how) -> DataFrame:
    """``docs`` without the rows of no language: ``und``, or a score under ``least``, as a duel lost in both steps would give."""
    model = learn(docs, **how)
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        for batch in batches:
            lang, score = sent.value.predict(batch.column("text").to_pylist())
            yield batch.filter(pa.array([a != UNKNOWN and b >= least for a, b in zip(lang, score)], pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
