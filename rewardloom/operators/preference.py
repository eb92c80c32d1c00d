"""Preference pairs, scorer input, held-out split, pair metrics.

``preference_pairs`` is linear in the data: after one-rating-per-key dedup, each prompt's
best answer (highest rating, then first in source order) is paired with every
strictly lower-rated answer of that prompt — at most n-1 pairs for n answers,
never all pairs.  The champion per prompt is an aggregate (map-side partial),
and the pairing joins against that one-row-per-prompt table with hot prompts
salted (operators/skew.py), so a prompt holding a third of all rows is spread
over many tasks rather than gathered in one.  ``preference_pairs_capped`` takes the widest of all
better/worse pairs of a prompt, up to a cap, without building the others.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from rewardloom.config import DEFAULT_SETTINGS, QA_TEMPLATE
from rewardloom.functions.text import qa_text
from rewardloom.operators.rewards import with_reward_key
from rewardloom.operators.skew import skew_safe_join
from rewardloom.session import materialize


def dedup_by_key(samples: DataFrame) -> DataFrame:
    """One row per reward key: the last rating in source order (as the
    reward lookup table keeps it).  Needs question, answer, rating, seq."""
    keyed = with_reward_key(samples)
    w = F.max_by(F.struct("question", "answer", "rating", "seq"), "seq")
    return keyed.groupBy("key").agg(w.alias("w")).select("key", "w.*")


def staged_answers(samples: DataFrame, dedup: bool = True) -> DataFrame:
    """The answers that pairs are made of, written once: several steps read them."""
    return materialize(dedup_by_key(samples), "pair-answers") if dedup else samples


def against_best(d: DataFrame, carried: tuple = ("answer",)) -> DataFrame:
    """Each prompt's best answer (highest rating, then first in source order) with every lower-rated one:
    question, chosen_rating, rejected_rating and chosen_/rejected_ of each ``carried`` column."""
    best = F.min_by(F.struct(F.col("rating").alias("chosen_rating"), *[F.col(c).alias(f"chosen_{c}") for c in carried]),
                    F.struct((-F.col("rating")).alias("r"), F.col("seq").alias("s")))
    champ = d.groupBy("question").agg(best.alias("c")).select("question", "c.*")
    rows = d.select("question", F.col("rating").alias("rejected_rating"), *[F.col(c).alias(f"rejected_{c}") for c in carried])
    return (skew_safe_join(rows, champ, "question", keys=d.select("question"))
            .where(F.col("rejected_rating") < F.col("chosen_rating")))


def _named(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.col("question").alias("prompt"), F.col("chosen_answer").alias("chosen"), F.col("rejected_answer").alias("rejected"),
                        "chosen_rating", "rejected_rating", (F.col("chosen_rating") - F.col("rejected_rating")).alias("margin"))


def preference_pairs(samples: DataFrame, dedup: bool = True) -> DataFrame:
    """Prompt, chosen, rejected, chosen_rating, rejected_rating, margin."""
    return _named(against_best(staged_answers(samples, dedup)))


def capped_pairs(d: DataFrame, most: int, carried: tuple = ("answer",)) -> DataFrame:
    """Of every prompt's pairs (better, worse) the first ``most`` by margin (widest first), then the higher
    rating of the better answer, then source order of the better and of the worse answer.

    The pairs aren't built to be ranked.  Every (better rating, worse rating) of a prompt is one step of that order,
    and the number of its pairs is the product of two counts.  With the better rating a-th from the top and the worse
    one b-th from the bottom, all steps with a smaller or equal a and b come first, so only steps with a * b <= most
    can hold a wanted pair: about most * ln(most) of them, found by joins on unique keys.  A running sum of their counts
    says how many pairs each step gives, and only these are generated, as ranks of answers among those of
    their prompt and rating.  A rank above ``most`` is never asked for, so windows keep that many rows a group, limited
    before the shuffle; a prompt holding a third of all rows sends no more than others do from each task.

    Ratings that are NULL or NaN and NULL prompts make no pairs."""
    d = d.where(F.col("question").isNotNull() & F.col("rating").isNotNull() & ~F.isnan(F.col("rating").cast("double")))
    rank = F.row_number().over(Window.partitionBy("question", "rating").orderBy("seq"))
    ranked = d.select("question", "rating", "seq", *carried).withColumn("_rank", rank).where(F.col("_rank") <= most).drop("seq")

    sizes = d.groupBy("question", "rating").agg(F.least(F.count(F.lit(1)), F.lit(most)).alias("n"))
    from_top = F.row_number().over(Window.partitionBy("question").orderBy(F.desc("rating")))
    from_bottom = F.row_number().over(Window.partitionBy("question").orderBy("rating"))
    top = sizes.withColumn("a", from_top).where(F.col("a") <= most).select(
        "question", F.col("rating").alias("chosen_rating"), F.col("n").alias("_better"), F.explode(F.sequence(F.lit(1), F.floor(F.lit(most) / F.col("a")).cast("int"))).alias("b"))
    bottom = sizes.withColumn("b", from_bottom).where(F.col("b") <= most).select(
        "question", F.col("rating").alias("rejected_rating"), F.col("n").alias("_worse"), "b")
    steps = top.join(bottom, ["question", "b"]).where(F.col("chosen_rating") > F.col("rejected_rating"))
    steps = steps.withColumn("_pairs", F.col("_better") * F.col("_worse"))
    order = Window.partitionBy("question").orderBy(F.desc(F.col("chosen_rating") - F.col("rejected_rating")), F.desc("chosen_rating"), "rejected_rating")
    before = F.coalesce(F.sum("_pairs").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    steps = steps.withColumn("_take", F.least("_pairs", F.lit(most) - before)).where(F.col("_take") > 0)

    asked = steps.withColumn("_at", F.explode(F.sequence(F.lit(0).cast("long"), F.col("_take") - 1))).select(
        "question", "chosen_rating", "rejected_rating", (F.floor(F.col("_at") / F.col("_worse")) + 1).cast("int").alias("_i"),
        (F.col("_at") % F.col("_worse") + 1).cast("int").alias("_j"))

    def side(name, at):
        return ranked.select("question", F.col("rating").alias(f"{name}_rating"), F.col("_rank").alias(at), *[F.col(c).alias(f"{name}_{c}") for c in carried])

    out = asked.join(side("chosen", "_i"), ["question", "chosen_rating", "_i"]).join(side("rejected", "_j"), ["question", "rejected_rating", "_j"])
    return out.drop("_i", "_j")


def preference_pairs_capped(samples: DataFrame, most: int, dedup: bool = True) -> DataFrame:
    """P1 over all better/worse pairs, at most ``most`` a prompt: the columns of ``preference_pairs``."""
    return _named(capped_pairs(staged_answers(samples, dedup), most))


def format_qa(df: DataFrame, q: str = "question", a: str = "answer", out: str = "text",
              template: str = QA_TEMPLATE) -> DataFrame:
    """The scorer's prompt template, with {question} and {answer}."""
    return df.withColumn(out, qa_text(q, a, template))


def split_bucket(col, seed: int = 42, buckets: int = DEFAULT_SETTINGS.test_share_buckets):
    """Stable hash bucket of a prompt: first 32 bits of md5(seed ':' prompt)."""
    c = F.col(col) if isinstance(col, str) else col
    h = F.md5(F.concat(F.lit(f"{seed}:"), c))
    return F.pmod(F.conv(F.substring(h, 1, 8), 16, 10).cast("bigint"), F.lit(buckets))


def train_test_split(df: DataFrame, prompt_col: str = "question", seed: int = 42,
                     buckets: int = DEFAULT_SETTINGS.test_share_buckets) -> DataFrame:
    """``split`` = 'test' for bucket 0 of ``buckets`` (≈1/buckets of the
    prompts), else 'train'.  Decided by prompt, so one prompt never lands on
    both sides, and stable under repartitioning and retries."""
    b = split_bucket(prompt_col, seed, buckets)
    return df.withColumn("bucket", b).withColumn(
        "split", F.when(F.col("bucket") == 0, F.lit("test")).otherwise(F.lit("train")))


def softplus_neg(d):
    """log(1 + exp(-d)) without overflow."""
    return F.greatest(-d, F.lit(0.0)) + F.log1p(F.exp(-F.abs(d)))


def pair_metrics(scored: DataFrame, by: tuple = ("split",), chosen: str = "score_chosen",
                 rejected: str = "score_rejected") -> DataFrame:
    """Pairwise accuracy (chosen scored higher) and logistic pair loss."""
    d = F.col(chosen) - F.col(rejected)
    return scored.groupBy(*by).agg(F.avg((d > 0).cast("double")).alias("accuracy"),
                                   F.avg(softplus_neg(d)).alias("loss"),
                                   F.count(F.lit(1)).alias("n_pairs"))
