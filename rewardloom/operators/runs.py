"""The feedback run, its gates, and the dataset card.

A run is one lazy chain  extract -> clean -> reward samples.  The gates need
three counts (extracted, cleaned, samples); they come from ONE aggregation
over the extracted rows, using the cleaning predicate as a column, so the
chain is never evaluated twice just to count.
"""

from __future__ import annotations

import datetime as _dt
from dataclasses import dataclass

from pyspark.sql import DataFrame, functions as F

from rewardloom.config import DEFAULT_SETTINGS, RUN_ID_FORMAT, Settings
from rewardloom.operators import clean as C, extract as E, rewards as R

NO_FEEDBACK, NOT_ENOUGH, READY = "no_feedback", "not_enough", "ready"


def status_expr(extracted, samples, min_samples: int):
    return (F.when(extracted == 0, F.lit(NO_FEEDBACK))
             .when(samples < F.lit(min_samples), F.lit(NOT_ENOUGH))
             .otherwise(F.lit(READY)))


def new_run_id(now: _dt.datetime | None = None) -> str:
    return (now or _dt.datetime.now(_dt.timezone.utc)).strftime(RUN_ID_FORMAT)


@dataclass
class Run:
    run_id: str
    samples: DataFrame      # lazy: question, answer, rating, reward (+ ids, seq)
    status: DataFrame       # one row: run_id, extracted, cleaned, samples, status
    feedback: DataFrame     # lazy extracted rows the two above derive from
    settings: Settings = DEFAULT_SETTINGS


def gate_counts(feedback: DataFrame, run_id: str,
                settings: Settings = DEFAULT_SETTINGS) -> DataFrame:
    """O2: one-row status from a single pass over the extracted rows."""
    ok = C.keep_after_cleaning()
    agg = feedback.agg(F.count(F.lit(1)).alias("extracted"), F.count_if(ok).alias("cleaned"))
    return agg.select(F.lit(run_id).alias("run_id"), "extracted", "cleaned",
                      F.col("cleaned").alias("samples"),
                      status_expr(F.col("extracted"), F.col("cleaned"),
                                  settings.min_feedback_samples).alias("status"))


def window_gates(feedback: DataFrame, days: list[int], as_of,
                 settings: Settings = DEFAULT_SETTINGS) -> DataFrame:
    """O2 for several ``days_back`` windows at once (0 = no cutoff): one
    aggregation with a conditional count per window, then one row each."""
    ok = C.keep_after_cleaning()
    as_of_c = E.as_of_col(as_of)
    aggs = []
    for i, d in enumerate(days):
        inside = (F.lit(True) if not d else
                  F.col("datetime") > as_of_c - F.make_dt_interval(F.lit(int(d))))
        inside = F.coalesce(inside, F.lit(False))
        aggs += [F.count_if(inside).alias(f"e{i}"), F.count_if(inside & ok).alias(f"c{i}")]
    wide = feedback.agg(*aggs)
    rows = F.array(*[F.struct(F.lit(int(d)).alias("days_back"), F.col(f"e{i}").alias("extracted"),
                              F.col(f"c{i}").alias("cleaned")) for i, d in enumerate(days)])
    out = wide.select(F.inline(rows))
    return out.select("days_back", "extracted", "cleaned", F.col("cleaned").alias("samples"),
                      status_expr(F.col("extracted"), F.col("cleaned"),
                                  settings.min_feedback_samples).alias("status"))


def feedback_run(chat: DataFrame, users: DataFrame, days_back: int | None = None, as_of=None,
                 settings: Settings = DEFAULT_SETTINGS, run_id: str | None = None) -> Run:
    """O1: the lazy run; nothing executes until the caller acts on it."""
    return run_of(E.extract_feedback(chat, users, days_back=days_back, as_of=as_of, sort=False), run_id, settings)


def run_of(fb: DataFrame, run_id: str | None = None, settings: Settings = DEFAULT_SETTINGS) -> Run:
    """O1 over feedback rows already extracted (such as the incremental job's)."""
    rid = run_id or new_run_id()
    samples = R.reward_samples(C.clean_feedback(fb), settings)
    return Run(rid, samples, gate_counts(fb, rid, settings), fb, settings)


def status_of(extracted: int, samples: int, min_samples: int) -> str:
    """``status_expr`` of counts that the driver has."""
    return NO_FEEDBACK if not extracted else NOT_ENOUGH if samples < min_samples else READY


SKETCH_BITS = 14      # 2^14 registers: a relative standard error of 0.8 %; a few thousand prompts are counted exactly


def card_metrics() -> list:
    """The card's aggregates over cleaned rows with reward, each mergeable: they need no shuffle of texts."""
    return [F.count(F.lit(1)).alias("rows"), F.sum("rating").alias("rating_sum"), F.min("rating").alias("min_rating"),
            F.max("rating").alias("max_rating"), F.sum("reward").alias("reward_sum"), F.max(F.unix_seconds("datetime")).alias("max_epoch"),
            F.hll_sketch_agg("question", SKETCH_BITS).alias("prompts_sketch")]


def execute_run(run: Run, sink_path: str | None = None, dry_run: bool = False) -> dict:
    """O2/O3: act on the gate.

    Dry run: only the one-row gate aggregate is computed; nothing is written.
    Real run: the extracted feedback rows are written ONCE to a staging folder
    in the shared directory (the only pass over the chat documents), each with the cleaning predicate's
    answer.  The gate reads that one boolean column and no text.  A ready run is cleaned, labelled and published
    from the staged rows as partition ``run_id`` of ``sink_path``; its card (S4), whose figures all merge
    without a shuffle of texts, is written next to it.  The staging folder is removed at the end.

    (``Observation`` on the write would save the boolean scan, but in this Spark a session that has observed once
    can't serialize a fitted logistic regression any more, so nothing here observes.)"""
    if dry_run or not sink_path:
        return run.status.first().asDict()
    from rewardloom.session import materialize, release
    from rewardloom.sources.snapshot import write_card, write_snapshot

    staged = materialize(run.feedback.withColumn("_clean", C.keep_after_cleaning()), f"run-{run.run_id}")
    extracted, cleaned = staged.agg(F.count(F.lit(1)), F.count_if("_clean")).first()
    st = {"run_id": run.run_id, "extracted": extracted, "cleaned": cleaned, "samples": cleaned,
          "status": status_of(extracted, cleaned, run.settings.min_feedback_samples)}
    if st["status"] == READY:
        clean = C.clean_feedback(staged.where("_clean").drop("_clean")).withColumn("reward", R.reward_expr("rating", run.settings))
        write_snapshot(R.reward_samples(clean, run.settings).drop("seq"), sink_path, run.run_id)
        write_card(finished_card(clean.agg(*card_metrics())).withColumn("run_id", F.lit(run.run_id)), sink_path, run.run_id)
        st["written"] = sink_path
    release(staged.sparkSession, staged)
    return st


def finished_card(figures: DataFrame) -> DataFrame:
    """``card_metrics`` with the card's own columns: distinct_prompts (an estimate beyond a few thousand), mean_rating, mean_reward."""
    return figures.withColumns({"distinct_prompts": F.hll_sketch_estimate("prompts_sketch"), "mean_rating": F.col("rating_sum") / F.col("rows"),
                                "mean_reward": F.col("reward_sum") / F.col("rows")})


def card_rollup(cards: DataFrame) -> DataFrame:
    """S4 over many runs: one row for all of ``cards`` (one row a run), without reading a sample again.  Sums add, sketches unite:
    prompts that several runs have count once."""
    whole = cards.agg(F.count(F.lit(1)).alias("runs"), F.sum("rows").alias("rows"), F.sum("rating_sum").alias("rating_sum"), F.min("min_rating").alias("min_rating"),
                      F.max("max_rating").alias("max_rating"), F.sum("reward_sum").alias("reward_sum"), F.max("max_epoch").alias("max_epoch"),
                      F.hll_union_agg("prompts_sketch").alias("prompts_sketch"))
    return finished_card(whole)


def run_due(cards: DataFrame, as_of, settings: Settings = DEFAULT_SETTINGS) -> bool:
    """The scheduler's question: is the newest published run at least ``run_interval_days`` old (or is there none)?  ``as_of`` is an
    aware datetime or epoch seconds; run ids that aren't times don't count."""
    at = F.try_to_timestamp(F.col("run_id").cast("string"), F.lit("yyyyMMdd_HHmmss"))
    newest = cards.agg(F.max(F.unix_seconds(at))).first()[0]
    now = int(as_of.timestamp()) if isinstance(as_of, _dt.datetime) else int(as_of)
    return newest is None or now - newest >= settings.run_interval_days * 86400


def dataset_card(samples: DataFrame, run_id: str) -> DataFrame:
    """One-row summary of a published sample set."""
    has_dt = "datetime" in samples.columns
    return samples.agg(
        F.lit(run_id).alias("run_id"),
        F.count(F.lit(1)).alias("rows"),
        F.count_distinct("question").alias("distinct_prompts"),
        F.avg("rating").alias("mean_rating"), F.min("rating").alias("min_rating"),
        F.max("rating").alias("max_rating"), F.avg("reward").alias("mean_reward"),
        (F.max(F.unix_seconds("datetime")) if has_dt else F.lit(None).cast("bigint")).alias("max_epoch"))
