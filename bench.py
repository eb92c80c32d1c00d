"""Benchmark: run the headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS].

Each query is executed in full through the ``noop`` sink (every row produced,
nothing collected to the driver), once, after an untimed warm-up pass of all
queries on the smallest test input.  The input tables that Spark derives once
(chats as JSON, rated answers, prompts) are built first, in a step of their
own that is timed apart (``staging``).  Prints ONE JSON line on stdout.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "extract_feedback", "extract_unrated", "extract_profile", "recent_feedback",
    "clean_feedback", "rating_histogram", "reward_samples", "unique_questions",
    "reward_cache", "compute_rewards", "cache_hit_rate", "batch_mean_reward",
    "prompt_vocab", "tokenize_prompts", "left_pad_batches", "decode_responses",
    "preference_pairs", "pair_eval", "feedback_run", "run_status", "dataset_card",
    "snapshot_roundtrip", "stream_extract", "stream_reward_cache", "score_batch",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    only = [q for q in os.environ.get("BENCH_QUERIES", "").split(",") if q]
    from rewardloom.session import local_session
    from rewardloom.plans import QUERIES, inputs

    n_cpu = int(cpus) if cpus.isdigit() else os.cpu_count() or 8
    spark = local_session(cpus, shuffle_partitions=max(8, 2 * n_cpu), app="rewardloom-bench")
    # warm-up (not timed): every query once on the smallest input, so the
    # timed pass measures the work at the target scale rather than JIT,
    # class loading and code generation of first use
    warm_dir = os.environ.get("BENCH_WARM_DIR", "/root/testdata/sf0.001")
    if not os.path.isdir(warm_dir):
        warm_dir = sf_dir
    for name in only or HEADLINE:
        QUERIES[name](spark, warm_dir).write.format("noop").mode("overwrite").save()
    t0 = time.perf_counter()
    inputs.chat_path(spark, sf_dir)
    inputs.rated_base(spark, sf_dir)
    inputs.prompts(spark, sf_dir)
    staging = round(time.perf_counter() - t0, 3)

    times: dict[str, float] = {}
    for name in only or HEADLINE:
        t0 = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - t0, 3)
        print(f"{name}: {times[name]:.3f}s", file=sys.stderr, flush=True)
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    print(json.dumps({"metric": "total_query_seconds", "value": round(sum(times.values()), 3),
                      "unit": "sec", "queries": times, "staging": staging, "sf": sf, "cpus": cpus}))
    spark.stop()


if __name__ == "__main__":
    main()
