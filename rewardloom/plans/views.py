"""SQL access: register the main operator outputs as temporary views so the
extraction can be queried with ``spark.sql`` the way the source pipeline's
users queried their database.  Views are lazy plans over the given tables."""

from __future__ import annotations

from pyspark.sql import DataFrame

from rewardloom.operators import clean as C, extract as E, rewards as R

VIEWS = ("feedback", "unrated", "clean_feedback", "samples", "reward_table")


def register_views(chat: DataFrame, users: DataFrame, prefix: str = "") -> list[str]:
    feedback = E.extract_feedback(chat, users, sort=False)
    clean = C.clean_feedback(feedback)
    samples = R.reward_samples(clean)
    frames = {
        "feedback": feedback.drop("seq"),
        "unrated": E.unrated_rows(chat, users).drop("seq"),
        "clean_feedback": clean.drop("seq"),
        "samples": samples.drop("seq"),
        "reward_table": R.build_reward_cache(samples),
    }
    names = []
    for name in VIEWS:
        frames[name].createOrReplaceTempView(prefix + name)
        names.append(prefix + name)
    return names
