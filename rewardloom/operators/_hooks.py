"""Iterator pandas UDF factories for user-supplied per-task models.

The model is created once per task (not per row or per batch); rows arrive as
Arrow batches.  Only the model call itself runs in Python."""

from __future__ import annotations

from typing import Iterator

import pandas as pd
from pyspark.sql.functions import pandas_udf


def batch_score_udf(factory):
    @pandas_udf("double")
    def _score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        fn = factory()
        for texts in batches:
            yield pd.Series([float(x) for x in fn(texts.fillna("").tolist())], dtype="float64")
    return _score
