"""Column-expression helpers (all JVM-side built-ins, codegen friendly)."""

from rewardloom.functions.text import (ustrip, is_blank, reward_key, coerce_numeric,
                                       corpus_tokens, qa_text)
from rewardloom.functions.jsonx import has_key
from rewardloom.functions.order import seq_col, epoch_col

__all__ = ["ustrip", "is_blank", "reward_key", "coerce_numeric", "corpus_tokens", "qa_text",
           "has_key", "seq_col", "epoch_col"]
