"""Run settings (frozen) and fixed values that must equal the source system's.

Settings are plain values resolved on the driver; executors never read the
environment.
"""

from __future__ import annotations

from dataclasses import dataclass, field

# ---------------------------------------------------------------------------
# Fixed values (must match the behaviour being reproduced)
# ---------------------------------------------------------------------------
# Prompt template used when a (question, answer) pair is scored.
QA_TEMPLATE = "Câu hỏi: {question}\n\nTrả lời: {answer}"
RUN_ID_FORMAT = "%Y%m%d_%H%M%S"
# Separator between the question part and the answer part of a reward key.
KEY_SEPARATOR = "|||"
# Number of code points kept from each side of a reward key.
KEY_SIDE_CHARS = 200
# Special token ids of our corpus vocabulary.
PAD_ID, EOS_ID, UNK_ID = 0, 1, 2
SPECIAL_TOKENS = ("<pad>", "</s>", "<unk>")
# Whitespace run used by the corpus tokenizer (spelled out, no \s).
TOKEN_SPLIT_PATTERN = "[ \\t\\n\\r\\f\\x0B]+"

# The characters Python's ``str.strip()`` removes: every code point for which
# ``str.isspace()`` is true.  Derived from that rule (29 characters, all in the
# Basic Multilingual Plane below U+3001) rather than typed out.
UNICODE_WS = "".join(ch for ch in map(chr, range(0x3001)) if ch.isspace())


@dataclass(frozen=True)
class Settings:
    """Defaults mirror the source pipeline's configuration constants."""

    rating_min: float = 1.0
    rating_max: float = 5.0
    min_feedback_samples: int = 50
    run_interval_days: int = 7
    batch_size: int = 4
    unrated_limit: int = 1000
    prompt_max_tokens: int = 128
    scorer_max_tokens: int = 512
    test_share_buckets: int = 10        # bucket 0 of 10 -> ~10 % held out
    preview_rows: int = 3
    preview_chars: int = 80
    raw_preview_chars: int = 300
    batch_log_every: int = 10
    hashing_features: int = 256
    extra: dict = field(default_factory=dict, compare=False)

    def __post_init__(self):
        if self.rating_max == self.rating_min:
            raise ValueError("rating_max must differ from rating_min")

    @property
    def rating_mid(self) -> float:
        return (self.rating_min + self.rating_max) / 2.0


DEFAULT_SETTINGS = Settings()
