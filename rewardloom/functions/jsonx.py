"""JSON helpers that keep JSON null apart from an absent key."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def has_key(raw_json, key: str) -> Column:
    """True when the JSON object text has ``key`` (even with a JSON null
    value); False for absent keys, non-objects and unparsable text."""
    raw = F.col(raw_json) if isinstance(raw_json, str) else raw_json
    return F.coalesce(F.array_contains(F.json_object_keys(raw), F.lit(key)), F.lit(False))
