"""String expressions: Unicode strip, numeric coercion, reward keys, tokens."""

from __future__ import annotations

from string import Formatter

from pyspark.sql import Column, functions as F

from rewardloom.config import KEY_SEPARATOR, KEY_SIDE_CHARS, QA_TEMPLATE, TOKEN_SPLIT_PATTERN, UNICODE_WS

# Java regex space class matching what a numeric parser tolerates around a number.
_SP = "[ \\t\\n\\x0B\\f\\r]*"
_NUMBER_RE = f"^{_SP}[+-]?([0-9]+[.]?[0-9]*|[.][0-9]+)([eE][+-]?[0-9]+)?{_SP}$"
_INF_RE = f"^{_SP}[+-]?inf(inity)?{_SP}$"


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def ustrip(c) -> Column:
    """``str.strip()``: remove all Unicode whitespace at both ends."""
    return F.btrim(_c(c), F.lit(UNICODE_WS))


def is_blank(c) -> Column:
    """True for empty-after-strip text; NULL input gives NULL."""
    return ustrip(c) == F.lit("")


def coerce_numeric(c) -> Column:
    """``pandas.to_numeric(errors='coerce')`` for text: decimal/scientific
    numbers and literal infinities parse; anything else (including overflow,
    'nan', '4d', '0x10', '1,000') is NULL."""
    c = _c(c)
    as_double = c.try_cast("double")
    finite = F.when(F.abs(as_double) != F.lit(float("inf")), as_double)
    return (F.when(c.rlike(_NUMBER_RE), finite)
             .when(F.lower(c).rlike(_INF_RE), as_double))


def reward_key(question, answer) -> Column:
    """strip -> lower -> first 200 code points of each side, joined by '|||'."""
    def side(x):
        return F.substring(F.lower(ustrip(x)), 1, KEY_SIDE_CHARS)
    return F.concat(side(_c(question)), F.lit(KEY_SEPARATOR), side(_c(answer)))


def corpus_tokens(c, most: int | None = None) -> Column:
    """Whitespace tokens of a text (no empty tokens), or its first ``most``.  A stripped text begins and ends with a token, so
    only a blank one gives an empty string and the split may stop behind the last token wanted."""
    if most is None:
        return F.filter(F.split(ustrip(c), TOKEN_SPLIT_PATTERN), lambda t: t != F.lit(""))
    return F.filter(F.slice(F.split(ustrip(c), TOKEN_SPLIT_PATTERN, most + 1), 1, most), lambda t: t != F.lit(""))


def qa_text(question, answer, template: str = QA_TEMPLATE) -> Column:
    """The scorer's input: ``template`` with {question} and {answer} filled
    in, each any number of times; a missing side renders as ``None``, as
    Python string formatting does."""
    sides = {"question": F.coalesce(_c(question), F.lit("None")), "answer": F.coalesce(_c(answer), F.lit("None"))}
    parts = []
    for literal, field, spec, conversion in Formatter().parse(template):
        if literal:
            parts.append(F.lit(literal))
        if field is not None:
            if field not in sides or spec or conversion:
                raise ValueError(f"template field {{{field}}}: only {{question}} and {{answer}}")
            parts.append(sides[field])
    return F.concat(*parts) if parts else F.lit("")
