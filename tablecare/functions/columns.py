"""Column rules: each takes and returns a ``Column``.

All of them are built-in Catalyst expressions, so they stay inside whole-stage
codegen and work the same on batch and streaming DataFrames. Every parse is a
``try_*`` form: under ANSI mode one bad cell must give NULL, not fail the job.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values that must equal the reference for the same results.
# Date formats, tried in this order; the first that parses wins.
DATE_FORMATS = ("M/d/yy", "yyyy-MM-dd", "yyyy/MM/dd", "MMM d yyyy", "MM-dd-yyyy")
# Currency text removed before the cast: the characters "$" and ",", then "USD"
# followed by one whitespace character (case-sensitive).
CURRENCY_CHARS = r"[$,]"
CURRENCY_CODE = r"USD\s"
# Inclusive range accepted by the danger/risk level check.
LEVEL_RANGE = (1, 10)


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def trim_spaces(c: Column | str) -> Column:
    """Strip U+0020 at both ends (tabs and other whitespace stay)."""
    return F.trim(_c(c))


def blank_to_null(c: Column | str) -> Column:
    """A string that is empty after trimming becomes NULL; others are kept as is."""
    c = _c(c)
    return F.when(F.trim(c) == F.lit(""), F.lit(None)).otherwise(c)


def case_upper(c: Column | str) -> Column:
    return F.upper(_c(c))


def case_lower(c: Column | str) -> Column:
    return F.lower(_c(c))


def case_title(c: Column | str) -> Column:
    """First letter of each space-separated word upper, the rest lower."""
    return F.initcap(_c(c))


def clean_currency(c: Column | str, chars: str = CURRENCY_CHARS,
                   code: str = CURRENCY_CODE) -> Column:
    """Drop currency symbols and separators, then the currency code."""
    return F.regexp_replace(F.regexp_replace(_c(c), chars, ""), code, "")


def try_double(c: Column | str) -> Column:
    """Tolerant cast to double: text that is not a number gives NULL."""
    return _c(c).try_cast("double")


def try_int(c: Column | str) -> Column:
    """Tolerant cast to int: ``' 3 '`` -> 3, ``'3.0'``, ``'two'`` -> NULL."""
    return _c(c).try_cast("int")


def is_negative(c: Column | str) -> Column:
    """True when the value is below zero; NULL counts as not negative."""
    return F.coalesce(_c(c) < F.lit(0), F.lit(False))


def fix_negative(c: Column | str) -> Column:
    """Negative values become their absolute value; others (and NULL) are kept."""
    c = _c(c)
    return F.when(c < F.lit(0), c * F.lit(-1)).otherwise(c)


def _run_regex(letter: str, width: int) -> str | None:
    if letter == "y":
        return r"[+-]?[0-9]+"
    if letter in "Md":
        return r"[0-9]+" if (letter == "d" or width <= 2) else r"[A-Za-z]+"
    return None


def shape_guard(fmt: str) -> str | None:
    """A regex every string that ``fmt`` can parse must match, or None.

    Built from the pattern: year, month and day fields become digit runs (or
    letters for text months), other characters must appear literally. The
    guard is a superset of what the parser accepts, so putting it in front of
    the parse never changes a result; it only skips parses that would fail
    (each failed parse costs an exception). Patterns with other fields or
    quoted text get no guard.
    """
    out, i = ["^"], 0
    while i < len(fmt):
        ch = fmt[i]
        if ch.isalpha():
            j = i
            while j < len(fmt) and fmt[j] == ch:
                j += 1
            rx = _run_regex(ch, j - i)
            if rx is None:
                return None
            out.append(rx)
            i = j
        elif ch == "'":
            return None
        else:
            out.append(re.escape(ch))
            i += 1
    out.append("$")
    return "".join(out)


def parse_date(c: Column | str, formats: Sequence[str] = DATE_FORMATS) -> Column:
    """First format that parses wins; text no format accepts gives NULL."""
    c = _c(c)
    tries = []
    for f in formats:
        guard = shape_guard(f)
        parsed = F.try_to_date(c, f)
        tries.append(parsed if guard is None else F.when(c.rlike(guard), parsed))
    return F.coalesce(*tries)


def in_range(c: Column | str, low=LEVEL_RANGE[0], high=LEVEL_RANGE[1]) -> Column:
    """Keep values inside [low, high] (inclusive); outside or NULL gives NULL."""
    c = _c(c)
    return F.when(c.between(F.lit(low), F.lit(high)), c)


def any_null(columns: Sequence[str]) -> Column:
    """True when any of the columns is NULL; never NULL itself."""
    cond = F.lit(False)
    for name in columns:
        cond = cond | F.col(name).isNull()
    return cond


def all_not_null(columns: Sequence[str]) -> Column:
    cond = F.lit(True)
    for name in columns:
        cond = cond & F.col(name).isNotNull()
    return cond
