"""Text expressions with Python's notion of white space; the one place that knows regular-expression dialects."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

#: White space as a class's body, as characters, so that Java and RE2 read it alike.
SPACE = "\t-\r\x1c-\x20\x85\u00a0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"


def as_column(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once, however often the body names it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def strip(c: Column | str) -> Column:
    return F.regexp_replace(as_column(c), f"^[{SPACE}]+|[{SPACE}]+$", "")


def words(c: Column | str) -> Column:
    """The words of a text: runs of anything but white space."""
    return F.filter(F.split(as_column(c), f"[{SPACE}]+"), lambda w: w != "")


def word_count(c: Column | str) -> Column:
    return F.size(words(c)).cast("long")


def estimate_tokens(c: Column | str, factor: float = 1.3) -> Column:
    """Words times a factor, rounded down; null text has none."""
    return F.floor(F.coalesce(word_count(c), F.lit(0)) * F.lit(factor)).cast("long")


def blank_to_null(c: Column | str) -> Column:
    return let(strip(c), lambda s: F.when(s != "", s))


def year_of(c: Column | str) -> Column:
    """The first year from 1000 to 2099 that stands alone."""
    return F.regexp_extract(as_column(c), r"(?U)\b(1[0-9]{3}|20[0-9]{2})\b", 1).try_cast("int")


def contains_any(c: Column, needles: tuple[str, ...]) -> Column:
    found = F.lit(False)
    for n in needles:
        found |= c.contains(n)
    return found
