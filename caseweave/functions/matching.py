"""Case-insensitive predicates.

The data is matched without regard to case ('Casenote' = 'casenote'). The
predicates fold case; the columns keep their spelling and plain string type.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def ci_eq(c: Column | str, value: str) -> Column:
    return F.lower(_col(c)) == value.lower()


def ci_contains(c: Column | str, text: str) -> Column:
    """Substring test; cheaper than a regex of the same meaning."""
    return F.lower(_col(c)).contains(text.lower())


def ci_contains_any(c: Column | str, texts: list[str]) -> Column:
    return reduce(lambda a, b: a | b, [ci_contains(c, t) for t in texts])


def ci_starts(c: Column | str, text: str) -> Column:
    return F.lower(_col(c)).startswith(text.lower())


def ci_ends(c: Column | str, text: str) -> Column:
    return F.lower(_col(c)).endswith(text.lower())


def ci_rlike(c: Column | str, pattern: str) -> Column:
    """Unanchored regex match, case folded."""
    return _col(c).rlike("(?i)" + pattern)


def flag(condition: Column) -> Column:
    """1 where the condition is true, NULL (never 0) elsewhere."""
    return F.when(condition, F.lit(1))


def is_true(condition: Column) -> Column:
    """Two-valued form of a predicate: NULL becomes false."""
    return F.coalesce(condition, F.lit(False))
