"""Grouping by text without regard to case, accents and trailing blanks.

Collated strings have no hash aggregate: they are sorted. So counts are made by plain
spelling first, and only what is left of them, a row per spelling and group (or per
spelling and person), is folded by collation. The shown spelling is the least one.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

COLLATION = "UNICODE_CI_AI_RTRIM"


def category_key(c: Column | str) -> Column:
    """What the spellings of one category share; of a collated type, to group by only."""
    return F.collate(c, COLLATION)


def folded(
    df: DataFrame,
    groups: Sequence[str],
    categories: Sequence[str],
    aggregates: Mapping[str, Column],
) -> DataFrame:
    """One row per group, where spellings of ``categories`` (some of the groups) are one.

    Columns keep their order, their names and plain string types.
    """
    keys = [category_key(g).alias(f"_k_{g}") if g in categories else F.col(g) for g in groups]
    shown = [F.min(c).alias(c) for c in categories]
    out = df.groupBy(*keys).agg(*shown, *[a.alias(n) for n, a in aggregates.items()])
    return out.select(*groups, *aggregates)
