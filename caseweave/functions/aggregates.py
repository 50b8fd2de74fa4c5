"""Aggregations that stay safe when one key holds a large share of the rows.

Every helper has map-side partials, so a hot key is reduced where it is read instead
of being shipped whole to one task. Counts and dates are hash aggregates; extremes of
texts and of structs are sort aggregates, which sort the input of a task by key first.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from caseweave.functions.categories import folded
from caseweave.functions.matching import flag


def distinct_flags(
    df: DataFrame,
    groups: Sequence[str],
    key: str,
    flags: dict[str, Column],
    categories: Sequence[str] = (),
) -> DataFrame:
    """``COUNT(DISTINCT key)`` under several conditions at once.

    Two aggregation levels instead of one Expand copy of the input per
    condition: flags are folded per (groups, key), then counted per group.
    Groups whose keys are all NULL stay, with zero counts. Spellings of the groups in
    ``categories`` are one, also where one key has several of them.
    """
    has_key = F.col(key).isNotNull()
    per_key = df.groupBy(*groups, key).agg(
        *[F.max(flag(cond & has_key)).alias(name) for name, cond in flags.items()]
    )
    counts = {name: F.count(name) for name in flags}
    if not categories:
        return per_key.groupBy(*groups).agg(*[c.alias(name) for name, c in counts.items()])
    per_key = folded(per_key, [*groups, key], categories, {name: F.max(name) for name in flags})
    return folded(per_key, groups, categories, counts)


def concat_distinct(c: Column | str, sep: str) -> Column:
    """Distinct non-null values in order, joined by ``sep``; NULL if there are none."""
    values = F.collect_set(c)
    return F.when(F.size(values) > 0, F.concat_ws(sep, F.array_sort(values)))


def latest_rows(df: DataFrame, key: str, date: str, among: DataFrame | None = None) -> DataFrame:
    """Rows dated at their key's latest date, of the keys in ``among``; ties are kept.

    The latest date is a partial aggregate. The semi-join hashes on (key,
    date), which spreads the rows of one busy key over its dates.
    """
    edge = df.where(F.col(key).isNotNull()).groupBy(key).agg(F.max(date).alias(date))
    if among is not None:
        edge = edge.join(among, key, "left_semi")
    return df.join(edge, [key, date], "left_semi")


def best_row(df: DataFrame, key: str, order: Sequence[Column]) -> DataFrame:
    """The row per key that sorts highest: a max over structs, one row per key and task
    before the shuffle."""
    payload = [c for c in df.columns if c != key]
    ranked = F.struct(
        *[c.alias(f"_o{i}") for i, c in enumerate(order)], F.struct(*payload).alias("_row")
    )
    return df.groupBy(key).agg(F.max(ranked).alias("_best")).select(key, "_best._row.*")


def rank_of(c: Column | str, values: Sequence[str]) -> Column:
    """Position of a value in a fixed order; NULL when it is not listed."""
    col = F.lower(F.col(c) if isinstance(c, str) else c)
    out = F.lit(None).cast("int")
    for i, v in reversed(list(enumerate(values, start=1))):
        out = F.when(col == v.lower(), F.lit(i)).otherwise(out)
    return out


def order_by_rank(
    df: DataFrame,
    c: str,
    values: Sequence[str],
    nulls_first: bool = False,
    then: Sequence[str] = (),
) -> DataFrame:
    """Sort a finished report by a fixed value order, other values last, NULL last or first.

    ``then`` are columns that order rows of one value.
    """
    null = F.col(c).isNotNull() if nulls_first else F.col(c).isNull()
    return df.orderBy(null, rank_of(c, values).asc_nulls_last(), F.col(c).asc_nulls_last(), *then)
