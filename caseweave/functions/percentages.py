"""Column percentages with a total row."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _percent(value: Column, total: Column) -> Column:
    """Share in percent, two decimals, half to even; NULL for a zero total."""
    share = F.try_divide(value.cast("double"), total.cast("double")) * F.lit(100.0)
    return F.rint(share * F.lit(100.0)) / F.lit(100.0)


def percentage_convert(
    df: DataFrame,
    replace: bool = True,
    as_text: bool = False,
    order: Sequence[Column] = (),
    total_label: str = "Total",
) -> DataFrame:
    """Turn every numeric column of a finished report into percentages of its total.

    ``replace`` overwrites the column, otherwise ``percentage_<column>`` is
    added behind all columns. A total row closes the report; its label goes into the first
    non-numeric column. ``as_text`` writes '12.5%' instead of 12.5.
    """
    numeric = [f.name for f in df.schema if isinstance(f.dataType, T.NumericType)]
    labels = [f.name for f in df.schema if not isinstance(f.dataType, T.NumericType)]
    if not numeric:
        return df

    # The total row joins the report before the totals are summed, all by one window over
    # the rows of the finished report: it is read once, and one task then holds its groups.
    total_row = df.sparkSession.range(0, 1, 1, 1).select(
        *[
            F.lit(total_label if labels and f.name == labels[0] else None)
            .cast(f.dataType)
            .alias(f.name)
            for f in df.schema
        ],
        F.lit(True).alias("_total"),
    )
    everything = W.partitionBy()
    whole = df.withColumn("_total", F.lit(False)).unionByName(total_row)
    whole = whole.select(
        "*",
        *[F.sum(c).over(everything).alias(f"_sum_{c}") for c in numeric],
        *[F.when(~F.col("_total"), c).alias(f"_s{i}") for i, c in enumerate(order)],
    )
    sort_keys = ["_total", *[f"_s{i}" for i in range(len(order))]]
    ordered = whole.orderBy(*[F.col(s).asc_nulls_last() for s in sort_keys])

    def share(name: str) -> Column:
        value, total = F.col(name), F.col(f"_sum_{name}")
        part = _percent(value, total)
        if as_text:
            text = F.concat(part.cast("string"), F.lit("%"))
            return F.when(F.col("_total"), total.cast("string")).otherwise(text)
        return F.when(F.col("_total"), total.cast("double")).otherwise(part)

    def shown(name: str) -> Column:
        if name not in numeric:
            return F.col(name)
        if replace:
            return share(name)
        value = F.when(F.col("_total"), F.col(f"_sum_{name}")).otherwise(F.col(name))
        return value.cast("string") if as_text else value

    columns = [shown(f.name).alias(f.name) for f in df.schema]
    if not replace:
        columns += [share(name).alias(f"percentage_{name}") for name in numeric]
    return ordered.select(*columns)
