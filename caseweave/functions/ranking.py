"""Row numbers per key without sending a whole key through one sort."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def numbered_rows(
    df: DataFrame, key: str, coarse: dict[str, Column], fine: Sequence[Column], name: str = "rn"
) -> DataFrame:
    """``row_number`` per key in the order (coarse..., fine...).

    ``coarse`` names the leading sort expressions, which must have few values
    per key (dates, yes/no). Rows are numbered inside (key, coarse) buckets;
    the bucket sizes, one row each, give the offset of every bucket.
    Sort direction: descending for coarse keys, NULLs last.
    """
    bucket_cols = [f"_b_{n}" for n in coarse]
    keyed = df.withColumns(dict(zip(bucket_cols, coarse.values(), strict=True)))
    sizes = keyed.groupBy(key, *bucket_cols).agg(F.count(F.lit(1)).alias("_size"))
    before = (
        W.partitionBy(key)
        .orderBy(*[F.col(b).desc_nulls_last() for b in bucket_cols])
        .rowsBetween(W.unboundedPreceding, -1)
    )
    offsets = sizes.select(
        F.col(key).alias("_k"),
        *[F.col(b).alias(f"{b}_k") for b in bucket_cols],
        F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_offset"),
    )
    inside = W.partitionBy(key, *bucket_cols).orderBy(*fine)
    placed = keyed.withColumn("_in", F.row_number().over(inside))
    match = F.col(key) == F.col("_k")
    for b in bucket_cols:
        match = match & F.col(b).eqNullSafe(F.col(f"{b}_k"))
    return placed.join(offsets, match, "inner").select(
        *df.columns, (F.col("_offset") + F.col("_in")).cast("int").alias(name)
    )
