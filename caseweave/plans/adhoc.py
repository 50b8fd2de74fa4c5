"""Ad-hoc SQL over the cohort and the source tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession

from caseweave.plans.context import ReportContext
from caseweave.sources.schemas import SCHEMAS


def register_views(
    ctx: ReportContext, prefix: str = "", sources: Sequence[str] = tuple(SCHEMAS)
) -> list[str]:
    """Register ``cohort`` and the source tables as temporary views."""
    ctx.cohort.rows().createOrReplaceTempView(f"{prefix}cohort")
    for name in sources:
        ctx.sources[name].createOrReplaceTempView(f"{prefix}{name}")
    return [f"{prefix}cohort", *[f"{prefix}{n}" for n in sources]]


def query_run(
    spark: SparkSession, query: str, args: Mapping[str, object] | None = None
) -> DataFrame:
    """Run SQL over the registered views; values are bound as parameters (``:name``)."""
    return spark.sql(query, args=dict(args or {}))


def query_modify(rows: DataFrame, *conditions: Column) -> DataFrame:
    """Narrow the input of a query before it aggregates.

    Use as ``query(cohort.rows().transform(query_modify, condition))``: each
    query takes its cohort and sources as arguments, so further conditions are
    filters on those.
    """
    for condition in conditions:
        rows = rows.where(condition)
    return rows
