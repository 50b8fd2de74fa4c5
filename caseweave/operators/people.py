"""Counting cohort participants that have matching rows elsewhere."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from caseweave.functions.categories import folded
from caseweave.operators.cohort import PID, AnyCohort, as_cohort


def count_people_with(
    cohort: AnyCohort | DataFrame, facts: DataFrame, name: str = "n_participants"
) -> DataFrame:
    """One row: cohort participants with at least one row in ``facts``.

    Both sides are cut to distinct ids before they meet.
    """
    ids = facts.select(PID).distinct()
    return as_cohort(cohort).people().join(ids, PID, "left_semi").agg(F.count(PID).alias(name))


def count_people(cohort: AnyCohort | DataFrame, name: str = "n_participants") -> DataFrame:
    return as_cohort(cohort).people().agg(F.count(PID).alias(name))


def count_by(
    df: DataFrame, *groups: str, name: str = "n_participants", categories: Sequence[str] = ()
) -> DataFrame:
    """Participants per group of a table with distinct (participant, groups) rows.

    Spellings of the groups in ``categories`` are one; a participant has one of them."""
    counts = df.groupBy(*groups).agg(F.count(PID).alias(name))
    return folded(counts, groups, categories, {name: F.sum(name)}) if categories else counts


def weighted_rows(value: Column, weight: Column) -> Column:
    """Number of rows with a non-null value when each row stands for ``weight`` rows."""
    return F.coalesce(F.sum(F.when(value.isNotNull(), weight)), F.lit(0).cast("bigint"))
