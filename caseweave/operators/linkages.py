"""Linkage (referral) reports."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from caseweave import fixed_values as fv
from caseweave.functions.categories import folded
from caseweave.functions.dates import ReportWindow, add_years
from caseweave.functions.matching import ci_eq
from caseweave.operators.cohort import PID, AnyCohort, as_cohort
from caseweave.operators.people import count_by, count_people_with

Q = AnyCohort | DataFrame


def _dated(window: ReportWindow, started_linked: str) -> Column:
    which = started_linked.lower()
    if which == "both":
        return window.has("linked_date") | window.has("start_date")
    if which not in ("linked_date", "start_date"):
        raise ValueError(f"unknown linkage date {started_linked!r}")
    return window.has(which)


def _kept(
    linkages: DataFrame,
    window: ReportWindow,
    hub_initiated: bool,
    timeframe: bool,
    started_linked: str,
) -> DataFrame:
    out = linkages.where(ci_eq("hub_initiated", "yes")) if hub_initiated else linkages
    return out.where(_dated(window, started_linked)) if timeframe else out


def link_tally(
    cohort: Q,
    linkages: DataFrame,
    window: ReportWindow,
    hub_initiated: bool = True,
    timeframe: bool = False,
    started_linked: str = "linked_date",
) -> DataFrame:
    """Participants with at least one linkage."""
    kept = _kept(linkages, window, hub_initiated, timeframe, started_linked)
    return count_people_with(cohort, kept)


def link_edu_job(
    cohort: Q,
    linkages: DataFrame,
    participants: DataFrame,
    window: ReportWindow,
    link_type: str = "education",
    hub_initiated: bool = True,
    age: int = 19,
    cutoff: str | dt.date = "t1",
    first_n_months: float | None = None,
) -> DataFrame:
    """Participants below (education) or above (employment) an age with a later linkage.

    Without a month limit, some linkage follows some episode start exactly when
    the last linkage follows the first start. With a limit, each linkage date
    is compared with the latest start before it; both kinds of dates are
    distinct per participant and read in date order.
    """
    birthday = add_years("birth_date", age)
    at = F.col("_at")
    sides = {"education": at < birthday, "employment": at > birthday}
    if link_type.lower() not in sides:
        raise ValueError(f"unknown link type {link_type!r}")
    starts = (
        as_cohort(cohort)
        .with_episode(_at=window.cutoff(cutoff))
        .distinct(episode=["active_date", "_at"])
        .join(participants.select(PID, "birth_date"), PID)
        .where(sides[link_type.lower()])
        .select(PID, "active_date")
    )
    links = linkages.where(ci_eq("linkage_type", link_type) & F.col("linked_date").isNotNull())
    if hub_initiated:
        links = links.where(ci_eq("hub_initiated", "yes"))

    if first_n_months is None:
        first = starts.groupBy(PID).agg(F.min("active_date").alias("first"))
        last = links.groupBy(PID).agg(F.max("linked_date").alias("last"))
        hits = first.join(last, PID).where(F.col("last") > F.col("first"))
        return hits.agg(F.count(PID).alias("n_participants"))

    started, linked = F.col("started"), F.col("linked")
    dates = (
        starts.select(PID, F.col("active_date").alias("day"), F.lit(1).alias("s"))
        .unionByName(links.select(PID, F.col("linked_date").alias("day"), F.lit(0).alias("s")))
        .groupBy(PID, "day")
        .agg(F.max("s").alias("started"), F.min("s").alias("linked_min"))
        .select(PID, "day", "started", (1 - F.col("linked_min")).alias("linked"))
    )
    earlier = W.partitionBy(PID).orderBy("day").rowsBetween(W.unboundedPreceding, -1)
    before = F.max(F.when(started == 1, F.col("day"))).over(earlier)
    near = F.datediff(F.col("day"), F.col("before")) <= first_n_months * fv.DAYS_PER_MONTH
    hits = dates.withColumn("before", before).where((linked == 1) & near)
    return hits.select(PID).distinct().agg(F.count(PID).alias("n_participants"))


def split_areas(goal_area: Column | str) -> Column:
    """The pieces of a goal-area list, separated by comma and space."""
    return F.explode(F.split(goal_area, ", "))


def link_goal_area(
    cohort: Q,
    linkages: DataFrame,
    window: ReportWindow,
    hub_initiated: bool = True,
    timeframe: bool = True,
    started_linked: str = "linked_date",
) -> DataFrame:
    """Participants per linked goal area."""
    kept = _kept(linkages, window, hub_initiated, timeframe, started_linked)
    pairs = kept.select(PID, split_areas("goal_area").alias("separated_area")).distinct()
    # spellings of one person first, where they are together; then those of all
    areas = folded(
        pairs.join(as_cohort(cohort).people(), PID, "left_semi"),
        [PID, "separated_area"],
        ["separated_area"],
        {},
    )
    return count_by(areas, "separated_area", categories=["separated_area"])
