"""A2J reports over the A2J cohort (``classify.a2j_cohort``); all rows are listed.

A person may have very many listed rows as well as very many facts, so both sides of
these joins are dealt.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from caseweave.functions.dates import ReportWindow
from caseweave.functions.joins import HotKeys, hot_keys, spread_join
from caseweave.operators.cohort import PID, AnyCohort, as_cohort

Q = AnyCohort | DataFrame


def _listed(facts: DataFrame, people: DataFrame, hot: HotKeys | None) -> DataFrame:
    return spread_join(facts, people, PID, hot=hot, other_hot=hot_keys(people, PID))


def a2j_cases(
    cohort: Q,
    legal: DataFrame,
    window: ReportWindow,
    started_ended: str = "started",
    hot: HotKeys | None = None,
) -> DataFrame:
    """Cases that started or ended in the window."""
    date = "arrest_date" if started_ended.lower() == "started" else "case_outcome_date"
    people = as_cohort(cohort).rows()
    # the id tells equal cases apart when they are dealt
    cases = legal.where(window.has(date)).select(
        PID, "case_id", "offense_date", "case_outcome_date", "case_outcome", "sentence"
    )
    return _listed(cases, people, hot).select(
        *people.columns, "offense_date", "case_outcome_date", "case_outcome", "sentence"
    )


def a2j_linkages(
    cohort: Q, linkages: DataFrame, window: ReportWindow, hot: HotKeys | None = None
) -> DataFrame:
    """Linkages made in the window."""
    people = as_cohort(cohort).rows()
    links = linkages.where(window.has("linked_date")).select(
        PID, "linkage_id", "linkage_type", "linkage_org", "goal_area"
    )
    return _listed(links, people, hot).select(
        *people.columns, "linkage_type", "linkage_org", "goal_area"
    )
