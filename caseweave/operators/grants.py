"""Grant, incident and mediation tallies."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from caseweave.functions.dates import ReportWindow
from caseweave.functions.matching import ci_contains, flag, is_true
from caseweave.operators.cohort import AnyCohort, as_cohort
from caseweave.operators.people import count_by


def grant_tally(
    cohort: AnyCohort | DataFrame, window: ReportWindow, start_end: str | None = None
) -> DataFrame:
    """Participants per grant; 'start_date' or 'end_date' keeps those who began or
    ended the grant or the episode in the window."""
    c = as_cohort(cohort)
    if start_end is None:
        return count_by(c.distinct(service=["grant_type"]), "grant_type")
    own = {"start_date": "active_date", "end_date": "closed_date"}[start_end]
    pairs = (
        c.with_episode(_episode_in=is_true(window.has(own)))
        .with_service(_grant_in=is_true(window.has(start_end)))
        .distinct(episode=["_episode_in"], service=["grant_type", "_grant_in"])
    )
    hits = pairs.where(F.col("_episode_in") | F.col("_grant_in"))
    return count_by(hits.select("participant_id", "grant_type").distinct(), "grant_type")


def _cpic() -> Column:
    return ci_contains("how_hear", "CPIC")


def incident_tally(incidents: DataFrame, window: ReportWindow) -> DataFrame:
    """Incidents in the window by way of notification; unknown ways count in neither."""
    known = F.col("incident_id").isNotNull()
    return incidents.where(window.has("date_incident")).agg(
        F.count(flag(_cpic() & known)).alias("cpic"),
        F.count(flag(~_cpic() & known)).alias("non_cpic"),
    )


def incidents_cpic(incidents: DataFrame, window: ReportWindow) -> DataFrame:
    """Notified incidents by type: with and without deaths."""
    known = F.col("incident_id").isNotNull()
    return (
        incidents.where(_cpic() & window.has("date_incident"))
        .groupBy("type_incident")
        .agg(
            F.count(flag((F.col("num_deceased") > 0) & known)).alias("fatal"),
            F.count(flag((F.col("num_deceased") == 0) & known)).alias("non_fatal"),
        )
    )


def incidents_non_cpic(incidents: DataFrame, window: ReportWindow) -> DataFrame:
    """Other incidents by way of notification."""
    return (
        incidents.where(window.has("date_incident") & ~_cpic())
        .groupBy("how_hear")
        .agg(F.count("incident_id").alias("n"))
    )


def mediation_tally(
    mediations: DataFrame, followups: DataFrame, window: ReportWindow, followup: bool = False
) -> DataFrame:
    """Mediations or follow-ups in the window by outcome; a missing outcome counts 0."""
    source, date = (
        (followups, "date_session") if followup else (mediations, "date_start_mediation")
    )
    return (
        source.where(window.has(date))
        .groupBy("outcome_mediation")
        .agg(F.count("outcome_mediation").alias("n"))
    )


def mediation_time_spent(mediations: DataFrame, window: ReportWindow) -> DataFrame:
    """Hours spent on mediations of conflicts in the window."""
    return mediations.where(window.has("date_conflict")).agg(
        F.sum("hours_spent_mediation").alias("hours")
    )
