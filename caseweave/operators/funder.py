"""Funder reports (JAC / IDHS) over the grant cohort (``classify.grant_cohort``)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from caseweave import fixed_values as fv
from caseweave.functions.aggregates import distinct_flags
from caseweave.functions.dates import ReportWindow, age_years
from caseweave.functions.categories import folded
from caseweave.functions.joins import HotKeys, spread_join
from caseweave.functions.matching import ci_contains, ci_eq, is_true
from caseweave.operators import sessions as sess
from caseweave.operators.cohort import PID, AnyCohort, as_cohort
from caseweave.operators.linkages import split_areas
from caseweave.operators.people import count_by, count_people, count_people_with, weighted_rows

Q = AnyCohort | DataFrame


def idhs_ages(cohort: Q, participants: DataFrame, ppr: bool = False) -> DataFrame:
    """New and continuing participants per age band at the start of service."""
    bands = fv.AGE_BANDS_PPR if ppr else fv.AGE_BANDS
    dates = as_cohort(cohort).distinct(episode=["new_client", "active_date"])
    aged = dates.join(participants.select(PID, "birth_date"), PID).withColumn(
        "_age", age_years("birth_date", "active_date")
    )
    return distinct_flags(
        aged, ["new_client"], PID, {n: F.col("_age").between(a, b) for n, a, b in bands}
    )


def idhs_tally(cohort: Q) -> DataFrame:
    """New and continuing participants."""
    return count_by(as_cohort(cohort).distinct(episode=["new_client"]), "new_client")


def idhs_tally_closed(cohort: Q, window: ReportWindow) -> DataFrame:
    """Participants whose grant or episode ended in the window."""
    pairs = (
        as_cohort(cohort)
        .with_episode(_closed=is_true(window.has("closed_date")))
        .with_service(_ended=is_true(window.has("end_date")))
        .distinct(episode=["_closed"], service=["_ended"])
    )
    hits = pairs.where(F.col("_closed") | F.col("_ended")).select(PID).distinct()
    return hits.agg(F.count(PID).alias("n_participants"))


def idhs_class_notes(
    cohort: Q,
    classes: DataFrame,
    window: ReportWindow,
    new: bool = False,
    class_text: str = fv.CLASS_TEXT,
    literal: bool = False,
    hot: HotKeys | None = None,
) -> DataFrame:
    """Words of the class notes of participants, with their number of occurrences.

    Words are runs of letters and digits of any alphabet. Spellings that differ in
    case are one word, shown as the first of them; ``literal`` keeps them apart.
    ``class_text`` is what the names of the classes hold.
    """
    c = as_cohort(cohort)
    people = (c.where_service(F.col("start_date") > window.start) if new else c).people()
    enrolled = classes.where(
        ci_contains("class", class_text)
        & (F.col("unenroll_date").isNull() | window.has("unenroll_date"))
    )
    words = F.explode(F.regexp_extract_all("summary_note", F.lit(r"[\p{L}\p{N}]+"), F.lit(0)))
    spellings = (
        spread_join(enrolled, people, PID, hot=hot)
        .select(words.alias("acronym"))
        .groupBy("acronym")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    if literal:
        return spellings
    folded = spellings.groupBy(F.lower("acronym").alias("_word"))
    return folded.agg(F.min("acronym").alias("acronym"), F.sum("n").alias("n")).drop("_word")


def idhs_race_gender(cohort: Q, participants: DataFrame, race_gender: str = "race") -> DataFrame:
    """Cohort rows (not participants) by new client and race or gender; unknown counts 0."""
    rows = as_cohort(cohort).row_counts(["new_client"])
    known = rows.join(participants.select(PID, race_gender), PID)
    counts = known.groupBy("new_client", race_gender).agg(
        weighted_rows(F.col(race_gender), F.col("n_rows")).alias("n")
    )
    return folded(counts, ["new_client", race_gender], [race_gender], {"n": F.sum("n")})


def idhs_language(cohort: Q, participants: DataFrame) -> DataFrame:
    """New and continuing participants by primary language."""
    people = as_cohort(cohort).distinct(episode=["new_client"])
    known = people.join(participants.select(PID, "language_primary"), PID)
    return count_by(known, "new_client", "language_primary", categories=["language_primary"])


def idhs_service_tally(cohort: Q, program: str = "idhs") -> DataFrame:
    """New and continuing participants by service of the program."""
    services = {"outreach": "Outreach", "cm": "Case", "legal": "Legal"}
    flags = {
        n: ci_contains("program_type", f"{program} - {text}") for n, text in services.items()
    }
    per_person = as_cohort(cohort).person_flags(flags, ["new_client"])
    return per_person.groupBy("new_client").agg(*[F.count(n).alias(n) for n in flags])


def idhs_linkages(
    cohort: Q, linkages: DataFrame, window: ReportWindow, program: str = "idhs"
) -> DataFrame:
    """Hub linkages of case-managed participants in the window, by goal area."""
    managed = (
        as_cohort(cohort)
        .where_service(ci_contains("program_type", f"{program} - case"))
        .distinct(episode=["new_client"])
    )
    links = linkages.where(
        ci_eq("hub_initiated", "Yes")
        & window.has("linked_date")
        & F.col("goal_area").isNotNull()
    ).select(PID, "linkage_id", "goal_area")
    listed = links.join(managed, PID).select(
        "linkage_id", "new_client", split_areas("goal_area").alias("separated_area")
    )
    return distinct_flags(
        listed,
        ["separated_area"],
        "linkage_id",
        {
            "new_links": ci_eq("new_client", "new"),
            "cont_links": ci_eq("new_client", "continuing"),
        },
        categories=["separated_area"],
    )


def _managed(cohort: Q, program: str) -> DataFrame:
    wanted = ci_contains("program_type", f"{program} - Case Management")
    return as_cohort(cohort).where_service(wanted).people()


def jac_cm_hours(
    cohort: Q, case_sessions: DataFrame, window: ReportWindow, program: str = "jac"
) -> DataFrame:
    """Average over participants of their case-management hours in the window."""
    per_person = (
        case_sessions.where(sess.in_scope("cm", window))
        .groupBy(PID)
        .agg(F.sum("hours").alias("hours"))
    )
    return per_person.join(_managed(cohort, program), PID, "left_semi").agg(
        F.avg("hours").alias("overall_avg")
    )


def jac_cm_sessions(
    cohort: Q, case_sessions: DataFrame, window: ReportWindow, program: str = "jac"
) -> DataFrame:
    """Successful sessions per participant with at least one."""
    kept = case_sessions.where(sess.in_scope("cm", window) & sess.successful()).select(
        PID, "case_session_id"
    )
    served = kept.join(_managed(cohort, program), PID)
    n_sessions = F.countDistinct("case_session_id").cast("double")
    n_people = F.countDistinct(PID).cast("double")
    return served.agg(F.try_divide(n_sessions, n_people).alias("avg_sessions"))


def jac_transpo_assist(cohort: Q) -> DataFrame:
    """Participants of a JAC program with transport support."""
    wanted = ci_contains("program_type", "JAC") & (F.col("crws") == 1)
    return count_people(as_cohort(cohort).where_service(wanted))


def jac_linked_participant_tally(cohort: Q, linkages: DataFrame) -> DataFrame:
    """Participants with a started linkage."""
    return count_people_with(cohort, linkages.where(F.col("start_date").isNotNull()))
