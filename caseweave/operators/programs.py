"""Program, service and session reports."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from caseweave import fixed_values as fv
from caseweave.functions.aggregates import distinct_flags, order_by_rank
from caseweave.functions.categories import folded
from caseweave.functions.dates import ReportWindow
from caseweave.functions.matching import ci_contains, ci_ends, ci_eq
from caseweave.functions.percentages import percentage_convert
from caseweave.operators import sessions as sess
from caseweave.operators.classify import juvenile_at
from caseweave.operators.cohort import PID, AnyCohort, as_cohort
from caseweave.operators.people import count_people, count_people_with, weighted_rows

Q = AnyCohort | DataFrame


def programs_packages(cohort: Q) -> DataFrame:
    """Participants per combination of services, with their share."""
    flags = {name: F.col(name) == 1 for name, _ in fv.PACKAGE_LABELS}
    any_service = reduce(lambda a, b: a | b, [F.col(n).isNotNull() for n in flags])
    label = F.concat_ws(
        " + ", *[F.when(F.col(n) == 1, F.lit(text)) for n, text in fv.PACKAGE_LABELS]
    )
    per_person = as_cohort(cohort).person_flags(flags).where(any_service)
    counts = per_person.groupBy(label.alias("concatenated_services")).agg(
        F.count(F.lit(1)).alias("n")
    )
    total = counts.agg(F.sum("n").alias("total")).scalar()
    return counts.withColumn("percentage", F.col("n") / total).orderBy(
        F.col("n").desc(), "concatenated_services"
    )


def outreach_tally(cohort: Q) -> DataFrame:
    """Participants of an outreach program."""
    return count_people(as_cohort(cohort).where_service(ci_contains("program_type", "outreach")))


def programs_service_tally(cohort: Q, service_column: str) -> DataFrame:
    """Participants with a service flag set, or of outreach."""
    if service_column.lower() == "outreach":
        return outreach_tally(cohort)
    c = as_cohort(cohort)
    if service_column not in c.columns:
        raise ValueError(f"cohort has no column {service_column!r}")
    return count_people(c.where_service(F.col(service_column) == 1))


def programs_sessions(
    cohort: Q,
    case_sessions: DataFrame,
    window: ReportWindow,
    timeframe: bool = True,
    cm_outreach: str = "cm",
) -> DataFrame:
    """Participants with at least one session."""
    kept = case_sessions.where(sess.in_scope(cm_outreach, window if timeframe else None))
    return count_people_with(cohort, kept)


def programs_session_tally(
    cohort: Q, case_sessions: DataFrame, window: ReportWindow, cm_outreach: str = "cm"
) -> DataFrame:
    """Distinct failed and successful sessions in the window."""
    kept = case_sessions.where(sess.in_scope(cm_outreach, window)).select(
        PID, "case_session_id", "hours", "indirect_type"
    )
    served = kept.join(as_cohort(cohort).people(), PID)
    return distinct_flags(
        served,
        [],
        "case_session_id",
        {"unsuccessful": sess.unsuccessful(), "successful": sess.successful()},
    )


def program_flags() -> dict[str, Column]:
    """Program columns of the grouped reports."""
    grant = F.col("grant_type")
    return {
        "hd": F.col("hd") == 1,
        "juv_div": F.col("cm_juv_divert") == 1,
        "rjcc": F.col("rjcc") == 1,
        "scan": F.col("cm_scan") == 1,
        "jac": ci_contains(grant, fv.JAC_TEXT),
        "idhs": (F.col("vp") == 1) & ci_contains(grant, fv.IDHS_TEXT),
    }


def grant_flags() -> dict[str, Column]:
    return {name: ci_contains("grant_type", text) for name, text in fv.GRANT_COLUMNS}


def programs_by_demographic(
    cohort: Q,
    participants: DataFrame,
    window: ReportWindow,
    demographic: str = "race",
    percentages: bool = False,
) -> DataFrame:
    """Participants per program by age, race or gender."""
    if demographic not in ("age", "race", "gender"):
        raise ValueError(f"unknown demographic {demographic!r}")
    flags = program_flags()
    per_person = as_cohort(cohort).person_flags(flags)
    value = juvenile_at(window) if demographic == "age" else F.col(demographic)
    people = participants.select(PID, value.alias(demographic))
    counts = (
        per_person.join(people, PID)
        .groupBy(demographic)
        .agg(*[F.count(name).alias(name) for name in flags])
    )
    if demographic != "age":
        counts = folded(counts, [demographic], [demographic], {n: F.sum(n) for n in flags})
    if percentages:
        return percentage_convert(counts, order=[F.col(demographic)])
    return counts


def _hours_band(contact: str) -> Column:
    reached = sess.reached(contact)
    hours = F.col("hours")
    band = F.when((hours == 0) | ci_eq(contact, fv.UNSUCCESSFUL), F.lit("0"))
    for label, above, up_to in fv.SESSION_LENGTH_BANDS:
        band = band.when((hours > above) & (hours <= up_to) & reached, F.lit(label))
    return band.when(hours > 2, F.lit("2+"))


def programs_session_length(
    cohort: Q,
    case_sessions: DataFrame,
    window: ReportWindow,
    cm_outreach: str = "cm",
    timeframe: bool = True,
) -> DataFrame:
    """Average session length in minutes, overall and for successful sessions.

    A session counts once per cohort row of its participant: sums per
    participant are weighted by the number of rows instead of repeating them.
    """
    kept = case_sessions.where(sess.in_scope(cm_outreach, window if timeframe else None))
    success_hours = F.when(sess.successful(), F.col("hours"))
    per_person = kept.groupBy(PID).agg(
        F.sum("hours").alias("h"),
        F.count("hours").alias("n"),
        F.sum(success_hours).alias("sh"),
        F.count(success_hours).alias("sn"),
    )
    weight = F.col("n_rows")
    return (
        per_person.join(as_cohort(cohort).row_counts(), PID)
        .agg(
            F.sum(F.col("h") * weight).alias("h"),
            F.sum(F.col("n") * weight).alias("n"),
            F.sum(F.col("sh") * weight).alias("sh"),
            F.sum(F.col("sn") * weight).alias("sn"),
        )
        .select(
            (F.try_divide("h", "n") * 60).alias("overall"),
            (F.try_divide("sh", "sn") * 60).alias("successful"),
        )
    )


def programs_session_length_grouped(
    cohort: Q,
    case_sessions: DataFrame,
    window: ReportWindow,
    cm_outreach: str = "cm",
    timeframe: bool = True,
) -> DataFrame:
    """Sessions per length band, counted once per cohort row of the participant."""
    kept = case_sessions.where(sess.in_scope(cm_outreach, window if timeframe else None))
    per_person = kept.groupBy(PID, _hours_band("contact_type").alias("session_length")).agg(
        F.count(F.lit(1)).alias("n")
    )
    counts = (
        per_person.join(as_cohort(cohort).row_counts(), PID)
        .groupBy("session_length")
        .agg(weighted_rows(F.col("session_length"), F.col("n") * F.col("n_rows")).alias("n"))
    )
    order = ["0", *[label for label, _, _ in fv.SESSION_LENGTH_BANDS], "2+"]
    return order_by_rank(counts, "session_length", order, nulls_first=True)


def programs_rct_neighborhoods(cohort: Q) -> DataFrame:
    """Participants of the RCT program, overall and per neighborhood partner."""
    program = F.col("program_type")
    flags = {
        "overall": ci_contains(program, "RCT"),
        "lawndale": ci_contains(program, "RCT,") | ci_eq(program, "RCT") | ci_ends(program, ", RCT"),
    }
    flags |= {name: ci_contains(program, text) for name, text in fv.RCT_NEIGHBORHOODS}
    per_person = as_cohort(cohort).person_flags(flags)
    return per_person.agg(*[F.count(name).alias(name) for name in flags])
