"""The classified cohort and its report-specific variants."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from caseweave import fixed_values as fv
from caseweave.functions.aggregates import best_row, concat_distinct
from caseweave.functions.dates import ReportWindow, add_years
from caseweave.functions.matching import (
    ci_contains,
    ci_contains_any,
    ci_eq,
    flag,
    is_true,
)
from caseweave.operators.cohort import PID, AnyCohort, Cohort, as_cohort
from caseweave.operators.episodes import episodes, with_stint_count
from caseweave.sources.catalog import Sources

GRANT_COLUMNS = fv.COHORT_GRANT_COLUMNS
FLAG_COLUMNS = fv.FLAG_COLUMNS


# Copies of a row that are made from one array.
COPIES = 100_000


def _running(window: ReportWindow) -> Column:
    """The grant has no end or meets the window; one that is open may start later."""
    return F.col("end_date").isNull() | (
        (F.col("end_date") >= window.start) & (F.col("start_date") <= window.end)
    )


def cohort_grants(
    participants: DataFrame,
    grants: DataFrame,
    window: ReportWindow,
    keep_ungranted: bool = False,
) -> DataFrame:
    """Participants with the grants that bring them into the cohort.

    A grant counts if it or its comment names a known program, it is not the
    excluded grant, and it either has no end or meets the window. Rows without
    a grant are dropped, or kept with ``keep_ungranted``.
    """
    people = participants.select(PID, "first_name", "last_name", "program_type")
    known = ci_contains_any("grant_type", fv.COHORT_GRANT_TERMS) | ci_contains(
        "comments", fv.COHORT_COMMENT_TERM
    )
    allowed = ~ci_eq("grant_type", fv.EXCLUDED_GRANT)
    running = _running(window)
    wanted = grants.select(PID, *GRANT_COLUMNS)
    if not keep_ungranted:
        return people.join(wanted.where(known & allowed & running), PID)
    no_grant = F.col("grant_type").isNull()
    return people.join(wanted, PID, "left").where(
        (is_true(known) | no_grant) & (is_true(allowed) | no_grant) & running
    )


def grants_cohort(
    sources: Sources,
    window: ReportWindow,
    max_slots: int | None = None,
    keep_ungranted: bool = False,
) -> Cohort:
    """Episodes with programs and grants, not yet classified."""
    # Unknown participants have no services, so their episodes meet nothing.
    spans = episodes(sources.pstatus, window, max_slots)
    return Cohort(
        with_stint_count(spans),
        cohort_grants(sources.participants, sources.grant_type, window, keep_ungranted),
        keys=sources.grant_type.where(_running(window)).select(PID),
        hot=sources.hot_keys("grant_type"),
    )


def service_rules() -> list[tuple[str, Column]]:
    """Flag rules in dependency order; later rules may read earlier flags."""
    program, grant, comments = F.col("program_type"), F.col("grant_type"), F.col("comments")
    juvenile = ci_contains_any(grant, fv.JUVENILE_GRANTS)
    rct = ci_contains(program, fv.RCT_PROGRAM)
    managed = ci_contains(program, fv.CM_PROGRAM) | ci_contains(grant, fv.CM_GRANT)
    vp_grant, hd_grant = (ci_eq(grant, name) for name in fv.VP_GRANTS)
    return [
        ("service_legal", rct | ci_contains(program, fv.LEGAL_PROGRAM)),
        ("service_cm", rct | managed | juvenile),
        ("cm_juv_divert", juvenile),
        ("cm_scan", ci_contains(grant, fv.SCAN_GRANT)),
        ("cm_scan_outreach", ci_contains(grant, fv.SCAN_OUTREACH_GRANT)),
        ("hd", (F.col("service_legal") == 1) & (F.col("service_cm") == 1)),
        ("hd_rct", rct),
        ("rjcc", ci_contains(program, fv.RJCC_PROGRAM)),
        ("crws", ci_contains(comments, fv.CRWS_TEXT) | ci_contains(grant, fv.CRWS_TEXT)),
        ("vp", vp_grant | hd_grant),
    ]


def classify(
    cohort: AnyCohort | DataFrame, rules: Sequence[tuple[str, Column]] | None = None
) -> AnyCohort:
    """Add one 1/NULL flag per rule, in one projection.

    Rules read program and grant columns and the flags of earlier rules; their
    names must be new columns.
    """
    c = as_cohort(cohort)
    flags = dict(service_rules() if rules is None else rules)
    taken = sorted(flags.keys() & set(c.columns))
    if taken:
        raise ValueError(f"cohort already has columns {taken}")
    return c.with_service(**{name: flag(condition) for name, condition in flags.items()})


def build_cohort(
    sources: Sources,
    window: ReportWindow,
    max_slots: int | None = None,
    keep_ungranted: bool = False,
) -> Cohort:
    """The classified cohort of a reporting window."""
    return classify(grants_cohort(sources, window, max_slots, keep_ungranted))


# -- variants ----------------------------------------------------------------


def juvenile_at(window: ReportWindow) -> Column:
    """Age label at the start of the window; an unknown birth date counts as adult."""
    return F.when(
        window.start < add_years("birth_date", 18), F.lit(fv.JUVENILE)
    ).otherwise(F.lit(fv.EMERGING_ADULT))


def monthly_cohort(
    cohort: AnyCohort | DataFrame, participants: DataFrame, window: ReportWindow
) -> AnyCohort:
    """Cohort with days served, client status and age, for monthly reports."""
    served = F.datediff(F.coalesce(F.col("closed_date"), window.end), F.col("active_date"))
    band = F.lit(fv.DAYS_SERVED_REST)
    for label, low, high in reversed(fv.DAYS_SERVED_BANDS):
        band = F.when(served.between(low, high), F.lit(label)).otherwise(band)
    people = participants.select(PID, "birth_date", "race", "gender").withColumn(
        "age", juvenile_at(window)
    )
    return (
        as_cohort(cohort)
        .join_people(people)
        .with_episode(
            days_to_t2=F.datediff(window.end, F.col("active_date")),
            days_served=band,
            client_status=F.when(
                F.col("closed_date") <= window.end, F.lit("closed out")
            ).otherwise(F.lit("active client")),
            new_client=F.when(F.col("active_date") >= window.start, F.lit("new client")),
        )
    )


def classify_concat(cohort: AnyCohort | DataFrame) -> DataFrame:
    """One row per named participant: distinct values of each column, comma-joined.

    The two lists are reduced separately; distinct values of their product are
    the distinct values of each list.
    """
    names = ["first_name", "last_name"]
    dates = ["active_date", "closed_date"]
    texts = ["program_type", "grant_type"]

    def joined(columns: Sequence[str]) -> list[Column]:
        return [concat_distinct(F.col(c).cast("string"), ",").alias(c) for c in columns]

    if isinstance(cohort, Cohort):
        left = cohort.episodes.groupBy(PID).agg(*joined(dates))
        right = cohort.served().groupBy(PID, *names).agg(*joined([*texts, *FLAG_COLUMNS]))
        out = right.join(left, PID)
    else:
        out = as_cohort(cohort).rows().groupBy(PID, *names).agg(
            *joined([*texts, *dates, *FLAG_COLUMNS])
        )
    return out.select(PID, *names, "program_type", *dates, "grant_type", *FLAG_COLUMNS)


def grant_cohort(
    cohort: AnyCohort | DataFrame,
    window: ReportWindow,
    grant: str = "JAC HD",
    program: str = "JAC",
) -> AnyCohort:
    """Rows at a participant's latest start among rows of one funder, marked new or continuing."""
    matches = ci_contains("grant_type", grant) | ci_contains("program_type", program)
    return (
        as_cohort(cohort)
        .at_last_episode_where(matches)
        .with_episode(
            new_client=F.when(window.has("active_date"), F.lit("new")).otherwise(
                F.lit("continuing")
            )
        )
    )


def hd_cohort(cohort: AnyCohort | DataFrame) -> AnyCohort:
    """Rows with both legal and case-management service."""
    return as_cohort(cohort).where_service(F.col("hd") == 1)


def best_addresses(address: DataFrame) -> DataFrame:
    """Best address per participant: primary first, then newest, then lowest address_id."""
    return best_row(
        address.where(F.col(PID).isNotNull()),
        PID,
        [F.lower("primary_address"), F.col("entered_date"), -F.col("address_id")],
    )


def a2j_cohort(
    cohort: AnyCohort | DataFrame, participants: DataFrame, address: DataFrame, legal: DataFrame
) -> DataFrame:
    """Participants of the A2J grant with address and legal summary.

    A participant appears once per matching cohort row; the copies are made in
    chunks, so that no row holds an element for each of them.
    """
    granted = as_cohort(cohort).where_service(ci_contains("grant_type", "A2J")).row_counts()
    people = participants.select(PID, "first_name", "last_name", "gender", "race")
    cases = (
        legal.groupBy(PID)
        .agg(
            F.max("arrest_date").alias("last_arrest"),
            concat_distinct("juvenile_adult", ", ").alias("juvenile_adult"),
            concat_distinct("case_type", ", ").alias("case_type"),
        )
        .where(F.col("last_arrest").isNotNull())
        .drop("last_arrest")
    )
    per_person = (
        granted.join(people, PID)
        .join(best_addresses(address).select(PID, "zip"), PID)
        .join(cases, PID, "left")
    )
    return per_person.select(
        "first_name",
        "last_name",
        PID,
        "gender",
        "race",
        F.when(ci_eq("race", "Hispanic/Latinx"), F.lit("Yes"))
        .otherwise(F.lit("Not Reported"))
        .alias("hispanic_latino"),
        "zip",
        "juvenile_adult",
        "case_type",
        F.explode(_chunks(F.col("n_rows"))).alias("_chunk"),
    ).select("*", F.explode(F.sequence(F.lit(1), F.col("_chunk"))).alias("_copy")).drop(
        "_chunk", "_copy"
    )


def _chunks(n_rows: Column) -> Column:
    """Sizes, at most COPIES each, that add up to n_rows."""
    last = F.lit(COPIES) * F.floor((n_rows - 1) / COPIES)
    whole = F.sequence(F.lit(0).cast("bigint"), last, F.lit(COPIES).cast("bigint"))
    return F.transform(whole, lambda begin: F.least(n_rows - begin, F.lit(COPIES)).cast("int"))
