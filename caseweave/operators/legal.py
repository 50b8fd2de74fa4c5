"""Legal case reports.

Case rows are cut to what a report needs per participant or per case before
they meet the cohort, and the cohort to one row per participant.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from caseweave import fixed_values as fv
from caseweave.functions.aggregates import (
    concat_distinct,
    distinct_flags,
    latest_rows,
    order_by_rank,
    rank_of,
)
from caseweave.functions.categories import folded
from caseweave.functions.dates import ReportWindow, add_years
from caseweave.functions.joins import HotKeys, looked_up, spread_join
from caseweave.functions.matching import ci_contains, ci_contains_any, ci_eq, ci_starts, flag
from caseweave.functions.percentages import percentage_convert
from caseweave.operators import sessions as sess
from caseweave.operators.cohort import PID, AnyCohort, as_cohort
from caseweave.operators.people import count_people_with

Q = AnyCohort | DataFrame

_CHARGE_CLASSES = {
    "felony": lambda: ci_contains("charge", "Felony"),
    "misdemeanor": lambda: ci_contains("charge", "Misdemeanor"),
}


def _charge_flags() -> dict[str, Column]:
    return {name: cond() for name, cond in _CHARGE_CLASSES.items()}


def legal_tally(
    cohort: Q, legal: DataFrame, window: ReportWindow, pending: bool = False
) -> DataFrame:
    """Participants with a case before the end of the window, or one still pending."""
    cases = legal.where(F.col("arrest_date") < window.end)
    if pending:
        open_status = ci_contains_any("case_status_current", ["diversion", "pending"])
        cases = cases.where(open_status | (F.col("case_outcome_date") > window.start))
    return count_people_with(cohort, cases)


# -- custody -----------------------------------------------------------------


def _older_than(
    cohort: Q, participants: DataFrame, window: ReportWindow, age: int, cutoff: str | dt.date
) -> DataFrame:
    """Participants older than an age at the cutoff in at least one episode."""
    last = as_cohort(cohort).episode_facts(_at=F.max(window.cutoff(cutoff)))
    return (
        last.join(participants.select(PID, "birth_date"), PID)
        .where(F.col("_at") > add_years("birth_date", age))
        .select(PID)
        .distinct()
    )


def legal_custody_list(
    cohort: Q,
    participants: DataFrame,
    trunc_legal: DataFrame,
    window: ReportWindow,
    age: int = 19,
    cutoff: str | dt.date = "active_date",
) -> DataFrame:
    """Latest custody record of each older participant; several rows of that day are joined.

    Only the rows of the latest day of the older participants are joined up.
    """
    texts = ["legal_status", "legal_status_detail", "custody_status", "comments"]
    older = _older_than(cohort, participants, window, age, cutoff)
    return (
        latest_rows(trunc_legal, PID, "trunc_date", among=older)
        .groupBy(PID, F.col("trunc_date").alias("recent_date"))
        .agg(*[concat_distinct(t, ", ").alias(t) for t in texts])
    )


def legal_custody_tally(
    cohort: Q,
    participants: DataFrame,
    trunc_legal: DataFrame,
    window: ReportWindow,
    age: int = 19,
    cutoff: str | dt.date = "active_date",
) -> DataFrame:
    """Older participants per latest custody status."""
    listed = legal_custody_list(cohort, participants, trunc_legal, window, age, cutoff)
    return listed.groupBy("custody_status").agg(F.count(PID).alias("n_participants"))


def legal_in_custody_links(
    cohort: Q, trunc_legal: DataFrame, linkages: DataFrame
) -> DataFrame:
    """Participants last recorded in custody, at most 45 days before an episode began, with a linkage."""
    in_custody = ci_eq("custody_status", "In Custody (+)")
    records = trunc_legal.groupBy(PID).agg(
        F.max("trunc_date").alias("recent"),
        F.max(F.when(in_custody, F.col("trunc_date"))).alias("recent_in_custody"),
    )
    held = records.where(F.col("recent") == F.col("recent_in_custody"))
    first = as_cohort(cohort).episode_facts(first_active=F.min("active_date"))
    near = first.join(held, PID).where(
        F.col("first_active") <= F.date_add("recent", fv.CUSTODY_LAG_DAYS)
    )
    linked = linkages.select(PID).distinct()
    return near.join(linked, PID, "left_semi").agg(F.count(PID).alias("n_participants"))


# -- outcomes and programs ---------------------------------------------------

_INVOLVED = [PID, "linkages_made", "linkages_started", "successful", "unsuccessful"]


def _outcomes(cohort: Q, legal: DataFrame, window: ReportWindow) -> DataFrame:
    """One row per cohort participant and outcome in the window."""
    return (
        legal.where(window.has("case_outcome_date"))
        .join(as_cohort(cohort).people(), PID, "left_semi")
        .groupBy(PID, "case_outcome")
        .agg(
            concat_distinct("class_prior_to_plea_trial", ", ").alias("charge"),
            concat_distinct("case_type", ", ").alias("case_type"),
            concat_distinct("sentence", ", ").alias("sentence"),
        )
    )


def legal_program_involvement_long(
    cohort: Q,
    legal: DataFrame,
    linkages: DataFrame,
    case_sessions: DataFrame,
    window: ReportWindow,
    program_timeframe: bool = False,
) -> DataFrame:
    """One row per participant and outcome in the window, with linkage and session counts."""
    # cohort people are looked up once, with the outcomes; linkages and sessions shrink to
    # a row per person on their own
    outcomes = _outcomes(cohort, legal, window)
    text = F.when(
        ci_starts("case_outcome", "plead"),
        F.concat(F.col("case_outcome"), F.lit(" - "), F.col("sentence")),
    ).otherwise(F.col("case_outcome"))

    def counted(date: str) -> Column:
        return window.has(date) if program_timeframe else F.col(date).isNotNull()

    links = (
        linkages.where(ci_eq("hub_initiated", "yes"))
        .groupBy(PID)
        .agg(
            F.count(flag(counted("linked_date"))).alias("linkages_made"),
            F.count(flag(counted("start_date"))).alias("linkages_started"),
        )
    )
    contacts = distinct_flags(
        case_sessions.where(sess.of_kind("cm") & counted("session_date")),
        [PID],
        "case_session_id",
        {"successful": sess.successful(), "unsuccessful": sess.unsuccessful()},
    )
    counts = ["linkages_made", "linkages_started", "successful", "unsuccessful"]
    return (
        outcomes.select(PID, "charge", "case_type", text.alias("case_outcome"))
        .join(links, PID, "left")
        .join(contacts, PID, "left")
        .select(
            PID,
            "charge",
            "case_type",
            "case_outcome",
            *[F.coalesce(c, F.lit(0).cast("bigint")).alias(c) for c in counts],
        )
    )


def legal_program_involvement(
    cohort: Q,
    legal: DataFrame,
    linkages: DataFrame,
    case_sessions: DataFrame,
    window: ReportWindow,
    program_timeframe: bool = False,
) -> DataFrame:
    """One row per participant: the counts, n_cases and all outcomes in the window as
    ``cases``, an array of (case_outcome, charge, case_type) in that order."""
    long = legal_program_involvement_long(
        cohort, legal, linkages, case_sessions, window, program_timeframe
    )
    # one element per distinct outcome text of the participant
    case = F.struct("case_outcome", "charge", "case_type")
    return long.groupBy(*_INVOLVED).agg(
        F.count(F.lit(1)).alias("n_cases"),
        F.array_sort(F.collect_list(case)).alias("cases"),
    )


def legal_program_involvement_wide(
    cohort: Q,
    legal: DataFrame,
    linkages: DataFrame,
    case_sessions: DataFrame,
    window: ReportWindow,
    slots: int | None = None,
    program_timeframe: bool = False,
) -> DataFrame:
    """The outcomes side by side: charge_1, case_type_1, case_outcome_1, charge_2, …

    Without ``slots`` there are as many column groups as the participant with the most
    outcomes needs: a first job counts outcomes per participant, which needs neither
    linkages nor sessions, and the columns are made by its answer. With ``slots`` their
    number is fixed, and a participant with more outcomes stops the query, whichever of
    them is read.
    """
    if slots is None:
        outcomes = _outcomes(cohort, legal, window).select(PID, "case_outcome")
        per_person = outcomes.groupBy(PID).agg(F.count(F.lit(1)).alias("n"))
        slots = per_person.agg(F.max("n")).first()[0] or 0
    found = legal_program_involvement(
        cohort, legal, linkages, case_sessions, window, program_timeframe
    )
    too_many = F.raise_error(F.lit(f"a participant has more than {slots} outcomes"))
    fits = F.col("n_cases") <= slots
    cases = F.when(fits, F.col("cases")).otherwise(too_many.cast(found.schema["cases"].dataType))
    columns = [
        F.get(cases, F.lit(i - 1))[part].alias(f"{part}_{i}")
        for i in range(1, slots + 1)
        for part in ("charge", "case_type", "case_outcome")
    ]
    n_cases = F.when(fits, F.col("n_cases")).otherwise(too_many.cast("bigint"))
    return found.select(*_INVOLVED, *columns, n_cases.alias("n_cases"))


def legal_fel_reduction(
    cohort: Q,
    legal: DataFrame,
    felony_classes: DataFrame,
    window: ReportWindow,
    timeframe: bool = True,
) -> DataFrame:
    """Participants whose felony class was lowered in any case, or in none."""
    cases = legal.where(window.has("case_outcome_date")) if timeframe else legal
    prior = looked_up(felony_classes, "class", "ranking", F.col("class_prior_to_plea_trial"))
    after = looked_up(felony_classes, "class", "ranking", F.col("class_after_plea_trial"))
    compared = cases.select(PID, prior.alias("_prior"), after.alias("_after")).where(
        F.col("_prior").isNotNull() & F.col("_after").isNotNull()
    )
    per_person = compared.groupBy(PID).agg(
        F.max(flag(F.col("_prior") < F.col("_after"))).alias("lowered")
    )
    return (
        per_person.join(as_cohort(cohort).people(), PID, "left_semi")
        .groupBy(F.when(F.col("lowered") == 1, "lowered").otherwise("remained").alias("felony"))
        .agg(F.count(F.lit(1)).alias("n"))
    )


def _top_outcomes(
    cohort: Q, legal: DataFrame, highest_case: DataFrame, window: ReportWindow, timeframe: bool
) -> DataFrame:
    """Highest-ranked outcomes per participant; unranked outcomes always stay."""
    cases = legal.where(window.has("case_outcome_date")) if timeframe else legal
    per_spelling = (
        cases.groupBy(PID, "case_outcome")
        .agg(F.collect_set("sentence").alias("sentences"))
        .join(as_cohort(cohort).people(), PID, "left_semi")
    )
    sentences = F.array_sort(F.array_distinct(F.flatten(F.collect_list("sentences"))))
    per_outcome = folded(
        per_spelling, [PID, "case_outcome"], ["case_outcome"], {"sentences": sentences}
    )
    joined = F.when(F.size("sentences") > 0, F.concat_ws(", ", "sentences"))
    rank = looked_up(highest_case, "case_outcome", "ranking", F.col("case_outcome"))
    ranked = per_outcome.select(
        PID, "case_outcome", joined.alias("sentence"), rank.alias("ranking")
    )
    top = F.max("ranking").over(W.partitionBy(PID))
    return ranked.withColumn("_top", top).where(
        F.col("ranking").isNull() | (F.col("ranking") == F.col("_top"))
    )


def _outcome_counts(labels: DataFrame) -> DataFrame:
    counts = labels.groupBy("case_outcome").agg(F.count("case_outcome").alias("n"))
    return folded(counts, ["case_outcome"], ["case_outcome"], {"n": F.sum("n")})


def _outcome_label(timeframe: bool) -> Column:
    """Pleas carry their sentence; with a timeframe only the bare text 'plead guilty' does."""
    plea = ci_eq("case_outcome", "plead guilty") if timeframe else ci_starts("case_outcome", "plead")
    return F.when(
        plea, F.concat(F.col("case_outcome"), F.lit(" - "), F.col("sentence"))
    ).otherwise(F.col("case_outcome"))


def legal_case_outcomes(
    cohort: Q,
    legal: DataFrame,
    highest_case: DataFrame,
    window: ReportWindow,
    timeframe: bool = True,
) -> DataFrame:
    """Most severe outcomes of the participants."""
    top = _top_outcomes(cohort, legal, highest_case, window, timeframe)
    return _outcome_counts(top.select(_outcome_label(timeframe).alias("case_outcome")))


def legal_plea_outcomes(
    cohort: Q,
    legal: DataFrame,
    highest_case: DataFrame,
    window: ReportWindow,
    timeframe: bool = True,
) -> DataFrame:
    """Most severe outcomes that are guilty pleas."""
    top = _top_outcomes(cohort, legal, highest_case, window, timeframe)
    pleas = top.where(ci_starts("case_outcome", "plead"))
    return _outcome_counts(pleas.select(_outcome_label(timeframe).alias("case_outcome")))


def legal_case_statuses(
    cohort: Q,
    legal: DataFrame,
    window: ReportWindow,
    timeframe: bool = False,
    opened_closed: str = "closed",
    hot: HotKeys | None = None,
) -> DataFrame:
    """Felony and misdemeanor cases per status and per outcome.

    A case counts if an episode began no later than some days after the
    arrest. Status and outcome rows come from one pass over the cases.
    """
    status_lag = fv.STATUS_LAG_DAYS_WINDOW if timeframe else fv.STATUS_LAG_DAYS
    outcome_lag = fv.OUTCOME_LAG_DAYS_WINDOW if timeframe else fv.STATUS_LAG_DAYS
    cases = legal
    if timeframe:
        opened = opened_closed.lower() in ("opened", "open")
        cases = cases.where(window.has("arrest_date" if opened else "case_outcome_date"))
    first = as_cohort(cohort).episode_facts(first_active=F.min("active_date"))
    listed_cases = cases.select(
        PID, "case_id", "charge", "arrest_date", "case_status_current", "case_outcome"
    )
    served = spread_join(listed_cases, first, PID, hot=hot)

    def within(days: int) -> Column:
        return F.col("first_active") <= F.date_add("arrest_date", days)

    def entry(part: int, label: str) -> Column:
        return F.struct(F.lit(part).alias("part"), F.col(label).alias("label"))

    by_status = F.when(
        within(status_lag) & ci_contains_any("case_status_current", fv.CASE_STATUS_TERMS),
        entry(1, "case_status_current"),
    )
    by_outcome = F.when(
        within(outcome_lag) & F.col("case_outcome").isNotNull(), entry(2, "case_outcome")
    )
    entries = F.explode(F.array(by_status, by_outcome))
    listed = (
        served.select("case_id", "charge", entries.alias("e"))
        .where(F.col("e").isNotNull())
        .select("case_id", "charge", "e.part", F.col("e.label").alias("case_status_current"))
    )
    counts = distinct_flags(listed, ["part", "case_status_current"], "case_id", _charge_flags())
    # a text may be a status as well as an outcome; its status row comes first
    ordered = order_by_rank(counts, "case_status_current", fv.CASE_STATUS_ORDER, then=["part"])
    return ordered.drop("part")


def legal_one_case(
    cohort: Q,
    legal: DataFrame,
    window: ReportWindow,
    timeframe: bool = True,
    literal: bool = False,
) -> DataFrame:
    """Outcomes of participants with exactly one case.

    ``literal`` drops the one-case condition.
    """
    cases = legal.where(window.has("case_outcome_date")) if timeframe else legal
    per_outcome = cases.groupBy(PID, "case_outcome").agg(
        F.min("case_id").alias("_low"),
        F.max("case_id").alias("_high"),
        F.count("case_outcome").alias("n"),
    )
    if not literal:
        person = W.partitionBy(PID)
        per_outcome = (
            per_outcome.withColumn("_low", F.min("_low").over(person))
            .withColumn("_high", F.max("_high").over(person))
            .where(F.col("_low") == F.col("_high"))
        )
    counts = (
        per_outcome.join(as_cohort(cohort).people(), PID, "left_semi")
        .groupBy("case_outcome")
        .agg(F.sum("n").alias("n"))
    )
    return folded(counts, ["case_outcome"], ["case_outcome"], {"n": F.sum("n")})


# -- case types and re-arrests -----------------------------------------------


def _after_last_close() -> Column:
    return F.col("last_closed_date").isNull() | (F.col("arrest_date") > F.col("last_closed_date"))


def _arrests_since_close(legal: DataFrame, last_close: DataFrame) -> DataFrame:
    """Distinct arrest dates of participants with a close record, after that close.

    Distinct first: a participant then has at most one row per calendar day.
    """
    arrests = legal.select(PID, "arrest_date").distinct()
    closes = last_close.select(PID, "last_closed_date")
    return arrests.join(closes, PID).where(_after_last_close())


def _case_type_report(
    cases: DataFrame, case_client: str, percentage: bool
) -> DataFrame:
    key = {"case": "case_id", "client": PID}[case_client]
    counts = distinct_flags(cases, ["case_type"], key, _charge_flags(), ["case_type"])
    if percentage:
        order = [F.coalesce(rank_of("case_type", fv.CASE_TYPE_ORDER), F.lit(8))]
        return percentage_convert(counts, replace=False, order=order)
    return order_by_rank(counts, "case_type", fv.CASE_TYPE_ORDER)


def legal_case_type(
    cohort: Q,
    legal: DataFrame,
    last_close: DataFrame,
    window: ReportWindow,
    timeframe: bool = False,
    opened_closed: str = "opened",
    percentage: bool = False,
    case_client: str = "case",
    hot: HotKeys | None = None,
) -> DataFrame:
    """Cases (or participants) since the last close, by type.

    With a timeframe: 'opened' keeps arrests in the window and participants who
    began in it, 'closed' keeps outcomes in the window.
    """
    cases = legal.select(
        PID, "case_id", "arrest_date", "case_outcome_date", "charge", "case_type"
    )
    opened = opened_closed.lower() in ("opened", "open")
    if timeframe and not opened:
        cases = cases.where(window.has("case_outcome_date"))
    people = as_cohort(cohort).episode_facts(
        _began=F.max(F.coalesce(window.has("active_date"), F.lit(False)))
    )
    people = people.join(last_close.select(PID, "last_closed_date"), PID)
    served = spread_join(cases, people, PID, hot=hot).where(_after_last_close())
    if timeframe and opened:
        served = served.where(window.has("arrest_date") | F.col("_began"))
    return _case_type_report(served, case_client, percentage)


def legal_case_type_first(
    cohort: Q,
    legal: DataFrame,
    last_close: DataFrame,
    percentage: bool = False,
    case_client: str = "case",
) -> DataFrame:
    """As ``legal_case_type``, for the earliest arrest date of each participant.

    The first arrest comes from distinct arrest dates; the cases of that day
    are then found by (participant, day).
    """
    first = (
        _arrests_since_close(legal, last_close)
        .groupBy(PID)
        .agg(F.min("arrest_date").alias("arrest_date"))
        .join(as_cohort(cohort).people(), PID, "left_semi")
    )
    cases = legal.select(PID, "case_id", "arrest_date", "charge", "case_type")
    on_first = cases.join(first, [PID, "arrest_date"], "left_semi")
    return _case_type_report(on_first, case_client, percentage)


def _pending_at(day: Column) -> Column:
    return (F.col("arrest_date") < day) & (
        ci_eq("case_status_current", "Case Pending") | (F.col("case_outcome_date") > day)
    )


def legal_pending_cases(
    cohort: Q, legal: DataFrame, window: ReportWindow, at: str = "t1"
) -> DataFrame:
    """Participants with a case pending at the start or end of the window."""
    day = window.start if at == "t1" else window.end
    return count_people_with(cohort, legal.where(_pending_at(day)))


def legal_pending_and_ended(
    cohort: Q, legal: DataFrame, window: ReportWindow, at: str = "t1"
) -> DataFrame:
    """Those who also had a case end in the window; both facts come from one aggregation."""
    day = window.start if at == "t1" else window.end
    facts = legal.groupBy(PID).agg(
        F.max(flag(_pending_at(day))).alias("pending"),
        F.max(flag(window.has("case_outcome_date"))).alias("ended"),
    )
    both = facts.where((F.col("pending") == 1) & (F.col("ended") == 1))
    return count_people_with(cohort, both)


def legal_rearrested(
    cohort: Q,
    legal: DataFrame,
    last_close: DataFrame,
    window: ReportWindow,
    timeframe: bool = True,
) -> DataFrame:
    """Participants arrested again after their first arrest since the last close.

    A later arrest exists exactly when the latest (counted) arrest is after the
    first, so two extremes per participant replace a self-join.
    """
    since = _arrests_since_close(legal, last_close)
    counted = (
        F.when(window.has("arrest_date"), F.col("arrest_date"))
        if timeframe
        else F.col("arrest_date")
    )
    extremes = since.groupBy(PID).agg(
        F.min("arrest_date").alias("first"), F.max(counted).alias("last")
    )
    return count_people_with(cohort, extremes.where(F.col("last") > F.col("first")))
