"""Every query of the library by name, with the arguments it takes from a context.

Options are keyword arguments of the operator behind the name.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable, Collection, Mapping

from pyspark.sql import DataFrame

from caseweave.operators import a2j, demographics, documents, funder, grants, legal, linkages
from caseweave.operators import monthly, programs
from caseweave.plans.context import ReportContext as Ctx

Query = Callable[..., DataFrame]

def _hot(ctx: Ctx, table: str) -> dict[str, object]:
    """The table's participants with very many rows, as far as the sources know them."""
    return {"hot": ctx.sources.hot_keys(table)}


QUERIES: dict[str, Query] = {
    # demographics
    "dem_age_tally": lambda c, **o: demographics.dem_age_tally(
        c.cohort, c.sources.participants, c.window, **o
    ),
    "dem_age_list": lambda c, **o: demographics.dem_age_list(
        c.cohort, c.sources.participants, c.window, **o
    ),
    "dem_race_gender": lambda c, **o: demographics.dem_race_gender(
        c.cohort, c.sources.participants, c.window, **o
    ),
    "dem_recent_address": lambda c, **o: demographics.dem_recent_address(
        c.cohort, c.sources.address, **o
    ),
    "dem_recent_address_neighborhood": lambda c, **o: (
        demographics.dem_recent_address_neighborhood(
            c.cohort, c.sources.neighborhoods, **_hot(c, "neighborhoods"), **o
        )
    ),
    # documents, grants, incidents, mediation
    "docs_has_formatted": lambda c, **o: documents.docs_has_formatted(
        c.cohort, c.sources.documents_unfiltered, **o
    ),
    "grant_tally": lambda c, **o: grants.grant_tally(c.cohort, c.window, **o),
    "incident_tally": lambda c, **o: grants.incident_tally(
        c.sources.critical_incidents, c.window, **o
    ),
    "incidents_cpic": lambda c, **o: grants.incidents_cpic(
        c.sources.critical_incidents, c.window, **o
    ),
    "incidents_non_cpic": lambda c, **o: grants.incidents_non_cpic(
        c.sources.critical_incidents, c.window, **o
    ),
    "mediation_tally": lambda c, **o: grants.mediation_tally(
        c.sources.mediations, c.sources.mediation_followup, c.window, **o
    ),
    "mediation_time_spent": lambda c, **o: grants.mediation_time_spent(
        c.sources.mediations, c.window, **o
    ),
    # legal
    "legal_tally": lambda c, **o: legal.legal_tally(c.cohort, c.sources.legal, c.window, **o),
    "legal_custody_tally": lambda c, **o: legal.legal_custody_tally(
        c.cohort, c.sources.participants, c.sources.trunc_legal, c.window, **o
    ),
    "legal_custody_list": lambda c, **o: legal.legal_custody_list(
        c.cohort, c.sources.participants, c.sources.trunc_legal, c.window, **o
    ),
    "legal_in_custody_links": lambda c, **o: legal.legal_in_custody_links(
        c.cohort, c.sources.trunc_legal, c.sources.linkages, **o
    ),
    "legal_program_involvement": lambda c, **o: legal.legal_program_involvement(
        c.cohort, c.sources.legal, c.sources.linkages, c.sources.case_sessions, c.window, **o
    ),
    "legal_program_involvement_wide": lambda c, **o: legal.legal_program_involvement_wide(
        c.cohort, c.sources.legal, c.sources.linkages, c.sources.case_sessions, c.window, **o
    ),
    "legal_program_involvement_long": lambda c, **o: legal.legal_program_involvement_long(
        c.cohort, c.sources.legal, c.sources.linkages, c.sources.case_sessions, c.window, **o
    ),
    "legal_fel_reduction": lambda c, **o: legal.legal_fel_reduction(
        c.cohort, c.sources.legal, c.sources.felony_classes, c.window, **o
    ),
    "legal_case_outcomes": lambda c, **o: legal.legal_case_outcomes(
        c.cohort, c.sources.legal, c.sources.highest_case, c.window, **o
    ),
    "legal_plea_outcomes": lambda c, **o: legal.legal_plea_outcomes(
        c.cohort, c.sources.legal, c.sources.highest_case, c.window, **o
    ),
    "legal_case_statuses": lambda c, **o: legal.legal_case_statuses(
        c.cohort, c.sources.legal, c.window, **_hot(c, "legal"), **o
    ),
    "legal_one_case": lambda c, **o: legal.legal_one_case(
        c.cohort, c.sources.legal, c.window, **o
    ),
    "legal_case_type": lambda c, **o: legal.legal_case_type(
        c.cohort, c.sources.legal, c.sources.last_close, c.window, **_hot(c, "legal"), **o
    ),
    "legal_case_type_first": lambda c, **o: legal.legal_case_type_first(
        c.cohort, c.sources.legal, c.sources.last_close, **o
    ),
    "legal_pending_cases": lambda c, **o: legal.legal_pending_cases(
        c.cohort, c.sources.legal, c.window, **o
    ),
    "legal_pending_and_ended": lambda c, **o: legal.legal_pending_and_ended(
        c.cohort, c.sources.legal, c.window, **o
    ),
    "legal_rearrested": lambda c, **o: legal.legal_rearrested(
        c.cohort, c.sources.legal, c.sources.last_close, c.window, **o
    ),
    # linkages
    "link_tally": lambda c, **o: linkages.link_tally(
        c.cohort, c.sources.linkages, c.window, **o
    ),
    "link_edu_job": lambda c, **o: linkages.link_edu_job(
        c.cohort, c.sources.linkages, c.sources.participants, c.window, **o
    ),
    "link_goal_area": lambda c, **o: linkages.link_goal_area(
        c.cohort, c.sources.linkages, c.window, **o
    ),
    # programs and sessions
    "programs_packages": lambda c, **o: programs.programs_packages(c.cohort, **o),
    "programs_service_tally": lambda c, **o: programs.programs_service_tally(c.cohort, **o),
    "outreach_tally": lambda c, **o: programs.outreach_tally(c.cohort, **o),
    "programs_sessions": lambda c, **o: programs.programs_sessions(
        c.cohort, c.sources.case_sessions, c.window, **o
    ),
    "programs_session_tally": lambda c, **o: programs.programs_session_tally(
        c.cohort, c.sources.case_sessions, c.window, **o
    ),
    "programs_by_demographic": lambda c, **o: programs.programs_by_demographic(
        c.cohort, c.sources.participants, c.window, **o
    ),
    "programs_session_length": lambda c, **o: programs.programs_session_length(
        c.cohort, c.sources.case_sessions, c.window, **o
    ),
    "programs_session_length_grouped": lambda c, **o: programs.programs_session_length_grouped(
        c.cohort, c.sources.case_sessions, c.window, **o
    ),
    "programs_rct_neighborhoods": lambda c, **o: programs.programs_rct_neighborhoods(
        c.cohort, **o
    ),
    # A2J
    "a2j_cases": lambda c, **o: a2j.a2j_cases(
        c.cohort, c.sources.legal, c.window, **_hot(c, "legal"), **o
    ),
    "a2j_linkages": lambda c, **o: a2j.a2j_linkages(
        c.cohort, c.sources.linkages, c.window, **_hot(c, "linkages"), **o
    ),
    # monthly
    "grouped_by_status": lambda c, **o: monthly.grouped_by_status(c.cohort, **o),
    "grouped_by_time": lambda c, **o: monthly.grouped_by_time(c.cohort, **o),
    # funders
    "idhs_ages": lambda c, **o: funder.idhs_ages(c.cohort, c.sources.participants, **o),
    "idhs_tally": lambda c, **o: funder.idhs_tally(c.cohort, **o),
    "idhs_tally_closed": lambda c, **o: funder.idhs_tally_closed(c.cohort, c.window, **o),
    "idhs_class_notes": lambda c, **o: funder.idhs_class_notes(
        c.cohort, c.sources.classes, c.window, **_hot(c, "classes"), **o
    ),
    "idhs_race_gender": lambda c, **o: funder.idhs_race_gender(
        c.cohort, c.sources.participants, **o
    ),
    "idhs_language": lambda c, **o: funder.idhs_language(
        c.cohort, c.sources.participants, **o
    ),
    "idhs_service_tally": lambda c, **o: funder.idhs_service_tally(
        c.cohort, **{"program": c.program, **o}
    ),
    "idhs_linkages": lambda c, **o: funder.idhs_linkages(
        c.cohort, c.sources.linkages, c.window, **{"program": c.program, **o}
    ),
    "jac_cm_hours": lambda c, **o: funder.jac_cm_hours(
        c.cohort, c.sources.case_sessions, c.window, **{"program": c.program, **o}
    ),
    "jac_cm_sessions": lambda c, **o: funder.jac_cm_sessions(
        c.cohort, c.sources.case_sessions, c.window, **{"program": c.program, **o}
    ),
    "jac_transpo_assist": lambda c, **o: funder.jac_transpo_assist(c.cohort, **o),
    "jac_linked_participant_tally": lambda c, **o: funder.jac_linked_participant_tally(
        c.cohort, c.sources.linkages, **o
    ),
}


# Queries whose rows come in a defined order; with a condition on the options where only
# some forms do.
_ORDERED: dict[str, Callable[[dict[str, object]], bool]] = {
    "legal_case_statuses": lambda o: True,
    "legal_case_type": lambda o: True,
    "legal_case_type_first": lambda o: True,
    "programs_packages": lambda o: True,
    "programs_session_length_grouped": lambda o: True,
    "programs_by_demographic": lambda o: bool(o.get("percentages")),
    "grouped_by_status": lambda o: True,
    "grouped_by_time": lambda o: True,
}


def is_ordered(name: str, options: dict[str, object]) -> bool:
    return name in _ORDERED and _ORDERED[name](options)


# The fact table that a query reads only inside the window, whatever else it asks of the
# rows; the condition on the options says when it does.
_WINDOWED: dict[str, tuple[str, Callable[[dict[str, object]], bool]]] = {
    "programs_sessions": ("case_sessions", lambda o: o.get("timeframe", True) is True),
    "programs_session_tally": ("case_sessions", lambda o: True),
    "programs_session_length": ("case_sessions", lambda o: o.get("timeframe", True) is True),
    "programs_session_length_grouped": (
        "case_sessions", lambda o: o.get("timeframe", True) is True,
    ),
    "jac_cm_hours": ("case_sessions", lambda o: True),
    "jac_cm_sessions": ("case_sessions", lambda o: True),
    "link_tally": ("linkages", lambda o: o.get("timeframe", False) is True),
    "link_goal_area": ("linkages", lambda o: o.get("timeframe", True) is True),
    "idhs_linkages": ("linkages", lambda o: True),
}
# Further queries over these tables, which read rows outside the window.
_WHOLE = {
    "case_sessions": ("legal_program_involvement",),
    "linkages": (
        "a2j_linkages", "link_edu_job", "legal_in_custody_links", "legal_program_involvement",
        "jac_linked_participant_tally",
    ),
}


def shared_tables(blocks: Collection[tuple[str, Mapping[str, object]]]) -> list[str]:
    """Fact tables that several of the given queries read, all of them inside the window only."""
    windowed, whole = Counter(), set()
    for name, options in blocks:
        table, applies = _WINDOWED.get(name, ("", lambda o: False))
        if applies(dict(options)):
            windowed[table] += 1
        elif table:
            whole.add(table)
        whole |= {t for t, names in _WHOLE.items() if name.startswith(names)}
    return sorted(t for t, n in windowed.items() if n > 1 and t not in whole)


def run_query(ctx: Ctx, name: str, **options: object) -> DataFrame:
    """Build one query; an unknown name is an error."""
    if name not in QUERIES:
        raise KeyError(f"unknown query {name!r}")
    return QUERIES[name](ctx, **options)
