"""Edge cases of the report queries on small literal tables."""

from __future__ import annotations

import pytest
from pyspark.sql.types import DateType, StructField

from conftest import as_value
from caseweave.operators.cohort import FlatCohort
from caseweave.plans.context import ReportContext
from caseweave.plans.queries import run_query


@pytest.fixture(scope="module")
def flat(spark):
    """Cohort rows (pid, active, closed, program, grant, hd, cm flag, crws)."""

    def make(*values):
        cols = (
            "participant_id BIGINT, active_date DATE, closed_date DATE, program_type STRING,"
            " grant_type STRING, hd INT, crws INT"
        )
        names = [c.split()[0] for c in cols.split(", ")]
        date = StructField("d", DateType())
        data = [
            tuple(as_value(date, v) if n.endswith("_date") else v for n, v in zip(names, row))
            for row in values
        ]
        return FlatCohort(spark.createDataFrame(data, cols))

    return make


def member(pid, active="2023-05-01", closed=None, program=None, grant=None, hd=None, crws=None):
    return (pid, active, closed, program, grant, hd, crws)


@pytest.fixture()
def run(flat, sources, window, rows):
    def go(name, cohort, options=None, program="idhs", columns=(), **tables):
        ctx = ReportContext(sources(**tables), window, flat(*cohort), program)
        return rows(run_query(ctx, name, **(options or {})), *columns)

    return go


def case(case_id, pid=1, **more):
    return {"case_id": case_id, "participant_id": pid, **more}


# -- demographics -------------------------------------------------------------


def test_leap_birthday_is_in_neither_age_group(run):
    people = [{"participant_id": 1, "birth_date": "2004-02-29"}]
    on_birthday = [member(1, "2022-02-28")]
    assert run("dem_age_tally", on_birthday, participants=people) == [(0, 0)]


def test_unknown_birth_date(run):
    people = [{"participant_id": 1}]
    assert run("dem_age_tally", [member(1)], participants=people) == [(0, 0)]
    listed = run("dem_age_list", [member(1)], columns=["age_group"], participants=people)
    assert listed == [("Adult",)]


def test_empty_cohort_counts_zero(run):
    people = [{"participant_id": 1, "race": "White"}]
    assert run("dem_age_tally", [], participants=people) == [(0, 0)]
    assert run("dem_race_gender", [], participants=people) == []
    assert run("legal_tally", [], legal=[case(1, arrest_date="2020-01-01")]) == [(0,)]
    assert run("programs_rct_neighborhoods", []) == [(0,) * 6]
    assert run("jac_cm_sessions", []) == [(None,)]
    assert run("programs_session_length", []) == [(None, None)]


def test_equal_addresses_take_the_lowest_id(run):
    same = {"participant_id": 1, "primary_address": "Yes", "entered_date": "2023-01-01"}
    places = [{**same, "address_id": 7, "location": "x"}, {**same, "address_id": 3, "location": "y"}]
    for latest, want in ((True, [("y", 1)]), (False, [("x", 2), ("y", 1)])):
        got = run(
            "dem_recent_address_neighborhood", [member(1)], {"latest_only": latest},
            columns=["location", "rn"], neighborhoods=places,
        )
        assert got == want


# -- documents ----------------------------------------------------------------


def test_document_families(run):
    def docs(*names):
        return [{"participant_id": 1, "document_name": n, "document_type": "assessments"} for n in names]

    got = run("docs_has_formatted", [member(1), member(2)],
              documents_unfiltered=docs("ab_assm_isp_01152023", "Post-Traumatic", "x_FCS_99999999"))
    assert got == [
        (1, 1, "Yes", 0, "Yes", None, None, 0, "Yes", "Yes", 3),
        (2, None, None, None, None, None, None, None, None, None, None),
    ]
    # Documents outside every family still count as assessments.
    assert run("docs_has_formatted", [member(1)], columns=["has_bp", "assess"],
               documents_unfiltered=docs("letter")) == [(None, 1)]


# -- grants, incidents, mediation ---------------------------------------------


def test_incidents_without_source_count_nowhere(run):
    incidents = [
        {"incident_id": 1, "how_hear": "via cpic", "date_incident": "2023-01-01", "num_deceased": 0},
        {"incident_id": 2, "how_hear": "News", "date_incident": "2023-12-31"},
        {"incident_id": 3, "date_incident": "2023-06-01"},
        {"incident_id": None, "how_hear": "News", "date_incident": "2023-06-01"},
        {"incident_id": 5, "how_hear": "News", "date_incident": "2024-01-01"},
    ]
    assert run("incident_tally", [], critical_incidents=incidents) == [(1, 1)]
    assert run("incidents_cpic", [], critical_incidents=incidents) == [(None, 0, 1)]
    assert run("incidents_non_cpic", [], critical_incidents=incidents) == [("News", 1)]


def test_missing_outcome_counts_zero(run):
    meetings = [{"date_start_mediation": "2023-01-01", "hours_spent_mediation": 2.5}]
    assert run("mediation_tally", [], mediations=meetings) == [(None, 0)]
    assert run("mediation_time_spent", [], mediations=meetings) == [(None,)]


# -- legal --------------------------------------------------------------------


def test_custody_joins_records_of_the_latest_day(run):
    records = [
        {"participant_id": 1, "trunc_date": "2023-02-01", "custody_status": s}
        for s in ("Released", "In Custody (+)")
    ] + [
        {"participant_id": 1, "trunc_date": "2023-01-01", "custody_status": "Old"},
        {"participant_id": 1, "custody_status": "Undated"},
    ]
    people = [{"participant_id": 1, "birth_date": "2000-01-01"}]
    got = run("legal_custody_tally", [member(1)], participants=people, trunc_legal=records)
    assert got == [("In Custody (+), Released", 1)]
    links = [{"participant_id": 1, "linkage_id": 1}]
    assert run("legal_in_custody_links", [member(1, "2023-03-18")], trunc_legal=records, linkages=links) == [(1,)]
    assert run("legal_in_custody_links", [member(1, "2023-03-19")], trunc_legal=records, linkages=links) == [(0,)]


def outcome(case_id, text, pid=1, **more):
    return case(case_id, pid, case_outcome=text, case_outcome_date="2023-05-01", **more)


RANKS = [{"case_outcome": "Found", "ranking": 4}, {"case_outcome": "Guilty", "ranking": 4},
         {"case_outcome": "plead guilty", "ranking": 1}]


def test_top_outcomes_keep_ties_and_unranked(run):
    cases = [outcome(1, "Found"), outcome(2, "Guilty"), outcome(3, "Moved"),
             outcome(4, "Plead Guilty", sentence="Jail"), outcome(5, None)]
    got = run("legal_case_outcomes", [member(1)], legal=cases, highest_case=RANKS)
    assert got == [(None, 0), ("Found", 1), ("Guilty", 1), ("Moved", 1)]


def test_pleas_carry_sentences(run):
    cases = [outcome(1, "Plead Guilty", sentence="Jail"), outcome(2, "Plead Guilty", sentence="Fine"),
             outcome(3, "Plead Guilty", 2), outcome(4, "Plead down", 3, sentence="Fine")]
    people = [member(1), member(2), member(3)]
    tables = {"legal": cases, "highest_case": RANKS}
    assert run("legal_case_outcomes", people, **tables) == [
        (None, 0), ("Plead Guilty - Fine, Jail", 1), ("Plead down", 1)]
    assert run("legal_case_outcomes", people, {"timeframe": False}, **tables) == [
        (None, 0), ("Plead Guilty - Fine, Jail", 1), ("Plead down - Fine", 1)]
    assert run("legal_plea_outcomes", people, **tables) == [
        (None, 0), ("Plead Guilty - Fine, Jail", 1), ("Plead down", 1)]


def test_felony_reduction_needs_both_classes(run):
    cases = [
        outcome(1, "x", 1, class_prior_to_plea_trial="Class 1", class_after_plea_trial="class 2"),
        outcome(2, "x", 1, class_prior_to_plea_trial="Class 2", class_after_plea_trial="Class 1"),
        outcome(3, "x", 2, class_prior_to_plea_trial="Class 2", class_after_plea_trial="Class 2"),
        outcome(4, "x", 3, class_prior_to_plea_trial="Class 2"),
    ]
    classes = [{"class": "Class 1", "ranking": 1}, {"class": "Class 2", "ranking": 2}]
    got = run("legal_fel_reduction", [member(1), member(2), member(3)], legal=cases, felony_classes=classes)
    assert got == [("lowered", 1), ("remained", 1)]


def test_one_case(run):
    cases = [outcome(1, "A", 1), outcome(1, "A", 1), outcome(2, "B", 2), outcome(3, "A", 2), outcome(4, None, 3)]
    people = [member(1), member(2), member(3)]
    assert run("legal_one_case", people, legal=cases) == [(None, 0), ("A", 2)]
    assert run("legal_one_case", people, {"timeframe": False}, legal=[
        *cases, case(9, 1, case_outcome="A", case_outcome_date="2020-01-01"), case(8, 2),
        case(7, 4, case_outcome="C")]) == [(None, 0)]
    assert run("legal_one_case", [member(4)], {"timeframe": False}, legal=[case(7, 4, case_outcome="C")]) == [("C", 1)]
    assert run("legal_one_case", people, {"literal": True}, legal=cases) == [(None, 0), ("A", 3), ("B", 1)]


def test_case_status_lags(run):
    cases = [
        case(1, charge="Felony", arrest_date="2023-05-01", case_status_current="CASE PENDING"),
        case(2, charge="misdemeanor", arrest_date="2023-03-02", case_outcome="Dismissed"),
        case(3, charge="Felony", arrest_date="2023-03-01", case_outcome="Dismissed"),
    ]
    assert run("legal_case_statuses", [member(1, "2023-05-01")], legal=cases) == [
        ("CASE PENDING", 1, 0), ("Dismissed", 0, 1)]


def test_rearrest_and_first_charge(run):
    cases = [
        case(1, charge="Felony", case_type="gun", arrest_date="2022-01-01"),
        case(2, charge="Felony", case_type="drug", arrest_date="2022-06-01"),
        case(3, charge="Felony", case_type="drug", arrest_date="2023-06-01"),
        case(4, 2, charge="Felony", case_type="drug", arrest_date="2023-06-01"),
        case(5, 2, charge="Felony", case_type="drug", arrest_date="2023-06-01"),
        case(6, 3, charge="Felony", case_type="drug", arrest_date="2023-06-01"),
    ]
    closes = [{"participant_id": 1, "last_closed_date": "2022-03-01"}, {"participant_id": 2}]
    people = [member(1), member(2), member(3)]
    tables = {"legal": cases, "last_close": closes}
    assert run("legal_rearrested", people, **tables) == [(1,)]
    assert run("legal_case_type_first", people, **tables) == [("drug", 3, 0)]
    assert run("legal_case_type", people, **tables) == [("drug", 4, 0)]
    assert run("legal_case_type", people, {"case_client": "client"}, **tables) == [("drug", 2, 0)]


def test_involvement_has_every_outcome(run):
    cases = [outcome(i, f"A{i:02}", class_prior_to_plea_trial="c") for i in range(1, 31)]
    cases += [outcome(40, "A", 2), outcome(41, None, 2)]
    people = [member(1), member(2)]
    got = run("legal_program_involvement", people, legal=cases, columns=["participant_id", "n_cases", "cases"])
    assert [(r[0], r[1], len(r[2])) for r in got] == [(1, 30, 30), (2, 2, 2)]
    assert [c.case_outcome for c in got[0][2]] == [f"A{i:02}" for i in range(1, 31)]


def test_involvement_side_by_side(run):
    cases = [outcome(1, "A"), outcome(2, "B", class_prior_to_plea_trial="c"), outcome(3, "A", 2)]
    people = [member(1), member(2)]
    wide = "legal_program_involvement_wide"
    got = run(wide, people, {"slots": 2}, legal=cases,
              columns=["participant_id", "case_outcome_1", "charge_2", "case_outcome_2", "n_cases", "successful"])
    assert got == [(1, "A", "c", "B", 2, 0), (2, "A", None, None, 1, 0)]
    for column in ("charge_1", "case_outcome_1", "n_cases"):
        with pytest.raises(Exception, match="more than 1 outcomes"):
            run(wide, people, {"slots": 1}, legal=cases, columns=["participant_id", column])


def test_involvement_as_wide_as_the_data(run):
    wide = "legal_program_involvement_wide"
    cases = [outcome(i, f"A{i:02}") for i in range(1, 13)] + [outcome(20, "B", 2), outcome(21, "C", 9)]
    got = run(wide, [member(1), member(2)], legal=cases,
              columns=["participant_id", "case_outcome_1", "case_outcome_12", "n_cases"])
    assert got == [(1, "A01", "A12", 12), (2, "B", None, 1)]
    with pytest.raises(Exception, match="case_outcome_13"):
        run(wide, [member(1)], legal=cases, columns=["case_outcome_13"])
    assert run(wide, [member(3)], legal=cases, columns=["participant_id", "n_cases"]) == []


# -- linkages -----------------------------------------------------------------


def link(linkage_id, pid=1, **more):
    return {"linkage_id": linkage_id, "participant_id": pid, "hub_initiated": "yes", **more}


def test_goal_areas(run):
    linked = {"linked_date": "2023-01-01"}
    links = [link(1, goal_area="A, B", **linked), link(2, goal_area="A,B", **linked),
             link(3, goal_area="", **linked), link(4, **linked), link(5, goal_area="late", linked_date="2024-01-01"),
             link(6, goal_area=", ".join(f"g{i:02d}" for i in range(12)), **linked)]
    got = run("link_goal_area", [member(1)], linkages=links)
    assert got == [("", 1), ("A", 1), ("A,B", 1), ("B", 1)] + [(f"g{i:02d}", 1) for i in range(12)]


def test_month_limit_takes_the_nearest_start(run):
    people = [{"participant_id": 1, "birth_date": "2010-01-01"}]
    tables = {"participants": people, "linkages": [link(1, linkage_type="Education", linked_date="2023-07-01")]}
    twice = [member(1, "2022-01-01"), member(1, "2023-06-20")]
    assert run("link_edu_job", twice, {"first_n_months": 1}, **tables) == [(1,)]
    assert run("link_edu_job", twice[:1], {"first_n_months": 1}, **tables) == [(0,)]
    assert run("link_edu_job", twice[:1], **tables) == [(1,)]
    # A linkage on the day of the start does not follow it.
    assert run("link_edu_job", [member(1, "2023-07-01")], {"first_n_months": 1}, **tables) == [(0,)]


# -- programs -----------------------------------------------------------------


def session(sid, hours, pid=1, **more):
    return {"case_session_id": sid, "participant_id": pid, "session_date": "2023-05-01",
            "session_casenote": "CASENOTE", "hours": hours, **more}


def test_session_bands_count_per_cohort_row(run):
    sessions = [session(1, 0.25), session(2, 0.0), session(3, None), session(4, 2.0), session(5, 2.01),
                session(6, 1.0, contact_type="unsuccessful attempt"), session(7, 3.0, 9)]
    got = run("programs_session_length_grouped", [member(1), member(1)], case_sessions=sessions)
    assert got == [(None, 0), ("0", 4), ("0-.25", 2), ("1.76-2", 2), ("2+", 2)]
    tally = run("programs_session_tally", [member(1), member(1)], case_sessions=sessions)
    assert tally == [(1, 4)]


def test_session_length_is_weighted(run):
    sessions = [session(1, 1.0), session(2, 3.0, 2), session(3, 0.0, 2)]
    got = run("programs_session_length", [member(1), member(1), member(2)], case_sessions=sessions)
    assert got == [((1.0 * 2 + 3.0) / 4 * 60, (1.0 * 2 + 3.0) / 3 * 60)]


def test_neighborhood_partners(run):
    people = [member(i, program=p) for i, p in enumerate(
        ["RCT", "rct - build, RCT", "RCT, Other", "RCT - NLC", "RCT - Breakthrough", "RCT - Target", "none"])]
    assert run("programs_rct_neighborhoods", people) == [(6, 3, 1, 1, 1, 1)]


def test_new_clients_have_a_row_without_any(spark):
    import __spark_entry__ as entry

    found = entry.queries()["grouped_by_status_no_new_clients"](spark, "/root/testdata/sf0.01").collect()
    by_status = {r.client_status: r for r in found}
    assert [r.client_status for r in found][1] == "new client"
    assert set(by_status["new client"][1:]) == {0}
    assert sum(by_status["active client"][1:]) > 0


# -- fixtures -------------------------------------------------------------------


@pytest.mark.parametrize(("base", "views"), [
    ("orders", ["pstatus", "grant_type", "legal", "trunc_legal", "address", "neighborhoods"]),
    ("lineitem", ["linkages", "case_sessions"]),
    ("events", ["critical_incidents", "mediations", "mediation_followup"]),
    ("customer", ["participants", "classes"]),
    ("documents", ["documents_unfiltered"]),
])
def test_views_hold_every_row(spark, base, views):
    from caseweave.sources.fixtures import fixture_sources

    sf = "/root/testdata/sf0.001"
    n = spark.read.parquet(f"{sf}/{base}.parquet").count()
    s = fixture_sources(spark, sf)
    assert {v: s[v].count() for v in views} == dict.fromkeys(views, n)


# -- funders ------------------------------------------------------------------


def test_class_notes_count_every_word(flat, sources, window, rows):
    words = " ".join(f"w{i}" for i in range(40))
    s = sources(classes=[
        {"participant_id": 1, "class": "2023 idhs vp North", "summary_note": words + "; GSW/GSW"},
        {"participant_id": 1, "class": "2023 IDHS VP", "unenroll_date": "2022-12-31", "summary_note": "old"},
        {"participant_id": 2, "class": "2023 IDHS VP", "summary_note": "stranger"},
    ])
    ctx = ReportContext(s, window, flat(member(1)))
    got = dict(rows(run_query(ctx, "idhs_class_notes")))
    assert len(got) == 41 and got["GSW"] == 2 and got["w39"] == 1


def test_class_notes_fold_case_and_keep_letters(flat, sources, window, rows):
    s = sources(classes=[
        {"participant_id": 1, "class": "2023 IDHS VP", "summary_note": "DV dv José gsw, ÉTÉ été 7é"},
        {"participant_id": 1, "class": "2025 other", "summary_note": "later"},
    ])
    ctx = ReportContext(s, window, flat(member(1)))
    got = dict(rows(run_query(ctx, "idhs_class_notes")))
    assert got == {"DV": 2, "José": 1, "gsw": 1, "ÉTÉ": 2, "7é": 1}
    apart = dict(rows(run_query(ctx, "idhs_class_notes", literal=True)))
    assert apart == {"DV": 1, "dv": 1, "José": 1, "gsw": 1, "ÉTÉ": 1, "été": 1, "7é": 1}
    assert rows(run_query(ctx, "idhs_class_notes", class_text="2025")) == [("later", 1)]


def test_hours_average_ignores_unknown_sums(run):
    people = [member(i, program="JAC - Case Management") for i in (1, 2, 3)]
    sessions = [session(1, 2.0), session(2, 4.0), session(3, None, 2), session(4, 1.0, 3)]
    assert run("jac_cm_hours", people, program="jac", case_sessions=sessions) == [(3.5,)]
    assert run("jac_cm_sessions", people, program="jac", case_sessions=sessions) == [(1.5,)]
    assert run("jac_transpo_assist", [member(1, program="jac", crws=1), member(2, program="JAC")]) == [(1,)]


def test_unknown_options_are_errors(run):
    with pytest.raises(ValueError, match="no column"):
        run("programs_service_tally", [], {"service_column": "nope"})
    with pytest.raises(ValueError, match="demographic"):
        run("programs_by_demographic", [], {"demographic": "height"})
    with pytest.raises(ValueError, match="linkage date"):
        run("link_tally", [], {"timeframe": True, "started_linked": "sometime"})
    with pytest.raises(ValueError, match="link type"):
        run("link_edu_job", [], {"link_type": "sport"})
    with pytest.raises(KeyError, match="unknown query"):
        run("nothing", [])
