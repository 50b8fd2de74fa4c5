"""Grant rules, flags and the equality of the two cohort forms."""

from __future__ import annotations

import pytest

from caseweave.fixed_values import PACKAGE_LABELS
from caseweave.operators import classify as cl
from caseweave.operators.cohort import FlatCohort
from caseweave.plans import context as cx
from caseweave.plans.queries import QUERIES, run_query

import __spark_entry__ as entry

ACTIVE = [{"status_id": 1, "participant_id": 1, "status_date": "2023-05-01", "pstatus": "Active"}]


def person(**more):
    return [{"participant_id": 1, "first_name": "A", "last_name": "B", **more}]


def grant(**values):
    return [{"participant_id": 1, "start_date": "2023-02-01", **values}]


@pytest.fixture()
def built(sources, window):
    def run(grants, people=None, **options):
        s = sources(pstatus=ACTIVE, participants=people or person(), grant_type=grants)
        return cl.build_cohort(s, window, **options)

    return run


@pytest.mark.parametrize(
    ("values", "kept"),
    [
        ({"grant_type": "jac hd"}, 1),
        ({"grant_type": "Other", "comments": "moved to CRWS"}, 1),
        ({"grant_type": "Other"}, 0),
        ({"grant_type": "scan outreach"}, 0),
        ({"grant_type": "DFSS - SCaN Outreach"}, 1),
        ({"grant_type": None}, 0),
        ({"grant_type": "YIP", "end_date": "2022-12-31"}, 0),
        ({"grant_type": "YIP", "end_date": "2023-01-01"}, 1),
        ({"grant_type": "YIP", "start_date": "2024-02-01"}, 1),
        ({"grant_type": "YIP", "start_date": "2024-02-01", "end_date": "2024-03-01"}, 0),
    ],
)
def test_grant_rules(built, values, kept):
    assert built(grant(**values)).rows().count() == kept


def test_ungranted_rows_can_be_kept(built, rows):
    assert rows(built([], keep_ungranted=True).rows(), "grant_type") == [(None,)]
    assert rows(built(grant(grant_type=None), keep_ungranted=True).rows(), "grant_type") == [(None,)]
    assert built(grant(grant_type="Other"), keep_ungranted=True).rows().count() == 0


def test_flags_are_one_or_null(built):
    row = built(grant(grant_type="IDHS VP"), person(program_type="rct - BUILD")).rows().first()
    assert (row.service_legal, row.service_cm, row.hd, row.hd_rct, row.vp) == (1, 1, 1, 1, 1)
    assert (row.cm_juv_divert, row.cm_scan, row.rjcc, row.crws) == (None,) * 4


def test_days_served_and_age_of_monthly_cohort(sources, window, rows):
    history = [
        {"status_id": i, "participant_id": p, "status_date": d, "pstatus": s}
        for i, (p, d, s) in enumerate([
            (1, "2023-01-01", "Active"), (1, "2023-02-15", "Closed"),
            (2, "2022-12-31", "Active"), (2, "2023-03-31", "Closed"),
            (3, "2023-12-31", "Active"),
        ])
    ]
    people = [
        {"participant_id": 1, "birth_date": "2005-01-02"},
        {"participant_id": 2, "birth_date": "2005-01-01"},
        {"participant_id": 3},
    ]
    s = sources(
        pstatus=history, participants=people,
        grant_type=[{"participant_id": p, "grant_type": "YIP", "start_date": "2023-01-01"} for p in (1, 2, 3)],
    )
    monthly = cx.monthly_context(s, window).cohort.rows()
    assert rows(monthly, "participant_id", "days_served", "client_status", "new_client", "age", "days_to_t2") == [
        (1, "0-45", "closed out", "new client", "juvenile", 364),
        (2, "46-90", "closed out", None, "emerging adult", 365),
        (3, "0-45", "active client", "new client", "emerging adult", 0),
    ]


def test_negative_days_fall_in_the_rest_band(spark, table, window):
    flat = spark.sql(
        "SELECT 1L participant_id, DATE '2023-02-04' active_date, DATE '2023-02-01' closed_date"
        " UNION ALL SELECT 1L, NULL, NULL"
    )
    people = table("participants", person())
    out = cl.monthly_cohort(flat, people, window).rows()
    assert {r.days_served for r in out.collect()} == {"271+"}


def test_a2j_lists_a_person_per_cohort_row(sources, window, rows):
    history = [
        {"status_id": i, "participant_id": 1, "status_date": d, "pstatus": s}
        for i, (d, s) in enumerate([
            ("2023-01-01", "Active"), ("2023-02-01", "Closed"), ("2023-03-01", "Active"),
        ])
    ]
    s = sources(
        pstatus=history, participants=person(race="hispanic/latinx"),
        grant_type=grant(grant_type="A2J") + grant(grant_type="a2j plus"),
        address=[
            {"address_id": 9, "participant_id": 1, "primary_address": "Yes", "entered_date": "2020-01-01", "zip": "9"},
            {"address_id": 8, "participant_id": 1, "primary_address": "yes", "entered_date": "2020-01-01", "zip": "8"},
            {"address_id": 1, "participant_id": 1, "primary_address": "No", "entered_date": "2023-01-01", "zip": "1"},
        ],
        legal=[{"case_id": 1, "participant_id": 1, "case_type": "gun"}],
    )
    listed = cx.a2j_context(s, window).cohort.rows()
    assert rows(listed, "participant_id", "zip", "hispanic_latino", "case_type") == [(1, "8", "Yes", None)] * 4


OPTIONS = {
    "programs_service_tally": [{"service_column": name} for name, _ in PACKAGE_LABELS[:3]],
    "grant_tally": [{}, {"start_end": "start_date"}, {"start_end": "end_date"}],
    "legal_program_involvement_wide": [{"slots": 8}],
    "dem_age_tally": [{"cutoff": "t2"}, {"new_clients": True}],
    "legal_case_type": [{"timeframe": True, "case_client": "client"}],
    "link_edu_job": [{"first_n_months": 2}, {"link_type": "employment", "cutoff": "active_date"}],
    "legal_custody_list": [{"cutoff": "1997-06-30"}],
    "programs_by_demographic": [{"demographic": "age"}, {"demographic": "gender"}],
}
FUNDER = {n for n in QUERIES if n.startswith(("idhs_", "jac_"))}
MONTHLY = {"grouped_by_status", "grouped_by_time"}
ROUNDED = {"overall", "successful", "overall_avg"}


@pytest.mark.parametrize("name", [n for n in QUERIES if not n.startswith(("a2j_", "incident", "mediation"))])
def test_flat_and_factored_cohort_agree(spark, rows, name):
    """The product of the two lists gives the same answers as the lists."""
    sf = "/root/testdata/sf0.001"
    make = entry._jac if name in FUNDER else entry._monthly if name in MONTHLY else entry._general
    ctx = make(spark, sf)
    flat = cx.ReportContext(ctx.sources, ctx.window, FlatCohort(ctx.cohort.rows()), ctx.program)

    def result(c, options):
        df = run_query(c, name, **options)
        got = rows(df, *sorted(df.columns))
        return [tuple(round(v, 6) if isinstance(v, float) else v for v in r) for r in got]

    for options in OPTIONS.get(name, [{}]):
        assert result(ctx, options) == result(flat, options)
