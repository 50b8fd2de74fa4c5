"""Every registered query against its independent SQL."""

from __future__ import annotations

import pytest

import __spark_entry__ as entry
from verification.compare import difference, oracle_connection

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def con():
    return oracle_connection(SF)


def test_every_query_has_an_oracle():
    assert set(entry._report_queries()) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", list(entry._report_queries()))
def test_query_matches_oracle(spark, con, name):
    assert difference(spark, con, SF, name) == ""


def test_anchor_values(spark):
    q = entry.queries()
    assert q["stints"](spark, SF).count() == 946
    assert q["stints_max_slots"](spark, SF).count() == 220
    cohort = q["classify_by_program"](spark, SF)
    sums = cohort.selectExpr(
        "count(*)", "count(DISTINCT participant_id)", "sum(service_legal)", "sum(service_cm)",
        "sum(cm_juv_divert)", "sum(cm_scan)", "sum(cm_scan_outreach)", "sum(hd)", "sum(hd_rct)",
        "sum(rjcc)", "sum(crws)", "sum(vp)",
    ).first()
    assert tuple(sums) == (3779, 820, 1440, 2934, 1021, 707, 522, 1223, 1047, 355, 829, 1030)
    assert q["grant_cohort"](spark, SF).count() == 2130


def test_entry(spark):
    df = entry.entry(spark)
    assert df.columns[0] == "client_status"
    assert df.count() == 3
