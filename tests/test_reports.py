"""Report bundles, sinks and ad-hoc SQL."""

from __future__ import annotations

import re
from collections import Counter

import pytest

import __spark_entry__ as entry
from caseweave.plans import context as cx
from caseweave.plans import reports as rp
from caseweave.plans.adhoc import query_run, register_views
from caseweave.plans.queries import QUERIES, run_query, shared_tables
from verification.compare import oracle_connection
from verification.oracle import ORDERS, oracle

SF = "/root/testdata/sf0.001"
BUNDLES = {
    "a2j": (rp.A2J_REPORT, entry._a2j, 3),
    "monthly programs": (rp.MONTHLY_PROGRAM_GRANT, entry._monthly, 11),
    "monthly legal": (rp.MONTHLY_LEGAL, entry._monthly, 9),
    "monthly sessions": (rp.MONTHLY_CM_OUTREACH, entry._monthly, 9),
    "smartsheet": (rp.JAC_SMARTSHEET, entry._jac, 10),
    "cvi": (rp.CVI, entry._jac, 11),
    "ppr": (rp.PPR, entry._jac, 11),
}


@pytest.mark.parametrize("bundle", list(BUNDLES))
def test_bundles_build(spark, bundle):
    report, context, size = BUNDLES[bundle]
    blocks = rp.build_report(report, context(spark, SF))
    assert list(blocks) == list(report) and len(blocks) == size
    assert all(df.columns for df in blocks.values())
    assert len({rp.block_folder(b) for b in blocks}) == size


def test_unknown_query_is_an_error(spark):
    with pytest.raises(KeyError, match="no_such"):
        rp.build_report({"x": ("no_such", {})}, entry._jac(spark, SF))


@pytest.mark.parametrize("reliable", [False, True])
def test_written_report_equals_its_queries(spark, tmp_path, rows, reliable):
    ctx = entry._jac(spark, SF)
    report = {k: rp.JAC_SMARTSHEET[k] for k in ("participant count", "ages", "referrals")}
    folders = rp.write_report(report, ctx, str(tmp_path), reliable=reliable)
    assert set(folders) == set(report)
    for block, (name, options) in report.items():
        want = run_query(ctx, name, **options)
        got = spark.read.schema(want.schema).csv(folders[block], sep="\t", header=True)
        assert rows(got) == rows(want)
    with pytest.raises(Exception, match="(?i)exist"):
        rp.write_report(report, ctx, str(tmp_path))


def test_written_as_parquet(spark, tmp_path, rows):
    ctx = entry._a2j(spark, SF)
    folders = rp.write_report({"LINKAGES": rp.A2J_REPORT["LINKAGES"]}, ctx, str(tmp_path), "parquet")
    assert rows(spark.read.parquet(folders["LINKAGES"])) == rows(run_query(ctx, "a2j_linkages"))


def test_shared_cohort_is_released(spark):
    ctx = entry._general(spark, SF)
    with rp.shared_cohort(ctx) as shared:
        kept = shared.cohort.episodes
        assert kept.is_cached
        assert shared.cohort.people().count() == ctx.cohort.people().count()
    assert not kept.is_cached


def test_a_report_shows_swapped_rows(spark):
    """Same cells, other rows: the report differs; also if only the order differs."""
    report = {"types": ("legal_case_type", {}), "races": ("dem_race_gender", {})}
    plain = spark.createDataFrame([("a", 1), ("b", 2)], "label string, n int")
    swapped = spark.createDataFrame([("a", 2), ("b", 1)], "label string, n int")

    def shown(first, second):
        blocks = {"types": first, "races": second}
        return Counter(map(tuple, rp.report_rows(report, blocks).collect()))

    assert shown(plain, plain) != shown(swapped, plain)
    assert shown(plain, plain) != shown(plain, swapped)
    turned = plain.orderBy(plain.label.desc())
    assert shown(plain.orderBy("label"), plain) != shown(turned, plain)
    assert shown(plain.orderBy("label"), plain) == shown(plain.orderBy("label"), turned)


def test_long_digits_are_shown(spark):
    odd = spark.createDataFrame(
        [("12345678901234567890123", 9_007_199_254_740_993, 1e300)], "t string, n long, d double"
    )
    report = {"x": ("dem_race_gender", {})}
    content = rp.report_rows(report, {"x": odd}).first().content
    assert content == "d=1.0E300; n=9007199254740993.0000; t=12345678901234567890123"


@pytest.mark.parametrize("name", list(ORDERS))
def test_rows_come_in_order(spark, name):
    found = entry.queries()[name](spark, SF)
    got = [tuple(r[c] for c in sorted(found.columns)) for r in found.collect()]
    con = oracle_connection(SF)
    cur = con.execute(f"SELECT * FROM ({oracle()[name]}) ORDER BY {ORDERS[name]}")
    names = [d[0] for d in cur.description]
    want = [tuple(r[names.index(c)] for c in sorted(names)) for r in cur.fetchall()]
    assert len(want) > 1
    if name == "legal_case_statuses":  # a text that is status and outcome has two rows
        by = names.index("case_status_current")
        at = sorted(names).index("case_status_current")
        assert [r[at] for r in got] == [r[at] for r in want] and sorted(names)[by] is not None
    else:
        assert got == want


def test_session_blocks_read_sessions_once(spark):
    report = rp.MONTHLY_CM_OUTREACH
    assert shared_tables(report.values()) == ["case_sessions", "linkages"]
    assert shared_tables(rp.JAC_SMARTSHEET.values()) == ["case_sessions"]
    assert shared_tables(rp.MONTHLY_LEGAL.values()) == []
    with rp.shared_inputs(entry._monthly(spark, SF), report) as shared:
        rows = rp.report_rows(report, rp.build_report(report, shared))
        # sessions and linkages are read from what is kept, not from their files again
        text = rows._jdf.queryExecution().optimizedPlan().toString()
        files = [x for x in text.splitlines() if re.search(r"(?<!InMemory)Relation \[", x)]
        assert "InMemoryRelation" in text and not [x for x in files if "l_orderkey" in x]
        again = rp.report_rows(report, rp.build_report(report, entry._monthly(spark, SF)))
        text = again._jdf.queryExecution().optimizedPlan().toString()
        assert "l_orderkey" in text


def test_hd_context_keeps_hd_rows(spark):
    c = cx.hd_context(entry._sources(spark, SF), entry.WINDOW).cohort.rows()
    assert {r.hd for r in c.select("hd").collect()} == {1}


def test_adhoc_sql_binds_parameters(spark):
    names = register_views(entry._general(spark, SF), prefix="t_", sources=["legal"])
    assert names == ["t_cohort", "t_legal"]
    sql = "SELECT count(DISTINCT c.participant_id) AS n FROM t_cohort c JOIN t_legal USING (participant_id) WHERE case_type = :kind"
    assert query_run(spark, sql, {"kind": "gun"}).first().n > 0
    assert query_run(spark, sql, {"kind": "gun' OR '1'='1"}).first().n == 0


def test_every_query_is_registered():
    keys = " ".join(entry.queries())
    renamed = {"dem_age_list", "link_edu_job"}
    assert [n for n in QUERIES if n not in keys and n not in renamed] == []
