"""Sources stored by participant: same rows, and no shuffle for what is done by participant."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from caseweave.functions.joins import HOT_ROWS_CONF
from caseweave.sources.catalog import Sources
from verification import skewed
from verification.compare import difference, oracle_connection
from verification.plans import counts, plan_text

SF = "/root/testdata/sf0.001"
STATIC = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.enabled": "false",
}


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("bucketed")
    made = entry._sources(spark, SF).store_bucketed(spark, str(folder), "stored_cases", 4)
    yield made
    spark.sql("DROP DATABASE stored_cases CASCADE")


@pytest.fixture()
def over_stored(spark, stored, monkeypatch):
    monkeypatch.setattr(entry, "_sources", lambda s, d: stored)


@pytest.mark.parametrize(
    ("name", "exchanges"),
    [
        # the last exchange of a tally brings the partial counts together
        ("mreport", 0),
        ("classify_by_program", 0),
        ("legal_program_involvement", 0),
        ("legal_rearrested", 1),
        ("programs_sessions", 1),
        ("docs_has_formatted", 0),
        ("stints", 0),
    ],
)
def test_no_shuffle_by_participant(spark, over_stored, name, exchanges):
    before = {k: spark.conf.get(k) for k in STATIC}
    for k, v in STATIC.items():
        spark.conf.set(k, v)
    try:
        text = plan_text(entry.queries()[name](spark, SF))
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert counts(text)["exch"] == exchanges
    assert "hashpartitioning(participant_id" not in text


@pytest.mark.parametrize(
    "name",
    [
        "mreport", "legal_rearrested", "programs_sessions", "legal_case_type_opened",
        "dem_recent_address_neighborhood", "a2j_linkages", "idhs_class_notes",
    ],
)
def test_same_rows(spark, over_stored, name):
    assert difference(spark, oracle_connection(SF), SF, name) == ""


def test_hot_participants_are_stored(spark, tmp_path_factory, monkeypatch):
    folder = str(tmp_path_factory.mktemp("hot"))
    skewed.write(SF, folder)
    spark.conf.set(HOT_ROWS_CONF, "50")
    try:
        plain = entry._sources(spark, folder)
        target = str(tmp_path_factory.mktemp("bucketed-hot"))
        made = plain.store_bucketed(spark, target, "stored_hot", 4)
        kept = {r.participant_id: r["_parts"] for r in made.hot_keys("legal").parts.collect()}
        fresh = plain.hot_keys("legal").parts.collect()
        assert kept == {r.participant_id: r["_parts"] for r in fresh} and kept[1] > 5
        monkeypatch.setattr(entry, "_sources", lambda s, d: made)
        for name in ("mreport", "legal_case_statuses", "a2j_cases"):
            assert difference(spark, oracle_connection(folder), folder, name) == ""
        spark.conf.set(HOT_ROWS_CONF, "3000000")  # another limit: measured anew
        assert made.hot_keys("legal").none
    finally:
        spark.conf.unset(HOT_ROWS_CONF)
        spark.sql("DROP DATABASE IF EXISTS stored_hot CASCADE")


def test_sources_that_measure_nothing(spark, rows):
    plain = entry._sources(spark, SF)
    silent = Sources(lambda n: plain[n], None)
    assert silent.hot_keys("legal") is None
    assert silent.replaced(legal=plain.legal).hot_keys("legal") is None
    fewer = plain.replaced(legal=plain.legal.where(F.col("case_id") % 2 == 0))
    assert fewer.hot_keys("legal").none and fewer.hot_keys("linkages") is plain.hot_keys("linkages")
