"""One participant with a third of all orders: same answers, in joins that split the load."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from caseweave.functions.joins import (
    HOT_ROWS_CONF,
    HotKeys,
    dealt,
    hot_keys,
    measured_hot_keys,
    repeated,
    spread_join,
)
from verification import skewed
from verification.compare import difference, oracle_connection

QUERIES = [
    "status_wide", "stints", "stint_case_tally", "stints_plus_count", "classify_by_program",
    "classify_concat", "grant_cohort", "dem_recent_address_neighborhood",
    "dem_recent_address_neighborhood_latest", "docs_has_formatted", "grant_tally_started",
    "legal_custody_tally", "legal_in_custody_links", "legal_program_involvement",
    "legal_case_outcomes", "legal_case_statuses", "legal_one_case", "legal_case_type_first",
    "legal_rearrested", "link_education_first_months", "link_goal_area",
    "programs_session_tally", "programs_session_length_grouped", "grouped_by_status_program",
    "idhs_linkages", "idhs_class_notes", "a2j_cases", "a2j_linkages", "legal_case_type_opened",
    "jac_cm_sessions", "mreport",
]


@pytest.fixture(scope="module", autouse=True)
def low_limit(spark):
    """Split keys with more than 50 facts."""
    spark.conf.set(HOT_ROWS_CONF, "50")
    yield
    spark.conf.unset(HOT_ROWS_CONF)


@pytest.fixture(scope="module")
def hot(tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("hot"))
    skewed.write("/root/testdata/sf0.001", folder)
    return folder


def test_the_data_is_skewed(spark, hot):
    owners = spark.read.parquet(f"{hot}/orders.parquet").groupBy("o_custkey").count()
    total, top = owners.selectExpr("sum(count)", "max(count)").first()
    assert top > 0.3 * total


@pytest.mark.parametrize("name", QUERIES)
def test_hot_participant(spark, hot, name):
    assert difference(spark, oracle_connection(hot), hot, name) == ""


def test_spread_join_equals_join(spark, rows):
    facts = spark.range(3000).selectExpr(
        "id", "CASE WHEN id % 3 = 0 THEN 0 WHEN id % 100 = 1 THEN NULL ELSE id % 50 END AS k"
    )
    people = spark.range(40).selectExpr("id AS k", "id * 2 AS v")
    twice = people.unionByName(people.withColumn("v", people.v + 1))
    measured = measured_hot_keys(facts, "k")
    assert measured.known and measured.count == 1 and not measured.none
    other = hot_keys(twice, "k")
    for side in (people, twice):
        want = rows(facts.join(side, "k"), "id", "v")
        for options in ({}, {"hot": measured}, {"other_hot": other}, {"hot": measured, "other_hot": other}):
            assert rows(spread_join(facts, side, "k", **options), "id", "v") == want


def test_both_sides_are_dealt(spark):
    """A person with 10,000 listed rows and 10,000 cases: no task gets more than its parts."""
    listed = spark.range(10_000).selectExpr("id AS row_id", "7L AS k").repartition(8)
    cases = spark.range(10_000).selectExpr("id AS case_id", "7L AS k").repartition(8)
    hot, other = hot_keys(cases, "k"), hot_keys(listed, "k")
    left = repeated(dealt(cases, hot, "k"), other, "k", "_other")
    right = repeated(dealt(listed, other, "k", "_other"), hot, "k")
    for side in (left, right):
        parts = [r["count"] for r in side.groupBy("k", "_part", "_other").count().collect()]
        assert len(parts) == 200 * 200 and max(parts) <= 2 * 50
    # the same join on a part of it, all pairs there
    few = spread_join(cases.where("case_id < 300"), listed.where("row_id < 300"), "k", hot=hot, other_hot=other)
    assert few.distinct().count() == 90_000


def test_sketch_finds_every_hot_key(spark):
    """Many keys around the limit, and a long tail; nothing above the limit is missed."""
    facts = spark.range(200_000).selectExpr(
        "CASE WHEN id % 2 = 0 THEN id % 900 ELSE 1000000 + id END AS k", "id"
    )
    counts = {r.k: r["count"] for r in facts.groupBy("k").count().where("count > 50").collect()}
    found = {r.k: r["_parts"] for r in measured_hot_keys(facts, "k").parts.collect()}
    exact = {r.k: r["_parts"] for r in hot_keys(facts, "k").parts.collect()}
    assert exact == {k: -(-n // 50) for k, n in counts.items()}
    assert found.keys() >= exact.keys() and all(found[k] >= exact[k] for k in exact)


def test_exact_count_where_a_sketch_could_miss(spark, monkeypatch):
    from caseweave.functions import joins

    facts = spark.range(2000).selectExpr("id % 30 AS k")
    monkeypatch.setattr(joins, "SKETCH_ERROR", 0.5)
    found = measured_hot_keys(facts, "k")
    assert (found.known, found.count) == (True, 30)
    assert measured_hot_keys(facts.where("k < 0"), "k").none
    assert isinstance(found, HotKeys)


def test_no_part_exceeds_the_limit(spark):
    facts = spark.range(3000).selectExpr("CASE WHEN id % 3 = 0 THEN 0 ELSE id END AS k", "id").repartition(4)
    hot = hot_keys(facts, "k")
    assert [tuple(r) for r in hot.parts.collect()] == [(0, 20)]
    sizes = dealt(facts, hot, "k").groupBy("k", "_part").count()
    assert sizes.agg({"count": "max"}).first()[0] <= 2 * 50
    assert facts.count() == dealt(facts, hot, "k").count()


def test_parts_do_not_depend_on_the_order_of_rows(spark, rows):
    """A task that is run again may see its rows in another order."""
    facts = spark.range(2000).selectExpr("id % 2 AS k", "id AS fact_id", "cast(id AS string) AS note")
    hot = hot_keys(facts, "k")
    placed = facts.repartition(5, "note")
    one = dealt(placed.sortWithinPartitions("fact_id"), hot, "k")
    two = dealt(placed.sortWithinPartitions(F.desc("note")), hot, "k")
    assert rows(one, "fact_id", "_part") == rows(two, "fact_id", "_part")
    assert one.select("_part").distinct().count() > 1
