"""The registered queries: against their SQL, and with the columns and rows they promise."""

from __future__ import annotations

import pytest

import __spark_entry__ as entry
from caseweave.llm.queries import ORACLE, QUERIES
from verification.compare import difference, oracle_connection

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", list(ORACLE))
def test_query_matches_oracle(spark, name):
    assert difference(spark, oracle_connection(SF), SF, name) == ""


def test_one_query_per_operator():
    names = [n for n in entry.queries() if n.startswith("op")]
    assert {int(n[2:].split("_")[0]) for n in names} == set(range(1, 14))
    assert set(QUERIES) == set(names)
    assert "pipeline" in entry.queries() and "pipeline" not in entry.oracle_sql()


@pytest.mark.parametrize("name", list(QUERIES))
def test_one_row_per_document_or_page(spark, name):
    if name.startswith("op11_"):  # one row per word
        return
    table, key = {"op8": ("pages", "page_id"), "op13": ("embeddings", "vec_id")}.get(
        name.split("_")[0], ("documents", "doc_id")
    )
    base = spark.read.parquet(f"{SF}/{table}.parquet")
    found = QUERIES[name](spark, SF)
    ids = [r[key] for r in found.select(key).collect()]
    assert sorted(ids) == sorted(r[key] for r in base.select(key).collect())


@pytest.mark.parametrize("name", ["op3_license_scan", "op7_quality_rules"])
def test_native_queries_run_no_python(spark, name):
    plan = QUERIES[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan
