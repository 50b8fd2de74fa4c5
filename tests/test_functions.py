"""Building blocks against their plain forms."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from caseweave.functions import aggregates as agg
from caseweave.functions.dates import ReportWindow, add_years, age_years
from caseweave.functions.matching import ci_rlike, flag
from caseweave.functions.percentages import percentage_convert
from caseweave.functions.ranking import numbered_rows
from caseweave.sources.catalog import Sources, conform, normalise_categories


def test_window_checks_its_order():
    with pytest.raises(ValueError, match="starts after"):
        ReportWindow("2023-02-01", "2023-01-01")
    assert ReportWindow("2023-02-01", dt.date(2023, 2, 1)).t1 == dt.date(2023, 2, 1)


def test_ages_on_leap_days(spark):
    row = spark.sql("SELECT DATE '2004-02-29' b, DATE '2022-02-28' a").select(
        age_years("b", "a").alias("age"), add_years("b", 18).alias("birthday")
    ).first()
    assert (row.age, row.birthday) == (17, dt.date(2022, 2, 28))


def test_distinct_flags_equal_count_distinct(spark, rows):
    df = spark.range(5000).selectExpr(
        "id % 7 AS g", "CASE WHEN id % 11 > 0 THEN id % 97 END AS k", "id % 5 AS v"
    )
    flags = {"a": F.col("v") > 2, "b": F.col("v") == 0}
    got = agg.distinct_flags(df, ["g"], "k", flags)
    want = df.groupBy("g").agg(
        *[F.countDistinct(F.when(c, F.col("k"))).alias(n) for n, c in flags.items()]
    )
    assert rows(got) == rows(want)


def test_distinct_flags_keep_groups_without_keys(spark, rows):
    df = spark.sql("SELECT 'x' g, CAST(NULL AS BIGINT) k, true v")
    assert rows(agg.distinct_flags(df, ["g"], "k", {"n": F.col("v")})) == [("x", 0)]
    assert rows(agg.distinct_flags(df.limit(0), [], "k", {"n": F.col("v")})) == [(0,)]


def test_extreme_rows_keep_ties(spark, rows):
    df = spark.sql(
        "SELECT * FROM VALUES (1, DATE '2023-01-01', 'a'), (1, DATE '2023-02-01', 'b'),"
        " (1, DATE '2023-02-01', 'c'), (2, NULL, 'd') AS t(k, d, v)"
    )
    assert rows(agg.latest_rows(df, "k", "d"), "v") == [("b",), ("c",)]
    only = df.where("v = 'b'").select("k").distinct()
    assert rows(agg.latest_rows(df, "k", "d", among=only), "v") == [("b",), ("c",)]
    assert agg.latest_rows(df, "k", "d", among=only.limit(0)).count() == 0


def test_concat_of_nothing_is_null(spark, rows):
    df = spark.sql("SELECT * FROM VALUES (1, 'b'), (1, 'a'), (1, 'b'), (2, NULL) AS t(k, v)")
    got = df.groupBy("k").agg(agg.concat_distinct("v", ", ").alias("v"))
    assert rows(got) == [(1, "a, b"), (2, None)]


def test_numbered_rows_equal_row_number(spark, rows):
    df = spark.range(3000).selectExpr(
        "id", "CASE WHEN id % 3 = 0 THEN 0 ELSE id % 50 END AS k",
        "CASE WHEN id % 4 > 0 THEN id % 4 END AS c", "hash(id) AS f",
    )
    got = numbered_rows(df, "k", {"c": F.col("c")}, [F.col("f"), F.col("id")])
    want = df.selectExpr(
        "*", "CAST(row_number() OVER (PARTITION BY k ORDER BY c DESC NULLS LAST, f, id) AS INT) rn"
    )
    assert rows(got) == rows(want)


def test_flag_and_regex(spark):
    row = spark.sql("SELECT 'AB_ASSM' s, CAST(NULL AS STRING) n").select(
        flag(ci_rlike("s", "_AM*")).alias("a"), flag(ci_rlike("s", "zz")).alias("b"),
        flag(ci_rlike("n", "a")).alias("c"),
    ).first()
    assert tuple(row) == (1, None, None)


def test_percentages(spark):
    df = spark.sql("SELECT * FROM VALUES ('b', 1L, 0L), ('a', 2L, 0L) AS t(g, n, z)")
    order = [F.col("g")]
    numeric = [tuple(r) for r in percentage_convert(df, order=order).collect()]
    assert numeric == [("a", 66.67, None), ("b", 33.33, None), ("Total", 3.0, 0.0)]
    text = [tuple(r) for r in percentage_convert(df, as_text=True, order=order).collect()]
    assert text == [("a", "66.67%", None), ("b", "33.33%", None), ("Total", "3", "0")]
    added = percentage_convert(df.drop("z"), replace=False, order=order)
    assert added.columns == ["g", "n", "percentage_n"]
    assert [tuple(r) for r in added.collect()] == [("a", 2, 66.67), ("b", 1, 33.33), ("Total", 3, 3.0)]


def test_percentages_round_half_to_even(spark):
    df = spark.sql("SELECT * FROM VALUES ('a', 1L), ('b', 31L) AS t(g, n)")
    assert percentage_convert(df, order=[F.col("g")]).first().n == 3.12


def test_sources_conform_and_report_missing_columns(spark):
    raw = spark.sql("SELECT 1 participant_id, '2023-01-02' last_closed_date, 5 extra")
    out = conform("last_close", raw)
    assert out.dtypes == [("participant_id", "bigint"), ("last_closed_date", "date")]
    with pytest.raises(ValueError, match="lacks columns"):
        conform("last_close", raw.drop("last_closed_date"))
    with pytest.raises(KeyError, match="unknown source"):
        Sources.of({})["nothing"]


def test_sources_from_parquet_and_catalog(spark, tmp_path, rows):
    raw = spark.sql("SELECT 1L participant_id, DATE '2023-01-02' last_closed_date")
    raw.write.parquet(str(tmp_path / "last_close"))
    assert rows(Sources.parquet(spark, str(tmp_path)).last_close) == [(1, "2023-01-02")]
    raw.createOrReplaceTempView("closings")
    assert rows(Sources.catalog(spark, {"last_close": "closings"}).last_close) == [(1, "2023-01-02")]
    other = Sources.of({}).replaced(last_close=raw)
    assert other.last_close.count() == 1


def test_normalised_categories(spark, rows):
    df = spark.sql("SELECT * FROM VALUES ('asian '), ('ASIAN'), ('other'), (NULL) AS t(race)")
    got = normalise_categories(df, {"race": ["Asian", "White"]})
    assert rows(got) == [(None,), ("Asian",), ("Asian",), ("other",)]


def test_percentages_stand_behind_all_columns(spark):
    df = spark.sql("SELECT * FROM VALUES ('a', 1L, 3L), ('b', 3L, 1L) AS t(k, x, y)")
    out = percentage_convert(df, replace=False, order=[F.col("k")])
    assert out.columns == ["k", "x", "y", "percentage_x", "percentage_y"]
    assert [tuple(r) for r in out.collect()] == [
        ("a", 1, 3, 25.0, 75.0), ("b", 3, 1, 75.0, 25.0), ("Total", 4, 4, 4.0, 4.0),
    ]


def test_fixed_order_with_nulls(spark):
    df = spark.sql("SELECT * FROM VALUES (NULL), ('z'), ('low'), ('HIGH') AS t(v)")
    ranked = [r.v for r in agg.order_by_rank(df, "v", ["high", "low"]).collect()]
    assert ranked == ["HIGH", "low", "z", None]
    first = agg.order_by_rank(df, "v", ["high", "low"], nulls_first=True)
    assert [r.v for r in first.collect()] == [None, "HIGH", "low", "z"]


def test_folded_spellings(spark, rows):
    from caseweave.functions.aggregates import distinct_flags
    from caseweave.functions.categories import folded

    spelled = [("Niño", 1), ("nino  ", 1), ("NINO", 2), ("nina", 3), (None, 4), (" nino", 5), ("", 6)]
    df = spark.createDataFrame(spelled, "area string, id long")
    got = folded(df, ["area"], ["area"], {"n": F.count(F.lit(1))})
    assert got.schema["area"].dataType.simpleString() == "string"
    assert rows(got) == [(None, 1), ("", 1), (" nino", 1), ("NINO", 3), ("nina", 1)]
    # one id with two spellings counts once
    flags = {"low": F.col("id") < 3, "all": F.lit(True)}
    counted = distinct_flags(df, ["area"], "id", flags, ["area"])
    assert rows(counted) == [
        (None, 0, 1), ("", 0, 1), (" nino", 0, 1), ("NINO", 2, 2), ("nina", 0, 1),
    ]


def test_looked_up(spark, rows):
    from caseweave.functions import joins

    ranks = spark.createDataFrame(
        [("Low", 1), ("HIGH", 3), ("high", 2), (None, 9), ("none", None)], "name string, ranking int"
    )
    df = spark.createDataFrame([("low",), ("High",), ("none",), ("x",), (None,)], "v string")
    got = df.select("v", joins.looked_up(ranks, "name", "ranking", F.col("v")).alias("r"))
    assert rows(got) == [(None, None), ("High", 3), ("low", 1), ("none", None), ("x", None)]
    nothing = df.select(joins.looked_up(ranks.where("false"), "name", "ranking", F.col("v")).alias("r"))
    assert set(nothing.collect()) == {(None,)}


def test_a_lookup_is_small(spark, monkeypatch):
    from caseweave.functions import joins

    monkeypatch.setattr(joins, "MAX_LOOKUP", 10)
    many = spark.range(12).selectExpr("cast(id as string) AS name", "cast(id as int) AS ranking")
    df = many.select(joins.looked_up(many, "name", "ranking", F.col("name")).alias("r"))
    with pytest.raises(Exception, match="more than 10 texts"):
        df.collect()
    few = many.where("ranking < 10")
    assert many.select(joins.looked_up(few, "name", "ranking", F.col("name")).alias("r")).count() == 12
