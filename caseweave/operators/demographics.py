"""Age, race, gender and address reports."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from caseweave.functions.aggregates import best_row
from caseweave.functions.dates import ReportWindow, add_years, age_years
from caseweave.functions.joins import HotKeys, spread_join
from caseweave.functions.matching import ci_contains, flag
from caseweave.functions.ranking import numbered_rows
from caseweave.operators.classify import best_addresses
from caseweave.operators.cohort import PID, AnyCohort, as_cohort, with_participant_columns
from caseweave.operators.people import count_by


def _scope(
    cohort: AnyCohort | DataFrame, window: ReportWindow, new_clients: bool
) -> AnyCohort:
    c = as_cohort(cohort)
    return c.where_episode(window.has("active_date")) if new_clients else c


def dem_age_tally(
    cohort: AnyCohort | DataFrame,
    participants: DataFrame,
    window: ReportWindow,
    age: int = 18,
    cutoff: str | dt.date = "active_date",
    new_clients: bool = False,
) -> DataFrame:
    """Participants below the age at the cutoff, and from that age to 25."""
    at = window.cutoff(cutoff)
    dates = (
        _scope(cohort, window, new_clients)
        .with_episode(_at=at)
        .distinct(episode=["_at"])
        .join(participants.select(PID, "birth_date"), PID)
    )
    per_person = dates.groupBy(PID).agg(
        F.max(flag(F.col("_at") < add_years("birth_date", age))).alias("juvenile"),
        F.max(flag(age_years("birth_date", "_at").between(age, 25))).alias("adult"),
    )
    return per_person.agg(F.count("juvenile").alias("juvenile"), F.count("adult").alias("adult"))


def dem_age_list(
    cohort: AnyCohort | DataFrame,
    participants: DataFrame,
    window: ReportWindow,
    age: int = 18,
    cutoff: str | dt.date = "active_date",
    new_clients: bool = False,
) -> DataFrame:
    """All cohort rows with an age group; an unknown birth date counts as adult."""
    c = _scope(cohort, window, new_clients)
    columns = c.columns
    dated = with_participant_columns(c, participants, ["birth_date"]).rows()
    group = F.when(
        window.cutoff(cutoff) < add_years("birth_date", age), F.lit("Juvenile")
    ).otherwise(F.lit("Adult"))
    return dated.select(*columns, group.alias("age_group"))


def dem_race_gender(
    cohort: AnyCohort | DataFrame,
    participants: DataFrame,
    window: ReportWindow,
    race_gender: str = "race",
    new_clients: bool = False,
) -> DataFrame:
    """Participants per race or gender."""
    people = _scope(cohort, window, new_clients).people()
    return count_by(people.join(participants.select(PID, race_gender), PID), race_gender, categories=[race_gender])


def dem_recent_address(cohort: AnyCohort | DataFrame, address: DataFrame) -> DataFrame:
    """Names and best address of each cohort participant."""
    named = as_cohort(cohort).distinct(service=["first_name", "last_name"])
    one_name = named.groupBy(PID).agg(
        F.min(F.struct("first_name", "last_name")).alias("_name")
    )
    return one_name.join(best_addresses(address), PID).select(
        "_name.first_name",
        "_name.last_name",
        PID,
        *[c for c in address.columns if c != PID],
    )


def dem_recent_address_neighborhood(
    cohort: AnyCohort | DataFrame,
    neighborhoods: DataFrame,
    latest_only: bool = False,
    hot: HotKeys | None = None,
) -> DataFrame:
    """Addresses with neighborhood, numbered per participant from the best one.

    Order: primary first, newest, places named 'other' or unnamed first among
    equals, lowest address_id. All rows are listed unless ``latest_only``.
    """
    out = [PID, "location", "primary_address", "entered_date", "updated_date", "neighborhood"]
    known = F.when(~ci_contains("neighborhood", "other"), F.lit(1)).otherwise(F.lit(0))
    primary, entered = F.lower("primary_address"), F.col("entered_date")
    people = as_cohort(cohort).people()
    if latest_only:
        order = [primary, entered, -known, -F.col("address_id")]
        best = best_row(neighborhoods, PID, order).join(people, PID, "left_semi")
        return best.select(*out, F.lit(1).alias("rn"))
    fine = [known.asc(), F.col("address_id").asc()]

    def in_parts(places: DataFrame) -> DataFrame:
        coarse = {"primary": primary, "entered": entered}
        return numbered_rows(places, PID, coarse, fine).select(*out, "rn")

    if hot is None:
        return in_parts(spread_join(neighborhoods, people, PID))
    # a person's places are numbered by one sort, unless they are known to be very many
    order = [primary.desc_nulls_last(), entered.desc_nulls_last(), *fine]
    number = F.row_number().over(W.partitionBy(PID).orderBy(*order))
    usual = neighborhoods if hot.none else neighborhoods.join(hot.sent, PID, "left_anti")
    numbered = usual.join(people, PID, "left_semi").withColumn("rn", number).select(*out, "rn")
    if hot.none:
        return numbered
    many = neighborhoods.join(hot.sent, PID, "left_semi")
    return numbered.unionByName(in_parts(spread_join(many, people, PID, hot=hot)))
