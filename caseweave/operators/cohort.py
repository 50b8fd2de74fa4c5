"""A cohort: service episodes and service grants of the same people.

A classified cohort has one row per (episode, grant) of a person: the product
of two independent lists. ``Cohort`` keeps the lists apart. ``rows()`` forms the
product where a report lists it; tallies ask for what they need through
``people``, ``distinct``, ``person_flags``, ``episode_facts`` or ``row_counts``,
which reduce each list per person *before* the two meet, so that a person with
very many episodes and grants costs their sum, not their product.

``FlatCohort`` offers the same calls over any table that already has one row
per combination.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from caseweave.functions.joins import HotKeys, spread_join
from caseweave.functions.matching import flag

PID = "participant_id"


class Cohort:
    """Episodes and services per participant, joined on demand.

    ``member``: a participant belongs only if some service meets this condition.
    ``kept``: services that count once membership is decided.
    ``keys``: a table with at least one row per service row, by participant_id;
    it tells cheaply which participants have very many services. ``hot`` names them, if
    they were measured before.
    """

    def __init__(
        self,
        episodes: DataFrame,
        services: DataFrame,
        member: Column | None = None,
        kept: Column | None = None,
        keys: DataFrame | None = None,
        hot: HotKeys | None = None,
    ):
        self.episodes = episodes
        self.services = services
        self.member = member
        self.kept = kept
        self.keys = keys
        self.hot = hot

    @property
    def columns(self) -> list[str]:
        return [PID, *self._only(self.episodes), *self._only(self.services)]

    @staticmethod
    def _only(df: DataFrame) -> list[str]:
        return [c for c in df.columns if c != PID]

    def _with(self, episodes: DataFrame | None = None, services: DataFrame | None = None) -> Cohort:
        return Cohort(
            self.episodes if episodes is None else episodes,
            self.services if services is None else services,
            self.member,
            self.kept,
            self.keys,
            self.hot,
        )

    def served(self) -> DataFrame:
        """Services that count, of participants that belong."""
        out = self.services if self.kept is None else self.services.where(self.kept)
        if self.member is None:
            return out
        members = self.services.where(self.member).select(PID).distinct()
        return out.join(members, PID, "left_semi")

    def _per_person(self, **aggregates: Column) -> DataFrame:
        """One row per belonging participant with services that count.

        Membership is one more aggregate, so the services are read once.
        Aggregates must look at counting services only (see ``_counting``).
        """
        checks = {}
        if self.member is not None:
            checks["_member"] = F.max(flag(self.member))
        if self.kept is not None:
            checks["_kept"] = F.max(flag(self.kept))
        if not checks and not aggregates:
            return self.services.select(PID).distinct()
        out = self.services.groupBy(PID).agg(
            *[a.alias(n) for n, a in {**aggregates, **checks}.items()]
        )
        for name in checks:
            out = out.where(F.col(name) == 1)
        return out.select(PID, *aggregates)

    def _counting(self, condition: Column) -> Column:
        return condition if self.kept is None else self.kept & condition

    def rows(self) -> DataFrame:
        """One row per (episode, service) of a participant.

        Episodes are few per participant; services may be many and are split.
        """
        out = spread_join(self.served(), self.episodes, PID, sizes=self.keys, hot=self.hot)
        return out.select(*self.columns)

    # -- derivation -------------------------------------------------------

    def with_episode(self, **cols: Column) -> Cohort:
        return self._with(episodes=self.episodes.withColumns(cols))

    def with_service(self, **cols: Column) -> Cohort:
        return self._with(services=self.services.withColumns(cols))

    def where_episode(self, condition: Column) -> Cohort:
        return self._with(episodes=self.episodes.where(condition))

    def where_service(self, condition: Column) -> Cohort:
        if self.member is None:
            return self._with(services=self.services.where(condition))
        kept = self._counting(condition)
        return Cohort(self.episodes, self.services, self.member, kept, self.keys, self.hot)

    def join_people(self, facts: DataFrame) -> Cohort:
        """Add columns of a table with one row per participant (inner join)."""
        return self._with(services=self.services.join(facts, PID))

    def at_last_episode_where(self, condition: Column) -> Cohort:
        """All rows dated at the latest active_date among rows whose service meets a condition.

        A participant's episodes go with each of their services, so the latest
        matching date is the latest date of any participant with a match. The
        window holds the episodes of one participant: two per day at most.
        """
        last = F.max("active_date").over(W.partitionBy(PID))
        episodes = self.episodes.withColumn("_last", last).where(
            F.col("active_date") == F.col("_last")
        )
        member = self._counting(condition)
        if self.member is not None:
            raise ValueError("membership is already decided")
        last_only = episodes.drop("_last")
        return Cohort(last_only, self.services, member, self.kept, self.keys, self.hot)

    # -- reductions -------------------------------------------------------

    def people(self) -> DataFrame:
        """Distinct participant ids."""
        return self.episodes.select(PID).distinct().join(self._per_person(), PID, "left_semi")

    def distinct(self, episode: Sequence[str] = (), service: Sequence[str] = ()) -> DataFrame:
        """Distinct (participant, episode columns, service columns)."""
        left = self.episodes.select(PID, *episode).distinct()
        if not service:
            return left.join(self._per_person(), PID, "left_semi")
        return left.join(self.served().select(PID, *service).distinct(), PID)

    def person_flags(
        self, flags: dict[str, Column], episode: Sequence[str] = ()
    ) -> DataFrame:
        """One row per (participant, episode columns): 1 where any service meets a condition."""
        marks = self._per_person(
            **{name: F.max(flag(self._counting(cond))) for name, cond in flags.items()}
        )
        return self.episodes.select(PID, *episode).distinct().join(marks, PID)

    def episode_facts(self, **aggregates: Column) -> DataFrame:
        """One row per participant with aggregates over the episodes."""
        facts = self.episodes.groupBy(PID).agg(*[a.alias(n) for n, a in aggregates.items()])
        return facts.join(self._per_person(), PID, "left_semi")

    def row_counts(self, episode: Sequence[str] = ()) -> DataFrame:
        """(participant, episode columns, n_rows): how often a pair occurs in ``rows()``."""
        left = self.episodes.groupBy(PID, *episode).agg(F.count(F.lit(1)).alias("_ne"))
        right = self._per_person(_ns=F.count(flag(self._counting(F.lit(True)))))
        return left.join(right, PID).select(
            PID, *episode, (F.col("_ne") * F.col("_ns")).alias("n_rows")
        )


class FlatCohort:
    """The same calls over a table with one row per combination."""

    def __init__(self, rows: DataFrame):
        self._rows = rows

    @property
    def columns(self) -> list[str]:
        return self._rows.columns

    def rows(self) -> DataFrame:
        return self._rows

    def with_episode(self, **cols: Column) -> FlatCohort:
        return FlatCohort(self._rows.withColumns(cols))

    with_service = with_episode

    def where_episode(self, condition: Column) -> FlatCohort:
        return FlatCohort(self._rows.where(condition))

    where_service = where_episode

    def join_people(self, facts: DataFrame) -> FlatCohort:
        return FlatCohort(self._rows.join(facts, PID))

    def at_last_episode_where(self, service_condition: Column) -> FlatCohort:
        last = (
            self._rows.where(service_condition)
            .groupBy(PID)
            .agg(F.max("active_date").alias("active_date"))
        )
        return FlatCohort(self._rows.join(last, [PID, "active_date"], "left_semi"))

    def people(self) -> DataFrame:
        return self._rows.where(F.col(PID).isNotNull()).select(PID).distinct()

    def distinct(self, episode: Sequence[str] = (), service: Sequence[str] = ()) -> DataFrame:
        return self._rows.select(PID, *episode, *service).distinct()

    def person_flags(
        self, flags: dict[str, Column], episode: Sequence[str] = ()
    ) -> DataFrame:
        return self._rows.groupBy(PID, *episode).agg(
            *[F.max(flag(cond)).alias(name) for name, cond in flags.items()]
        )

    def episode_facts(self, **aggregates: Column) -> DataFrame:
        return self._rows.groupBy(PID).agg(*[a.alias(n) for n, a in aggregates.items()])

    def row_counts(self, episode: Sequence[str] = ()) -> DataFrame:
        return self._rows.groupBy(PID, *episode).agg(F.count(F.lit(1)).alias("n_rows"))


AnyCohort = Cohort | FlatCohort


def as_cohort(source: AnyCohort | DataFrame) -> AnyCohort:
    return FlatCohort(source) if isinstance(source, DataFrame) else source


def with_participant_columns(
    cohort: AnyCohort | DataFrame, participants: DataFrame, columns: Sequence[str]
) -> AnyCohort:
    """Join participant columns the cohort does not have yet."""
    c = as_cohort(cohort)
    missing = [name for name in columns if name not in c.columns]
    return c.join_people(participants.select(PID, *missing)) if missing else c
