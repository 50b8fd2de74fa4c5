"""The set of source tables a report reads."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from caseweave.functions.joins import HotKeys, hot_rows, measured_hot_keys
from caseweave.sources.schemas import SCHEMAS

PID = "participant_id"
HOT_TABLE = "hot_keys"
_HOT_SCHEMA = f"source string, hot_limit long, {PID} long, _parts long"


def conform(name: str, df: DataFrame) -> DataFrame:
    """Project a table onto its declared schema; columns it lacks are an error.

    Only declared columns are selected, so the scan below reads no others.
    """
    schema = SCHEMAS[name]
    missing = [f.name for f in schema if f.name not in df.columns]
    if missing:
        raise ValueError(f"source {name!r} lacks columns {missing}")
    actual = {f.name: f.dataType for f in df.schema}
    return df.select(
        *[
            F.col(f.name) if actual[f.name] == f.dataType else F.col(f.name).cast(f.dataType)
            for f in schema
        ]
    )


def normalise_categories(df: DataFrame, canonical: Mapping[str, list[str]]) -> DataFrame:
    """Trim category columns and map case variants to one spelling.

    Grouping afterwards treats 'asian' and 'Asian ' as one category. Values
    outside the list are only trimmed.
    """
    out: dict[str, Column] = {}
    for column, spellings in canonical.items():
        trimmed = F.trim(F.col(column))
        value = trimmed
        for s in spellings:
            value = F.when(F.lower(trimmed) == s.lower(), F.lit(s)).otherwise(value)
        out[column] = value
    return df.withColumns(out)


class Sources:
    """Source tables by name, loaded on first use and checked against their schema.

    ``measure`` finds the participants with very many rows in a table, once per table and
    limit, for all queries that read it. The default is one pass over the table's ids when
    a query is built that needs to know; with None queries count for themselves.
    """

    def __init__(
        self,
        load: Callable[[str], DataFrame],
        measure: Callable[[str, DataFrame], HotKeys] | None = lambda _, df: measured_hot_keys(df, PID),
    ):
        self._load = load
        self._measure = measure
        self._tables: dict[str, DataFrame] = {}
        self._hot: dict[tuple[str, int], HotKeys] = {}

    def hot_keys(self, name: str) -> HotKeys | None:
        """Participants with very many rows in a table; None if nothing is measured."""
        if self._measure is None:
            return None
        df = self[name]
        kept = name, hot_rows(df)
        if kept not in self._hot:
            self._hot[kept] = self._measure(name, df)
        return self._hot[kept]

    def __getitem__(self, name: str) -> DataFrame:
        if name not in SCHEMAS:
            raise KeyError(f"unknown source {name!r}")
        if name not in self._tables:
            self._tables[name] = conform(name, self._load(name))
        return self._tables[name]

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_") or name not in SCHEMAS:
            raise AttributeError(name)
        return self[name]

    def replaced(self, **tables: DataFrame) -> Sources:
        """A copy in which some tables are exchanged."""
        def measure(name: str, df: DataFrame) -> HotKeys:
            known = None if name in tables else self.hot_keys(name)
            return measured_hot_keys(df, PID) if known is None else known

        # a measured list of an exchanged table would be of other rows
        found = None if self._measure is None else measure
        return Sources(lambda n: tables[n] if n in tables else self[n], found)

    def normalised(self, canonical: Mapping[str, Mapping[str, list[str]]]) -> Sources:
        """A copy whose category columns have one spelling per value.

        ``canonical`` gives the spellings by table and column, for example
        ``{"participants": {"race": ["Asian", "Black"]}}``. Grouping then treats
        'asian' and 'Asian ' as one; other values are only trimmed.
        """
        return Sources(
            lambda n: normalise_categories(self[n], canonical[n]) if n in canonical else self[n],
            None if self._measure is None else lambda n, _: self.hot_keys(n),
        )

    def store_bucketed(
        self, spark: SparkSession, folder: str, database: str, buckets: int
    ) -> Sources:
        """Write all sources as tables below ``folder``, and read them from there.

        Tables with a participant are bucketed and sorted by participant_id into the same
        number of buckets. Joins, windows and aggregates by participant then need no
        shuffle: bucket i of one table meets bucket i of another. Choose as many buckets as
        tasks should read a table; each bucket is one file. The participants with very many
        rows are stored with the tables, so that reports need not look for them.
        """
        base = folder.rstrip("/")
        spark.sql(f"CREATE DATABASE IF NOT EXISTS `{database}`")

        def save(df: DataFrame, name: str, by_person: bool = False) -> None:
            writer = df.write.format("parquet").option("path", f"{base}/{name}")
            if by_person:
                writer = writer.bucketBy(buckets, PID).sortBy(PID)
            writer.saveAsTable(f"`{database}`.`{name}`")

        # a row without participant says under which limit a table was measured
        hot = spark.createDataFrame([], _HOT_SCHEMA)
        for name in SCHEMAS:
            df = self[name]
            by_person = PID in df.columns
            save(df.repartition(buckets, PID) if by_person else df, name, by_person)
            if by_person:
                found = measured_hot_keys(spark.table(f"`{database}`.`{name}`"), PID)
                mark = spark.createDataFrame([(name, hot_rows(df), None, None)], _HOT_SCHEMA)
                named = found.parts.select(F.lit(name), F.lit(hot_rows(df)), PID, "_parts")
                hot = hot.union(mark).union(named)
        save(hot.coalesce(1), HOT_TABLE)
        return Sources.bucketed(spark, database)

    @classmethod
    def bucketed(cls, spark: SparkSession, database: str) -> Sources:
        """Tables written by ``store_bucketed``."""

        def measure(name: str, df: DataFrame) -> HotKeys:
            stored = spark.table(f"`{database}`.`{HOT_TABLE}`").where(F.col("source") == name)
            found = stored.toArrow()  # MAX_HOT_KEYS rows and one at most
            if not found.num_rows or found["hot_limit"][0].as_py() != hot_rows(df):
                return measured_hot_keys(df, PID)
            listed = found.filter(found[PID].is_valid()).select([PID, "_parts"])
            parts = spark.createDataFrame(listed, f"{PID} long, _parts long")
            return HotKeys(parts, PID, True, listed.num_rows)

        return cls(lambda n: spark.table(f"`{database}`.`{n}`"), measure)

    @classmethod
    def of(cls, tables: Mapping[str, DataFrame]) -> Sources:
        return cls(lambda n: tables[n])

    @classmethod
    def parquet(cls, spark: SparkSession, directory: str, suffix: str = "") -> Sources:
        """One Parquet file or folder per table: ``<directory>/<table><suffix>``."""
        base = directory.rstrip("/")
        return cls(lambda n: spark.read.parquet(f"{base}/{n}{suffix}"))

    @classmethod
    def catalog(cls, spark: SparkSession, names: Mapping[str, str]) -> Sources:
        """Catalog tables, e.g. ``{'legal': 'civic.legal'}``; missing names map to themselves."""
        return cls(lambda n: spark.table(names.get(n, n)))

    @classmethod
    def jdbc(
        cls,
        spark: SparkSession,
        url: str,
        names: Mapping[str, str],
        bounds: tuple[int, int],
        partitions: int = 64,
        properties: Mapping[str, str] | None = None,
        ranges: Mapping[str, tuple[str, str, str]] | None = None,
    ) -> Sources:
        """Tables of a relational database, read in parallel ranges of participant_id.

        ``bounds`` are the lowest and highest participant id; rows outside them
        land in the first and last range. ``ranges`` names another column with its
        bounds for a table, e.g. ``{"critical_incidents": ("incident_id", "1", "900000"),
        "mediations": ("date_start_mediation", "2015-01-01", "2025-01-01")}``. Only
        lookups should have neither: they are read in one partition.
        """

        def load(name: str) -> DataFrame:
            reader = (
                spark.read.format("jdbc")
                .option("url", url)
                .option("dbtable", names.get(name, name))
                .options(**dict(properties or {}))
            )
            by = dict(ranges or {}).get(name)
            if by is None and "participant_id" in SCHEMAS[name].names:
                by = ("participant_id", str(bounds[0]), str(bounds[1]))
            if by is not None:
                reader = (
                    reader.option("partitionColumn", by[0])
                    .option("lowerBound", by[1])
                    .option("upperBound", by[2])
                    .option("numPartitions", partitions)
                )
            return reader.load()

        return cls(load)
