"""Joining facts by key when single keys may be huge on either side."""

from __future__ import annotations

from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Session setting: rows of one key that a single task should join at most.
HOT_ROWS_CONF = "caseweave.join.hotKeyRows"
HOT_ROWS = 2_000_000
# Keys that can be hot at once. It bounds the list that is broadcast (16 MB): a hot key has
# more than 1 / MAX_HOT_KEYS of all rows, too, which matters beyond 2 * 10 ** 12 rows only.
MAX_HOT_KEYS = 1_000_000

# Items that a sketch reports and tracks. It tracks them in a table of 2 ** 18 entries, so
# counts are at most SKETCH_ERROR of all rows too high or too low (3.5 over the entries, the
# bound of the sketch), and a key with more than twice that share is always reported; there
# are fewer such keys than SKETCH_KEYS.
SKETCH_KEYS, SKETCH_TRACKED = 40_000, 100_000
SKETCH_ERROR = 3.5 / (1 << 18)


# Entries of a lookup that is sent to every row as one value.
MAX_LOOKUP = 100_000


def looked_up(lookup: DataFrame, key: str, value: str, of: Column) -> Column:
    """The value of a text in a lookup table (a few rows per text at most), without regard
    to case; NULL where it is not there. Of several values of a text the largest counts.

    The lookup becomes one map, read once as a scalar subquery, so the rows that are
    looked up are neither joined nor shuffled, however large the planner takes the table
    to be. A lookup with more than MAX_LOOKUP texts stops the query: it is a table to join.
    """
    texts = lookup.where(F.col(key).isNotNull() & F.col(value).isNotNull())
    entries = texts.groupBy(F.lower(key).alias("k")).agg(F.max(value).alias("v"))
    counted = F.count(F.lit(1))
    too_many = F.raise_error(F.lit(f"a lookup has more than {MAX_LOOKUP} texts"))
    # the entries are cut before they are gathered: one more than allowed is enough to tell
    few = entries.limit(MAX_LOOKUP + 1)
    known = F.map_from_entries(F.collect_list(F.struct("k", "v")))
    whole = few.agg(
        F.when(counted <= MAX_LOOKUP, known).otherwise(too_many.cast(_map_type(lookup, value))).alias("m")
    )
    return F.try_element_at(whole.scalar(), F.lower(of))


def _map_type(lookup: DataFrame, value: str) -> str:
    return f"map<string,{lookup.schema[value].dataType.simpleString()}>"


def hot_rows(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get(HOT_ROWS_CONF, str(HOT_ROWS)))


@dataclass(frozen=True)
class HotKeys:
    """Keys with more than a limit of rows: ``parts`` has the key and ``_parts``, the number
    of parts to deal its rows to. ``known`` tells that the list was measured before the
    query is planned; ``count`` is then its length."""

    parts: DataFrame
    key: str
    known: bool = False
    count: int = -1

    @property
    def none(self) -> bool:
        return self.known and self.count == 0

    @cached_property
    def sent(self) -> DataFrame:
        """The list for a broadcast: at most MAX_HOT_KEYS rows."""
        return F.broadcast(self.parts)


def hot_keys(facts: DataFrame, key: str) -> HotKeys:
    """Hot keys by an exact count within the query, a map-side aggregate of the key column."""
    limit = hot_rows(facts)
    counts = facts.where(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("_n"))
    total = counts.agg(F.sum("_n")).scalar()
    share = F.floor(total / MAX_HOT_KEYS)
    found = counts.where((F.col("_n") > limit) & (F.col("_n") > share))
    return HotKeys(found.select(key, F.ceil(F.col("_n") / F.lit(limit)).alias("_parts")), key)


def measured_hot_keys(facts: DataFrame, key: str) -> HotKeys:
    """Hot keys from one pass with a mergeable sketch, before the query is planned.

    Nothing is shuffled by key. The sketch never misses a key with more than
    2 * SKETCH_ERROR of the rows; where the limit is below that (beyond 7 * 10 ** 10 rows
    at the usual limit) keys are counted exactly instead. An estimate above a key's count
    only means more parts than needed.
    """
    limit = hot_rows(facts)
    named = facts.where(F.col(key).isNotNull()).select(key)
    spark = facts.sparkSession
    top = F.expr(f"approx_top_k(`{key}`, {SKETCH_KEYS}, {SKETCH_TRACKED})").alias("top")
    total, items = named.agg(F.count(F.lit(1)).alias("n"), top).first()
    if 2 * SKETCH_ERROR * total > limit:
        exact = hot_keys(facts, key).parts.toArrow()
        return HotKeys(spark.createDataFrame(exact, f"{key} long, _parts long"), key, True, len(exact))
    rows = [(i["item"], -(-int(i["count"]) // limit)) for i in items or () if i["count"] > limit]
    # a local relation: its size is known to the planner without a job
    return HotKeys(spark.createDataFrame(rows, f"{key} long, _parts long"), key, True, len(rows))


def _parts() -> Column:
    return F.coalesce(F.col("_parts"), F.lit(1).cast("bigint"))


def _place(columns: list[str]) -> Column:
    """Number of a row by its content and its partition.

    A row's place in its partition has no part in it, so a task that is run again after
    a loss deals the same rows alike, in whatever order it sees them. The partition's
    number tells equal rows of different partitions apart; facts should keep their id.
    """
    return F.xxhash64(*columns, F.spark_partition_id())


def dealt(facts: DataFrame, hot: HotKeys, key: str, part: str = "_part") -> DataFrame:
    """Facts with the part that a row of a hot key is dealt to, else 0."""
    return (
        facts.withColumn("_place", _place(facts.columns))
        .join(hot.sent, key, "left")
        .withColumn(part, F.pmod("_place", _parts()))
        .drop("_parts", "_place")
    )


def repeated(rows: DataFrame, hot: HotKeys, key: str, part: str = "_part") -> DataFrame:
    """Rows once per part of their key."""
    every_part = F.explode(F.sequence(F.lit(0).cast("bigint"), _parts() - 1))
    return rows.join(hot.sent, key, "left").withColumn(part, every_part).drop("_parts")


def spread_join(
    facts: DataFrame,
    others: DataFrame,
    key: str,
    sizes: DataFrame | None = None,
    hot: HotKeys | None = None,
    other_hot: HotKeys | None = None,
) -> DataFrame:
    """Inner join of facts to other rows by key; hot keys are split.

    The facts of a hot key are dealt to parts of about ``hot_rows`` facts and the rows of
    the other side are repeated per part, so no task receives much more than the limit of
    any key. Where the other side may have many rows of a key, too, ``other_hot`` names
    those keys: both sides are then dealt, to a grid of parts, and each is repeated along
    the other's parts.

    ``hot`` are the hot keys of the facts if they were measured before; without any the
    join is a plain one, which keeps the partitioning of stored tables. With some, only
    their rows are dealt, and the others are joined as they are. ``sizes`` is a table to
    count keys in instead of the facts, with no fewer rows per key.
    """
    if hot is None:
        hot = hot_keys(facts if sizes is None else sizes, key)
    if hot.none and (other_hot is None or other_hot.none):
        return facts.join(others, key)
    if hot.known and other_hot is None:
        usual = facts.join(hot.sent, key, "left_anti").join(others, key)
        few = _dealt_join(
            facts.join(hot.sent, key, "left_semi"), others.join(hot.sent, key, "left_semi"), key, hot
        )
        return usual.unionByName(few)
    return _dealt_join(facts, others, key, hot, other_hot)


def _dealt_join(
    facts: DataFrame, others: DataFrame, key: str, hot: HotKeys, other_hot: HotKeys | None = None
) -> DataFrame:
    left, right = dealt(facts, hot, key), repeated(others, hot, key)
    if other_hot is None:
        return left.join(right, [key, "_part"]).drop("_part")
    # numbered before they are repeated, so that equal rows of a part stay one row's copies
    left = repeated(left, other_hot, key, "_other")
    right = repeated(dealt(others, other_hot, key, "_other"), hot, key)
    return left.join(right, [key, "_part", "_other"]).drop("_part", "_other")
