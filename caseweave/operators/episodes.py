"""Service episodes from a status history."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from caseweave.fixed_values import ACTIVE, CLOSED
from caseweave.functions.dates import ReportWindow, in_years, overlaps
from caseweave.functions.matching import ci_eq, flag, is_true
from caseweave.operators.cohort import PID

_OTHER, _ACTIVE, _CLOSED = 0, 1, 2

# When an episode of each class ended and began, as seen from the window.
EPISODE_CLASSES = {
    "#2": ("in", "before"),
    "#3": ("after", "before"),
    "#4": ("open", "before"),
    "#5": ("in", "in"),
    "#6": ("after", "in"),
    "#7": ("open", "in"),
    "#8": ("after", "after"),
    "#9": ("open", "after"),
}


def dated_history(pstatus: DataFrame) -> DataFrame:
    """Status rows that can take part in an episode."""
    return pstatus.where(F.col(PID).isNotNull() & F.col("status_date").isNotNull())


def _newest_first() -> W:
    return W.partitionBy(PID).orderBy(F.col("status_date").desc(), F.col("status_id").desc())


def newest_statuses(pstatus: DataFrame, slots: int) -> DataFrame:
    """The newest ``slots`` status rows per participant, numbered in ``slot``.

    The limit on the row number is applied before the shuffle too, so a
    participant with a huge history ships at most ``slots`` rows per input task.
    """
    return (
        dated_history(pstatus)
        .withColumn("slot", F.row_number().over(_newest_first()))
        .where(F.col("slot") <= slots)
    )


def status_wide(pstatus: DataFrame, slots: int) -> DataFrame:
    """One row per participant, slot 1 newest: pstatus1..n, status_date1..n.

    A view of the newest ``slots`` statuses for reading; checks and tallies use
    the whole history (``neighbours``).
    """
    picks: list[Column] = []
    for i in range(1, slots + 1):
        here = F.col("slot") == i
        picks.append(F.max(F.when(here, F.col("pstatus"))).alias(f"pstatus{i}"))
        picks.append(F.max(F.when(here, F.col("status_date"))).alias(f"status_date{i}"))
    return newest_statuses(pstatus, slots).groupBy(PID).agg(*picks)


def episodes(
    pstatus: DataFrame, window: ReportWindow, max_slots: int | None = None
) -> DataFrame:
    """Episodes (participant_id, active_date, closed_date) that meet the window.

    An episode starts at an 'Active' row whose next row, by date then
    status_id, is 'Closed' or does not exist (still open, NULL closed_date).
    ``max_slots`` looks at the newest rows of each participant only; so few are
    put in order at once.

    Else two steps, so that no task has to order the whole history of one
    participant: rows are ordered within (participant, day); each day is then
    summarised by its first and last status, and days are ordered within the
    participant. The second step has at most one row per calendar day.
    """
    if max_slots is not None:
        pairs = neighbours(pstatus, max_slots)
        closed = F.col("next_date").isNull() | ci_eq("next_pstatus", CLOSED)
        begun = pairs.where(ci_eq("pstatus", ACTIVE) & closed)
        found = begun.select(
            PID, F.col("status_date").alias("active_date"), F.col("next_date").alias("closed_date")
        )
        return found.where(overlaps(F.col("active_date"), F.col("closed_date"), window))
    history = dated_history(pstatus)
    state = (
        F.when(ci_eq("pstatus", ACTIVE), F.lit(_ACTIVE))
        .when(ci_eq("pstatus", CLOSED), F.lit(_CLOSED))
        .otherwise(F.lit(_OTHER))
    )
    in_day = W.partitionBy(PID, "status_date").orderBy("status_id")
    days = (
        history.select(PID, "status_date", "status_id", state.alias("state"))
        .withColumn("next_in_day", F.lead("state").over(in_day))
        .groupBy(PID, "status_date")
        .agg(
            F.max(
                flag((F.col("state") == _ACTIVE) & (F.col("next_in_day") == _CLOSED))
            ).alias("closed_same_day"),
            F.min_by("state", "status_id").alias("first_state"),
            F.max_by("state", "status_id").alias("last_state"),
        )
    )
    by_day = W.partitionBy(PID).orderBy("status_date")
    following = days.select(
        PID,
        "status_date",
        "closed_same_day",
        "last_state",
        F.lead("status_date").over(by_day).alias("next_date"),
        F.lead("first_state").over(by_day).alias("next_state"),
    ).where(F.col("status_date") <= window.end)

    day, nxt = F.col("status_date"), F.col("next_date")
    same_day = F.col("closed_same_day") == 1
    onward = (F.col("last_state") == _ACTIVE) & (
        nxt.isNull() | (F.col("next_state") == _CLOSED)
    )
    found = F.array(
        F.when(same_day, F.struct(day.alias("a"), day.alias("c"))),
        F.when(onward, F.struct(day.alias("a"), nxt.alias("c"))),
    )
    return (
        following.where(same_day | onward)
        .select(PID, F.explode(found).alias("e"))
        .select(PID, F.col("e.a").alias("active_date"), F.col("e.c").alias("closed_date"))
        .where(F.col("active_date").isNotNull())
        .where(overlaps(F.col("active_date"), F.col("closed_date"), window))
    )


def stints(
    pstatus: DataFrame,
    participants: DataFrame,
    window: ReportWindow,
    max_slots: int | None = None,
) -> DataFrame:
    """Distinct named episodes of known participants."""
    return (
        episodes(pstatus, window, max_slots)
        .join(participants.select(PID, "first_name", "last_name"), PID)
        .select(PID, "first_name", "last_name", "active_date", "closed_date")
        .distinct()
    )


def with_stint_count(stint_rows: DataFrame) -> DataFrame:
    """Add the number of episodes of the participant to each of them."""
    return stint_rows.withColumn("stint_count", F.count(F.lit(1)).over(W.partitionBy(PID)))


def stint_count(stint_rows: DataFrame) -> DataFrame:
    return stint_rows.groupBy(PID).agg(F.count(F.lit(1)).alias("stint_count"))


def stint_totals(stint_rows: DataFrame) -> DataFrame:
    per_person = stint_rows.groupBy(PID).agg(F.count(F.lit(1)).alias("n"))
    return per_person.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("n_rows"), F.count(PID).alias("n_participants")
    )


# -- data-quality checks on the whole history -------------------------------


def neighbours(pstatus: DataFrame, max_slots: int | None = None) -> DataFrame:
    """Every status row with the next one of its participant, by date then status_id:
    participant_id, pstatus, status_date, next_pstatus, next_date (NULL for the newest).

    In two steps like ``episodes``: rows are ordered within a day, days within the
    participant, so that no task orders all rows of one participant. The newest
    ``max_slots`` rows alone are put in order at once.
    """
    if max_slots is not None:
        newest = newest_statuses(pstatus, max_slots)
        newer = _newest_first()
        return newest.select(
            PID,
            "pstatus",
            "status_date",
            F.lag("pstatus").over(newer).alias("next_pstatus"),
            F.lag("status_date").over(newer).alias("next_date"),
        )
    history = dated_history(pstatus)
    in_day = W.partitionBy(PID, "status_date").orderBy("status_id")
    of_day = history.select(
        PID,
        "status_date",
        "status_id",
        "pstatus",
        F.lead("status_id").over(in_day).alias("_next_id"),
        F.lead("pstatus").over(in_day).alias("_next"),
    )
    inside = of_day.where(F.col("_next_id").isNotNull()).select(
        PID,
        "pstatus",
        "status_date",
        F.col("_next").alias("next_pstatus"),
        F.col("status_date").alias("next_date"),
    )
    ends = of_day.groupBy(PID, "status_date").agg(
        F.min_by("pstatus", "status_id").alias("_first"),
        F.max_by("pstatus", "status_id").alias("pstatus"),
    )
    by_day = W.partitionBy(PID).orderBy("status_date")
    onward = ends.select(
        PID,
        "pstatus",
        "status_date",
        F.lead("_first").over(by_day).alias("next_pstatus"),
        F.lead("status_date").over(by_day).alias("next_date"),
    )
    return inside.unionByName(onward)


def status_anomalies(
    pstatus: DataFrame,
    participants: DataFrame,
    years: Sequence[int],
    max_slots: int | None = None,
) -> DataFrame:
    """Equal neighbouring statuses, Active or Closed, of participants with a status in the years.

    One row per such pair: participant, status and the two dates. ``max_slots``
    looks at the newest rows of each participant only.
    """
    history = dated_history(pstatus) if max_slots is None else newest_statuses(pstatus, max_slots)
    seen = history.where(in_years("status_date", years)).select(PID).distinct()
    same = F.lower("pstatus") == F.lower("next_pstatus")
    known = ci_eq("pstatus", ACTIVE) | ci_eq("pstatus", CLOSED)
    return (
        neighbours(pstatus, max_slots)
        .where(is_true(same & known) & F.col("next_date").isNotNull())
        .join(seen, PID, "left_semi")
        .join(participants.select(PID, "first_name", "last_name"), PID)
        .select(PID, "first_name", "last_name", "pstatus", "status_date", "next_date")
    )


def max_status_count(pstatus: DataFrame, years: Sequence[int]) -> DataFrame:
    """Largest number of status rows of one participant in the given years."""
    return (
        pstatus.where(in_years("status_date", years))
        .groupBy(PID)
        .agg(F.count("status_id").alias("n"))
        .agg(F.max("n").alias("max_status_count"))
    )


def stint_case_tally(
    pstatus: DataFrame,
    participants: DataFrame,
    window: ReportWindow,
    max_slots: int | None = None,
) -> DataFrame:
    """Participants and episodes per episode class, from the whole history.

    Classes: closed in the window after starting before (#2) or in it (#5);
    closed later after starting before (#3), in (#6) or after it (#8); still
    open since before (#4), in (#7) or after it (#9). A class without members
    is listed with zeros. Episodes of the same dates count once per participant.
    """
    start, end = F.col("status_date"), F.col("next_date")
    began = (
        F.when(start < window.start, F.lit("before"))
        .when(start <= window.end, F.lit("in"))
        .otherwise(F.lit("after"))
    )
    closed = F.when(end < window.start, F.lit("before")).when(end <= window.end, F.lit("in"))
    ended = F.when(end.isNull(), F.lit("open")).otherwise(
        F.coalesce(closed, F.lit("after"))
    )
    found = (
        neighbours(pstatus, max_slots)
        .where(ci_eq("pstatus", ACTIVE) & (end.isNull() | ci_eq("next_pstatus", CLOSED)))
        .join(participants.select(PID).distinct(), PID, "left_semi")
        .select(PID, start.alias("a"), end.alias("c"), began.alias("began"), ended.alias("ended"))
        .distinct()
    )
    per_person = found.groupBy("ended", "began", PID).agg(F.count(F.lit(1)).alias("n"))
    counts = per_person.groupBy("ended", "began").agg(
        F.count(F.lit(1)).alias("n_participants"), F.sum("n").alias("n_rows")
    )
    labels = pstatus.sparkSession.createDataFrame(
        [(label, ended, began) for label, (ended, began) in EPISODE_CLASSES.items()],
        "case_label string, ended string, began string",
    )
    return labels.join(counts, ["ended", "began"], "left").select(
        "case_label",
        *[F.coalesce(c, F.lit(0).cast("bigint")).alias(c) for c in ("n_participants", "n_rows")],
    )
