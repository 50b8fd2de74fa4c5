"""Monthly report: program and grant involvement by client status and days served.

These read the monthly cohort (``classify.monthly_cohort``).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from caseweave import fixed_values as fv
from caseweave.functions.aggregates import order_by_rank, rank_of
from caseweave.functions.percentages import percentage_convert
from caseweave.operators.cohort import AnyCohort, as_cohort
from caseweave.operators.programs import grant_flags, program_flags

Q = AnyCohort | DataFrame

NEW_CLIENT = "new client"


def _flags(program_grant: str, with_vp: bool) -> dict[str, Column]:
    if program_grant == "grant":
        return grant_flags()
    if program_grant != "program":
        raise ValueError(f"expected 'program' or 'grant', not {program_grant!r}")
    flags = program_flags()
    return flags | {"vp": F.col("vp") == 1} if with_vp else flags


def grouped_by_status(cohort: Q, program_grant: str = "grant") -> DataFrame:
    """Participants per program or grant, by client status and for new clients.

    A new client counts in the status row and in the 'new client' row; both
    come from one pass. The 'new client' row is there without any, too.
    """
    flags = _flags(program_grant, with_vp=True)
    marked = as_cohort(cohort).person_flags(
        {f"f_{n}": cond for n, cond in flags.items()}, episode=["client_status", "new_client"]
    )
    both = F.array(
        F.col("client_status"), F.when(F.col("new_client") == NEW_CLIENT, F.lit(NEW_CLIENT))
    )
    listed = marked.withColumn("client_status", F.explode(both)).where(
        F.col("client_status").isNotNull()
    )
    per_person = listed.groupBy("client_status", "participant_id").agg(
        *[F.max(f"f_{n}").alias(n) for n in flags]
    )
    counts = per_person.groupBy("client_status").agg(*[F.count(n).alias(n) for n in flags])
    nobody = counts.sparkSession.range(1).select(
        F.lit(NEW_CLIENT).alias("client_status"), *[F.lit(0).cast("bigint").alias(n) for n in flags]
    )
    counts = (
        counts.unionByName(nobody)
        .groupBy("client_status")
        .agg(*[F.sum(n).alias(n) for n in flags])
    )
    return order_by_rank(counts, "client_status", fv.CLIENT_STATUS_ORDER)


def grouped_by_time(
    cohort: Q, program_grant: str = "grant", closed_only: bool = False, percentages: bool = True
) -> DataFrame:
    """Participants per program or grant, by days served."""
    flags = _flags(program_grant, with_vp=False)
    c = as_cohort(cohort)
    if closed_only:
        c = c.where_episode(F.col("client_status") == "closed out")
    per_person = c.person_flags({f"f_{n}": cond for n, cond in flags.items()}, ["days_served"])
    counts = per_person.groupBy("days_served").agg(
        *[F.count(f"f_{n}").alias(n) for n in flags]
    )
    bands = [label for label, _, _ in fv.DAYS_SERVED_BANDS]
    if percentages:
        order = [F.coalesce(rank_of("days_served", bands), F.lit(len(bands) + 1))]
        return percentage_convert(counts, order=order)
    return order_by_rank(counts, "days_served", bands)
