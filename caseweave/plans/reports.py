"""Named report bundles and their runner."""

from __future__ import annotations

import re
from collections.abc import Iterator, Mapping
from concurrent.futures import ThreadPoolExecutor
from contextlib import AbstractContextManager, contextmanager
from dataclasses import replace
from functools import reduce

from pyspark import StorageLevel, inheritable_thread_target
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from caseweave.functions.dates import ReportWindow
from caseweave.operators.cohort import PID, Cohort, FlatCohort
from caseweave.plans.context import ReportContext
from caseweave.plans.queries import QUERIES, is_ordered, run_query, shared_tables

Report = Mapping[str, tuple[str, Mapping[str, object]]]

# Block names of the bundles and the query with options behind each.
A2J_REPORT: Report = {
    "CASES_STARTED": ("a2j_cases", {"started_ended": "started"}),
    "CASES_ENDED": ("a2j_cases", {"started_ended": "ended"}),
    "LINKAGES": ("a2j_linkages", {}),
}

MONTHLY_PROGRAM_GRANT: Report = {
    "grant involvement": ("grant_tally", {}),
    "grants started": ("grant_tally", {"start_end": "start_date"}),
    "grants ended": ("grant_tally", {"start_end": "end_date"}),
    "Program Involvement by Days - All": ("grouped_by_time", {"program_grant": "program"}),
    "Program Involvement by Days - Closed": (
        "grouped_by_time", {"program_grant": "program", "closed_only": True},
    ),
    "PROGRAMS BY RACE": ("programs_by_demographic", {"demographic": "race", "percentages": True}),
    "PROGRAMS BY GENDER": (
        "programs_by_demographic", {"demographic": "gender", "percentages": True},
    ),
    "PROGRAMS BY AGE": ("programs_by_demographic", {"demographic": "age", "percentages": True}),
    "ALL_DAYS_SERVED_BY_GRANT": ("grouped_by_time", {"program_grant": "grant"}),
    "CLOSED_DAYS_SERVED_BY_GRANT": (
        "grouped_by_time", {"program_grant": "grant", "closed_only": True},
    ),
    "PACKAGE OF SERVICES": ("programs_packages", {}),
}

MONTHLY_LEGAL: Report = {
    "CiviCore.Legal Tally": ("legal_tally", {}),
    "Case Pending Tally": ("legal_tally", {"pending": True}),
    "Case Type - All Cases": ("legal_case_type", {"percentage": True}),
    "Case Type - Opened": ("legal_case_type", {"timeframe": True, "opened_closed": "opened"}),
    "Case Type - Closed": ("legal_case_type", {"timeframe": True, "opened_closed": "closed"}),
    "Rearrested": ("legal_rearrested", {}),
    "Pending Cases": ("legal_pending_cases", {"at": "t2"}),
    "Case Outcomes": ("legal_case_outcomes", {}),
    "Guilty Plea Outcomes": ("legal_plea_outcomes", {"timeframe": True}),
}

MONTHLY_CM_OUTREACH: Report = {
    "receiving CM": ("programs_service_tally", {"service_column": "service_cm"}),
    "Had CM Session in Month": ("programs_sessions", {}),
    "CM Session Count": ("programs_session_tally", {"cm_outreach": "cm"}),
    "CM Session Length": ("programs_session_length", {}),
    "CM Session Length (Grouped)": ("programs_session_length_grouped", {}),
    "Had Outreach Session in Month": ("programs_sessions", {"cm_outreach": "outreach"}),
    "Outreach Session Count": ("programs_session_tally", {"cm_outreach": "outreach"}),
    "linkage tally": ("link_tally", {"hub_initiated": True, "timeframe": True}),
    "services linked": ("link_goal_area", {"started_linked": "both"}),
}

JAC_SMARTSHEET: Report = {
    "participant count": ("idhs_tally", {}),
    "genders": ("dem_race_gender", {"race_gender": "gender"}),
    "races": ("dem_race_gender", {"race_gender": "race"}),
    "ages": ("dem_age_tally", {}),
    "services": ("idhs_service_tally", {}),
    "avg hours spent on CM": ("jac_cm_hours", {}),
    "avg number of CM sessions": ("jac_cm_sessions", {}),
    "transportation assistance": ("jac_transpo_assist", {}),
    "connected to other providers": ("jac_linked_participant_tally", {}),
    "referrals": ("idhs_linkages", {}),
}

CVI: Report = {
    "total participants": ("idhs_tally", {}),
    "ages": ("idhs_ages", {}),
    "races": ("idhs_race_gender", {"race_gender": "race"}),
    "genders": ("idhs_race_gender", {"race_gender": "gender"}),
    "languages": ("idhs_language", {}),
    "services": ("idhs_service_tally", {}),
    "referrals": ("idhs_linkages", {}),
    "number of mediations": ("mediation_tally", {}),
    "CPIC notifications": ("incidents_cpic", {}),
    "non-CPIC notifications": ("incidents_non_cpic", {}),
    "time spent on mediations": ("mediation_time_spent", {}),
}

PPR: Report = {
    "new and continuing clients": ("idhs_tally", {}),
    "closed clients": ("idhs_tally_closed", {}),
    "outreach and legal": ("idhs_service_tally", {}),
    "race": ("dem_race_gender", {"race_gender": "race"}),
    "gender": ("dem_race_gender", {"race_gender": "gender"}),
    "ages": ("idhs_ages", {"ppr": True}),
    "eligibility": ("idhs_class_notes", {"new": True}),
    "cm linkages": ("idhs_linkages", {}),
    "initial mediations": ("mediation_tally", {}),
    "followup mediations": ("mediation_tally", {"followup": True}),
    "incidents": ("incident_tally", {}),
}


def build_report(report: Report, ctx: ReportContext) -> dict[str, DataFrame]:
    """The blocks of a report as lazy DataFrames; an unknown query name is an error."""
    unknown = sorted({name for name, _ in report.values()} - QUERIES.keys())
    if unknown:
        raise KeyError(f"unknown queries {unknown}")
    return {block: run_query(ctx, name, **options) for block, (name, options) in report.items()}


def report_rows(report: Report, blocks: Mapping[str, DataFrame]) -> DataFrame:
    """All blocks in one table: block, row, content, n.

    A row's content is its fields as text, by name. Rows of a block with a defined order
    are numbered from 1; other blocks, which may be long listings, have no numbers, and n
    says how often a content occurs.
    """
    parts = []
    for block, df in blocks.items():
        name, options = report[block]
        rows = _numbered(df) if is_ordered(name, dict(options)) else df.withColumn("_row", F.lit(None))
        content = F.concat_ws("; ", *[_field(f) for f in sorted(df.schema, key=lambda f: f.name)])
        texts = rows.select(F.col("_row").cast("bigint").alias("row"), content.alias("content"))
        counted = texts.groupBy("row", "content").agg(F.count(F.lit(1)).alias("n"))
        parts.append(counted.select(F.lit(block).alias("block"), "row", "content", "n"))
    return reduce(DataFrame.unionByName, parts)


def _numbered(df: DataFrame) -> DataFrame:
    """Rows of a sorted tally by number: it has a row per group, so one task numbers them."""
    placed = df.withColumn("_place", F.monotonically_increasing_id())
    return placed.withColumn("_row", F.row_number().over(W.orderBy("_place"))).drop("_place")


def _field(field: T.StructField) -> Column:
    """name=value; numbers with four decimals, whatever their type."""
    value = F.col(f"`{field.name}`")
    text = value.cast("string")
    if isinstance(field.dataType, T.NumericType):
        text = F.coalesce(value.try_cast("decimal(38,4)").cast("string"), text)
    return F.concat(F.lit(f"{field.name}="), F.coalesce(text, F.lit("NULL")))


def run_report(report: Report, ctx: ReportContext) -> DataFrame:
    """The finished report (see ``report_rows``), computed once and kept.

    The cohort and the fact tables that several blocks read are shared; they are released
    when the report is there.
    """
    with shared_inputs(ctx, report) as shared:
        rows = report_rows(report, build_report(report, shared))
        rows = rows.persist(StorageLevel.MEMORY_AND_DISK)
        rows.count()
    return rows


def _in_window(table: str, window: ReportWindow) -> Column:
    if table == "case_sessions":
        return window.has("session_date")
    return window.has("linked_date") | window.has("start_date")


@contextmanager
def shared_inputs(
    ctx: ReportContext, report: Report, reliable: bool = False
) -> Iterator[ReportContext]:
    """Compute what the blocks of a report share once: the cohort, and of every fact table
    that several blocks read inside the window the rows of cohort people in it.

    The episode and service lists are kept, not their product. By default all is cached
    on the executors and recomputed where one is lost; ``reliable`` writes it to the
    folder set in ``spark.checkpoint.dir`` instead.
    """
    kept: list[DataFrame] = []

    def keep(df: DataFrame) -> DataFrame:
        if reliable:
            return df.checkpoint()
        cached = df.persist(StorageLevel.MEMORY_AND_DISK)
        kept.append(cached)
        cached.count()
        return cached

    try:
        if isinstance(ctx.cohort, Cohort):
            # Membership is settled here, so that the blocks need not check it again.
            cohort = Cohort(
                keep(ctx.cohort.episodes), keep(ctx.cohort.served()), hot=ctx.cohort.hot
            )
        else:
            cohort = FlatCohort(keep(ctx.cohort.rows()))
        facts = {
            table: keep(
                ctx.sources[table]
                .where(_in_window(table, ctx.window))
                .join(cohort.people(), PID, "left_semi")
            )
            for table in shared_tables(report.values())
        }
        yield replace(ctx, cohort=cohort, sources=ctx.sources.replaced(**facts))
    finally:
        for df in kept:
            df.unpersist()


def shared_cohort(
    ctx: ReportContext, reliable: bool = False
) -> AbstractContextManager[ReportContext]:
    """Compute the cohort once for all queries of a context."""
    return shared_inputs(ctx, {}, reliable)


def block_folder(block: str) -> str:
    return re.sub(r"[^a-z0-9]+", "_", block.lower()).strip("_")


def write_report(
    report: Report,
    ctx: ReportContext,
    path: str,
    format: str = "tsv",
    reliable: bool = False,
    mode: str = "errorifexists",
    parallel: int = 4,
) -> dict[str, str]:
    """Write each block to its own folder below ``path``; returns block -> folder.

    ``parallel`` blocks are submitted at a time, since most end in a few small tasks.
    """

    def write(df: DataFrame, folder: str) -> None:
        if format == "tsv":
            df.write.mode(mode).csv(folder, sep="\t", header=True)
        else:
            df.write.mode(mode).format(format).save(folder)

    with shared_inputs(ctx, report, reliable) as shared:
        blocks = build_report(report, shared)
        folders = {block: f"{path.rstrip('/')}/{block_folder(block)}" for block in blocks}
        with ThreadPoolExecutor(max_workers=parallel) as pool:
            jobs = [
                pool.submit(inheritable_thread_target(df.sparkSession)(write), df, folders[block])
                for block, df in blocks.items()
            ]
            for job in jobs:
                job.result()
    return folders
