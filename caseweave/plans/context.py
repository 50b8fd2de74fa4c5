"""What a report needs: sources, window and the cohort it runs on."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame

from caseweave.functions.dates import ReportWindow
from caseweave.operators.classify import (
    a2j_cohort,
    build_cohort,
    grant_cohort,
    hd_cohort,
    monthly_cohort,
)
from caseweave.operators.cohort import AnyCohort, as_cohort
from caseweave.sources.catalog import Sources


@dataclass(frozen=True)
class ReportContext:
    """Arguments shared by the queries of a report.

    ``program`` names the funder whose services the funder reports count.
    """

    sources: Sources
    window: ReportWindow
    cohort: AnyCohort
    program: str = "idhs"


def general_context(sources: Sources, window: ReportWindow, **options: object) -> ReportContext:
    """The classified cohort; options go to ``build_cohort``."""
    return ReportContext(sources, window, build_cohort(sources, window, **options))


def monthly_context(sources: Sources, window: ReportWindow) -> ReportContext:
    base = build_cohort(sources, window)
    return ReportContext(sources, window, monthly_cohort(base, sources.participants, window))


def hd_context(sources: Sources, window: ReportWindow) -> ReportContext:
    return ReportContext(sources, window, hd_cohort(build_cohort(sources, window)))


def funder_context(
    sources: Sources,
    window: ReportWindow,
    funder: str = "idhs",
    grant_pattern: str = "JAC HD",
    program_pattern: str = "JAC",
) -> ReportContext:
    """Grant cohort of 'jac' or 'idhs'. Both select by the same patterns unless told otherwise."""
    base = build_cohort(sources, window)
    cohort = grant_cohort(base, window, grant_pattern, program_pattern)
    return ReportContext(sources, window, cohort, funder)


def a2j_context(sources: Sources, window: ReportWindow) -> ReportContext:
    base = build_cohort(sources, window)
    rows: DataFrame = a2j_cohort(base, sources.participants, sources.address, sources.legal)
    return ReportContext(sources, window, as_cohort(rows))
