"""Longitudinal case-management analytics as DataFrame transformations."""

from caseweave.functions.dates import ReportWindow
from caseweave.operators.cohort import Cohort, FlatCohort, as_cohort
from caseweave.sources.catalog import Sources

__all__ = ["Cohort", "FlatCohort", "ReportWindow", "Sources", "as_cohort"]
