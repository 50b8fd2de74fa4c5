"""Predicates on case sessions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from caseweave import fixed_values as fv
from caseweave.functions.dates import ReportWindow
from caseweave.functions.matching import ci_eq


def of_kind(cm_outreach: str) -> Column:
    return ci_eq("session_casenote", fv.SESSION_KINDS[cm_outreach.lower()])


def in_scope(cm_outreach: str, window: ReportWindow | None) -> Column:
    kind = of_kind(cm_outreach)
    return kind if window is None else kind & window.has("session_date")


def reached(contact: str = "indirect_type") -> Column:
    """The contact is not marked as failed."""
    return F.col(contact).isNull() | ~ci_eq(contact, fv.UNSUCCESSFUL)


def successful() -> Column:
    return (F.col("hours") > 0) & reached()


def unsuccessful() -> Column:
    return (F.col("hours") == 0) | ci_eq("indirect_type", fv.UNSUCCESSFUL)
