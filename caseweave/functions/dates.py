"""Reporting window and date arithmetic."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F


def _as_date(value: str | dt.date) -> dt.date:
    return value if isinstance(value, dt.date) else dt.date.fromisoformat(value)


@dataclass(frozen=True)
class ReportWindow:
    """Reporting period, inclusive at both ends."""

    t1: dt.date
    t2: dt.date

    def __init__(self, t1: str | dt.date, t2: str | dt.date):
        object.__setattr__(self, "t1", _as_date(t1))
        object.__setattr__(self, "t2", _as_date(t2))
        if self.t1 > self.t2:
            raise ValueError(f"window starts after it ends: {self.t1} > {self.t2}")

    @property
    def start(self) -> Column:
        return F.lit(self.t1)

    @property
    def end(self) -> Column:
        return F.lit(self.t2)

    def has(self, c: Column | str) -> Column:
        return (F.col(c) if isinstance(c, str) else c).between(self.start, self.end)

    def cutoff(self, which: str | dt.date, active: str = "active_date") -> Column:
        """'active_date', 't1', 't2' or an ISO date, as a date column."""
        if isinstance(which, dt.date):
            return F.lit(which)
        named = {"active_date": F.col(active), "t1": self.start, "t2": self.end}
        key = which.lower()
        return named[key] if key in named else F.lit(_as_date(which))


def add_years(c: Column | str, years: int) -> Column:
    return F.add_months(c, 12 * years)


def age_years(birth: Column | str, at: Column | str) -> Column:
    """Completed years between two dates (29 Feb birthdays complete on 1 Mar)."""
    b = F.col(birth) if isinstance(birth, str) else birth
    a = F.col(at) if isinstance(at, str) else at
    return F.timestamp_diff("YEAR", b.cast("timestamp"), a.cast("timestamp"))


def overlaps(start: Column, end: Column, w: ReportWindow) -> Column:
    """Interval [start, end] meets the window; a NULL end is still running."""
    return (start <= w.end) & (end.isNull() | (end >= w.start))


def in_years(c: Column | str, years: Sequence[int]) -> Column:
    """The date lies in one of the years; written as ranges, which a scan can use to skip data."""
    col = F.col(c) if isinstance(c, str) else c
    ranges = [col.between(F.lit(dt.date(y, 1, 1)), F.lit(dt.date(y, 12, 31))) for y in years]
    return reduce(lambda a, b: a | b, ranges, F.lit(False))
