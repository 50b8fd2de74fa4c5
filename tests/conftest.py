from __future__ import annotations

import datetime as dt
import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from caseweave.functions.dates import ReportWindow  # noqa: E402
from caseweave.session import tune  # noqa: E402
from caseweave.sources.catalog import Sources  # noqa: E402
from caseweave.sources.schemas import SCHEMAS  # noqa: E402
from verification.compare import session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    s = tune(session(8))
    if s.conf.get("spark.checkpoint.dir", None) is None:
        s.sparkContext.setCheckpointDir(str(tmp_path_factory.mktemp("checkpoint")))
    return s


@pytest.fixture(scope="session")
def window():
    return ReportWindow("2023-01-01", "2023-12-31")


def as_value(field, value):
    if value is not None and field.dataType.simpleString() == "date":
        return dt.date.fromisoformat(value)
    return value


@pytest.fixture(scope="session")
def table(spark):
    """Small source table: rows as dicts, missing columns NULL, dates as text."""

    def make(name, rows=()):
        schema = SCHEMAS[name]
        data = [tuple(as_value(f, r.get(f.name)) for f in schema) for r in rows]
        return spark.createDataFrame(data, schema)

    return make


@pytest.fixture(scope="session")
def sources(table):
    """Sources with the given tables; all others are empty."""

    def make(**tables):
        return Sources(lambda n: table(n, tables.get(n, ())))

    return make


@pytest.fixture(scope="session")
def rows():
    """Rows of a DataFrame as sorted tuples of the named columns."""

    def collect(df, *columns):
        got = [tuple(r[c] for c in (columns or df.columns)) for r in df.collect()]
        return sorted(
            (tuple(str(v) if isinstance(v, dt.date) else v for v in r) for r in got),
            key=lambda r: tuple((v is not None, str(v)) for v in r),
        )

    return collect
