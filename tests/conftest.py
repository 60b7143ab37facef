import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from rollspan.session import make_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = make_session("tests", "local[4]", **{
        "spark.ui.enabled": "false", "spark.sql.shuffle.partitions": "4", "spark.driver.memory": "4g"})
    session.sparkContext.setLogLevel("ERROR")
    return session


def rows(df, *order):
    """Rows as dicts, ordered by the given columns."""
    return [r.asDict() for r in (df.orderBy(*order) if order else df).collect()]


@pytest.fixture
def as_rows():
    return rows
