import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from changeflow.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "tests",
        "local[4]",
        spark__sql__shuffle__partitions="4",
        spark__driver__memory="4g",
        spark__ui__showConsoleProgress="false",
        spark__sql__maxMetadataStringLength="10000",
        spark__sql__debug__maxToStringFields="1000",
        spark__checkpoint__dir=str(tmp_path_factory.mktemp("shared")),
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def plan():
    """The physical plan of a DataFrame, as text."""

    def text(df):
        return df._jdf.queryExecution().executedPlan().toString()

    return text


def rows(df, *columns):
    """Rows as sorted tuples, for comparisons that ignore order."""
    picked = df.select(*columns) if columns else df
    return sorted((tuple(row) for row in picked.collect()), key=repr)
