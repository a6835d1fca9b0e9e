import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

from tanisight.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "tests", "local[8]",
        spark__sql__shuffle__partitions="4", spark__ui__enabled="false",
        spark__ui__showConsoleProgress="false", spark__driver__memory="8g",
        spark__checkpoint__dir=str(tmp_path_factory.mktemp("shared")),
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf():
    return "/root/testdata/sf0.001"


def rows(df, *columns):
    """Rows as sorted tuples."""
    picked = df.select(*columns) if columns else df
    return sorted((tuple(r) for r in picked.collect()), key=repr)


def plan_of(df):
    """Physical plan as text."""
    return df._jdf.queryExecution().executedPlan().toString()
