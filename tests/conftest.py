import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tunelake.session import build_session, ship_package  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "tests",
        "local[4]",
        **{
            "spark.sql.shuffle.partitions": "4",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.driver.memory": "4g",
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    ship_package(session)
    return session


@pytest.fixture(scope="session")
def make(spark):
    """Rows to a DataFrame over several partitions."""

    def build(rows, schema):
        return spark.createDataFrame(rows, schema).repartition(3)

    return build


@pytest.fixture
def rows():
    """A DataFrame as sorted tuples, columns in the given order."""

    def collect(df, *columns):
        found = df.select(*columns) if columns else df
        return sorted((tuple(r) for r in found.collect()), key=repr)

    return collect
