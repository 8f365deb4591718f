"""The driver's contract: every query runs on the smallest tables and agrees with its SQL."""

import os

import pytest

import __spark_entry__ as entry_module
import check
from tunelake.session import shared_folder

DATA = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="no test tables")


@pytest.fixture(scope="module")
def con():
    return check.duck(DATA)


def test_entry(spark):
    df = entry_module.entry(spark)
    assert df.columns == ["run", "step", "eval_loss", "train_loss", "gap"] and df.count() > 0


def test_every_oracle_belongs_to_a_query():
    assert set(entry_module.oracle_sql()) <= set(entry_module.queries())


@pytest.mark.parametrize("name", sorted(entry_module.queries()))
def test_query_equals_sql(spark, con, name):
    verdict, _, _ = check.compare(spark, con, DATA, name)
    assert verdict in ("equal", "no sql")


def test_shared_folder_is_the_configured_one(spark):
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        assert shared_folder(spark) == configured.rstrip("/")
