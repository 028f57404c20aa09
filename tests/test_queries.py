"""Every registered query against its check SQL on the smallest tables."""

import os
import sys

import pytest
from conftest import TINY

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import __spark_entry__ as contract  # noqa: E402
import check  # noqa: E402
from tidemark.plans import oracles, plans  # noqa: E402

SQL = oracles()
PLANS = plans()


@pytest.fixture(scope="module")
def duck():
    return check.connect(TINY)


def test_every_query_has_its_sql():
    assert set(PLANS) == set(SQL)


@pytest.mark.parametrize("name", sorted(PLANS))
def test_matches_sql(spark, duck, name):
    verdict = check.compare(spark, duck, TINY, PLANS[name], SQL.get(name))
    assert verdict.startswith(("ok", "rows only")), verdict


def test_entry(spark):
    df = contract.entry(spark)
    assert df.columns == ["category", "window_start", "window_end", "revenue", "order_count"]
    assert df.count() > 0
