"""Every registered query against its SQL oracle, on the smallest tables."""

import re

import pytest

import __spark_entry__ as entry
import check
from tests.conftest import SF


@pytest.fixture(scope="module")
def oracle():
    return check.oracle_connection(SF)


def test_oracles_belong_to_queries():
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_every_query_has_an_oracle():
    """But for the training-data operators, which have tests of their own."""
    bare = set(entry.queries()) - set(entry.oracle_sql())
    assert all(re.match(r"op\d+_|pipeline$", name) for name in bare)


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_query(spark, oracle, name):
    verdict, detail, _ = check.compare(spark, oracle, name, SF)
    assert verdict == "ok", detail


def test_entry(spark):
    assert entry.entry(spark).count() > 0
