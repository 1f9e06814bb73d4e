"""Every registered query against its SQL on the smallest tables."""

import re

import pytest

import __spark_entry__ as entry_module
from checks.compare import connect, difference
from checks.queries import ORACLES, QUERIES

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(FOLDER)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_sql(spark, con, name):
    assert difference(QUERIES[name](spark, FOLDER), con, ORACLES[name]) is None


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_query_has_rows(spark, name):
    assert QUERIES[name](spark, FOLDER).count() > 0


def test_entry_is_the_flagship(spark):
    assert entry_module.entry(spark).columns == ["lang", "source_file", "count", "percent"]
    assert QUERIES.keys() <= entry_module.queries().keys()
    assert set(entry_module.oracle_sql()) <= set(entry_module.queries())


def test_every_listed_operator_has_a_query():
    """The inventory's ids, apart from helpers that other operators carry."""
    ids = {re.match(r"([a-z]+\d+)_", n).group(1) for n in QUERIES if re.match(r"[a-z]+\d+_", n)}
    wanted = {f"s{i}" for i in (1, 3, 4, 5, 7, 8, 9, 10)}
    wanted |= {f"p{i}" for i in range(1, 44)} - {"p24", "p25", "p26", "p28"}
    wanted |= {f"d{i}" for i in range(1, 6)} | {f"j{i}" for i in range(1, 7)}
    wanted |= {f"a{i}" for i in range(1, 35)} | {f"w{i}" for i in range(1, 10)}
    wanted |= {f"r{i}" for i in range(1, 4)} | {f"l{i}" for i in range(1, 13)}
    assert wanted <= ids
