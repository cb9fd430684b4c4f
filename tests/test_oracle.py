"""Every registered query against its SQL equivalent on the smallest tables."""

from __future__ import annotations

import pytest
from oracle import compare, duck

import __spark_entry__ as entry

QUERIES, ORACLES = entry.queries(), entry.oracle_sql()



@pytest.fixture(scope="module")
def con(sf_dir):
    return duck(sf_dir)


@pytest.mark.parametrize("key", sorted(ORACLES))
def test_matches_sql(spark, sf_dir, con, key):
    assert compare(QUERIES[key](spark, sf_dir), con, ORACLES[key]) is None


@pytest.mark.parametrize("key", sorted(set(QUERIES) - set(ORACLES)))
def test_runs(spark, sf_dir, key):
    assert QUERIES[key](spark, sf_dir).count() > 0


def test_entry_is_ordered(spark):
    df = entry.entry(spark)
    values = [r["irc"] for r in df.select("irc").collect()]
    assert values and values == sorted(values, reverse=True)


def test_keys_follow_the_inventory():
    ids = {k.split("_")[0] for k in QUERIES}
    counts = {"S": 8, "P": 17, "J": 12, "A": 27, "W": 10, "O": 4, "U": 2, "R": 7, "F": 22, "D": 23, "M": 8}
    assert {f"{letter}{i}" for letter, n in counts.items() for i in range(1, n + 1)} <= ids
