"""Every registered query runs, and equals its SQL twin where it has one."""

from __future__ import annotations

import compare
import pytest

import __spark_entry__ as entry
from tests.conftest import SMALL


@pytest.fixture(scope="module")
def duck():
    return compare.connect(SMALL)


@pytest.mark.parametrize("name", sorted(entry.queries()))
def test_query(spark, duck, name):
    _, note, good = compare.check(spark, duck, name, entry.queries()[name], entry.oracle_sql().get(name), SMALL)
    assert good, note


def test_entry(spark):
    assert set(entry.entry(spark).columns) >= {"o_orderkey", "fold", "o_custkey_target_enc"}


def test_every_twin_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())
