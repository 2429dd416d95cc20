"""Every registered query against independent SQL on the same tables."""

from __future__ import annotations

import os

import pytest

import __spark_entry__ as entry_module
import compare

SF_DIR = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def duck():
    return compare.connect(SF_DIR)


@pytest.mark.parametrize("name", sorted(entry_module.oracle_sql()))
def test_query_equals_sql(spark, duck, name):
    frame = entry_module.queries()[name](spark, SF_DIR)
    assert compare.difference(frame, duck, entry_module.oracle_sql()[name]) is None


def test_every_oracle_has_a_query():
    assert set(entry_module.oracle_sql()) <= set(entry_module.queries())


def test_entry_row_count(spark):
    assert entry_module.entry(spark).count() == 1923
