"""Every registered query against its oracle on the smallest tables."""

from __future__ import annotations

import compare
import pytest

import __spark_entry__ as entry_points
from meterloom.workload.queries import QUERIES

SF_DIR = "/root/testdata/sf0.001"
OWN = set(QUERIES)


@pytest.fixture(scope="module")
def con():
    return compare.connect(SF_DIR)


def test_every_query_has_an_oracle():
    assert OWN <= set(entry_points.oracle_sql())
    assert OWN <= set(entry_points.queries())
    assert set(entry_points.oracle_sql()) <= set(entry_points.queries())


@pytest.mark.parametrize("name", sorted(entry_points.oracle_sql()))
def test_query(spark, con, name):
    found = compare.differences(entry_points.queries()[name](spark, SF_DIR), con, entry_points.oracle_sql()[name])
    assert found is None, found


def test_partition_profile_covers_all_rows(spark):
    profile = entry_points.queries()["partition_profile"](spark, SF_DIR).collect()
    assert sum(r["row_count"] for r in profile) == spark.read.parquet(f"{SF_DIR}/lineitem.parquet").count()


def test_entry_is_the_target_layout(spark):
    assert len(entry_points.entry(spark).columns) == 47
