"""Every named query runs at the smallest scale and equals its check text where there is one."""

import pytest
from check import compare

from eventloom.plans.registry import all_checks, all_queries

SF = "/root/testdata/sf0.001"
# Filters that select single keys or days find nothing at the smallest scale.
SPARSE = {"flt5_flight_search"}


@pytest.mark.parametrize("name", sorted(all_queries()))
def test_query(spark, name):
    problem = compare(spark, SF, all_queries()[name], all_checks().get(name))
    assert problem is None or (name in SPARSE and problem == "both empty")
