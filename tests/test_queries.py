"""Every registered query against its SQL, and the shape of its plan."""

import pytest

from checks.compare import compare
from checks.oracle import statements
from grantline import catalog

SMALL = "/root/testdata/sf0.001"
NAMES = sorted(catalog.queries())


def test_every_query_has_its_sql():
    assert set(NAMES) == set(statements())


@pytest.mark.parametrize("name", NAMES)
def test_query_agrees_with_sql(spark, name):
    assert compare(spark, SMALL, name) == ""


@pytest.mark.parametrize(
    "name",
    [
        "location_access",
        "location_access_anchored",
        "location_access_diverse",
        "new_location_proposals",
        "governance_export",
        "hcl_object_grants",
        "object_grants",
        "volumes",
        "allowlist_payload",
        "bucket_folders",
    ],
)
def test_plan_has_no_nested_loop_and_no_python(spark, name):
    plan = catalog.queries()[name](spark, SMALL)._jdf.queryExecution().executedPlan().toString()
    for operator in ("NestedLoopJoin", "CartesianProduct", "Python", "Pandas"):
        assert operator not in plan


def test_scan_reads_only_the_needed_columns(spark):
    plan = (
        catalog.queries()["hcl_object_grants"](spark, SMALL)._jdf.queryExecution().executedPlan().toString()
    )
    assert "l_extendedprice" not in plan and "l_shipdate" not in plan
