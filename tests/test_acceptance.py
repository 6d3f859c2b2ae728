"""Known row counts of the smallest tables, and relations that must hold between results."""

import pytest
from pyspark.sql import functions as F

from grantline import catalog

SMALL = "/root/testdata/sf0.001"


def run(spark, name):
    return catalog.queries()[name](spark, SMALL)


@pytest.mark.parametrize(
    "name, count",
    [
        ("governance_export", 272),
        ("location_access", 992),
        ("uncovered_patterns", 26),
        ("new_location_proposals", 21),
        ("volumes", 54),
        ("allowlist_delta", 115),
    ],
)
def test_row_counts(spark, name, count):
    assert run(spark, name).count() == count


def test_number_of_single_privileges(spark):
    entries = run(spark, "principal_object_privileges").filter("privileges <> ''")
    assert entries.select(F.explode(F.split("privileges", ","))).count() == 3735


def test_document_blocks_fit_together(spark):
    document = run(spark, "hcl_location_document").cache()
    outputs = document.select("section", "output")
    address = r'^(?:resource|data) "\w+" "(\w+)"'
    defined = outputs.filter("section IN (1, 2)").select(F.regexp_extract("output", address, 1).alias("address"))
    referred = outputs.filter("section = 3").select(
        F.regexp_extract("output", r"external_location\.(\w+)\.id", 1).alias("address")
    )
    assert defined.count() == defined.distinct().count()
    assert referred.distinct().exceptAll(defined).count() == 0
    grants = outputs.filter("section = 3").select(F.regexp_extract("output", address, 1))
    assert grants.count() == grants.distinct().count()
    document.unpersist()


@pytest.mark.parametrize(
    "name", ["bucket_map_duplicates", "unsearchable_paths", "incomplete_blocks", "allowlist_delta_jar", "allowlist_delta_maven"]
)
def test_checks_are_not_empty(spark, name):
    assert run(spark, name).count() > 0


def test_every_reason_of_a_dropped_resource_occurs(spark):
    reasons = {r.reason for r in run(spark, "dropped_resources").select("reason").distinct().collect()}
    assert reasons == {
        "not_allowed", "not_storage", "inside_bucket", "unreadable_document", "no_document", "no_resource", "too_few_paths",
        "conditional", "action_limited",
    }


def test_no_grant_without_privileges(spark):
    grants = run(spark, "hcl_object_grants").filter("part = 1")
    assert grants.count() > 0
    assert grants.filter(F.col("output").contains('[""]') | F.col("output").contains("[]")).count() == 0
