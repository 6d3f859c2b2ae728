import re

import pytest

from grantline.functions.privileges import PrivilegeSet
from grantline.operators import documents, privileges
from grantline.plans.privileges import acl_document
from grantline.schemas import LEGACY_GRANT


def grants(spark, *data):
    return spark.createDataFrame(list(data), LEGACY_GRANT)


def on_table(principal, action, table="t"):
    return (principal, action, "c", "d", table, None)


def test_every_type_and_every_privilege(spark, rows):
    places = {
        "TABLE": ("c", "d", "t", None),
        "SCHEMA": ("c", "d", None, None),
        "CATALOG": ("c", None, None, None),
        "UNKNOWN": (None, None, None, None),
    }
    expected = {
        ("ALL PRIVILEGES", "TABLE"): ["ALL_PRIVILEGES"],
        ("READ_METADATA", "TABLE"): ["APPLY_TAG"],
        ("READ_METADATA", "SCHEMA"): ["APPLY_TAG"],
        ("READ_METADATA", "CATALOG"): ["BROWSE", "APPLY_TAG"],
        ("USAGE", "TABLE"): ["USE_SCHEMA", "USE_CATALOG"],
        ("USAGE", "SCHEMA"): ["USE_SCHEMA"],
        ("USAGE", "CATALOG"): ["USE_CATALOG"],
        ("CREATE", "TABLE"): [],
        ("CREATE", "SCHEMA"): ["CREATE_TABLE"],
        ("CREATE", "CATALOG"): ["CREATE_SCHEMA"],
        ("CREATE", "UNKNOWN"): ["CREATE_TABLE", "CREATE_SCHEMA"],
        ("select", "SCHEMA"): ["SELECT"],
        ("Modify", "CATALOG"): ["MODIFY"],
        ("CREATE_NAMED_FUNCTION", "SCHEMA"): ["CREATE_FUNCTION"],
        ("OWN", "TABLE"): [],
        (None, "TABLE"): [],
    }
    data = [("p", action, *places[kind]) for action, kind in expected]
    mask = PrivilegeSet()
    result = privileges.translate_grants(grants(spark, *data), mask).select(
        "action_type", "object_type", mask.names()
    )
    assert {(row[0], row[1]): row[2] for row in result.collect()} == expected


def test_views_are_named_like_tables(spark, rows):
    frame = grants(
        spark,
        ("p", "SELECT", "c", "d", None, "v"),
        ("p", "SELECT", "c", "d", "t", "v"),
        ("p", "SELECT", None, "d", None, None),
    )
    described = privileges.describe_objects(frame)
    assert rows(described, "object_type", "object_name") == [
        ("SCHEMA", "d"),
        ("TABLE", "c.d.t"),
        ("TABLE", "c.d.v"),
    ]


def test_privileges_are_united_and_listed_in_descending_order(spark, rows):
    frame = grants(
        spark,
        on_table("p", "SELECT"),
        on_table("p", "select"),
        on_table("p", "MODIFY"),
        on_table("p", "USAGE"),
        on_table("p", "OWN"),
    )
    result = privileges.principal_object_privileges(frame)
    assert rows(result, "privileges", "privilege_list", "legacy_privileges") == [
        (
            ["USE_SCHEMA", "USE_CATALOG", "SELECT", "MODIFY"],
            '["USE_SCHEMA","USE_CATALOG","SELECT","MODIFY"]',
            ["MODIFY", "OWN", "SELECT", "USAGE", "select"],
        )
    ]


def test_rows_without_principal_or_privilege_give_no_grant_but_are_reported(spark, rows):
    frame = grants(
        spark,
        on_table(None, "SELECT"),
        on_table("p", "OWN"),
        on_table("p", "CREATE"),
        on_table("q", "SELECT"),
        ("q", "SELECT", None, None, None, None),
    )
    assert rows(privileges.grantable(frame), "principal", "object_name") == [("q", "c.d.t")]
    assert rows(privileges.unmapped_privileges(frame)) == [
        ("CREATE", "TABLE", "not_allowed_on_type", 1),
        ("OWN", "TABLE", "unmapped", 1),
        ("SELECT", "TABLE", "no_principal", 1),
        ("SELECT", "UNKNOWN", "unknown_object", 1),
    ]


def test_lists_of_an_object_are_parallel_bounded_and_whole(spark):
    data = [on_table(f"u{n}", ["SELECT", "MODIFY"][n % 2]) for n in range(500)]
    data += [on_table("solo", "SELECT", "other")]
    lists = privileges.object_grants(grants(spark, *data), n_lists=10).collect()
    hot = [row for row in lists if row.object_name == "c.d.t"]
    assert {row.list_no for row in hot} == set(range(10)) and len(hot) == 10
    assert max(len(row.principals) for row in hot) < 100
    pairs = {}
    for row in hot:
        assert row.principals == sorted(row.principals)
        pairs |= dict(zip(row.principals, row.privileges))
    assert pairs == {f"u{n}": [["SELECT", "MODIFY"][n % 2]] for n in range(500)}


def test_dominant_type_breaks_ties_in_order(spark, rows):
    frame = grants(
        spark,
        ("p", "SELECT", "a.b", None, None, None),
        ("p", "SELECT", "a", "b", None, None),
        ("q", "SELECT", "x", "y", None, None),
        ("q", "SELECT", "x.y", None, None, None),
        ("r", "SELECT", "x", "y", None, None),
    )
    assert rows(privileges.dominant_object_type(frame)) == [("a.b", "CATALOG"), ("x.y", "SCHEMA")]


def test_object_block_reads_as_one_text(spark):
    frame = grants(
        spark,
        on_table("ann", "SELECT"),
        on_table('b"ob', "ALL PRIVILEGES"),
        on_table("ann", "USAGE"),
        ("ann", "USAGE", "c", None, None, None),
    )
    document = acl_document(frame).orderBy("section", "label", "block", "part", "item")
    text = "".join(row.output + "\n" for row in document.collect())
    header, blocks = text.split("}\n\n", 1)
    assert header.startswith("terraform {")
    kind = re.match(r'resource "(\w+)" ', blocks)[1]
    assert blocks == (
        f'resource "{kind}" "catalog_c" {{\n\tcatalog = "c"\n\n'
        '\tgrant {\n\t\tprincipal  = "ann"\n\t\tprivileges  = ["USE_CATALOG"]\n\t}\n}\n\n'
        f'resource "{kind}" "table_c_d_t" {{\n\ttable = "c.d.t"\n\n'
        '\tgrant {\n\t\tprincipal  = "ann"\n\t\tprivileges  = ["USE_SCHEMA","USE_CATALOG","SELECT"]\n\t}\n\n'
        '\tgrant {\n\t\tprincipal  = "b\\"ob"\n\t\tprivileges  = ["ALL_PRIVILEGES"]\n\t}\n}\n\n'
    )


def test_objects_with_equal_labels_stay_apart(spark):
    frame = grants(spark, on_table("p", "SELECT", "a-b"), on_table("p", "SELECT", "a_b"))
    rows = privileges.grantable(frame)
    pieces = documents.object_grant_blocks(rows, documents.object_addresses(rows))
    ordered = pieces.orderBy("section", "label", "block", "part", "item").collect()
    assert [row.part for row in ordered] == [0, 1, 2, 0, 1, 2]
    assert {row.label for row in ordered} == {"c_d_a_b"}
    addresses = {row.output.split('"')[3] for row in ordered if row.part == 0}
    assert len(addresses) == 2 and all(address.startswith("table_c_d_a_b_") for address in addresses)


def test_own_mapping_with_more_privileges_than_one_mask_holds(spark, rows):
    mapping = {"MANY": [f"P{n:03}" for n in range(130)], "ONE": ["P129"]}
    mask = PrivilegeSet(mapping, {"TABLE": ["P000"]})
    assert len(mask.columns) == 3
    frame = grants(spark, on_table("p", "many"), on_table("q", "ONE"))
    result = privileges.grantable(frame, mask)
    assert rows(result, "principal", "privileges") == [
        ("p", [f"P{n:03}" for n in range(129, 0, -1)]),
        ("q", ["P129"]),
    ]


def test_mapping_can_be_replaced_in_the_pipeline(spark):
    frame = grants(spark, on_table("p", "OWN"), on_table("p", "SELECT"))
    text = "".join(row.output for row in acl_document(frame, {"OWN": ["MANAGE"]}).collect())
    assert '["MANAGE"]' in text and "SELECT" not in text


@pytest.mark.parametrize("kind, kept", [("TABLE", 847), ("VIEW", 1023)])
def test_unknown_types_remove_nothing(spark, kind, kept):
    mask = PrivilegeSet()
    row = (
        spark.createDataFrame([(kind, 1023)], "kind string, privilege_bits_0 bigint")
        .select(*mask.allowed_on("kind"))
        .first()
    )
    assert row[0] == kept
